"""What the operators share: inputs, row keys, saved tables and bounded samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The white space of the contracts (the ASCII blanks), and what lies between it.
BLANKS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
MOST_STRATA = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved_folder(spark: SparkSession) -> str:
    """A new place in the shared folder; what is written there goes when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Later steps then read the same rows however often they run and whichever
    executor is lost.
    """
    path = saved_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """64 bits of a text; with ``doc_id`` it names a row up to true repeats."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_rows(docs: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``winners(win_id, win_key)``, one for each.

    ``win_id`` is a doc_id (null joins null) and ``win_key`` a :func:`text_key`.
    Of rows that repeat id and text, one stays; they can differ only in the other
    columns. The join and the aggregate share one exchange of the texts.
    """
    key = "__text_key"
    cols = docs.columns
    named = docs.withColumn(key, text_key())
    hit = named.join(winners, (named["doc_id"].eqNullSafe(winners["win_id"])) & (named[key] == winners["win_key"]),
                     "left_semi")
    return hit.dropDuplicates(["doc_id", key]).select(*cols)


def drop_rows(docs: DataFrame, losers: DataFrame) -> DataFrame:
    """``docs`` without the rows named by ``losers(win_id, win_key)``."""
    key = "__text_key"
    cols = docs.columns
    named = docs.withColumn(key, text_key())
    return named.join(losers, (named["doc_id"].eqNullSafe(losers["win_id"])) & (named[key] == losers["win_key"]),
                      "left_anti").select(*cols)


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def bounded_sample(rows: DataFrame, stratum: str, per_stratum: int, doc_id: str = "doc_id") -> DataFrame:
    """About ``per_stratum`` rows of each stratum, chosen by a hash of the id.

    A count per stratum sets a hash threshold, so there is no sort and no pull of rows
    to the driver; a stratum with fewer rows is taken whole. Up to MOST_STRATA counts
    are broadcast, so that ``rows`` are not shuffled; with more, Spark joins as it likes.
    """
    scale = 1 << 30
    counts = (rows.groupBy(F.col(stratum).alias("__s")).count()
              .select("__s", (F.lit(float(per_stratum)) * scale / F.col("count")).alias("__upto")))
    known = counts.limit(MOST_STRATA + 1).collect()
    if len(known) <= MOST_STRATA:
        counts = F.broadcast(rows.sparkSession.createDataFrame(known, counts.schema))
    drawn = F.pmod(F.xxhash64(F.lit(17), F.col(doc_id)), F.lit(scale))
    return (rows.join(counts, F.col(stratum) == F.col("__s")).where(drawn < F.col("__upto"))
            .drop("__s", "__upto"))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """``(text, label)`` of at most about ``per_label`` documents of each label.

    Only labels are sampled and broadcast (two columns, two labels, ``per_label`` rows
    each), so the documents are read once and not shuffled. An id with several labels
    has the highest, one with several texts the smallest.
    """
    one = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("label").cast("int").alias("label"))
    wanted = bounded_sample(one, "label", per_label)
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(wanted), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"))
