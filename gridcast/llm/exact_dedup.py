"""Operator 6: exact duplicates by a tree merge of sorted digest runs.

Rows are dealt to runs by their number, whatever their digest, so all runs are of one size.
A task sorts its run and thins it: of equal digests the best row stays and the counts add
up. In each round the runs of ``fan_in`` neighbours meet and are merged in digest order in
the same way. While the runs get fewer, each is cut into more digest ranges, so all tasks
stay busy until one run, spread by range, is left. A round exchanges by (run, range) alone:
a task holds one range of one merged run. Only digests move; a group of copies has at most
one entry in each run, however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, saved, text_key

#: What two entries must share to count as one text: SHA-256, a second hash with other
#: mathematics, and the number of bytes. Checked at every level of the merge.
SAME = ["digest", "check", "n_bytes"]


def _digests(docs: DataFrame, runs: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", F.char_length(text).alias("n_points"), text_key().alias("text_key"),
                        F.regexp_replace(text, f"{BLANKS}+", "").alias("bare"))
            .select("doc_id", "n_points", "text_key", F.unhex(F.sha2("bare", 256)).alias("digest"),
                    F.xxhash64("bare").alias("check"), F.octet_length("bare").alias("n_bytes"),
                    F.monotonically_increasing_id().alias("row"))
            .withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int")))


def _merged(entries: DataFrame, *place: str) -> DataFrame:
    """Entries with their new ``place`` (run, or run and slice): each is sorted by digest in one task and thinned."""
    return (entries.repartition(*place).sortWithinPartitions(*place, *SAME)
            .groupBy(*place, *SAME).agg(F.min("best").alias("best"), F.sum("n").alias("n")))


def merge_runs(entries: DataFrame, runs: int, fan_in: int) -> DataFrame:
    """``(digest, check, n_bytes, run, best, n)`` of many runs -> the same of one run."""
    lead = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    slices = 1
    entries = _merged(entries, "run")
    while runs > 1:
        runs, slices = -(-runs // fan_in), min(slices * fan_in, 1 << 16)
        entries = _merged(entries.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                          .withColumn("slice", F.floor(lead * slices / 65536).cast("int")), "run", "slice")
    return entries.select(*SAME, "best", "n")


def exact_duplicates(docs: DataFrame, runs: int | None = None, fan_in: int = 8) -> DataFrame:
    """``(doc_id, text_key, keep_id, keep_key, group_size, kept, text_sha256)`` for each row.

    Two texts are equal when they are identical without ASCII white space. Of a group
    the row with most code points stays, then the smallest doc_id (null last).
    (keep_id, keep_key) names that row. A null text counts as empty; all empty and
    blank texts are one group. Of rows that repeat id and text exactly one is ``kept``.
    No rows in: no rows out. Other columns are not read.
    """
    runs = runs or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = saved(_digests(docs, runs))
    rank = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"), F.col("row"))
    merged = merge_runs(rows.select(*SAME, "run", rank.alias("best"), F.lit(1).cast("long").alias("n")), runs, fan_in)
    return (rows.join(merged, SAME).select(
        "doc_id", "text_key", F.col("best.doc_id").alias("keep_id"), F.col("best.text_key").alias("keep_key"),
        F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256")))
