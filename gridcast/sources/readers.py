"""A1 read, A2 newest snapshot, A3 preferred source, A9 write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_timestamps(df: DataFrame) -> DataFrame:
    """Naive (NTZ) timestamps in storage mean UTC: cast them to instants.

    Under the UTC session the cast is the identity on the clock value.
    """
    cols = [F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def load_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read one driver table; projecting early lets the scan prune columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return canonical_timestamps(df)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                 with_ingest_seq: bool = False, **options) -> DataFrame:
    """A1: read a dataset with a declared schema (no inference on the hot path).

    ``with_ingest_seq`` adds ``ingest_file`` and ``ingest_seq``; sorting by both is file
    order ("keep first", B4). In Parquet the number is the row's index in its file; in
    other formats, which have no index, an increasing id that follows the splits.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        options.setdefault("header", "true")
    df = r.options(**options).load(path)
    if with_ingest_seq:
        df = (df.withColumn("ingest_file", F.col("_metadata.file_path"))
                .withColumn("ingest_seq", F.col("_metadata.row_index") if fmt == "parquet"
                            else F.monotonically_increasing_id()))
    return canonical_timestamps(df)


def newest_snapshot(files: DataFrame, dataset_col: str = "dataset") -> DataFrame:
    """A2: the newest file of each dataset, matched by *exact* dataset name.

    ``files`` is ``(dataset, path, mtime)`` — e.g. built from
    ``_metadata.file_path`` / ``_metadata.file_modification_time`` of a scan.
    Returns one row per dataset: ``(dataset, path, mtime)``.
    """
    return (files.groupBy(dataset_col)
            .agg(F.max_by("path", F.struct("mtime", "path")).alias("path"), F.max("mtime").alias("mtime")))


def read_newest(spark: SparkSession, root: str, dataset: str, fmt: str = "parquet") -> DataFrame:
    """A2: the newest snapshot of ``dataset`` under ``root`` (``root/<dataset>/<snapshot>/files``).

    The newest file's folder is the snapshot. A dataset whose name only begins alike does not match.
    """
    files = file_listing(spark, f"{root}/*/*", fmt).withColumn("dataset", F.regexp_extract("path", "([^/]+)/[^/]+/[^/]+$", 1))
    found = newest_snapshot(files.where(F.col("dataset") == dataset)).first()  # one row
    if found is None:
        raise FileNotFoundError(f"no snapshot of {dataset} under {root}")
    return canonical_timestamps(spark.read.format(fmt).load(found["path"].rsplit("/", 1)[0]))


def file_listing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Distinct (path, mtime) of the files under ``path``, from scan metadata only."""
    df = spark.read.format(fmt).load(path)
    return (df.select(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_modification_time").alias("mtime")).distinct())


def coalesce_sources(preferred: DataFrame, fallback: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A3 per-row variant: preferred value where present, fallback elsewhere."""
    p = preferred.select(*keys, F.col(value).alias("_p"))
    f = fallback.select(*keys, F.col(value).alias("_f"))
    return p.join(f, list(keys), "full").select(*keys, F.coalesce("_p", "_f").alias(value))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | Column | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Persist a processed table, partitioned (e.g. by year) for pruning."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
