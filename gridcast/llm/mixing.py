"""Operator 10: mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, served in proportion to its
target. A document copy finishes at virtual time (words of its source up to its end)
/ (target of its source). At virtual time 1 all sources reach their targets; a copy that
lies across that line is two pieces, which finish at 1 and later. The pieces are range-sorted
globally by finish time and cut at the total budget by sums per range; what the cut leaves
of each source is how far its queue is served, and so what is taken of each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, saved

#: Columns that the mix adds; input columns of these names are replaced.
ADDED = ["size", "source_size", "target", "before", "taken"]


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(source_sizes: DataFrame, cycle: int = 3, max_repeats: int = 3) -> DataFrame:
    """``(source, source_size)`` -> and ``target``, one row per source.

    Sources in code point order, null last, weigh 1 .. ``cycle``, repeating, and share
    all sizes. No target exceeds ``max_repeats`` times its size; what is over goes to
    the others by weight until none is above. That fixed point is a water level: by
    rising cap per weight, the level of "all before are capped" is right where it lies
    at or below the own cap. The windows run over one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = (source_sizes.withColumn("weight", (F.row_number().over(in_order) - 1) % cycle + 1)
         .withColumn("cap", F.col("source_size") * max_repeats)
         .withColumn("ratio", F.col("cap").cast("double") / F.col("weight")))
    capped = F.coalesce(F.sum("cap").over(by_cap), F.lit(0).cast("long"))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0).cast("long"))
    t = t.withColumn("level", (F.sum("source_size").over(everything) - capped).cast("double") / weight)
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    return t.select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
                    .alias("target"))


def fair_mix(docs: DataFrame, cycle: int = 3, max_repeats: int = 3, seed: str = "mix", cells: int = 1024) -> DataFrame:
    """``docs`` with the columns ADDED; every row comes back, ``taken`` is 0 where the mix has none of it.

    ``docs`` needs doc_id, source and ``size`` (words; see :func:`word_count`).
    ``before`` is the words of its source that precede it. The shuffle is the order of
    md5(seed:doc_id), so reruns and other cluster sizes agree; rows with one id go by
    size. A source is cut into ``cells`` ranges of that order: sums per cell give each
    cell's offset and a window inside the cell does the rest, so a source with a third
    of all rows is many tasks. Null sources are one source. Documents without words
    take nothing. No rows in: no rows out.
    """
    cols = [c for c in docs.columns if c not in ADDED]
    slim = saved(docs.select("doc_id", "source", "size"))  # all steps but the last read these three columns

    def celled(rows: DataFrame) -> DataFrame:
        key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        return rows.withColumn("__key", key).withColumn(
            "__cell", F.floor(F.conv(F.substring("__key", 1, 4), 16, 10).cast("int") * cells / 65536))

    sums = celled(slim).groupBy("source", "__cell").agg(F.sum("size").alias("cell_size"))
    sized = targets(sums.groupBy("source").agg(F.sum("cell_size").alias("source_size")), cycle, max_repeats)
    earlier = Window.partitionBy("source").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.withColumn("__offset", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0).cast("long")))
    of_cell = saved(offset.join(sized.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).select(
        F.col("source").alias("__source"), F.col("__cell").alias("__c"), "__offset", "source_size", "target"))

    def placed(rows: DataFrame) -> DataFrame:
        """With the words of the source before each row."""
        inside = (Window.partitionBy("source", "__cell").orderBy("__key", "doc_id", "size")
                  .rowsBetween(Window.unboundedPreceding, -1))
        rows = celled(rows).join(of_cell, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__cell") == F.col("__c")))
        return rows.withColumn("before", F.col("__offset") + F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))

    served = serve(placed(slim), max_repeats).select(F.col("source").alias("__of"), F.col("served").alias("__line"))
    rows = placed(docs.select(*cols, "size")).join(served, F.col("source").eqNullSafe(F.col("__of")), "left")
    line = F.coalesce("__line", F.lit(0).cast("long"))
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), line - F.col("before") - F.col("source_size") * e))
                 for e in range(max_repeats)), F.lit(0)).cast("long")
    return rows.select(*cols, "size", "source_size", "target", "before", taken.alias("taken"))


def serve(rows: DataFrame, max_repeats: int) -> DataFrame:
    """``(source, served)``: words of each source that the global cut at the budget leaves.

    ``rows`` are (source, size, source_size, target, before). The budget is the sum of the
    rounded targets. Only these numbers move; they are written once, in finish order.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.floor(F.col("target") + 0.5)  # words of the source up to virtual time 1
    begin = F.col("before") + F.col("source_size") * F.col("copy")
    end = begin + F.col("size")
    queue = (rows.where("size > 0").select("source", "size", "source_size", "target", "before",
                                           F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("copy")))
    early = F.struct(F.when(end < mark, end / F.col("target")).otherwise(1.0).alias("finish"),
                     (F.least(end, mark) - begin).alias("words"))
    late = F.struct((end / F.col("target")).alias("finish"), (end - F.greatest(begin, mark)).alias("words"))
    pieces = (queue.select("source", "before", "copy", F.inline(F.array(early, late))).where("words > 0"))
    order = ["finish", "source", "before", "copy"]
    ranged = saved(pieces.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                   .withColumn("range", F.spark_partition_id()))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = ranged.groupBy("range").agg(F.sum("words").alias("n")).select(
        F.col("range").alias("__range"), F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("__first"))
    budget = rows.select("source", mark.alias("mark")).distinct().agg(F.coalesce(F.sum("mark"), F.lit(0).cast("long")).alias("budget"))
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("__own", F.coalesce(F.sum("words").over(inside), F.lit(0).cast("long")))
              .join(ranges, F.col("range") == F.col("__range")).crossJoin(F.broadcast(budget)))  # one row
    left = F.col("budget") - F.col("__first") - F.col("__own")
    return placed.groupBy("source").agg(F.sum(F.greatest(F.lit(0), F.least(F.col("words"), left))).alias("served"))


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows that the mix takes, range-sorted by the virtual time at which their first copy ends."""
    finish = (F.col("before") + F.col("size")) / F.col("target")
    taken = mixed.where("taken > 0").withColumn("virtual_finish", finish)
    return (taken.repartitionByRange("virtual_finish", "source", "doc_id")
            .sortWithinPartitions("virtual_finish", "source", "doc_id"))
