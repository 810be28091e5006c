"""Row identity and positions without a single-task window.

``row_number()`` over an unpartitioned window moves every row into one task.
Positions are instead derived from a range-partitioned sort: each sorted
partition counts its rows, a tiny prefix sum over the partition counts gives
offsets (one row per partition, broadcast), and a row's position is its
partition offset plus its index inside the partition.  The sorted data is
checkpointed first (reliable checkpoint in the shared checkpoint folder) so
that both uses of it see identical partitions even after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, order: list[Column | str], name: str = "position",
                  base: int = 0, checkpoint: bool = True) -> DataFrame:
    """Add a dense 0/1-based position in ``order`` (order must be total)."""
    s = df.orderBy(*order)
    s = s.withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    if checkpoint:
        s = s.checkpoint(eager=True)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    # The prefix sum runs over one row per partition (a few thousand at most).
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = s.join(F.broadcast(offsets.select("__pid", "__off", "__first")), "__pid")
    return out.withColumn(name, (F.col("__off") + F.col("__mid") - F.col("__first") + base).cast("long")).drop(
        "__pid", "__mid", "__off", "__first")


def rank_within(df: DataFrame, group: list[str], order: list[Column | str], name: str = "rank",
                base: int = 0) -> DataFrame:
    """Dense rank inside each group by ``order`` with hot groups spread over
    many tasks: global position minus the group's first position."""
    p = with_position(df, [*group, *order], "__pos")
    starts = p.groupBy(*group).agg(F.min("__pos").alias("__start"), F.count(F.lit(1)).alias("__group_rows"))
    from ..functions.skew import join_group_stats
    j = join_group_stats(p, starts, group, "__group_rows", "__pos")
    return j.withColumn(name, F.col("__pos") - F.col("__start") + base).drop("__pos", "__start")


def assign_source_row(spark, paths: list[str] | str, base: int = 1, name: str = "source_row") -> DataFrame:
    """Sequential row id in file order for Parquet inputs (1-based by default).

    Uses the scan's ``_metadata.row_index`` plus per-file offsets (files in
    path order); only one row per file passes through the small offset table.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("__file"),
                                          F.col("_metadata.row_index").alias("__ri"))
    files = df.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    out = df.join(F.broadcast(offsets), "__file")
    cols = [c for c in df.columns if c not in ("__file", "__ri")]
    return out.select((F.col("__off") + F.col("__ri") + base).cast("long").alias(name), *cols)
