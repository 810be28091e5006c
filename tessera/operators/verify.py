"""Verification operators: identities, row-level equality, samples.

Every check returns a small DataFrame of counts (``0`` bad rows = pass), so
a check is a Spark job over the whole data, never a driver-side loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_keys(a: DataFrame, b: DataFrame, a_not_b: str = "a_not_b", b_not_a: str = "b_not_a",
              a_rows: str | None = None) -> DataFrame:
    """Symmetric EXCEPT (distinct) of two key sets as one row of counts."""
    x = a.subtract(b).agg(F.count(F.lit(1)).alias(a_not_b))
    y = b.subtract(a).agg(F.count(F.lit(1)).alias(b_not_a))
    parts = [x.withColumn("__j", F.lit(1)), y.withColumn("__j", F.lit(1))]
    if a_rows:
        parts.append(a.agg(F.count(F.lit(1)).alias(a_rows)).withColumn("__j", F.lit(1)))
    return reduce(lambda l, r: l.join(r, "__j"), parts).drop("__j")


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT ALL in both directions (NULL-safe, whole rows): one row of counts."""
    cols = a.columns
    b = b.select(*cols)
    x = a.exceptAll(b).agg(F.count(F.lit(1)).alias("missing_rows")).withColumn("__j", F.lit(1))
    y = b.exceptAll(a).agg(F.count(F.lit(1)).alias("extra_rows")).withColumn("__j", F.lit(1))
    return x.join(y, "__j").drop("__j")


def row_diff(before: DataFrame, after: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """Full join on ``key``; rows whose ``cols`` differ null-safely or that exist
    on one side only.  Columns: key, side ('both'/'before'/'after')."""
    cols = cols or [c for c in before.columns]
    a = before.select(F.col(key).alias("__k"), F.struct(*[F.col(c) for c in cols]).alias("__a"))
    b = after.select(F.col(key).alias("__k2"), F.struct(*[F.col(c) for c in cols]).alias("__b"))
    j = a.join(b, a["__k"] == b["__k2"], "full")
    side = (F.when(F.col("__k").isNull(), "after").when(F.col("__k2").isNull(), "before").otherwise("both"))
    return (j.where(~F.col("__a").eqNullSafe(F.col("__b")))
            .select(F.coalesce("__k", "__k2").alias(key), side.alias("side")))


def count_if_bad(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass of ``count_if`` per named rule."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in checks.items()])


def stratified_head(df: DataFrame, stratum: str, order: str, n: int) -> DataFrame:
    """First ``n`` rows of each stratum by ``order`` (a top-k per group)."""
    w = Window.partitionBy(stratum).orderBy(F.col(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def seeded_order(id_col: str, seed: int) -> Column:
    """Deterministic pseudo-random integer order, reproducible in plain SQL."""
    return F.pmod(F.col(id_col) * 7919 + F.lit(seed), F.lit(10007))


def stratified_sample(df: DataFrame, stratum: str, id_col: str, quotas: dict, seed: int = 42) -> DataFrame:
    """Up to ``quotas[stratum value]`` rows per stratum in seeded order.

    One constant-limit top-k per quota, so each keeps ``WindowGroupLimit``
    (k rows per stratum per map task before the shuffle)."""
    order = F.struct(seeded_order(id_col, seed).alias("o"), F.col(id_col).alias("id"))
    parts = [stratified_head(df.where(F.col(stratum) == k).withColumn("__o", order), stratum, "__o", v).drop("__o")
             for k, v in quotas.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def evenly_spaced(df: DataFrame, order: str, k: int, partition: str | None = None) -> DataFrame:
    """``k`` picks at positions ``floor(j * (n - 1) / (k - 1))`` of the sorted
    rows (the integer form of numpy's ``linspace`` indices), per partition
    value if given.  Positions come from the distributed position/rank
    helpers, never from a single-task window."""
    from ..functions.skew import join_group_stats
    from .identity import rank_within, with_position
    if partition is None:
        p = with_position(df, [order], "__i")
        n = p.count()
        picks = sorted({(j * (n - 1)) // (k - 1) for j in range(k)}) if n and k > 1 else ([0] if n else [])
        return p.where(F.col("__i").isin(picks)).drop("__i")
    r = rank_within(df, [partition], [order], "__i")
    sizes = r.groupBy(partition).agg(F.count(F.lit(1)).alias("__n"))
    j = join_group_stats(r, sizes, [partition], "__n", "__i")
    m = F.least(F.lit(k), F.col("__n"))
    hit = F.exists(F.sequence(F.lit(0), m - 1),
                   lambda t: F.when(m > 1, F.floor(t * (F.col("__n") - 1) / (m - 1))).otherwise(0) == F.col("__i"))
    return j.where(hit).drop("__i", "__n")
