"""Lossless n-way routing of rows to named outputs.

A route is a single ``when`` chain written to one ``route`` column, so every
row gets exactly one name in one pass (no scan per output).  NULL predicates
count as false; rows matched by no predicate go to ``default``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import coalesce_false


def route_column(routes: list[tuple[str, Column]], default: str | None = None) -> Column:
    expr = None
    for name, pred in routes:
        cond = coalesce_false(pred)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def route(df: DataFrame, routes: list[tuple[str, Column]], default: str | None = None,
          name: str = "route") -> DataFrame:
    """Append the route name; the first matching predicate wins."""
    return df.withColumn(name, route_column(routes, default))


def route_checks(df: DataFrame, routes: list[tuple[str, Column]]) -> DataFrame:
    """One row of proof counts: rows, rows per route, overlapping, uncovered.

    Routes are meant to be mutually exclusive and complete; ``overlap_rows``
    and ``uncovered_rows`` must both be 0.
    """
    hits = [F.coalesce(p, F.lit(False)).cast("int") for _, p in routes]
    n_hit = reduce(lambda a, b: a + b, hits)
    aggs = [F.count(F.lit(1)).alias("input_rows")]
    aggs += [F.count_if(F.coalesce(p, F.lit(False))).alias(f"{n}_rows") for n, p in routes]
    aggs += [F.count_if(n_hit > 1).alias("overlap_rows"), F.count_if(n_hit == 0).alias("uncovered_rows")]
    return df.agg(*aggs)


def route_counts(df: DataFrame, name: str = "route") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("rows"))


def write_routes(df: DataFrame, path: str, name: str = "route", mode: str = "errorifexists",
                 row_group_bytes: int | None = None, observe: dict[str, Column] | None = None):
    """Write every route to ``path/route=<name>/`` in one job (Parquet, ZSTD).

    ``mode='errorifexists'`` refuses to overwrite earlier results.  With
    ``observe`` (name -> aggregate), the metrics are collected by the write
    job itself through an ``Observation`` (no second pass) and returned as a
    dict.
    """
    obs = None
    if observe:
        from pyspark.sql import Observation
        obs = Observation("route_write")
        df = df.observe(obs, *[agg.alias(k) for k, agg in observe.items()])
    w = df.write.mode(mode).option("compression", "zstd").partitionBy(name)
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    w.parquet(path)
    return obs.get if obs is not None else None


def read_routes(spark, base: str, names: list[str] | None = None, name: str = "route") -> DataFrame:
    """Read routed outputs back; a name list becomes partition pruning."""
    df = spark.read.option("basePath", base).parquet(base)
    if names is not None:
        df = df.where(F.col(name).isin(list(names)))
    return df
