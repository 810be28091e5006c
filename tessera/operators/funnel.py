"""Stage funnels, stage × species matrices, cascades and list audits.

Per-stage counts are computed once per stage and combined with a union plus
one pivot aggregate (no chain of joins); membership between key lists is a
tagged union grouped by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import species_key, to_double
from .classify import first_loss


def stage_metrics(name: str, df: DataFrame, n: int = 15, lo: int = 1993, hi: int = 2025) -> DataFrame:
    """One row: rows, species, species >= n, rows in those species, year and depth tallies."""
    y, d = to_double("year"), to_double("depth")
    per = df.groupBy(species_key().alias("species_key")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if((y < lo) | (y > hi)).alias("__out"), F.count_if(y.isNull()).alias("__ym"),
        F.count_if(d < 0).alias("__neg"))
    r = F.col("records")
    return per.agg(
        F.sum(r).cast("long").alias("rows"), F.count("species_key").alias("species"),
        F.count_if(F.col("species_key").isNotNull() & (r >= n)).alias("species_ge15"),
        F.coalesce(F.sum(F.when(F.col("species_key").isNotNull() & (r >= n), r)), F.lit(0)).cast("long").alias("rows_in_species_ge15"),
        F.sum("__out").cast("long").alias("year_outside_window"), F.sum("__ym").cast("long").alias("year_missing"),
        F.sum("__neg").cast("long").alias("negative_depth")).select(F.lit(name).alias("stage"), "*")


def funnel(stages: list[tuple[str, DataFrame]], n: int = 15) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [stage_metrics(s, d, n) for s, d in stages])


def stage_counts(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, species_key, records) for every stage, as one union."""
    parts = [d.groupBy(species_key().alias("species_key")).agg(F.count(F.lit(1)).alias("records"))
             .select(F.lit(s).alias("stage"), "species_key", "records") for s, d in stages]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stage_matrix(stages: list[tuple[str, DataFrame]], prefix: str = "n_") -> DataFrame:
    """species_key × stage counts (NULL where a species is absent) via one
    pivot aggregate over the union of per-stage counts."""
    c = stage_counts(stages)
    names = [s for s, _ in stages]
    return c.groupBy("species_key").agg(*[F.sum(F.when(F.col("stage") == s, F.col("records"))).cast("long")
                                          .alias(prefix + s) for s in names])


def stage_matrix_one_pass(raw: DataFrame, survivors: DataFrame, passed: list[tuple[str, Column]], prefix: str = "n_") -> DataFrame:
    """The matrix of raw, dedup and row-wise stages, with one pass over the dedup's ``survivors``:
    ``passed`` says per stage, in order, whether a row passes it."""
    key, one, so_far, counts = species_key().alias("species_key"), F.lit(1), F.lit(True), []
    for name, ok in passed:
        so_far = so_far & F.coalesce(ok, F.lit(False))
        counts.append(F.count_if(so_far).alias(prefix + name))
    first, later = prefix + "raw", [prefix + s for s in ("dedup", *(name for name, _ in passed))]
    base = raw.groupBy(key).agg(F.count(one).alias(first))
    rest = survivors.groupBy(key).agg(F.count(one).alias(later[0]), *counts)
    both = base.unionByName(rest, allowMissingColumns=True).groupBy("species_key").agg(*[F.sum(c).cast("long").alias(c) for c in (first, *later)])
    return both.select("species_key", *[F.nullif(F.col(c), F.lit(0)).cast("long").alias(c) for c in (first, *later)])


def with_first_loss(matrix: DataFrame, stages: list[tuple[str, str]], n: int = 15,
                    never: str = "never_below15") -> DataFrame:
    return matrix.withColumn("first_stage_below15", F.coalesce(first_loss(stages, n), F.lit(never)))


def key_list(df: DataFrame, key: Column | None = None) -> DataFrame:
    key = key if key is not None else species_key()
    return df.select(key.alias("species_key")).where(F.col("species_key").isNotNull()).distinct()


def membership_flags(base: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """Add one boolean per named key list (left semi-style flags through a
    tagged union and one aggregate)."""
    parts = [base.select("species_key", F.lit("__base").alias("__tag"))]
    parts += [l.select("species_key", F.lit(name).alias("__tag")) for name, l in lists.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    g = u.groupBy("species_key").agg(F.bool_or(F.col("__tag") == "__base").alias("__in_base"),
                                     *[F.bool_or(F.col("__tag") == n).alias(n) for n in lists])
    flags = g.where("__in_base").drop("__in_base")
    return base.join(flags, "species_key", "left")


def outer_indicator(left: DataFrame, right: DataFrame, key: str, left_cols: dict[str, str],
                    right_cols: dict[str, str]) -> DataFrame:
    """Full outer merge with a both / left_only / right_only indicator."""
    a = left.select(F.col(key).alias("__ka"), *[F.col(c).alias(a) for c, a in left_cols.items()], F.lit(True).alias("__l"))
    b = right.select(F.col(key).alias("__kb"), *[F.col(c).alias(a) for c, a in right_cols.items()], F.lit(True).alias("__r"))
    j = a.join(b, a["__ka"].eqNullSafe(b["__kb"]), "full")
    ind = (F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), "both")
           .when(F.col("__l").isNotNull(), "left_only").otherwise("right_only"))
    return j.select(F.coalesce("__ka", "__kb").alias(key), *left_cols.values(), *right_cols.values(), ind.alias("indicator"))


def pick_column(df: DataFrame, candidates: list[str]) -> str | None:
    """First present column among ``candidates`` (case-insensitive)."""
    names = {c.lower(): c for c in df.columns}
    return next((names[c.lower()] for c in candidates if c.lower() in names), None)


def optional_col(df: DataFrame, name: str) -> Column:
    c = pick_column(df, [name])
    return F.col(c) if c else F.lit(None).cast("string")


def range_audit(attrs: DataFrame, current: DataFrame) -> DataFrame:
    """Range attribute audit: per species feature counts, features with
    presence and origin in 1..3, marine features and both; joined to the
    current species list with has_range / has_marine_selected_range."""
    name = pick_column(attrs, ["sci_name", "binomial", "scientificname"])
    if name is None:
        raise ValueError("no species name field")
    pres = optional_col(attrs, "presence").try_cast("double")
    orig = optional_col(attrs, "origin").try_cast("double")
    marine = F.lower(F.trim(optional_col(attrs, "marine").cast("string"))).isin("true", "1")
    po = F.coalesce(pres.isin(1.0, 2.0, 3.0) & orig.isin(1.0, 2.0, 3.0), F.lit(False))
    m = F.coalesce(marine, F.lit(False))
    a = attrs.select(F.lower(F.trim(F.coalesce(F.col(name), F.lit("")))).alias("species_key"),
                     po.alias("po"), m.alias("m")).where(F.col("species_key") != "")
    counts = a.groupBy("species_key").agg(
        F.count(F.lit(1)).alias("range_rows"), F.count_if("po").alias("rows_presence_origin_123"),
        F.count_if("m").alias("rows_marine"), F.count_if(F.col("po") & F.col("m")).alias("rows_marine_presence_origin_123"))
    j = current.join(counts, "species_key", "left")
    return j.withColumns({"has_range": F.col("range_rows").isNotNull(),
                          "has_marine_selected_range": F.coalesce(F.col("rows_marine_presence_origin_123"), F.lit(0)) > 0})


def funnel_one_pass(raw: DataFrame, survivors: DataFrame, passes: list[tuple[str, Column]], n: int = 15,
                    raw_name: str = "raw", survivor_name: str = "dedup", lo: int = 1993, hi: int = 2025) -> DataFrame:
    """Stage funnel in one aggregation when the stages are row-wise filters.

    ``passes`` are the later stages in order, each a predicate evaluated on
    the survivor rows (a row reaches stage k when it passes stages 1..k).
    Rows are exploded into the stages they reach, then one aggregate per
    (stage, species) and one per stage give the metrics of :func:`funnel`.
    """
    reach = F.lit(0)
    ok = F.lit(True)
    for _, pred in passes:
        ok = ok & F.coalesce(pred, F.lit(False))
        reach = reach + F.when(ok, 1).otherwise(0)
    names = [raw_name, survivor_name] + [nm for nm, _ in passes]
    y, d = to_double("year"), to_double("depth")
    cols = [species_key().alias("species_key"), ((y < lo) | (y > hi)).alias("__out"), y.isNull().alias("__ym"),
            (d < 0).alias("__neg")]
    a = raw.select(*cols, F.array(F.lit(0)).alias("__stages"))
    b = survivors.select(*cols, F.sequence(F.lit(1), reach + 1).alias("__stages"))
    rows = a.unionByName(b).select("*", F.explode("__stages").alias("__stage")).drop("__stages")
    per = rows.groupBy("__stage", "species_key").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("__out").alias("__o"), F.count_if("__ym").alias("__y"),
        F.count_if("__neg").alias("__n"))
    r = F.col("records")
    ge = F.col("species_key").isNotNull() & (r >= n)
    m = per.groupBy("__stage").agg(
        F.sum(r).cast("long").alias("rows"), F.count("species_key").alias("species"),
        F.count_if(ge).alias("species_ge15"), F.coalesce(F.sum(F.when(ge, r)), F.lit(0)).cast("long").alias("rows_in_species_ge15"),
        F.sum("__o").cast("long").alias("year_outside_window"), F.sum("__y").cast("long").alias("year_missing"),
        F.sum("__n").cast("long").alias("negative_depth"))
    stage = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("__stage") + 1)
    return m.select(stage.alias("stage"), "rows", "species", "species_ge15", "rows_in_species_ge15",
                    "year_outside_window", "year_missing", "negative_depth")
