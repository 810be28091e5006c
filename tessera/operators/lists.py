"""Reference lists, membership, group-size thresholds and species reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import species_key, strip, to_double
from ..functions.skew import DEFAULT_HOT_ROWS, join_group_stats
from .route import route


def species_counts(df: DataFrame, threshold: int | None = None, key: Column | None = None) -> DataFrame:
    """(species_key, records[, retained = records >= threshold])."""
    key = key if key is not None else species_key()
    out = df.groupBy(key.alias("species_key")).agg(F.count(F.lit(1)).alias("records"))
    if threshold is not None:
        out = out.withColumn("retained", F.col("records") >= threshold)
    return out


def name_list(df: DataFrame, name_col: str = "sci_name") -> DataFrame:
    """Distinct lower-cased names without white space at either end; empty ones left out."""
    key = F.lower(strip(name_col))
    return df.where(F.col(name_col).isNotNull() & (key != "")).select(key.alias("species_key")).distinct()


def membership_route(df: DataFrame, names: DataFrame, name_col: str = "scientificname") -> DataFrame:
    """Flag rows whose key is in ``names`` and route them accepted/excluded.

    A NULL name never matches (it is excluded, not lost).  Whether the list
    is broadcast is left to the planner and AQE, which know its bytes; a hot
    name above that is a skewed partition, which AQE splits.
    """
    nm = names.select(F.col("species_key").alias("__name"), F.lit(True).alias("matched_iucn"))
    r = df.withColumn("__key", species_key(name_col))
    r = r.join(nm, r["__key"] == nm["__name"], "left").drop("__key", "__name")
    r = r.withColumn("matched_iucn", F.coalesce("matched_iucn", F.lit(False)))
    return route(r, [("accepted", F.col("matched_iucn"))], default="excluded")


def names_without_records(names: DataFrame, accepted: DataFrame, name_col: str = "scientificname") -> DataFrame:
    present = accepted.select(species_key(name_col).alias("species_key")).where(F.col("species_key").isNotNull())
    return names.join(present.distinct(), "species_key", "left_anti")


def species_lost(before: DataFrame, after: DataFrame, name_col: str = "scientificname") -> DataFrame:
    """Species keys of ``before`` with no row left in ``after`` (NULL key never listed)."""
    b = before.select(species_key(name_col).alias("species_key")).where(F.col("species_key").isNotNull()).distinct()
    a = after.select(species_key(name_col).alias("species_key")).where(F.col("species_key").isNotNull()).distinct()
    return b.join(a, "species_key", "left_anti")


def _sheet_good(ranges: DataFrame, name_col="sci_name", up="depth_up", low="depth_low") -> DataFrame:
    return (ranges.select("row_no", species_key(name_col).alias("species_key"),
                          to_double(up).alias("depth_up"), to_double(low).alias("depth_low"))
            .where((F.col("depth_up") >= 0) & (F.col("depth_low") >= 0)))


def lookup_keep_last(ranges: DataFrame, order_col: str = "row_no") -> DataFrame:
    """Usable sheet rows (both endpoints >= 0), last row per name wins."""
    g = _sheet_good(ranges)
    last = g.groupBy("species_key").agg(F.max_by(F.struct("depth_up", "depth_low"), order_col).alias("p"))
    return last.select("species_key", "p.depth_up", "p.depth_low",
                       ((F.col("p.depth_up") + F.col("p.depth_low")) / 2).alias("iucn_mid"))


def duplicate_names(ranges: DataFrame) -> DataFrame:
    """Names with more than one usable row, with distinct endpoint counts."""
    g = _sheet_good(ranges)
    return (g.groupBy("species_key").agg(F.count(F.lit(1)).alias("rows"),
                                         F.count_distinct("depth_up").alias("up_values"),
                                         F.count_distinct("depth_low").alias("low_values"))
            .where(F.col("rows") > 1))


def min_records(df: DataFrame, n: int = 15, key: Column | None = None, row_id: str = "source_row",
                hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Attach ``species_key`` and ``records`` and route accepted (>= n) /
    below_threshold.  Counts come from an aggregate joined back with hot
    species split over several tasks."""
    key = key if key is not None else species_key()
    rows = df.withColumn("species_key", key)
    counts = rows.groupBy("species_key").agg(F.count(F.lit(1)).alias("records"))
    j = join_group_stats(rows, counts, ["species_key"], "records", row_id, hot_rows=hot_rows)
    return route(j, [("accepted", F.col("records") >= n)], default="below_threshold")


def record_count_distribution(counts: DataFrame, col: str = "records") -> DataFrame:
    return counts.groupBy(col).agg(F.count(F.lit(1)).alias("species"))


def threshold_diagnostic(counts: DataFrame, lo: int = 10, hi: int = 15) -> DataFrame:
    r = F.col("records")
    mid = (r >= lo) & (r < hi)
    return counts.agg(F.count_if(r >= lo).alias(f"species_at_least_{lo}"),
                      F.coalesce(F.sum(F.when(r >= lo, r)), F.lit(0)).cast("long").alias(f"rows_at_least_{lo}"),
                      F.count_if(mid).alias(f"species_{lo}_to_{hi - 1}"),
                      F.coalesce(F.sum(F.when(mid, r)), F.lit(0)).cast("long").alias(f"rows_{lo}_to_{hi - 1}"))


def point_key_route(decisions: DataFrame, counts: DataFrame, n: int = 15) -> DataFrame:
    """accepted / below_threshold on unique points per species; duplicates
    routed to duplicate_removed.  ``counts`` has one row per species."""
    c = counts.select("species_key", "unique_points")
    j = decisions.join(c, "species_key")
    r = route(j, [("duplicate_removed", F.col("source_row") != F.col("keep_source_row")),
                  ("accepted", F.col("unique_points") >= n)], default="below_threshold")
    return r.select("source_row", "route")


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_rows")).withColumn(
        "unique_key", F.col("rows") == F.col("distinct_rows"))
