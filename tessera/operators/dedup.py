"""Deduplication with a deterministic survivor and an auditable removed map.

Design: a group's decision (survivor, size) comes from a ``groupBy`` on the
real key columns -- never a hash -- so equal keys always meet and NULLs group
together.  Aggregates combine map-side, so a hot group costs one row per map
task in the shuffle.  Where every row needs its group's decision (removed
maps, per-row decisions) the decision is joined back with the salted
:func:`~tessera.functions.skew.join_group_stats`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import category_clean, species_key
from ..functions.skew import DEFAULT_HOT_ROWS, join_group_stats
from ..session import staged


def dedup_groups(df: DataFrame, keys: list[str], order_col: str = "source_row",
                 id_col: str | None = "id", carry: list[str] | None = None) -> DataFrame:
    """One row per distinct key: survivor (smallest ``order_col``), its id,
    group size, copies of the survivor's id, and ``carry`` columns of the
    survivor (as ``retained_<col>``).

    Two aggregation levels (key+id, then key) give the same-id count without
    joining rows back.
    """
    carry = carry or []
    inner_keys = keys + ([id_col] if id_col else [])
    lvl1 = df.groupBy(*inner_keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(order_col).alias("__first"),
        *[F.min_by(c, order_col).alias(f"__c_{c}") for c in carry])
    aggs = [F.sum("__n").alias("duplicate_group_size"),
            F.min("__first").alias("retained_source_row")]
    if id_col:
        aggs += [F.min_by(id_col, "__first").alias("retained_id"),
                 F.min_by("__n", "__first").alias("__same_id_copies")]
    aggs += [F.min_by(f"__c_{c}", "__first").alias(f"retained_{c}") for c in carry]
    g = lvl1.groupBy(*keys).agg(*aggs)
    if id_col:
        g = g.withColumn("retained_id_copies", F.when(F.col("retained_id").isNotNull(),
                                                      F.col("__same_id_copies")).otherwise(F.lit(1)))
        g = g.drop("__same_id_copies")
    return g


def exact_dedup(df: DataFrame, keys: list[str], order_col: str = "source_row", id_col: str = "id",
                group_size_col: str = "duplicate_group_size") -> DataFrame:
    """Survivors: one row per key with all original columns + group size.

    The survivor is rebuilt from the aggregate (its key, id and order value),
    so no join back to the rows is needed.
    """
    g = dedup_groups(df, keys, order_col, id_col)
    out = []
    for c in df.columns:
        if c == id_col:
            out.append(F.col("retained_id").alias(c))
        elif c == order_col:
            out.append(F.col("retained_source_row").alias(c))
        else:
            out.append(F.col(c))
    out.append(F.col("duplicate_group_size").cast("long").alias(group_size_col))
    return g.select(*out)


def removed_map(df: DataFrame, keys: list[str], order_col: str = "source_row", id_col: str = "id",
                hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Every non-survivor row mapped to its survivor.

    Columns: removed_source_row, removed_id, retained_source_row, retained_id,
    same_id (NULL when either id is NULL, like SQL equality).

    Only rows whose keys' 8-byte hash occurs more than once can be in such a
    group, so only they are grouped and joined by the keys themselves; rows
    that share a hash by accident fall out there.  The hashes are written, so
    the planner knows their bytes and broadcasts them if small.
    """
    h = F.xxhash64(*keys)
    hashes = df.groupBy(h.alias("__kh")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__kh")
    rows = df.select(id_col, order_col, *keys).withColumn("__kh", h)
    rows = rows.join(staged(hashes, "repeated-keys"), "__kh", "left_semi").drop("__kh")
    g = (dedup_groups(rows, keys, order_col, id_col)
         .where(F.col("duplicate_group_size") > 1)
         .select(*keys, "retained_source_row", "retained_id", "duplicate_group_size"))
    m = join_group_stats(rows, g, keys, "duplicate_group_size", order_col, hot_rows=hot_rows)
    return (m.where(F.col(order_col) != F.col("retained_source_row"))
            .select(F.col(order_col).alias("removed_source_row"),
                    F.col(id_col).alias("removed_id"),
                    "retained_source_row", "retained_id",
                    (F.col(id_col) == F.col("retained_id")).alias("same_id")))


def dedup_summary(df: DataFrame, keys: list[str], order_col: str = "source_row",
                  id_col: str = "id") -> DataFrame:
    """One row: raw, retained, removed rows; repeated groups; same/different id;
    largest group; removed percent."""
    g = dedup_groups(df, keys, order_col, id_col)
    s = g.agg(F.sum("duplicate_group_size").cast("long").alias("raw_rows"),
              F.count(F.lit(1)).alias("retained_rows"),
              F.count_if(F.col("duplicate_group_size") > 1).alias("repeated_groups"),
              F.max("duplicate_group_size").cast("long").alias("max_group_size"),
              F.sum(F.col("retained_id_copies") - 1).cast("long").alias("removed_same_id"))
    return (s.withColumn("removed_rows", F.col("raw_rows") - F.col("retained_rows"))
            .withColumn("removed_different_id", F.col("removed_rows") - F.col("removed_same_id"))
            .withColumn("removed_percent", F.col("removed_rows") * 100.0 / F.col("raw_rows"))
            .select("raw_rows", "retained_rows", "removed_rows", "repeated_groups",
                    "removed_same_id", "removed_different_id", "max_group_size", "removed_percent"))


# --- category normalisation then dedup -------------------------------------------------

def category_dedup(df: DataFrame, keys: list[str], categories=("sex", "lifestage"),
                   order_col: str = "source_row", id_col: str = "id") -> DataFrame:
    """Normalise NULL/''/'NA' in ``categories`` then dedup on all keys.

    Output keeps the raw values of the survivor as ``<col>_raw`` and the
    cleaned value under the original name, plus
    ``category_duplicate_group_size``.
    """
    cats = [c for c in categories if c in keys]
    norm = df.select(*[category_clean(c).alias(c) if c in cats else F.col(c) for c in df.columns],
                     *[F.col(c).alias(f"{c}_raw") for c in cats])
    g = dedup_groups(norm, keys, order_col, id_col, carry=[f"{c}_raw" for c in cats])
    out = []
    for c in df.columns:
        if c in cats:
            continue
        if c == id_col:
            out.append(F.col("retained_id").alias(c))
        elif c == order_col:
            out.append(F.col("retained_source_row").alias(c))
        else:
            out.append(F.col(c))
    out += [F.col(f"retained_{c}_raw").alias(f"{c}_raw") for c in cats]
    out += [F.col(c) for c in cats]
    out.append(F.col("duplicate_group_size").cast("long").alias("category_duplicate_group_size"))
    return g.select(*out)


def duplicate_groups(df: DataFrame, keys: list[str], order_col: str = "source_row",
                     normalise: dict[str, Column] | None = None) -> DataFrame:
    """Groups with more than one row: survivor and size (HAVING count > 1)."""
    if normalise:
        df = df.select(*[normalise[c].alias(c) if c in normalise else F.col(c) for c in df.columns])
    return (df.groupBy(*keys).agg(F.min(order_col).alias("retained_source_row"),
                                  F.count(F.lit(1)).alias("group_size"))
            .where(F.col("group_size") > 1)
            .select("retained_source_row", "group_size"))


# --- point-key dedup with a priority ----------------------------------------------------

def priority_decisions(keys_df: DataFrame, key_cols: list[str], priority_col: str = "priority",
                       order_col: str = "source_row", species_col: str = "species_key",
                       hot_rows: int = DEFAULT_HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Point-key dedup decisions.

    ``keys_df`` holds (order_col, key columns, priority); the survivor of a
    key is the row with the smallest (priority, order_col).  Returns
    ``(groups, decisions)``: groups = key + group_size + best_priority +
    keep_source_row; decisions = source_row, keep_source_row, group_size,
    species_key, priority, best_priority for every row.
    """
    # Right for any priority and row id; a NULL priority comes last.
    best = F.struct(F.col(priority_col).isNull().alias("n"), F.col(priority_col).alias("p"), F.col(order_col).alias("r"))
    groups = keys_df.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(priority_col).alias("best_priority"),
        F.min(best)["r"].alias("keep_source_row"))
    d = join_group_stats(keys_df, groups, key_cols, "group_size", order_col, hot_rows=hot_rows)
    decisions = d.select(order_col, "keep_source_row", F.col("group_size").cast("long").alias("group_size"),
                         species_col, priority_col, "best_priority")
    return groups, decisions


def species_point_counts(groups: DataFrame, species_col: str = "species_key") -> DataFrame:
    """Per species: unique points (groups) and input records (sum of sizes)."""
    return groups.groupBy(species_col).agg(F.count(F.lit(1)).alias("unique_points"),
                                           F.sum("group_size").cast("long").alias("input_records"))


def species_crossing(counts: DataFrame, n: int = 15) -> DataFrame:
    """Species at or above ``n`` raw records that fall below it after dedup."""
    return counts.where((F.col("input_records") >= n) & (F.col("unique_points") < n))


def prefer_observed(df: DataFrame, flag_col: str = "depth_flag", n: int = 10,
                    key: Column | None = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Observed-priority retention: a species with at least ``n`` observed
    rows (flag = 0) keeps only observed rows; otherwise it keeps all rows."""
    key = key if key is not None else species_key()
    rows = df.withColumn("__species", key).withColumn("__rid", F.monotonically_increasing_id())
    counts = rows.groupBy("__species").agg(F.count(F.lit(1)).alias("__n"),
                                           F.count_if(F.col(flag_col) == 0).alias("__observed"))
    j = join_group_stats(rows, counts, ["__species"], "__n", "__rid", hot_rows=hot_rows)
    keep = (F.col("__observed") < n) | (F.col(flag_col) == 0)
    return j.where(F.coalesce(keep, F.lit(False))).drop("__species", "__rid", "__n", "__observed")
