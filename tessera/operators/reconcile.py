"""Canonical signatures and multiset reconciliation of two dataset versions.

A signature is the *list* of normalised key columns, never a digest: groups
are formed on the real values, so two payloads meet exactly when they are
equal under the rule.  ``sig_label`` gives a compact SHA-256 label for
reports only.

Reconciliation avoids joins: both versions are tagged, unioned and grouped
once by signature, which gives per-signature counts on each side (map-side
combined, so a very common payload costs one row per map task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import EXTENDED_MISSING, SIGNATURE_TEXT_COLUMNS, blank_to_null, is_finite, to_double
from ..functions.skew import DEFAULT_HOT_ROWS, join_group_stats


def _num(c: str) -> Column:
    d = to_double(c)
    return F.when(is_finite(d), d)


def signature_columns(keys: list[str], mode: str = "strict",
                      text_cols=SIGNATURE_TEXT_COLUMNS, prefix: str = "s_") -> list[Column]:
    """Normalised key columns, aliased ``prefix + key``.

    strict:   text -> trim, '' -> NULL, name lowercased; other -> finite double or NULL.
    relaxed:  strict, then literal 'NA' -> NULL (not countryCode); numbers rounded to 9 decimals.
    extended: relaxed with thirteen missing spellings, and a numeric ``behavior``
              kept as a number (a struct of number and text).
    """
    out = []
    for c in keys:
        if c in text_cols:
            e = blank_to_null(c)
            if c == "scientificname":
                e = F.lower(e)
            if mode in ("relaxed", "extended") and c != "countryCode":
                tokens = ["NA"] if mode == "relaxed" else list(EXTENDED_MISSING)
                e = F.when(~e.isin(tokens), e)
            if mode == "extended" and c == "behavior":
                n = _num(F.trim(F.col(c)))
                e = F.struct(n.alias("number"), F.when(n.isNull(), e).alias("text"))
        else:
            e = _num(c)
            if mode in ("relaxed", "extended"):
                e = F.round(e, 9)
        out.append(e.alias(prefix + c))
    return out


def sig_label(keys: list[str], prefix: str = "s_") -> Column:
    """SHA-256 of the JSON of the signature struct (NULL fields kept)."""
    return F.sha2(F.to_json(F.struct(*[F.col(prefix + k).alias(k) for k in keys]),
                            {"ignoreNullFields": "false"}), 256)


def with_signature(df: DataFrame, keys: list[str], mode: str = "strict", prefix: str = "s_") -> DataFrame:
    return df.select("*", *signature_columns(keys, mode, prefix=prefix))


def multiset(df: DataFrame, keys: list[str], mode: str = "strict", by: list[Column] | None = None) -> DataFrame:
    """(signature columns, [by], n) -- rows per distinct payload."""
    sig = signature_columns(keys, mode)
    by = by or []
    return df.groupBy(*sig, *by).agg(F.count(F.lit(1)).alias("n"))


def side_counts(new: DataFrame, old: DataFrame, keys: list[str], mode: str = "strict",
                by: list[Column] | None = None) -> DataFrame:
    """One row per signature (and ``by``) with ``n_new`` and ``n_old``."""
    by = by or []
    sig = signature_columns(keys, mode)
    a = new.select(*sig, *by, F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = old.select(*sig, *by, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    cols = [c for c in a.columns if c not in ("__a", "__b")]
    return (a.unionByName(b).groupBy(*cols)
            .agg(F.sum("__a").cast("long").alias("n_new"), F.sum("__b").cast("long").alias("n_old")))


def reconcile_summary(counts: DataFrame) -> DataFrame:
    """common / new-only / old-only groups and rows, collapsed rows per side."""
    nn, no = F.col("n_new"), F.col("n_old")
    return counts.agg(
        F.count_if((nn > 0) & (no > 0)).alias("common_groups"),
        F.count_if((nn > 0) & (no == 0)).alias("new_only_groups"),
        F.count_if((nn == 0) & (no > 0)).alias("old_only_groups"),
        F.coalesce(F.sum(F.when(no == 0, nn)), F.lit(0)).cast("long").alias("new_only_rows"),
        F.coalesce(F.sum(F.when(nn == 0, no)), F.lit(0)).cast("long").alias("old_only_rows"),
        (F.sum(nn) - F.count_if(nn > 0)).cast("long").alias("new_collapsed_rows"),
        (F.sum(no) - F.count_if(no > 0)).cast("long").alias("old_collapsed_rows"))


def reconcile_by(counts: DataFrame, key: str) -> DataFrame:
    """Per ``key`` (e.g. species): common / new-only / old-only signature groups."""
    nn, no = F.col("n_new"), F.col("n_old")
    return counts.groupBy(key).agg(F.count_if((nn > 0) & (no > 0)).alias("common"),
                                   F.count_if(no == 0).alias("new_only"),
                                   F.count_if(nn == 0).alias("archive_only"))


def count_delta(new: DataFrame, old: DataFrame, key: Column) -> DataFrame:
    """Per key: new_rows, archive_rows, delta (one union + group, no join)."""
    a = new.select(key.alias("species_key"), F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = old.select(key.alias("species_key"), F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    g = a.unionByName(b).groupBy("species_key").agg(F.sum("__a").cast("long").alias("new_rows"),
                                                    F.sum("__b").cast("long").alias("archive_rows"))
    return g.withColumn("delta", F.col("new_rows") - F.col("archive_rows"))


def count_delta_tallies(delta: DataFrame) -> DataFrame:
    n, o = F.col("new_rows"), F.col("archive_rows")
    return delta.agg(F.count_if((n > 0) & (o > 0)).alias("shared_species"),
                     F.count_if((n > 0) & (o == 0)).alias("new_only_species"),
                     F.count_if((n == 0) & (o > 0)).alias("archive_only_species"),
                     F.count_if(n == o).alias("species_equal_counts"),
                     F.count_if(n != o).alias("species_different_counts"),
                     F.sum(n).cast("long").alias("new_rows"), F.sum(o).cast("long").alias("archive_rows"))


def rows_with_side_counts(rows: DataFrame, counts: DataFrame, keys: list[str], row_id: str,
                          size_col: str, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Attach (n_new, n_old) of each row's signature (rows carry ``s_*``)."""
    sig = [f"s_{k}" for k in keys]
    return join_group_stats(rows, counts, sig, size_col, row_id, hot_rows=hot_rows)


def unresolved(rows_sig: DataFrame, counts: DataFrame, keys: list[str], side: str, row_id: str) -> DataFrame:
    """Rows of ``side`` ('new'/'old') whose signature is absent on the other side."""
    own, other = ("n_new", "n_old") if side == "new" else ("n_old", "n_new")
    c = counts.select(*[f"s_{k}" for k in keys], own, other)
    j = rows_with_side_counts(rows_sig, c, keys, row_id, own)
    return j.where(F.col(other) == 0)


def in_duplicate_groups(rows_sig: DataFrame, counts: DataFrame, keys: list[str], side: str,
                        row_id: str) -> DataFrame:
    """Rows of ``side`` whose signature occurs more than once on that side."""
    own = "n_new" if side == "new" else "n_old"
    c = counts.select(*[f"s_{k}" for k in keys], own)
    j = rows_with_side_counts(rows_sig, c, keys, row_id, own)
    return j.where(F.col(own) > 1)


def unresolved_both(new: DataFrame, old: DataFrame, keys: list[str], row_id: str, mode: str = "relaxed",
                    hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(side, row_id, n_new, n_old) for the rows of both versions in one pass:
    both sides are tagged and unioned, per-signature counts come from one
    aggregate, and one salted join attaches them to every row."""
    sig = signature_columns(keys, mode)
    rows = (new.select(F.lit("new").alias("side"), F.col(row_id), *sig)
            .unionByName(old.select(F.lit("old").alias("side"), F.col(row_id), *sig)))
    sig_names = [f"s_{k}" for k in keys]
    counts = rows.groupBy(*sig_names).agg(F.count_if(F.col("side") == "new").alias("n_new"),
                                          F.count_if(F.col("side") == "old").alias("n_old"))
    counts = counts.withColumn("__rows", F.col("n_new") + F.col("n_old"))
    j = join_group_stats(rows, counts, sig_names, "__rows", row_id, hot_rows=hot_rows)
    return j.select("side", row_id, "n_new", "n_old")


# --- per-field differences -------------------------------------------------------------

def field_diffs(new: DataFrame, old: DataFrame, key: str, cols: list[str], tol: float = 1e-9) -> DataFrame:
    """Per matched pair (equal ``key`` on both sides) one row per differing field.

    Values compare as text with NULL read as ''.  When both parse as numbers
    the difference is numeric and within tolerance when both are finite and
    ``|a-b| <= tol``; otherwise within tolerance means equal after trim.
    """
    a = new.select(F.col(key), *[F.coalesce(F.col(c), F.lit("")).alias(f"__n_{c}") for c in cols])
    b = old.select(F.col(key).alias("__k"), *[F.coalesce(F.col(c), F.lit("")).alias(f"__o_{c}") for c in cols])
    j = a.join(b, a[key] == b["__k"])
    arr = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__n_{c}").alias("new_value"),
                             F.col(f"__o_{c}").alias("old_value")) for c in cols])
    e = j.select(key, F.explode(arr).alias("d")).select(key, "d.*")
    e = e.where(F.col("new_value") != F.col("old_value"))
    x, y = to_double("new_value"), to_double("old_value")
    both = x.isNotNull() & y.isNotNull()
    return e.select(key, "field", "new_value", "old_value",
                    F.when(both, F.abs(x - y)).alias("numeric_abs_difference"),
                    F.when(both, is_finite(x) & is_finite(y) & (F.abs(x - y) <= tol))
                    .otherwise(F.trim("new_value") == F.trim("old_value")).alias("within_tolerance"))


# --- group cause attribution -------------------------------------------------------------

def group_causes(df: DataFrame, keys: list[str], group_mode: str = "relaxed", row_id: str = "source_row") -> DataFrame:
    """For each group with more than one row under ``group_mode``: its size,
    the fields whose strict value is not constant in it (';'-joined, key
    order) and the group's smallest ``row_id`` as its name.

    "Not constant" is tested with min/max plus NULL presence, so the
    aggregate needs constant memory per group.
    """
    gcols = signature_columns(keys, group_mode, prefix="g_")
    scols = signature_columns(keys, "strict", prefix="v_")
    r = df.select(F.col(row_id), *gcols, *scols)
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(row_id).alias("group_row")]
    for k in keys:
        v = F.col(f"v_{k}")
        aggs += [F.min(v).alias(f"mn_{k}"), F.max(v).alias(f"mx_{k}"),
                 F.count_if(v.isNull()).alias(f"nl_{k}"), F.count(v).alias(f"nn_{k}")]
    g = r.groupBy(*[f"g_{k}" for k in keys]).agg(*aggs).where(F.col("rows") > 1)
    diff = [F.when((F.col(f"mn_{k}") != F.col(f"mx_{k}")) | ((F.col(f"nl_{k}") > 0) & (F.col(f"nn_{k}") > 0)),
                   F.lit(k)) for k in keys]
    return g.select("group_row", "rows", F.concat_ws(";", *diff).alias("different_fields"))


def collapse_attribution(df: DataFrame, keys: list[str], row_id: str = "source_row") -> DataFrame:
    """Rows collapsed inside relaxed duplicate groups by NA-only, rounding-only
    and combined normalisation (n - distinct keys, summed over groups).

    Each measure is a two-level aggregate (group+key, then group) that yields
    the group size and its distinct-key count together, so no join is needed.
    """
    g = signature_columns(keys, "relaxed", prefix="g_")
    r = df.select(*g, *_na_only(keys, "a_"), *_round_only(keys, "b_"))
    gk = [f"g_{k}" for k in keys]

    def level(prefix):
        inner = r.groupBy(*gk, *[f"{prefix}{k}" for k in keys]).agg(F.count(F.lit(1)).alias("__m"))
        per = inner.groupBy(*gk).agg(F.sum("__m").alias("n"), F.count(F.lit(1)).alias("d"))
        return per.where(F.col("n") > 1)

    na = level("a_").agg(F.count(F.lit(1)).alias("duplicate_groups"),
                         F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("candidate_duplicate_rows"),
                         F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).cast("long").alias("collapsed_na_only"),
                         F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("collapsed_combined"))
    rd = level("b_").agg(F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).cast("long")
                         .alias("collapsed_numeric_round_only"))
    return (na.withColumn("__j", F.lit(1)).join(rd.withColumn("__j", F.lit(1)), "__j")
            .select("duplicate_groups", "candidate_duplicate_rows", "collapsed_na_only",
                    "collapsed_numeric_round_only", "collapsed_combined"))


def _na_only(keys, prefix):
    """NA -> missing (not countryCode), no rounding."""
    out = []
    for k, c in zip(keys, signature_columns(keys, "strict", prefix="__t_")):
        if k in SIGNATURE_TEXT_COLUMNS and k != "countryCode":
            c = F.when(c != "NA", c)
        out.append(c.alias(prefix + k))
    return out


def _round_only(keys, prefix):
    out = []
    for k, c in zip(keys, signature_columns(keys, "strict", prefix="__t_")):
        if k not in SIGNATURE_TEXT_COLUMNS:
            c = F.round(c, 9)
        out.append(c.alias(prefix + k))
    return out


# --- residual pairing ---------------------------------------------------------------------

def unique_partner_pairs(new_rows: DataFrame, old_rows: DataFrame, keys: list[str], row_id: str,
                         mode: str = "extended") -> tuple[DataFrame, DataFrame]:
    """Pair rows of ``new_rows`` with the single row of ``old_rows`` that has
    the same ``mode`` signature.  Returns (pairs: new_row, old_row;
    unmatched new rows: row_id).  Old rows are grouped first; only keys with
    exactly one old row take part, so each new row joins at most one partner.
    """
    a = new_rows.select(F.col(row_id).alias("new_row"), *signature_columns(keys, mode))
    b = old_rows.select(F.col(row_id).alias("__old"), *signature_columns(keys, mode))
    sig = [f"s_{k}" for k in keys]
    ob = b.groupBy(*sig).agg(F.count(F.lit(1)).alias("partners"), F.min("__old").alias("old_row"))
    ob = ob.where(F.col("partners") == 1)
    cond = reduce(lambda x, y: x & y, [a[s].eqNullSafe(ob[s]) for s in sig])
    j = a.join(ob, cond, "left")
    pairs = j.where(F.col("old_row").isNotNull()).select("new_row", "old_row")
    unmatched = j.where(F.col("old_row").isNull()).select(F.col("new_row").alias(row_id))
    return pairs, unmatched
