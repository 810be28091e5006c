"""Queries of build steps 1-3: dedup, coordinate/depth/year QC, lists,
thresholds, point-key dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import species_key, to_double
from ..operators import classify, dedup, lists
from ..operators.route import route
from ..sources import fixtures as fx
from ..sources.fixtures import FX1_COLUMNS, with_fixtures
from .registry import query

KEYS = FX1_COLUMNS[2:]           # every source column except source_row and id
KQ = ", ".join(KEYS)
ALL = ", ".join(FX1_COLUMNS)
SK = "lower(trim(scientificname))"


def tok(tokens):
    return ", ".join(f"'{t}'" for t in tokens)


COORD_TOKENS = tok(("", "na", "n/a", "nan", "null", "none"))
EXT_TOKENS = tok(("", "na", "n/a", "nan", "null", "none", "<na>"))

# --- step 1: exact dedup ---------------------------------------------------------------

# Each group of equal rows is one list of row numbers: its head stays, its tail goes.
_RANKED = f"""alike AS (SELECT list(source_row ORDER BY source_row) AS members FROM fx1d GROUP BY {KQ}),
  ranked AS (
  SELECT f.*, g.retained_source_row, g.duplicate_group_size FROM fx1d f
  JOIN (SELECT members[1] AS retained_source_row, len(members) AS duplicate_group_size, unnest(members) AS source_row
        FROM alike) g ON f.source_row = g.source_row)"""


@query("exact_dedup", with_fixtures(["fx1d"], f""", {_RANKED}
SELECT {ALL}, duplicate_group_size FROM ranked WHERE source_row = retained_source_row"""))
def exact_dedup(spark, sf):
    return dedup.exact_dedup(fx.load(spark, sf, "fx1d"), KEYS)


_REMOVED = """removed AS (
  SELECT gone.source_row AS removed_source_row, gone.id AS removed_id, kept.source_row AS retained_source_row,
         kept.id AS retained_id, gone.id = kept.id AS same_id
  FROM (SELECT members[1] AS head, unnest(members[2:]) AS tail FROM alike) g
  JOIN fx1d gone ON gone.source_row = g.tail JOIN fx1d kept ON kept.source_row = g.head)"""


@query("dedup_removed_map", with_fixtures(["fx1d"], f""", {_RANKED}, {_REMOVED}
SELECT * FROM removed"""))
def dedup_removed_map(spark, sf):
    return dedup.removed_map(fx.load(spark, sf, "fx1d"), KEYS)


@query("dedup_summary", with_fixtures(["fx1d"], f""", {_RANKED}, {_REMOVED},
s AS (SELECT count(*) AS raw_rows,
        count(*) FILTER (WHERE source_row = retained_source_row) AS retained_rows,
        count(*) FILTER (WHERE source_row = retained_source_row AND duplicate_group_size > 1) AS repeated_groups,
        max(duplicate_group_size) AS max_group_size FROM ranked),
m AS (SELECT count(*) FILTER (WHERE same_id) AS removed_same_id FROM removed)
SELECT raw_rows, retained_rows, raw_rows - retained_rows AS removed_rows, repeated_groups,
  removed_same_id, raw_rows - retained_rows - removed_same_id AS removed_different_id,
  max_group_size, CAST(raw_rows - retained_rows AS DOUBLE) * 100 / raw_rows AS removed_percent
FROM s, m"""))
def dedup_summary(spark, sf):
    return dedup.dedup_summary(fx.load(spark, sf, "fx1d"), KEYS)


def graded(name: str, source: str, column: str, tokens: str, unread: str, infinite: str, band: str) -> str:
    """CTE ``name`` (raw, num, grade): the distinct texts of a column, split into disjoint
    sets (blank, no number, no finite number, a number graded by ``band``)."""
    return f"""{name}_texts AS (SELECT DISTINCT {column} AS raw, try_cast({column} AS DOUBLE) AS num,
    coalesce({column}, '') AS said FROM {source}),
  {name}_read AS (SELECT raw, num, lower(trim(said)) IN ({tokens}) AS blank FROM {name}_texts),
  {name} AS (SELECT raw, num, 'missing' AS grade FROM {name}_read WHERE blank
    UNION ALL SELECT raw, num, '{unread}' FROM {name}_read WHERE NOT blank AND num IS NULL
    UNION ALL SELECT raw, num, '{infinite}' FROM {name}_read WHERE NOT blank AND NOT isfinite(num)
    UNION ALL SELECT raw, num, {band} FROM {name}_read WHERE NOT blank AND isfinite(num))"""


def bands(labels: tuple[str, ...], *passed: str) -> str:
    """The label numbered by how many of the conditions hold."""
    steps = " + ".join(f"({c})::INT" for c in passed)
    return f"([{tok(labels)}])[1 + {steps}]"


def _coord_sql(src: str) -> str:
    def axis(name, column, limit):
        return graded(name, src, column, COORD_TOKENS, "invalid_numeric", "invalid_numeric",
                      bands(("valid", "out_of_range"), f"num NOT BETWEEN -{limit} AND {limit}"))
    return f"""{axis('lon_grades', 'longitude', 180)},
  {axis('lat_grades', 'latitude', 90)},
  qc AS (SELECT p.*, x.num AS longitude_numeric, y.num AS latitude_numeric, x.grade AS longitude_qc, y.grade AS latitude_qc,
    pair.zero_pair AS review_zero_zero, if(pair.zero_pair IS NULL, 'excluded', 'accepted') AS route
    FROM {src} p JOIN lon_grades x ON p.longitude IS NOT DISTINCT FROM x.raw
    JOIN lat_grades y ON p.latitude IS NOT DISTINCT FROM y.raw
    LEFT JOIN (SELECT 'valid' AS both_are, unnest([true, false]) AS zero_pair) pair
      ON x.grade = both_are AND y.grade = both_are AND zero_pair = (greatest(abs(x.num), abs(y.num)) = 0))"""


@query("coordinate_qc", with_fixtures(["fx1"], f""", {_coord_sql('fx1')} SELECT * FROM qc"""))
def coordinate_qc(spark, sf):
    return classify.coordinate_qc(fx.load(spark, sf, "fx1"))


@query("coordinate_status_counts", with_fixtures(["fx1"], f""", {_coord_sql('fx1')}
SELECT longitude_qc, latitude_qc, count(*) AS records FROM qc GROUP BY 1, 2"""))
def coordinate_status_counts(spark, sf):
    qc = classify.coordinate_qc(fx.load(spark, sf, "fx1"))
    return classify.status_crosstab(qc, "longitude_qc", "latitude_qc")


SPECIES_COUNTS_SQL = with_fixtures(["fx1d"], f""", {_RANKED},
  kept AS (SELECT {ALL}, duplicate_group_size FROM ranked WHERE source_row = retained_source_row),
  {_coord_sql('kept')}
SELECT {SK} AS species_key, count(*) AS records, count(*) >= 15 AS retained
FROM qc WHERE route = 'accepted' GROUP BY 1""")


def species_counts_plan(spark, sf):
    """Flagship: FX1d -> exact dedup -> coordinate QC -> route -> species counts."""
    kept = dedup.exact_dedup(fx.load(spark, sf, "fx1d"), KEYS)
    qc = classify.coordinate_qc(kept)
    return lists.species_counts(qc.where(F.col("route") == "accepted"), threshold=15)


query("species_counts", SPECIES_COUNTS_SQL)(species_counts_plan)

# --- step 2: depth ---------------------------------------------------------------------


def _num(c):
    return f"CASE WHEN isfinite(try_cast({c} AS DOUBLE)) THEN try_cast({c} AS DOUBLE) END"


LOOKUP_SQL = f"""r2 AS (SELECT lower(trim(sci_name)) AS species_key, {_num('depth_up')} AS up,
    {_num('depth_low')} AS low, row_no FROM fx2 WHERE lower(trim(sci_name)) IS NOT NULL),
  g2 AS (SELECT species_key, count(*) AS iucn_table_rows, min(row_no) AS first_row FROM r2 GROUP BY 1),
  d2 AS (SELECT species_key, count(*) AS n_pairs FROM (SELECT DISTINCT species_key, up, low FROM r2) t GROUP BY 1),
  f2 AS (SELECT g2.species_key, r2.up, r2.low, g2.iucn_table_rows, d2.n_pairs FROM g2
    JOIN r2 ON r2.species_key = g2.species_key AND r2.row_no = g2.first_row
    JOIN d2 ON d2.species_key = g2.species_key),
  s2 AS (SELECT *, CASE WHEN n_pairs > 1 THEN 'conflicting'
      WHEN up IS NULL OR low IS NULL THEN 'missing_endpoint'
      WHEN up < 0 OR low < 0 THEN 'negative_endpoint' WHEN up > low THEN 'reversed'
      WHEN low > 11000 THEN 'excessive_endpoint' ELSE 'valid' END AS iucn_range_status FROM f2),
  lookup AS (SELECT species_key, up AS iucn_depth_up, low AS iucn_depth_low,
    CASE WHEN iucn_range_status = 'valid' THEN (up + low) / 2 END AS iucn_depth_mid,
    iucn_range_status, iucn_table_rows FROM s2)"""


# What follows from the grade of the observed depth and the status of the range ('*': any).
DEPTH_OUTCOMES = (
    [("valid", "*", "ready_observed", "observed", "0", "accepted")]
    + [(g, "*", f"review_{g}_observed", "unresolved", "NULL", "review")
       for g in ("unparseable", "nonfinite", "negative", "excessive")]
    + [("missing", "valid", "ready_iucn_mid", "iucn_mid", "1", "accepted")]
    + [("missing", r, f"review_iucn_{r}", "unresolved", "NULL", "review")
       for r in ("reversed", "conflicting", "excessive_endpoint")]
    + [("missing", r, f"excluded_missing_depth_{r}", "unresolved", "NULL", "excluded")
       for r in ("missing_endpoint", "negative_endpoint", "unmatched_iucn")])
DEPTH_BAND = bands(("negative", "valid", "excessive"), "num >= 0", "num > 11000")


def depth_sql(src: str = "fx1") -> str:
    outcomes = ", ".join(f"('{g}', '{r}', '{q}', '{s}', {f}::INTEGER, '{way}')" for g, r, q, s, f, way in DEPTH_OUTCOMES)
    return f"""{LOOKUP_SQL},
  {graded('depth_grades', src, 'depth', EXT_TOKENS, 'unparseable', 'nonfinite', DEPTH_BAND)},
  outcomes(grade, ranged, qc, taken_from, flag, way) AS (VALUES {outcomes}),
  depth_result AS (SELECT r.*, r.depth AS depth_raw, l.iucn_depth_up, l.iucn_depth_low, l.iucn_depth_mid,
    l.iucn_range_status, l.iucn_table_rows, g.grade AS observed_depth_status, o.qc AS depth_qc_status,
    if(o.taken_from = 'observed', g.num, NULL) AS depth_observed,
    map {{'observed': g.num, 'iucn_mid': l.iucn_depth_mid}}[o.taken_from] AS depth_final,
    o.taken_from AS depth_source, o.flag AS depth_flag,
    coalesce(map {{'observed': g.num, 'iucn_mid': l.iucn_depth_mid}}[o.taken_from] > 5727.9, false) AS beyond_environment_depth,
    o.taken_from = 'observed' AND coalesce(l.iucn_range_status = 'valid' AND g.num NOT BETWEEN l.iucn_depth_up AND l.iucn_depth_low, false)
      AS observed_outside_iucn_range, o.way AS route
    FROM {src} r JOIN depth_grades g ON r.depth IS NOT DISTINCT FROM g.raw
    LEFT JOIN lookup l ON {SK} = l.species_key
    JOIN outcomes o ON o.grade = g.grade AND o.ranged IN ('*', coalesce(l.iucn_range_status, 'unmatched_iucn')))"""


DEPTH_SQL = depth_sql()


def depth_plan(spark, sf):
    lookup = classify.range_lookup(fx.load(spark, sf, "fx2"))
    return classify.assign_depth(fx.load(spark, sf, "fx1"), lookup)


@query("depth_status", with_fixtures(["fx1"], f""", {graded('depth_grades', 'fx1', 'depth', EXT_TOKENS, 'unparseable', 'nonfinite', DEPTH_BAND)}
SELECT source_row, depth, grade AS observed_depth_status FROM fx1 JOIN depth_grades ON depth IS NOT DISTINCT FROM raw"""))
def depth_status(spark, sf):
    return fx.load(spark, sf, "fx1").select("source_row", "depth",
                                            classify.depth_status("depth").alias("observed_depth_status"))


@query("range_lookup_status", with_fixtures(["fx2"], f""", {LOOKUP_SQL} SELECT * FROM lookup"""))
def range_lookup_status(spark, sf):
    return classify.range_lookup(fx.load(spark, sf, "fx2"))


@query("depth_assign", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL} SELECT * FROM depth_result"""))
def depth_assign(spark, sf):
    return depth_plan(spark, sf)


_FLAG_COLS = ("source_row, id, scientificname, depth_raw, depth_final, depth_source, iucn_depth_up, "
              "iucn_depth_low, iucn_range_status, beyond_environment_depth, observed_outside_iucn_range")


@query("depth_flags", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT {_FLAG_COLS} FROM depth_result
WHERE route = 'accepted' AND (beyond_environment_depth OR observed_outside_iucn_range)"""))
def depth_flags(spark, sf):
    d = depth_plan(spark, sf)
    return (d.where((F.col("route") == "accepted")
                    & (F.col("beyond_environment_depth") | F.col("observed_outside_iucn_range")))
            .select(*[c.strip() for c in _FLAG_COLS.split(",")]))


@query("depth_route", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT source_row, depth_qc_status, route FROM depth_result"""))
def depth_route(spark, sf):
    return depth_plan(spark, sf).select("source_row", "depth_qc_status", "route")


@query("depth_status_counts", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT depth_qc_status, coalesce(iucn_range_status, 'unmatched') AS iucn_range_status, count(*) AS records
FROM depth_result GROUP BY 1, 2"""))
def depth_status_counts(spark, sf):
    d = depth_plan(spark, sf)
    return (d.groupBy("depth_qc_status", F.coalesce("iucn_range_status", F.lit("unmatched")).alias("iucn_range_status"))
            .agg(F.count(F.lit(1)).alias("records")))


#: Stored results have another value in the rows of this modulus and remainder.
ALTERED = (109, 4)


def stored_copy(spark, df, name: str, **altered):
    """A written copy of ``df`` with some values altered."""
    from ..session import scratch_path
    path = scratch_path(spark, name)
    here = F.col("source_row") % ALTERED[0] == ALTERED[1]
    df.withColumns({c: F.when(here, v).otherwise(F.col(c)) for c, v in altered.items()}).write.parquet(path)
    return spark.read.parquet(path)


# The rule applied anew to the raw text and the range, compared with what was stored.
@query("depth_formula_check", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL},
  stored AS (SELECT * REPLACE (if(source_row % {ALTERED[0]} = {ALTERED[1]}, coalesce(depth_final, 0) + 0.5, depth_final) AS depth_final) FROM depth_result),
  again AS (SELECT *, if(lower(trim(coalesce(depth_raw, ''))) IN ({EXT_TOKENS}),
      if(iucn_range_status = 'valid', iucn_depth_up + (iucn_depth_low - iucn_depth_up) / 2, NULL),
      if(try_cast(depth_raw AS DOUBLE) BETWEEN 0 AND 11000, try_cast(depth_raw AS DOUBLE), NULL)) AS expected FROM stored)
SELECT count(*) AS checked_rows, (SELECT count(*) FROM again WHERE (depth_final IS NULL) <> (expected IS NULL)
  OR abs(depth_final - expected) > 1e-9) AS failures FROM again"""))
def depth_formula_check(spark, sf):
    d = stored_copy(spark, depth_plan(spark, sf), "depth_result", depth_final=F.coalesce("depth_final", F.lit(0.0)) + 0.5)
    return d.agg(F.count(F.lit(1)).alias("checked_rows"),
                 F.count_if(F.coalesce(classify.depth_formula_failures(d), F.lit(False))).alias("failures"))


@query("species_lost", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT {SK} AS species_key FROM fx1 GROUP BY 1
HAVING {SK} NOT IN (SELECT lower(trim(scientificname)) FROM depth_result
                    WHERE route = 'accepted' AND scientificname IS NOT NULL)"""))
def species_lost(spark, sf):
    d = depth_plan(spark, sf)
    return lists.species_lost(fx.load(spark, sf, "fx1"), d.where(F.col("route") == "accepted"))


# --- step 2: year ----------------------------------------------------------------------

YEAR_BAND = f"if(num <> floor(num), 'fractional', {bands(('before_period', 'ready', 'after_period'), 'num >= 1993', 'num > 2025')})"


def year_sql(src: str = "fx1") -> str:
    return f"""{graded('year_grades', src, 'year', EXT_TOKENS, 'unparseable', 'nonfinite', YEAR_BAND)},
  year_ways(grade, way) AS (VALUES ('ready', 'accepted'), ('before_period', 'earlier')),
  year_result AS (SELECT p.*, p.year AS year_raw, g.grade AS year_qc_status,
    if(w.way = 'accepted', try_cast(g.num AS INTEGER), NULL) AS year_final, coalesce(w.way, 'review') AS route
    FROM {src} p JOIN year_grades g ON p.year IS NOT DISTINCT FROM g.raw LEFT JOIN year_ways w ON w.grade = g.grade)"""


YEAR_SQL = year_sql()


def year_plan(spark, sf):
    return classify.year_qc(fx.load(spark, sf, "fx1"))


@query("year_qc", with_fixtures(["fx1"], f""", {YEAR_SQL}
SELECT source_row, year, year_raw, year_qc_status, year_final, route FROM year_result"""))
def year_qc(spark, sf):
    return year_plan(spark, sf).select("source_row", "year", "year_raw", "year_qc_status", "year_final", "route")


@query("year_route", with_fixtures(["fx1"], f""", {YEAR_SQL}
SELECT route, count(*) AS records, count(DISTINCT {SK}) AS species FROM year_result GROUP BY 1"""))
def year_route(spark, sf):
    return year_plan(spark, sf).groupBy("route").agg(F.count(F.lit(1)).alias("records"),
                                                     F.count_distinct(species_key()).alias("species"))


@query("year_distribution", with_fixtures(["fx1"], f""", {YEAR_SQL}
SELECT year_raw, year_qc_status, count(*) AS records FROM (
  SELECT year_raw, year_qc_status FROM year_result WHERE route = 'accepted'
  UNION ALL SELECT year_raw, year_qc_status FROM year_result WHERE route = 'earlier'
  UNION ALL SELECT year_raw, year_qc_status FROM year_result WHERE route = 'review') u
GROUP BY 1, 2 ORDER BY try_cast(year_raw AS DOUBLE) NULLS LAST, year_raw NULLS LAST"""))
def year_distribution(spark, sf):
    y = year_plan(spark, sf)
    parts = [y.where(F.col("route") == r).select("year_raw", "year_qc_status")
             for r in ("accepted", "earlier", "review")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (u.groupBy("year_raw", "year_qc_status").agg(F.count(F.lit(1)).alias("records"))
            .orderBy(to_double("year_raw").asc_nulls_last(), F.col("year_raw").asc_nulls_last()))


@query("year_formula_check", with_fixtures(["fx1"], f""", {YEAR_SQL},
  whole AS (SELECT unnest(range(1993, 2026)) AS y),
  stored AS (SELECT * REPLACE (if(source_row % {ALTERED[0]} = {ALTERED[1]}, coalesce(year_final, 1900) + 1, year_final) AS year_final) FROM year_result),
  again AS (SELECT r.*, whole.y AS expected FROM stored r LEFT JOIN whole ON try_cast(r.year AS DOUBLE) = whole.y)
SELECT count(*) AS checked_rows, (SELECT count(*) FROM again WHERE year_final IS DISTINCT FROM expected
  OR year_raw IS DISTINCT FROM year) AS failures FROM again"""))
def year_formula_check(spark, sf):
    y = stored_copy(spark, year_plan(spark, sf), "year_result", year_final=F.coalesce("year_final", F.lit(1900)) + 1)
    return y.agg(F.count(F.lit(1)).alias("checked_rows"),
                 F.count_if(F.coalesce(classify.year_formula_failures(), F.lit(False))).alias("failures"))


# --- step 2: zero pair, preconditions ------------------------------------------------------

@query("exclude_zero_pair", with_fixtures(["fx1"], """
SELECT source_row, longitude, latitude,
  CASE WHEN coalesce(try_cast(longitude AS DOUBLE) = 0 AND try_cast(latitude AS DOUBLE) = 0, false)
       THEN 'excluded' ELSE 'accepted' END AS route,
  CASE WHEN coalesce(try_cast(longitude AS DOUBLE) = 0 AND try_cast(latitude AS DOUBLE) = 0, false)
       THEN 'zero_zero_coordinate' END AS exclusion_reason
FROM fx1"""))
def exclude_zero_pair(spark, sf):
    r = route(fx.load(spark, sf, "fx1"), [("excluded", classify.zero_pair())], default="accepted")
    return r.select("source_row", "longitude", "latitude", "route",
                    F.when(F.col("route") == "excluded", F.lit("zero_zero_coordinate")).alias("exclusion_reason"))


# --- step 2: name lists --------------------------------------------------------------------

NAMES_SQL = "names AS (SELECT DISTINCT lower(trim(sci_name)) AS species_key FROM fx2 WHERE sci_name IS NOT NULL AND trim(sci_name) <> '')"
MEMBER_SQL = f"""{NAMES_SQL},
  member AS (SELECT *, coalesce({SK} IN (SELECT species_key FROM names), false) AS matched_iucn FROM fx1)"""


@query("name_list", with_fixtures(["fx2"], f""", {NAMES_SQL} SELECT * FROM names"""))
def name_list(spark, sf):
    return lists.name_list(fx.load(spark, sf, "fx2"), "sci_name")


def membership_plan(spark, sf):
    names = lists.name_list(fx.load(spark, sf, "fx2"), "sci_name")
    return lists.membership_route(fx.load(spark, sf, "fx1"), names)


@query("membership_filter", with_fixtures(["fx1", "fx2"], f""", {MEMBER_SQL}
SELECT source_row, scientificname, CASE WHEN matched_iucn THEN 'accepted' ELSE 'excluded' END AS route FROM member"""))
def membership_filter(spark, sf):
    return membership_plan(spark, sf).select("source_row", "scientificname", "route")


@query("membership_excluded_index", with_fixtures(["fx1", "fx2"], f""", {MEMBER_SQL}
SELECT source_row, id, scientificname, 'not_in_iucn_name_list' AS exclusion_reason FROM member
WHERE NOT matched_iucn"""))
def membership_excluded_index(spark, sf):
    return (membership_plan(spark, sf).where(F.col("route") == "excluded")
            .select("source_row", "id", "scientificname",
                    F.lit("not_in_iucn_name_list").alias("exclusion_reason")))


@query("names_without_records", with_fixtures(["fx1", "fx2"], f""", {MEMBER_SQL}
SELECT species_key FROM names WHERE species_key NOT IN (
  SELECT lower(trim(scientificname)) FROM member WHERE matched_iucn)"""))
def names_without_records(spark, sf):
    names = lists.name_list(fx.load(spark, sf, "fx2"), "sci_name")
    acc = membership_plan(spark, sf).where(F.col("route") == "accepted")
    return lists.names_without_records(names, acc)


GOOD_SQL = """good AS (SELECT row_no, lower(trim(sci_name)) AS species_key,
    try_cast(depth_up AS DOUBLE) AS depth_up, try_cast(depth_low AS DOUBLE) AS depth_low FROM fx2
  WHERE try_cast(depth_up AS DOUBLE) >= 0 AND try_cast(depth_low AS DOUBLE) >= 0)"""


@query("lookup_keep_last", with_fixtures(["fx2"], f""", {GOOD_SQL}
SELECT g.species_key, g.depth_up, g.depth_low, (g.depth_up + g.depth_low) / 2 AS iucn_mid
FROM good g JOIN (SELECT species_key, max(row_no) AS last_row FROM good GROUP BY 1) l
  ON g.species_key = l.species_key AND g.row_no = l.last_row"""))
def lookup_keep_last(spark, sf):
    return lists.lookup_keep_last(fx.load(spark, sf, "fx2"))


@query("duplicate_names", with_fixtures(["fx2"], f""", {GOOD_SQL}
SELECT species_key, count(*) AS rows, count(DISTINCT depth_up) AS up_values,
  count(DISTINCT depth_low) AS low_values FROM good GROUP BY 1 HAVING count(*) > 1"""))
def duplicate_names(spark, sf):
    return lists.duplicate_names(fx.load(spark, sf, "fx2"))


# --- step 3: category dedup ---------------------------------------------------------------

_CAT = {c: f"CASE WHEN {c} IS NULL OR {c} IN ('', 'NA') THEN NULL ELSE {c} END" for c in ("sex", "lifestage")}
_CAT_KEYS = ", ".join(f"{c}_c" if c in _CAT else c for c in KEYS)
CAT_SQL = f"""cn AS (SELECT *, {_CAT['sex']} AS sex_c, {_CAT['lifestage']} AS lifestage_c FROM fx1c),
  cr AS (SELECT *, min(source_row) OVER w AS keep, count(*) OVER w AS sz FROM cn
    WINDOW w AS (PARTITION BY {_CAT_KEYS}))"""
_CAT_OUT = ", ".join(c for c in FX1_COLUMNS if c not in _CAT)


@query("category_dedup", with_fixtures(["fx1c"], f""", {CAT_SQL}
SELECT {_CAT_OUT}, sex AS sex_raw, lifestage AS lifestage_raw, sex_c AS sex, lifestage_c AS lifestage,
  sz AS category_duplicate_group_size FROM cr WHERE source_row = keep"""))
def category_dedup(spark, sf):
    return dedup.category_dedup(fx.load(spark, sf, "fx1c"), KEYS)


@query("duplicate_groups", with_fixtures(["fx1c"], f""", {CAT_SQL}
SELECT keep AS retained_source_row, sz AS group_size FROM cr WHERE source_row = keep AND sz > 1"""))
def duplicate_groups(spark, sf):
    from ..functions.normalize import category_clean
    return dedup.duplicate_groups(fx.load(spark, sf, "fx1c"), KEYS,
                                  normalise={c: category_clean(c) for c in ("sex", "lifestage")})


@query("selection_index_check", with_fixtures(["fx1c"], f""", {CAT_SQL},
  out_rows AS (SELECT source_row FROM cr WHERE source_row = keep),
  removed AS (SELECT source_row FROM cr WHERE source_row <> keep),
  expected AS (SELECT source_row FROM fx1c WHERE source_row NOT IN (SELECT source_row FROM removed))
SELECT (SELECT count(*) FROM (SELECT source_row FROM out_rows EXCEPT SELECT source_row FROM expected) a) AS output_not_expected,
       (SELECT count(*) FROM (SELECT source_row FROM expected EXCEPT SELECT source_row FROM out_rows) b) AS expected_not_output,
       (SELECT count(*) FROM out_rows) AS output_rows"""))
def selection_index_check(spark, sf):
    from ..operators import verify
    src = fx.load(spark, sf, "fx1c")
    kept = dedup.category_dedup(src, KEYS).select("source_row")
    from ..functions.normalize import category_clean
    norm = src.select(*[category_clean(c).alias(c) if c in ("sex", "lifestage") else F.col(c) for c in src.columns])
    removed = dedup.removed_map(norm, KEYS).select(F.col("removed_source_row").alias("source_row"))
    expected = src.select("source_row").join(removed, "source_row", "left_anti")
    return verify.same_keys(kept, expected, "output_not_expected", "expected_not_output", "output_rows")


# --- step 3: point-key dedup (FX7: lineitem) -------------------------------------------

POINT_KEYS = ["species_key", "qty", "disc", "year_key"]
POINT_SQL = """pk AS (SELECT l_orderkey * 10 + l_linenumber AS source_row, l_suppkey AS species_key,
    l_quantity AS qty, l_discount AS disc, year(l_shipdate) AS year_key,
    (l_returnflag IS NOT NULL AND l_returnflag <> 'A')::INTEGER AS priority FROM lineitem),
  decisions AS (SELECT source_row, first_value(source_row) OVER best AS keep_source_row, count(*) OVER point AS group_size,
    species_key, priority, first_value(priority) OVER best AS best_priority FROM pk
    WINDOW point AS (PARTITION BY species_key, qty, disc, year_key),
      best AS (PARTITION BY species_key, qty, disc, year_key ORDER BY priority, source_row)),
  sc AS (SELECT species_key, count(DISTINCT keep_source_row) AS unique_points, count(*) AS input_records
    FROM decisions GROUP BY 1)"""


def point_keys(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_row"),
                     F.col("l_suppkey").alias("species_key"), F.col("l_quantity").alias("qty"),
                     F.col("l_discount").alias("disc"), F.year("l_shipdate").alias("year_key"),
                     F.when(F.col("l_returnflag") != "A", F.lit(1)).otherwise(F.lit(0)).alias("priority"))


def point_plan(spark, sf):
    return dedup.priority_decisions(point_keys(spark, sf), POINT_KEYS)


@query("point_key_dedup", with_fixtures([], f"{POINT_SQL} SELECT * FROM decisions"))
def point_key_dedup(spark, sf):
    return point_plan(spark, sf)[1]


@query("point_key_route", with_fixtures([], f"""{POINT_SQL}
SELECT d.source_row, CASE WHEN d.source_row <> d.keep_source_row THEN 'duplicate_removed'
  WHEN s.unique_points >= 15 THEN 'accepted' ELSE 'below_threshold' END AS route
FROM decisions d JOIN sc s ON d.species_key = s.species_key"""))
def point_key_route(spark, sf):
    groups, decisions = point_plan(spark, sf)
    counts = dedup.species_point_counts(groups)
    return lists.point_key_route(decisions, counts, 15)


@query("point_key_priority_check", with_fixtures([], f"""{POINT_SQL}
SELECT count(*) AS decisions, count(DISTINCT source_row) AS distinct_rows,
  count(*) FILTER (WHERE (source_row = keep_source_row OR source_row % 7 = 3) AND priority <> best_priority) AS violations
FROM decisions"""))
def point_key_priority_check(spark, sf):
    """The stored decisions, in which some rows keep themselves."""
    from ..session import scratch_path
    _, d = point_plan(spark, sf)
    path = scratch_path(spark, "point_decisions")
    own = F.when(F.col("source_row") % 7 == 3, F.col("source_row")).otherwise(F.col("keep_source_row"))
    d.withColumn("keep_source_row", own).write.parquet(path)
    d = spark.read.parquet(path)
    return d.agg(F.count(F.lit(1)).alias("decisions"), F.count_distinct("source_row").alias("distinct_rows"),
                 F.count_if((F.col("source_row") == F.col("keep_source_row"))
                            & (F.col("priority") != F.col("best_priority"))).alias("violations"))


@query("key_uniqueness", with_fixtures([], f"""{POINT_SQL}
SELECT count(*) AS rows, count(DISTINCT source_row) AS distinct_rows,
  count(*) = count(DISTINCT source_row) AS unique_key FROM pk"""))
def key_uniqueness(spark, sf):
    k = point_keys(spark, sf)
    return lists.key_uniqueness(k, "source_row")


@query("key_preconditions", with_fixtures([], f"""{POINT_SQL}
SELECT count(*) AS rows, count(*) - coalesce(sum((len(known) = 6 AND priority * (priority - 1) = 0)::INT), 0)::BIGINT AS bad_rows
FROM (SELECT priority, list_filter([source_row::DOUBLE, species_key::DOUBLE, qty::DOUBLE, disc::DOUBLE, year_key::DOUBLE, priority::DOUBLE],
    lambda v: v IS NOT NULL AND isfinite(v)) AS known FROM pk) t"""))
def key_preconditions(spark, sf):
    from ..functions.normalize import is_finite
    k = point_keys(spark, sf)
    bad = (F.col("source_row").isNull() | F.col("species_key").isNull() | F.col("qty").isNull()
           | F.col("disc").isNull() | F.col("year_key").isNull() | F.col("priority").isNull()
           | ~F.col("priority").isin(0, 1) | ~is_finite("qty") | ~is_finite("disc"))
    return k.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(bad, F.lit(True))).alias("bad_rows"))


# Parts as species, on a coarse grid of points: many records, fewer points.
@query("species_crossing_threshold", with_fixtures([], """points AS (
  SELECT l_partkey AS species_key, count(*) AS k FROM lineitem
  GROUP BY l_partkey, l_quantity > 25, l_linenumber > 3, year(l_shipdate))
SELECT species_key, count(*) AS unique_points, sum(k)::BIGINT AS input_records FROM points
GROUP BY species_key HAVING count(*) < 15 AND sum(k) > 14"""))
def species_crossing_threshold(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    keys = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_row"), F.col("l_partkey").alias("species_key"),
                     (F.col("l_quantity") > 25).cast("int").alias("qty"), (F.col("l_linenumber") > 3).cast("int").alias("disc"),
                     F.year("l_shipdate").alias("year_key"), F.lit(0).alias("priority"))
    groups, _ = dedup.priority_decisions(keys, POINT_KEYS)
    return dedup.species_crossing(dedup.species_point_counts(groups), 15)


# --- step 3: observed priority and minimum records -------------------------------------------

@query("observed_priority", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL},
  acc AS (SELECT source_row, scientificname, depth_flag FROM depth_result WHERE route = 'accepted'),
  w AS (SELECT *, count(*) FILTER (WHERE depth_flag = 0) OVER (PARTITION BY {SK}) AS observed FROM acc)
SELECT source_row, depth_flag FROM w WHERE observed < 10 OR depth_flag = 0"""))
def observed_priority(spark, sf):
    acc = depth_plan(spark, sf).where(F.col("route") == "accepted").select("source_row", "scientificname",
                                                                          "depth_flag")
    return dedup.prefer_observed(acc, "depth_flag", 10).select("source_row", "depth_flag")


MINREC_SQL = f"""mr AS (SELECT source_row, {SK} AS species_key, count(*) OVER (PARTITION BY {SK}) AS records FROM fx1),
  msc AS (SELECT {SK} AS species_key, count(*) AS records FROM fx1 GROUP BY 1)"""


def minrec_plan(spark, sf):
    return lists.min_records(fx.load(spark, sf, "fx1"), 15)


@query("min_records_route", with_fixtures(["fx1"], f""", {MINREC_SQL}
SELECT source_row, species_key, CASE WHEN records >= 15 THEN 'accepted' ELSE 'below_threshold' END AS route FROM mr"""))
def min_records_route(spark, sf):
    return minrec_plan(spark, sf).select("source_row", "species_key", "route")


@query("record_count_distribution", with_fixtures(["fx1"], f""", {MINREC_SQL}
SELECT records, count(*) AS species FROM msc GROUP BY 1"""))
def record_count_distribution(spark, sf):
    return lists.record_count_distribution(lists.species_counts(fx.load(spark, sf, "fx1")))


@query("threshold_diagnostic", with_fixtures(["fx1"], f""", {MINREC_SQL}
SELECT coalesce(sum(k), 0)::BIGINT AS species_at_least_10, coalesce(sum(k * records), 0)::BIGINT AS rows_at_least_10,
  coalesce(sum(if(records < 15, k, 0)), 0)::BIGINT AS species_10_to_14,
  coalesce(sum(if(records < 15, k * records, 0)), 0)::BIGINT AS rows_10_to_14
FROM (SELECT records, count(*) AS k FROM msc GROUP BY records HAVING records > 9) t"""))
def threshold_diagnostic(spark, sf):
    return lists.threshold_diagnostic(lists.species_counts(fx.load(spark, sf, "fx1")))


# --- skewed inputs: the hot-group split engaged on table-derived data ---------------

SKEW_HOT_ROWS = 1000   # small so that the fixture's hot groups are split


@query("skewed_min_records_route", with_fixtures(["fx1h"], f"""
SELECT source_row, {SK} AS species_key, count(*) OVER (PARTITION BY {SK}) AS records,
  CASE WHEN count(*) OVER (PARTITION BY {SK}) >= 15 THEN 'accepted' ELSE 'below_threshold' END AS route
FROM fx1h"""))
def skewed_min_records_route(spark, sf):
    """Minimum-records route where one species holds 40% of the rows; with
    ``hot_rows=1000`` that species is split over many join tasks."""
    r = lists.min_records(fx.load(spark, sf, "fx1h"), 15, hot_rows=SKEW_HOT_ROWS)
    return r.select("source_row", "species_key", "records", "route")


@query("skewed_removed_map", with_fixtures(["fx1h"], f""",
  rk AS (SELECT *, min(source_row) OVER (PARTITION BY {KQ}) AS retained_source_row FROM fx1h)
SELECT r.source_row AS removed_source_row, r.id AS removed_id, r.retained_source_row, k.id AS retained_id,
  (r.id = k.id) AS same_id
FROM rk r JOIN rk k ON r.retained_source_row = k.source_row WHERE r.source_row <> r.retained_source_row"""))
def skewed_removed_map(spark, sf):
    """Removed map where one duplicate group holds 20% of the rows (split)."""
    return dedup.removed_map(fx.load(spark, sf, "fx1h"), KEYS, hot_rows=SKEW_HOT_ROWS)
