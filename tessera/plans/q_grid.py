"""Queries of build step 6: raster catalog, nearest layer, grid sampling,
masks, environment route, mode comparison, neighbourhoods, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import species_key
from ..operators import classify, grid, lists, verify
from ..operators.identity import with_position
from ..sources import fixtures as fx
from ..sources.fixtures import with_fixtures
from ..session import materialize, staged
from .q_clean import DEPTH_SQL, YEAR_SQL, _coord_sql
from .registry import query

SPEC = grid.GridSpec()
YEARS = (1995, 2001)
VARS = grid.VARIABLES
_FILE_RE = grid.FILE_PATTERN


def env_points(spark, sf):
    """FX1 rows that pass coordinate, depth and year QC, as sampling points
    (materialised once: every sampling plan reads them several times)."""
    x = classify.coordinate_qc(fx.load(spark, sf, "fx1")).where(F.col("route") == "accepted").drop("route")
    lookup = classify.range_lookup(fx.load(spark, sf, "fx2"))
    x = classify.assign_depth(x, lookup).where(F.col("route") == "accepted").drop("route")
    x = classify.year_qc(x).where(F.col("route") == "accepted")
    return materialize(x.select("source_row", species_key().alias("species_key"), F.col("longitude_numeric").alias("lon"),
                                F.col("latitude_numeric").alias("lat"), "depth_final", "year_final"))


def layered_points(spark, sf, pts=None):
    pts = pts if pts is not None else env_points(spark, sf)
    return grid.assign_layers(pts, fx.load(spark, sf, "fx3"))


_RASTERS: dict[tuple, grid.Rasters] = {}


def rasters(spark, sf):
    """The pixels as tiles, written once per session and scale, as the fixtures are."""
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _RASTERS:
        px = fx.load(spark, sf, "fx4")
        _RASTERS[key] = grid.prepare_rasters(px, grid.with_spec(grid.raster_headers(px), SPEC))
    return _RASTERS[key]


def wide_plan(spark, sf, pts=None, keep=()):
    return grid.sample_tiles(layered_points(spark, sf, pts), rasters(spark, sf), keep=keep)


ENV_SQL = f"""{DEPTH_SQL}, {YEAR_SQL}, {_coord_sql('fx1')},
  env_points AS (SELECT d.source_row, lower(trim(d.scientificname)) AS species_key, c.longitude_numeric AS lon,
    c.latitude_numeric AS lat, d.depth_final, y.year_final FROM depth_result d
    JOIN year_result y ON d.source_row = y.source_row JOIN qc c ON c.source_row = d.source_row
    WHERE d.route = 'accepted' AND y.route = 'accepted' AND c.route = 'accepted'),
  cand AS (SELECT p.source_row, l.layer, abs(p.depth_final - l.phy_depth) AS dp, abs(p.depth_final - l.bgc_depth) AS db
    FROM env_points p CROSS JOIN fx3 l),
  np AS (SELECT source_row, min(dp) AS mdp, min(db) AS mdb FROM cand GROUP BY 1),
  lay AS (SELECT c.source_row, min(c.layer) FILTER (WHERE c.dp = n.mdp) AS phy_layer,
    min(c.layer) FILTER (WHERE c.db = n.mdb) AS bgc_layer FROM cand c JOIN np n ON c.source_row = n.source_row GROUP BY 1),
  pts AS (SELECT p.*, l.phy_layer, l.bgc_layer FROM env_points p JOIN lay l ON p.source_row = l.source_row),
  grids AS (SELECT variable, year, layer, max(col) + 1 AS width, max(row) + 1 AS height FROM fx4 GROUP BY 1, 2, 3),
  largest AS (SELECT variable, max(width) AS width, max(height) AS height FROM grids GROUP BY 1),
  vars(variable, bit) AS (VALUES {', '.join(f"('{v}', {i})" for i, v in enumerate(VARS))})"""


def _sampled_sql(mode, name):
    layer = ("p.phy_layer" if mode == "shared_phy" else
             "CASE WHEN v.variable IN ('thetao', 'so') THEN p.phy_layer ELSE p.bgc_layer END")
    return f"""{name}_pv AS (SELECT p.source_row, p.species_key, p.phy_layer, p.bgc_layer, v.variable, v.bit,
    p.year_final AS year, {layer} AS layer,
    floor((p.lat - ({SPEC.f})) / ({SPEC.e}))::BIGINT AS row, floor((p.lon - ({SPEC.c})) / ({SPEC.a}))::BIGINT AS col
    FROM pts p CROSS JOIN vars v),
  {name}_pv2 AS (SELECT q.*, coalesce(row >= 0 AND row < coalesce(g.height, s.height) AND col >= 0 AND col < coalesce(g.width, s.width), false) AS inside
    FROM {name}_pv q LEFT JOIN grids g ON g.variable = q.variable AND g.year = q.year AND g.layer = q.layer
    LEFT JOIN largest s ON s.variable = q.variable),
  {name} AS (SELECT q.*, CASE WHEN inside THEN x.value ELSE 0.0 END AS value FROM {name}_pv2 q LEFT JOIN fx4 x
    ON x.variable = q.variable AND x.year = q.year AND x.layer = q.layer AND x.row = q.row AND x.col = q.col)"""


WIDE_SQL = f"""{ENV_SQL}, {_sampled_sql('independent', 'sampled')},
  wide AS (SELECT source_row, first(phy_layer) AS phy_layer, first(bgc_layer) AS bgc_layer,
    {', '.join(f"max(value) FILTER (WHERE variable = '{v}') AS {v}" for v in VARS)},
    sum(CASE WHEN NOT inside THEN 1 << bit ELSE 0 END)::INTEGER AS environment_outside_mask,
    sum(CASE WHEN value = -1 OR NOT coalesce(isfinite(value), false) THEN 1 << bit ELSE 0 END)::INTEGER
      AS environment_invalid_mask
    FROM sampled GROUP BY source_row)"""

ALL_FX = ["fx1", "fx2", "fx3", "fx4"]


# --- catalog ----------------------------------------------------------------------------------

CATALOG_SQL = f"""catalog AS (SELECT file_name, folder,
    CASE WHEN regexp_matches(file_name, '{_FILE_RE}') AND regexp_extract(file_name, '{_FILE_RE}', 1) = folder
         THEN true ELSE false END AS recognized FROM fx4_files),
  catalog2 AS (SELECT file_name, folder,
    CASE WHEN recognized THEN regexp_extract(file_name, '{_FILE_RE}', 1) END AS variable,
    CASE WHEN recognized THEN CAST(regexp_extract(file_name, '{_FILE_RE}', 2) AS INTEGER) END AS year,
    CASE WHEN recognized THEN CAST(regexp_extract(file_name, '{_FILE_RE}', 3) AS INTEGER) END AS layer,
    CASE WHEN recognized THEN CAST(regexp_extract(file_name, '{_FILE_RE}', 4) AS DOUBLE) END AS filename_depth,
    recognized FROM catalog)"""


def catalog_plan(spark, sf):
    return grid.raster_catalog(fx.load(spark, sf, "fx4_files"))


@query("raster_catalog", with_fixtures(["fx4_files"], f", {CATALOG_SQL} SELECT * FROM catalog2"))
def raster_catalog(spark, sf):
    return catalog_plan(spark, sf)


@query("missing_grid_keys", with_fixtures(["fx3", "fx4_files"], f""", {CATALOG_SQL},
  exp AS (SELECT f.folder AS variable, y.range::INTEGER AS year, l.layer FROM (SELECT DISTINCT folder FROM fx4_files) f, range({YEARS[0]}, {YEARS[1] + 1}) y, fx3 l)
SELECT * FROM exp e WHERE NOT EXISTS (SELECT 1 FROM catalog2 c WHERE c.recognized AND c.variable = e.variable
  AND c.year = e.year AND c.layer = e.layer)"""))
def missing_grid_keys(spark, sf):
    layers = fx.load(spark, sf, "fx3").agg(F.min("layer"), F.max("layer")).first()
    return grid.missing_grid_keys(catalog_plan(spark, sf), YEARS, tuple(layers))


@query("varying_depths", with_fixtures(["fx4_files"], f""", {CATALOG_SQL}
SELECT variable, layer, count(DISTINCT filename_depth) AS depths FROM catalog2 WHERE recognized
GROUP BY 1, 2 HAVING count(DISTINCT filename_depth) > 1"""))
def varying_depths(spark, sf):
    return grid.varying_depths(catalog_plan(spark, sf))


@query("duplicate_grid_keys", with_fixtures(["fx4_files"], f""", {CATALOG_SQL}
SELECT variable, year, layer, count(*) AS files FROM catalog2 WHERE recognized GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def duplicate_grid_keys(spark, sf):
    """Rasters that several files claim to hold."""
    return grid.duplicate_keys(catalog_plan(spark, sf))


HEAD_SQL = """headers AS (SELECT variable, year, layer, max(col) + 1 AS width, max(row) + 1 AS height,
    count(*) AS cells, count(*) FILTER (WHERE value IS NULL) AS nodata_cells FROM fx4 GROUP BY 1, 2, 3)"""


@query("grid_mismatch", with_fixtures(["fx4"], f""", {HEAD_SQL},
  ref AS (SELECT width, height FROM headers ORDER BY list_position(['thetao', 'so', 'chl', 'no3', 'o2'], variable), year, layer LIMIT 1)
SELECT h.variable, h.year, h.layer, h.width, h.height, (h.width = r.width AND h.height = r.height) AS grid_matches_reference
FROM headers h, ref r"""))
def grid_mismatch(spark, sf):
    return grid.grid_consistency(grid.raster_headers(fx.load(spark, sf, "fx4")))


@query("raster_header_patterns", with_fixtures(["fx4"], f""", {HEAD_SQL}
SELECT width, height, nodata_cells > 0 AS has_nodata, count(*) AS files FROM headers GROUP BY 1, 2, 3"""))
def raster_header_patterns(spark, sf):
    h = grid.raster_headers(fx.load(spark, sf, "fx4"))
    return h.groupBy("width", "height", (F.col("nodata_cells") > 0).alias("has_nodata")).agg(
        F.count(F.lit(1)).alias("files"))


@query("pixel_stats", with_fixtures(["fx4"], """
SELECT variable, year, layer, count(*) FILTER (WHERE value = -1) AS n_minus1, count(*) FILTER (WHERE value = 0) AS n_zero,
  count(*) FILTER (WHERE value < -1) AS n_negative_other, min(value) FILTER (WHERE value <> -1) AS min_except_minus1,
  max(value) FILTER (WHERE value <> -1) AS max_except_minus1 FROM fx4 GROUP BY 1, 2, 3"""))
def pixel_stats(spark, sf):
    return grid.pixel_stats(fx.load(spark, sf, "fx4"))


@query("sentinel_conflicts", with_fixtures(["fx4"], f"""
SELECT year, layer, row, col, CAST({SPEC.c} + (col + 0.5) * {SPEC.a} AS DOUBLE) AS lon,
  CAST({SPEC.f} + (row + 0.5) * ({SPEC.e}) AS DOUBLE) AS lat, so FROM (
  SELECT year, layer, row, col, max(value) FILTER (WHERE variable = 'thetao') AS thetao,
    max(value) FILTER (WHERE variable = 'so') AS so, count(*) FILTER (WHERE variable = 'thetao') AS na,
    count(*) FILTER (WHERE variable = 'so') AS nb FROM fx4 WHERE variable IN ('thetao', 'so') GROUP BY 1, 2, 3, 4) t
WHERE na > 0 AND nb > 0 AND thetao = -1 AND coalesce(so <> -1, true)"""))
def sentinel_conflicts(spark, sf):
    return grid.sentinel_conflicts(fx.load(spark, sf, "fx4"), SPEC)


# --- layers and sampling ------------------------------------------------------------------------

@query("nearest_layer", with_fixtures(ALL_FX, f", {ENV_SQL} SELECT source_row, depth_final, phy_layer, bgc_layer FROM pts"))
def nearest_layer(spark, sf):
    return layered_points(spark, sf).select("source_row", "depth_final", "phy_layer", "bgc_layer")


@query("depth_coverage", with_fixtures(ALL_FX, f""", {ENV_SQL}
SELECT count(*) AS rows, count(*) FILTER (WHERE depth_final > (SELECT max(phy_depth) FROM fx3)) AS below_deepest_environment_rows,
  count(*) FILTER (WHERE depth_final < 0) AS negative_depth_rows, min(depth_final) AS minimum_depth,
  max(depth_final) AS maximum_depth FROM env_points"""))
def depth_coverage(spark, sf):
    pts = env_points(spark, sf)
    deepest = fx.load(spark, sf, "fx3").agg(F.max("phy_depth").alias("deepest"))
    j = pts.join(F.broadcast(deepest), how="inner")
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("depth_final") > F.col("deepest")).alias("below_deepest_environment_rows"),
                 F.count_if(F.col("depth_final") < 0).alias("negative_depth_rows"),
                 F.min("depth_final").alias("minimum_depth"), F.max("depth_final").alias("maximum_depth"))


@query("grid_sample", with_fixtures(ALL_FX, f", {WIDE_SQL} SELECT * FROM wide"))
def grid_sample(spark, sf):
    return wide_plan(spark, sf)


@query("grid_outside", with_fixtures(ALL_FX, f""", {WIDE_SQL}
SELECT source_row, environment_outside_mask, environment_invalid_mask FROM wide WHERE environment_outside_mask <> 0"""))
def grid_outside(spark, sf):
    return wide_plan(spark, sf).where(F.col("environment_outside_mask") != 0).select(
        "source_row", "environment_outside_mask", "environment_invalid_mask")


@query("invalid_mask_counts", with_fixtures(ALL_FX, f""", {WIDE_SQL}
SELECT environment_invalid_mask, count(*) AS records FROM wide GROUP BY 1"""))
def invalid_mask_counts(spark, sf):
    return wide_plan(spark, sf).groupBy("environment_invalid_mask").agg(F.count(F.lit(1)).alias("records"))


@query("sentinel_filter", with_fixtures(ALL_FX, f""", {WIDE_SQL}
SELECT count(*) AS rows, count(DISTINCT source_row) AS distinct_rows,
  count(*) FILTER (WHERE {' OR '.join(f'{v} = -1' for v in VARS)}) AS any_minus1,
  count(*) FILTER (WHERE {' OR '.join(f'{v} = 0' for v in VARS)}) AS any_zero,
  count(*) FILTER (WHERE {' OR '.join(f'{v} IS NULL' for v in VARS)}) AS any_missing FROM wide"""))
def sentinel_filter(spark, sf):
    w = wide_plan(spark, sf)
    any_of = lambda f: F.coalesce(F.greatest(*[F.coalesce(f(F.col(v)), F.lit(False)) for v in VARS]), F.lit(False))
    return w.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("source_row").alias("distinct_rows"),
                  F.count_if(any_of(lambda c: c == -1)).alias("any_minus1"),
                  F.count_if(any_of(lambda c: c == 0)).alias("any_zero"),
                  F.count_if(any_of(lambda c: c.isNull())).alias("any_missing"))


@query("environment_route", with_fixtures(ALL_FX, f""", {WIDE_SQL},
  j AS (SELECT w.source_row, p.species_key, w.environment_invalid_mask FROM wide w JOIN pts p ON w.source_row = p.source_row),
  cnt AS (SELECT species_key, count(*) AS input_records, count(*) FILTER (WHERE environment_invalid_mask = 0) AS valid_records
    FROM j GROUP BY 1)
SELECT j.source_row, j.species_key, c.valid_records AS species_environment_valid_records,
  CASE WHEN j.environment_invalid_mask <> 0 THEN 'environment_excluded'
       WHEN c.valid_records >= 15 THEN 'accepted' ELSE 'below_threshold' END AS route
FROM j JOIN cnt c ON j.species_key IS NOT DISTINCT FROM c.species_key"""))
def environment_route(spark, sf):
    from ..functions.skew import join_group_stats
    from ..operators.route import route
    j = wide_plan(spark, sf, keep=("species_key",)).select("source_row", "environment_invalid_mask", "species_key")
    cnt = j.groupBy("species_key").agg(F.count(F.lit(1)).alias("input_records"),
                                       F.count_if(F.col("environment_invalid_mask") == 0).alias("species_environment_valid_records"))
    r = join_group_stats(j, cnt, ["species_key"], "input_records", "source_row")
    r = route(r, [("environment_excluded", F.col("environment_invalid_mask") != 0),
                  ("accepted", F.col("species_environment_valid_records") >= 15)], default="below_threshold")
    return r.select("source_row", "species_key", "species_environment_valid_records", "route")


# --- two depth conventions ------------------------------------------------------------------------

# The stored values: a third by the shared layer, the others by their own, some with another number.
MODES_SQL = f"""{ENV_SQL}, {_sampled_sql('independent', 'ind')}, {_sampled_sql('shared_phy', 'shr')},
  both_ways AS (SELECT i.source_row, i.variable, s.value AS shared_value, i.value AS independent_value,
    CASE WHEN i.source_row % 31 = 0 THEN i.value + 100 WHEN i.source_row % 3 = 0 THEN s.value ELSE i.value END AS stored
    FROM ind i JOIN shr s ON i.source_row = s.source_row AND i.variable = s.variable),
  detail AS (SELECT *, coalesce(shared_value <> independent_value, false) AS discriminating,
    coalesce(shared_value = stored, false) AS shared_match, coalesce(independent_value = stored, false) AS independent_match FROM both_ways)"""


def modes_plan(spark, sf):
    """Each point's values by both conventions against the values stored earlier."""
    pts = env_points(spark, sf)
    repeated = pts.where(F.col("source_row").isNotNull()).groupBy("source_row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    repeated = staged(repeated.select("source_row"), "repeated-points")
    both = grid.sample_conventions(layered_points(spark, sf, pts), rasters(spark, sf), None if repeated.isEmpty() else repeated)
    row = F.col("source_row")
    stored = (F.when(row % 31 == 0, F.col("independent_value") + 100).when(row % 3 == 0, F.col("shared_value"))
              .otherwise(F.col("independent_value")))
    return grid.convention_matches(both.withColumn("stored", stored))


@query("mode_comparison_detail", with_fixtures(ALL_FX, f", {MODES_SQL} SELECT * FROM detail"))
def mode_comparison_detail(spark, sf):
    return modes_plan(spark, sf)


@query("mode_comparison_summary", with_fixtures(ALL_FX, f""", {MODES_SQL}
SELECT variable, count(*) AS comparisons, count(*) FILTER (WHERE discriminating) AS discriminating,
  count(*) FILTER (WHERE shared_match) AS shared_matches, count(*) FILTER (WHERE independent_match) AS independent_matches,
  count(*) FILTER (WHERE discriminating AND shared_match) AS discriminating_shared_matches,
  count(*) FILTER (WHERE discriminating AND independent_match) AS discriminating_independent_matches
FROM detail GROUP BY 1"""))
def mode_comparison_summary(spark, sf):
    d = modes_plan(spark, sf)
    return d.groupBy("variable").agg(
        F.count(F.lit(1)).alias("comparisons"), F.count_if("discriminating").alias("discriminating"),
        F.count_if("shared_match").alias("shared_matches"), F.count_if("independent_match").alias("independent_matches"),
        F.count_if(F.col("discriminating") & F.col("shared_match")).alias("discriminating_shared_matches"),
        F.count_if(F.col("discriminating") & F.col("independent_match")).alias("discriminating_independent_matches"))


_VLIST = "['thetao', 'so', 'chl', 'no3', 'o2']"
# Integer variable codes throughout: DuckDB's string-dictionary cache is not
# reliable for this many joins on the derived variable names.
NEIGHBOUR_SQL = f""", {ENV_SQL},
  pxi AS (SELECT list_position({_VLIST}, variable) AS vcode, year, layer, row, col, value FROM fx4),
  grids_i AS (SELECT vcode, year, layer, max(col) + 1 AS width, max(row) + 1 AS height FROM pxi GROUP BY 1, 2, 3),
  largest_i AS (SELECT vcode, max(width) AS width, max(height) AS height FROM grids_i GROUP BY 1),
  cells AS (SELECT p.source_row, v.vcode, p.year_final AS year, p.phy_layer, p.bgc_layer,
    floor((p.lat - ({SPEC.f})) / ({SPEC.e}))::BIGINT AS row, floor((p.lon - ({SPEC.c})) / ({SPEC.a}))::BIGINT AS col
    FROM pts p, (SELECT unnest([3, 4, 5]) AS vcode) v),
  stored AS (SELECT c.*, x.value AS stored FROM cells c
    JOIN pxi x ON x.vcode = c.vcode AND x.year = c.year AND x.layer = c.bgc_layer AND x.row = c.row AND x.col = c.col),
  both_layers AS (SELECT source_row, vcode, year, phy_layer AS layer, row, col, stored FROM stored
    UNION ALL SELECT source_row, vcode, year, bgc_layer AS layer, row, col, stored FROM stored),
  lays AS (SELECT b.* FROM both_layers b JOIN largest_i s ON s.vcode = b.vcode
    LEFT JOIN grids_i g ON g.vcode = b.vcode AND g.year = b.year AND g.layer = b.layer
    WHERE row >= 1 AND row <= coalesce(g.height, s.height) - 2 AND col >= 1 AND col <= coalesce(g.width, s.width) - 2),
  offs AS (SELECT a.dr, b.dc FROM (SELECT unnest([-1, 0, 1]) AS dr) a, (SELECT unnest([-1, 0, 1]) AS dc) b)
SELECT DISTINCT w.source_row, {_VLIST}[w.vcode] AS variable, w.layer, o.dr AS drow, o.dc AS dcol
FROM lays w, offs o, pxi x
WHERE x.vcode = w.vcode AND x.year = w.year AND x.layer = w.layer AND x.row = w.row + o.dr AND x.col = w.col + o.dc
  AND x.value = w.stored"""


@query("neighbour_matches", with_fixtures(ALL_FX, NEIGHBOUR_SQL))
def neighbour_matches(spark, sf):
    """Neighbourhood check on both the physical and the independent layer of
    the biogeochemical variables, against the independently sampled value."""
    return grid.neighbour_matches(layered_points(spark, sf), rasters(spark, sf))


# --- samples --------------------------------------------------------------------------------------

SEED = 20261002


@query("stratified_sample", with_fixtures(ALL_FX, f""", {ENV_SQL},
  s AS (SELECT *, phy_layer <> bgc_layer AS different,
    row_number() OVER (PARTITION BY species_key, phy_layer <> bgc_layer
      ORDER BY (source_row * 7919 + {SEED}) % 10007, source_row) AS rn FROM pts)
SELECT source_row, species_key, different FROM s WHERE (different AND rn <= 20) OR (NOT different AND rn <= 3)"""))
def stratified_sample(spark, sf):
    pts = layered_points(spark, sf).withColumn("different", F.col("phy_layer") != F.col("bgc_layer"))
    pts = pts.withColumn("stratum", F.concat_ws("|", F.coalesce("species_key", F.lit("")),
                                                F.col("species_key").isNull().cast("string"),
                                                F.col("different").cast("string")))
    a = verify.stratified_head(pts.where("different").withColumn("__o", F.struct(verify.seeded_order("source_row", SEED).alias("o"), "source_row")),
                               "stratum", "__o", 20)
    b = verify.stratified_head(pts.where(~F.col("different")).withColumn("__o", F.struct(verify.seeded_order("source_row", SEED).alias("o"), "source_row")),
                               "stratum", "__o", 3)
    return a.unionByName(b).select("source_row", "species_key", "different")


@query("evenly_spaced_sample", with_fixtures(ALL_FX, f""", {ENV_SQL},
  sp AS (SELECT species_key, row_number() OVER (ORDER BY species_key) - 1 AS i FROM
         (SELECT DISTINCT species_key FROM env_points WHERE species_key IS NOT NULL) t),
  n AS (SELECT count(*) AS n FROM sp),
  picks AS (SELECT DISTINCT (k * (n.n - 1)) // 23 AS i FROM n, range(24) r(k) WHERE n.n > 0)
SELECT sp.species_key, sp.i AS position FROM sp JOIN picks USING (i)"""))
def evenly_spaced_sample(spark, sf):
    sp = env_points(spark, sf).select("species_key").where(F.col("species_key").isNotNull()).distinct()
    pos = with_position(sp, ["species_key"], "position")
    n = pos.count()
    picks = sorted({(k * (n - 1)) // 23 for k in range(24)}) if n > 0 else []
    return pos.where(F.col("position").isin(picks)).select("species_key", "position")
