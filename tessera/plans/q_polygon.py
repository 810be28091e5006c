"""Queries of build step 7: ring checks, point-in-polygon decisions,
species counts, the five-way spatial route and predicate comparison.

Points are the FX1 rows with valid coordinates; polygons are FX5 boxes, alone,
overlapping or sharing part of an edge, and faulty rings.  The oracle tests the
four quarters round a point against the boxes, independent of edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import species_key
from ..operators import classify, polygon
from ..sources import fixtures as fx
from ..sources.fixtures import with_fixtures
from ..session import materialize
from .q_clean import _coord_sql
from .q_funnel import LOST
from .registry import query

FXS = ["fx1", "fx5"]


def poly_points(spark, sf):
    qc = classify.coordinate_qc(fx.load(spark, sf, "fx1")).where(F.col("route") == "accepted")
    return materialize(qc.select("source_row", species_key().alias("species_key"),
                                 F.col("longitude_numeric").alias("lon"), F.col("latitude_numeric").alias("lat")))


_PREPARED: dict[tuple, polygon.Prepared] = {}


def prepared(spark, sf):
    """The polygons, checked and tiled once per session and scale, as the fixtures are."""
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _PREPARED:
        _PREPARED[key] = polygon.prepare(fx.load(spark, sf, "fx5"))
    return _PREPARED[key]


def decisions_plan(spark, sf):
    return polygon.polygon_decide(poly_points(spark, sf), None, prepared=prepared(spark, sf))


POLY_SQL = f"""{_coord_sql('fx1')},
  pts AS (SELECT source_row, lower(trim(scientificname)) AS species_key, longitude_numeric AS lon,
    latitude_numeric AS lat FROM qc WHERE route = 'accepted'),
  rings AS (SELECT species_key, feature, count(*) AS edges, list(struct_pack(a := {{'x': x1, 'y': y1}}, b := {{'x': x2, 'y': y2}}) ORDER BY seq) AS es,
    min(least(x1, x2)) AS xmin, max(greatest(x1, x2)) AS xmax, min(least(y1, y2)) AS ymin, max(greatest(y1, y2)) AS ymax FROM fx5 GROUP BY 1, 2),
  -- a ring is a box if its edges follow each other, each along one axis
  boxes AS (SELECT *, len(list_filter(list_zip(es, list_concat(es[2:], es[:1])), lambda p: p[1].b = p[2].a)) = edges AS chained,
    len(list_filter(es, lambda e: e.a.x <> e.b.x AND e.a.y <> e.b.y)) = 0 AS straight FROM rings),
  poly_species AS (SELECT species_key, if(bool_and(chained AND straight), 'ready', 'invalid_geometry') AS buffer_status FROM boxes GROUP BY 1),
  -- a point is inside the union if boxes cover all four quarters round it, on the union if some closed box holds it
  pf AS (SELECT p.source_row, bool_or(e AND n) AND bool_or(e AND s) AND bool_or(w AND n) AND bool_or(w AND s) AS inside, bool_or((e OR w) AND (n OR s)) AS held
    FROM (SELECT p.source_row, lon >= xmin AND lon < xmax AS e, lon > xmin AND lon <= xmax AS w, lat >= ymin AND lat < ymax AS n, lat > ymin AND lat <= ymax AS s
      FROM pts p JOIN boxes USING (species_key)) p GROUP BY 1),
  decisions AS (SELECT p.source_row, p.species_key, coalesce(s.buffer_status, 'missing_buffer') AS buffer_status,
    coalesce(s.buffer_status = 'ready' AND pf.inside, false) AS buffer_inside,
    coalesce(s.buffer_status = 'ready' AND NOT pf.inside AND pf.held, false) AS buffer_boundary
    FROM pts p LEFT JOIN poly_species s ON p.species_key = s.species_key LEFT JOIN pf ON pf.source_row = p.source_row),
  sp AS (SELECT species_key, count(*) FILTER (WHERE buffer_inside) AS spatial_records FROM decisions GROUP BY 1),
  placed AS (SELECT *, if(buffer_status <> 'ready', 'unknown',
      (['outside', 'boundary', 'inside'])[1 + greatest(2 * buffer_inside::INT, buffer_boundary::INT)]) AS place FROM decisions),
  ways(place, enough, route) AS (VALUES ('inside', true, 'accepted'), ('inside', false, 'below_threshold'),
    ('outside', NULL, 'outside_buffer'), ('boundary', NULL, 'boundary_excluded'), ('unknown', NULL, 'review_missing_buffer')),
  routed AS (SELECT p.* EXCLUDE (place), sp.spatial_records, w.route
    FROM placed p JOIN sp ON p.species_key IS NOT DISTINCT FROM sp.species_key
    JOIN ways w ON w.place = p.place AND coalesce(w.enough = (sp.spatial_records >= 15), true))"""


@query("ring_checks", with_fixtures(["fx5"], """,
  turns AS (SELECT a.species_key, a.feature,
      sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) * sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) AS over_a,
      sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) * sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) AS over_b
    FROM fx5 a JOIN fx5 b ON a.species_key = b.species_key AND a.feature = b.feature AND a.seq < b.seq),
  bad AS (SELECT DISTINCT species_key, feature FROM turns WHERE over_a < 0 AND over_b < 0),
  loose AS (SELECT DISTINCT species_key, feature FROM (
      SELECT species_key, feature, x1 AS x, y1 AS y, 1 AS d FROM fx5 UNION ALL SELECT species_key, feature, x2, y2, -1 FROM fx5) v
    GROUP BY species_key, feature, x, y HAVING sum(d) <> 0),
  rings AS (SELECT species_key, feature, count(*) AS edges, bool_and(isfinite(x1 + y1 + x2 + y2)) AS finite FROM fx5 GROUP BY 1, 2)
SELECT r.species_key, r.feature, r.edges, r.finite, l.species_key IS NULL AS closed, b.species_key IS NULL AS simple,
  r.edges > 2 AND r.finite AND l.species_key IS NULL AND b.species_key IS NULL AS valid
FROM rings r LEFT JOIN loose l USING (species_key, feature) LEFT JOIN bad b USING (species_key, feature)"""))
def ring_checks(spark, sf):
    return polygon.ring_checks(fx.load(spark, sf, "fx5")).drop("turn")


@query("polygon_contains", with_fixtures(FXS, f", {POLY_SQL} SELECT * FROM decisions"))
def polygon_contains(spark, sf):
    return decisions_plan(spark, sf)


@query("polygon_status", with_fixtures(FXS, f"""", {POLY_SQL}
SELECT buffer_status, count(*) AS records, count(DISTINCT species_key) AS species FROM decisions GROUP BY 1""".lstrip('"')))
def polygon_status(spark, sf):
    d = decisions_plan(spark, sf)
    return d.groupBy("buffer_status").agg(F.count(F.lit(1)).alias("records"),
                                          F.count_distinct("species_key").alias("species"))


@query("polygon_species_counts", with_fixtures(FXS, f""", {POLY_SQL}
SELECT species_key, first(buffer_status) AS status, count(*) AS input_rows,
  count(*) FILTER (WHERE buffer_inside) AS inside_rows, count(*) FILTER (WHERE buffer_boundary) AS boundary_rows,
  CASE WHEN first(buffer_status) = 'ready' THEN count(*) FILTER (WHERE NOT buffer_inside AND NOT buffer_boundary) END AS outside_rows,
  first(buffer_status) = 'ready' AND count(*) FILTER (WHERE buffer_inside) >= 15 AS retained_ge15
FROM decisions GROUP BY 1"""))
def polygon_species_counts(spark, sf):
    return polygon.polygon_counts(decisions_plan(spark, sf))


@query("spatial_route", with_fixtures(FXS, f", {POLY_SQL} SELECT source_row, species_key, spatial_records, route FROM routed"))
def spatial_route(spark, sf):
    return polygon.spatial_route(decisions_plan(spark, sf)).select("source_row", "species_key", "spatial_records", "route")


@query("predicate_comparison", with_fixtures(FXS, f""", {POLY_SQL},
  per AS (SELECT species_key, count(*) FILTER (WHERE buffer_inside) AS n_contains,
    count(*) FILTER (WHERE buffer_inside OR buffer_boundary) AS n_intersects,
    count(*) FILTER (WHERE route = 'accepted' AND source_row % {LOST[0]} <> {LOST[1]}) AS actual_rows
    FROM routed WHERE buffer_status = 'ready' GROUP BY 1),
  modes AS (SELECT species_key, 'contains' AS mode, CASE WHEN n_contains >= 15 THEN n_contains ELSE 0 END AS predicted_rows, actual_rows FROM per
    UNION ALL SELECT species_key, 'intersects' AS mode, CASE WHEN n_intersects >= 15 THEN n_intersects ELSE 0 END AS predicted_rows, actual_rows FROM per)
SELECT species_key, mode, predicted_rows, actual_rows, predicted_rows = actual_rows AS counts_equal FROM modes"""))
def predicate_comparison(spark, sf):
    """Counts by either predicate against the stored accepted route, which has lost some rows."""
    from ..operators import route as rt
    from ..session import scratch_path
    path = scratch_path(spark, "spatial_routes")
    routed = polygon.spatial_route(decisions_plan(spark, sf))
    rt.write_routes(routed.select("source_row", "species_key", "buffer_status", "buffer_inside", "buffer_boundary", "route"), path)
    ready = F.col("buffer_status") == "ready"
    per = rt.read_routes(spark, path).where(ready).groupBy("species_key").agg(
        F.count_if("buffer_inside").alias("n_contains"),
        F.count_if(F.col("buffer_inside") | F.col("buffer_boundary")).alias("n_intersects"))
    stored = rt.read_routes(spark, path, ["accepted"]).where(ready & (F.col("source_row") % LOST[0] != LOST[1]))
    stored = stored.groupBy(F.col("species_key").alias("stored_key")).agg(F.count(F.lit(1)).alias("actual_rows"))
    per = per.join(stored, F.col("species_key") == F.col("stored_key"), "left").drop("stored_key")
    per = per.fillna(0, ["actual_rows"])
    out = None
    for mode, c in (("contains", "n_contains"), ("intersects", "n_intersects")):
        m = per.select("species_key", F.lit(mode).alias("mode"),
                       F.when(F.col(c) >= 15, F.col(c)).otherwise(F.lit(0)).cast("long").alias("predicted_rows"),
                       "actual_rows")
        out = m if out is None else out.unionByName(m)
    return out.withColumn("counts_equal", F.col("predicted_rows") == F.col("actual_rows"))
