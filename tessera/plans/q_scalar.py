"""Scalar function queries: text, numbers, digests, regex,
bit masks and JSON, each over a fixture so the functions run on whole
tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalize import blank_to_null, is_finite, to_double, truthy
from ..operators import grid, reconcile as rc
from ..sources import fixtures as fx
from ..sources.fixtures import with_fixtures
from .q_clean import KEYS
from .q_reconcile import sig_sql
from .registry import query


@query("scalar_text", with_fixtures(["fx1"], """
SELECT source_row, lower(scientificname) AS name_lower, trim(locality) AS locality_trim,
  nullif(trim(locality), '') AS locality_clean, coalesce(sex, 'unknown') AS sex_filled,
  'review_' || depth || '_observed' AS status_text, starts_with(eventDate, '199') AS nineties,
  replace(eventDate, '-', '/') AS date_slashes, lower(trim(behavior)) IN ('true', '1') AS behavior_truthy,
  concat_ws(';', CASE WHEN scientificname IS NULL THEN 'scientificname' END, CASE WHEN sex IS NULL THEN 'sex' END,
    CASE WHEN lifestage IS NULL THEN 'lifestage' END) AS missing_fields
FROM fx1"""))
def scalar_text(spark, sf):
    d = fx.load(spark, sf, "fx1")
    miss = F.concat_ws(";", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("scientificname", "sex", "lifestage")])
    return d.select("source_row", F.lower("scientificname").alias("name_lower"), F.trim("locality").alias("locality_trim"),
                    blank_to_null("locality").alias("locality_clean"),
                    F.coalesce("sex", F.lit("unknown")).alias("sex_filled"),
                    F.concat(F.lit("review_"), F.col("depth"), F.lit("_observed")).alias("status_text"),
                    F.col("eventDate").startswith("199").alias("nineties"),
                    F.replace(F.col("eventDate"), F.lit("-"), F.lit("/")).alias("date_slashes"),
                    truthy("behavior").alias("behavior_truthy"), miss.alias("missing_fields"))


_D = "try_cast(longitude AS DOUBLE)"
_L = "try_cast(latitude AS DOUBLE)"
_Z = "try_cast(depth AS DOUBLE)"
_Y = "try_cast(year AS DOUBLE)"


@query("scalar_number", with_fixtures(["fx1"], f"""
SELECT source_row, {_D} AS lon, isfinite({_D}) AS lon_finite, abs({_D}) AS lon_abs,
  CASE WHEN isfinite({_D}) THEN CAST(floor({_D}) AS DOUBLE) END AS lon_floor, round({_Z}, 9) AS depth_round9,
  CASE WHEN isfinite({_Y}) AND {_Y} = floor({_Y}) THEN CAST({_Y} AS BIGINT) END AS year_integral,
  isfinite({_D}) AND isfinite({_L}) AND abs({_D} - {_L}) <= 1e-9 AS lon_lat_close,
  ({_D} + {_L}) / 2 AS midpoint,
  CASE WHEN isfinite({_Y}) AND {_Y} = floor({_Y}) THEN CAST({_Y} AS BIGINT) * 100 + source_row % 50 + 1 END AS year_layer_key,
  CASE WHEN isfinite({_Y}) AND {_Y} = floor({_Y}) THEN (CAST({_Y} AS BIGINT) * 100 + source_row % 50 + 1) // 100 END AS key_year,
  CASE WHEN isfinite({_Y}) AND {_Y} = floor({_Y}) THEN (CAST({_Y} AS BIGINT) * 100 + source_row % 50 + 1) % 100 END AS key_layer,
  ((source_row % 5) * 99) // 4 AS linspace_index
FROM fx1"""))
def scalar_number(spark, sf):
    d = fx.load(spark, sf, "fx1")
    lon, lat, z, y = to_double("longitude"), to_double("latitude"), to_double("depth"), to_double("year")
    yi = F.when(is_finite(y) & (y == F.floor(y)), y.cast("long"))
    key = yi * 100 + F.col("source_row") % 50 + 1
    return d.select("source_row", lon.alias("lon"), is_finite(lon).alias("lon_finite"), F.abs(lon).alias("lon_abs"),
                    F.when(is_finite(lon), F.floor(lon).cast("double")).alias("lon_floor"), F.round(z, 9).alias("depth_round9"),
                    yi.alias("year_integral"),
                    (is_finite(lon) & is_finite(lat) & (F.abs(lon - lat) <= 1e-9)).alias("lon_lat_close"),
                    ((lon + lat) / 2).alias("midpoint"), key.alias("year_layer_key"),
                    F.floor(key / 100).cast("long").alias("key_year"), (key % 100).alias("key_layer"),
                    F.floor((F.col("source_row") % 5) * 99 / 4).cast("long").alias("linspace_index"))


@query("scalar_digest", with_fixtures(["fx1d"], f"""
SELECT count(*) AS rows, count(DISTINCT sha256(to_json(struct_pack({', '.join(s.rsplit(' AS ', 1)[1] + ' := ' + s.rsplit(' AS ', 1)[0] for s in sig_sql('strict'))})))) AS distinct_digests,
  (SELECT count(*) FROM (SELECT DISTINCT {', '.join(sig_sql('strict'))} FROM fx1d) t) AS distinct_payloads,
  0 AS buckets_out_of_range FROM fx1d"""))
def scalar_digest(spark, sf):
    d = fx.load(spark, sf, "fx1d").select(*rc.signature_columns(KEYS, "strict"))
    label = rc.sig_label(KEYS)
    bucket = F.pmod(F.xxhash64(*[F.col(f"s_{k}") for k in KEYS]), F.lit(64))
    a = d.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(label).alias("distinct_digests"),
              F.count_if((bucket < 0) | (bucket >= 64)).alias("buckets_out_of_range"))
    b = d.distinct().agg(F.count(F.lit(1)).alias("distinct_payloads"))
    return a.withColumn("__j", F.lit(1)).join(b.withColumn("__j", F.lit(1)), "__j").select(
        "rows", "distinct_digests", "distinct_payloads", "buckets_out_of_range")


@query("scalar_regex", with_fixtures(["fx4_files"], f"""
SELECT file_name, regexp_matches(file_name, '{grid.FILE_PATTERN}') AS full_match,
  regexp_extract(file_name, '{grid.FILE_PATTERN}', 1) AS g_variable, regexp_extract(file_name, '{grid.FILE_PATTERN}', 2) AS g_year,
  regexp_extract(file_name, '{grid.FILE_PATTERN}', 3) AS g_layer, regexp_extract(file_name, '{grid.FILE_PATTERN}', 4) AS g_depth
FROM fx4_files"""))
def scalar_regex(spark, sf):
    f = fx.load(spark, sf, "fx4_files")
    p = grid.FILE_PATTERN
    return f.select("file_name", F.col("file_name").rlike(p).alias("full_match"),
                    *[F.regexp_extract("file_name", p, i).alias(n)
                      for i, n in enumerate(["g_variable", "g_year", "g_layer", "g_depth"], start=1)])


@query("scalar_bits", with_fixtures(["fx4"], """
SELECT year, layer, row, col, mask, bit_count(mask) AS bits_set, (mask & 1) <> 0 AS thetao_bad FROM (
  SELECT year, layer, row, col, bit_or(CASE WHEN value = -1 OR value IS NULL
    THEN 1 << (list_position(['thetao', 'so', 'chl', 'no3', 'o2'], variable) - 1) ELSE 0 END)::INTEGER AS mask
  FROM fx4 GROUP BY 1, 2, 3, 4) t"""))
def scalar_bits(spark, sf):
    p = fx.load(spark, sf, "fx4")
    bit = F.when((F.col("value") == -1) | F.col("value").isNull(), F.expr(
        "shiftleft(1, array_position(array('thetao','so','chl','no3','o2'), variable) - 1)")).otherwise(0)
    g = p.groupBy("year", "layer", "row", "col").agg(F.bit_or(bit.cast("int")).alias("mask"))
    return g.select("year", "layer", "row", "col", "mask", F.bit_count("mask").cast("long").alias("bits_set"),
                    (F.col("mask").bitwiseAND(F.lit(1)) != 0).alias("thetao_bad"))


@query("scalar_json", with_fixtures(["fx4"], """
SELECT j, json_extract_string(j, '$.variable') AS variable, CAST(json_extract(j, '$.year') AS INTEGER) AS year, CAST(json_extract(j, '$.layer') AS INTEGER) AS layer,
  CAST(json_extract(j, '$.row') AS INTEGER) AS row, CAST(json_extract(j, '$.col') AS INTEGER) AS col,
  CAST(json_extract(j, '$.value') AS DOUBLE) AS value FROM (
  SELECT to_json(struct_pack(variable := variable, year := year, layer := layer, row := row, col := col, value := value)) AS j
  FROM fx4) t"""))
def scalar_json(spark, sf):
    p = fx.load(spark, sf, "fx4")
    j = F.to_json(F.struct("variable", "year", "layer", "row", "col", "value"), {"ignoreNullFields": "false"})
    schema = "variable STRING, year INT, layer INT, row INT, col INT, value DOUBLE"
    return p.select(j.alias("j")).select("j", F.from_json("j", schema).alias("s")).select(
        "j", "s.variable", "s.year", "s.layer", "s.row", "s.col", "s.value")
