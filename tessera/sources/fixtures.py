"""Derived test inputs (FIXTURES.md, part B) as SQL text.

Each fixture is one SELECT over the driver tables (or over earlier
fixtures) that Spark 4.1 (ANSI) and DuckDB both evaluate to the same rows.
The same text feeds the Spark side (``load``) and the DuckDB oracle
(``with_fixtures``), so both engines start from identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# The 13 columns of the occurrence fixture, in order.
FX1_COLUMNS = ["source_row", "id", "scientificname", "sex", "lifestage", "countryCode",
               "locality", "behavior", "eventDate", "longitude", "latitude", "depth", "year"]

_FX1 = """
SELECT o_orderkey + 1 AS source_row,
  cast(o_orderkey - o_orderkey % 2 as string) AS id,
  case when o_orderkey % 499 = 0 then null when o_orderkey % 3 = 0 then upper(c_name)
       when o_orderkey % 3 = 1 then '  ' || c_name else c_name || ' ' end AS scientificname,
  case o_orderkey % 5 when 0 then 'NA' when 1 then '' when 2 then null when 3 then 'female'
       else 'male' end AS sex,
  case o_orderkey % 4 when 0 then 'NA' when 1 then 'adult' when 2 then '' else null end AS lifestage,
  case when c_nationkey % 7 = 0 then 'NA' else cast(c_nationkey as string) end AS countryCode,
  case o_orderkey % 6 when 0 then 'NA' when 1 then ' bay ' else 'reef' end AS locality,
  case o_orderkey % 8 when 0 then '1' when 1 then '1.0' when 2 then 'n/a' else 'swim' end AS behavior,
  cast(cast(o_orderdate as date) as string) AS eventDate,
  case when o_orderkey % 41 = 0 then null when o_orderkey % 43 = 0 then ' NA '
       when o_orderkey % 47 = 0 then 'abc' when o_orderkey % 53 = 0 then 'inf'
       when o_orderkey % 59 = 0 then '181.5' when o_orderkey % 61 = 0 then '0'
       else cast((o_custkey * 37 + o_orderkey % 7) % 360 - 180 as string) || '.5' end AS longitude,
  case when o_orderkey % 67 = 0 then '' when o_orderkey % 71 = 0 then '-90.5'
       when o_orderkey % 122 = 0 then '0.0'
       else cast((o_custkey * 11 + o_orderkey % 5) % 180 - 90 as string) end AS latitude,
  case o_orderkey % 20 when 0 then null when 1 then 'NaN' when 2 then '' when 3 then '-5'
       when 4 then '12000' when 5 then 'inf' when 6 then 'deep' when 7 then '<NA>'
       else cast((o_orderkey % 2900) * 4 as string) || '.5' end AS depth,
  case o_orderkey % 19 when 0 then null when 1 then '1998.5' when 2 then '1850' when 3 then '2031'
       when 4 then 'nan' when 5 then 'inf' when 6 then '19x8'
       when 7 then cast(year(o_orderdate) as string) || '.0'
       else cast(year(o_orderdate) as string) end AS year
FROM orders JOIN customer ON o_custkey = c_custkey
"""

_FX1D = """
SELECT * FROM fx1
UNION ALL
SELECT source_row + 10000000 AS source_row,
  case when source_row % 20 = 1 then id || 'x' else id end AS id,
  scientificname, sex, lifestage, countryCode, locality, behavior, eventDate,
  longitude, latitude, depth, year
FROM fx1 WHERE source_row % 10 = 1
"""

_FX1C = """
SELECT * FROM fx1d
UNION ALL
SELECT source_row + 30000000 AS source_row, id, scientificname,
  case when sex = 'NA' then '' when sex = '' then null when sex is null then 'NA' else sex end AS sex,
  lifestage, countryCode, locality, behavior, eventDate, longitude, latitude, depth, year
FROM fx1 WHERE source_row % 25 = 1
"""

_FX2_UP = ("case c_custkey % 11 when 0 then null when 1 then '-1' when 2 then '500' "
           "when 3 then 'x' else cast(c_custkey % 40 as string) end")
_FX2_LOW = ("case c_custkey % 13 when 0 then null when 1 then '-9' when 2 then '20000' "
            "else cast(50 + c_custkey % 900 as string) end")
_FX2_NAME = "case c_custkey % 2 when 0 then ' ' || c_name else lower(c_name) end"

_FX2 = f"""
SELECT c_custkey + 1 AS row_no, {_FX2_NAME} AS sci_name, {_FX2_UP} AS depth_up,
  {_FX2_LOW} AS depth_low
FROM customer WHERE c_custkey % 5 <> 4
UNION ALL
SELECT c_custkey + 1 + 1000000 AS row_no, {_FX2_NAME} AS sci_name, {_FX2_UP} AS depth_up,
  case when c_custkey % 34 = 0 then '777' else {_FX2_LOW} end AS depth_low
FROM customer WHERE c_custkey % 5 <> 4 AND c_custkey % 17 = 0
UNION ALL
SELECT s_suppkey + 1 + 2000000 AS row_no, ' ' || s_name AS sci_name, '10' AS depth_up, '200' AS depth_low
FROM supplier WHERE s_suppkey % 3 = 0
"""

# Layers from all parts, 57 neighbouring ones each; their depths are uneven and in no order.
_LAYER = "cast(floor({key} / 57.0) as int) + 1"
_LAYER_DEPTH = "((layer * 1871) % 6007)"

_FX3 = f"""
SELECT layer, cast({_LAYER_DEPTH} as double) AS phy_depth, cast({_LAYER_DEPTH} + (layer % 3) * 8 as double) AS bgc_depth
FROM (SELECT DISTINCT {_LAYER.format(key='p_partkey')} AS layer FROM part) k
"""

# Pixels from all line items: every cell that has some, in each variable.  Every 17th layer lacks
# the last column, so its rasters are narrower.
_FX4_VARIABLES = ("thetao", "so", "chl", "no3", "o2")
_FX4_CELLS = f"""SELECT cast(year(l_shipdate) as int) AS year, {_LAYER.format(key='l_partkey')} AS layer,
    cast(l_suppkey % 8 as int) AS row, cast(l_orderkey % 10 as int) AS col, sum(l_orderkey * 3 + l_linenumber) AS total
  FROM lineitem GROUP BY 1, 2, 3, 4"""
_FX4 = " UNION ALL ".join(f"""
SELECT '{v}' AS variable, year, layer, row, col,
  case when (total + layer) % 97 = 0 then null else cast((total + {i * 11}) % 40 - 1 as double) end AS value
FROM ({_FX4_CELLS}) c WHERE layer % 17 <> 3 OR col < 9""" for i, v in enumerate(_FX4_VARIABLES))

# Raster file names of the catalog operators: one per (variable, year, layer) of FX4 minus the keys
# with (year * 50 + layer) % 61 = 0; some state another depth than the layer's other years, some
# rasters have a second file, and there is one unrecognised name per variable.
_FX4_FILES = f"""
SELECT variable || '_' || cast(year as string) || '_L' || cast(layer as string) || '_'
       || cast(cast({_LAYER_DEPTH} + case when (year * 50 + layer) % 59 = 7 then 1 else 0 end as bigint) as string) || 'm.tif' AS file_name,
       variable AS folder
FROM (SELECT DISTINCT variable, year, layer FROM fx4) k
WHERE (year * 50 + layer) % 61 <> 0
UNION ALL
SELECT variable || '_' || cast(year as string) || '_L' || cast(layer as string) || '_'
       || cast(cast({_LAYER_DEPTH} as bigint) as string) || '.0m.tif' AS file_name, variable AS folder
FROM (SELECT DISTINCT variable, year, layer FROM fx4) k WHERE (year * 50 + layer) % 23 = 5
UNION ALL
SELECT 'notes.tif' AS file_name, variable AS folder FROM (SELECT DISTINCT variable FROM fx4) v
"""

_FX5_X = "(c_custkey * 37) % 360 - 180"
_FX5_Y = "(c_custkey * 11) % 180 - 90"
_FX5_BOX = [((-2, 0), (62, 0)), ((62, 0), (62, 3)), ((62, 3), (-2, 3)), ((-2, 3), (-2, 0))]
_FX5_BOW = [((-2, 0), (62, 3)), ((62, 3), (62, 0)), ((62, 0), (-2, 3)), ((-2, 3), (-2, 0))]


def _fx5_ring(feature: int, ring: list, where: str, dx: int = 0, dy: int = 0) -> list[str]:
    """One SELECT per edge of a ring that lies at the species' corner, moved by (dx, dy)."""
    return [f"""SELECT lower(trim(c_name)) AS species_key, {feature} AS feature, {i} AS seq,
  cast({_FX5_X} + {x1 + dx} as double) AS x1, cast({_FX5_Y} + {y1 + dy} as double) AS y1,
  cast({_FX5_X} + {x2 + dx} as double) AS x2, cast({_FX5_Y} + {y2 + dy} as double) AS y2
FROM customer WHERE {where}""" for i, ((x1, y1), (x2, y2)) in enumerate(ring)]


# Boxes; a second one overlapping the first; a third that shares part of the first's northern edge;
# of the species without a box some have a ring that crosses itself, some one that is open.
_FX5 = "\nUNION ALL\n".join(
    _fx5_ring(1, _FX5_BOX, "c_custkey % 9 <> 0")
    + _fx5_ring(2, _FX5_BOX, "c_custkey % 9 <> 0 AND c_custkey % 4 = 0", dx=40)
    + _fx5_ring(3, _FX5_BOX, "c_custkey % 9 <> 0 AND c_custkey % 4 = 1", dx=22, dy=3)
    + _fx5_ring(1, _FX5_BOW, "c_custkey % 18 = 0")
    + _fx5_ring(1, _FX5_BOX[:3], "c_custkey % 54 = 27"))

_FX6 = """
SELECT source_row, id, upper(scientificname) AS scientificname, sex, lifestage, countryCode,
  case when locality = 'NA' and source_row % 2 = 0 then null else locality end AS locality,
  case when behavior = '1' and source_row % 3 = 0 then '1.0' else behavior end AS behavior, eventDate, longitude, latitude,
  case when source_row % 89 = 0 and depth like '%.5' then depth || '0000000001' else depth end AS depth,
  year
FROM fx1 WHERE source_row % 97 <> 0
UNION ALL
SELECT source_row + 20000000 AS source_row, id, 'ghost ' || id AS scientificname, sex, lifestage,
  countryCode, locality, behavior, eventDate, longitude, latitude, depth, year
FROM fx1 WHERE source_row % 101 = 0
"""

# Range attributes (not in FIXTURES.md part B; derived here the same way):
# one feature per customer, the name in a BINOMIAL column, text-typed
# presence/origin codes and a marine flag in three spellings.
_RANGE_ATTRS = """
SELECT c_name AS BINOMIAL, cast(c_custkey % 5 as string) AS presence,
  cast(c_nationkey % 4 as string) AS origin,
  case c_custkey % 3 when 0 then 'True' when 1 then '1' else 'false' end AS marine,
  'range_' || cast(c_custkey % 3 as string) || '.shp' AS source_file
FROM customer WHERE c_custkey % 7 <> 3
"""

# Skewed occurrence table for the hot-group paths: FX1, plus every FX1 row
# relabelled to one species (40% of all rows), plus 7,500 exact copies of the
# payload of source_row 1 (a 20% duplicate group).
_FX1H = """
SELECT * FROM fx1
UNION ALL
SELECT source_row + 40000000 AS source_row, id, 'Hot Species' AS scientificname, sex, lifestage, countryCode,
  locality, behavior, eventDate, longitude, latitude, depth, year
FROM fx1
UNION ALL
SELECT x.source_row + 50000000 AS source_row, x.id, y.scientificname, y.sex, y.lifestage, y.countryCode,
  y.locality, y.behavior, y.eventDate, y.longitude, y.latitude, y.depth, y.year
FROM fx1 x JOIN (SELECT * FROM fx1 WHERE source_row = 1) y ON x.source_row % 2 = 1
"""

# name -> (sql, dependencies)
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx1": (_FX1, ()),
    "fx1d": (_FX1D, ("fx1",)),
    "fx1c": (_FX1C, ("fx1d",)),
    "fx2": (_FX2, ()),
    "fx3": (_FX3, ()),
    "fx4": (_FX4, ()),
    "fx4_files": (_FX4_FILES, ("fx4",)),
    "fx5": (_FX5, ()),
    "fx6": (_FX6, ("fx1",)),
    "range_attrs": (_RANGE_ATTRS, ()),
    "fx1h": (_FX1H, ("fx1",)),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in FIXTURES[n][1]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(names, body: str) -> str:
    """DuckDB/ANSI text: ``WITH <fixtures> <body>`` for the oracle side."""
    closure = _closure(names)
    b = body.strip()
    if not closure:
        return b if b[:6].upper() == "SELECT" else "WITH " + b
    # Fixtures are computed once per oracle statement; the pixel grid is
    # inlined instead (cheap to recompute, and DuckDB's dictionary cache is
    # unreliable on its materialised string column).
    ctes = ",\n".join(f"{n} AS {'NOT ' if n == 'fx4' else ''}MATERIALIZED ({FIXTURES[n][0]})" for n in closure)
    return f"WITH {ctes}\n{b}"


_REGISTERED: dict[tuple, str] = {}


def _session_key(spark: SparkSession) -> tuple:
    """Identity of a live session (a new context gets a new application id)."""
    return (spark.sparkContext.applicationId, id(spark))


def register_tables(spark: SparkSession, sf_dir: str, tables=BASE_TABLES) -> None:
    """Register the driver tables of ``sf_dir`` as temp views (once per
    session and scale; re-registered when another scale was used since)."""
    for t in tables:
        key = (_session_key(spark), t)
        if _REGISTERED.get(key) != sf_dir:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
            _REGISTERED[key] = sf_dir


# fixture -> parts of its SQL that it mentions several times: Spark writes them first, instead of
# deriving them at each mention.
_PARTS: dict[str, dict[str, str]] = {"fx4": {"fx4_cells": _FX4_CELLS}}

_BUILT: dict[tuple, DataFrame] = {}


def _select(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a fixture; those that come straight from driver tables are dealt."""
    from ..session import staged
    sql, dependencies = FIXTURES[name]
    parts = _PARTS.get(name, {})
    for part, text in parts.items():
        staged(spark.sql(text), f"fixture-{part}").createOrReplaceTempView(part)
        sql = sql.replace(f"({text})", part)
    df = spark.sql(sql)
    return df if dependencies or parts else df.hint("rebalance", *df.columns)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Return fixture ``name`` built from the tables in ``sf_dir``.

    A fixture is built once per session and scale and written, so operators
    see a plain table scan -- as they would a production input -- instead of
    the fixture's CASE expressions.  Rows of the driver tables, which are
    single files, are dealt by their hash into partitions that Spark sizes by
    bytes (a round robin would sort each partition first, the larger the input
    the more); fixtures of fixtures and of written parts are spread already.
    """
    from ..session import staged
    register_tables(spark, sf_dir, ("orders", "customer", "supplier", "part", "lineitem"))
    df = None
    for n in _closure([name]):
        key = (_session_key(spark), sf_dir, n)
        df = _BUILT.get(key)
        if df is None:
            df = staged(_select(spark, n), f"fixture-{n}")
            _BUILT[key] = df
        df.createOrReplaceTempView(n)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
