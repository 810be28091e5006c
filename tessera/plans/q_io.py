"""Queries of build step 9: scans, sinks, row identity, inventories,
fingerprints and incremental (streaming) processing.

Round-trip queries write into a fresh folder under the session's shared
checkpoint folder and read the result back, so the returned DataFrame is
what was stored."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import classify, reconcile, route as rt
from ..operators.identity import assign_source_row
from ..session import scratch_path
from ..sources import fixtures as fx, io
from ..sources.csv_rows import read_csv_rows
from ..sources.fixtures import FX1_COLUMNS, with_fixtures
from ..streaming import incremental
from .q_clean import DEPTH_SQL, KEYS, KQ, _coord_sql
from .q_reconcile import sig_names, sig_sql
from .registry import query


def _txt(c, empty_null=False):
    e = f"cast({c} AS VARCHAR)"
    return f"nullif({e}, '') AS {c}" if empty_null else f"coalesce({e}, '') AS {c}"


@query("text_table_scan", with_fixtures(["fx1"], f" SELECT {', '.join(_txt(c) for c in FX1_COLUMNS)} FROM fx1"))
def text_table_scan(spark, sf):
    path = scratch_path(spark, "fx1_csv")
    io.write_csv(fx.load(spark, sf, "fx1"), path)
    return io.read_text_table(spark, path, required=("id",))


@query("archive_scan", with_fixtures(["fx6"], f" SELECT {', '.join(_txt(c, True) for c in FX1_COLUMNS)} FROM fx6"))
def archive_scan(spark, sf):
    path = scratch_path(spark, "fx6_csv")
    io.write_csv(fx.load(spark, sf, "fx6"), path)
    return io.read_text_table(spark, path, empty_as_null=True)


LINE_SCHEMA = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
                            T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                            T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
                            T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
                            T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType())])


@query("typed_scan", f"SELECT {', '.join(f.name for f in LINE_SCHEMA.fields)} FROM lineitem")
def typed_scan(spark, sf):
    path = scratch_path(spark, "lineitem_csv")
    io.write_csv(fx.table(spark, sf, "lineitem").select(*[f.name for f in LINE_SCHEMA.fields]), path)
    return io.read_typed(spark, path, LINE_SCHEMA)


@query("union_by_name", with_fixtures(["fx1"], f""" SELECT {', '.join(
    (f"CASE WHEN source_row % 3 = 1 THEN NULL ELSE nullif(cast(behavior AS VARCHAR), '') END AS behavior"
     if c == 'behavior' else _txt(c, True)) for c in FX1_COLUMNS)} FROM fx1"""))
def union_by_name(spark, sf):
    src = fx.load(spark, sf, "fx1")
    base = scratch_path(spark, "union_csv")
    parts = [(src.where(F.col("source_row") % 3 == 0), FX1_COLUMNS),
             (src.where(F.col("source_row") % 3 == 1), [c for c in FX1_COLUMNS if c != "behavior"]),
             (src.where(F.col("source_row") % 3 == 2), list(reversed(FX1_COLUMNS)))]
    for i, (df, cols) in enumerate(parts):
        io.write_csv(df.select(*cols), f"{base}/file{i}")
    return io.read_union_by_name(spark, f"{base}/*").select(*FX1_COLUMNS)


@query("restore_routes", with_fixtures(["fx1"], f", {_coord_sql('fx1')} SELECT source_row, route FROM qc"))
def restore_routes(spark, sf):
    path = scratch_path(spark, "coordinate_routes")
    rt.write_routes(classify.coordinate_qc(fx.load(spark, sf, "fx1")), path)
    return rt.read_routes(spark, path, ["accepted", "excluded"]).select("source_row", "route")


@query("route_roundtrip", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT route, count(*) AS rows, true AS refused_overwrite FROM depth_result GROUP BY 1"""))
def route_roundtrip(spark, sf):
    from .q_clean import depth_plan
    path = scratch_path(spark, "depth_routes")
    d = depth_plan(spark, sf)
    rt.write_routes(d, path)
    try:
        rt.write_routes(d, path)
        refused = False
    except Exception:  # noqa: BLE001 - the second write must be refused
        refused = True
    back = rt.read_routes(spark, path)
    return back.groupBy("route").agg(F.count(F.lit(1)).alias("rows")).withColumn("refused_overwrite", F.lit(refused))


@query("pruned_range_lookup", with_fixtures(["fx1d"], f""",
  keys AS (SELECT min(source_row) AS source_row FROM fx1d GROUP BY {KQ} HAVING count(*) > 1)
SELECT f.source_row, f.id, f.scientificname, f.source_row % 16 AS bucket FROM fx1d f JOIN keys k ON f.source_row = k.source_row"""))
def pruned_range_lookup(spark, sf):
    """Fetch the records of every duplicate-group survivor from a staging
    table partitioned by bucket.  The wanted set is derived from the data; the
    join on (bucket, source_row) lets dynamic partition pruning skip buckets
    and runtime filters skip row groups, instead of literal ranges."""
    from ..operators import dedup
    path = scratch_path(spark, "staging")
    src = fx.load(spark, sf, "fx1d")
    staged = src.withColumn("bucket", (F.col("source_row") % 16).cast("int"))
    io.write_parquet(staged, path, partition_by=["bucket"], row_group_bytes=1 << 20)
    wanted = (dedup.duplicate_groups(src, KEYS).select(F.col("retained_source_row").alias("source_row"))
              .withColumn("bucket", (F.col("source_row") % 16).cast("int")))
    back = spark.read.parquet(path)
    return back.join(wanted, ["bucket", "source_row"]).select("source_row", "id", "scientificname", "bucket")


@query("row_identity", "SELECT row_number() OVER () AS source_row, o_orderkey FROM orders")
def row_identity(spark, sf):
    return assign_source_row(spark, f"{sf}/orders.parquet").select("source_row", "o_orderkey")


@query("csv_row_identity", """SELECT row_number() OVER (ORDER BY doc_id) AS source_row, doc_id::VARCHAR AS doc_id, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source, sha256(coalesce(text, '')) AS text_sha256 FROM documents""")
def csv_row_identity(spark, sf):
    """Row ids in file order of quoted CSV whose texts go over many lines; every file is read in byte ranges."""
    path = scratch_path(spark, "documents_csv")
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    io.write_csv(docs.orderBy("doc_id"), path)
    rows = read_csv_rows(spark, path, docs.columns)
    return rows.select("source_row", "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("file_inventory")
def file_inventory(spark, sf):
    return io.file_inventory(spark, sf, "*.parquet")


@query("file_fingerprint")
def file_fingerprint(spark, sf):
    return io.file_fingerprints(spark, sf, "*.parquet")


# Files of 64 documents each; a stored listing of some, and a later state of others, in which some texts changed.
FILE_RANGE = 1 << 14
_HEX = "sha256(content[{r} * i + 1 : {r} * (i + 1)])".format(r=FILE_RANGE)
_FILES_SQL = f"""WITH docs AS (SELECT doc_id, doc_id // 64 AS part, coalesce(text, '') AS text FROM documents),
  lines AS (SELECT doc_id, part, false AS later, text FROM docs WHERE part % 7 <> 3
    UNION ALL SELECT doc_id, part, true, CASE WHEN part % 5 = 1 AND doc_id % 64 = 63 THEN text || '.' ELSE text END FROM docs WHERE part % 11 <> 5),
  files AS (SELECT part, later, encode(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS content FROM lines GROUP BY 1, 2),
  pieces AS (SELECT part, later, i, {_HEX} AS digest FROM
    (SELECT *, unnest(range(0, greatest(1, (octet_length(content) + {FILE_RANGE - 1}) // {FILE_RANGE}))) AS i FROM files)),
  digests AS (SELECT part, later, count(*) AS ranges,
    CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS sha256 FROM pieces GROUP BY 1, 2)"""


def _write_text_files(spark, sf, later: bool) -> str:
    """One text file per 64 neighbouring documents, its lines in the order of their ids."""
    docs = fx.table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 64).alias("part"),
                                                   F.coalesce("text", F.lit("")).alias("text"))
    if later:
        text = F.when((F.col("part") % 5 == 1) & (F.col("doc_id") % 64 == 63), F.concat("text", F.lit("."))).otherwise(F.col("text"))
        docs = docs.where(F.col("part") % 11 != 5).withColumn("text", text)
    else:
        docs = docs.where(F.col("part") % 7 != 3)
    path = scratch_path(spark, "text_files")
    (docs.repartition("part").sortWithinPartitions("part", "doc_id").select("part", F.col("text").alias("value"))
     .write.partitionBy("part").text(path))
    return path


def _part_digests(spark, path):
    """Digests by the part in the folder's name; the files' own names differ from write to write."""
    return (io.file_digests(spark, path, "*.txt", FILE_RANGE)
            .withColumn("part", F.regexp_extract("path", r"part=(\d+)/", 1).cast("long")))


@query("file_range_digest", f"{_FILES_SQL} SELECT part, ranges, sha256 FROM digests WHERE later")
def file_range_digest(spark, sf):
    """Digests of files of several byte ranges each."""
    return _part_digests(spark, _write_text_files(spark, sf, later=True)).select("part", "ranges", "sha256")


@query("fingerprint_mismatch", f"""{_FILES_SQL} SELECT part, a.sha256 AS stored_sha256, b.sha256 AS sha256,
  CASE WHEN b.part IS NULL THEN 'missing' WHEN a.part IS NULL THEN 'new' WHEN a.sha256 = b.sha256 THEN 'ok' ELSE 'changed' END AS status
FROM (FROM digests WHERE NOT later) a FULL JOIN (FROM digests WHERE later) b USING (part)""")
def fingerprint_mismatch(spark, sf):
    """A stored listing against the files' later state: every file with its status."""
    listing = scratch_path(spark, "inventory")
    io.write_parquet(_part_digests(spark, _write_text_files(spark, sf, later=False)), listing)
    now = _part_digests(spark, _write_text_files(spark, sf, later=True))
    return io.file_changes(spark.read.parquet(listing), now, "part")


#: Tables and a whole-number column whose bounds their footers state.
FOOTER_COLUMNS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
                  "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id"}


@query("footer_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, min({c})::BIGINT AS smallest, max({c})::BIGINT AS largest FROM {t}"
    for t, c in FOOTER_COLUMNS.items()))
def footer_counts(spark, sf):
    """Rows and key bounds of the tables, from Parquet footers only."""
    parts = [io.footer_stats(spark, f"{sf}/{t}.parquet", [c])
             .select(F.lit(t).alias("table_name"), "rows", F.col(f"min_{c}").cast("long").alias("smallest"), F.col(f"max_{c}").cast("long").alias("largest"))
             for t, c in FOOTER_COLUMNS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("table_fingerprint")
def table_fingerprint(spark, sf):
    out = None
    for t in fx.BASE_TABLES:
        r = io.table_fingerprint(fx.table(spark, sf, t)).select(F.lit(t).alias("table_name"), "rows", "fingerprint")
        out = r if out is None else out.unionByName(r)
    return out


# --- incremental ---------------------------------------------------------------------------

def _event_route(df):
    v = F.col("value")
    return df.select("event_id", "event_type",
                     F.when(v.isNull() | F.isnan(v), "review_missing").when(v < 0, "excluded_negative")
                     .otherwise("accepted").alias("route"))


def _arrivals(spark, sf, run):
    """Drop the events table into a landing folder in four arrivals and run
    ``run`` after the second and the fourth (each file must be seen once)."""
    ev = fx.table(spark, sf, "events")
    landing = scratch_path(spark, "landing")
    for k in range(4):
        ev.where(F.col("event_id") % 4 == k).write.mode("append").parquet(landing)
        if k in (1, 3):
            run(landing, ev.schema)


@query("incremental_route", """SELECT event_id, event_type, CASE WHEN value IS NULL OR isnan(value) THEN 'review_missing'
  WHEN value < 0 THEN 'excluded_negative' ELSE 'accepted' END AS route FROM events""")
def incremental_route(spark, sf):
    out, ck = scratch_path(spark, "incremental_out"), scratch_path(spark, "incremental_ckpt")
    _arrivals(spark, sf, lambda src, schema: incremental.incremental_route(spark, src, schema, out, ck, _event_route))
    return spark.read.parquet(out).select("event_id", "event_type", "route")


@query("incremental_multiset", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def incremental_multiset(spark, sf):
    out, ck = scratch_path(spark, "multiset_out"), scratch_path(spark, "multiset_ckpt")
    _arrivals(spark, sf, lambda src, schema: incremental.incremental_multiset(spark, src, schema, out, ck, ["event_type"]))
    return spark.read.parquet(out)


def _signature_arrivals(spark, sf, run):
    """FX1 in four arrivals, the later ones smaller; ``run`` after the second and the fourth."""
    src = fx.load(spark, sf, "fx1")
    landing = scratch_path(spark, "signature_landing")
    for k in range(4):
        src.where(F.least(F.lit(3), F.floor(F.col("source_row") % 16 / 4)) == k).write.mode("append").parquet(landing)
        if k in (1, 3):
            run(landing, src.schema)


@query("incremental_signatures", with_fixtures(["fx1"], f""" SELECT {', '.join(sig_names('relaxed'))}, count(*) AS n
FROM (SELECT {', '.join(sig_sql('relaxed'))} FROM fx1) t GROUP BY ALL"""))
def incremental_signatures(spark, sf):
    """Signature multiset of arriving parts; each run writes the signatures that it met."""
    out, ck = scratch_path(spark, "signatures_out"), scratch_path(spark, "signatures_ckpt")
    keys = sig_names("relaxed")
    _signature_arrivals(spark, sf, lambda src, schema: incremental.incremental_changes(
        spark, src, schema, out, ck, lambda d: d.select(*reconcile.signature_columns(KEYS, "relaxed")), keys))
    return incremental.current_totals(spark, out, keys)


@query("stage_write_metrics", with_fixtures(["fx1", "fx2"], f""", {DEPTH_SQL}
SELECT count(*) AS input_rows, count(*) FILTER (WHERE route = 'accepted') AS accepted_rows,
  count(*) FILTER (WHERE route = 'review') AS review_rows, count(*) FILTER (WHERE route = 'excluded') AS excluded_rows,
  count(*) FILTER (WHERE beyond_environment_depth) AS beyond_environment_depth_rows,
  count(DISTINCT lower(trim(scientificname))) FILTER (WHERE route = 'accepted') AS accepted_species
FROM depth_result"""))
def stage_write_metrics(spark, sf):
    """Stage summary (one row) observed during the routed write itself."""
    from .q_clean import depth_plan
    path = scratch_path(spark, "depth_stage")
    r = F.col("route")
    metrics = rt.write_routes(depth_plan(spark, sf), path, observe={
        "input_rows": F.count(F.lit(1)),
        "accepted_rows": F.count_if(r == "accepted"),
        "review_rows": F.count_if(r == "review"),
        "excluded_rows": F.count_if(r == "excluded"),
        "beyond_environment_depth_rows": F.count_if("beyond_environment_depth")})
    # Distinct species needs a shuffle, so it is read from what was written.
    species = rt.read_routes(spark, path, ["accepted"]).agg(
        F.count_distinct(F.lower(F.trim("scientificname"))).alias("accepted_species"))
    row = spark.createDataFrame([tuple(metrics[k] for k in ("input_rows", "accepted_rows", "review_rows",
                                                           "excluded_rows", "beyond_environment_depth_rows"))],
                                "input_rows long, accepted_rows long, review_rows long, excluded_rows long, "
                                "beyond_environment_depth_rows long")
    return row.withColumn("__j", F.lit(1)).join(species.withColumn("__j", F.lit(1)), "__j").drop("__j")


@query("report_csv_roundtrip", with_fixtures(["fx1"], """
SELECT lower(trim(scientificname)) AS species_key, count(*) AS records FROM fx1 GROUP BY 1"""))
def report_csv_roundtrip(spark, sf):
    """Ordered CSV report with header (species counts), read back typed."""
    from ..operators import lists
    path = scratch_path(spark, "species_report")
    io.write_report_csv(lists.species_counts(fx.load(spark, sf, "fx1")), path, ["species_key"])
    return io.read_typed(spark, path, T.StructType([T.StructField("species_key", T.StringType()),
                                                    T.StructField("records", T.LongType())]))
