"""Plan properties the design relies on, and exactly-once incremental runs."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.functions.skew import join_group_stats
from tessera.operators import verify

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_table_is_broadcast_and_rows_are_split(spark):
    rows = spark.range(0, 2000).select((F.col("id") % 3 == 0).cast("string").alias("k"), F.col("id").alias("rid"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    j = join_group_stats(rows, groups, ["k"], "n", "rid", hot_rows=100)
    assert "BroadcastExchange" in _plan(j)
    assert j.count() == 2000
    assert sorted((r.k, r.n) for r in j.select("k", "n").distinct().collect()) == [("false", 1333), ("true", 667)]


def test_top_k_sample_limits_before_shuffle(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("g"), F.col("id"))
    p = _plan(verify.stratified_head(df, "g", "id", 3))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_point_keys_scan_prunes_columns(spark):
    df = E.queries()["point_key_dedup"](spark, SMALL)
    p = _plan(df)
    scans = [l for l in p.split("\n") if "FileScan parquet" in l]
    assert scans and all("l_extendedprice" not in l and "l_tax" not in l for l in scans)


def test_incremental_route_processes_each_event_once(spark):
    out = E.queries()["incremental_route"](spark, SMALL)
    n, distinct = out.agg(F.count(F.lit(1)), F.count_distinct("event_id")).first()
    events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    assert n == distinct == events


def test_replayed_batch_is_written_once(spark, tmp_path):
    """A crash between a batch's write and its commit record: the replay replaces the batch."""
    from tessera.streaming.incremental import incremental_route
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.range(10).write.parquet(src)

    def run():
        incremental_route(spark, src, spark.range(1).schema, out, ck, lambda d: d.withColumn("route", F.lit("accepted")))
        return spark.read.parquet(out).count()

    assert run() == 10
    for f in (tmp_path / "ck" / "commits").iterdir():
        f.unlink()
    assert run() == 10
    spark.range(10, 15).write.mode("append").parquet(src)
    assert run() == 15


def test_hot_keys_come_from_group_sizes(spark):
    """The rows are read once for an inner join."""
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").select("l_suppkey", F.col("l_orderkey").alias("rid"))
    groups = spark.createDataFrame([(i, 500) for i in range(1, 11)], "l_suppkey long, n long")
    p = _plan(join_group_stats(rows, groups, ["l_suppkey"], "n", "rid", hot_rows=100)).split("Initial Plan")[0]
    assert p.count("FileScan parquet") == 1
