"""Byte-range digests, footer counts, digest trees and running signature counts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.operators import tree_diff
from tessera.sources import io
from tessera.streaming import incremental

SMALL = "/root/testdata/sf0.001"


def test_digest_of_a_file_in_ranges(spark, tmp_path):
    big, small = bytes(i * i % 251 for i in range(2500)), b"\xff\xfe\x00"
    for name, content in {"big.bin": big, "exact.bin": big[:2000], "small one%20.bin": small, "empty.bin": b""}.items():
        (tmp_path / name).write_bytes(content)
    rows = {r.file_name: r for r in io.file_digests(spark, str(tmp_path), range_bytes=1000).collect()}

    def sha(b):
        return hashlib.sha256(b).hexdigest()

    parts = [sha(big[i:i + 1000]) for i in (0, 1000, 2000)]
    assert (rows["big.bin"].ranges, rows["big.bin"].sha256) == (3, sha("".join(parts).encode()))
    assert (rows["exact.bin"].ranges, rows["exact.bin"].sha256) == (2, sha("".join(parts[:2]).encode()))
    assert (rows["small one%20.bin"].ranges, rows["small one%20.bin"].sha256) == (1, sha(small))
    assert "empty.bin" not in rows


def test_file_changes_name_every_status(spark, tmp_path):
    before, after = tmp_path / "before", tmp_path / "after"
    for folder, files in ((before, {"same": "a", "altered": "b", "gone": "c"}), (after, {"same": "a", "altered": "B", "added": "d"})):
        folder.mkdir()
        for name, text in files.items():
            (folder / name).write_text(text)
    changes = io.file_changes(io.file_digests(spark, str(before)), io.file_digests(spark, str(after)))
    assert {r.file_name: r.status for r in changes.collect()} == {"same": "ok", "altered": "changed", "gone": "missing", "added": "new"}


def test_an_empty_folder_has_no_digests(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert io.file_digests(spark, str(tmp_path / "none")).count() == 0


def test_counts_come_from_footers(spark):
    stats = io.footer_stats(spark, f"{SMALL}/lineitem.parquet", ["l_orderkey"])
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan
    t = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert tuple(stats.first()) == tuple(t.agg(F.count(F.lit(1)), F.min("l_orderkey"), F.max("l_orderkey")).first())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_no_bounds_of_text_from_footers(spark):
    with pytest.raises(ValueError, match="c_name"):
        io.footer_stats(spark, f"{SMALL}/customer.parquet", ["c_name"])


def _differences(a, b, **kw):
    return {tuple(r) for r in tree_diff.row_differences(a, b, **kw).collect()}


def test_one_changed_row_of_many_is_found(spark):
    a = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 777, "").otherwise(F.col("v")))  # a NULL becomes the empty text
    assert tree_diff.unequal_leaves(tree_diff.leaf_digests(a), tree_diff.leaf_digests(b)).count() == 2
    assert _differences(a, b) == {(777, None, 1, 0), (777, "", 0, 1)}


def test_numbers_of_equal_rows_count(spark):
    a = spark.createDataFrame([("x", 1)] * 5 + [(None, None)] * 2, "`a.b` string, n int")
    b = spark.createDataFrame([(1, "x")] * 3 + [(None, None)] * 2 + [(2, "y")], "n int, `a.b` string")
    assert _differences(a, b, names=("l", "r")) == {("x", 1, 5, 3), ("y", 2, 0, 1)}
    summary = tree_diff.difference_summary(tree_diff.row_differences(a, b))
    assert tuple(summary.first()) == (2, 1)


@pytest.mark.parametrize("bits", [1, 5, 16])
def test_a_place_swapped_with_null_is_seen(spark, bits):
    a = spark.createDataFrame([("x", None)], "p string, q string")
    b = spark.createDataFrame([(None, "x")], "p string, q string")
    assert _differences(a, b, bits=bits) == {("x", None, 1, 0), (None, "x", 0, 1)}


def test_equal_and_empty_tables_have_no_difference(spark):
    a = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    none = a.limit(0)
    assert _differences(a, a.repartition(7, "v")) == set()
    assert _differences(none, none) == set()
    assert tuple(tree_diff.difference_summary(tree_diff.row_differences(a, none)).first()) == (100, 0)


def test_a_stored_tree_stands_for_its_table(spark, tmp_path):
    a = spark.range(1000).select("id", (F.col("id") % 9).alias("v"))
    tree_diff.leaf_digests(a).write.parquet(str(tmp_path / "tree"))
    b = a.where("id <> 5")
    assert _differences(a, b, a_leaves=spark.read.parquet(str(tmp_path / "tree"))) == {(5, 5, 1, 0)}


def test_running_counts_write_what_changed(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "k string, v int"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        incremental.incremental_changes(spark, src, spark.createDataFrame([], schema).schema, out, ck, lambda d: d.select("k"), ["k"])
        return {r.k: r.n for r in incremental.current_totals(spark, out, ["k"]).collect()}

    assert arrive([(f"k{i}", i) for i in range(20)] + [(None, 0)]) == {f"k{i}": 1 for i in range(20)} | {None: 1}
    second = arrive([("k3", 0), ("k3", 1), (None, 2), ("new", 3)])
    assert (second["k3"], second[None], second["new"], len(second)) == (3, 2, 1, 22)
    batches = spark.read.option("basePath", out).parquet(out).groupBy("batch_id").count().collect()
    sizes = {r.batch_id: r["count"] for r in batches}
    assert sizes[max(sizes)] == 3 and sizes[min(sizes)] == 21  # the second run wrote its three keys alone
    for name in (str(max(sizes)), f".{max(sizes)}.crc"):  # a crash before the commit record
        (tmp_path / "ck" / "commits" / name).unlink()
    incremental.incremental_changes(spark, src, spark.createDataFrame([], schema).schema, out, ck, lambda d: d.select("k"), ["k"])
    assert {r.k: r.n for r in incremental.current_totals(spark, out, ["k"]).collect()} == second
