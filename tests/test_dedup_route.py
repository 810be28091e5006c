from pyspark.sql import functions as F

from tessera.operators import dedup
from tessera.operators.route import route, route_checks

ROWS = [(1, "i1", "a", None, "x"), (2, "i1", "a", None, "x"), (3, "i2", "a", None, "x"),
        (4, None, "b", "1", "y"), (5, None, "b", "1", "y"), (6, "i3", "c", "2", "z")]
SCHEMA = "source_row long, id string, k1 string, k2 string, k3 string"
KEYS = ["k1", "k2", "k3"]


def test_exact_dedup_and_map(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = {r.source_row: r for r in dedup.exact_dedup(df, KEYS).collect()}
    assert sorted(kept) == [1, 4, 6]
    assert kept[1].duplicate_group_size == 3 and kept[1].id == "i1" and kept[6].duplicate_group_size == 1
    m = {r.removed_source_row: r for r in dedup.removed_map(df, KEYS).collect()}
    assert m[2].retained_source_row == 1 and m[2].same_id is True
    assert m[3].same_id is False
    assert m[5].retained_source_row == 4 and m[5].same_id is None      # NULL ids: unknown, like SQL
    s = dedup.dedup_summary(df, KEYS).first()
    assert (s.raw_rows, s.retained_rows, s.removed_rows, s.repeated_groups, s.removed_same_id, s.max_group_size) == (
        6, 3, 3, 2, 1, 3)


def test_hot_group_split_gives_same_map(spark):
    rows = [(i, f"i{i % 2}", "hot", None, "x") for i in range(1, 41)] + [(100 + i, "c", f"cold{i}", None, "y") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = sorted(tuple(r) for r in dedup.removed_map(df, KEYS).collect())
    b = sorted(tuple(r) for r in dedup.removed_map(df, KEYS, hot_rows=4).collect())
    assert a == b and len(a) == 39


def test_priority_decisions(spark):
    rows = [(1, "s", 1.0, 1), (2, "s", 1.0, 0), (3, "s", 1.0, 0), (4, "s", 2.0, 1)]
    df = spark.createDataFrame(rows, "source_row long, species_key string, lon double, priority int")
    groups, d = dedup.priority_decisions(df, ["species_key", "lon"], hot_rows=2)
    got = {r.source_row: r.keep_source_row for r in d.collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 4}


def test_route_first_match_and_null(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 20)], "id long, v long")
    routes = [("small", F.col("v") < 10), ("big", F.col("v") >= 10)]
    got = {r.id: r.route for r in route(df, routes, default="review").collect()}
    assert got == {1: "small", 2: "review", 3: "big"}
    c = route_checks(df, routes).first()
    assert c.input_rows == 3 and c.overlap_rows == 0 and c.uncovered_rows == 1


def test_dedup_deterministic_across_partitions(spark):
    df = spark.createDataFrame(ROWS * 1, SCHEMA)
    a = sorted(tuple(r) for r in dedup.exact_dedup(df.repartition(1), KEYS).collect())
    b = sorted(tuple(r) for r in dedup.exact_dedup(df.repartition(7), KEYS).collect())
    assert a == b


def test_any_priority_and_row_id(spark):
    from tessera.operators.dedup import priority_decisions
    big = 1 << 62
    df = spark.createDataFrame([(1, "a", 2, "s"), (2, "a", 1, "s"), (big + 5, "b", -3, "s"), (3, "b", 0, "s"), (7, "c", None, "s"), (9, "c", 4, "s")],
                               "source_row long, k string, priority int, species_key string")
    groups, _ = priority_decisions(df, ["k"])
    assert {r.k: r.keep_source_row for r in groups.collect()} == {"a": 2, "b": big + 5, "c": 9}


def test_name_list_strips_all_white_space(spark):
    from tessera.operators.lists import name_list
    df = spark.createDataFrame([("Foo bar\t",), ("\n foo BAR",), ("\t",), (None,)], "sci_name string")
    assert [r.species_key for r in name_list(df).collect()] == ["foo bar"]


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    import pytest
    from tessera.sources import io
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\nz,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_text_table(spark, str(tmp_path), ["id", "name"]).collect()


def test_glob_of_csv_files_united_by_name(spark, tmp_path):
    from tessera.sources import io
    files = {"a.csv": 'id,name,depth\n1,x,5\n2,"y\nz",\n', "b b.csv": "depth,id,name\n7,3,w\n", "c[1].csv": "name,id\nv,4\n",
             "d.csv": "id,name,depth\n5,u,9\n", "e.csv": '"two\nlines",id\nq,6\n', "f.csv": ""}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    df = io.read_union_by_name(spark, f"{tmp_path}/*.csv")
    got = {tuple(r) for r in df.select("id", "name", "depth", "`two\nlines`").collect()}
    assert got == {("1", "x", "5", None), ("2", "y\nz", None, None), ("3", "w", "7", None), ("4", "v", None, None), ("5", "u", "9", None), ("6", None, None, "q")}
