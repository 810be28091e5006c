"""Steps that several queries share do their work once, and give whole results on repeated and null keys."""

from pyspark.sql import functions as F

from tessera.operators import classify, dedup, grid, polygon
from tessera.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def _plan(df, stage="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


def test_fixture_is_read_by_column(spark):
    plan = _plan(fx.load(spark, SMALL, "fx6").select("scientificname"), "executedPlan")
    assert "ReadSchema: struct<scientificname:string>" in plan


def test_pixels_read_the_line_items_once(spark, monkeypatch):
    """The cells are counted once, not once for each variable, and the rows are those of the fixture's SQL."""
    from tessera import session
    plans, staged = [], session.staged
    monkeypatch.setattr(session, "staged", lambda df, name: (plans.append(_plan(df)), staged(df, name))[1])
    px = fx.load(spark, SMALL + "/.", "fx4")  # a path that no other test has loaded
    assert sum(line.count("Relation [") for plan in plans for line in plan.splitlines() if "l_shipdate" in line) == 1, plans
    want = spark.sql(fx.FIXTURES["fx4"][0])
    assert px.dtypes == want.dtypes
    assert px.exceptAll(want).isEmpty() and want.exceptAll(px).isEmpty()


def test_the_planner_knows_the_bytes_of_headers(spark):
    """Headers that repeat take few bytes in a file of dictionaries, and as many as others in a broadcast."""
    n = 3000
    pixels = spark.range(n).selectExpr("'so' AS variable", "2000 AS year", "cast(id AS int) AS layer", "0 AS row", "0 AS col", "1.0D AS value")
    heads = grid.prepare_rasters(pixels, grid.with_spec(grid.raster_headers(pixels), grid.GridSpec())).headers
    assert heads.count() == n
    used = heads.select("year", "layer", "h_so")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert used >= n * 12, used


def test_a_filter_on_route_parses_each_number_once(spark):
    rows = spark.createDataFrame([(1, "a", "5", "1", "2", "2000"), (2, "a", None, "x", "2", "19x8"), (3, "b", "inf", "1", "95", "1998.5"),
                                  (4, None, "-5", " NA ", "2", None), (5, "c", "1d", "1", "2", "1850")],
                                 "source_row long, scientificname string, depth string, longitude string, latitude string, year string")
    ranges = spark.createDataFrame([(1, " A", "10", "20")], "row_no long, sci_name string, depth_up string, depth_low string")
    depth = classify.assign_depth(rows, classify.range_lookup(ranges))
    coords, years = classify.coordinate_qc(rows), classify.year_qc(rows)
    taken = [(df.where(F.col("route") == "accepted"), text) for df, text in ((depth, "depth_raw"), (years, "year_raw"))]
    taken.append((coords.where(F.col("route") == "accepted"), "latitude#"))
    for df, text in taken:
        marks = [line for line in _plan(df).splitlines() if "RLIKE" in line and text.split("_")[0].split("#")[0] in line and "depth_up" not in line]
        assert len(marks) == 1 and marks[0].count("RLIKE") == (2 if text == "latitude#" else 1), _plan(df)
    assert {r.source_row: r.depth_final for r in taken[0][0].collect()} == {1: 5.0, 2: 15.0}
    assert [r.source_row for r in taken[1][0].collect()] == [1]
    assert sorted(r.source_row for r in taken[2][0].collect()) == [1, 5]
    assert {r.source_row: r.observed_depth_status for r in depth.collect()} == {
        1: "valid", 2: "missing", 3: "nonfinite", 4: "negative", 5: "unparseable"}


def test_conventions_meet_without_a_join_on_the_point(spark):
    pixels = spark.createDataFrame([(v, 2000, layer, r, c, float(layer * 1000 + i * 100 + r * 10 + c)) for i, v in enumerate(grid.VARIABLES)
                                    for layer in (1, 2) for r in range(2) for c in range(2)],
                                   "variable string, year int, layer int, row int, col int, value double")
    points = spark.createDataFrame([(1, 0.5, -0.5, 2000, 1, 2), (2, 1.5, -0.5, 2000, 1, 1), (3, 0.5, -1.5, 2000, 2, 1), (3, 1.5, -1.5, 2000, 1, 2),
                                    (None, 0.5, -0.5, 2000, 1, 2)],
                                   "source_row long, lon double, lat double, year_final int, phy_layer int, bgc_layer int")
    spec = grid.GridSpec(c=0.0, a=1.0, f=0.0, e=-1.0)
    rasters = grid.prepare_rasters(pixels, grid.with_spec(grid.raster_headers(pixels), spec))
    own = grid.sample_long(points, None, spec, "independent", rasters=rasters).select("source_row", "variable", F.col("value").alias("independent_value"))
    shared = grid.sample_long(points, None, spec, "shared_phy", rasters=rasters).select("source_row", "variable", F.col("value").alias("shared_value"))
    columns = ["source_row", "variable", "shared_value", "independent_value"]
    want = sorted(tuple(r) for r in own.join(shared, ["source_row", "variable"]).select(*columns).collect())
    repeated = spark.createDataFrame([(3,)], "source_row long")
    assert sorted(tuple(r) for r in grid.sample_conventions(points, rasters, repeated).select(*columns).collect()) == want
    assert len(want) == 5 + 5 + 4 * 5
    single = grid.sample_conventions(points.where("source_row < 3"), rasters)
    assert sorted(tuple(r) for r in single.select(*columns).collect()) == [r for r in want if r[0] < 3]
    joins = [line for line in _plan(single).splitlines() if "Join" in line]
    assert joins and not any("source_row" in line for line in joins)


def test_tiles_hold_every_variable_of_a_square(spark):
    pixels = spark.createDataFrame([("so", 2000, 1, 0, 0, 1.0), ("so", 2000, 1, 1, 1, None), ("chl", 2000, 1, 0, 1, 3.0)],
                                   "variable string, year int, layer int, row int, col int, value double")
    tiles = grid.prepare_rasters(pixels, grid.with_spec(grid.raster_headers(pixels), grid.GridSpec(c=0.0, a=1.0, f=0.0, e=-1.0))).tiles
    got = {(r.family, r.gx, r.gy): r for r in tiles.collect()}
    phy = got["phy", 0, -1]
    assert sorted(zip(phy.t_so["at"], phy.t_so["value"]), key=str) == [(0, 1.0), (3, None)] and phy.t_thetao["at"] == []
    assert got["bgc", 0, -1].t_chl["value"] == [3.0]


def test_tiles_and_headers_are_not_carried_to_the_next_join(spark):
    """What the tasks of a later join sort holds a point's numbers only: no tile, no header of any raster."""
    pixels = spark.createDataFrame([(v, 2000, layer, r, c, float((layer + i + r * c) % 3)) for i, v in enumerate(grid.VARIABLES)
                                    for layer in (1, 2) for r in range(4) for c in range(4)],
                                   "variable string, year int, layer int, row int, col int, value double")
    points = spark.createDataFrame([(1, 1.5, -1.5, 2000, 1, 2), (1, 1.5, -1.5, 2000, 1, 2), (2, 9.5, -1.5, 2000, 2, 2), (3, 2.5, -2.5, 2001, 1, 1),
                                    (None, 2.5, -1.5, 2000, 2, 1), (4, None, -1.5, 2000, 1, 2), (5, 0.5, -0.5, None, None, 2)],
                                   "source_row long, lon double, lat double, year_final int, phy_layer int, bgc_layer int")
    rasters = grid.prepare_rasters(pixels, grid.with_spec(grid.raster_headers(pixels), grid.GridSpec(c=0.0, a=1.0, f=0.0, e=-1.0)))
    value = {(r.variable, r.layer, r.row, r.col): r.value for r in pixels.collect()}
    want = sorted([(s, v, layer, dr, dc) for s, row, col, phy, bgc in ((1, 1, 1, 1, 2), (1, 1, 1, 1, 2), (None, 1, 2, 2, 1)) for v in ("chl", "no3", "o2")
                   for layer in (phy, bgc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if value[v, layer, row + dr, col + dc] == value[v, bgc, row, col]], key=str)
    near = grid.neighbour_matches(points, rasters)
    assert sorted((tuple(r) for r in near.collect()), key=str) == want
    masks = sorted(((r.source_row, r.environment_outside_mask, r.environment_invalid_mask) for r in grid.sample_tiles(points, rasters).collect()), key=str)
    assert masks == sorted([(1, 0, 0), (1, 0, 0), (2, 31, 0), (3, 0, 31), (None, 0, 0), (4, 31, 0), (5, 0, 31)], key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (grid.neighbour_matches(points, rasters), grid.sample_tiles(points, rasters), grid.sample_conventions(points, rasters)):
            plan = df._jdf.queryExecution().optimizedPlan()
            joins, todo = [], [plan]
            while todo:
                node = todo.pop()
                todo += [node.children().apply(i) for i in range(node.children().size())]
                if node.nodeName() == "Join" and node.condition().isDefined():
                    joins.append(node.children().apply(0).schema().catalogString())
            assert len(joins) >= 4 and not any("array<bigint>" in x or "width:" in x or "nodata:" in x for x in joins), joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_spatial_route_makes_its_decisions_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def decided(inside):
        made.add(1)
        return inside

    rows = spark.createDataFrame([(i, "s" if i % 4 else None, "ready", i % 2 == 0, False) for i in range(40)],
                                 "source_row long, species_key string, buffer_status string, buffer_inside boolean, buffer_boundary boolean")
    got = polygon.spatial_route(rows.withColumn("buffer_inside", decided("buffer_inside")), n=5, hot_rows=7).collect()
    assert len(got) == 40 and made.value == 40
    assert {r.species_key: r.spatial_records for r in got} == {"s": 10, None: 10}


def test_removed_map_groups_only_rows_whose_keys_recur(spark):
    rows = spark.createDataFrame([(1, "p", "a", None), (2, "q", None, "a"), (3, "p", "a", None), (4, "r", None, "a"), (5, "s", "b", "c"),
                                  (6, None, "a", None), (7, "t", None, None), (8, "t", None, None)],
                                 "source_row long, id string, x string, y string")
    m = dedup.removed_map(rows, ["x", "y"], hot_rows=2)
    assert "LeftSemi" in _plan(m)
    assert sorted(tuple(r) for r in m.collect()) == [(3, "p", 1, "p", True), (4, "r", 2, "q", False), (6, None, 1, "p", None), (8, "t", 7, "t", True)]
