from pyspark.sql import functions as F

from tessera.operators import grid, polygon
from tessera.operators.identity import rank_within, with_position


def test_polygon_unit_square_and_union(spark):
    sq = [(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)]
    sq2 = [(x1 + 0.5, y1, x2 + 0.5, y2) for x1, y1, x2, y2 in sq]
    edges = [("s", 1, i, *map(float, e)) for i, e in enumerate(sq)] + [("s", 2, i, *map(float, e)) for i, e in enumerate(sq2)]
    e = spark.createDataFrame(edges, "species_key string, feature int, seq int, x1 double, y1 double, x2 double, y2 double")
    pts = [(1, "s", 0.25, 0.5), (2, "s", 1.0, 0.5), (3, "s", 0.75, 0.0), (4, "s", 2.0, 0.5), (5, "t", 0.5, 0.5),
           (6, "s", 1.5, 0.5)]
    p = spark.createDataFrame(pts, "source_row long, species_key string, lon double, lat double")
    got = {r.source_row: (r.buffer_status, r.buffer_inside, r.buffer_boundary)
           for r in polygon.polygon_decide(p, e, band=0.25, hot_rows=2).collect()}
    assert got[1] == ("ready", True, False)
    assert got[2] == ("ready", True, False)        # on feature 1's edge but inside feature 2
    assert got[3] == ("ready", False, True)        # on the bottom edge of both
    assert got[4] == ("ready", False, False)
    assert got[5] == ("missing_buffer", False, False)
    assert got[6] == ("ready", False, True)        # right edge of feature 2 only


def test_ring_checks_detects_open_ring(spark):
    edges = [("s", 1, 0, 0.0, 0.0, 1.0, 0.0), ("s", 1, 1, 1.0, 0.0, 1.0, 1.0), ("s", 1, 2, 1.0, 1.0, 0.0, 0.5)]
    e = spark.createDataFrame(edges, "species_key string, feature int, seq int, x1 double, y1 double, x2 double, y2 double")
    r = polygon.ring_checks(e).first()
    assert r.closed is False and r.valid is False


def test_nearest_layer_ties_go_low(spark):
    layers = spark.createDataFrame([(1, 10.0, 10.0), (2, 20.0, 30.0), (3, 30.0, 20.0)],
                                   "layer int, phy_depth double, bgc_depth double")
    pts = spark.createDataFrame([(1, 15.0), (2, 25.0), (3, 100.0), (4, None)], "source_row long, depth_final double")
    got = {r.source_row: (r.phy_layer, r.bgc_layer) for r in grid.assign_layers(pts, layers).collect()}
    assert got[1] == (1, 1)           # tie 10/20 -> layer 1; bgc tie 10/20(layer 3) -> 1
    assert got[2] == (2, 2)           # tie 20/30 -> layer 2; bgc: 30 is layer 2, 20 is layer 3 -> 2
    assert got[3] == (3, 2) and got[4] == (None, None)


def test_grid_sample_outside_keeps_zero(spark):
    pixels = spark.createDataFrame([(v, 2000, 1, r, c, float(r * 10 + c)) for v in grid.VARIABLES
                                    for r in range(2) for c in range(2)],
                                   "variable string, year int, layer int, row int, col int, value double")
    pts = spark.createDataFrame([(1, 1.5, -0.5, 2000, 1, 1), (2, 5.0, -0.5, 2000, 1, 1)],
                                "source_row long, lon double, lat double, year_final int, phy_layer int, bgc_layer int")
    spec = grid.GridSpec(c=0.0, a=1.0, f=0.0, e=-1.0)
    w = {r.source_row: r for r in grid.sample_wide(grid.sample_long(pts, pixels, spec)).collect()}
    assert w[1].thetao == 1.0 and w[1].environment_outside_mask == 0
    assert w[2].thetao == 0.0 and w[2].environment_outside_mask == 31 and w[2].environment_invalid_mask == 0


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    p = sorted((r.k, r.position) for r in with_position(df.repartition(5), ["k"], "position").collect())
    assert [x[1] for x in p] == list(range(1000))
    r = rank_within(df, ["g"], ["k"], "rank").collect()
    by_g = {}
    for row in r:
        by_g.setdefault(row.g, []).append((row.k, row.rank))
    for rows in by_g.values():
        rows.sort()
        assert [x[1] for x in rows] == list(range(len(rows)))


def test_shared_edge_is_dissolved(spark):
    a = [(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)]
    b = [(1, 0, 2, 0), (2, 0, 2, 1), (2, 1, 1, 1), (1, 1, 1, 0)]      # shares x = 1 with a, reversed
    edges = [("s", 1, i, *map(float, e)) for i, e in enumerate(a)] + [("s", 2, i, *map(float, e)) for i, e in enumerate(b)]
    e = spark.createDataFrame(edges, "species_key string, feature int, seq int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(1, "s", 1.0, 0.5), (2, "s", 1.0, 0.0), (3, "s", 1.0, 1.0), (4, "s", 0.5, 0.5)],
                              "source_row long, species_key string, lon double, lat double")
    got = {r.source_row: (r.buffer_inside, r.buffer_boundary) for r in polygon.polygon_decide(p, e, band=0.5).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (False, True), 4: (True, False)}


def test_evenly_spaced_global_and_grouped(spark):
    from tessera.operators.verify import evenly_spaced
    df = spark.range(0, 101).select((F.col("id") % 2).alias("g"), F.col("id"))
    got = sorted(r.id for r in evenly_spaced(df, "id", 5).collect())
    assert got == [0, 25, 50, 75, 100]
    per = sorted((r.g, r.id) for r in evenly_spaced(df, "id", 3, partition="g").collect())
    assert per == [(0, 0), (0, 50), (0, 100), (1, 1), (1, 49), (1, 99)]


def test_stratified_sample_quotas(spark):
    from tessera.operators.verify import stratified_sample
    df = spark.range(0, 200).select((F.col("id") % 2).alias("s"), F.col("id"))
    got = stratified_sample(df, "s", "id", {0: 5, 1: 2}).groupBy("s").count().collect()
    assert sorted((r.s, r["count"]) for r in got) == [(0, 5), (1, 2)]


def _boxes(spark, boxes):
    edges = []
    for f, (x, y, u, v) in enumerate(boxes):
        ring = [(x, y), (u, y), (u, v), (x, v), (x, y)]
        edges += [("s", f, i, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(ring, ring[1:], strict=False))]
    return spark.createDataFrame(edges, "species_key string, feature int, seq int, x1 double, y1 double, x2 double, y2 double")


def _decide(spark, edges, points):
    p = spark.createDataFrame([(i, "s", float(x), float(y)) for i, (x, y) in enumerate(points)],
                              "source_row long, species_key string, lon double, lat double")
    rows = polygon.polygon_decide(p, edges, band=0.5).orderBy("source_row").collect()
    return [(r.buffer_inside, r.buffer_boundary) for r in rows]


def test_equal_and_nested_features_keep_their_boundary(spark):
    inside, boundary = (True, False), (False, True)
    twice = _boxes(spark, [(0, 0, 1, 1), (0, 0, 1, 1)])
    assert _decide(spark, twice, [(1, 0.5), (0, 0.5), (0.5, 0.5)]) == [boundary, boundary, inside]
    turned = twice.selectExpr("species_key", "feature", "seq", *[f"if(feature = 1, {a}{3 - i}, {a}{i}) {a}{i}" for i in (1, 2) for a in "xy"])
    assert _decide(spark, turned, [(1, 0.5), (0.5, 0.5)]) == [boundary, inside]
    nested = _boxes(spark, [(0, 0, 2, 1), (0, 0, 1, 1), (0, 0, 1, 1)])
    assert _decide(spark, nested, [(0, 0.5), (1, 0.5), (2, 0.5)]) == [boundary, inside, boundary]
    beside = _boxes(spark, [(0, 0, 1, 1), (1, 0, 2, 1), (0, 0, 1, 1)])
    assert _decide(spark, beside, [(1, 0.5), (0, 0.5)]) == [inside, boundary]


def test_infinite_vertex_is_invalid_and_harms_no_other(spark):
    good = _boxes(spark, [(0, 0, 1, 1)])
    bad = _boxes(spark, [(0, 0, 1, 1)]).selectExpr("'t' AS species_key", "feature", "seq", "x1", "if(seq = 2, double('inf'), y1) AS y1", "x2",
                                                  "if(seq = 1, double('inf'), y2) AS y2")
    e = good.unionByName(bad)
    assert {r.species_key: r.buffer_status for r in polygon.polygon_status(e).collect()} == {"s": "ready", "t": "invalid_geometry"}
    assert _decide(spark, e, [(0.5, 0.5)]) == [(True, False)]


def _ring(vertices, feature=1, species="s"):
    ring = [*vertices, vertices[0]]
    return [(species, feature, i, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(ring, ring[1:], strict=False))]


def _edges(spark, rows):
    return spark.createDataFrame(rows, "species_key string, feature int, seq int, x1 double, y1 double, x2 double, y2 double")


def test_partly_shared_edges_are_noded(spark):
    inside, boundary, outside = (True, False), (False, True), (False, False)
    got = _decide(spark, _boxes(spark, [(0, 0, 1, 2), (1, 0, 2, 1)]), [(1, 0.5), (1, 1.5), (1, 1), (1, 0), (1.5, 1), (2.5, 0.5)])
    assert got == [inside, boundary, boundary, boundary, boundary, outside]
    # Three boxes round a corner: inside only where all sides are covered.
    around = [(0, 0, 1, 2), (1, 0, 2, 1), (1, 1, 3, 2)]
    assert _decide(spark, _boxes(spark, around), [(1, 1), (1.5, 1), (2.5, 1), (2, 1)]) == [inside, inside, boundary, boundary]
    # Slanted supporting line, cut at (1, 1) and (2, 2); a gap between two shared stretches.
    rows = _ring([(0, 0), (4, 4), (0, 4)]) + _ring([(0, 0), (1, 0), (1, 1)], 2) + _ring([(2, 2), (3, 2), (3, 3)], 3)
    assert _decide(spark, _edges(spark, rows), [(0.5, 0.5), (1.5, 1.5), (2.5, 2.5), (3.5, 3.5), (2, 2)]) == [inside, boundary, inside, boundary, boundary]


def test_rings_that_cross_themselves(spark):
    rings = {"box": [(0, 0), (2, 0), (2, 2), (0, 2)], "bow": [(0, 0), (2, 2), (2, 0), (0, 2)], "touch": [(0, 0), (4, 0), (2, 2), (2, 0)],
             "spike": [(0, 0), (2, 0), (3, 0), (2, 0), (2, 2)], "eight": [(0, 0), (1, 1), (2, 0), (2, 2), (1, 1), (0, 2)], "thin": [(0, 0), (9, 0.001), (9, 0)]}
    edges = _edges(spark, [e for name, v in rings.items() for e in _ring(v, species=name)] + _ring([(0, 0), (1e200, 0), (1e200, 1e200)], species="huge"))
    assert {r.species_key for r in polygon.ring_checks(edges).collect() if not r.simple} == {"bow", "touch", "spike", "eight"}
    status = {r.species_key: r.buffer_status for r in polygon.polygon_status(edges).collect()}
    assert status == {"box": "ready", "thin": "ready", "huge": "geometry_error"} | dict.fromkeys(["bow", "touch", "spike", "eight"], "invalid_geometry")


def test_large_rings_by_tiles(spark):
    """Rings of many uneven edges, against every pair of edges; heavy tiles are cut."""
    import math
    import random
    rng = random.Random(11)
    rings = []
    for k in range(6):
        n = 300
        angles = sorted(rng.random() ** (3 if k % 2 else 1) * 2 * math.pi for _ in range(n))
        v = [(r * math.cos(a) * 10 ** (k - 2), r * math.sin(a)) for a in angles for r in [2 + rng.random()]]
        if k in (2, 3, 5):
            v[40], v[41 + k] = v[41 + k], v[40]
        rings.append(v)

    def crossing(v):
        e = list(zip(v, v[1:] + v[:1], strict=True))
        turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return any(turn(*p, q[0]) * turn(*p, q[1]) < 0 and turn(*q, p[0]) * turn(*q, p[1]) < 0 for i, p in enumerate(e) for q in e[i + 1:])

    edges = _edges(spark, [e for k, v in enumerate(rings) for e in _ring(v, feature=k)])
    want = {k for k, v in enumerate(rings) if crossing(v)}
    assert want and len(want) < len(rings)
    for most in (64, 4):
        assert {r.feature for r in polygon.crossed_rings(edges, polygon.ring_sizes(edges), most).collect()} == want


def test_cover_agrees_with_edges(spark):
    """Random unions of triangles and boxes: every point against a ray cast over all edges."""
    import random
    rng = random.Random(12)
    for h in (0.5, 7.0):
        shapes = [[(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(3)] for _ in range(4)]
        rows = [e for f, v in enumerate(shapes) for e in _ring(v, f)]
        points = [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(400)]

        def within(v, x, y):
            ring = list(zip(v, v[1:] + v[:1], strict=True))
            return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in ring) % 2 == 1

        p = spark.createDataFrame([(i, "s", x, y) for i, (x, y) in enumerate(points)], "source_row long, species_key string, lon double, lat double")
        got = {r.source_row: r.buffer_inside for r in polygon.polygon_decide(p, _edges(spark, rows), band=h, hot_rows=50).collect()}
        assert got == {i: any(within(v, x, y) for v in shapes) for i, (x, y) in enumerate(points)}


def test_points_in_pure_tiles_meet_no_edge(spark):
    edges = _boxes(spark, [(0.5, 0.5, 20.5, 20.5)])
    cover = polygon.tile_cover(polygon.edge_rows(edges, 1.0), 1.0)
    rows = {r["row"]: (sorted(map(tuple, r.mixed)), sorted(map(tuple, r.inside))) for r in cover.collect()}
    assert rows[10] == ([(0, 0), (20, 20)], [(1, 19)]) or rows[10][0] == [(0, 0), (20, 20)] and (1, 19) in [(max(a, 1), min(b, 19)) for a, b in rows[10][1]]
    assert (0, 20) in rows[0][0] and (0, 20) in rows[20][0] and set(rows) == set(range(21))


def test_twenty_thousand_layers(spark):
    import random
    rng = random.Random(8)
    depths = [rng.choice([rng.uniform(0, 6000), rng.uniform(0, 5), float(rng.randrange(200))]) for _ in range(20_000)]
    layers = spark.createDataFrame([(i, d, d / 2) for i, d in enumerate(depths)], "layer int, phy_depth double, bgc_depth double")
    zs = [-50.0, 0.0, 9999.0, 2.5, 100.5] + [rng.uniform(-10, 6100) for _ in range(60)] + [float(i) / 2 for i in range(40)]
    pts = spark.createDataFrame(list(enumerate(zs)), "source_row long, depth_final double")
    for r in grid.assign_layers(pts, layers).collect():
        assert r.phy_layer == min((abs(zs[r.source_row] - d), i) for i, d in enumerate(depths))[1]
        assert r.bgc_layer == min((abs(zs[r.source_row] - d / 2), i) for i, d in enumerate(depths))[1]


def test_layer_tree_is_even_however_uneven_the_depths(spark):
    import random
    rng = random.Random(9)
    depths = [1e12, -5.0] + [rng.choice([rng.uniform(0, 1), float(rng.randrange(100)), 10 ** rng.uniform(-3, 4)]) for _ in range(20_000)]
    layers = spark.createDataFrame([(i, d, None) for i, d in enumerate(depths)], "layer int, phy_depth double, bgc_depth double")
    tree = grid.layer_tree(layers, {"phy": "phy_depth"})
    sizes = {}
    for r in tree.collect():
        sizes.setdefault(r.level, []).append(len(r["items"]))
    assert len(sizes[2]) == 1 and max(sizes[0]) <= grid.LAYER_FAN + 2 and max(map(max, sizes.values())) <= grid.LAYER_FAN + 2
    n = len(set(depths))
    assert len(sizes[0]) == -(-n // grid.LAYER_FAN)
    zs = [-1e9, 1e11, 1e13, 4.9e11, 5.1e11, 0.5] + [rng.uniform(-10, 6000) for _ in range(60)] + rng.sample(depths, 40)
    pts = spark.createDataFrame([*enumerate(zs), (1000, None)], "source_row long, depth_final double")
    got = {r.source_row: (r.phy_layer, r.bgc_layer) for r in grid.assign_layers(pts, layers).collect()}
    assert got.pop(1000) == (None, None)
    for i, z in enumerate(zs):
        assert got[i] == (min((abs(z - d), k) for k, d in enumerate(depths))[1], None)


def test_small_fans(spark):
    layers = spark.createDataFrame([(i, float(i * i), float(-i)) for i in range(30)], "layer int, phy_depth double, bgc_depth double")
    zs = [x / 2 for x in range(-70, 1900, 7)]
    pts = spark.createDataFrame(list(enumerate(zs)), "source_row long, depth_final double")
    for fan in (2, 3, 29, 30):
        for r in grid.assign_layers(pts, layers, fan=fan).collect():
            z = zs[r.source_row]
            assert r.phy_layer == min((abs(z - i * i), i) for i in range(30))[1]
            assert r.bgc_layer == min((abs(z + i), i) for i in range(30))[1]


def test_rasters_of_two_sizes(spark):
    pixels = spark.createDataFrame([(v, y, 1, r, c, 5.0) for v in grid.VARIABLES for y, n in ((2000, 2), (2001, 3)) for r in range(n) for c in range(n)],
                                   "variable string, year int, layer int, row int, col int, value double")
    pts = spark.createDataFrame([(1, 2.5, -0.5, 2000, 1, 1), (2, 2.5, -0.5, 2001, 1, 1), (3, 2.5, -0.5, 2002, 1, 1)],
                                "source_row long, lon double, lat double, year_final int, phy_layer int, bgc_layer int")
    w = {r.source_row: r for r in grid.sample_wide(grid.sample_long(pts, pixels, grid.GridSpec(c=0.0, a=1.0, f=0.0, e=-1.0))).collect()}
    assert (w[1].thetao, w[1].environment_outside_mask, w[1].environment_invalid_mask) == (0.0, 31, 0)
    assert (w[2].thetao, w[2].environment_outside_mask) == (5.0, 0)
    assert (w[3].thetao, w[3].environment_outside_mask, w[3].environment_invalid_mask) == (None, 0, 31)


def test_tiles_of_rasters_with_their_own_transforms(spark):
    """Values, masks and 3x3 windows against plain arrays; rasters of other sizes, transforms and nodata values."""
    import math
    import random
    rng = random.Random(13)
    specs = {}
    for i, v in enumerate(grid.VARIABLES):
        for layer in (1, 2):
            specs[v, layer] = (rng.randrange(3, 60), rng.randrange(3, 60), -10.0 - i, rng.choice([0.5, 1.0, 1.25]), 8.0 + layer, rng.choice([-0.5, -1.5]),
                               rng.choice([None, -9.0]))
    value = {(v, la, r, c): rng.choice([None, -1.0, 0.0, 1.0, 2.0]) for (v, la), (w, h, *_) in specs.items() for r in range(h) for c in range(w)}
    pixels = spark.createDataFrame([(v, 2000, la, r, c, x) for (v, la, r, c), x in value.items()], "variable string, year int, layer int, row int, col int, value double")
    headers = spark.createDataFrame([(v, 2000, la, *x) for (v, la), x in specs.items()],
                                    "variable string, year int, layer int, width int, height int, c double, a double, f double, e double, nodata double")
    pts = [(i, rng.uniform(-14, 30), rng.uniform(-40, 12), 2000, rng.choice([1, 2]), rng.choice([1, 2])) for i in range(300)]
    points = spark.createDataFrame(pts, "source_row long, lon double, lat double, year_final int, phy_layer int, bgc_layer int")

    def cell(v, layer, x, y):
        w, h, c, a, f, e, nodata = specs[v, layer]
        r, k = math.floor((y - f) / e), math.floor((x - c) / a)
        inside = 0 <= r < h and 0 <= k < w
        return r, k, inside, value[v, layer, r, k] if inside else (0.0 if nodata is None else nodata)

    for cells in (4, 16):
        rasters = grid.prepare_rasters(pixels, headers, cells)
        got = {r.source_row: r for r in grid.sample_tiles(points, rasters).collect()}
        near = {tuple(r) for r in grid.neighbour_matches(points, rasters).collect()}
        want = set()
        for i, x, y, _, phy, bgc in pts:
            out = bad = 0
            for bit, v in enumerate(grid.VARIABLES):
                layer = phy if v in grid.PHY_VARIABLES else bgc
                _, _, inside, val = cell(v, layer, x, y)
                assert got[i][v] == val
                out |= (not inside) << bit
                bad |= (val is None or val == -1) << bit
                if v not in grid.PHY_VARIABLES and inside:
                    for la in {phy, bgc}:
                        r, k, *_ = cell(v, la, x, y)
                        w, h = specs[v, la][:2]
                        if 1 <= r <= h - 2 and 1 <= k <= w - 2:
                            want |= {(i, v, la, dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if val is not None and value[v, la, r + dr, k + dc] == val}
            assert (got[i].environment_outside_mask, got[i].environment_invalid_mask) == (out, bad)
        assert near == want and near
