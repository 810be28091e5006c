"""Point-in-polygon inclusion over an edge table.

Polygons arrive as edges ``(species_key, feature, seq, x1, y1, x2, y2)``, one
ring per feature; several features of one species form a union.  A point is

* inside   -- in the interior of the union,
* boundary -- on the boundary of the union,
* outside  -- otherwise.

**Ring validity.** A ring must be closed, finite and simple.  Its edges are laid
out over tiles; only edges that share a tile are compared, and a tile with many
edges is cut into smaller ones, so no ring is compared edge by edge with itself.

**Union.** Edges of one supporting line are cut at each other's ends by a sweep
that counts the features on either side.  Where both sides are covered the line
lies inside the union (dissolved); elsewhere it is boundary.  An edge keeps the
intervals of it that are boundary.  Supporting lines are told apart by slope and
intercept, rounded to 12 and 9 decimals.

**Tile cover.** Each latitude row of a species holds the runs of tiles that its
edges touch (mixed) and those inside some feature.  A point in a tile that no
edge touches is decided by its tile alone; only points in mixed tiles meet the
edges of their row, which are exactly those that a horizontal ray through the
point can cross.  Point counts per (species, row) drive the salted join, so a
row holding a large share of a hot species' points is split across tasks.

Edges, cover and status are written once and read by every later step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import is_finite
from ..functions.skew import DEFAULT_HOT_ROWS, join_group_stats
from ..session import scratch_path

BAND_DEGREES = 1.0
#: Edges in a tile of the validity check before it is cut, how finely it is cut, and how often.
TILE_EDGES, TILE_CUT, TILE_ROUNDS = 64, 4, 8
#: Margin of tile borders, against rounding.
EPS = 1e-9


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _x_at(y: Column) -> Column:
    """The x of an edge at a latitude that it crosses."""
    return F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))


# --- ring validity ------------------------------------------------------------------------

def _tiles(edges: DataFrame) -> DataFrame:
    """Each edge with the tiles (i, j) of side ``w`` from (x0, y0) that it touches, column by column."""
    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    w, x0, y0 = F.col("w"), F.col("x0"), F.col("y0")
    eps = w * EPS

    def index(v: Column, origin: Column) -> Column:
        return F.floor((v - origin) / w)

    out = edges.withColumn("i", F.explode(F.sequence(index(left - eps, x0), index(right + eps, x0))))
    # The edge's y range between the column's borders.
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    a = F.col("y1") + slope * (F.greatest(left, x0 + F.col("i") * w) - F.col("x1"))
    b = F.col("y1") + slope * (F.least(right, x0 + (F.col("i") + 1) * w) - F.col("x1"))
    steep = F.col("x1") == F.col("x2")
    down = F.when(steep, low).otherwise(F.greatest(low, F.least(a, b, high)))
    up = F.when(steep, high).otherwise(F.least(high, F.greatest(a, b, low)))
    return out.withColumn("j", F.explode(F.sequence(index(down - eps, y0), index(up + eps, y0))))


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    """Sign of the turn a, b, c: left 1, straight 0, right -1."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _meet() -> Column:
    """Whether edges e and f share more than the vertex in which one follows the other."""
    c = {n: F.col(n) for n in ("ex1", "ey1", "ex2", "ey2", "fx1", "fy1", "fx2", "fy2")}
    e1, e2, f1, f2 = ((c["ex1"], c["ey1"]), (c["ex2"], c["ey2"]), (c["fx1"], c["fy1"]), (c["fx2"], c["fy2"]))

    def same(p, q):
        return (p[0] == q[0]) & (p[1] == q[1])

    def on(p, a, b):
        return ((_turn(*a, *b, *p) == 0) & (p[0] >= F.least(a[0], b[0])) & (p[0] <= F.greatest(a[0], b[0]))
                & (p[1] >= F.least(a[1], b[1])) & (p[1] <= F.greatest(a[1], b[1])))

    cross = (_turn(*e1, *e2, *f1) * _turn(*e1, *e2, *f2) < 0) & (_turn(*f1, *f2, *e1) * _turn(*f1, *f2, *e2) < 0)
    return (cross | (on(e1, f1, f2) & ~same(e1, f2)) | (on(e2, f1, f2) & ~same(e2, f1))
            | (on(f1, e1, e2) & ~same(f1, e2)) | (on(f2, e1, e2) & ~same(f2, e1)))


def ring_sizes(edges: DataFrame) -> DataFrame:
    """Per (species, feature): edges, finite, turn (1 counter-clockwise, -1 clockwise, null for an area of zero or none that
    is a number) and extent."""
    fin = is_finite("x1") & is_finite("y1") & is_finite("x2") & is_finite("y2")
    area = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    side = F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")))
    return edges.groupBy("species_key", "feature").agg(
        F.count(F.lit(1)).alias("edges"), F.bool_and(F.coalesce(fin, F.lit(False))).alias("finite"),
        F.when(is_finite(area) & (area != 0), F.signum(area)).alias("turn"),
        F.min(F.least("x1", "x2")).alias("x0"), F.min(F.least("y1", "y2")).alias("y0"), side.alias("side"))


def _tiled(e: DataFrame, rings: DataFrame, most: int) -> DataFrame:
    """Edges of large rings by tile; a tile with more than ``most`` edges is cut, a few rounds long.  Edges of a simple ring
    come apart, so those left together in tiny tiles are few, or do cross."""
    ring = ["species_key", "feature"]
    extent = rings.select(*ring, "x0", "y0", (F.col("side") / F.ceil(F.sqrt("edges")) * 1.01).alias("w"))  # about as many tiles as edges
    tile = [*ring, "w", "i", "j"]
    done, level = None, _staged(_tiles(e.join(extent, ring)), "ring-tiles")
    for _ in range(TILE_ROUNDS):
        heavy = level.groupBy(*tile).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).drop("n")
        heavy = _staged(heavy, "ring-heavy")
        if heavy.isEmpty():
            break
        light = level.join(heavy, tile, "left_anti")
        done = light if done is None else done.unionByName(light)
        parent = [F.floor(F.col(c) / TILE_CUT).alias(f"p_{c}") for c in ("i", "j")]
        finer = _tiles(level.join(heavy, tile, "left_semi").drop("i", "j").distinct().withColumn("w", F.col("w") / TILE_CUT))
        # Only tiles within the heavy ones; the others hold these edges in tiles that stay.
        held = heavy.select(*ring, (F.col("w") / TILE_CUT).alias("w"), F.col("i").alias("p_i"), F.col("j").alias("p_j"))
        level = _staged(finer.select("*", *parent).join(held, [*ring, "w", "p_i", "p_j"], "left_semi").drop("p_i", "p_j"), "ring-tiles")
    return level if done is None else done.unionByName(level)


def crossed_rings(edges: DataFrame, rings: DataFrame, most: int = TILE_EDGES) -> DataFrame:
    """(species_key, feature) of rings two of whose edges meet other than in the vertex between them; ``rings`` is
    the staged :func:`ring_sizes`.  A ring of up to ``most`` edges is one tile."""
    ring = ["species_key", "feature"]
    e = edges.where(is_finite("x1") & is_finite("y1") & is_finite("x2") & is_finite("y2"))
    e = e.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))).select(*ring, "seq", "x1", "y1", "x2", "y2")
    large = rings.where(F.col("finite") & (F.col("edges") > most))

    def pairs(edges: DataFrame, tile: list[str]) -> DataFrame:
        first = edges.select(*tile, F.col("seq").alias("eseq"), *[F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")])
        second = edges.select(*tile, F.col("seq").alias("fseq"), *[F.col(c).alias(f"f{c}") for c in ("x1", "y1", "x2", "y2")])
        return first.join(second, tile).where((F.col("eseq") < F.col("fseq")) & _meet()).select(*ring)

    if large.isEmpty():
        return pairs(e, ring).distinct()
    few = e.join(large.select(*ring), ring, "left_anti")
    return pairs(few, ring).unionByName(pairs(_tiled(e, large, most), [*ring, "w", "i", "j"])).distinct()


def ring_checks(edges: DataFrame, rings: DataFrame | None = None) -> DataFrame:
    """Per (species, feature): edge count, finite coordinates, closed ring, simple ring, valid (and ``turn``, see
    :func:`ring_sizes`, whose staged result may be given).

    Closure is tested without ordering: in a closed ring every vertex is the
    start of as many edges as it is the end of.
    """
    rings = rings if rings is not None else _staged(ring_sizes(edges), "rings")
    ring = ["species_key", "feature"]
    ends = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(d).alias("d")) for x, y, d in (("x1", "y1", 1), ("x2", "y2", -1))])
    vertices = edges.select(*ring, F.inline(ends)).groupBy(*ring, "x", "y").agg(F.sum("d").alias("b")).where(F.col("b") != 0)
    # The findings on a ring meet in one group.
    found = vertices.select(*ring, F.lit(True).alias("open"), F.lit(None).cast("boolean").alias("crossed"))
    found = found.unionByName(crossed_rings(edges, rings).select(*ring, F.lit(None).cast("boolean").alias("open"), F.lit(True).alias("crossed")))
    found = found.groupBy(*ring).agg(F.bool_or("open").alias("open"), F.bool_or("crossed").alias("crossed"))
    out = rings.join(found, ring, "left")
    closed, simple = F.col("open").isNull(), F.col("crossed").isNull()
    return out.select(*ring, "edges", "finite", closed.alias("closed"), simple.alias("simple"),
                      ((F.col("edges") >= 3) & F.col("finite") & closed & simple).alias("valid"), "turn")


def polygon_status(edges: DataFrame, rings: DataFrame | None = None) -> DataFrame:
    """Per species: ``invalid_geometry`` (some feature fails the ring checks), ``geometry_error`` (sound rings without
    an area, whose sides can't be told), else ``ready``."""
    per = ring_checks(edges, rings).groupBy("species_key").agg(
        F.bool_and("valid").alias("__ok"), F.bool_and(F.col("turn").isNotNull()).alias("__sided"), F.count(F.lit(1)).alias("features"))
    status = F.when(~F.col("__ok"), "invalid_geometry").when(~F.col("__sided"), "geometry_error").otherwise("ready")
    return per.select("species_key", "features", status.alias("buffer_status"))


# --- union --------------------------------------------------------------------------------

def boundary_intervals(edges: DataFrame, rings: DataFrame) -> DataFrame:
    """Adds ``vertical`` and ``outer``: the closed intervals of the edge, in x (in y if vertical), that are boundary of the
    union; null: all of it."""
    steep = F.col("x1") == F.col("x2")
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    t1, t2 = F.when(steep, F.col("y1")).otherwise(F.col("x1")), F.when(steep, F.col("y2")).otherwise(F.col("x2"))
    # With every ring turned the same way round, the two sides of a line show as the two directions along it.
    seg = edges.join(rings.select("species_key", "feature", "turn"), ["species_key", "feature"]).withColumns({
        "vertical": steep, "slope": F.when(~steep, F.round(slope, 12)),
        "icept": F.when(steep, F.col("x1")).otherwise(F.round(F.col("y1") - slope * F.col("x1"), 9)),
        "t1": F.least(t1, t2), "t2": F.greatest(t1, t2), "side": F.col("turn") * F.when(t1 < t2, 1).otherwise(-1)}).drop("turn")
    line = ["species_key", "vertical", "slope", "icept"]
    both = seg.groupBy(*line).agg(F.min("side").alias("s1"), F.max("side").alias("s2")).where(F.col("s1") < F.col("s2")).drop("s1", "s2")
    both = both.select(*[F.col(c).alias(f"b_{c}") for c in line])
    same_line = [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in line]
    # Few lines have features on both of their sides; the rest of the work is on these.
    shared = _staged(seg.join(both, same_line, "left_semi").select(*line, "feature", "seq", "t1", "t2", "side"), "polygon-shared")
    out = seg.select(*edges.columns, "vertical")
    if shared.isEmpty():
        return out.withColumn("outer", F.lit(None).cast("array<struct<a:double,b:double>>"))
    # The sweep: features that begin and end on either side at each end of an edge.
    ends = shared.select(*line, "side", F.explode(F.array(F.struct(F.col("t1").alias("t"), F.lit(1).alias("d")),
                                                          F.struct(F.col("t2").alias("t"), F.lit(-1).alias("d")))).alias("at"))
    steps = ends.groupBy(*line, F.col("at.t").alias("t")).agg(F.sum(F.when(F.col("side") > 0, F.col("at.d")).otherwise(0)).alias("up"),
                                                             F.sum(F.when(F.col("side") < 0, F.col("at.d")).otherwise(0)).alias("down"))
    along = Window.partitionBy(*line).orderBy("t")
    steps = steps.withColumns({"b": F.lead("t").over(along), "covered": (F.sum("up").over(along) > 0) & (F.sum("down").over(along) > 0)})
    steps = steps.withColumn("run", F.sum(F.when(F.col("covered"), 0).otherwise(1)).over(along))
    runs = steps.where("covered").groupBy(*line, "run").agg(F.min("t").alias("a"), F.max("b").alias("b"))

    def spread(df: DataFrame, lo: str, hi: str) -> DataFrame:
        """By stretches of ten degrees, so that a line with many edges is no single group."""
        return df.withColumn("part", F.explode(F.sequence(F.floor(F.col(lo) / 10), F.floor(F.col(hi) / 10))))

    e = spread(shared.select(*line, "feature", "seq", "t1", "t2"), "t1", "t2")
    r = spread(runs.select(*[F.col(c).alias(f"r_{c}") for c in line], "a", "b"), "a", "b").withColumnRenamed("part", "r_part")
    met = e.join(r, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in line] + [F.col("part") == F.col("r_part")])
    met = met.where((F.col("a") < F.col("t2")) & (F.col("b") > F.col("t1")))
    cut = met.groupBy("species_key", "feature", "seq", "t1", "t2").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("runs"))
    starts = F.concat(F.array("t1"), F.transform("runs", lambda x: x["b"]))
    stops = F.concat(F.transform("runs", lambda x: x["a"]), F.array("t2"))
    gaps = F.filter(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda x: x["a"] < x["b"])
    outer = cut.select("species_key", "feature", "seq", gaps.alias("outer"))
    return out.join(outer, ["species_key", "feature", "seq"], "left")


# --- cover --------------------------------------------------------------------------------

def _row(y: Column, h: float) -> Column:
    return F.floor(y / F.lit(h)).cast("long")


def edge_rows(edges: DataFrame, h: float) -> DataFrame:
    """Edges in each latitude row that they touch."""
    return edges.withColumn("row", F.explode(F.sequence(_row(F.least("y1", "y2"), h), _row(F.greatest("y1", "y2"), h))))


def tile_cover(rows: DataFrame, h: float) -> DataFrame:
    """(species_key, row, mixed, inside): runs (c0, c1) of square tiles of side ``h``; mixed ones an edge touches.

    A tile that no edge touches lies wholly in a feature or wholly out of it: its centre tells, by the crossings of the
    row's middle with the feature's edges.  Runs are far fewer than tiles, and bounded by the tiles of a row.
    """
    flat = F.col("y1") == F.col("y2")
    lo = F.greatest(F.least("y1", "y2"), F.col("row") * F.lit(h))
    hi = F.least(F.greatest("y1", "y2"), (F.col("row") + 1) * F.lit(h))
    a, b = F.when(flat, F.col("x1")).otherwise(_x_at(lo)), F.when(flat, F.col("x2")).otherwise(_x_at(hi))
    run = F.struct(F.floor((F.least(a, b) - EPS) / h).alias("c0"), F.floor((F.greatest(a, b) + EPS) / h).alias("c1"))
    middle = (F.col("row") + 0.5) * h
    crossing = F.when((F.col("y1") > middle) != (F.col("y2") > middle), _x_at(middle))
    per = rows.groupBy("species_key", "feature", "row").agg(F.collect_set(run).alias("m"), F.array_sort(F.collect_list(crossing)).alias("xs"))
    between = F.transform(F.filter(F.sequence(F.lit(0), F.size("xs") - 2), lambda i: (i % 2 == 0) & (F.size("xs") > 1)), lambda i: F.struct(
        (F.floor(F.get("xs", i) / h - 0.5) + 1).alias("c0"), (F.ceil(F.get("xs", i + 1) / h - 0.5) - 1).alias("c1")))
    between = F.when(F.size("xs") > 1, between).otherwise(F.array().cast("array<struct<c0:bigint,c1:bigint>>"))
    per = per.withColumn("r", F.filter(between, lambda x: x["c0"] <= x["c1"]))
    return per.groupBy("species_key", "row").agg(F.array_distinct(F.flatten(F.collect_list("m"))).alias("mixed"),
                                                 F.array_distinct(F.flatten(F.collect_list("r"))).alias("inside"))


# --- decisions ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Prepared:
    """What the decisions need of an edge table, each written: status per species, edges by latitude row with their
    boundary intervals, and the tile cover."""
    status: DataFrame
    rows: DataFrame
    cover: DataFrame
    band: float


def prepare(edges: DataFrame, band: float = BAND_DEGREES) -> Prepared:
    """Check, node and tile the polygons once for any number of point tables."""
    rings = _staged(ring_sizes(edges), "rings")
    status = _staged(polygon_status(edges, rings).select("species_key", "buffer_status"), "polygon-status")
    # Only species with sound rings are unfolded: one bad vertex concerns its species alone.
    sound = edges.join(status.where(F.col("buffer_status") == "ready").select("species_key"), "species_key", "left_semi")
    rows = _staged(edge_rows(boundary_intervals(sound.select("species_key", "feature", "seq", "x1", "y1", "x2", "y2"), rings), band), "polygon-edges")
    return Prepared(status, rows, _staged(tile_cover(rows, band), "polygon-cover"), band)


def polygon_decide(points: DataFrame, edges: DataFrame | None, band: float = BAND_DEGREES,
                   hot_rows: int = DEFAULT_HOT_ROWS, row_id: str = "source_row", prepared: Prepared | None = None) -> DataFrame:
    """Decisions per point: source_row, species_key, buffer_status,
    buffer_inside, buffer_boundary (both false unless the status is ready)."""
    ready = prepared or prepare(edges, band)
    status, rows, cover, band = ready.status, ready.rows, ready.cover, ready.band
    p = points.select(row_id, "species_key", "lon", "lat", _row(F.col("lat"), band).alias("row"))
    p = p.join(status, "species_key", "left").join(cover, ["species_key", "row"], "left")
    tile = F.floor(F.col("lon") / F.lit(band))

    def among(runs: str) -> Column:
        return F.coalesce(F.exists(runs, lambda r: (r["c0"] <= tile) & (tile <= r["c1"])), F.lit(False))

    p = p.select(row_id, "species_key", "lon", "lat", "row", F.coalesce("buffer_status", F.lit("missing_buffer")).alias("buffer_status"),
                 among("mixed").alias("__mixed"), among("inside").alias("__inside"))
    p = _staged(p, "polygon-points")  # read four times below
    pure = p.where(~F.col("__mixed")).select(row_id, "species_key", "buffer_status", F.col("__inside").alias("buffer_inside"), F.lit(False).alias("buffer_boundary"))

    m = p.where("__mixed").select(row_id, "species_key", "lon", "lat", "row")
    counts = m.groupBy("species_key", "row").agg(F.count(F.lit(1)).alias("__points"))
    j = join_group_stats(m, rows, ["species_key", "row"], "__points", row_id, hot_rows=hot_rows, sizes=counts)
    x, y = F.col("lon"), F.col("lat")
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    crosses = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    on_seg = (((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)) == 0) & (x >= F.least(x1, x2)) & (
        x <= F.greatest(x1, x2)) & (y >= F.least(y1, y2)) & (y <= F.greatest(y1, y2))
    t = F.when(F.col("vertical"), y).otherwise(x)
    on_outer = on_seg & F.coalesce(F.exists("outer", lambda s: (s["a"] <= t) & (t <= s["b"])), F.lit(True))
    per_feature = j.groupBy(row_id, "species_key", "feature").agg(
        F.sum(F.when(crosses, 1).otherwise(0)).alias("__cross"), F.bool_or(on_seg).alias("__on"), F.bool_or(on_outer).alias("__on_outer"))
    per_feature = per_feature.withColumn("__in", (F.col("__cross") % 2 == 1) & ~F.col("__on"))
    per_point = per_feature.groupBy(row_id, "species_key").agg(
        (F.bool_or("__in") | (F.bool_or("__on") & ~F.bool_or("__on_outer"))).alias("__inside"), F.bool_or("__on").alias("__edge"))
    mixed = per_point.select(row_id, "species_key", F.lit("ready").alias("buffer_status"), F.col("__inside").alias("buffer_inside"),
                             (~F.col("__inside") & F.col("__edge")).alias("buffer_boundary"))
    return pure.unionByName(mixed)


def polygon_counts(decisions: DataFrame, n: int = 15) -> DataFrame:
    """Per species: status, input / inside / boundary / outside rows, retained."""
    g = decisions.groupBy("species_key").agg(
        F.first("buffer_status").alias("status"), F.count(F.lit(1)).alias("input_rows"),
        F.count_if("buffer_inside").alias("inside_rows"), F.count_if("buffer_boundary").alias("boundary_rows"),
        F.count_if(~F.col("buffer_inside") & ~F.col("buffer_boundary")).alias("__outside"))
    return g.select("species_key", "status", "input_rows", "inside_rows", "boundary_rows",
                    F.when(F.col("status") == "ready", F.col("__outside")).alias("outside_rows"),
                    ((F.col("status") == "ready") & (F.col("inside_rows") >= n)).alias("retained_ge15"))


def point_place() -> Column:
    """Where a point lies: unknown (no usable polygon), inside, boundary or outside."""
    on = F.when(F.col("buffer_inside"), "inside").when(F.col("buffer_boundary"), "boundary").otherwise("outside")
    return F.when(F.col("buffer_status") == "ready", on).otherwise("unknown")


def spatial_route(decisions: DataFrame, n: int = 15, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Five routes; the threshold counts inside rows per species.  The decisions are made once, then counted and joined."""
    from .route import route
    decisions = _staged(decisions, "polygon-decisions")
    counts = decisions.groupBy("species_key").agg(F.count_if("buffer_inside").alias("spatial_records"),
                                                   F.count(F.lit(1)).alias("__rows"))
    j = join_group_stats(decisions, counts, ["species_key"], "__rows", "source_row", hot_rows=hot_rows).drop("__rows")
    enough = F.col("spatial_records") >= n
    return j.withColumn("__place", point_place()).transform(lambda d: route(d, [
        ("review_missing_buffer", F.col("__place") == "unknown"), ("outside_buffer", F.col("__place") == "outside"),
        ("boundary_excluded", F.col("__place") == "boundary"), ("accepted", (F.col("__place") == "inside") & enough),
        ("below_threshold", (F.col("__place") == "inside") & ~enough)])).drop("__place")
