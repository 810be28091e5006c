"""Layered grids: raster catalog, nearest layer, cell sampling, masks.

Rasters arrive as tables: ``pixels(variable, year, layer, row, col, value)``
(NULL value = nodata cell) and a catalog of file names.  A north-up grid is
described by its origin and cell size (``GridSpec``); width and height are
read from the pixel table.

Sampling is relational: pixels lie in tiles, arrays of cells keyed by (family,
year, layer, square of the earth) with one cell more to every side.  A point
joins the tiles of its two layers and reads its values and 3×3 windows by
index, each raster by its own transform, size and nodata value; it does not
carry a tile on to the next join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import is_finite
from .identity import with_position

# Fixed values of the environment rules.
VARIABLES = ["thetao", "so", "chl", "no3", "o2"]          # bit i of the masks is VARIABLES[i]
PHY_VARIABLES = ["thetao", "so"]                          # sampled at the physical layer
FILE_PATTERN = r"^([A-Za-z0-9]+)_(\d{4})_L(\d+)_([\d.]+)m\.tif$"


@dataclass(frozen=True)
class GridSpec:
    """North-up affine grid: x = c + col * a, y = f + row * e (e < 0)."""
    c: float = -180.0
    a: float = 36.0
    f: float = 80.0
    e: float = -20.0
    nodata: float | None = None


def variable_family(v: Column) -> Column:
    return F.when(v.isin(PHY_VARIABLES), F.lit("phy")).otherwise(F.lit("bgc"))


# --- catalog -------------------------------------------------------------------------------

def raster_catalog(files: DataFrame, name_col: str = "file_name", folder_col: str = "folder") -> DataFrame:
    """Parse ``<variable>_<yyyy>_L<layer>_<depth>m.tif``; ``recognized`` is
    false for names that do not match the pattern of their folder."""
    n = F.col(name_col)
    var = F.regexp_extract(n, FILE_PATTERN, 1)
    ok = n.rlike(FILE_PATTERN) & (var == F.col(folder_col))
    return files.select(
        n.alias("file_name"), F.col(folder_col).alias("folder"),
        F.when(ok, var).alias("variable"),
        F.when(ok, F.regexp_extract(n, FILE_PATTERN, 2).cast("int")).alias("year"),
        F.when(ok, F.regexp_extract(n, FILE_PATTERN, 3).cast("int")).alias("layer"),
        F.when(ok, F.regexp_extract(n, FILE_PATTERN, 4).cast("double")).alias("filename_depth"),
        ok.alias("recognized"))


def missing_grid_keys(catalog: DataFrame, years: tuple[int, int], layers: tuple[int, int]) -> DataFrame:
    """Expected (year, layer) grid per folder minus the recognised keys.

    The expected grid is generated per folder with ``explode(sequence)``, so
    it grows with the number of folders only.
    """
    folders = catalog.select("folder").distinct()
    exp = (folders.withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))
           .withColumn("layer", F.explode(F.sequence(F.lit(layers[0]), F.lit(layers[1])))))
    have = catalog.where("recognized").select(F.col("variable").alias("folder"), "year", "layer")
    return exp.join(have, ["folder", "year", "layer"], "left_anti").withColumnRenamed("folder", "variable")


def varying_depths(catalog: DataFrame) -> DataFrame:
    """Layers whose file names state more than one depth, and duplicate keys."""
    c = catalog.where("recognized")
    per_layer = c.groupBy("variable", "layer").agg(F.count_distinct("filename_depth").alias("depths"))
    return per_layer.where(F.col("depths") > 1)


def duplicate_keys(catalog: DataFrame) -> DataFrame:
    c = catalog.where("recognized")
    return c.groupBy("variable", "year", "layer").agg(F.count(F.lit(1)).alias("files")).where(F.col("files") > 1)


# --- headers and pixel statistics -----------------------------------------------------------

def raster_headers(pixels: DataFrame) -> DataFrame:
    """Per raster: width, height, cells, nodata cells (from the pixel table)."""
    return pixels.groupBy("variable", "year", "layer").agg(
        (F.max("col") + 1).alias("width"), (F.max("row") + 1).alias("height"),
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value").isNull()).alias("nodata_cells"))


def grid_consistency(headers: DataFrame) -> DataFrame:
    """Each raster's grid against the reference grid (the first raster by
    variable order, year, layer).  The reference is one row, broadcast."""
    order = F.array_position(F.array(*[F.lit(v) for v in VARIABLES]), F.col("variable"))
    ref = headers.agg(F.min_by(F.struct("width", "height"), F.struct(order, "year", "layer")).alias("ref"))
    j = headers.join(F.broadcast(ref), how="inner")
    return j.select("variable", "year", "layer", "width", "height",
                    ((F.col("width") == F.col("ref.width")) & (F.col("height") == F.col("ref.height")))
                    .alias("grid_matches_reference"))


def pixel_stats(pixels: DataFrame) -> DataFrame:
    v = F.col("value")
    return pixels.groupBy("variable", "year", "layer").agg(
        F.count_if(v == -1).alias("n_minus1"), F.count_if(v == 0).alias("n_zero"),
        F.count_if(v < -1).alias("n_negative_other"),
        F.min(F.when(v != -1, v)).alias("min_except_minus1"),
        F.max(F.when(v != -1, v)).alias("max_except_minus1"))


def cell_center(spec: GridSpec, row: Column, col: Column) -> tuple[Column, Column]:
    return (F.lit(spec.c) + (col + 0.5) * spec.a, F.lit(spec.f) + (row + 0.5) * spec.e)


def sentinel_conflicts(pixels: DataFrame, spec: GridSpec, a: str = "thetao", b: str = "so") -> DataFrame:
    """Cells where variable ``a`` is −1 and ``b`` is not, with cell centres.

    The two variables meet through one aggregate on the cell key (a pivot),
    not a self join.
    """
    cell = pixels.where(F.col("variable").isin(a, b)).groupBy("year", "layer", "row", "col").agg(
        F.max(F.when(F.col("variable") == a, F.col("value"))).alias(a),
        F.max(F.when(F.col("variable") == b, F.col("value"))).alias(b),
        F.count_if(F.col("variable") == a).alias("__na"), F.count_if(F.col("variable") == b).alias("__nb"))
    hit = cell.where((F.col("__na") > 0) & (F.col("__nb") > 0) & (F.col(a) == -1)
                     & F.coalesce(F.col(b) != -1, F.lit(True)))
    x, y = cell_center(spec, F.col("row"), F.col("col"))
    return hit.select("year", "layer", "row", "col", x.alias("lon"), y.alias("lat"), F.col(b))


# --- nearest layer --------------------------------------------------------------------------

LAYER_FAN = 64


def layer_tree(layers: DataFrame, depth_cols: dict[str, str], fan: int = LAYER_FAN) -> DataFrame:
    """(family, level, node, last_node, items): the layers of each family in depth order, cut at exact quantiles.

    Every ``fan`` layers in a row are a node of level 0, which also holds the edge layers of both neighbours, so the
    layer nearest to any depth of its range is in it.  Every ``fan`` nodes in a row are a node of the next level, which
    holds where they begin, up to one node.  Positions come from a range-partitioned sort, so no task holds all
    layers, and no node more than ``fan`` + 2, however uneven the depths.
    """
    rows = None
    for family, col in depth_cols.items():
        d = layers.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("d")).agg(F.min("layer").alias("l"))
        d = d.select(F.lit(family).alias("family"), "d", "l")
        rows = d if rows is None else rows.unionByName(d)
    placed = with_position(rows, ["family", "d"], "pos")
    spans = placed.groupBy("family").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    placed = placed.join(F.broadcast(spans), "family").withColumn("pos", F.col("pos") - F.col("first"))  # one row per family
    largest = spans.agg(F.max("n")).first()[0] or 0
    node, at, last = F.floor(F.col("pos") / fan), F.col("pos") % fan, F.floor((F.col("n") - 1) / fan)
    held = F.array(node, F.when(at == 0, node - 1), F.when(at == fan - 1, node + 1))
    held = F.filter(held, lambda x: (x >= 0) & (x <= last))
    entries = placed.select("family", F.lit(0).alias("level"), F.explode(held).alias("node"), F.struct("d", "l").alias("item"))
    width, level = fan, 1
    while width < largest:
        entries = entries.unionByName(placed.where(F.col("pos") % width == 0).select(
            "family", F.lit(level).alias("level"), F.floor(F.col("pos") / (width * fan)).alias("node"), F.struct("d", "l").alias("item")))
        width, level = width * fan, level + 1
    return entries.groupBy("family", "level", "node").agg(F.array_sort(F.collect_list("item")).alias("items"))


def nearest_layer(z: Column, candidates: Column) -> Column:
    """Layer whose depth is nearest to ``z``; ties go to the lowest layer
    (struct ordering on (distance, layer))."""
    best = F.array_min(F.transform(candidates, lambda s: F.struct(F.abs(z - s["d"]).alias("dist"), s["l"].alias("layer"))))
    return F.when(z.isNotNull(), best["layer"])


def assign_layers(points: DataFrame, layers: DataFrame, z: str = "depth_final", fan: int = LAYER_FAN) -> DataFrame:
    """Adds ``phy_layer`` and ``bgc_layer``: a depth goes down the levels of its family's tree by equi-joins.  The
    tree is written first, so the planner knows its bytes and broadcasts it if small."""
    from ..session import scratch_path
    path = scratch_path(points.sparkSession, "layer-tree")
    layer_tree(layers, {f: f"{f}_depth" for f in ("phy", "bgc")}, fan).write.parquet(path)
    tree = points.sparkSession.read.parquet(path)
    top = {r["family"]: r["top"] for r in tree.groupBy("family").agg(F.max("level").alias("top")).collect()}  # two rows
    out = points
    for family in ("phy", "bgc"):
        out = out.withColumn("__node", F.when(F.col(z).isNotNull(), F.lit(0)).cast("long"))
        for level in range(top.get(family, 0), -1, -1):
            nodes = tree.where((F.col("family") == family) & (F.col("level") == level)).select(F.col("node").alias("__held"), "items")
            out = out.join(nodes, F.col("__node") == F.col("__held"), "left")
            if level:  # the last child that does not begin below the depth
                child = F.greatest(F.size(F.filter("items", lambda s: s["d"] <= F.col(z))) - 1, F.lit(0))
                out = out.withColumn("__node", F.col("__node") * fan + child).drop("items", "__held")
        out = out.withColumn(f"{family}_layer", nearest_layer(F.col(z), F.col("items")).cast("int")).drop("__node", "__held", "items")
    return out


# --- sampling --------------------------------------------------------------------------------

def cell_of(spec: GridSpec, lon: Column, lat: Column) -> tuple[Column, Column]:
    return (F.floor((lat - F.lit(spec.f)) / F.lit(spec.e)).cast("long"),
            F.floor((lon - F.lit(spec.c)) / F.lit(spec.a)).cast("long"))


#: Cells along a side of a tile.
TILE_CELLS = 16
_HEADER = ["width", "height", "c", "a", "f", "e", "nodata"]


def with_spec(headers: DataFrame, spec: GridSpec) -> DataFrame:
    """Headers that share one transform and nodata value."""
    return headers.withColumns({k: F.lit(getattr(spec, k)).cast("double") for k in ("c", "a", "f", "e", "nodata")})


@dataclass(frozen=True)
class Rasters:
    """Rasters as written tables: the headers and pixel tiles of each (family, year, layer), one column per variable,
    the largest header of each variable, and the side of a tile in degrees."""
    headers: DataFrame
    tiles: DataFrame
    largest: DataFrame
    side: float


def prepare_rasters(pixels: DataFrame, headers: DataFrame, cells: int = TILE_CELLS) -> Rasters:
    """Pixels as tiles: each holds the cells that meet one square of the earth, and one cell more to every side, so a
    point finds its value and its 3x3 window in one row, whatever the rasters' transforms (``headers``: variable, year,
    layer, width, height, c, a, f, e, nodata).  A tile is bounded by its side, ``cells`` cells of the coarsest raster."""
    from ..session import scratch_path
    spark = pixels.sparkSession

    def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.options(**options).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    raster = ["variable", "year", "layer"]
    headers = staged(headers.select(*raster, *_HEADER), "raster-headers")
    coarsest = headers.agg(F.max(F.greatest(F.abs("a"), F.abs("e")))).first()[0]
    side = cells * (coarsest or 1.0)
    family = variable_family(F.col("variable"))
    header = F.struct(*_HEADER)
    wide = headers.groupBy(family.alias("family"), "year", "layer").agg(
        *[F.first(F.when(F.col("variable") == v, header), ignorenulls=True).alias(f"h_{v}") for v in VARIABLES])
    largest = headers.agg(*[F.max_by(F.when(F.col("variable") == v, header), F.when(F.col("variable") == v, F.col("width") * F.col("height"))).alias(f"l_{v}")
                            for v in VARIABLES])
    x, y = F.col("c") + F.col("col") * F.col("a"), F.col("f") + F.col("row") * F.col("e")
    size_x, size_y = F.abs("a"), F.abs("e")

    def squares(at: Column, step: str, size: Column) -> Column:
        low = F.least(at, at + F.col(step)) - size
        return F.explode(F.sequence(F.floor(low / side), F.floor((low + 3 * size) / side)))

    px = pixels.select(*raster, "row", "col", "value").join(headers, raster)
    px = px.withColumn("gx", squares(x, "a", size_x)).withColumn("gy", squares(y, "e", size_y))
    cell = F.struct((F.col("row").cast("long") * F.col("width") + F.col("col")).alias("at"), F.col("value").alias("value"))
    # A cell goes into one list, that of its variable; the few lists of a square then meet.  The cells are dealt first: a
    # list begun in the tasks that read them would hold few cells, and sort as many as such a task reads.
    lists = px.select(*raster, "gx", "gy", cell.alias("cell")).repartition(*raster, "gx", "gy")
    lists = lists.groupBy(*raster, "gx", "gy").agg(F.collect_list("cell").alias("cells"))
    tiles = lists.groupBy(family.alias("family"), "year", "layer", "gx", "gy").agg(
        *[F.flatten(F.collect_list(F.when(F.col("variable") == v, F.col("cells")))).alias(f"t_{v}") for v in VARIABLES])
    # Two arrays side by side: looking up a place does not copy the cells.
    tiles = tiles.withColumns({f"t_{v}": F.struct(F.col(f"t_{v}.at").alias("at"), F.col(f"t_{v}.value").alias("value")) for v in VARIABLES})
    # Headers repeat: plain, their file has the bytes that they take in a join, and only few are broadcast.
    plain = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
    return Rasters(staged(wide, "raster-heads", **plain), staged(tiles, "raster-tiles"), staged(largest, "raster-largest"), side)


class _Cell:
    """Expressions on one variable of a point row whose cell has been located (see :func:`_cells`)."""

    def __init__(self, variable: str):
        self.place, self.row, self.col, self.inside, self.width, self.outside = (
            F.col(f"__{x}_{variable}") for x in ("place", "row", "col", "inside", "width", "outside"))
        self.tile = F.col(f"__t_{variable}")

    def at(self, place: Column | None = None) -> Column:
        """The value at the point's place or at another one of its tile; null where the raster is missing."""
        found = F.array_position(self.tile["at"], self.place if place is None else place)
        return F.get(self.tile["value"], (found - 1).cast("int"))

    def value(self) -> Column:
        return F.when(self.inside, self.at()).otherwise(self.outside)


def _cells(lon: str, lat: str) -> dict[str, Column]:
    """The point's cell in each raster: its place, row and column, whether it is inside (else the value it takes), and the
    raster's width if the 3x3 window is complete."""
    out = {}
    for v in VARIABLES:
        h = F.coalesce(F.col(f"__h_{v}"), F.col(f"l_{v}"))
        row, col = F.floor((F.col(lat) - h["f"]) / h["e"]).cast("long"), F.floor((F.col(lon) - h["c"]) / h["a"]).cast("long")
        inside = F.coalesce((row >= 0) & (row < h["height"]) & (col >= 0) & (col < h["width"]), F.lit(False))
        whole = (row >= 1) & (row <= h["height"] - 2) & (col >= 1) & (col <= h["width"] - 2)
        out |= {f"__place_{v}": F.when(inside, row * h["width"] + col), f"__row_{v}": row, f"__col_{v}": col, f"__inside_{v}": inside,
                f"__width_{v}": F.when(whole, h["width"]), f"__outside_{v}": F.coalesce(h["nodata"], F.lit(0.0))}
    return out


def _read_tiles(points: DataFrame, rasters: Rasters, joins: dict[str, tuple[str, str]], read: Callable[[DataFrame, str, dict[str, _Cell]], DataFrame],
                lon: str, lat: str) -> DataFrame:
    """Points with the columns that ``read`` adds from the headers and tiles of each join: prefix -> (family, layer column).
    Both are joins on (year, layer) and, for tiles, the square of the point; Spark broadcasts small tables and splits skewed
    squares.  Each tile is read where it is met: what the next join sorts are a point's numbers, neither headers, which
    repeat with every point and so are small in a shuffle and large in a sort, nor tiles."""
    p = points
    cells = {v: _Cell(v) for v in VARIABLES}
    for prefix, (family, layer) in joins.items():
        kept = p.columns
        heads = rasters.headers.where(F.col("family") == family)
        heads = heads.select(F.col("year").alias("__y"), F.col("layer").alias("__l"), *[F.col(f"h_{v}").alias(f"__h_{v}") for v in VARIABLES])
        p = p.join(heads, (F.col("year_final") == F.col("__y")) & (F.col(layer) == F.col("__l")), "left")
        p = p.join(F.broadcast(rasters.largest))  # one row
        p = p.select(*kept, F.floor(F.col(lon) / rasters.side).alias("__gx"), F.floor(F.col(lat) / rasters.side).alias("__gy"),
                     *[c.alias(name) for name, c in _cells(lon, lat).items()])
        tiles = rasters.tiles.where(F.col("family") == family)
        tiles = tiles.select(F.col("year").alias("__y"), F.col("layer").alias("__l"), F.col("gx").alias("__tx"), F.col("gy").alias("__ty"),
                             *[F.col(f"t_{v}").alias(f"__t_{v}") for v in VARIABLES])
        working = [c for c in p.columns if c not in kept] + tiles.columns
        p = p.join(tiles, (F.col("year_final") == F.col("__y")) & (F.col(layer) == F.col("__l")) & (F.col("__gx") == F.col("__tx"))
                   & (F.col("__gy") == F.col("__ty")), "left")
        p = read(p, prefix, cells).drop(*working)
    return p


def _joins(mode: str) -> dict[str, tuple[str, str]]:
    bgc = "phy_layer" if mode == "shared_phy" else "bgc_layer"
    return {"p": ("phy", "phy_layer"), "b": ("bgc", bgc)}


def sample_tiles(points: DataFrame, rasters: Rasters, mode: str = "independent", lon: str = "lon", lat: str = "lat",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per point: source_row, both layers, ``keep``, the value of every variable and the masks of variables
    outside their raster and of invalid values.

    mode ``independent``: physical variables use ``phy_layer``, the others
    ``bgc_layer``; mode ``shared_phy``: every variable uses ``phy_layer``.
    Out-of-bounds cells take the raster's nodata value, or 0 when none is declared.  A point whose raster is missing
    is judged by the variable's largest grid and gets a NULL value.
    """
    def read(p: DataFrame, prefix: str, cells: dict[str, _Cell]) -> DataFrame:
        mine = {v: c for v, c in cells.items() if (v in PHY_VARIABLES) == (prefix == "p")}
        return p.withColumns({f"__v_{v}": c.value() for v, c in mine.items()} | {f"__in_{v}": c.inside for v, c in mine.items()})

    p = _read_tiles(points, rasters, _joins(mode), read, lon, lat)
    p = p.select("source_row", "phy_layer", "bgc_layer", *keep, *[F.col(f"__v_{v}").alias(v) for v in VARIABLES], *[f"__in_{v}" for v in VARIABLES])

    def mask(flag) -> Column:
        return sum((F.when(flag(v), F.lit(1 << i)).otherwise(0) for i, v in enumerate(VARIABLES)), F.lit(0)).cast("int")

    return p.select("source_row", "phy_layer", "bgc_layer", *keep, *VARIABLES, mask(lambda v: ~F.col(f"__in_{v}")).alias("environment_outside_mask"),
                    mask(lambda v: (F.col(v) == -1) | ~F.coalesce(is_finite(F.col(v)), F.lit(False))).alias("environment_invalid_mask"))


def sample_long(points: DataFrame, pixels: DataFrame, spec: GridSpec, mode: str = "independent",
                variables=VARIABLES, lon="lon", lat="lat", rasters: Rasters | None = None) -> DataFrame:
    """One row per (point, variable): layer, cell, inside flag and value; the rows of a point are made after its values
    are read."""
    rasters = rasters or prepare_rasters(pixels, with_spec(raster_headers(pixels), spec))

    def read(p: DataFrame, prefix: str, cells: dict[str, _Cell]) -> DataFrame:
        items = {}
        for v, cell in cells.items():
            if v in variables and (v in PHY_VARIABLES) == (prefix == "p"):
                layer = F.col("phy_layer") if mode == "shared_phy" or v in PHY_VARIABLES else F.col("bgc_layer")
                items[f"__i_{v}"] = F.struct(F.lit(v).alias("variable"), layer.alias("layer"), cell.row.alias("row"), cell.col.alias("col"),
                                             F.lit(VARIABLES.index(v)).alias("bit"), cell.inside.alias("inside"), cell.value().cast("double").alias("value"))
        return p.withColumns(items)

    p = _read_tiles(points, rasters, _joins(mode), read, lon, lat)
    return p.select(*[F.col(c).alias("year" if c == "year_final" else c) for c in points.columns],
                    F.inline(F.array(*[F.col(f"__i_{v}") for v in variables])))


def sample_conventions(points: DataFrame, rasters: Rasters, repeated: DataFrame | None = None, lon: str = "lon",
                       lat: str = "lat") -> DataFrame:
    """(source_row, variable, shared_value, independent_value): the value at the physical layer and at the variable's own.
    One row of a point holds its tiles of both, so the two meet without a join on the point.  ``repeated``, if given, names
    the ids that several points bear: of those, each value of the one kind goes with each of the other.  A null id meets
    nothing."""
    def read(p: DataFrame, prefix: str, cells: dict[str, _Cell]) -> DataFrame:
        return p.withColumns({f"__{prefix}_{v}": c.value().cast("double") for v, c in cells.items() if (v in PHY_VARIABLES) == (prefix == "p")})

    p = _read_tiles(points.where(F.col("source_row").isNotNull()), rasters,
                    {"p": ("phy", "phy_layer"), "b": ("bgc", "bgc_layer"), "s": ("bgc", "phy_layer")}, read, lon, lat)
    items = []
    for v in VARIABLES:
        own, shared = ("p", "p") if v in PHY_VARIABLES else ("b", "s")
        items.append(F.struct(F.lit(v).alias("variable"), F.col(f"__{shared}_{v}").alias("shared_value"), F.col(f"__{own}_{v}").alias("independent_value")))
    both = p.select("source_row", F.inline(F.array(*items)))
    if repeated is None:
        return both
    again = both.join(repeated, "source_row", "left_semi")
    pairs = again.select("source_row", "variable", "shared_value").join(
        again.select("source_row", "variable", "independent_value"), ["source_row", "variable"])
    return both.join(repeated, "source_row", "left_anti").unionByName(pairs)


def convention_matches(values: DataFrame) -> DataFrame:
    """Per (source_row, variable): whether the two conventions' values differ (only then does a match tell them apart)
    and which of them the stored value equals.  A NULL matches nothing."""
    shared, own, stored = F.col("shared_value"), F.col("independent_value"), F.col("stored")
    no = F.lit(False)
    return values.select("source_row", "variable", shared, own, stored, F.coalesce(shared != own, no).alias("discriminating"),
                         F.coalesce(shared == stored, no).alias("shared_match"), F.coalesce(own == stored, no).alias("independent_match"))


def sample_wide(long: DataFrame, variables=VARIABLES) -> DataFrame:
    """Pivot per-variable values back to one row per point with the masks."""
    aggs = [F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables]
    bit = F.expr("shiftleft(1, bit)")
    bits_out = F.sum(F.when(~F.col("inside"), bit).otherwise(0))
    bad = (F.col("value") == -1) | ~F.coalesce(is_finite(F.col("value")), F.lit(False))
    bits_bad = F.sum(F.when(bad, bit).otherwise(0))
    return long.groupBy("source_row").agg(
        F.first("phy_layer").alias("phy_layer"), F.first("bgc_layer").alias("bgc_layer"), *aggs,
        bits_out.cast("int").alias("environment_outside_mask"), bits_bad.cast("int").alias("environment_invalid_mask"))


def neighbour_matches(points: DataFrame, rasters: Rasters, variables=("chl", "no3", "o2"), lon: str = "lon", lat: str = "lat") -> DataFrame:
    """3×3 neighbourhood cells (complete windows only), on the physical and on the independent layer of each variable, whose
    value equals the independently sampled one: (source_row, variable, layer, drow, dcol).  The window is read off the
    point's tile; only cells that match become rows."""
    window = F.array(*[F.lit(i) for i in range(9)])  # a cell's number in the 3x3 window, row by row
    drow, dcol = lambda i: F.floor(i / 3).cast("int") - 1, lambda i: i % 3 - 1

    def read(p: DataFrame, prefix: str, cells: dict[str, _Cell]) -> DataFrame:
        if prefix == "b":
            p = p.withColumns({f"__own_{v}": F.when(cells[v].inside, cells[v].at()) for v in variables})
        matches = {}
        for v in variables:
            cell, own = cells[v], F.col(f"__own_{v}")
            whole = cell.width.isNotNull() & own.isNotNull()
            if prefix == "s":
                whole &= F.col("phy_layer") != F.col("bgc_layer")
            same = F.filter(window, lambda i: cell.at(cell.place + drow(i) * cell.width + dcol(i)) == own)  # noqa: B023
            matches[f"__{prefix}_{v}"] = F.when(whole, same).otherwise(F.array().cast("array<int>"))
        return p.withColumns(matches)

    p = _read_tiles(points, rasters, {"b": ("bgc", "bgc_layer"), "s": ("bgc", "phy_layer")}, read, lon, lat)
    found = [F.transform(f"__{prefix}_{v}", lambda i: F.struct(F.lit(v).alias("variable"), F.col(layer).alias("layer"), drow(i).alias("drow"), dcol(i).alias("dcol")))  # noqa: B023
             for v in variables for prefix, layer in (("b", "bgc_layer"), ("s", "phy_layer"))]
    return p.select("source_row", F.inline(F.concat(*found)))
