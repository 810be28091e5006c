"""SimHash near-dedup through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments.  If two fingerprints differ in
at most two bits, one of the segments differs in at most one bit, so with the
right bit of it made a wildcard both show the same variant.  Every distinct
fingerprint is indexed under its 64 one-wildcard segment variants; rows with
equal variants are joined and verified by their bit distance.

Exact copies are one fingerprint.  A bucket (variant) with more than
``MOST_IN_BUCKET`` fingerprints is not paired: its fingerprints are indexed
again with two wildcards over all 64 bits.  Fingerprints equal under two
wildcards lie within two bits of each other and at most four share such a key,
so those links need no pairing and no check, and the links are the same.
Components come from alternating star contraction.

The fingerprints are computed in Arrow batches (a document at a time); all
the rest is joins and grouping of 8-byte values.

Defined cases: a null or empty text has fingerprint zero and links like any
other; a null ``doc_id`` is never the smallest id unless alone; repeated rows
give repeated result rows; an empty table gives an empty result; further
columns are ignored by :func:`components` and kept by :func:`representatives`.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage_table, text_of

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, MAX_BITS, SEED = 3, 2, 42
MOST_IN_BUCKET = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = min(shingle, len(words)) - 1
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65_536):  # a very long text in pieces
        hashes = np.fromiter((xxh64_intdigest(line[starts[i]:ends[i + last]], SEED) for i in range(lo, min(n, lo + 65_536))), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_hash, fp) for every row; the hash tells rows of one id apart."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("row_hash"), text_of(text_col).alias("t"))

    @F.arrow_udf("long")
    def fp(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return rows.select("doc_id", "row_hash", fp("t").alias("fp"))


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): the 64 one-wildcard variants of the two 32-bit segments.  A key packs
    the wildcard's place (which tells the segment) and the segment without that bit."""
    places = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place")
    half = F.when(F.col("place") < 32, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    clear = F.expr("~shiftleft(1L, place % 32)")
    key = F.col("place").cast("long") * F.lit(1 << 32) + half.bitwiseAND(clear)
    return fps.select("fp", places).select(key.alias("key"), "fp")


def _near(held: DataFrame, max_bits: int) -> DataFrame:
    """Verified pairs (a, b) within the sorted arrays ``f``."""
    one = held.select("f", F.posexplode("f").alias("i", "a"))
    near = F.filter(F.slice(F.col("f"), F.col("i") + 2, F.size("f")), lambda b: F.bit_count(F.col("a").bitwiseXOR(b)) <= max_bits)
    return one.select("a", F.explode(near).alias("b")).distinct()


def _links_in_small(shared: DataFrame, max_bits: int, most: int) -> DataFrame:
    """Pairs within buckets of 2 to ``most`` fingerprints."""
    held = shared.where(F.col("n") <= most).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("f"))
    return _near(held, max_bits)


def _links_in_large(shared: DataFrame, max_bits: int, most: int) -> DataFrame:
    """Links of fingerprints in larger buckets: equal under two wildcards."""
    fps = shared.where(F.col("n") > most).select("fp").distinct()
    masks = F.explode(F.expr("flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), "
                             "j -> named_struct('i', i, 'j', j))))")).alias("w")
    free = F.expr("~(shiftleft(1L, w.i) | shiftleft(1L, w.j))")
    keyed = fps.select("fp", masks).select("fp", F.expr("w.i * 64 + w.j").alias("pair"), F.col("fp").bitwiseAND(free).alias("masked"))
    held = keyed.groupBy("pair", "masked").agg(F.sort_array(F.collect_set("fp")).alias("f")).where(F.size("f") > 1)  # at most four
    return _near(held, max_bits)


def links(fps: DataFrame, max_bits: int = MAX_BITS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within ``max_bits`` (at most 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with one wildcard find distances up to 2")
    index = variants(fps)
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stage_table(sizes, "bucket-sizes").withColumnRenamed("key", "s_key").hint("merge")
    # The entries of buckets that hold more than one fingerprint.
    shared = stage_table(index.join(sizes, F.col("key") == F.col("s_key")).select("key", "n", "fp"), "shared-buckets")
    return _links_in_small(shared, max_bits, most).unionByName(_links_in_large(shared, max_bits, most))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): star contraction.  Each round hangs every neighbourhood on
    its least node, first the larger neighbours, then all smaller ones; the
    components are stars when a round changes nothing."""
    edges = stage_table(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: larger neighbours of x go to the least of x and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).toDF("x", "m")
        large = (both.where("v > u").join(least, F.col("u") == F.col("x"))
                 .select(F.col("m").alias("u"), "v").where("u <> v").distinct())
        large = stage_table(large, "large-star")
        # Small star: smaller neighbours of x, and x, go to the least of them.
        least = large.groupBy("v").agg(F.min("u").alias("m")).toDF("x", "m")
        small = (large.join(least, F.col("v") == F.col("x")).select(F.col("m").alias("p"), "u", "v"))
        small = (small.select(F.explode(F.array(F.struct(F.col("p").alias("u"), F.col("u").alias("v")), F.struct(F.col("p").alias("u"), F.col("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        edges = stage_table(small, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = now


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """One row per input row: doc_id, row_hash, fp, component_id (the smallest id reachable)."""
    rows = stage_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected(links(fps.select("fp"), max_bits, most))
    placed = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    placed = stage_table(placed, "placed-fingerprints")
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "c_root")
    of = placed.join(least, F.col("root") == F.col("c_root")).select(F.col("fp").alias("c_fp"), "component_id")
    # A fingerprint may hold a third of all rows: AQE splits such a partition of this join.
    return rows.join(of, F.col("fp") == F.col("c_fp")).select("doc_id", "row_hash", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (of repeated rows, one).
    Rows without an id stay only if their component has none."""
    keep = (components(docs, id_col, text_col, shingle, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("keep_id"), F.col("row_hash").alias("keep_hash")).distinct())
    keep = stage_table(keep, "kept-rows")
    names = docs.columns
    h = fresh("_row", names)
    stays = (docs.withColumn(h, F.xxhash64(text_of(text_col)))
             .join(keep, F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col(h) == F.col("keep_hash")), "left_semi"))
    return stays.dropDuplicates([id_col, h]).select(*names)
