"""Exact dedup by deterministic block naming.

A normalised text (A-Z lower-cased) is cut into fixed-size blocks.  The
distinct blocks are sorted and numbered; then adjacent names are paired and the
distinct pairs numbered again, level by level, until every document has one
name.  Equal names at equal levels mean equal texts, without any trust in a
hash: names come from grouping whole blocks and whole pairs.

A text crosses the network once, when its blocks are grouped (with map-side
combining, so a block that holds a third of all rows is one row per task).  The
name is then looked up by the block's 64-bit hash wherever that hash belongs to
a single distinct block; blocks of colliding hashes are looked up by the whole
block.

Defined cases: a null text counts as empty; a null ``doc_id`` is the smallest
id; rows repeated with the same id and text share one fate and are counted each
in ``group_size``; an empty table gives an empty result; further columns are
ignored by :func:`groups` and kept by :func:`survivors`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, stage_table, text_of

BLOCK_BYTES = 4096
#: Rows of one text: the id, a hash and the size tell rows of the same id apart.
KEY = ["k_id", "k_hash", "k_size"]


def _same(left: list[str], right: list[str]) -> Column:
    cond = F.col(left[0]).eqNullSafe(F.col(right[0]))
    for a, b in zip(left[1:], right[1:], strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def numbered(distinct: DataFrame, order: list[str], name: str = "name") -> DataFrame:
    """Integers for distinct rows, ascending in ``order``: a range sort, then
    per-partition offsets.  The sorted rows are staged, so that both passes see
    the same partitions even after a lost executor."""
    rows = distinct.sort(*order).select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    rows = stage_table(rows, "names")
    per = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = per.select(F.col("_p").alias("_q"), "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = rows.join(F.broadcast(offsets), F.col("_p") == F.col("_q"))  # at most one row per sort partition
    return out.withColumn(name, F.col("_m") - F.col("_first") + F.col("_off") + 1).drop("_p", "_m", "_q", "_first", "_off")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = ascii_lower(text_of(text_col))
    return (docs.select(F.col(id_col).alias("k_id"), norm.alias("_norm"))
            .select("k_id", F.xxhash64("_norm").alias("k_hash"), F.octet_length("_norm").alias("k_size"), "_norm"))


def _block_names(blocks: DataFrame) -> DataFrame:
    """(KEY, pos, h, block) -> (KEY, pos, name): equal names, equal blocks."""
    distinct = blocks.select("h", "block").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    distinct = stage_table(distinct, "block-hashes")
    single = numbered(distinct.where("n = 1").select("h"), ["h"])
    single = single.select(F.col("h").alias("n_h"), (F.col("name") * 2).alias("name"))
    named = blocks.select(*KEY, "pos", "h").join(single, F.col("h") == F.col("n_h")).select(*KEY, "pos", "name")
    shared = distinct.where("n > 1").select(F.col("h").alias("s_h"))
    if shared.isEmpty():
        return named
    # Hashes that several distinct blocks share: those blocks are numbered as a whole, with odd names.
    odd = blocks.join(stage_table(shared, "shared-hashes"), F.col("h") == F.col("s_h"), "left_semi")
    names = numbered(odd.select("h", "block").distinct(), ["h", "block"])
    names = names.select(F.col("h").alias("n_h"), F.col("block").alias("n_block"), (F.col("name") * 2 + 1).alias("name"))
    odd = odd.join(names, (F.col("h") == F.col("n_h")) & (F.col("block") == F.col("n_block")))
    return named.unionByName(odd.select(*KEY, "pos", "name"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
               block_hash=F.xxhash64) -> DataFrame:
    """KEY -> (level, name): equal identities mean equal texts.  One row per distinct KEY."""
    rows = _keyed(docs, id_col, text_col)
    data = F.encode("_norm", "UTF-8")
    last = F.greatest(F.ceil(F.col("k_size") / block_bytes).cast("int") - 1, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * block_bytes + 1, block_bytes))
    blocks = (rows.select(*KEY, F.posexplode(cut).alias("pos", "block"))
              .select(*KEY, "pos", block_hash("block").alias("h"), "block"))
    named = stage_table(_block_names(blocks), "named-0")
    one = F.col("k_size") <= block_bytes
    level, span = 0, block_bytes
    done = named.where(one).select(*KEY, F.lit(0).alias("level"), "name").dropDuplicates(KEY)
    todo = named.where(~one)
    while not todo.isEmpty():
        # Adjacent names become pairs; 0 stands for a missing right half.
        level, span = level + 1, span * 2
        pair = (todo.groupBy(*KEY, F.expr("pos div 2").alias("pos"))
                .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                     F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("b")))
        pair = stage_table(pair.select(*KEY, F.col("pos").cast("int").alias("pos"), "a", "b"), f"pairs-{level}")
        names = numbered(pair.select("a", "b").distinct(), ["a", "b"]).toDF("n_a", "n_b", "name")
        named = (pair.join(names, (F.col("a") == F.col("n_a")) & (F.col("b") == F.col("n_b"))).select(*KEY, "pos", "name"))
        named = stage_table(named, f"named-{level}")
        one = F.col("k_size") <= span
        done = done.unionByName(named.where(one).select(*KEY, F.lit(level).alias("level"), "name"))
        todo = named.where(~one)
    return done


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    ident = stage_table(identities(docs, id_col, text_col, block_bytes), "identities")
    rows = _keyed(docs, id_col, text_col).select(*KEY, F.sha2("_norm", 256).alias("text_sha256"))
    i = ident.select(*[F.col(k).alias("i_" + k) for k in KEY], "level", "name")
    rows = stage_table(rows.join(i, _same(KEY, ["i_" + k for k in KEY])).select("k_id", "text_sha256", "level", "name"), "row-identities")
    best = rows.groupBy("level", "name").agg(F.max("k_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    best = stage_table(best.withColumnsRenamed({"level": "g_level", "name": "g_name"}), "text-groups")
    # A group may hold a third of all rows: AQE splits such a partition of this join.
    out = rows.join(best, (F.col("level") == F.col("g_level")) & (F.col("name") == F.col("g_name")))
    return out.select(F.col("k_id").alias("doc_id"), "keep_id", "group_size",
                      F.col("k_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the largest id (of repeated rows, one)."""
    ident = stage_table(identities(docs, id_col, text_col, block_bytes), "identities")
    best = ident.groupBy("level", "name").agg(F.max(F.struct(*KEY)).alias("k")).select("k.*")
    names = docs.columns
    own = {k: fresh("_" + k, names) for k in KEY}
    norm = ascii_lower(text_of(text_col))
    rows = docs.select("*", F.xxhash64(norm).alias(own["k_hash"]), F.octet_length(norm).alias(own["k_size"]))
    joined = rows.join(best, F.col(id_col).eqNullSafe(F.col("k_id")) & (F.col(own["k_hash"]) == F.col("k_hash"))
                       & (F.col(own["k_size"]) == F.col("k_size")), "left_semi")
    return joined.dropDuplicates([id_col, own["k_hash"], own["k_size"]]).select(*names)
