"""Shards by a hierarchical weighted hash tree.

A topology is a list of (region, rack, shard, weight).  A document descends
it: at each level every child makes a draw ``-ln(u) / weight`` from a hash of
the document id and the child's name, and the least draw wins, so a child
wins with probability weight / total.  A node's draw depends on its own
name and weight alone; changing a weight moves documents only between the
changed subtree and the rest, never between unchanged siblings.  A shard that
joins as a subtree of its own takes documents only into itself.

Only DataFrame functions are used.  The law of the query is ``key``.

Defined cases: a null ``doc_id`` is one key, like any other; null and empty
texts have size 1; repeated rows get slots of their own; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, stage_table, text_of

REGIONS, RACKS, PER_RACK = 2, 2, 4
BASE_SHARDS = REGIONS * RACKS * PER_RACK


def topology(shards: int) -> list[tuple[str, str, int, float]]:
    """Up to 16 shards: two regions of two racks of four; each further one joins as a region of its own."""
    tree = []
    for s in range(shards):
        rack = s // PER_RACK
        home = (f"region{rack // RACKS}", f"rack{rack}") if s < BASE_SHARDS else (f"region-s{s}", f"rack-s{s}")
        tree.append((*home, s, 1.0))
    return tree


def draw(key: Column, node: str, weight: float, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(node), key), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 53))
    return -F.log(u) / F.lit(float(weight))


def _least(key: Column, nodes: list[tuple[str, float, Column]], seed: int) -> Column:
    """The value of the child with the least draw (ties: the smaller value)."""
    if len(nodes) == 1:
        return nodes[0][2]
    return F.array_min(F.array(*[F.struct(draw(key, n, w, seed).alias("d"), v.alias("v")) for n, w, v in nodes]))["v"]


def descend(key: Column, tree: list[tuple[str, str, int, float]], seed: int = 11) -> Column:
    """The shard: region, then rack, then shard by weighted draws."""
    def total(depth: int, name) -> float:
        return sum(x[3] for x in tree if x[depth] == name and x[3] > 0)

    def chosen(picked: Column, of: dict) -> Column:
        out = None
        for name, c in of.items():
            out = F.when(picked == F.lit(name), c) if out is None else out.when(picked == F.lit(name), c)
        return out

    live = [x for x in tree if x[3] > 0]
    regions = list(dict.fromkeys(x[0] for x in live))
    region = _least(key, [(r, total(0, r), F.lit(r)) for r in regions], seed)
    rack = chosen(region, {r: _least(key, [(k, total(1, k), F.lit(k)) for k in dict.fromkeys(x[1] for x in live if x[0] == r)], seed + 1)
                           for r in regions})
    racks = list(dict.fromkeys(x[1] for x in live))
    return chosen(rack, {k: _least(key, [(f"shard{x[2]}", x[3], F.lit(x[2])) for x in live if x[1] == k], seed + 2) for k in racks})


def shard(docs: DataFrame, shards: int = BASE_SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; slots are gapless per shard."""
    text = text_of(text_col)
    key = F.col("doc_id")
    rows = (docs.select(F.col(id_col).alias("doc_id"),
                        (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
            .select("*", F.lit("key").alias("law"), descend(key, topology(shards)).alias("shard"),
                    descend(key, topology(shards + 1)).alias("grown_shard")))
    ranked = gapless_rank(stage_table(rows, "shards"), "shard", ["doc_id", "size", "text_crc32"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
