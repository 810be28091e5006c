"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves of a tree per group (``lang``) in the order of their ids; runs
of ``fan`` nodes become their parent's digest until one is left, the group's
subroot.  The subroots, in the order of their groups, are the leaves of one
more tree, whose last node is the root.

**Nested-interval labels.** A node carries the interval [lo, hi) of the leaf
ranks that it covers.  On level k the intervals are at most fan^k wide and
begin at its multiples, so ``lo div fan^k`` is a node's bucket.

* Ancestors: a node's parent is the node one level up, in the same tree and
  bucket, whose interval contains the node's: a join on equal buckets, checked
  by containment.
* Siblings: the parent's interval less the node's own is covered by its
  siblings, those that end before the node begins and those that begin after
  it ends.

Digests of siblings travel down from the root, level by level, so the joins
above the leaves hold an eighth, a 64th, ... of the rows, and texts are hashed
in the scan and never shuffled.  A tree may hold any share of the rows: ranks
come from a range sort with offsets per partition, and buckets spread a tree
over all tasks.

Defined cases: a null field is hashed as ``-``; null ids come first, ties are
ordered by digest (equal rows are interchangeable, each is a leaf); a null
group is a group, the first; a null id is never altered; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stage_table

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A node's sibling digests at one level, joined left and right of it.
SIDES = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tampered_text(id_col: Column, text: Column) -> Column:
    """The text, A-Z lower-cased where 3 divides the crc32 of the decimal id."""
    return F.when(F.crc32(id_col.cast("string")) % 3 == 0, ascii_lower(text)).otherwise(text)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
           claimed_text: Column | None = None, text_col: str = "text") -> DataFrame:
    """(doc_id, tree, digest, claimed): the leaf of each row, and the leaf that its ``claimed_text`` would give."""
    own = digest_of([F.col(c) for c in fields])
    claim = own
    if claimed_text is not None:
        other = digest_of([claimed_text if c == text_col else F.col(c) for c in fields])
        claim = F.when(claimed_text.eqNullSafe(F.col(text_col)), own).otherwise(other)
    # A null group sorts first, and differs from an empty one.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), tree.alias("tree"), own.alias("digest"), claim.alias("claimed"))


def ranked(items: DataFrame, order: list[str]) -> DataFrame:
    """``items`` with lo (the rank in its tree), hi = lo + 1 and n (leaves of the tree), staged.

    Rows are range-sorted and written; what the trees have in the partitions before gives the offsets.  As rows are
    sorted by tree, that table has at most one row per partition and one per tree.
    """
    tie = items.withColumn("_tie", F.monotonically_increasing_id())  # spreads equal rows over partitions
    rows = tie.orderBy("tree", *order, "_tie").drop("_tie")
    rows = stage_table(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "merkle-leaves")
    per = rows.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_part", "tree", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                     F.sum("_rows").over(Window.partitionBy("tree")).alias("n"))
    out = rows.join(per, ["_part", "tree"])
    lo = F.col("_before") + F.col("_at") - F.col("_first")
    return out.withColumn("lo", lo).withColumn("hi", lo + 1).drop("_part", "_at", "_before", "_first")


def grown(level0: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The levels above the leaves, each staged: (tree, lo, hi, digest, n, kids), kids being (lo, hi, digest) in order."""
    largest = level0.agg(F.max("n")).first()[0] or 0
    levels, below, width = [], level0, 1
    while width < largest:
        run = below.where(F.col("n") > width).groupBy("tree", F.floor(F.col("lo") / (width * fan)).alias("bucket"))
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))  # at most ``fan``
        below = run.agg(kids.alias("kids"), F.max("n").alias("n")).select(
            "tree", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
            F.sha2(F.concat_ws("", "kids.digest"), 256).alias("digest"), "n", "kids")
        below = stage_table(below, "merkle-level")
        levels.append(below)
        width *= fan
    return levels


def _top(nodes: DataFrame) -> DataFrame:
    """Nodes that cover their whole tree."""
    return nodes.where((F.col("lo") == 0) & (F.col("hi") == F.col("n")))


def with_siblings(level0: DataFrame, levels: list[DataFrame], above: DataFrame, fan: int = FAN) -> DataFrame:
    """``level0`` with ``sides``: the sibling digests of every level from the leaf up, followed by those that ``above``
    (tree, sides, ...) holds for its tree's last node.  Further columns of ``above`` come along."""
    carried = [c for c in above.columns if c not in ("tree", "sides")]
    chain = None
    for k in range(len(levels), -1, -1):
        nodes = level0 if k == 0 else levels[k - 1]
        last = _top(nodes).join(above, "tree")
        if chain is None:
            chain = last
            continue
        width = fan ** (k + 1)
        parents = chain.select(F.col("tree").alias("p_tree"), F.floor(F.col("lo") / width).alias("p_bucket"), F.col("lo").alias("p_lo"),
                               F.col("hi").alias("p_hi"), F.col("kids").alias("p_kids"), F.col("sides").alias("p_sides"), *carried)
        inner = nodes.where((F.col("lo") > 0) | (F.col("hi") < F.col("n")))
        held = inner.join(parents, (F.col("tree") == F.col("p_tree")) & (F.floor(F.col("lo") / width) == F.col("p_bucket"))
                          & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))
        left = F.concat_ws("", F.transform(F.filter("p_kids", lambda s: s["hi"] <= F.col("lo")), lambda s: s["digest"]))
        right = F.concat_ws("", F.transform(F.filter("p_kids", lambda s: s["lo"] >= F.col("hi")), lambda s: s["digest"]))
        sides = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), "p_sides")
        chain = held.select(*nodes.columns, sides.alias("sides"), *carried).unionByName(last.select(*nodes.columns, "sides", *carried))
    return chain


def manifest(leaf_rows: DataFrame, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(nodes, proofs) of rows (doc_id, tree, digest, claimed).

    ``nodes``: tree (null: the tree of subroots), level, lo, hi, digest: the manifest itself.  ``proofs``: doc_id, leaf,
    claimed, subroot, root and ``sides``, the sibling digests from the leaf up to the root.
    """
    level0 = stage_table(ranked(leaf_rows, ["doc_id", "digest", "claimed"]), "merkle-ranked")
    levels = grown(level0, fan)
    subroots = _top(level0).select("tree", "digest")
    for nodes in levels:
        subroots = subroots.unionByName(_top(nodes).select("tree", "digest"))
    upper0 = stage_table(ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"), ["group"]), "merkle-subroots")
    upper = grown(upper0, fan)
    root = (upper[-1] if upper else upper0).select(F.lit("").alias("tree"), F.lit(None).cast(SIDES).alias("sides"), F.col("digest").alias("root"))
    root = root.withColumn("sides", F.array().cast(SIDES))
    above = with_siblings(upper0, upper, root, fan).select(
        F.col("group").alias("tree"), "sides", F.col("digest").alias("subroot"), "root")
    above = stage_table(above, "merkle-above")
    proofs = with_siblings(level0, levels, above, fan).select("doc_id", F.col("digest").alias("leaf"), "claimed", "subroot", "root", "sides")

    def labelled(nodes: DataFrame, level: int, name: Column) -> DataFrame:
        return nodes.select(name.alias("tree"), F.lit(level).alias("level"), "lo", "hi", "digest")

    table = labelled(level0, 0, F.col("tree"))
    for k, nodes in enumerate(levels):
        table = table.unionByName(labelled(nodes, k + 1, F.col("tree")))
    for k, nodes in enumerate([upper0, *upper]):
        table = table.unionByName(labelled(nodes, k, F.lit(None).cast("string")))
    return table, proofs


def folded(leaf: str = "claimed", sides: str = "sides") -> Column:
    """The root that a leaf and the sibling digests give."""
    return F.aggregate(sides, F.col(leaf), lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def digest(proofs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    all_sides = F.concat_ws("", F.transform("sides", lambda s: F.concat(s["left"], s["right"])))
    out = proofs.withColumn("folded_root", folded())
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(all_sides, 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
