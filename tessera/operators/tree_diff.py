"""Difference of two tables as multisets of whole rows, by a tree of additive digests.

Every row falls into a leaf by the first bits of its hash.  A leaf's digest is
its number of rows and two sums of independent 64-bit row hashes, so it depends
neither on order nor on partitioning, partial sums combine before the shuffle
(a row repeated a million times sends one sum a task), and a stored tree can be
compared without reading the rows it was made of.  The inner nodes add their
children up.  A comparison starts at the root and goes down only below unequal
nodes; rows of unequal leaves alone are then compared exactly.

A difference is missed only if all three figures of a leaf agree by chance
(about 2^-128); a row reported was compared by value.

Defined cases: NULL equals NULL and differs from the empty text; equal rows
count by their number; two empty tables have no difference; columns of the
second table are taken by the first one's names, others are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

LEAF_BITS = 16  # 65,536 leaves: at most 512 KB of leaf numbers travel to every task
LEVEL_BITS = 4  # children of a node: 16
SUM = "decimal(38,0)"


def _hash(columns: list[str], seed: int) -> Column:
    # Spark's hash passes over NULLs, so their places are hashed as well.
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns])


def leaf_of(columns: list[str], bits: int = LEAF_BITS) -> Column:
    return F.shiftrightunsigned(_hash(columns, 1), 64 - bits)


def leaf_digests(df: DataFrame, columns: list[str] | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """leaf, n, d1, d2: the lowest level of the tree, one row per leaf that has rows.  Store it to compare later."""
    columns = columns or df.columns
    return (df.select(leaf_of(columns, bits).alias("leaf"), _hash(columns, 2).cast(SUM).alias("d1"), _hash(columns, 3).cast(SUM).alias("d2"))
            .groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("d1").cast(SUM).alias("d1"), F.sum("d2").cast(SUM).alias("d2")))


def _shift(level: int, bits: int) -> int:
    """Bits of a leaf's number below a level's nodes."""
    return max(0, bits - level * LEVEL_BITS)


def level_digests(leaves: DataFrame, level: int, bits: int = LEAF_BITS) -> DataFrame:
    """node, n, d1, d2 of a level: 0 is the root, every further one splits a node by ``LEVEL_BITS`` bits."""
    return leaves.groupBy(F.shiftrightunsigned("leaf", _shift(level, bits)).alias("node")).agg(F.sum("n").alias("n"), F.sum("d1").cast(SUM).alias("d1"), F.sum("d2").cast(SUM).alias("d2"))


def unequal_leaves(a_leaves: DataFrame, b_leaves: DataFrame, bits: int = LEAF_BITS) -> DataFrame:
    """leaf: numbers of the unequal leaves, found from the root down.

    The trees' difference is made once and written (at most 2^bits rows); each
    level then looks only at the children of the unequal nodes above, whose
    numbers, at most 2^bits, are broadcast.
    """
    figures = ["n", "d1", "d2"]
    minus = b_leaves.select("leaf", *[(-F.col(c)).cast(a_leaves.schema[c].dataType).alias(c) for c in figures])
    both = a_leaves.select("leaf", *figures).unionByName(minus)
    path = scratch_path(a_leaves.sparkSession, "tree-difference")
    both.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in figures]).write.parquet(path)
    difference = a_leaves.sparkSession.read.parquet(path)

    unequal = (F.col("n") != 0) | (F.col("d1") != 0) | (F.col("d2") != 0)
    nodes = level_digests(difference, 0, bits).where(unequal).select("node")
    for level in range(1, -(-bits // LEVEL_BITS) + 1):
        step = _shift(level - 1, bits) - _shift(level, bits)
        children = level_digests(difference, level, bits).withColumn("parent", F.shiftrightunsigned("node", step))
        above = F.broadcast(nodes.select(F.col("node").alias("parent")))
        nodes = children.join(above, "parent", "left_semi").where(unequal).select("node")
    return nodes.select(F.col("node").alias("leaf"))


def row_differences(a: DataFrame, b: DataFrame, a_leaves: DataFrame | None = None, b_leaves: DataFrame | None = None,
                    bits: int = LEAF_BITS, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Every distinct row whose number differs, with ``n_<a>`` and ``n_<b>``: EXCEPT ALL both ways in one table.

    ``a_leaves`` and ``b_leaves`` are the tables' stored trees, if there are any.
    """
    cols = a.columns
    b = b.select(*[F.col(f"`{c}`") for c in cols])
    leaves = unequal_leaves(a_leaves if a_leaves is not None else leaf_digests(a, cols, bits),
                            b_leaves if b_leaves is not None else leaf_digests(b, cols, bits), bits)
    wanted = F.broadcast(leaves.withColumnRenamed("leaf", "__leaf"))
    na, nb = f"n_{names[0]}", f"n_{names[1]}"

    def side(df: DataFrame, in_a: int) -> DataFrame:
        kept = df.withColumn("__leaf", leaf_of(cols, bits)).join(wanted, "__leaf", "left_semi").drop("__leaf")
        return kept.withColumn("__a", F.lit(in_a).cast("long")).withColumn("__b", F.lit(1 - in_a).cast("long"))

    both = side(a, 1).unionByName(side(b, 0)).groupBy(*[F.col(f"`{c}`") for c in cols])
    return both.agg(F.sum("__a").alias(na), F.sum("__b").alias(nb)).where(F.col(na) != F.col(nb))


def difference_summary(differences: DataFrame, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """One row: rows that the second table lacks (``missing_rows``) and has beyond the first (``extra_rows``)."""
    na, nb = (F.col(f"n_{x}") for x in names)
    return differences.agg(F.coalesce(F.sum(F.greatest(na - nb, F.lit(0))), F.lit(0)).alias("missing_rows"),
                           F.coalesce(F.sum(F.greatest(nb - na, F.lit(0))), F.lit(0)).alias("extra_rows"))
