"""Line dedup over levelled sorted runs of line hashes.

Documents arrive in batches; a document, by the hash of its id, lies wholly in
one.  A batch's line hashes are merge-anti-joined with the owners in the runs so
far: keys not seen before enter as owners, keys seen before enter as a count and
their largest document.  Both form the batch's own run, sorted by hash.  When a
level holds ``fan_in`` runs they are compacted into one run of the next level, so
a key is rewritten at most once per level and few runs are open at any time.
After the last batch the runs give every key's number of documents and keeper,
the largest of them.

The number of batches follows from the number of lines (``LINES_PER_BATCH``),
within ``LEAST_BATCHES`` and ``SLOTS``; lines are written by slot, so a batch reads
its own files only.  Ids may be of any type that has an order.

Hashes have 128 bits.  A hot line is one row per task before the shuffle
(map-side combining), and one row in the runs.  Only DataFrame functions are
used.

Defined cases: a null or empty text is one empty line; rows of one ``doc_id``
are one document; rows with a null ``doc_id`` are together one document, the
smallest; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WS, ascii_lower, stage_table, text_of

LEAST_CHARS, LEAST_DOCS = 20, 3
LEAST_BATCHES, SLOTS, FAN_IN = 4, 16, 2
LINES_PER_BATCH = 1_000_000_000


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space; expects A-Z lower-cased already."""
    return F.trim(line, F.lit(WS))


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, row_hash, pos, key, slot) for every line whose key is long enough."""
    text = text_of(text_col)
    keyed = F.transform(F.split(ascii_lower(text), "\n", -1),
                        lambda x: F.when(F.char_length(line_key(x)) >= least_chars, F.unhex(F.md5(line_key(x)))))
    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row_hash"), F.posexplode(keyed).alias("pos", "key"))
            .where(F.col("key").isNotNull()).withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")))


def staged_lines(lines: DataFrame) -> DataFrame:
    """The lines written by slot: a filter on slots reads their files alone."""
    path = scratch_path(lines.sparkSession, "lines")
    lines.write.partitionBy("slot").parquet(path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def run_of(lines: DataFrame) -> DataFrame:
    """(key, n, last): documents that hold the key, and the largest of them (null id: least)."""
    per = lines.select("key", "doc_id").distinct()
    return per.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))


class Runs:
    """Levels of sorted runs (key, n, keeper, owner): the owner row of a key is the one that entered it."""

    def __init__(self, fan_in: int = FAN_IN):
        self.fan_in, self.levels = fan_in, {}

    def all(self) -> list[DataFrame]:
        return [r for level in sorted(self.levels) for r in self.levels[level]]

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join a batch's (key, n, last) with the runs, and add its own run."""
        batch = stage_table(batch, "line-batch")
        new, seen = batch, None
        if self.all():
            owners = self._union(self.all()).where("owner").select("key").hint("merge")
            new = batch.join(owners, "key", "left_anti")
            seen = batch.join(owners, "key", "left_semi").select("key", "n", F.col("last").alias("keeper"), F.lit(False).alias("owner"))
        run = new.select("key", "n", F.col("last").alias("keeper"), F.lit(True).alias("owner"))
        self._push(0, run if seen is None else run.unionByName(seen))

    def _push(self, level: int, run: DataFrame) -> None:
        runs = self.levels.setdefault(level, [])
        # Range-partitioned and sorted by key: a run's files hold ascending, disjoint key ranges.
        runs.append(stage_table(run.sort("key"), f"line-run-{level}"))
        if len(runs) >= self.fan_in:
            self.levels[level] = []
            self._push(level + 1, self.merged(runs))

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def merged(self, runs: list[DataFrame] | None = None) -> DataFrame:
        """One row per key: documents, keeper, and whether its owner is among these runs."""
        return self._union(self.all() if runs is None else runs).groupBy("key").agg(
            F.sum("n").alias("n"), F.max("keeper").alias("keeper"), F.max("owner").alias("owner"))


def frequent_lines(lines: DataFrame, batches: int | None = None, least_docs: int = LEAST_DOCS, fan_in: int = FAN_IN) -> DataFrame:
    """(key, keeper) of the keys found in at least ``least_docs`` documents.  ``lines`` should be staged by slot."""
    batches = min(SLOTS, batches or max(LEAST_BATCHES, -(-lines.count() // LINES_PER_BATCH)))
    runs = Runs(fan_in)
    for i in range(batches):
        runs.add(run_of(lines.where(F.col("slot").isin(list(range(i, SLOTS, batches))))))
    return runs.merged().where(F.col("n") >= least_docs).select("key", "keeper")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
          least_docs: int = LEAST_DOCS, batches: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_text."""
    lines = staged_lines(hashed_lines(docs, id_col, text_col, least_chars))
    drop = stage_table(frequent_lines(lines, batches, least_docs).toDF("d_key", "keeper"), "frequent-lines")
    # A hot line is a large partition of this join, which AQE splits.
    gone = (lines.join(drop, (F.col("key") == F.col("d_key")) & ~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))  # one document's lines
            .toDF("g_id", "g_hash", "gone"))
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"), F.xxhash64(text).alias("h"))
    out = rows.join(gone, (F.col("h") == F.col("g_hash")) & F.col("doc_id").eqNullSafe(F.col("g_id")), "left")
    split = F.split("t", "\n", -1)
    n = F.size(split)
    # The stretches between dropped lines.
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(n))
    between = F.transform(F.sequence(F.lit(0), F.size("gone")),
                          lambda i: F.slice(split, F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1))
    kept = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.flatten(between), "\n"))
    return out.select("doc_id", n.cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))
