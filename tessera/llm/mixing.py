"""Mixing sources to target weights at exact token budgets.

Every document gets a hash-random key.  Within its source the rows are laid
out in key order: the key's leading bits give range buckets, bucket totals
are prefix-summed, and the bucket in which the source's budget ends is
prefix-summed row by row.  That yields one cut per source: the number of
whole epochs and the document (with the words still missing) at which the last
epoch ends.  A row's share follows from its own key and its source's cut, so
no text is shuffled and no source has to fit into a task.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating,
and share 150 % of all sizes; a target stops at twice its source's size and the
excess is shared again by weight.  This is a water level: with sources ordered
by cap / weight, the level follows from prefix sums over the source table
(one row per source).

Only DataFrame functions are used.  Defined cases: a null text has size 0; a
null source is a source, the last one; a null ``doc_id`` is a value; rows
alike in id and text share what the cut leaves for them evenly (a rest of less
than their number is not taken); an empty table gives an empty result; further
columns are ignored by :func:`mix` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, count_words, fresh, stage_table, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17
_KEY_BITS = 32


def mix_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Hash-random key (128 bits, hex) of id and text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n) -> the same and ``target``."""
    # The windows run over one row per source.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.select("*", weight.alias("w"))
    s = s.select("*", (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    s = s.select("*", (F.col("cap") / F.col("w")).alias("ratio"))
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(F.lit(1))
    level = ((F.lit(share) * F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
             / (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))))
    s = s.select("*", level.alias("level"))
    # The first source (by ratio) that the level does not reach fixes it for all after it.
    found = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everyone)
    s = s.select("*", found["level"].alias("water"))
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water") * F.col("w")))
    return s.select("source", "source_size", "n", target.alias("target"))


def cuts(rows: DataFrame) -> DataFrame:
    """Per source: target, whole ``epochs``, and where the last one ends: rows
    before (key, doc_id) are taken once more, rows at it take ``rest`` words each.
    ``rows`` (doc_id, source, size, key) must be a staged table."""
    buckets = bucket_count(rows.count())
    at = F.conv(F.substring("key", 1, _KEY_BITS // 4), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.shiftright(at * F.lit(buckets), _KEY_BITS))
    per = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    per = stage_table(per, "mix-buckets")
    goal = targets(per.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("left", budget - F.col("epochs") * F.col("source_size")).drop("n")
    goal = stage_table(goal, "mix-goals")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    g = goal.select(F.col("source").alias("gs"), "left")
    ends = (per.withColumn("sofar", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .join(g, F.col("source").eqNullSafe(F.col("gs")))
            .where((F.col("left") >= F.col("sofar")) & (F.col("left") < F.col("sofar") + F.col("words")))
            .select("gs", F.col("bucket").alias("gb"), "sofar", "left"))
    # Rows of the one bucket per source that holds the cut; rows alike count as one.
    inside = (rows.join(ends, F.col("source").eqNullSafe(F.col("gs")) & (F.col("bucket") == F.col("gb")))
              .groupBy("source", "key", "doc_id", "size", "sofar", "left").agg(F.count(F.lit(1)).alias("alike")))
    run = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("alike")
    inside = inside.withColumn("start", F.col("sofar") + F.coalesce(F.sum(words).over(run), F.lit(0)))
    end = (inside.where((F.col("left") >= F.col("start")) & (F.col("left") < F.col("start") + words))
           .select(F.col("source").alias("es"), F.col("key").alias("end_key"), F.col("doc_id").alias("end_id"),
                   F.expr("(left - start) div alike").alias("rest")))
    return (goal.join(end, F.col("source").eqNullSafe(F.col("es")), "left")
            .select(F.col("source").alias("cut_source"), "source_size", "target", "epochs", "end_key", "end_id", "rest"))


def _once_more(key: Column, doc_id: Column) -> tuple[Column, Column]:
    """Whether a row lies before its source's cut, and whether it is the cut row."""
    tie = key == F.col("end_key")
    here = tie & doc_id.eqNullSafe(F.col("end_id"))
    # nulls order first, as in the window
    lower = F.coalesce(doc_id < F.col("end_id"), doc_id.isNull() & F.col("end_id").isNotNull())
    return F.coalesce((key < F.col("end_key")) | (tie & lower), F.lit(False)), F.coalesce(here, F.lit(False))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = text_of(text_col)
    return stage_table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   count_words(text).alias("size"), mix_key(F.col(id_col), text).alias("key")), "mix-rows")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = _sized(docs, id_col, text_col, source_col)
    cut = stage_table(cuts(rows), "mix-cuts")
    before, here = _once_more(F.col("key"), F.col("doc_id"))
    more = F.when(before, F.col("size")).when(here, F.col("rest")).otherwise(F.lit(0))
    return (rows.join(cut, F.col("source").eqNullSafe(F.col("cut_source")))
            .select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + more).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document as often as the
    mix takes it, always whole.  A source's cut document is in once more if the
    mix takes at least half of its words in the last epoch, so a source misses its
    target by at most half a document (rows alike share one fate).  A document
    without words takes part in every whole epoch."""
    cut = stage_table(cuts(_sized(docs, id_col, text_col, source_col)), "mix-cuts")
    names = docs.columns
    inner = {c: fresh("_cut_" + c, names) for c in cut.columns}
    cut = cut.select([F.col(c).alias(n) for c, n in inner.items()])
    copy, key = fresh("_copy", names), fresh("_key", names)
    at = F.col(key) == F.col(inner["end_key"])
    doc_id, end_id = F.col(id_col), F.col(inner["end_id"])
    lower = F.coalesce(doc_id < end_id, doc_id.isNull() & end_id.isNotNull())
    before = F.coalesce((F.col(key) < F.col(inner["end_key"])) | (at & lower), F.lit(False))
    here = F.coalesce(at & doc_id.eqNullSafe(end_id), F.lit(False))
    rest = F.col(inner["rest"])
    half = F.when(here, (rest > 0) & (2 * rest >= count_words(text_of(text_col)))).otherwise(F.lit(False))
    copies = F.col(inner["epochs"]) + (before | half).cast("long")
    out = (docs.withColumn(key, mix_key(F.col(id_col), text_of(text_col)))
           .join(cut, F.col(source_col).eqNullSafe(F.col(inner["cut_source"])))
           .where(copies > 0)
           .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), copies))))
    return out.select(names)
