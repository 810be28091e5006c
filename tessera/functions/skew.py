"""Joining rows to per-group results without one task per hot group.

Most operators of the library decide per group (a dedup key, a species) and
then need that decision back on every row of the group.  A window over the
group key would put a hot group -- say a third of all rows -- into one task.
Instead the decision is computed by a (map-side combined) aggregate and
joined back with :func:`join_group_stats`, which splits hot groups:

* ``hot`` holds ``(key hash, fan)`` for key hashes with at least
  ``hot_rows`` rows, read off the group sizes.  Because those counts sum to at most the row count N,
  ``hot`` has at most ``N / hot_rows`` entries of 12 bytes: a proven bound,
  so it is broadcast.
* a hot group's row on the group side is repeated ``fan = ceil(size /
  hot_rows)`` times with salt ``0..fan-1``; each data row picks the salt
  ``pmod(hash(row id), fan)``.  Every shuffle partition of the join then
  carries at most about ``hot_rows`` rows of any one group.

Keys are compared null-safely, so NULL groups with NULL exactly as in
``GROUP BY``.  A hash collision with a hot hash only salts a cold group too,
which is harmless: both sides use the same fan for the same hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group this large is split over several join tasks (about 1 GB of 1 kB
# rows per task at most).  At 1e11 rows the hot table has at most
# 1e11 / 1e6 = 100,000 entries (1.2 MB).
DEFAULT_HOT_ROWS = 1_000_000


def _key_hash(keys: list[Column]) -> Column:
    return F.xxhash64(*keys)


def join_group_stats(rows: DataFrame, groups: DataFrame, keys: list[str], size_col: str,
                     row_id_col: str, how: str = "inner",
                     hot_rows: int = DEFAULT_HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Attach the columns of ``groups`` (one row per key) to ``rows``.

    ``size_col`` names the group size column of ``groups``, from which the
    hot keys follow without another pass over ``rows``.  A left join counts
    the rows instead, since keys without a group may be hot there.
    ``sizes`` (keys and ``size_col``), if given, is a narrow table that says how many
    rows a key has; ``groups`` then needs no size and stands in the plan once.
    ``row_id_col`` is any column that spreads a group's rows evenly (a row id).
    Key columns appear once in the result, taken from ``rows``.
    """
    # Keys meet by an 8-byte hash.  A collision can only make a cold key look
    # hot, which salts it needlessly but never changes the result.
    h = _key_hash([F.col(k) for k in keys]).alias("__h")
    if sizes is not None:
        sizes = sizes.where(F.col(size_col) >= hot_rows).groupBy(h).agg(F.max(size_col).alias("__n"))
    elif how == "inner":
        sizes = groups.where(F.col(size_col) >= hot_rows).groupBy(h).agg(F.max(size_col).alias("__n"))
    else:
        sizes = rows.groupBy(h).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= hot_rows)
    hot = sizes.select("__h", F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int").alias("__fan"))
    hot = F.broadcast(hot)

    g = groups.withColumn("__h", _key_hash([F.col(k) for k in keys]))
    g = g.join(hot, "__h", "left").withColumn("__fan", F.coalesce("__fan", F.lit(1)))
    g = g.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__fan") - 1))).drop("__fan")
    g = g.select([F.col(c).alias(f"__g_{c}") if c in keys or c in ("__h", "__salt") else F.col(c)
                  for c in g.columns])

    r = rows.withColumn("__h", _key_hash([F.col(k) for k in keys]))
    r = r.join(hot, "__h", "left")
    r = r.withColumn("__salt", F.when(F.col("__fan").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(row_id_col)), F.col("__fan")).cast("int"))).drop("__fan")

    cond = [F.col("__h") == F.col("__g___h"), F.col("__salt") == F.col("__g___salt")]
    cond += [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    out = r.join(g, cond, how)
    return out.drop("__h", "__salt", "__g___h", "__g___salt", *[f"__g_{k}" for k in keys])
