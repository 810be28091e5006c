"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# ASCII white space \x20 \x09-\x0D, and a word: a run of anything else (Java regex).
WS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Characters outside ASCII that full Unicode lower-casing would change.
_OTHER_UPPER = r"[\P{ASCII}&&[\p{IsUppercase}\p{Lt}]]"
ROWS_PER_BUCKET = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does the same unless the text holds an
    upper-case letter outside ASCII; only such texts take the slower mapping."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return (F.when(ascii_only, F.lower(c))
            .when(~c.rlike(_OTHER_UPPER), F.lower(c))
            .otherwise(F.translate(c, _UPPER, _UPPER.lower())))


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def count_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a table into the shared checkpoint folder and read it
    back.  Survives lost executors, and later plans see pruned scans with sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column of the input uses (Spark ignores case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def bucket_count(n: int, rows: int = ROWS_PER_BUCKET) -> int:
    """Hash buckets so that each holds about ``rows`` rows at any input size."""
    return max(1, math.ceil(n / rows))


def gapless_rank(df: DataFrame, group: str, order: list[str], name: str,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """0-based gapless rank within ``group`` (a non-null column) in hash order.

    A group may hold any share of the rows, so it is cut into hash buckets of
    about ``rows_per_bucket`` rows: bucket counts give offsets, and only rows
    of one bucket meet in a window.  The offsets have one row per (group,
    bucket).  ``df`` should be a staged table (it is read three times).
    """
    buckets = bucket_count(df.count(), rows_per_bucket)
    h, b, off = (fresh(x, df.columns) for x in ("_h", "_b", "_off"))
    rows = (df.withColumn(h, F.xxhash64(F.lit(7), *order))
            .withColumn(b, F.pmod(F.col(h), F.lit(buckets)).cast("long")))
    per = rows.groupBy(group, b).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col(group).alias("_g"), F.col(b).alias("_gb"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias(off))
    inside = Window.partitionBy(group, b).orderBy(h, *order)
    ranked = rows.withColumn(name, F.row_number().over(inside) - 1)
    out = ranked.join(offsets, (F.col(group) == F.col("_g")) & (F.col(b) == F.col("_gb")))
    return out.withColumn(name, (F.col(name) + F.col(off)).cast("long")).drop("_g", "_gb", h, b, off)
