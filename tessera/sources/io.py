"""Sources and sinks: text-typed CSV scans, routed Parquet outputs, file
inventories and fingerprints.

Every CSV scan takes an explicit all-string schema (never inferred).  Output
locations are the caller's; helpers that need scratch space take it from the
session's shared checkpoint folder (``tessera.session.scratch_path``).
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_rows import read_csv_rows
from .digests import RANGE_BYTES, file_changes, file_digests  # noqa: F401

CSV_READ = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "FAILFAST",
            "enforceSchema": "false",  # a file whose header differs from the schema is an error, never read by position
           
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}
CSV_WRITE = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def header_columns(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> list[str]:
    """Column names of a CSV header (the only row read); repeated names and
    missing ``required`` columns (e.g. ``id``) are refused."""
    first = spark.read.option("header", "false").option("multiLine", "true").option("escape", '"').csv(path).limit(1)
    cols = [c for c in first.first()]
    cols = [c.lstrip("﻿") for c in cols]
    if len(set(cols)) != len(cols):
        raise ValueError("repeated column names in header")
    missing = [c for c in required if c not in cols]
    if missing:
        raise ValueError(f"header lacks required columns {missing}")
    return cols


def all_text_schema(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_text_table(spark: SparkSession, path: str | list[str], cols: list[str] | None = None,
                    empty_as_null: bool = False, required: tuple[str, ...] = ()) -> DataFrame:
    """Header-driven all-text CSV scan; a file is read in byte ranges, by several tasks.

    ``empty_as_null=False`` (source tables): an empty field is the empty
    string, never NULL.  ``empty_as_null=True`` (archives): empty -> NULL.
    """
    cols = cols or header_columns(spark, path, required)
    df = read_csv_rows(spark, path, cols, row_id=None)
    if empty_as_null:
        return df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in cols])
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**CSV_READ).schema(schema).csv(path)


def files_by_header(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> files, from one distributed read of the lines; one row per file is
    collected.  A file without any line has no header and no rows."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    first = (lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
             .groupBy("path").agg(F.min_by("value", "at").alias("line")))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("path").collect():
        file = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(r["path"]))  # a name, not a pattern
        line = r["line"].lstrip("\ufeff")
        # An open quote: the header goes on in the next line.
        cols = header_columns(spark, file) if line.count('"') % 2 else next(csv.reader([line]), [])
        if len(set(cols)) != len(cols):
            raise ValueError(f"repeated column names in header of {file}")
        found.setdefault(tuple(cols), []).append(file)
    return found


def read_union_by_name(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV files (paths, folders or globs) whose headers differ; columns united by
    name (missing ones NULL).  One scan per distinct header."""
    frames = [read_text_table(spark, files, list(cols), empty_as_null=True) for cols, files in files_by_header(spark, paths).items()]
    if not frames:
        raise ValueError(f"no header in {paths}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists",
                  row_group_bytes: int | None = None) -> None:
    w = df.write.mode(mode).option("compression", "zstd")
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report_csv(df: DataFrame, path: str, order: list[str], mode: str = "errorifexists") -> None:
    """Ordered CSV with header for small reports: a global sort, then one
    file (the sort's range partitions are merged in order)."""
    df.orderBy(*order).coalesce(1).write.mode(mode).options(**CSV_WRITE).csv(path)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Directory listing as a table: name, stem key (``_`` -> space, lower,
    trim), extension, bytes, modification time.  Contents are not read."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
          .select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    return df.select(name.alias("file_name"),
                     F.lower(F.trim(F.regexp_replace(stem, "_", " "))).alias("stem_key"),
                     F.lower(F.regexp_extract(name, r"\.([^./]*)$", 1)).alias("extension"),
                     F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_fingerprints(spark: SparkSession, path: str, pattern: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """SHA-256, size and mtime per file, read in byte ranges (see :mod:`.digests`)."""
    return file_digests(spark, path, pattern, range_bytes).select("file_name", "bytes", "modified", "sha256")


#: Types whose smallest and largest value a Parquet footer states exactly.
FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_stats(spark: SparkSession, path: str | list[str], columns: list[str] = ()) -> DataFrame:
    """One row: ``rows`` and, per named column, ``min_<column>`` and ``max_<column>``, from the
    footers of Parquet files alone (no column is read).

    The count is pushed into the Parquet source, which only its newer reader does;
    the frame belongs to a session of its own, so the caller's settings stay.  Files
    of a folder must have one schema; a column without a footer bound (text, floats) is refused.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(*([path] if isinstance(path, str) else path))
    unbounded = [c for c in columns if not isinstance(df.schema[c].dataType, FOOTER_TYPES)]
    if unbounded:
        raise ValueError(f"no exact footer bounds for {unbounded}")
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.count(F.lit(1)).alias("rows"), *bounds)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent content fingerprint: row count and the sum of a
    64-bit row hash (wrapping), computed in one distributed aggregate."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("fingerprint"))
