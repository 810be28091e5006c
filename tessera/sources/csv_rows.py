"""Quoted CSV files read in byte ranges, with row ids in file order.

A quoted field may hold line breaks, so whether a line begins a record depends
on every quote before it in its file; Spark's multi-line reader therefore takes
a file as one task.  Here files are split like any text:

1. Lines are read by byte range.  One pass counts, per range, the quotes and
   the lines that begin a record *if* the range starts outside, or inside, a
   quoted field.  Only these counts (one row per range) are kept.
2. A prefix scan over a file's ranges gives the quote parity at each range's
   start, hence which of the two counts holds, the number of records before the
   range, and, over the files in path order, the row ids.
3. A line that begins and ends outside quotes is a record as it stands.  Only
   the lines of records that go over line breaks are shuffled, by record, and
   joined.  ``from_csv`` parses both.

The running counts within a range come from an Arrow function over three
numbers a line; the text stays in the JVM.

Defined cases: blank lines outside quotes are no records; ``\\r\\n`` ends a line
as ``\\n`` does and is kept inside quotes; a byte-order mark before a header is
dropped; an empty file has no records; a file whose header differs, whose last
quote is not closed, or whose record has another number of fields is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _running(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Per line of a range, in order: its number, the quote parity before it, and the lines up to it that begin a
    record if the range starts outside (``outer``) or inside (``inner``) a quoted field."""
    key, carry = None, np.zeros(4, dtype=np.int64)  # of the last line: range; number, parity, outer, inner after it
    for keys, odd, blank in parts:
        k, q, held = keys.to_numpy(zero_copy_only=False), odd.to_numpy(zero_copy_only=False).astype(np.int64), ~blank.to_numpy(zero_copy_only=False)
        n = len(k)
        if not n:
            yield pa.array([], pa.struct([(x, pa.int64()) for x in ("at", "parity", "outer", "inner")]))
            continue
        new = np.concatenate([[k[0] != key], k[1:] != k[:-1]])
        first = np.flatnonzero(new) if new[0] else np.concatenate([[0], np.flatnonzero(new)])
        spans = np.diff(np.concatenate([first, [n]]))
        start = np.zeros((len(first), 4), dtype=np.int64)
        if not new[0]:
            start[0] = carry
        base = np.repeat(start, spans, axis=0)

        def within(values: np.ndarray) -> np.ndarray:
            """Inclusive sums from the start of each range."""
            total = np.cumsum(values)
            return total - np.repeat((total - values)[first], spans)

        at = within(np.ones(n, dtype=np.int64)) + base[:, 0]
        quotes = within(q) + base[:, 1]
        parity = (quotes - q) % 2
        outer = within((held & (parity == 0)).astype(np.int64)) + base[:, 2]
        inner = within((held & (parity == 1)).astype(np.int64)) + base[:, 3]
        key, carry = k[-1], np.array([at[-1], quotes[-1] % 2, outer[-1], inner[-1]])
        yield pa.StructArray.from_arrays([pa.array(x) for x in (at, parity, outer, inner)], names=["at", "parity", "outer", "inner"])


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, start, value, odd, blank, run): every line with its range and running counts."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = lines.withColumns({"odd": quotes % 2 == 1, "blank": F.col("value").isin("", "\r")})

    @F.arrow_udf("struct<at:long,parity:long,outer:long,inner:long>")
    def running(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from _running(parts)

    # Each value depends on the lines before it: not to be moved past a filter.
    return lines.withColumn("run", running.asNondeterministic()(F.xxhash64("path", "start"), "odd", "blank"))


def csv_ranges(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per byte range: path, start, parity (open quote at its start), before (records of the file before the
    range), file_row (data records of the files before).  The scans run over one row per range, and per file."""
    ranges = _lines(spark, paths).groupBy("path", "start").agg(
        F.count_if("odd").alias("quotes"), F.max("run.outer").alias("outer"), F.max("run.inner").alias("inner"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("records", F.when(F.col("parity") == 0, F.col("outer")).otherwise(F.col("inner")))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("records").over(earlier), F.lit(0)))
    files = ranges.groupBy("path").agg(F.sum("records").alias("n"), (F.sum("quotes") % 2).alias("open"))
    files = files.select("path", "open", F.coalesce(F.sum(F.greatest(F.col("n") - 1, F.lit(0))).over(
        Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("file_row"))
    parity = F.when(F.col("open") == 0, F.col("parity")).otherwise(F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("path"))).cast("long"))
    return ranges.join(files, "path").select("path", "start", parity.alias("parity"), "before", "file_row")


def read_csv_rows(spark: SparkSession, paths: str | list[str], cols: list[str], base: int = 1, row_id: str | None = "source_row",
                  sep: str = ",") -> DataFrame:
    """(row_id, *cols) of all records, all text (an empty field is NULL), numbered from ``base`` in file order.
    ``row_id`` None: the columns alone; a name that the file has is refused."""
    if row_id in cols:
        raise ValueError(f"the file has a column {row_id}")
    staged = scratch_path(spark, "csv-ranges")
    csv_ranges(spark, paths).write.parquet(staged)
    ranges = spark.read.parquet(staged).withColumnsRenamed({"path": "r_path", "start": "r_start", "parity": "r_parity"})
    lines = _lines(spark, paths).join(ranges, (F.col("path") == F.col("r_path")) & (F.col("start") == F.col("r_start")), "left")
    # A file that changed, or is cut otherwise than in the first pass, must not lose lines.
    known = F.when(F.col("r_parity").isNull(), F.raise_error(F.concat(F.lit("file changed while it was read: "), F.col("path"))).cast("long"))
    opened = F.coalesce(known, (F.col("r_parity") + F.col("run.parity")) % 2)
    begun = F.when(F.col("r_parity") == 0, F.col("run.outer")).otherwise(F.col("run.inner"))
    lines = lines.select("path", "start", "value", "odd", "blank", "file_row", opened.alias("opened"), (F.col("before") + begun).alias("record"),
                         F.col("run.at").alias("at"))
    whole = lines.where((F.col("opened") == 0) & ~F.col("odd") & ~F.col("blank")).select("path", "file_row", "record", "value")
    parts = lines.where((F.col("opened") == 1) | F.col("odd"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", "value"))), lambda x: x["value"]), "\n")
    broken = parts.groupBy("path", "file_row", "record").agg(joined.alias("value"))
    records = whole.unionByName(broken).withColumn("value", F.regexp_replace("value", "\r\\z", ""))
    first = F.col("record") == 1
    records = records.withColumn("value", F.when(first, F.regexp_replace("value", "\\A﻿", "")).otherwise(F.col("value")))
    names = [f"c{i}" for i in range(len(cols))]
    row = F.from_csv("value", ", ".join(f"{n} string" for n in names), RECORD | {"sep": sep})
    records = records.withColumn("row", row)
    header = F.array(*[F.coalesce(F.col(f"row.{n}"), F.lit("")) for n in names]) == F.array(*map(F.lit, cols))
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("path"))).cast("boolean")
    data = records.where(F.when(~first, True).when(header, False).otherwise(wrong))
    number = F.col("file_row") + F.col("record") - 2 + base
    ids = [number.cast("long").alias(row_id)] if row_id else []
    return data.select(*ids, *[F.col(f"row.{n}").alias(c) for n, c in zip(names, cols, strict=True)])
