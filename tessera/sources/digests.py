"""Content digests of files, read in byte ranges.

A file of any size is cut into ranges of ``range_bytes``; Spark spreads the
ranges over tasks, each task reads its ranges in blocks of 1 MB and hashes
them, and a file's digest is put together from its range digests in order.
A file of one range has its plain SHA-256; a file of several has the SHA-256
of its range digests (lowercase hex, concatenated), so digests compare only
for one ``range_bytes``.

Defined cases: an empty folder gives no rows; Spark's file sources pass over
files without bytes, so an empty file is not listed (one that became empty is
``missing`` in a comparison); a file that became shorter since it was listed is
an error.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers get this module's functions with the task; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
RANGES_PER_TASK = 16


def _open(path: str):
    """A file by the path that Spark lists: local paths as they stand, others by their scheme."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _range_digest(path: str, start: int, size: int) -> str:
    digest, left = hashlib.sha256(), size
    with _open(path) as file:
        file.seek(start)
        while left:
            block = file.read(min(left, BLOCK_BYTES))
            if not block:
                raise OSError(f"{path} ends before byte {start + size}: it changed since it was listed")
            digest.update(block)
            left -= len(block)
    return digest.hexdigest()


def _hash_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted = zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size")))
        digests = pa.array([_range_digest(*w) for w in wanted], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("at"), digests], names=["path", "at", "digest"])


def file_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Listed files (``path``, ``bytes``) as byte ranges: path, at (0, 1, ...), start, size."""
    last = F.greatest(F.ceil(F.col("bytes") / range_bytes), F.lit(1)) - 1
    cut = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("at"))
    start = F.col("at") * F.lit(range_bytes).cast("long")
    return cut.select("path", "at", start.alias("start"), F.least(F.col("bytes") - start, F.lit(range_bytes).cast("long")).alias("size"))


def file_digests(spark: SparkSession, path: str | list[str], pattern: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, file_name, bytes, modified, ranges, sha256 of every file (folders below ``path`` included)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
             .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")))
    ranges = file_ranges(files, range_bytes)
    # Ranges are tiny rows that stand for much reading: as many tasks as there is to read, not as many as the rows fill.
    n = ranges.count()
    spread = ranges.repartition(max(1, -(-n // RANGES_PER_TASK), min(n, spark.sparkContext.defaultParallelism)), "path", "at")
    parts = spread.mapInArrow(_hash_ranges, "path string, at long, digest string")
    whole = parts.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("parts"))
    digest = F.when(F.size("parts") == 1, F.col("parts")[0]["digest"]).otherwise(
        F.sha2(F.concat_ws("", F.col("parts.digest")), 256))
    return (files.join(whole, "path")
            .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "bytes", "modified",
                    F.size("parts").alias("ranges"), digest.alias("sha256")))


def file_changes(stored: DataFrame, now: DataFrame, key: str = "file_name") -> DataFrame:
    """Every file of either listing with its stored and present digest and its status:
    ``ok``, ``changed`` (other bytes or digest), ``new`` or ``missing``.  ``key`` must be unique in each."""
    a = stored.select(F.col(key), F.col("bytes").alias("stored_bytes"), F.col("sha256").alias("stored_sha256"))
    b = now.select(key, "bytes", "sha256")
    same = (F.col("bytes") == F.col("stored_bytes")) & (F.col("sha256") == F.col("stored_sha256"))
    status = (F.when(F.col("sha256").isNull(), "missing").when(F.col("stored_sha256").isNull(), "new")
              .when(same, "ok").otherwise("changed"))
    return a.join(b, key, "full").select(key, "stored_sha256", "sha256", status.alias("status"))
