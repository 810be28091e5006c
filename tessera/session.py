"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library is planned for.  AQE re-plans joins from
# measured sizes and splits skewed shuffle partitions; the rest keeps the
# engine quiet and deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the master comes from spark-submit; locally it falls back to
    ``local[$TESSERA_CPUS or 8]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('TESSERA_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is read, never replaced.  Only
    for a ``local`` master with nothing set (tests) is a scratch folder
    created; on a cluster a missing setting is an error, never a
    machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared, durable folder for this cluster")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TESSERA_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def staged(df, name: str):
    """Write ``df`` once as compressed Parquet in the shared checkpoint folder and read it back: later plans take
    the columns they need, and the planner knows the bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Cut lineage at a stage boundary: a reliable checkpoint into the shared
    checkpoint folder (survives executor loss; the next stage reads it back
    like the stage's written output)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
