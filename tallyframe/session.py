"""Session set-up, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators are written for. All are ordinary Spark
# settings; a cluster's own spark-defaults override them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when the next aggregate must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes; wide projections (28 lags, 47 columns)
    # run faster split into several methods than fused into one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_removed_at_end: set[str] = set()


def get_spark(app_name: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULT_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder beside the catalog's tables, which all executors reach as well. A cluster whose
    catalog lies on the driver's own disk has no such folder, so there the setting is asked for.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = "://" not in warehouse or warehouse.startswith("file:")
    if own_disk and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for one run, unused before, inside the shared folder; it goes when the application ends."""
    app = spark.sparkContext.applicationId
    root = f"{shared_folder(spark)}/tallyframe/{app}"
    if root not in _removed_at_end:
        _removed_at_end.add(root)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give iterative fits (boosting) a checkpoint folder, unless the cluster has set one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def materialize(df: DataFrame, name: str = "step", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and pins values that a
    recomputation could change (row positions, partition ids). ``options`` go to the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
