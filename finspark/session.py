"""Session helpers: a local session for tests and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "finspark") -> SparkSession:
    """Local session used by tests and the bench; on a cluster use the
    session the platform provides (all operators only need ``spark``)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("FINSPARK_DRIVER_MEM", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests) gets a private folder; on
    a cluster a missing setting is an error, since a machine-local folder is
    not visible to the executors and does not survive their loss."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        d = d or sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Connect)
        pass
    if not d:
        master = sc.master if sc is not None else ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        d = tempfile.mkdtemp(prefix="finspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss
    (never ``localCheckpoint``). Used for small derived tables (entity x
    month grain) that several branches of one plan consume, so the raw
    tables behind them are scanned once."""
    ensure_checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    # Without a cache the checkpoint write recomputes the plan a second time.
    df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, dropped with the
    tables of :func:`materialize`."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/finspark-materialized/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: lineage is cut (a lost executor re-reads files instead of
    recomputing the raw scans), the write is a single job (``checkpoint()``
    without a cache computes its plan twice), and the read-back keeps column
    pruning, filter pushdown and size statistics for the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete the tables that :func:`materialize` wrote for THIS application
    under the checkpoint folder (call when the DataFrames built on them are
    no longer used); other applications' tables stay."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/finspark-materialized/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
