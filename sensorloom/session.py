"""Session helpers: the shared folder for checkpoints and derived tables, and tuning knobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROWS_PER_BLOCK = "sensorloom.rowsPerBlock"
SALTS = "sensorloom.salts"


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName("sensorloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def rows_per_block(spark: SparkSession) -> int:
    """Target rows per block of an ordered scan (see ``operators.ordered``)."""
    return int(spark.conf.get(ROWS_PER_BLOCK, "1000000"))


def salts(spark: SparkSession) -> int:
    """Replicas of the per-key side in a salted join."""
    return int(spark.conf.get(SALTS, "8"))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sensorloom-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a derived table below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a derived table that nothing reads any more, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def cut_lineage(df):
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
