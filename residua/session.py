"""Session helpers shared by the operators and the queries."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes in one Arrow batch: long texts must not add up to more than a worker can hold.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("residua")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table of that name under sf_dir, which may be any path Spark can read."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def bound_arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> None:
    """Lower the rows and bytes of an Arrow batch to at most this many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions; given to repartition(), it isn't lowered for small rows that grow later."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see: spark.checkpoint.dir, or one of our own where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if path is None and current is not None:
        return current
    if path is None:  # a single machine, as in tests
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="residua-")
    if current is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what staged() wrote."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
