"""Session-level helpers: table access, checkpoint folder, partition counts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Stored tables of one application lie in one folder, so that they can go together.
STORED = "taskmill-stored-"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (one file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (local tests) a temporary folder is made and set for the session.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="taskmill-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back.

    Like :func:`cut`, for rows that several later scans read in part: the scans
    prune columns, which a checkpoint cannot.
    """
    path = f"{shared_dir(df.sparkSession)}/{STORED}{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stored(spark: SparkSession) -> None:
    """Deletes the tables that :func:`stored` has written for this application. Results that
    still have to read them must have been written or collected before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{STORED}{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file or folder exists, on whatever file system the path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the file or folder exists and holds at least one byte."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop) and fs.getContentSummary(hadoop).getLength() > 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_session(app: str = "taskmill", cpus: str | None = None) -> SparkSession:
    """A session for tests and the bench on one machine."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
