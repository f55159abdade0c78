"""A local session for tests, benchmarks and trying things out.

On a cluster the session comes from ``spark-submit``; nothing in the package
changes its settings.  Intermediate tables go to the folder that it names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, *, memory: str = "8g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wordloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="wordloom-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the shared folder: what uses it again reads it, also after an executor is lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def own_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the session's file system is closed."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop)
    system.deleteOnExit(hadoop)
    return path
