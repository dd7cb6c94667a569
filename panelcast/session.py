"""Session helpers: a local session for tests and bench, and durable intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "panelcast", cpus: str = "*", shuffle_partitions: int = 8):
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a temporary folder. On a cluster a
    folder that one machine alone can see would be lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="panelcast-"))
    return _own_folder[0]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_staged: list[str] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and continue from the written copy.

    A panel is staged after the fact scan, so that model fits, scoring and projection read weekly
    rows instead of scanning the facts again; the copy survives the loss of executors. ``clear_staged`` deletes it.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Delete the tables that this process has staged so far, once their results are written; how many there were."""
    done = 0
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done


def task_slots(spark: SparkSession, per_core: int = 1) -> int:
    """Number of parts to spread model fits over."""
    cores = spark.sparkContext.defaultParallelism
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), per_core * cores)
