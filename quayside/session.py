"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the bench, which name its folders; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quayside")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session of one process that names none gets a temporary one. Any other that names none is an error, because a
    folder of one machine would lose the table with that machine; that the named folder is a shared one is for the
    cluster to see to.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quayside-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        # Boosting keeps its binned rows there.
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def staging_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quayside/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def clear_staged(spark: SparkSession) -> None:
    """Removes what this application staged, once nothing reads it any more."""
    remove(spark, staging_root(spark))


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it isn't installed, as in a checkout."""
    root, known = str(Path(__file__).parents[1]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH", "")]))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several branches: it is computed once, lost executors do not bring its inputs
    back into the job, and each branch still reads only the columns it needs.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
