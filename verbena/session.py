"""Session helpers: reading tables and finding the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()
_HOMES: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="verbena-ship-"), "verbena.zip")  # the driver's file; Spark hands it on
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of the folder `sf_dir`."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt out to all of them before costly work; others as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local one is set only where the session names none and runs in one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            path = current.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            path = "file://" + tempfile.mkdtemp(prefix="verbena-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder; it is deleted with all others when the application's JVM ends."""
    home = f"{shared_dir(spark)}/verbena-{spark.sparkContext.applicationId}"
    if home not in _HOMES:
        fs, p = file_system(spark, home)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _HOMES.add(home)
    return f"{home}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """df written once to the shared folder and read again: later plans start from the files."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings that the operators count on: AQE with skew handling, UTC, Arrow."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder
