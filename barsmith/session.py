"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "barsmith", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("BARSMITH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package, whatever folder they start in; once per application."""
    context = spark.sparkContext
    if not getattr(context, "barsmith_shipped", False):
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="barsmith-code-")
        context.addPyFile(shutil.make_archive(
            f"{folder}/barsmith", "zip", os.path.dirname(package), os.path.basename(package)))
        context.barsmith_shipped = True
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Bars carry wall-clock times, so parsing must not depend on the host's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    return ship(spark)


class NoSharedFolder(RuntimeError):
    """Intermediate results need a folder that the driver and all executors can reach."""


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or the context's own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barsmith-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts lineage and survives the loss of executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(df: DataFrame) -> None:
    """Remove what materialize wrote, once no later plan reads it."""
    remove(df.sparkSession, df.scratch_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
