"""Session settings and the shared folder for data between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings a job of this package should run with. The report zone is part of the
# result, because hour labels follow it. Repeated JSON keys keep the last value.
REPORT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# For session builders: columns are put together faster when Spark does not note where
# in the Python code each one was written.
BUILDER_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def pin_report_settings(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    for name, value in REPORT_SETTINGS.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process on one machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the session names in ``spark.checkpoint.dir``. Only a local
    session, which has no other machines, gets a temporary folder when none is
    named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hourtally-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/hourtally/{name}-{uuid.uuid4().hex}"


def read_if_there(spark: SparkSession, schema, path: str, kind: str = "parquet") -> DataFrame | None:
    """A written table, or None when nothing was ever written to the path."""
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder, files = folder_of(spark, path)
    files.delete(folder, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Make a finished folder visible under its name, at once."""
    folder, files = folder_of(spark, source)
    if not files.rename(folder, folder_of(spark, target)[0]):
        raise RuntimeError(f"{source} could not become {target}")


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = folder_of(spark, path)
    return files.exists(folder)


def create(spark: SparkSession, path: str) -> None:
    """Make an empty file, as a mark; nothing happens if it is there."""
    mark, files = folder_of(spark, path)
    if not files.exists(mark):
        files.mkdirs(mark.getParent())
        files.create(mark).close()


def folder_of(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop has them."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder (survives lost executors)."""
    folder = shared_folder(frame.sparkSession)
    if frame.sparkSession.sparkContext.getCheckpointDir() is None:
        frame.sparkSession.sparkContext.setCheckpointDir(folder)
    return frame.checkpoint()
