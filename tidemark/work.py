"""Tables written on the way, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where none is named and all runs on one machine, as in tests, a temporary one."""
    context = spark.sparkContext
    if (found := context.getCheckpointDir()) is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
        found = context.getCheckpointDir()
    return found


def passing_folder(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends, if not before."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    at, system = _system(spark, path)
    system.deleteOnExit(at)
    return path


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def kept(frame: DataFrame, what: str) -> DataFrame:
    """The frame as a written table: several actions read it, none works it out again, and lost executors don't matter."""
    path = passing_folder(frame.sparkSession, what)
    frame.write.parquet(path)
    back = frame.sparkSession.read.schema(frame.schema).parquet(path)
    back._tidemark_path = path
    return back


def forget(*frames: DataFrame) -> None:
    """Delete tables of ``kept`` that no later step reads."""
    for frame in frames:
        delete(frame.sparkSession, frame._tidemark_path)


def delete(spark: SparkSession, path: str) -> None:
    at, system = _system(spark, path)
    system.delete(at, True)
