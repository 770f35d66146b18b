"""Write an expensive result once, so that every consumer reads the table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# A task holds the row group that it writes, 128 MiB of texts unless told otherwise.
ROW_GROUP_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that all executors of this session share, if the session names one."""
    return spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; a local one only where a local session names none."""
    folder = shared_folder(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="recordloom-")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(
    df: DataFrame, path: str | None = None, partition_by: Sequence[str] = (), again: bool = False
) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back.

    Model calls in ``df`` run once, however many consumers follow, and a lost executor
    costs later steps nothing but a re-read.  ``partition_by`` gives each value a folder
    of its own, so that filters on it read nothing else.  An existing path is an error
    unless it is written ``again``.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "staged")
    mode = "overwrite" if again else "errorifexists"
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(df: DataFrame, path: str) -> None:
    """Add the rows of ``df`` to the table at ``path``, task by task.

    A task writes its file aside and moves it into the table when it commits (the second
    version of the file committer), so what is in the table after a failure are the whole
    files of the tasks that were done: the table is its own manifest.  Spark lets one attempt
    of a task commit, and all attempts of a task use one file name, so an attempt that is lost
    while it commits is replaced, not doubled.  The move is one step on file systems that
    rename; on a store that copies instead, set a committer made for it.
    """
    writer = df.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def staged_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """What tasks have committed to the table at ``path``; None if there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
