"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders of the innermost scope that is open, if any.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tabwright-")
        context.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write the frame once and read it back; with ``by``, a filter on these columns reads their part alone.

    This cuts lineage, survives the loss of executors, and gives Catalyst the true size of
    the data: a join with the result is broadcast only when the written files are smaller
    than ``spark.sql.autoBroadcastJoinThreshold`` and is shuffled otherwise. Within a ``scope`` the table lives as long as that.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tabwright/{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Own the tables that are staged inside it, and delete them at its end, also if it fails.

    Frames that read them cannot be used after that: write what is to stay inside the scope. Scopes may be nested; a table belongs
    to the innermost one.
    """
    mine: list[str] = []
    token = _owned.set(mine)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in mine:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
