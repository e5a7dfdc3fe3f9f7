"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which every executor reaches.

    Where none is set, a session whose tasks all run on this machine, as in tests, gets one; any other is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        folder = tempfile.mkdtemp(prefix="tessera-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage is cut and it is computed once.

    Shuffle files of the write go when it ends, as nothing reads them again. ``dropped`` deletes the table.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tessera-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote, once all that is made of them is written."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def present(df: DataFrame) -> bool:
    """Whether the table that ``saved`` wrote is still there."""
    spark, path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
