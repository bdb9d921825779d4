"""Staged tables: results that later steps read again, in a folder that all executors and the driver share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir`` where the session sets it, else a folder in the warehouse, if
    that is in a store and not on the driver's disk; in local mode, where the driver is the only executor, a new
    temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = getattr(spark, "_skyloom_dir", None)
    if not root:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            root = tempfile.mkdtemp(prefix="spark-skyloom-")
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
            if not re.match(r"(?!file:)[a-z][a-z0-9+.-]*:", root):
                raise ValueError(f"{root} is a folder of the driver alone: set spark.checkpoint.dir to one that all executors share")
        spark._skyloom_dir = root
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later steps neither recompute it nor depend on
    one executor's disk. ``discard`` deletes it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for table in tables:
        delete(table.sparkSession, table._staged)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
