"""Tables in the shared folder: cut lineage, and outputs that are read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where nothing is set, a temporary folder serves a local master, as in
    tests; on a cluster it would be another folder on each machine, so that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Intermediate tables of one operator: cut() writes them; clear() deletes those that its result doesn't read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame) -> DataFrame:
        self.paths.append(new_path(self.spark, "cut"))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def clear(self) -> None:
        while self.paths:
            remove(self.spark, self.paths.pop())


def cut(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
