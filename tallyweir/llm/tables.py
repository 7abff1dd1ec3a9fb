"""Reading the given tables, cutting lineage in the shared folder, and names that don't clash."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where nothing is set, a temporary folder serves a local master, as in
    tests; on a cluster it would be another folder on each machine, so that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: later steps restart from there when executors are lost."""
    return written(df, new_path(df.sparkSession, "cut"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Intermediate tables of one operator that its result doesn't read: cut() writes them, clear() deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        self.paths.append(new_path(self.spark, "cut"))
        return written(df, self.paths[-1], compression)

    def clear(self) -> None:
        while self.paths:
            remove(self.spark, self.paths.pop())


def private(taken: Iterable[str], *names: str) -> list[str]:
    """names, made longer where a column of taken is called so (in whatever case)."""
    have, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
    return out


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def ddl(df: DataFrame, names: Iterable[str]) -> str:
    """name type, ... of columns of df."""
    return ", ".join(f"{quoted(c)} {df.schema[c].dataType.simpleString()}" for c in names)


def by_plain_names(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """step(docs), whose columns are docs' own, for names that Arrow steps can't take (with points or backticks)."""
    if all(re.fullmatch(r"\w+", c) for c in docs.columns):
        return step(docs)
    plain = [c if re.fullmatch(r"\w+", c) else private(docs.columns, f"column{k}")[0] for k, c in enumerate(docs.columns)]
    return step(docs.toDF(*plain)).toDF(*docs.columns)
