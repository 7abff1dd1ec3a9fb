"""A stored table of one row a key, which takes batches of upserts.

Rows lie in buckets of their keys' hash. A batch is written as a delta, and is seen once a version that names it is; reading
merges deltas over the base, and only in buckets that have some; compaction rewrites those buckets and no others. A version
is one small file that appears whole, so a batch that breaks leaves the table as it was, and its repeat writes over it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..operators.state import dedup_latest, keyed_upsert, merge_upsert, newest_leaves
from .shared import exists, remove


class KeyedTable:
    """The table under path. schema: its columns, keys among them. merge: whether fields that a row leaves null keep their
    values (inside structs too); else the last row of a key replaces it whole.

    One writer at a time; batches are numbered upwards, as micro-batches are. Null keys are a key."""

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, keys: list[str], buckets: int = 32, merge: bool = False):
        self.spark, self.path, self.keys, self.buckets, self.merge = spark, path.rstrip("/"), keys, buckets, merge
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> dict:
        """n, base (bucket -> the version whose folder holds it), deltas ([batch, buckets] in order) and upto (batches up to it are
        in the base)."""
        at, fs = self._fs(f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        if not (known := [int(x.removesuffix(".json")) for x in names if x.endswith(".json") and x[0] != "_"]):
            return {"n": 0, "base": {}, "deltas": [], "upto": -1}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/versions/{max(known)}.json").collect()))

    def _switch(self, version: dict) -> None:
        version["n"] += 1
        new, fs = self._fs(f"{self.path}/versions/_{version['n']}.json")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(version).encode()))
        out.close()
        final, _ = self._fs(f"{self.path}/versions/{version['n']}.json")
        if fs.exists(final) or not fs.rename(new, final):
            raise RuntimeError(f"version {version['n']} was written by another writer")

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def upsert(self, batch: DataFrame, number: int, seq: str) -> None:
        """Take batch (columns of the table, and seq, which orders a key's rows) as batch `number`. One that was taken before
        changes nothing."""
        version = self.version()
        if number <= version["upto"] or any(number == d[0] for d in version["deltas"]):
            return
        rows = (newest_leaves if self.merge else dedup_latest)(batch.select(*self.schema.names, F.col(seq).alias("_seq")), self.keys, "_seq")
        rows = rows.select(*self.schema.names, self._bucket())
        at = f"{self.path}/delta/batch={number}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
        touched = [r.bucket for r in self.spark.read.schema(self._stored()).parquet(at).select("bucket").distinct().collect()]  # at most self.buckets
        version["deltas"] = sorted([*version["deltas"], [number, sorted(touched)]])
        self._switch(version)

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields]).add("bucket", IntegerType())

    def _base(self, version: dict, buckets: set[int]) -> DataFrame:
        paths = [f"{self.path}/base/v={v}/bucket={b}" for b, v in version["base"].items() if int(b) in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _touched(self, version: dict) -> set[int]:
        return {b for _, buckets in version["deltas"] for b in buckets}

    def _merged(self, version: dict) -> DataFrame:
        """The rows of the buckets that deltas touch."""
        deltas = None
        for number, buckets in version["deltas"]:
            if buckets:
                one = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/delta/batch={number}/bucket={b}" for b in buckets)).withColumn("_seq", F.lit(number))
                deltas = one if deltas is None else deltas.unionByName(one)
        base = self._base(version, self._touched(version))
        if deltas is None:
            return base
        return (merge_upsert if self.merge else keyed_upsert)(base, deltas, self.keys, "_seq").select(*self.schema.names)

    def read(self) -> DataFrame:
        """All rows. Buckets without deltas are read as they lie, without a shuffle."""
        version = self.version()
        touched = self._touched(version)
        rest = self._base(version, {int(b) for b in version["base"]} - touched)
        return rest.unionByName(self._merged(version)) if touched else rest

    def compact(self) -> None:
        """Rewrite the buckets that have deltas into the base, and switch to it."""
        version = self.version()
        if not (touched := self._touched(version)):
            return
        n = version["n"] + 1
        rows = self._merged(version).select(*self.schema.names, self._bucket())
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/v={n}")
        version["base"] |= {str(b): n for b in sorted(touched)}
        version["upto"] = max(d[0] for d in version["deltas"])
        version["deltas"] = []
        self._switch(version)

    def clean(self) -> None:
        """Delete what the newest version doesn't name: old buckets and deltas. For when no reader has an older one open."""
        version = self.version()
        live = {f"base/v={v}/bucket={b}" for b, v in version["base"].items()} | {f"delta/batch={d[0]}" for d in version["deltas"]}
        for kind, deep in (("base", True), ("delta", False)):
            at, fs = self._fs(f"{self.path}/{kind}")
            for one in fs.listStatus(at) if fs.exists(at) else []:
                inner = fs.listStatus(one.getPath()) if deep else [one]
                for folder in inner:
                    name = folder.getPath().toUri().getPath().split(f"/{kind}/")[-1]
                    if folder.isDirectory() and f"{kind}/{name}" not in live:
                        remove(self.spark, folder.getPath().toString())

    def exists(self) -> bool:
        return exists(self.spark, f"{self.path}/versions")
