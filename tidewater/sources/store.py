"""A versioned table over Parquet: each commit lists the files of a version; the newest commit file is the table.

Data files are immutable and shared between versions, so append, restore and truncate cost what they add. A version is one commit file,
created under its number with overwriting forbidden: a second writer of the same version fails, as surely as the file system's
exclusive create does (HDFS, object stores with conditional writes). A change that reads the table commits on the version it has read, so a commit in
between makes it fail instead of being undone. Readers pass over commit files that aren't written yet.
All paths go through Hadoop's file system, so a table can live wherever Spark writes.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.keys import table_checksum
from ..operators.state import classify, upsert


#: An empty commit file of this age is what a writer left that died; the next one takes its number.
ABANDONED_SECONDS = 600
#: Parts are named like partitions, so that one scan reads any number of them.
PART = "tidewater_part"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), tuple(partition_by)
        jvm = spark.sparkContext._jvm
        self._Path, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- commits
    def versions(self) -> list[int]:
        log = self._Path(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(log) if s.getPath().getName().endswith(".json") and s.getLen() > 0)

    def exists(self) -> bool:
        return bool(self.versions())

    def _commit_of(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"{self.path} has no version")
        version = known[-1] if version is None else version
        stream = self._fs.open(self._Path(f"{self.path}/_log/{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, operation: str, parts: list[str], schema: StructType, based_on: int | None) -> int:
        version = (self.versions() or [-1])[-1] + 1
        if based_on is not None and version != based_on + 1:
            raise RuntimeError(f"{self.path} has moved on from version {based_on}")
        body = {"version": version, "timestamp": time.time(), "operation": operation, "parts": parts, "schema": json.loads(schema.json()), "partition_by": list(self.partition_by)}
        target = self._Path(f"{self.path}/_log/{version:012d}.json")
        if self._fs.exists(target):
            left = self._fs.getFileStatus(target)
            if left.getLen() == 0 and time.time() - left.getModificationTime() / 1000 > ABANDONED_SECONDS:
                self._fs.delete(target, False)
        try:
            out = self._fs.create(target, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"version {version} of {self.path} was written by another") from e
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        return version

    def _write(self, df: DataFrame) -> str:
        part = f"{self.path}/data/{PART}={uuid.uuid4().hex}"
        writer = df.write.partitionBy(*self.partition_by) if self.partition_by else df.write
        writer.parquet(part)
        return part

    # --- reading
    def read(self, version: int | None = None) -> DataFrame:
        commit = self._commit_of(version)
        schema = StructType.fromJson(commit["schema"])
        if not commit["parts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*commit["parts"]).select(*schema.names)

    def history(self) -> DataFrame:
        rows = [(c["version"], c["timestamp"], c["operation"], len(c["parts"])) for c in map(self._commit_of, self.versions())]
        return self.spark.createDataFrame(rows, "version long, at double, operation string, parts int").withColumn("timestamp", F.timestamp_seconds("at")).drop("at")

    # --- writing
    def overwrite(self, df: DataFrame, operation: str = "overwrite", based_on: int | None = None) -> int:
        """A new version of ``df`` alone; its schema too. A ``df`` that reads this table names the version it reads."""
        before = (self.versions() or [None])[-1] if based_on is None else based_on
        return self._commit(operation, [self._write(df)], df.schema, before)

    def newest(self) -> tuple[int, DataFrame]:
        """The newest version and its rows."""
        version = self._commit_of()["version"]
        return version, self.read(version)

    def append(self, df: DataFrame) -> int:
        if not self.exists():
            return self.overwrite(df, "append")
        commit = self._commit_of()
        schema = StructType.fromJson(commit["schema"])
        if {f.name: f.dataType for f in df.schema} != {f.name: f.dataType for f in schema}:
            raise ValueError(f"{self.path}: appended columns differ from the table's")
        return self._commit("append", [*commit["parts"], self._write(df.select(*schema.names))], schema, commit["version"])

    def upsert(self, source: DataFrame, keys: list[str]) -> int:
        if not self.exists():
            return self.overwrite(source, "upsert")
        version, df = self.newest()
        return self.overwrite(upsert(df, source.select(*df.columns), keys), "upsert", version)

    def upsert_newest(self, source: DataFrame, keys: list[str], order: str) -> int:
        """Only newer rows replace; see ``classify``."""
        version, df = self.newest()
        moved = classify(df, source, keys, order).where("action <> 'noop'").drop("action")
        return self.overwrite(upsert(df, moved, keys), "upsert newest", version)

    def update(self, condition: Column, values: dict[str, Column]) -> int:
        hit = F.coalesce(condition, F.lit(False))
        version, df = self.newest()
        return self.overwrite(df.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]), "update", version)

    def delete(self, condition: Column) -> int:
        """Rows for which the condition is null stay."""
        version, df = self.newest()
        return self.overwrite(df.where(~F.coalesce(condition, F.lit(False))), "delete", version)

    def truncate(self) -> int:
        commit = self._commit_of()
        return self._commit("truncate", [], StructType.fromJson(commit["schema"]), commit["version"])

    def restore(self, version: int) -> int:
        commit = self._commit_of(version)
        return self._commit(f"restore {version}", commit["parts"], StructType.fromJson(commit["schema"]), self.versions()[-1])

    def clone(self, target: str) -> VersionedTable:
        """A full copy, proven by checksum."""
        other = VersionedTable(self.spark, target, self.partition_by)
        other.overwrite(self.read(), "clone")
        a, b = table_checksum(self.read()).first(), table_checksum(other.read()).first()
        if a != b:
            raise RuntimeError(f"clone {target} differs from {self.path}")
        return other

    # --- upkeep
    def compact(self, sort_by: list[str], files: int | None = None) -> int:
        """Rewrites by range of ``sort_by``, so that footers' minima and maxima skip files."""
        version, df = self.newest()
        df = df.repartitionByRange(files, *sort_by) if files else df.repartitionByRange(*sort_by)
        return self.overwrite(df.sortWithinPartitions(*sort_by), "compact", version)

    def vacuum(self, retain_hours: float = 720, keep_versions: int = 1) -> int:
        """Removes versions older than ``retain_hours``, but never the last ``keep_versions``, and data of that age that no version left names.

        Younger data may belong to a writer that hasn't committed yet, so 0 hours is for tables that nobody writes. Returns how many parts went.
        """
        known, limit = self.versions(), time.time() - retain_hours * 3600
        old = [v for v in known[: max(0, len(known) - max(keep_versions, 1))] if self._commit_of(v)["timestamp"] <= limit]
        used = {p for v in known if v not in old for p in self._commit_of(v)["parts"]}
        for v in old:
            self._fs.delete(self._Path(f"{self.path}/_log/{v:012d}.json"), False)
        gone = 0
        for s in self._fs.listStatus(self._Path(f"{self.path}/data")):
            if f"{self.path}/data/{s.getPath().getName()}" not in used and s.getModificationTime() / 1000 <= limit:
                self._fs.delete(s.getPath(), True)
                gone += 1
        return gone
