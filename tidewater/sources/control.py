"""Small control files in JSON, and file trees: atomic writes, listings, verified copies."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import SparkSession


def read_json(path: str | Path) -> dict | None:
    p = Path(path)
    return json.loads(p.read_text(encoding="utf-8")) if p.exists() else None


def write_json(path: str | Path, value: dict) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    temporary = p.with_suffix(p.suffix + ".tmp")
    temporary.write_text(json.dumps(value, indent=1, sort_keys=True, default=str), encoding="utf-8")
    os.replace(temporary, p)


class ControlFiles:
    """JSON files under a folder of any Hadoop file system: the control root can stand beside the tables."""

    def __init__(self, root: str, spark):
        self.root, self._jvm, self._conf = str(root).rstrip("/"), spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}.json")
        return path, path.getFileSystem(self._conf)

    def read(self, name: str) -> dict | None:
        path, fs = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """Written aside and renamed; readers never see half a file."""
        path, fs = self._at(name)
        aside = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}.json.new")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True, default=str).encode()))
        out.close()
        if fs.exists(path):
            fs.delete(path, False)
        if not fs.rename(aside, path):
            raise OSError(f"{path} can't be replaced")


class LocalFiles:
    """The same over local paths."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def read(self, name: str) -> dict | None:
        return read_json(self.root / f"{name}.json")

    def write(self, name: str, value: dict) -> None:
        write_json(self.root / f"{name}.json", value)


def listing(spark: SparkSession, root: str) -> dict[str, int]:
    """Relative path to size of every file under ``root``, on whatever file system it is."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(root))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base, files, out = fs.makeQualified(top).toUri().getPath().rstrip("/") + "/", fs.listFiles(top, True), {}
    while files.hasNext():
        f = files.next()
        out[f.getPath().toUri().getPath().removeprefix(base)] = f.getLen()
    return dict(sorted(out.items()))


def verified_copy(spark: SparkSession, source: str, target: str) -> int:
    """Copies a tree and compares paths and sizes; returns the number of files. Source and target may be on different file systems."""
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = path(str(source)), path(str(target))
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf):
        raise OSError(f"{source} couldn't be copied")
    want, have = listing(spark, source), listing(spark, target)
    wrong = [p for p, n in want.items() if have.get(p) != n]
    if wrong:
        raise OSError(f"{len(wrong)} files differ after the copy, first {wrong[0]}")
    return len(want)


def verified_move(spark: SparkSession, source: str, target: str) -> int:
    """The source goes only after the copy has been verified."""
    n = verified_copy(spark, source, target)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(source))
    top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(top, True)
    return n
