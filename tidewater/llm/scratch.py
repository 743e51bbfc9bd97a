"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, the context's own checkpoint folder.

    With neither, a local session (tests) gets a temporary folder and a cluster gets one under the warehouse,
    which is shared; machine-local folders are never used on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        root = tempfile.mkdtemp(prefix="scratch-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


class Scratch:
    """One operator call's written tables; ``drop`` removes them once the result has been read."""

    _made: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        Scratch._made.append(self)

    def write(self, df: DataFrame, table: str, **options: str) -> DataFrame:
        """Writes ``df`` as Parquet and returns it as read back, so that a lost executor costs no recomputation."""
        at = f"{self.path}/{table}"
        df.write.options(**options).parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self) -> None:
        if self in Scratch._made:
            Scratch._made.remove(self)
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def dropped_after() -> Iterator[None]:
    """What operators write inside the block goes at its end: results must have been stored by then."""
    before = list(Scratch._made)
    try:
        yield
    finally:
        for made in [s for s in Scratch._made if s not in before]:
            made.drop()
