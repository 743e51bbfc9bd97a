"""Raw snapshots: untyped CSV, file metadata, small literal and generated frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header, comma, quotes escaped by quotes; every column a string. Directories like ``ingestion_date=2026-01-31`` become a date column."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).options(header=True, sep=",", quote='"', escape='"', inferSchema=False).csv(path)


def write_raw_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append").options(header=True, quote='"', escape='"')
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)


def append_daily_parquet(df: DataFrame, path: str, day_column: str = "ingestion_date") -> None:
    """One file a day, as daily extracts arrive."""
    df.coalesce(1).write.mode("append").partitionBy(day_column).parquet(path)


def file_metadata(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct files behind ``df`` with ``columns``: path, name, size, modification time. ``df`` must be the scan itself: views hide it."""
    meta = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_modification_time").alias("modified_at")]
    return df.select(*columns, *meta).distinct()


def environment_view(df: DataFrame, name: str) -> DataFrame:
    """A temporary view under the environment's name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
