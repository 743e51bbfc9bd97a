"""Running sums over groups of any size, without a window that puts a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def running(spark: SparkSession, df: DataFrame, groups: list[str], order: list[str | Column], value: Column, folder: str) -> DataFrame:
    """``df`` with ``running``, the sum of ``value`` up to each row by ``order`` in its group, and ``total``, its group's sum.

    Rows are dealt by ranges of group and order and written once under ``folder``, a shared one, with the number of their range. A
    range's rows are summed up in it; what comes before a range is a prefix sum over one row a group and range. ``order`` must tell rows apart.
    """
    dealt = df.withColumn("_value", value).repartitionByRange(*groups, *order)
    dealt.withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    by_range = Window.partitionBy(*groups).orderBy("_range")
    sums = rows.groupBy(*groups, "_range").agg(F.sum("_value").alias("_sum"))
    before = sums.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_range").alias("_of_range"),
        F.coalesce(F.sum("_sum").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_sum").over(Window.partitionBy(*groups)).alias("total"),
    )
    inside = F.sum("_value").over(Window.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = F.col("_range") == F.col("_of_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    out = rows.withColumn("_inside", inside).join(before, same)
    return out.select(*df.columns, (F.col("_before") + F.col("_inside")).alias("running"), "total")
