"""Hash keys: surrogate keys, version hashes, payload hashes and checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: stands for null in hashed text, since concat_ws drops nulls.
NULL_MARK = "<NULL>"


def _text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))


def hashed(*columns: str | Column) -> Column:
    """md5 of the columns' texts, parted by two bars; nulls count."""
    return F.md5(F.concat_ws("||", *[_text(c) for c in columns]))


def payload_hash(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """md5 over all columns but ``without``, in name order."""
    return hashed(*sorted(c for c in df.columns if c not in without))


def table_checksum(df: DataFrame) -> DataFrame:
    """One row: n and a sum of row hashes that doesn't depend on order."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("checksum"))


def set_fingerprint(*columns: str | Column) -> Column:
    """Aggregate: sha256 over the sorted texts of a group's distinct rows."""
    return F.sha2(F.concat_ws("||", F.sort_array(F.collect_set(F.concat_ws("::", *[_text(c) for c in columns])))), 256)
