"""A Bloom filter as a table of fixed size, made and asked with DataFrame functions alone.

A key's hash names one of ``2 ** SLOTS`` slots and three bits in it; a slot is one 64-bit number. The table has a row for each
slot in use, so at most ``2 ** SLOTS`` (some 40 MB where it is broadcast), whatever the number of keys. What was added is always found;
of other keys few are while the table has room (one in a thousand at two keys a slot), more as it fills. So a filter may only save
work: whoever asks it must be right for keys that pass without having been added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import fresh
from .scratch import Scratch

SLOTS = 20


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))


def _place(key: Column) -> tuple[Column, Column]:
    """The slot of a key and its three bits."""
    h = F.xxhash64(key, F.lit(17))
    return F.shiftrightunsigned(h, 64 - SLOTS), _bit(h).bitwiseOR(_bit(F.shiftright(h, 6))).bitwiseOR(_bit(F.shiftright(h, 12)))


def bloom(keys: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """The filter of ``keys[key]``: slot, bits. Combined before the exchange, written once."""
    slot, bits = _place(F.col(key))
    return scratch.write(keys.select(slot.alias("slot"), bits.alias("bits")).groupBy("slot").agg(F.bit_or("bits").alias("bits")), name)


def marked(rows: DataFrame, key: Column, filter_: DataFrame, mark: str) -> DataFrame:
    """``rows`` with the boolean ``mark``: false only if the key was never added. Rows stay where they are."""
    at, want, slot, bits = fresh([*rows.columns, mark], "bloom_at", "bloom_want", "bloom_slot", "bloom_bits")
    place, mask = _place(key)
    asked = rows.withColumns({at: place, want: mask}).join(F.broadcast(filter_.select(F.col("slot").alias(slot), F.col("bits").alias(bits))), F.col(at) == F.col(slot), "left")
    return asked.withColumn(mark, F.coalesce(F.col(bits).bitwiseAND(F.col(want)) == F.col(want), F.lit(False))).drop(at, want, slot, bits)


def passing(rows: DataFrame, key: Column, filter_: DataFrame) -> DataFrame:
    """The ``rows`` whose key may have been added."""
    at, want, slot, bits = fresh(rows.columns, "bloom_at", "bloom_want", "bloom_slot", "bloom_bits")
    place, mask = _place(key)
    asked = rows.withColumns({at: place, want: mask}).join(F.broadcast(filter_.select(F.col("slot").alias(slot), F.col("bits").alias(bits))), F.col(at) == F.col(slot))
    return asked.where(F.col(bits).bitwiseAND(F.col(want)) == F.col(want)).select(*[F.col(f"`{c}`") for c in rows.columns])


def without(rows: DataFrame, id_col: str, gone: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The ``rows`` whose id isn't in ``gone`` (one column), with all their columns; null ids match each other.

    Only rows that pass the filter of ``gone`` are exchanged for the exact anti join; all others go through as they stand.
    """
    mark, key = fresh(rows.columns, "bloom_mark", "bloom_gone")
    gone = gone.toDF(key)
    told = marked(rows, F.col(f"`{id_col}`"), bloom(gone, key, scratch, name), mark)
    asked = told.where(F.col(mark)).drop(mark)
    return told.where(~F.col(mark)).drop(mark).union(asked.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left_anti"))
