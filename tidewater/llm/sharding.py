"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced together.

Rows with equal texts form a group and stay together, unless the group alone would fill half a shard: such a text (a third
of all rows may share it) is parted by a hash of the row's id. Tokens are estimated from the text's white space and bytes. Groups are hashed into ``UNITS`` units, whose size vectors are
the only thing that is summed over the corpus and seen by the driver: a few thousand rows, whatever the corpus. Units are packed in order of falling size, each into the shard where the dot product of its vector
with what the shard has left is highest, as shares of an even shard. The last units are small, so they even out what the large ones left.

A row's slot is its place in its unit plus the sizes of the shard's units before: ranks are taken within parts of units of
about ordinary size, never over a shard or a hot group.

Defined cases: null counts as the empty text, of size 1; other columns, whatever their names, are left alone; ties between shards go to the lower number; ties of the same
id and text are equal rows, whose slots may be exchanged; an empty table gives none. Results depend on ids and texts alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import squeezed, text_or_empty

UNITS = 8192
#: A unit of more than so many times the mean is ranked in parts.
LARGE = 16
#: A group of equal texts that fills more of a shard than this is parted.
WHOLE = 0.5


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(docs[text_col])
    size = F.octet_length(text).cast("long") + 1
    # white space parts most scripts, and letters of those it doesn't part take three bytes
    blanks = F.char_length(text) - F.char_length(squeezed(text))
    tokens = blanks + F.floor((F.octet_length(text) - F.char_length(text)) / 2) + 1
    return docs.select(docs[id_col].alias("doc"), size.alias("size"), tokens.cast("long").alias("tokens"), F.crc32(text.cast("binary")).alias("crc"), F.pmod(F.xxhash64(text), F.lit(UNITS)).cast("int").alias("unit"), F.pmod(F.xxhash64(text, F.lit(1)), F.lit(256)).cast("int").alias("other"))


def pack(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of ``sizes`` (non-negative vectors). Greedy by dot product with the residual capacity."""
    share = sizes / np.maximum(sizes.sum(axis=0), 1) * shards
    left, out = np.ones((shards, sizes.shape[1])), np.zeros(len(sizes), np.int64)
    order = np.lexsort((np.arange(len(sizes)), -share.max(axis=1)))
    for i in order.tolist():
        out[i] = best = int(np.argmax(left @ share[i]))
        left[best] -= share[i]
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, size (bytes and 1), crc (of the text), shard, slot (from 0 in each shard, without gaps)."""
    spark = docs.sparkSession
    rows = _sized(docs, id_col, text_col)
    units = _sums(rows, ["unit"])
    if not units:
        return rows.select("doc", "size", "crc", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    whole = np.maximum(np.sum(list(units.values()), axis=0), 1)
    share = lambda v: float((np.array(v) / whole).max())
    # units that fill much of a shard are told apart by a second hash of the text, so that only the hot text itself is ever parted
    wide = [u for (u,), v in units.items() if share(v) * shards > WHOLE]
    rows = rows.withColumn("sub", F.when(F.col("unit").isin(wide), F.col("other")).otherwise(0) if wide else F.lit(0))
    groups = {(u, 0): v for (u,), v in units.items() if u not in wide}
    if wide:
        groups |= _sums(rows.where(F.col("unit").isin(wide)), ["unit", "sub"])
    # ranks are taken in parts of ordinary size
    parts = {g: n for g, v in groups.items() if (n := min(UNITS, int(np.ceil(share(v) * UNITS / LARGE)))) > 1}
    rows = rows.withColumn("part", _part(parts))
    found = {(*g, 0): v for g, v in groups.items() if g not in parts}
    if parts:
        found |= _sums(rows.where(F.struct("unit", "sub").isin([F.struct(F.lit(u), F.lit(s)) for u, s in parts]) if len(parts) <= 64 else F.col("unit").isin([u for u, _ in parts])), ["unit", "sub", "part"], parts)
    # a group is placed whole unless it alone would fill half a shard
    packed: dict[tuple, list] = {}
    for key in sorted(found):
        packed.setdefault(key if share(groups[key[:2]]) * shards > WHOLE else key[:2], []).append(key)
    sizes = np.array([np.sum([found[k] for k in keys], axis=0) for keys in packed.values()], float)
    before, table = [0] * shards, []
    for keys, s in zip(packed.values(), pack(sizes, shards).tolist(), strict=True):
        for key in keys:
            table.append((*key, s, before[s]))
            before[s] += int(found[key][2])
    plan = F.broadcast(spark.createDataFrame(table, "unit int, sub int, part int, shard int, before long"))
    rank = F.row_number().over(Window.partitionBy("unit", "sub", "part").orderBy("doc", "crc", "size"))
    placed = rows.withColumn("rank", rank).join(plan, ["unit", "sub", "part"])
    return placed.select("doc", "size", "crc", "shard", (F.col("before") + F.col("rank") - 1).alias("slot"))


def _sums(rows: DataFrame, by: list[str], only: dict | None = None) -> dict[tuple, tuple]:
    """The size vectors by unit: bytes, tokens, rows."""
    found = rows.groupBy(*by).agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).collect()
    return {tuple(r[: len(by)]): tuple(r[len(by) :]) for r in found if only is None or tuple(r[:2]) in only}


def _part(parts: dict[tuple, int]) -> Column:
    """The part of a row: 0 in ordinary groups, else by a hash of its id."""
    if not parts:
        return F.lit(0)
    many = F.create_map(*[x for (u, s), p in sorted(parts.items()) for x in (F.lit(u * 256 + s), F.lit(p))])
    return F.coalesce(F.pmod(F.xxhash64("doc"), F.try_element_at(many, F.col("unit") * 256 + F.col("sub"))), F.lit(0)).cast("int")
