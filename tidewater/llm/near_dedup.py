"""Near duplicates by fast similarity sketches, banding and exact verification.

*Sketch*: in round i each shingle of a document falls into one of ``COORDINATES`` bins with a hashed value to which i is added; a
bin keeps its least value. After as many rounds as there are coordinates, round i throws every shingle into bin i, so
every coordinate fills after twice as many rounds at most, and the estimate is as concentrated as that of independent minima. Most
documents fill in one to three rounds, against one hash for each coordinate in plain MinHash.

*Banding*: ``BANDS`` bands of ``ROWS`` coordinates; two sets of Jaccard similarity 0.8 share no band with a probability of 3e-6.

*Verification*: links are confirmed on full shingle sets. Documents with equal sets are one node. In a bucket, every
member is compared with three leaders (least, greatest, least by hash), so a group of thousands of near copies costs a few
comparisons a member, not one a pair. After the components of these links are known, members of one bucket that are still in
different components are told by their differences from what most of the bucket has in common, and an exact prefix filter on the
rarest differences finds every pair that can be a link. No link between components is lost and no bucket is spelled out in pairs.

Defined cases: null, empty and wordless texts have an empty set, link with nothing and stay; a text of fewer words than
a shingle has its whole sequence as one shingle; repeated rows have equal sets; rows that share an id are one node, with
the links of each; rows with a null id stay and link with nothing. Other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import map_arrow
from .bloom import bloom, passing, without
from .components import connected_components
from .pretoken import chunks
from .scratch import Scratch

BANDS, ROWS = 42, 6
COORDINATES = BANDS * ROWS
WORDS, PERCENT = 5, 80

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizing 64-bit mix of multiplications and shifts."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one set after the other, and each set's end."""
    parts: list[bytes] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        parts += text.encode().lower().split()  # bytes: only A-Z is lowered, only ASCII white space parts
        ends[i + 1] = len(parts)
    coded = pa.array(parts, pa.large_binary()).dictionary_encode()
    of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    hashes = of_word[coded.indices.to_numpy(zero_copy_only=False)] if len(parts) else np.zeros(0, np.uint64)
    n = len(hashes)
    runs = hashes.copy()
    for k in range(1, words):
        runs[: max(n - k, 0)] = mixed(runs[: max(n - k, 0)] * np.uint64(3) + hashes[k:])
    sets = []
    for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False):
        if b - a >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mixed(np.array([whole * np.uint64(5) + h]))[0]
            sets.append(np.array([whole]))
        else:
            sets.append(np.zeros(0, np.uint64))
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), cuts


def sketches(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The sketch of each set, a row each; rows of empty sets are all ones."""
    n, t = len(cuts) - 1, COORDINATES
    out = np.full(n * t, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(cuts))
    for i in range(2 * t):
        if not len(values):
            break
        with np.errstate(over="ignore"):
            h = mixed(values + np.uint64(i + 1) * _STEP)
        place = (h & np.uint64(0xFFFFFFFF)) * np.uint64(t) >> np.uint64(32) if i < t else np.full(len(values), i - t, np.uint64)
        np.minimum.at(out, owner * t + place.astype(np.int64), (np.uint64(i) << np.uint64(32)) | (h >> np.uint64(32)))
        open_rows = (out.reshape(n, t) == np.iinfo(np.uint64).max).any(axis=1)
        left = open_rows[owner]
        if not left.all():
            values, owner = values[left], owner[left]
    return out.reshape(n, t)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    with np.errstate(over="ignore"):
        keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, (len(rows), 1))
        for k in range(ROWS):
            keys = mixed(keys * np.uint64(7) + rows[:, k::ROWS])
    return keys


def _ids(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = df.select(df[id_col].alias("doc"), df[text_col].alias("text"))
    return source, source.schema["doc"].dataType.simpleString()


def sketch_table(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n (shingles), digest (of the whole set), bands (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in chunks(texts):
                values, cuts = shingle_sets(texts[a:b], words)
                sizes = np.diff(cuts)
                raw, ends = values.tobytes(), (cuts * 8).tolist()
                digests = [xxhash.xxh3_128_digest(raw[x:y]) for x, y in zip(ends, ends[1:], strict=False)]
                keys = band_keys(sketches(values, cuts)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1)), mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists], names=["doc", "n", "digest", "bands"])

    source, kind = _ids(docs, id_col, text_col)
    return map_arrow(source, run, f"doc {kind}, n long, digest binary, bands array<long>")


def set_table(docs: DataFrame, wanted: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, shingles of the documents whose id passes the filter ``wanted``: all that were added, and few others.

    Texts are read where they are and never exchanged, however many are wanted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in chunks(texts):
                values, cuts = shingle_sets(texts[a:b], words)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), lists], names=["doc", "shingles"])

    source, kind = _ids(docs, id_col, text_col)
    return map_arrow(passing(source, F.col("doc"), wanted), run, f"doc {kind}, shingles array<long>")


def _close(small: Column, large: Column, percent: int) -> Column:
    """Sets whose sizes differ too much can't be similar."""
    return F.least(small, large) * 100 >= F.greatest(small, large) * percent


class NearDuplicates:
    def __init__(self, docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"):
        self.docs, self.words, self.percent, self.id_col, self.text_col = docs, words, percent, id_col, text_col
        self.scratch = Scratch(docs.sparkSession, "near")
        self.sketch = self.scratch.write(sketch_table(docs, words, id_col, text_col), "sketch")
        known = self.sketch.where("n > 0 AND doc IS NOT NULL")
        self.nodes = self.scratch.write(known.groupBy("digest").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")

    def _shared_bands(self) -> DataFrame:
        """band, rep, n, size, leaders of every node in every band that holds more than one node.

        Bands of one node, nearly all, are only counted: one number a band is exchanged for them.
        """
        each = self.nodes.select(F.explode("bands").alias("band"), "rep", "n")
        sizes = each.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # written, so that the join with it meets two plain exchanges and a hot band can be split
        held = self.scratch.write(each.join(self.scratch.write(sizes, "sizes"), "band").select("band", "rep", "n", "size"), "held")
        me = F.struct("rep", "n")
        lead = held.groupBy("band").agg(F.min(me).alias("low"), F.max(me).alias("high"), F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "n")).alias("any"))
        some = F.array_distinct(F.array("low", "high", F.struct(F.col("any.rep").alias("rep"), F.col("any.n").alias("n"))))
        lead = self.scratch.write(lead.select("band", some.alias("leaders")), "leaders")
        return self.scratch.write(held.join(lead, "band").select("band", "rep", "n", "size", "leaders"), "shared")

    def links(self) -> DataFrame:
        """a, b: links enough to tell every component. Each is confirmed on full sets."""
        shared = self._shared_bands()
        stars = shared.select("rep", "n", F.explode("leaders").alias("to")).where((F.col("rep") != F.col("to.rep")) & _close(F.col("n"), F.col("to.n"), self.percent))
        pairs = self.scratch.write(stars.select(F.least("rep", "to.rep").alias("a"), F.greatest("rep", "to.rep").alias("b")).distinct(), "pairs")
        first = self._verified(pairs, "first")
        roots = connected_components(first, self.scratch, "first-roots")
        # bands of up to three nodes have had all their pairs compared; of the others, those in one component need no more
        larger = shared.where(F.col("size") > F.size("leaders")).select("band", F.col("leaders")[0]["rep"].alias("grp"), "rep", "n")
        larger = larger.join(roots, F.col("rep") == F.col("node"), "left").select("band", "grp", "rep", "n", F.coalesce("root", "rep").alias("root"))
        # written, so that the join with them meets two plain exchanges and a hot band can be split
        mixed_bands = self.scratch.write(larger.groupBy("band").agg(F.min("root").alias("one"), F.max("root").alias("two")).where("one <> two").select("band"), "mixed")
        open_ = self.scratch.write(larger.join(mixed_bands, "band", "left_semi").select("grp", "rep", "n", "root").distinct(), "open")
        sets = self._sets(open_.select(F.col("rep").alias("doc")), "second")
        rest = self._open_pairs(open_, sets).distinct().join(pairs, ["a", "b"], "left_anti")
        return first.unionByName(self._verified(self.scratch.write(rest, "rest"), "second", sets))

    def _open_pairs(self, open_: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b: every pair of a group (the bands that share a least node) that can be similar enough without being joined yet.

        Each set is told by its difference D from the group's reference, the shingles that most of its members have. Two sets of
        n and m shingles are linked exactly if their own difference, D xor D', has at most c (n + m) shingles, c = (100 - percent) /
        (100 + percent). With s = |D| - c n: two sets with s + s' <= 0 are linked for certain, so all members that this joins
        with the one of least s need that one link only. All other links need |D and D'| >= (s + s') / 2 > 0, which is a set
        overlap, searched by an exact prefix filter on the rarest differences with a positional filter in the join. What
        the members of a large group of near copies have in common isn't part of any D, so it pairs nothing. (Below, s is times 100 + percent.)
        """
        up, down = 100 + self.percent, 100 - self.percent
        each = open_.join(sets, F.col("rep") == F.col("doc")).select("grp", F.explode("shingles").alias("e"))
        size = open_.groupBy("grp").agg(F.count(F.lit(1)).alias("m"))
        most = each.groupBy("grp", "e").agg(F.count(F.lit(1)).alias("c")).join(size, "grp").where(F.col("c") * 2 > F.col("m"))
        # at most twice the mean of the members' sets
        reference = self.scratch.write(most.groupBy("grp").agg(F.collect_list("e").alias("ref")), "reference")
        known = open_.join(sets, F.col("rep") == F.col("doc")).join(reference, "grp", "left").withColumn("ref", F.coalesce("ref", F.array().cast("array<long>")))
        diff = known.select("grp", "rep", "n", "root", F.concat(F.array_except("shingles", "ref"), F.array_except("ref", "shingles")).alias("diff"))
        diff = self.scratch.write(diff.withColumn("d", F.size("diff").cast("long")).withColumn("s", F.col("d") * up - F.col("n") * down), "diff")
        star = self.scratch.write(diff.groupBy("grp").agg(F.min(F.struct("s", "rep", "root")).alias("star"), F.max("s").alias("top")), "star")
        placed = diff.join(star, "grp").withColumn("far", F.col("s") + F.col("star.s") > 0)
        near = placed.where(~F.col("far") & (F.col("root") != F.col("star.root"))).select(F.least("rep", "star.rep").alias("a"), F.greatest("rep", "star.rep").alias("b"))

        label = F.when(F.col("far"), F.col("root")).otherwise(F.col("star.root"))
        least = lambda x: F.greatest(F.ceil(x / (2 * up)), F.lit(1)).cast("long")
        # of two sets the one of greater s asks, the other is found
        asks = F.when(F.col("far"), F.col("d") - least(F.col("s") + F.col("star.s")))
        found = F.col("d") - least(F.greatest(F.col("s") * 2, F.col("s") - F.col("star.s")))
        searched = placed.where(F.col("top") + F.col("star.s") > 0).select("grp", "rep", "n", label.alias("label"), "d", "s", asks.alias("asks"), found.alias("found"), F.explode("diff").alias("e"))
        often = searched.groupBy("grp", "e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        # differences that only one member has come first; they pair nothing and are only counted
        shared = searched.join(often, ["grp", "e"]).groupBy("grp", "rep", "n", "label", "d", "s", "asks", "found").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("shared"))
        heads = shared.select("grp", "rep", "n", "label", "d", "s", "asks", "found", F.posexplode("shared").alias("i", "x"), (F.col("d") - F.size("shared")).alias("alone"))
        heads = heads.select("grp", F.col("x.e").alias("e"), "rep", "n", "label", "d", "s", (F.col("alone") + F.col("i")).alias("at"), "asks", "found").where((F.col("at") <= F.col("asks")) | (F.col("at") <= F.col("found")))
        heads = self.scratch.write(heads, "heads")
        one = heads.where(F.col("at") <= F.col("asks")).drop("asks", "found")
        two = heads.where(F.col("at") <= F.col("found")).select("grp", "e", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "label", "d", "s", "at")])
        first_asks = (F.col("s") > F.col("s2")) | ((F.col("s") == F.col("s2")) & (F.col("rep") > F.col("rep2")))
        enough = F.least(F.col("d") - F.col("at"), F.col("d2") - F.col("at2")) * (2 * up) >= F.col("s") + F.col("s2")
        met = one.join(two, ["grp", "e"]).where((F.col("label") != F.col("label2")) & first_asks & enough & _close(F.col("n"), F.col("n2"), self.percent))
        return near.unionByName(met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")))

    def _sets(self, ids: DataFrame, name: str) -> DataFrame:
        wanted = bloom(ids, "doc", self.scratch, f"{name}-wanted")
        return self.scratch.write(set_table(self.docs, wanted, self.words, self.id_col, self.text_col), f"{name}-sets")

    def _verified(self, pairs: DataFrame, name: str, sets: DataFrame | None = None) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        if sets is None:
            sets = self._sets(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))), name)
        left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - F.col("common")
        # not made distinct: that would bind the join to its keys, and a hot one couldn't be split
        linked = both.withColumn("common", common).where(F.col("common") * 100 >= union * self.percent).select("a", "b")
        return self.scratch.write(linked, f"{name}-links")

    def components(self) -> DataFrame:
        """doc, n, component (the least id it can reach): one row a document."""
        roots = connected_components(self.links(), self.scratch, "roots")
        of_set = self.nodes.select("digest", "rep").join(roots, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("of"), F.coalesce("root", "rep").alias("root"))
        mine = self.sketch.select("doc", "n", "digest").join(of_set, (F.col("digest") == F.col("of")) & (F.col("n") > 0) & F.col("doc").isNotNull(), "left")
        return mine.select("doc", "n", F.coalesce("root", "doc").alias("component"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component, with all their columns."""
    found = NearDuplicates(docs, words, percent, id_col, text_col)
    gone = found.scratch.write(found.components().where("doc <> component").select("doc").distinct(), "gone")
    return without(docs, id_col, gone, found.scratch, "gone-filter")
