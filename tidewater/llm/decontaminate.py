"""Benchmark decontamination with a positional inverted index of the training texts; DataFrame functions only.

*Index*: the words of every document are counted as far as tests use them, and for each test window its two rarest words
are found. The postings of those words (word, document, position) are stored as one sorted table, rarest words with the
words around them; an end mark gives each document's length. *Search*: the list of a window's rarest word, each position less the word's offset in the window, is
intersected with the adjusted list of its second rarest word; what remains is checked word by word. *Proximity*: the
same lists, joined on the document with a bounded distance instead of an equal start. There a window's two words are the
rarest that do occur, so that copies with another word put in or in place of one are near; a copy in which one of the two was replaced isn't.

Words of documents meet those of the benchmark through a filter of fixed size, where they stand; what it lets pass by mistake is a posting that no
window asks for. Documents are never exchanged, at any size of the benchmark: only postings are, and matches come back combined by document.

Defined cases: null, empty and wordless texts have no words and no hits; items without words have no window; items
of fewer words than a window are one window of what they have; equal windows of different items are searched once
and count for each; documents that share an id share their matches; null ids match each other. Other columns, whatever
their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import bloom, marked, passing, without
from .scratch import Scratch
from .text import spaced_words, text_or_empty, word_array

WINDOW = 10
#: Near means that two words stand up to so many words further apart or closer than in the window.
DISTANCE = 3
#: Stands in the index after the last word of every document, so that its position is the document's length.
END = ""

class PhraseIndex:
    """Postings of the words that identify the windows of a benchmark."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", near: bool = True):
        """Without ``near``, windows with a word that no document has aren't indexed: phrases don't need them, proximity does."""
        self.near = near
        self.spark: SparkSession = docs.sparkSession
        self.scratch, self.window = Scratch(self.spark, "phrases"), window
        self.docs = docs.select(docs[id_col].alias("doc"), spaced_words(text_or_empty(docs[text_col])).alias("spaced"))
        items = benchmark.select(benchmark[item_col].alias("item"), word_array(spaced_words(text_or_empty(benchmark[item_text]))).alias("words"))
        self._windows(items.where(F.size("words") > 0))
        self._rarest()
        self._postings()

    def _windows(self, items: DataFrame) -> None:
        last = F.greatest(F.size("words") - self.window, F.lit(0))
        cut = items.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, self.window))).alias("terms"))
        cut = cut.select("item", "terms", F.sha2(F.array_join("terms", " "), 256).alias("win"))
        of_items = self.scratch.write(cut.dropDuplicates(["item", "win"]), "windows")
        self.items = of_items.select("item", "win")
        self.windows = of_items.groupBy("win").agg(F.first("terms").alias("terms"))

    def _tokens(self) -> DataFrame:
        """doc, words, pos, term: every word at its place, and at the end of every document the empty word ``END``."""
        words = F.when(F.col("spaced") == "", F.array(F.lit(END))).otherwise(F.split(F.concat("spaced", F.lit("  ")), "  "))
        # never empty, so the outer form adds no row; for the other, a filter would be inferred that splits every text again
        return self.docs.select("doc", words.alias("words")).select("doc", "words", F.posexplode_outer("words").alias("pos", "term"))

    def _rarest(self) -> None:
        """For each window: its two rarest words with their offsets, by counts over all documents."""
        terms = self.scratch.write(self.windows.select(F.explode("terms").alias("term")).distinct(), "terms")
        met = passing(self._tokens().select("term"), F.col("term"), bloom(terms, "term", self.scratch, "terms-filter"))
        counts = met.groupBy("term").agg(F.count(F.lit(1)).alias("n")).join(terms, "term", "left_semi")
        counts = self.scratch.write(counts, "counts")
        each = self.windows.select("win", "terms", F.posexplode("terms").alias("offset", "term"))
        ranked = each.join(counts, "term", "left").groupBy("win", "term").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"), F.min("offset").alias("offset"), F.first("terms").alias("terms"))
        order = F.array_sort(F.collect_list(F.struct("n", "term", "offset")))
        best = ranked.groupBy("win").agg(F.first("terms").alias("terms"), order.alias("order"))
        # a window with a word that no document has occurs nowhere, but may be near
        whole = F.col("order")[0]["n"] > 0
        best = best.withColumn("whole", whole).withColumn("order", F.filter("order", lambda o: o["n"] > 0))
        best = best.where((F.size("order") > 1) | F.col("whole") if self.near else F.col("whole"))
        self.searched = self.scratch.write(best.select("win", "terms", "whole", F.col("order")[0].alias("one"), F.try_element_at("order", F.lit(2)).alias("two")), "searched")

    def _postings(self) -> None:
        ones = self.searched.select(F.col("one.term").alias("term"), F.col("whole").alias("rarest"))
        twos = self.searched.where("two IS NOT NULL").select(F.col("two.term").alias("term"))
        ends = self.spark.range(1).select(F.lit(END).alias("term"))
        listed = bloom(ones.select("term").unionByName(twos).unionByName(ends), "term", self.scratch, "listed")
        rarest = bloom(ones.where("rarest"), "term", self.scratch, "rarest")
        found = marked(passing(self._tokens(), F.col("term"), listed), F.col("term"), rarest, "rarest")
        lead = F.greatest(F.col("pos") - (self.window - 1), F.lit(0))
        around = F.when(F.col("rarest"), F.slice("words", lead + 1, F.lit(2 * self.window - 1)))
        postings = found.select("term", "doc", F.col("pos").cast("int").alias("pos"), (F.col("pos") - lead).cast("int").alias("lead"), around.alias("around"))
        self.postings = self.scratch.write(postings.sortWithinPartitions("term", "doc", "pos"), "postings")

    def _list(self, which: str, whole: bool = True) -> DataFrame:
        """win, doc and the start each posting of a window's word stands for; of windows all of whose words occur, or of all."""
        wanted = self.searched.where(F.col(which).isNotNull() & (F.col("whole") | F.lit(not whole))).select("win", "terms", F.col(which)["term"].alias("term"), F.col(which)["offset"].alias("offset"))
        return self.postings.join(wanted, "term").withColumn("start", F.col("pos") - F.col("offset"))

    def phrases(self) -> DataFrame:
        """win, doc, start, length of every occurrence of a window."""
        first = self._list("one").where("start >= 0 AND lead >= offset")
        same = F.slice("around", F.col("lead") - F.col("offset") + 1, F.size("terms")) == F.col("terms")
        second = self._list("two").select(F.col("win").alias("win2"), F.col("doc").alias("doc2"), F.col("start").alias("start2"))
        alone = self.searched.where("whole AND two IS NULL").select(F.col("win").alias("alone"))
        first = first.where(same).select("win", "doc", "start", F.size("terms").alias("length"))
        pairs = (F.col("win") == F.col("win2")) & (F.col("start") == F.col("start2")) & F.col("doc").eqNullSafe(F.col("doc2"))
        both = first.join(second, pairs, "left_semi")
        return both.unionByName(first.join(alone, F.col("win") == F.col("alone"), "left_semi"))

    def proximity(self, distance: int) -> DataFrame:
        """win, doc, start, gap: places where a window's two rarest words stand in their order, up to ``distance`` words further apart or closer than in the window."""
        if not self.near:
            raise ValueError("the index was made without near")
        one = self._list("one", whole=False).select("win", "doc", F.col("start").alias("start"), "pos", "offset")
        two = self._list("two", whole=False).select(F.col("win").alias("win2"), F.col("doc").alias("doc2"), F.col("start").alias("start2"), F.col("pos").alias("pos2"), F.col("offset").alias("offset2"))
        bucket = max(1, distance + 1)
        one = one.withColumn("cell", F.explode(F.array(*[F.floor(F.col("start") / bucket) + i for i in (-1, 0, 1)])))
        two = two.withColumn("cell2", F.floor(F.col("start2") / bucket))
        near = one.join(two, (F.col("win") == F.col("win2")) & F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("cell") == F.col("cell2")))
        ordered = (F.col("pos") < F.col("pos2")) == (F.col("offset") < F.col("offset2"))
        gap = F.abs(F.col("start") - F.col("start2"))
        return near.where(ordered & (gap <= distance)).groupBy("win", "doc", "start").agg(F.min(gap).alias("gap"))

    def report(self) -> DataFrame:
        """One row a document: doc, n_words, n_hit (words inside any occurrence), items (their sorted ids, null: none)."""
        found = self.scratch.write(self.phrases(), "found")
        spans = found.select("doc", "start", "length").distinct()
        inside = F.array_distinct(F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("length") - 1))))
        hits = spans.groupBy("doc").agg(F.size(inside).cast("long").alias("n_hit"))
        items = found.select("doc", "win").distinct().join(self.items, "win").groupBy("doc").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
        both = hits.withColumnRenamed("doc", "doc_h").join(items, F.col("doc_h").eqNullSafe(F.col("doc"))).drop("doc")
        lengths = self.postings.where(F.col("term") == END).select("doc", F.col("pos").cast("long").alias("n_words"))
        out = lengths.join(both, F.col("doc").eqNullSafe(F.col("doc_h")), "left")
        return out.select("doc", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items")

    def near_report(self, distance: int = DISTANCE) -> DataFrame:
        """One row a document: doc, n_near (windows whose two words stand near each other), least_gap, near_items (sorted ids, null: none)."""
        found = self.scratch.write(self.proximity(distance).groupBy("win", "doc").agg(F.min("gap").alias("gap")), "near")
        hits = found.groupBy("doc").agg(F.count(F.lit(1)).alias("n_near"), F.min("gap").cast("int").alias("least_gap")).withColumnRenamed("doc", "doc_h")
        items = found.join(self.items, "win").groupBy("doc").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("near_items"))
        both = hits.join(items, F.col("doc_h").eqNullSafe(F.col("doc"))).drop("doc")
        out = self.postings.where(F.col("term") == END).select("doc").join(both, F.col("doc").eqNullSafe(F.col("doc_h")), "left")
        return out.select("doc", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "least_gap", "near_items")


def items_digest(items: Column) -> Column:
    return F.sha2(F.coalesce(F.array_join(items, ","), F.lit("")), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of ``docs`` without any window of ``benchmark``, with all their columns."""
    index = PhraseIndex(docs, benchmark, id_col=id_col, near=False, **columns)
    hit = index.scratch.write(index.phrases().select("doc").distinct(), "hit")
    return without(docs, id_col, hit, index.scratch, "hit-filter")
