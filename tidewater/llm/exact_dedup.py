"""Exact duplicates through a log-structured merge index of text digests.

*Memtable and flush*: every scan task turns its rows into (digest, length, id) entries and flushes them as one run,
sorted by digest. *Compaction*: the runs flushed since the last one, and the level it left, merge into the next
level, which keeps for each digest the entry that stays and the group's size. *Filter*: each level has a filter of the digests that are hit
(held by more than one row), of fixed size. Rows ask it where they are: those that don't pass stand alone and aren't exchanged. *Byte verification*:
the texts of rows that pass are told apart by digest and whole text, first in each task, so that a text held by a third of all rows travels once a task;
a digest with more than one text is grouped anew by whole texts.

So what travels is a digest and an id a row, and the different texts of the rows that are hit.

Defined cases: a null text counts as empty; empty texts equal each other; repeated rows are members like any other, so
of two wholly equal rows each gets an output row and exactly one id stays; a null id sorts after every other id. Other columns, whatever
their names, are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import bloom, marked, passing, without
from .naming import fresh
from .scratch import Scratch
from .text import squeezed, text_or_empty


def _best() -> Column:
    """Orders entries of one digest: more code points first, then the smaller id, null ids last."""
    return F.struct((-F.col("chars")).alias("neg"), F.col("doc").isNull().alias("none"), F.col("doc"))


def _digest(whole: Column) -> Column:
    return F.unhex(F.sha2(whole, 256))


class MergeIndex:
    """Digest index over one or more flushed batches of documents."""

    def __init__(self, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text"):
        self.scratch, self.id_col, self.text_col = Scratch(spark, "exact"), id_col, text_col
        self.runs: list[DataFrame] = []
        self.sources: list[DataFrame] = []
        self.level: DataFrame | None = None
        self.hit_filter: DataFrame | None = None
        self._merged = 0  # runs that are part of the level

    def entries(self, docs: DataFrame) -> DataFrame:
        text = text_or_empty(docs[self.text_col])
        return docs.select(docs[self.id_col].alias("doc"), _digest(squeezed(text)).alias("digest"), F.char_length(text).cast("long").alias("chars"))

    def flush(self, docs: DataFrame) -> DataFrame:
        """Writes the digests of ``docs`` as sorted runs, one a task."""
        run = self.scratch.write(self.entries(docs).sortWithinPartitions("digest"), f"run-{len(self.runs)}")
        self.runs.append(run)
        self.sources.append(docs)
        return run

    def rows(self) -> DataFrame:
        """Every entry of every run."""
        return reduce(DataFrame.unionByName, self.runs)

    def compact(self) -> DataFrame:
        """Merges the runs flushed since the last call into the level: digest, the best entry, the size of the group."""
        new = [run.select("digest", _best().alias("best"), F.lit(1).cast("long").alias("size")) for run in self.runs[self._merged :]]
        parts = [*([self.level] if self.level else []), *new]
        merged = reduce(DataFrame.unionByName, parts).groupBy("digest").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        self._merged = len(self.runs)
        self.level = self.scratch.write(merged.sortWithinPartitions("digest"), f"level-{self._merged}")
        self.hit_filter = bloom(self.hits(), "digest", self.scratch, f"filter-{self._merged}")
        return self.level

    def hits(self) -> DataFrame:
        """digest, keep, size of the digests of more than one row."""
        return self.level.where(F.col("size") > 1).select("digest", F.col("best.doc").alias("keep"), "size")

    def _hit_texts(self) -> DataFrame:
        """doc, chars, digest and squeezed text of the rows whose digest passes the filter."""
        out = []
        for docs in self.sources:
            text = text_or_empty(docs[self.text_col])
            rows = docs.select(docs[self.id_col].alias("doc"), F.char_length(text).cast("long").alias("chars"), squeezed(text).alias("whole")).withColumn("digest", _digest(F.col("whole")))
            out.append(passing(rows, F.col("digest"), self.hit_filter))
        return reduce(DataFrame.unionByName, out)

    def verify(self) -> DataFrame:
        """Digests that stand for more than one text; no rows unless digests collide."""
        texts = self._hit_texts().select("digest", "whole").distinct()
        unlike = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
        return self.scratch.write(unlike.select("digest"), f"collisions-{self._merged}")

    def members(self) -> DataFrame:
        """One row for each document: doc, keep, size, digest. Call after ``compact``."""
        unlike = self.verify()
        told = marked(self.rows(), F.col("digest"), self.hit_filter, "hit")
        alone = told.where("NOT hit").select("doc", F.col("doc").alias("keep"), F.lit(1).cast("long").alias("size"), "digest")
        joined = told.where("hit").join(self.hits().withColumnRenamed("digest", "same"), F.col("digest") == F.col("same"), "left")
        held = F.col("same").isNotNull()  # else the filter let a single row pass
        out = alone.unionByName(joined.select("doc", F.when(held, F.col("keep")).otherwise(F.col("doc")).alias("keep"), F.coalesce("size", F.lit(1)).cast("long").alias("size"), "digest"))
        if unlike.isEmpty():
            return out
        texts = self._hit_texts().join(unlike, "digest", "left_semi")
        best = texts.groupBy("digest", "whole").agg(F.min(_best()).alias("best"), F.count(F.lit(1)).alias("n"))
        again = texts.join(best, ["digest", "whole"]).select("doc", F.col("best.doc").alias("keep"), F.col("n").alias("size"), "digest")
        return out.join(unlike, "digest", "left_anti").select("doc", "keep", "size", "digest").unionByName(again)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, keep (the id that stays), size (of its group), digest (SHA-256 of the text without white space)."""
    index = MergeIndex(docs.sparkSession, id_col, text_col)
    index.flush(docs)
    index.compact()
    return index.members()


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Ids are taken as unique; rows that share an id and a text count as one row and one of them stays.
    """
    index = MergeIndex(docs.sparkSession, id_col, text_col)
    index.flush(docs)
    index.compact()
    found = index.scratch.write(index.members(), "members")
    gone = found.where(~F.col("doc").eqNullSafe(F.col("keep")))
    twice = index.scratch.write(found.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "twice")
    if twice.isEmpty():
        return without(docs, id_col, gone.select("doc"), index.scratch, "gone")
    # rows whose id stands more than once are told by id and text
    same, lost, own, of = fresh(docs.columns, "same", "lost", "own", "of")
    some = docs.join(twice.toDF(same), docs[id_col].eqNullSafe(F.col(same)), "left_semi").withColumn(own, _digest(squeezed(text_or_empty(F.col(f"`{text_col}`")))))
    some = some.join(gone.select(F.col("doc").alias(lost), F.col("digest").alias(of)), F.col(f"`{id_col}`").eqNullSafe(F.col(lost)) & (F.col(own) == F.col(of)), "left_anti")
    some = some.dropDuplicates([id_col, own]).drop(own)
    ids = gone.select("doc").unionByName(twice)
    return without(docs, id_col, ids, index.scratch, "gone").union(some)
