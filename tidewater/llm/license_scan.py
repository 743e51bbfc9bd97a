"""License texts found by an exact set-similarity join of text blocks with license paragraphs; DataFrame functions only.

A template is the set of the words of one paragraph of a license; a block contains it if the block's distinct words
hold at least ``threshold`` of the template's. The templates' words are ordered by how rarely they occur in the whole
corpus, rarest first. *Prefix filter*: a block that meets a template's threshold shares one of its first
|T| - ceil(threshold |T|) + 1 words, so blocks and templates are joined on these words only. *Length filter*: a block of fewer distinct words than
the needed overlap can't. *Positional filter*: if the first shared word stands at place p in the order, at most
|T| - p words can be shared. What passes is verified on the whole sets, so none is missed and none is wrong.

The templates are a parameter of fixed size, so their prefix words and sets are broadcast; the corpus is never joined with itself. One pass over the
texts counts the template words, one finds phrases and the blocks with a prefix word. Equal blocks are verified once, so a
block that a third of all documents hold is one row.

*Blocks*: paragraphs, which lines without words part; a text that has no such line is cut into its lines, and into windows of 2 L words
at every L words, L being twice the words of the longest template, so that any L words that follow each other are in one.

Defined cases: null and empty texts have no words, no labels and score 0; a block repeated counts once; a phrase is
counted at each of its places, in blocks or across them; rows that share an id share the labels of templates. Other columns, whatever their names,
are left out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import NON_WORD, count_spaced, lower_ascii, spaced_words, text_or_empty

#: Phrases that name a license wherever their words stand consecutively.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: By label, opening sentences and paragraphs of common license texts, in their words. Paragraphs that licenses share are under one label of their own.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "apache": (
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "you should have received a copy of the gnu general public license along with this program if not see",
    ),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",),
    "unlicense": ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",),
    "cc-by-notice": ("this work is licensed under a creative commons attribution 4 0 international license cc by",),
    "reserved-notice": ("copyright all rights reserved no part of this publication may be reproduced or transmitted in any form without prior written permission of the publisher",),
    "as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
}
THRESHOLD = 0.7
#: From the end of a line to the end of the last line without words after it.
_GAP = rf"\n{NON_WORD[:-1]}*\n"


def phrase_places(spaced: Column, phrases: Mapping[str, str] = PHRASES) -> dict[str, tuple[Column, Column, Column]]:
    """For each phrase: how often it stands, and the number of words before its first and its last place (null: none).

    Each word carries a space on either side, so places next to each other don't overlap and counting them is exact.
    """
    padded = F.concat(F.lit(" "), spaced, F.lit(" "))
    total = count_spaced(spaced)
    out = {}
    for phrase in phrases:
        words = phrase.split(" ")
        needle = F.lit(" " + "  ".join(words) + " ")
        has = F.contains(padded, needle)
        times = F.when(has, ((F.char_length(padded) - F.char_length(F.replace(padded, needle, F.lit("")))) / F.char_length(needle)).cast("long")).otherwise(F.lit(0).cast("long"))
        before = F.when(has, count_spaced(F.trim(F.substring_index(padded, " " + "  ".join(words) + " ", 1))))
        after = F.when(has, count_spaced(F.trim(F.substring_index(padded, " " + "  ".join(words) + " ", -1))))
        out[phrase] = (times, before, total - after - len(words))
    return out


def word_order(docs: DataFrame, text_col: str, words: Sequence[str]) -> dict[str, int]:
    """How often each of ``words``, those of the templates, occurs in all documents; one row a word comes back."""
    # outer: no text is without an element, and for the other form a filter would be inferred that splits every text again
    each = docs.select(F.explode_outer(F.split(spaced_words(text_or_empty(docs[text_col])), "  ")).alias("word"))
    counts = each.where(F.col("word").isin(*words)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def template_plans(templates: Mapping[str, Sequence[str]], counts: Mapping[str, int], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """For each template: its label, its words, rarest first, the overlap needed, and the length of the prefix that must be shared."""
    out = []
    for label, text in ((label, t) for label, texts in templates.items() for t in texts):
        words = sorted(set(text.split(" ")), key=lambda w: (counts.get(w, 0), w))
        need = math.ceil(threshold * len(words) - 1e-9)
        out.append((label, words, need, len(words) - need + 1))
    return out


def block_span(templates: Mapping[str, Sequence[str]]) -> int:
    """L of the windows: twice the words of the longest template."""
    return 2 * max((len(t.split(" ")) for texts in templates.values() for t in texts), default=1)


def wrapped_blocks(text: Column, span: int) -> Column:
    """The blocks of a text as arrays in the form of ``spaced_words``: paragraphs; of a text that is one, lines and windows of 2 ``span`` words."""
    text = F.translate(F.replace(lower_ascii(text), F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    filled = lambda blocks: F.filter(F.transform(blocks, spaced_words), lambda b: b != "")
    paragraphs, lines, words = filled(F.split(text, _GAP)), filled(F.split(text, r"\n")), F.split(spaced_words(text), "  ")
    last = F.greatest(F.ceil(F.size(words) / span).cast("int") - 2, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda k: F.array_join(F.slice(words, k * span + 1, 2 * span), "  "))
    return F.when(F.size(paragraphs) > 1, paragraphs).when(F.size(lines) > 1, F.concat(lines, windows)).otherwise(lines)


class LicenseScan:
    """Phrases and contained templates of every document; texts are read twice, for the order of words and for what is found."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.spark, self.id_col, self.threshold = docs.sparkSession, id_col, threshold
        self.scratch = Scratch(self.spark, "licenses")
        words = sorted({w for texts in templates.values() for t in texts for w in t.split(" ")})
        self.plans = template_plans(templates, word_order(docs, text_col, words), threshold)
        self.marked = self.scratch.write(self._marked(docs, text_col, phrases, block_span(templates)), "marked")

    def _marked(self, docs: DataFrame, text_col: str, phrases: Mapping[str, str], span: int) -> DataFrame:
        """A row a document: what phrases it has, and its blocks that hold a prefix word, in the form of ``spaced_words`` (null: none)."""
        prefix_words = F.array(*[F.lit(w) for w in sorted({w for _, words, _, prefix in self.plans for w in words[:prefix]})])
        shares = lambda spaced: F.arrays_overlap(F.split(spaced, "  "), prefix_words)
        held = docs.select(docs[self.id_col].alias("doc"), text_or_empty(docs[text_col]).alias("text")).withColumn("spaced", spaced_words(F.col("text")))
        places = phrase_places(F.col("spaced"), phrases)
        base = F.array_compact(F.array(*[F.when(places[p][0] > 0, F.lit(label)) for p, label in phrases.items()]))
        blocks = F.filter(wrapped_blocks(F.col("text"), span), shares)
        return held.select(
            "doc", count_spaced(F.col("spaced")).alias("n_words"), sum((n for n, _, _ in places.values()), F.lit(0)).cast("long").alias("n_base"),
            _least([a for _, a, _ in places.values()], F.least).alias("first_word"), _least([b for _, _, b in places.values()], F.greatest).alias("last_word"), base.alias("base"),
            F.when(shares(F.col("spaced")), blocks).alias("blocks"),
        )

    def containments(self) -> DataFrame:
        """doc, label, containment: each label of which some block of a document contains a template to at least the threshold."""
        each = self.marked.where("blocks IS NOT NULL").select("doc", F.explode("blocks").alias("spaced")).withColumn("block", F.sha2("spaced", 256))
        blocks = self.scratch.write(each.groupBy("block").agg(F.first("spaced").alias("spaced")), "blocks")
        # both tables have a few rows a template
        heads = self.spark.createDataFrame([(w, t, i) for t, (_, words, _, prefix) in enumerate(self.plans) for i, w in enumerate(words[:prefix])], "word string, template int, at int")
        whole = self.spark.createDataFrame([(t, label, words, need) for t, (label, words, need, _) in enumerate(self.plans)], "template int, label string, of array<string>, need int")
        words = blocks.select("block", F.array_distinct(F.split("spaced", "  ")).alias("words"))
        met = words.select("block", "words", F.explode("words").alias("word")).join(F.broadcast(heads), "word").groupBy("block", "template").agg(F.min("at").alias("at"), F.first("words").alias("words"))
        passed = met.join(F.broadcast(whole), "template").where((F.size("words") >= F.col("need")) & (F.size("of") - F.col("at") >= F.col("need")))
        overlap = F.size(F.array_intersect("words", "of"))
        found = passed.select("block", "label", overlap.alias("overlap"), "need", F.size("of").alias("n")).where("overlap >= need")
        found = self.scratch.write(found.groupBy("block", "label").agg(F.max(F.col("overlap") / F.col("n")).alias("containment")), "found")
        return each.select("doc", "block").join(found, "block").groupBy("doc", "label").agg(F.max("containment").alias("containment"))

    def report(self) -> DataFrame:
        """One row a document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

        ``score`` is 1 where a phrase stands, else the greatest containment of a template (0: none reaches the threshold).
        """
        found = self.containments().groupBy("doc").agg(F.collect_set("label").alias("more"), F.max("containment").alias("most")).withColumnRenamed("doc", "found")
        out = self.marked.drop("blocks").join(found, F.col("doc").eqNullSafe(F.col("found")), "left")
        joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
        return out.select(
            F.col("doc").alias(self.id_col), "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
            joined(F.concat(F.col("base"), F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
            F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
        )


def containments(docs: DataFrame, **options) -> DataFrame:
    """doc, label, containment. Options as for ``LicenseScan``."""
    return LicenseScan(docs, **options).containments()


def scan(docs: DataFrame, **options) -> DataFrame:
    """One row a document. Options as for ``LicenseScan``."""
    return LicenseScan(docs, **options).report()


def _least(columns: list[Column], of) -> Column:
    return (of(*columns) if len(columns) > 1 else columns[0]).cast("long")
