"""License scans with a positional index of rare words (DataFrame only).

Method. Each template is a word sequence with a mandatory key phrase. The
index keeps, for every template, the word of its key phrase with the highest
inverse document frequency over all documents, and its position. In a file the
indexed words are looked up, each occurrence fixes where the template would
start, occurrences of other templates' words never meet that start, and the
key phrase is verified word by word at its relative position. A place counts
if the key phrase stands there and the template's words agreeing at their
relative positions carry at least ``AGREE`` of its IDF weight. Every place of
a key phrase contains its indexed word, so none is missed.

Scale. One pass counts the document frequency of the few template words (a
bounded table), a second one scans; both are projections over the texts, no
text is shuffled, and the templates are literals in the plan.

Defined cases: a null text is empty; no place gives n_base 0, null positions,
empty labels and score 0; repeated rows get a row each; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TOKEN_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
AGREE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), tuple((key or text).split()), base)


# Phrases whose places are counted, then further license
# statements with their mandatory key phrase.
TEMPLATES = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("mit", "released under the terms of the mit license", "terms of the mit license"),
    template("apache-2", "licensed under apache 2 0", "under apache 2"),
    template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    template("mpl-2", "subject to the terms of the mozilla public license", "mozilla public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("bsd", "licensed under the bsd license", "bsd license"),
    template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license",
             "creative commons attribution noncommercial"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("cc-by", "licensed under cc by 4 0", "cc by 4"),
    template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """ASCII-lower-cased words of a text as an array, empty for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(TOKEN_PATTERN), F.lit(0))


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of documents, and in how many each template word stands."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(vocabulary))).alias("found"))
    # One extra entry per document counts the documents in the same pass.
    rows = (found.select(F.explode(F.array_append("found", F.lit(""))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())  # at most one row per template word
    counts = {r["word"]: r["n"] for r in rows}
    return counts.get("", 0), counts


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, agree: float = AGREE) -> DataFrame:
    """doc_id, n_words and ``places``: array of (label, base, start, agreement)
    for every verified place, by template and start."""
    n_docs, df = document_frequencies(docs, templates)

    def idf(word: str) -> float:
        return math.log((1 + n_docs) / (1 + df.get(word, 0))) + 1.0

    anchors = []
    for t in templates:
        at = max(range(len(t.key)), key=lambda i: (idf(t.key[i]), -i))
        anchors.append((t.key[at], t.key_at + at))
    indexed = sorted({w for w, _ in anchors})
    words, hits = F.col("words"), F.col("hits")

    def agreement(t: Template, start: Column) -> Column:
        total = sum(idf(w) for w in t.words)
        parts = [F.when(F.get(words, start + i) == w, F.lit(idf(w) / total)).otherwise(0.0) for i, w in enumerate(t.words)]
        out = parts[0]
        for p in parts[1:]:
            out = out + p
        return F.least(out, F.lit(1.0))

    def places(t: Template, word: str, offset: int) -> Column:
        starts = F.transform(F.filter(hits, lambda i: F.get(words, i) == word), lambda i: i - offset)

        def verified(s: Column) -> Column:
            ok = F.lit(True)
            for j, w in enumerate(t.key):
                ok = ok & F.coalesce(F.get(words, s + (t.key_at + j)) == w, F.lit(False))
            return ok

        found = F.transform(F.filter(starts, verified), lambda s: F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.cast("long").alias("start"),
            (F.lit(1.0) if t.words == t.key else agreement(t, s)).alias("agreement")))
        return F.filter(found, lambda p: p["agreement"] >= agree)

    tokens = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    looked_up = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, i).isin(indexed)))
    tokens = tokens.select("doc_id", "words", F.coalesce(looked_up, F.array().cast("array<int>")).alias("hits"))
    every = F.concat(*[places(t, w, o) for t, (w, o) in zip(templates, anchors)])
    none = F.array().cast("array<struct<label:string,base:boolean,start:bigint,agreement:double>>")
    return tokens.select("doc_id", n.cast("long").alias("n_words"),
                         F.when(F.size(hits) > 0, every).otherwise(none).alias("places"))


def summary(scanned: DataFrame) -> DataFrame:
    """One row per document of ``scan``'s places."""
    based = scanned.select("*", F.filter("places", lambda p: p["base"]).alias("based"))

    def labels(col: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(col, lambda p: p["label"]))), ",")

    starts = F.transform("based", lambda p: p["start"])
    return based.select(
        "doc_id", "n_words", F.size("based").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels("based").alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["agreement"])), F.lit(0.0)).alias("score"))
