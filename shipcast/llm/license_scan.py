"""License scan (operator 1): a positional index of the rarest words of licence phrases.

Each template is a word sequence with mandatory key phrases. The index holds, for every
template, its key-phrase words of highest inverse document frequency over all documents, with
their places in the template. A file is tokenised once; its words that stand in the
index are looked up, each posting proposes a start (place in the file minus place in the
template), starts that the template's other rare words agree with survive, and the key
phrases are compared word by word. Frequencies decide only how few starts are proposed:
every place of every key phrase is found, whatever the statistics.

All of it happens inside the row, in Spark expressions: no exchange but the one that adds
up the document frequencies of the (fixed, small) template vocabulary."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, documents, whole_text

# Fixed values of the scan: words, base phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Further templates: label, words, key phrase (a part of the words).
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy",
     "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification",
     "redistribution and use in source and binary forms"),
    ("gpl-gnu", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("epl", "under the terms of the eclipse public license", "eclipse public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-text", "creative commons attribution 4 0 international", "creative commons attribution"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
)
ANCHORS = 2


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key_start: int
    key_len: int
    base: bool

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.key_start:self.key_start + self.key_len]


def make_template(label: str, words: str, key: str, base: bool = False) -> Template:
    w, k = tuple(words.split()), tuple(key.split())
    start = next(i for i in range(len(w)) if w[i:i + len(k)] == k)
    return Template(label, w, start, len(k), base)


def default_templates() -> list[Template]:
    return ([make_template(label, words, words, True) for words, label in BASE_PHRASES]
            + [make_template(*t) for t in TEMPLATES])


def file_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def word_idf(docs: DataFrame, templates: list[Template]) -> dict[str, float]:
    """Inverse document frequency, over all documents, of the words of all key phrases. The
    result has at most one row per such word, a number that the templates fix."""
    vocabulary = sorted({w for t in templates for w in t.key})
    found = docs.select(F.array_intersect(file_words(whole_text()), F.array(*map(F.lit, vocabulary))).alias("w"))
    rows = (found.select(F.explode(F.concat("w", F.array(F.lit("")))).alias("word"))
            .groupBy("word").count().collect())
    n = {r["word"]: r["count"] for r in rows}
    return {w: math.log((n.get("", 0) + 1) / (n.get(w, 0) + 1)) for w in vocabulary}


def anchors(t: Template, idf: dict[str, float], k: int = ANCHORS) -> list[tuple[str, int]]:
    """The ``k`` key-phrase words of highest frequency weight with their places; ties by place."""
    places = sorted(range(t.key_len), key=lambda i: (-idf[t.key[i]], i))
    return [(t.key[i], t.key_start + i) for i in places[:k]]


def _literal(templates: list[Template], idf: dict[str, float]) -> tuple[Column, Column, list[str]]:
    """The templates and the index (rarest word -> postings) as constant expressions."""
    def row(t: Template) -> Column:
        return F.struct(
            F.lit(t.label).alias("label"), F.array(*map(F.lit, t.words)).alias("words"),
            F.lit(t.key_start).alias("key_start"), F.lit(t.key_len).alias("key_len"), F.lit(t.base).alias("base"),
            F.array(*[F.struct(F.lit(w).alias("word"), F.lit(p).alias("place"))
                      for w, p in anchors(t, idf)]).alias("anchors"))
    postings: dict[str, list[tuple[int, int]]] = {}
    for i, t in enumerate(templates):
        word, place = anchors(t, idf)[0]
        postings.setdefault(word, []).append((i, place))
    index = F.create_map(*[x for w, ps in sorted(postings.items()) for x in (
        F.lit(w), F.array(*[F.struct(F.lit(i).alias("template"), F.lit(p).alias("place")) for i, p in ps]))])
    return F.array(*map(row, templates)), index, sorted(postings)


def scan(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words and ``found`` of every row of ``docs`` (doc_id, text; others ignored).

    ``found`` lists (label, base, start, at, score) of every place where a template's key
    phrase stands, in no set order: ``at`` is the first word of the key phrase, ``start``
    that of the template, ``score`` the share of the template's words that stand at their
    places. Null texts count as empty, rows without words have an empty list; repeated rows
    give repeated results; an empty table gives an empty one."""
    templates = templates or default_templates()
    rows, index, rare = _literal(templates, word_idf(docs, templates))
    words = docs.select("doc_id", file_words(whole_text()).alias("words"))
    hits = F.array_compact(F.transform("words", lambda w, i: F.when(
        w.isin(*rare), F.struct(i.alias("place"), w.alias("word")))))
    located = words.select("doc_id", "words", hits.alias("hits"))
    starts = F.flatten(F.transform("hits", lambda h: F.transform(
        F.element_at(index, h["word"]),
        lambda p: F.struct(p["template"].alias("template"), (h["place"] - p["place"]).alias("start")))))

    def agrees(c: Column) -> Column:
        t = F.get(rows, c["template"])
        return F.forall(t["anchors"], lambda a: F.get(F.col("words"), c["start"] + a["place"]).eqNullSafe(a["word"]))

    def verified(c: Column) -> Column:
        t = F.get(rows, c["template"])
        at = c["start"] + t["key_start"]
        return (at >= 0) & (F.slice("words", F.greatest(at + 1, F.lit(1)), t["key_len"])
                            == F.slice(t["words"], t["key_start"] + 1, t["key_len"]))

    def report(c: Column) -> Column:
        t = F.get(rows, c["template"])
        same = F.size(F.filter(F.transform(t["words"], lambda w, j: F.get(
            F.col("words"), c["start"] + j).eqNullSafe(w)), lambda x: x))
        return F.struct(t["label"].alias("label"), t["base"].alias("base"), c["start"].alias("start"),
                        (c["start"] + t["key_start"]).alias("at"), (same / F.size(t["words"])).alias("score"))

    kept = F.filter(F.filter(starts, agrees), verified)
    return located.select("doc_id", F.size("words").cast("long").alias("n_words"),
                          F.transform(kept, report).alias("found"))


def op1_license(spark, sf_dir: str) -> DataFrame:
    out = scan(documents(spark, sf_dir))
    base = F.filter("found", lambda f: f["base"])
    places = F.transform(base, lambda f: f["at"])

    def joined(found: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")

    return out.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"))
