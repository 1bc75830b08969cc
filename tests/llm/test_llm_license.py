import re

import pytest

from shipcast.llm import license_scan as L

SCHEMA = "doc_id long, text string, words string, n_words int, found string"


def brute(text):
    """Every place of every key phrase, by comparing word slices."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(L.WORD, lower)
    found = []
    for t in L.default_templates():
        for at in range(len(words) - t.key_len + 1):
            if tuple(words[at:at + t.key_len]) == t.key:
                start = at - t.key_start
                same = sum(0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words))
                found.append((t.label, t.base, start, at, same / len(t.words)))
    return len(words), sorted(found)


TEXTS = [
    None, "", " \n", "no licence here", "All Rights Reserved. all rights, RESERVED all rights reserved",
    "This work is licensed under the GNU General Public License, version 3.", "general public", "public license",
    "Licensed under CC BY-NC 4.0.", "cc by cc by cc by-sa 4.0", "CC BY", "by", "cc", "Released under the MIT License.",
    "lİcense mit license", "É mit licenſe", "permission is hereby granted, free of charge, to any person",
    "general public license " * 3000, "x " * 50_000 + "all rights reserved", "redistribution and use in source",
    "free and unencumbered software released into the public domain", "rights reserved all",
]


def test_scan_equals_brute_force(spark):
    rows = [(i, t, "clash", 1, "clash") for i, t in enumerate(TEXTS)] * 2     # repeated rows
    got = L.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, found = brute(TEXTS[r.doc_id])
        assert r.n_words == n
        assert sorted((f.label, f.base, f.start, f.at, f.score) for f in r.found) == found


def test_result_does_not_depend_on_the_statistics(spark):
    flat = {w: 0.0 for t in L.default_templates() for w in t.key}
    df = spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(TEXTS)], SCHEMA)
    want = {r.doc_id: sorted(map(tuple, r.found)) for r in L.scan(df).collect()}
    original, L.word_idf = L.word_idf, lambda docs, templates: flat
    try:
        assert {r.doc_id: sorted(map(tuple, r.found)) for r in L.scan(df).collect()} == want
    finally:
        L.word_idf = original


def test_rare_words_lead_the_index(spark):
    df = spark.createDataFrame([(i, "license license public", "", 0, "") for i in range(9)]
                               + [(10, "gnu", "", 0, "")], SCHEMA)
    idf = L.word_idf(df, L.default_templates())
    assert idf["gnu"] > idf["license"] and idf["general"] > idf["gnu"]
    gnu = next(t for t in L.default_templates() if t.label == "gpl-gnu")
    assert [w for w, _ in L.anchors(gnu, idf)] == ["general", "gnu"]


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = L.scan(spark.createDataFrame([(1, "a", "", 0, "")], SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("label,words,key,base", [("x", "a b c", "b c", False)])
def test_template(label, words, key, base):
    t = L.make_template(label, words, key, base)
    assert t.key == ("b", "c") and t.key_start == 1


def test_template_with_any_letter(spark):
    """Only A-Z are folded: the Kelvin sign is no k, a capital sharp s no sharp s."""
    ts = [L.make_template("kit", "kit kept in trunk", "kept in trunk"), L.make_template("eszett", "ma\u00df", "ma\u00df")]
    texts = ["Kit KEPT in Trunk", "kit \u212aept in trunk", "MA\u1e9e", "Ma\u00df"]
    got = L.scan(spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(texts)], SCHEMA), ts).collect()
    assert {r.doc_id: [f.label for f in r.found] for r in got} == {0: ["kit"], 1: [], 2: [], 3: ["eszett"]}
