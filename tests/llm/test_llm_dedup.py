import random
from collections import defaultdict

import numpy as np
import pytest

from shipcast.llm import near_dedup as D

SCHEMA = "doc_id long, text string, n long, fp string, keys string, component_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "clash", "clash", "clash") for i, t in rows], SCHEMA)


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows, percent=85):
    """component_id of every row, from all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].add(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j > i}:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    names = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[root(i)].append(d)
    return [(d, len(s), (min(names[root(i)]) if names[root(i)] else None) if s else d)
            for i, ((d, _), s) in enumerate(zip(rows, sets))]


def run(spark, rows):
    got = D.near_duplicates(frame(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def edited(rnd, words, rate):
    return " ".join(rnd.choice(["zz", "yy", "xx", "ww"]) + str(rnd.randint(0, 9999)) if rnd.random() < rate else w
                    for w in words)


def test_hot_group_of_near_copies(spark):
    """Copies around the limit of 0.85, chains through variants, and a passage that all share."""
    rnd = random.Random(0)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(150)]
    rows = [(i, edited(rnd, base, rnd.choice([0, 0.004, 0.01, 0.02, 0.05]))) for i in range(300)]
    chain = list(base)
    for i in range(300, 340):                      # every next one changes one more word
        chain[(i * 7) % 150] = f"c{i}"
        rows.append((i, " ".join(chain)))
    passage = " ".join(f"p{j}" for j in range(60))
    rows += [(i, passage + " " + " ".join(f"q{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(8, 40))))
             for i in range(340, 480)]
    rnd.shuffle(rows)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three four five"),
            (8, "One Two three four five"), (9, "É a b c d e"), (10, "é a b c d e"), (None, "null id text one two three"),
            (None, "null id text one two three"), (11, "same id twice a b c d"), (11, "another text for the same id e f g"),
            (12, "same id twice a b c d"), (1, None), (20, "long " * 40_000), (21, "long " * 30_000)]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert D.near_duplicates(frame(spark, [])).count() == 0
    assert run(spark, [(1, "nobody shares this text at all")]) == [(1, 2, 1)]


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "A b c d e f g"),
            (6, "x y z u v w"), (6, "x y z u v w"), (None, "q r s t u v")]
    docs = frame(spark, rows)
    out = D.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "a b c d e f g"), (3, None), (4, ""), (6, "x y z u v w"), (None, "q r s t u v")], key=str)


def test_near_copies_under_one_id_leave_one_row(spark):
    base = " ".join(f"w{j}" for j in range(60))
    other, third = " ".join(f"v{j}" for j in range(60)), " ".join(f"u{j}" for j in range(60))
    rows = [(5, base), (5, base + " more"), (8, base + " again"), (7, "an unrelated text a b c"), (7, "under one id d e f g"),
            (None, other), (None, other + " more"), (None, third), (9, None), (9, "")]
    out = [(r.doc_id, r.text) for r in D.drop_near_duplicates(frame(spark, rows)).collect()]
    groups = [rows[:3], rows[3:4], rows[4:5], rows[5:7], rows[7:8], rows[8:9], rows[9:]]
    assert [len(set(g) & set(out)) for g in groups] == [1] * 7 and len(out) == 7 and rows[2] not in out


def test_small_table(spark):
    from conftest import SMALL
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in D.op8_near_dedup(spark, SMALL).collect()))
    assert got == sorted((d, n, c, d == c) for d, n, c in brute(rows))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, j) for j in range(1001, 1400)] + [(1399, 2000), (5000, 5001)]
    name = lambda x: x.to_bytes(4, "big")
    rnd = random.Random(1)
    rnd.shuffle(links)
    df = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in links], "u binary, v binary").repartition(7)
    got = {bytes(r.node): bytes(r.root) for r in D.components(df).collect()}
    want = {**{name(i): name(0) for i in range(1, 301)}, **{name(j): name(1000) for j in range(1001, 1400)},
            name(2000): name(1000), name(5001): name(5000)}
    assert got == want
    assert D.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.3, 0.85])
def test_signatures_estimate_similarity(share):
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(150):
        both = rng.integers(0, 2**63, 200, dtype=np.uint64)
        n = int(round(200 * share))
        rest = (200 - n) // 2
        a, b = np.sort(both[:n + rest]), np.sort(np.concatenate([both[:n], both[n + rest:]]))
        sig = D.super_minhash([a, b])
        errors.append((sig[0] == sig[1]).mean() - n / 200)
    assert abs(np.mean(errors)) < 0.01
    # the variance is below that of independent hashes
    assert np.var(errors) < share * (1 - share) / D.SLOTS * 1.05


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 150, 3000, 20000)]
    together = D.super_minhash(sets)
    for i, s in enumerate(sets):
        assert (D.super_minhash([s])[0] == together[i]).all()
    assert (together != np.iinfo(np.uint32).max).all()


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_the_limit_is_a_parameter(spark, percent):
    rnd = random.Random(percent)
    base = [[f"w{rnd.randrange(900)}" for _ in range(60)] for _ in range(12)]
    rows = [(0, "alone and quite another text")]
    for b in base:
        for _ in range(6):
            words = list(b)
            for _ in range(rnd.randrange(4)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(9999)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in D.near_duplicates(df, percent).collect())
    assert got == sorted(brute(rows, percent))
    assert sorted(r.doc_id for r in D.drop_near_duplicates(df, percent).collect()) == sorted(
        d for d, _, c in brute(rows, percent) if d == c)


def test_limits_that_the_bands_would_miss_are_refused(spark):
    with pytest.raises(ValueError, match="80"):
        D.near_duplicates(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), 79)
