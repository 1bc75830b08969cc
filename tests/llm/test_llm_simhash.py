import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from shipcast.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, component_id int, k1 int, rest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], SCHEMA)


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return sorted(((d, fps[i], min(ids[root(i)], default=None)) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    got = S.simhash_groups(frame(spark, rows)).collect()
    return sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str)


def test_groups_equal_brute_force(spark):
    rnd = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "délta", "ÄÖ", "x1", "zeta", "eta", "theta", "iota"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 400))] for _ in range(60)]
    rows = []
    for b in base:
        for _ in range(4):
            c = list(b)
            if rnd.random() < 0.7:
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append((len(rows), rnd.choice([" ", "\t", "\n ", "\x0b"]).join(c)))
    rows += [(1000 + i, " ".join(base[0])) for i in range(120)]           # a third are exact copies
    rows += [(5, "other words under a repeated id"), (None, "a text without an id"), (None, rows[0][1]),
             (2001, None), (2002, ""), (2003, " \n"), (2004, "one"), (2005, "one two"), (2006, " "),
             (2007, "word " * 50_000), (2008, "a b c")]
    rows += rows[:5]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(1000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.fingerprint(text) == whole == int(np.uint64(plain_fingerprint(text)).view(np.int64))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_bit_sliced_pairs_equal_all_pairs(n, radius, monkeypatch):
    monkeypatch.setattr(S, "PAIRS", 2)
    rng = np.random.default_rng(n)
    x = rng.integers(0, 2**64, n, dtype=np.uint64)
    for i in range(1, n, 2):                                             # near the one before
        x[i] = x[i - 1] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), False)))
    want = {(i, j) for j in range(n) for i in range(j) if (int(x[i]) ^ int(x[j])).bit_count() <= radius}
    got = [p for i, j in S.near_pairs(x, np.zeros(n, int), radius) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    runs = np.sort(rng.integers(0, 9, n))
    some = {p for i, j in S.near_pairs(x, runs, radius) for p in zip(i.tolist(), j.tolist())}
    assert {p for p in want if runs[p[0]] == runs[p[1]]} <= some <= want


@pytest.mark.parametrize("large", [1, 3, 2048])
def test_large_buckets_are_dealt_again_without_loss(spark, large):
    rng = np.random.default_rng(5)
    x = set(rng.integers(-2**63, 2**63, 200).tolist())
    for c in list(x)[:4]:                                                 # balls of the radius and beyond
        for _ in range(60):
            flips = sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 4)), False))
            x.add(int(np.uint64((c % 2**64) ^ flips).view(np.int64)))
    x = sorted(x)
    classes = spark.createDataFrame([(v,) for v in x], "fp long")
    roots = {r["node"]: r["root"] for r in S.components(S.fingerprint_links(classes, large)).collect()}
    parent = {v: v for v in x}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, u in enumerate(x):
        for v in x[:i]:
            if ((u ^ v) % 2**64).bit_count() <= 2:
                a, b = root(u), root(v)
                parent[max(a, b)] = min(a, b)
    assert {v: roots.get(v, v) for v in x} == {v: root(v) for v in x}


def test_query_over_the_whole_table(spark):
    import pandas as pd

    from conftest import SMALL

    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    got = S.op13_simhash(spark, SMALL).collect()
    want = brute([(int(d), t) for d, t in zip(docs["doc_id"], docs["text"])])
    assert sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in got), key=str) == want
    assert all(len(r["fingerprint"]) == 16 and r["fingerprint"].islower() or r["fingerprint"].isdigit() for r in got)


def test_buckets_stay_whole_where_the_join_turns_into_a_broadcast(spark):
    """As on larger tables: partitions are not merged into one, and bucket sizes turn out small enough to broadcast."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    near = x ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    rows = [(v,) for v in [*x.view(np.int64).tolist(), *near.view(np.int64).tolist()]]
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        classes = spark.createDataFrame(rows, "fp long").repartition(4).distinct()
        roots = {r["node"]: r["root"] for r in S.components(S.fingerprint_links(classes)).collect()}
    finally:
        spark.conf.set(setting, before)
    assert all(roots.get(a, a) == roots.get(b, b) for a, b in zip(x.view(np.int64).tolist(), near.view(np.int64).tolist()))
