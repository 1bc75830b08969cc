import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shipcast.llm import mixing as M
from shipcast.llm import sharding as S

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, target string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "clash", "clash", 7) for i, t, s in rows], SCHEMA)


def targets(sizes):
    """Share by weight, cap at twice a source, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total >= 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            free.discard(s)
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


def corpus(seed, n=400):
    rnd = random.Random(seed)
    rows = [(i, " ".join("w" * rnd.randint(1, 5) for _ in range(rnd.randint(0, 120))),
             rnd.choice(["hot"] * 8 + ["b", "a", "é", "Z", None, ""])) for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "none"), (n + 2, "one two " * 9000, "b"), (None, "a null id", "b"),
                   (3, "a repeated id", "hot"), *rows[:5]]


@pytest.mark.parametrize("seed", [0, 1])
def test_mix_meets_its_targets(spark, seed):
    rows = corpus(seed)
    got = M.mix(M.document_rows(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = M.mix(M.document_rows(frame(spark, rows[::-1]))).collect()
    key = lambda r: (str(r.doc_id), r.tie, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_are_whole_copies(spark):
    rows = corpus(2)
    docs = frame(spark, rows)
    out = M.mix_documents(docs)
    assert out.columns == docs.columns
    seen = Counter((r.doc_id, r.text) for r in out.collect())
    placed = M.mix(M.document_rows(docs)).collect()
    want = Counter()
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t)
    for r in placed:
        if r.epochs + r.more:
            text = next(t for t in texts[r.doc_id] if M_md5(t) == r.tie)
            want[r.doc_id, text] += r.epochs + r.more
    assert seen == want
    words = Counter()
    for (_, t), n in seen.items():
        words["all"] += n * len(re.findall(M.SPACE_WORD, t or ""))
    assert abs(words["all"] - 1.5 * sum(r["size"] for r in placed)) <= 7 * 9000


def M_md5(t):
    import hashlib
    return hashlib.md5((t or "").encode()).hexdigest()


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert M.mix(M.document_rows(empty)).count() == 0
    assert M.mix_documents(empty).count() == 0
    wordless = frame(spark, [(1, None, "a"), (2, " ", None)])
    assert {r.taken for r in M.mix(M.document_rows(wordless)).collect()} == {0}


def test_shards_are_contiguous_and_balanced(spark):
    rows = corpus(3)
    got = S.shard_by_bytes(S.document_sizes(frame(spark, rows)), "size", ["doc_id", "size", "text_crc32"], 8).collect()
    assert len(got) == len(rows)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    loads, slots, ids = Counter(), defaultdict(list), defaultdict(list)
    for r in got:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        ids[r.shard].append(-1 if r.doc_id is None else r.doc_id)
    assert set(loads) <= set(range(8))
    for s in loads:
        assert abs(loads[s] - total / 8) <= largest
        assert sorted(slots[s]) == list(range(len(slots[s])))
    used = sorted(loads)
    assert all(max(ids[a]) <= min(ids[b]) for a, b in zip(used, used[1:]))


def test_many_equal_rows_are_spread(spark):
    rows = [(7, "same text", "a")] * 800
    got = S.shard_by_bytes(S.document_sizes(frame(spark, rows)), "size", ["doc_id", "size", "text_crc32"], 8)
    assert {r["count"] for r in got.groupBy("shard").count().collect()} == {100}
    assert got.select("shard", "slot").distinct().count() == 800
    empty = S.shard_by_bytes(S.document_sizes(frame(spark, [])), "size", ["doc_id"], 8)
    assert empty.count() == 0


def test_native_plans(spark):
    from conftest import SMALL
    plan = S.op9_sharding(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_prefix_sums_cover_many_partitions(spark):
    from shipcast.llm.common import prefix_sums
    df = spark.range(1000).withColumn("k", F.pmod(F.hash("id"), F.lit(50)))
    got = sorted(prefix_sums(df, ["k", "id"], {"before": F.col("id")}).collect(), key=lambda r: (r.k, r.id))
    total = 0
    for r in got:
        assert r.before == total
        total += r.id
