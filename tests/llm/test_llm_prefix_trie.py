import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shipcast.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, pos int, a string, depth string, n_convs int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def truncated(c, n):                                   # the remainder has the sign of c
    return int(c - n * int(c / n))


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", md5(text or ""), text or ""))
    for c in convs:
        convs[c] = [(r[2], r[4]) for r in sorted(convs[c])]
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - truncated(c, 100), [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    for key, m in members.items():
        for d in range(len(key) + 1):
            saved[key[:d]] += (len(m) - 1) * len(key[-1][1]) if key else 0
            leaves[key[:d]] += not children[key]
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
                   for k, m in members.items()), key=str)


def run(spark, rows, **sizes):
    out = T.prefix_trie(*T.rebuilt(T.ordered_turns(frame(spark, rows))), **sizes)
    return sorted(map(tuple, out.collect()), key=str)


def many_rows():
    rnd = random.Random(4)
    rows = []
    for c in [*range(-130, 130), 1700, 5000, 5001]:
        n = rnd.choice([0, 1, 2, 3, 5, 9])
        first = "hot" if c % 3 else f"open {rnd.randrange(4)}"                   # most share their first turn
        rows += [(c, t, rnd.choice(["user", "assistant"]) if t else "user",
                  first if t == 0 else rnd.choice(["yes", "no 😀", "é" * 9])) for t in range(n)]
    rows += [(7, None, None, None), (7, None, "user", None), (7, 1, "user", ""), (7, 1, "user", "z" * 200_000),
             (8, 3, "a", "same"), (8, 3, "a", "same"), (9, 3, "b", "tie"), (9, 3, "a", "tie"), (9, 3, "a", "eit"),
             (None, 0, "user", "no id"), (900, 0, "x", "y z"), (901, 0, "x y", "z")]
    rows += [(333, t, "user", f"turn {t % 3}") for t in range(60)]               # a long one, and one that follows it
    rows += [(334, t, "user", f"turn {t % 3}") for t in range(50)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"wide": 20, "block_turns": 60}, {"wide": 10_000, "block_turns": 10**6},
                                   {"wide": 40, "block_turns": 300}])
def test_equals_brute_force(spark, sizes):
    rows = many_rows()
    assert run(spark, rows, **sizes) == brute(rows)


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"said {t}") for c in range(1, 400) for t in range(3)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(100, 0, "user", "x")], [(103, None, None, None)]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_digests_of_ends_in_many_chunks(spark):
    rows = [(d, a, d, c) for d, a, n in [(0, 0, 1), (1, 5, 3000), (1, 6, 2), (2, -9, 40)] for c in range(n)]
    ends = spark.createDataFrame(rows, "depth long, a long, b long, conv_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {(r["depth"], r["a"]): r["ends_sha256"] for r in T.end_digests(ends).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = defaultdict(list)
    for d, a, _, c in rows:
        want[d, a].append(c)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
