import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SMALL
from shipcast.llm import lm_score as L
from shipcast.llm import quality_clf as Q

DOCS = "doc_id long, text string, stats string, score string, held_out string"
MIDDLE = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], DOCS)


def rest(doc_id, of):
    return zlib.crc32(str(doc_id).encode()) % of


# --- language model ---------------------------------------------------------------------
def base(rows):
    train = Counter()
    for i, t in rows:
        if i is not None and rest(i, 7) != 2:
            train.update(L.tokens(t))
    n, v = sum(train.values()), len(train)
    for i, t in rows:
        words = L.tokens(t)
        yield (i, i is None or rest(i, 7) == 2, len(words), sum(train[w] > 0 for w in words), n,
               sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words))


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_lm_base_equals_brute_force(spark, head):
    rows = [(i, " ".join(f"W{(i * j) % 37} é{j % 5}" for j in range(i % 50))) for i in range(200)]
    rows += [(200, None), (201, ""), (None, "w1 unseen"), (5, "repeated id"), (5, "repeated id"), (202, "x " * 70_000)]
    got = L.score_documents(frame(spark, rows), head_size=head).collect()
    assert len(got) == len(rows)
    key = lambda x: (str(x[0]), x[2], round(x[5], 4))
    mine = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r.score < 0 for r in got)


def test_head_takes_whole_levels_from_the_top(spark):
    counts = spark.createDataFrame([(bytearray(b"a"), 900), (bytearray(b"b"), 40), (bytearray(b"c"), 40),
                                    *[(bytearray(f"r{i}".encode()), 1) for i in range(50)]], "word binary, c long")
    assert L.head_words(counts, 1000)[:3] == [(b"a", 900), (b"b", 40), (b"c", 40)]
    assert len(L.head_words(counts, 1000)) == 53
    assert L.head_words(counts, 20) == [(b"a", 900), (b"b", 40), (b"c", 40)]
    assert L.head_words(counts, 2) == [(b"a", 900)] and L.head_words(counts, 0) == []


def test_lm_without_training_rows(spark):
    out = L.score_documents(frame(spark, [(None, "a b"), (None, None)])).collect()
    assert [r.train_tokens for r in out] == [0, 0] and all(r.base_score == 0 and r.n_known == 0 for r in out)
    assert L.score_documents(frame(spark, [])).count() == 0


def test_lm_is_a_distribution():
    """Class times member probabilities add up to one over all buckets, whatever the history."""
    rng = np.random.default_rng(0)
    w = L.Weights(rng.normal(size=16).astype("f4"), rng.normal(size=(16, 16)).astype("f4"),
                  rng.normal(size=(L.ROWS, 16)).astype("f4"), rng.normal(size=(L.ROWS * 16, 16)).astype("f4"))
    rows = rng.integers(0, L.ROWS, (3, 1))
    total = 0.0
    for k in range(16):
        classes, members = L.forward(w, rows, np.array([k]))
        total += float(classes[0, k]) * float(members.sum())
    assert total == pytest.approx(1, abs=1e-4)


def test_lm_beats_its_base_on_held_out_text(spark):
    rows = L.op4_lm(spark, MIDDLE).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > rows["sum(base_score)"]


def test_lm_score_by_plain_loops(spark):
    """The model's probability of every token from the definition, one token at a time."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, n) if x < 2_000) for n in (0, 1, 5, 300, 900)] + [None, "zz zz new"]
    docs = frame(spark, list(enumerate(texts)))
    rows = docs.select("doc_id", "text", L.held_out().alias("out")).collect()
    counts = Counter(w for r in rows if not r.out for w in L.tokens(r.text))
    table = spark.createDataFrame([(bytearray(w), c) for w, c in counts.items()], "word binary, c long")
    lexicon = L.lexicon_of(table, len(counts), 50)
    texts_in = docs.where(~L.held_out()).select("doc_id", L.whole_text().alias("text"))
    w = L.train(texts_in, spark.sparkContext.broadcast(lexicon), L.start_weights(lexicon), sum(counts.values()))
    shape = lexicon.shape

    def bucket(x):
        i = lexicon.head.get(x, shape.own)      # own words are the first of the head
        return i if i < shape.own else shape.own + zlib.crc32(x) % (shape.buckets - shape.own)

    of_bucket = Counter()
    for x, c in counts.items():
        of_bucket[bucket(x)] += c + 1
    got = {r.doc_id: r.score for r in L.score_documents(docs, head_size=50).collect()}
    for r in rows:
        want, words = 0.0, L.tokens(r.text)
        hashes = np.array([zlib.crc32(x) for x in words], np.uint32)
        feature = L.features(hashes, np.arange(len(words)) == len(words) - 1, shape.rows)
        for i, x in enumerate(words):
            k, m = bucket(x) % shape.classes, bucket(x) // shape.classes
            top = [float(w.class_b[c]) + sum(float(w.class_w[f[i], c]) for f in feature) for c in range(shape.classes)]
            low = [float(w.member_b[k, j]) + sum(float(w.member_w[f[i] * shape.classes + k, j]) for f in feature)
                   for j in range(shape.classes)]
            for at, logits in ((k, top), (m, low)):
                want += math.log10(math.exp(logits[at]) / sum(map(math.exp, logits)))
            want += math.log10(counts[x] + 1) - math.log10(of_bucket[bucket(x)] + 1)
        assert got[r.doc_id] == pytest.approx(want, rel=1e-4, abs=1e-3), r.doc_id


def test_lm_does_not_depend_on_the_layout(spark, monkeypatch):
    """The same rows in other partitions and another order score the same, over several shares."""
    monkeypatch.setattr(L.Shape, "weights", property(lambda self: 0))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    runs = [{r.doc_id: r.score for r in L.score_documents(d, share=5_000).collect()}
            for d in (docs.coalesce(1), docs.repartition(7, "text").orderBy("doc_id", ascending=False))]
    assert runs[0] == pytest.approx(runs[1], rel=1e-9) and len(runs[0]) == docs.count()


def test_lm_shares_are_averaged_over_those_that_met_a_row(spark, monkeypatch):
    """Several shares a round still beat the base on what they learnt from."""
    monkeypatch.setattr(L.Shape, "weights", property(lambda self: 0))
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    out = L.score_documents(docs, share=40_000).where("not held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert out["sum(score)"] > out["sum(base_score)"]


def test_lm_shape_grows_with_the_vocabulary():
    shapes = [L.Shape.of(v) for v in (0, 10_000, 1_000_000, 30_000_000, 10**9)]
    assert (shapes[0].classes, shapes[0].rows) == (16, 4096)
    assert all(a.weights <= b.weights for a, b in zip(shapes, shapes[1:]))
    assert all(v <= s.weights <= max(2 * v, shapes[0].weights) for v, s in zip((0, 10_000, 10**6, 3 * 10**7, 10**9), shapes))


# --- quality classifier -------------------------------------------------------------------
def test_quality_accuracy_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    got = Q.op7_quality(spark, MIDDLE).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (rest(r.doc_id, 3) == 1) for r in got)
    seen = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(seen) > 80 and sum(a == b for a, b in seen) / len(seen) > 0.97


def fitted(spark, rows):
    stats = spark.createDataFrame([(list(map(float, Q.statistics(t))), y) for t, y in rows], "stats array<double>, label int")
    return Q.fit(stats)


def test_quality_scores_by_brute_force(spark):
    """Every score of the query from one matrix on one machine: ridge as a least-squares problem with
    penalty rows, isotonic levels by the max-min formula over all intervals of bins."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    stats = np.array([Q.statistics(t) for _, t in docs])
    train = np.array([rest(i, 3) != 1 and labels.get(i) is not None for i, _ in docs])
    y = np.array([labels[i] for (i, _), use in zip(docs, train) if use], float)
    rng = np.random.default_rng(Q.SEED)
    directions = rng.normal(size=(Q.N_STATS, Q.FEATURES)) / np.sqrt(Q.N_STATS)
    phases = rng.uniform(0, 2 * np.pi, Q.FEATURES)
    mean, scale = stats[train].mean(axis=0), stats[train].std(axis=0)
    scale[scale < 1e-12] = 1.0
    z = np.clip((stats - mean) / scale, -6, 6)
    z = np.column_stack([np.sqrt(2 / Q.FEATURES) * np.cos(z @ directions + phases), np.ones(len(z))])
    penalty = np.sqrt(np.append(np.full(Q.FEATURES, Q.RIDGE), 1e-9))
    weights = np.linalg.lstsq(np.vstack([z[train], np.diag(penalty)]), np.append(y, np.zeros(len(penalty))), rcond=None)[0]
    raw = z @ weights
    place = np.clip((raw[train] + 1) / 3 * Q.BINS, 0, Q.BINS - 1).astype(int)
    used = np.unique(place)
    n = np.array([(place == b).sum() for b in used])
    total = np.array([y[place == b].sum() for b in used])
    k = len(used)
    average = np.full((k, k), np.nan)
    for i in range(k):
        average[i, i:] = total[i:].cumsum() / n[i:].cumsum()
    level = np.array([max(average[i, j:].min() for i in range(j + 1)) for j in range(k)])
    centre = (used + 0.5) / Q.BINS * 3 - 1
    blocks = sorted(set(level))
    knots = [np.average(centre[level == v], weights=n[level == v]) for v in blocks]
    want = np.interp(raw, knots, blocks)
    got = {r.doc_id: r.score for r in Q.op7_quality(spark, SMALL).collect()}
    np.testing.assert_allclose([got[i] for i, _ in docs], want, atol=1e-6)


def test_quality_query_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert Q.op7_quality(spark, str(tmp_path)).count() == 0


def test_quality_degenerate_labels(spark):
    some = np.array([Q.statistics("a few words of text"), Q.statistics(None)])
    assert fitted(spark, []).score(some).tolist() == [0.5, 0.5]
    ones = fitted(spark, [(f"text number {i} of some", 1) for i in range(30)])
    assert (ones.score(some) > 0.9).all()


def test_quality_edge_rows(spark):
    docs = frame(spark, [(1, None), (2, ""), (None, "null id"), (3, "x " * 100_000), (3, "again"), (4, " \n"), (5, "é😀")])
    stats = docs.select("doc_id", Q.text_statistics(Q.whole_text()).alias("stats"))
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (None, 1), (9, 1), (5, None)], "doc_id long, quality int")
    rows = Q.labelled_rows(stats, labels).collect()
    want = sum(2 if i == 3 else 1 for i in (1, 3, 3) if rest(i, 3) != 1)
    assert len(rows) == want and all(len(r.stats) == Q.N_STATS for r in rows)
    model = Q.fit(Q.labelled_rows(stats, labels))
    out = stats.select("doc_id", Q.score(stats["stats"], model).alias("s")).collect()
    assert len(out) == 7 and all(0 <= r.s <= 1 for r in out)
    assert stats.limit(0).select(Q.score(stats["stats"], model)).count() == 0


def test_isotonic_pools_violators():
    x, y = Q.isotonic(np.array([0., 1, 2, 3]), np.array([0.0, 0.6, 0.4, 1.0]), np.array([1.0, 1, 1, 2]))
    assert y.tolist() == [0.0, 0.5, 1.0] and x.tolist() == [0.0, 1.5, 3.0]


# --- pipeline -----------------------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from shipcast.llm.common import stored
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for i, (name, stage) in enumerate(P.STAGES):
        before = docs
        docs = stored(stage(spark, before, SMALL))
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        if i < 4:
            assert docs.columns == columns
            assert docs.join(before, columns, "left_anti").count() == 0      # rows come whole
        if name == "quality classifier":
            wrong = [d for d in ids - now if labels.get(d) == 1]
            assert len(wrong) <= 0.03 * len(ids)
        if name == "quality rules":
            from test_llm_rules import brute
            kept = set()
            for r in before.collect():
                n, chars, symbols, dup, repeat, shout, stutter = brute(r.text)
                bad = (n < 20 or repeat * 100 > n * 30 or symbols * 10 > n * 3 or shout * 10 > n * 3 or chars < 2 * n
                       or chars > 25 * n or (dup >= 3 and dup * 20 > n) or stutter * 10 > n * 3)
                kept |= set() if bad else {r.doc_id}
            assert now == kept
        if name == "MinHash near-dedup":
            from test_llm_dedup import brute as groups
            assert now == {d for d, _, c in groups([(r.doc_id, r.text) for r in before.collect()], P.NEAR_PERCENT) if d == c}
        ids = now
    assert docs.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = P.run(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens", "ids_sha256").collect()))


def pipeline_folder(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline_with_odd_rows(spark, tmp_path):
    """Null and empty texts, repeated rows, null and repeated ids, clashing column names."""
    import corpus_pipeline as P
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(None, None), (900_001, None), (900_002, ""), (900_003, " \n\t "), (None, "a short one"), (900_004, "x"),
           (900_005, "word " * 30_000)]
    odd = spark.createDataFrame(odd, "doc_id long, text string").join(docs.drop("doc_id", "text").limit(1))
    odd = odd.withColumn("source", F.lit(None).cast("string")).select(docs.columns)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id < 40"))          # a fifth come twice
    again = docs.where("doc_id = 41").withColumn("doc_id", F.lit(42).cast("long"))  # one id, two texts
    docs = docs.unionByName(again)
    clash = docs.selectExpr("*", "'a' AS score", "1 AS n", "'k' AS key", "2 AS fp", "'r' AS root", "3 AS ids", "4 AS size")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = P.run(spark, pipeline_folder(spark, tmp_path / "clash", clash, labels)).collect()
    plain = P.run(spark, pipeline_folder(spark, tmp_path / "plain", docs, labels)).collect()
    told = lambda rows: sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"]) for r in rows)
    assert told(out) == told(plain) and len(out) > 50
    rejected = {900_001, 900_002, 900_003, 900_004, 900_005}
    assert not {r["doc_id"] for r in out} & rejected


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").limit(0)
    assert P.run(spark, pipeline_folder(spark, tmp_path, docs, labels)).count() == 0
