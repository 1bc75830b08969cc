"""LM scoring (operator 4): a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | h) * P(member | class, h) * P(word | member). A bucket (class,
member) is a frequent word of its own or a hash of the others. The first two factors are softmaxes
over hashed features of the history: the word before, the word two before (skip) and both
together (n-gram). The last is the add-one share of the word among its bucket's training
tokens, from exact counts over all training documents.

The model grows with the counted vocabulary of V words: classes and members are its fifth root
each, three quarters of the buckets are words of their own, and the feature rows double until
there is a weight for every word. So the weights that travel take 4 to 8 bytes a distinct word.

Training is distributed: shares of the documents are fixed by a hash and by the number of
tokens, not by the cluster. In every round each share is walked by one task in a fixed order, which takes
gradient steps from the common weights; a feature row's changes are averaged over the shares that
met it, weighted by how often. A share grows with the weights, so the changes written stay a
few bytes a token. Scoring runs in numpy over slices of documents, gathering only the weight
rows that the features hit.

Counts: the most frequent words, at most HEAD, travel to the tasks; a document's other words are
joined with the full count table, so every word is looked up exactly."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, documents, stored, whole_text

# The least numbers of classes (and members of each) and of feature rows.
CLASSES = 16
ROWS = 1 << 12
HEAD = 200_000
ROUNDS = 2
RATE = 0.15
# Tokens of a slice, and the least of a share; weights of one shipped block; partial averages before the last.
SLICE = 60_000
SHARE = 8_000_000
BLOCK = 1 << 16
FAN_IN = 32
END = b""
HELD_OUT = 2, 7


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, then the end token."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def held_out():
    """Rows the model does not learn from; a null id has no checksum and is held out."""
    rest, of = HELD_OUT
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == rest, F.lit(True))


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c: the tokens of all texts (column text) counted, each batch on its own first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter[bytes] = Counter()
            for t in b.column("text"):
                seen.update(tokens(t.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Shape:
    """Classes, members of each class, and feature rows."""
    classes: int
    rows: int

    @classmethod
    def of(cls, vocabulary: int) -> Shape:
        """Fifth root of the vocabulary; rows double until every word has a weight."""
        classes, rows = max(CLASSES, int(np.ceil(vocabulary ** 0.2))), ROWS
        while rows * classes * (classes + 1) < vocabulary:
            rows *= 2
        return cls(classes, rows)

    @property
    def buckets(self) -> int:
        return self.classes * self.classes

    @property
    def own(self) -> int:
        """Buckets that hold one frequent word each; the others share the rest of the vocabulary."""
        return self.buckets * 3 // 4

    @property
    def weights(self) -> int:
        return self.rows * self.classes * (self.classes + 1)

    def hashed_bucket(self, code):
        return self.own + code % (self.buckets - self.own)

    def spread(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and member of a bucket: neighbours in frequency go to different classes."""
        return bucket % self.classes, bucket // self.classes


@dataclass
class Weights:
    """class_w [rows, classes], member_w [rows * classes, members], and their biases."""
    class_b: np.ndarray
    member_b: np.ndarray
    class_w: np.ndarray
    member_w: np.ndarray

    def moved(self, change: np.ndarray) -> Weights:
        cut = len(self.class_b)
        return Weights(self.class_b, self.member_b, self.class_w + change[:, :cut],
                       self.member_w + change[:, cut:].reshape(self.member_w.shape))

    def copy(self) -> Weights:
        return Weights(self.class_b, self.member_b, self.class_w.copy(), self.member_w.copy())


@dataclass
class Lexicon:
    """The frequent words with their counts, and the token and word totals of every bucket."""
    head: dict[bytes, int]
    log_count: np.ndarray      # log10(c + 1)
    bucket: np.ndarray
    hashed: np.ndarray
    shape: Shape
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray


def start_weights(lexicon: Lexicon) -> Weights:
    """No feature weights; biases give the bucket frequencies (add one)."""
    shape = lexicon.shape
    share = np.zeros((shape.classes, shape.classes))
    k, m = shape.spread(np.arange(shape.buckets))
    share[k, m] = lexicon.bucket_tokens + 1
    return Weights(np.log(share.sum(1) / share.sum()).astype(np.float32),
                   np.log(share / share.sum(1, keepdims=True)).astype(np.float32),
                   np.zeros((shape.rows, shape.classes), np.float32),
                   np.zeros((shape.rows * shape.classes, shape.classes), np.float32))


def look_up(lexicon: Lexicon, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in the head (-1: not there), bucket and 32-bit hash of every word."""
    get = lexicon.head.get
    place = np.fromiter([get(w, -1) for w in words], np.int64, len(words))
    bucket, hashed = lexicon.bucket[place], lexicon.hashed[place]
    rare = np.flatnonzero(place < 0)
    if len(rare):
        code = np.fromiter([zlib.crc32(words[i]) for i in rare.tolist()], np.uint32, len(rare))
        hashed[rare] = code
        bucket[rare] = lexicon.shape.hashed_bucket(code.astype(np.int64))
    return place, bucket, hashed


def features(hashed: np.ndarray, is_end: np.ndarray, rows: int) -> np.ndarray:
    """Rows (of ``rows``, a power of two) of the hashed features of every token's history, [3, n]. The slice starts with a
    document; an end token stands before its first word, and nothing before that is seen."""
    end = np.uint32(zlib.crc32(END))
    one = np.concatenate([[end], hashed[:-1]]).astype(np.uint32)
    first = np.concatenate([[True], is_end[:-1]])
    two = np.where(first, end, np.concatenate([[end], one[:-1]])).astype(np.uint32)
    shift = np.uint32(33 - rows.bit_length())
    a, b = one * np.uint32(2654435761), two * np.uint32(2246822519)
    return np.stack([a >> shift, (b + np.uint32(374761393)) * np.uint32(3266489917) >> shift,
                     (a ^ (b >> np.uint32(7))) * np.uint32(668265263) >> shift]).astype(np.int64)


def softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def forward(w: Weights, rows: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(class | h) and P(member | class k, h) of every token."""
    classes, members = np.take(w.class_b[None], np.zeros_like(k), axis=0), np.take(w.member_b, k, axis=0)
    for r in rows:
        classes += np.take(w.class_w, r, axis=0)
        members += np.take(w.member_w, r * len(w.class_b) + k, axis=0)
    return softmax(classes), softmax(members)


def step(table: np.ndarray, squares: np.ndarray, keys: np.ndarray, slope: np.ndarray) -> None:
    """One adaptive gradient step on the rows of ``table`` that the slice hits: ``keys``, ascending,
    of every token, with its slope."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    hit = keys[starts]
    total = np.add.reduceat(slope, starts, axis=0)
    squares[hit] += np.einsum("ij,ij->i", total, total) / total.shape[1]
    table[hit] -= RATE * total / np.sqrt(squares[hit] + 1e-6)[:, None]


def learn(w: Weights, squares: tuple[np.ndarray, np.ndarray], rows: np.ndarray, k: np.ndarray, m: np.ndarray) -> None:
    classes, members = forward(w, rows, k)
    at = np.arange(len(k))
    classes[at, k] -= 1
    members[at, m] -= 1
    places = len(k).bit_length()
    for r in rows:
        # row and class with the token's place in one number: sorting it orders both tables
        packed = np.sort((r * len(w.class_b) + k) << places | at)
        order, keys = packed & ((1 << places) - 1), packed >> places
        step(w.class_w, squares[0], keys // len(w.class_b), np.take(classes, order, axis=0))
        step(w.member_w, squares[1], keys, np.take(members, order, axis=0))


def slices(texts: Iterator[str | None], most: int = SLICE) -> Iterator[tuple[list[bytes], list[int]]]:
    """Tokens of whole documents, about ``most`` at a time, and each document's number of tokens."""
    words, sizes = [], []
    for t in texts:
        got = tokens(t)
        words += got
        sizes.append(len(got))
        if len(words) >= most:
            yield words, sizes
            words, sizes = [], []
    if sizes:
        yield words, sizes


def train(texts: DataFrame, lexicon_sent, weights: Weights, n_tokens: int, rounds: int = ROUNDS,
          share: int = SHARE) -> Weights:
    """Distributed training on all ``texts`` (doc_id, text) of ``n_tokens`` tokens, a part of the
    documents per round. A share holds ``share`` tokens or more, and at least two a weight."""
    spark = texts.sparkSession
    shape = lexicon_sent.value.shape
    share = max(share, 2 * shape.weights)
    shares = max(1, -(-n_tokens // (rounds * share)))
    width = shape.classes * (shape.classes + 1)
    step_rows = max(1, BLOCK // width)
    code = F.xxhash64("doc_id", "text")
    slot = F.pmod(code, F.lit(rounds * shares))
    schema = "block long, share long, met binary, change binary"

    def add(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("share")      # one order of addition whatever the cluster
        met = sum(np.frombuffer(x, "<i8") for x in p["met"])
        change = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in p["change"])
        return pd.DataFrame({"block": p["block"].iloc[:1], "share": p["share"].min(), "met": [met.tobytes()],
                             "change": [change.astype("<f4").tobytes()]})

    for n in range(rounds):
        sent = spark.sparkContext.broadcast(weights)

        def walk(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lexicon, first, mine = lexicon_sent.value, sent.value, 0
            w = first.copy()
            squares = np.zeros(len(w.class_w), np.float32), np.zeros(len(w.member_w), np.float32)
            met = np.zeros(shape.rows, np.int64)

            def texts_of(batches):
                nonlocal mine
                for b in batches:
                    if b.num_rows:
                        mine = b.column("share")[0].as_py()
                    yield from b.column("text").to_pylist()

            for words, sizes in slices(texts_of(batches)):
                _, bucket, hashed = look_up(lexicon, words)
                is_end = np.zeros(len(words), bool)
                is_end[np.cumsum(sizes) - 1] = True
                rows, (k, m) = features(hashed, is_end, shape.rows), shape.spread(bucket)
                for i in range(0, len(words), SLICE):       # a long document alone can exceed a slice
                    part = slice(i, i + SLICE)
                    learn(w, squares, rows[:, part], k[part], m[part])
                met += np.bincount(rows.ravel(), minlength=shape.rows)
            if met.any():
                for i in range(0, shape.rows, step_rows):
                    of = slice(i, i + step_rows)
                    wide = slice(i * shape.classes, (i + step_rows) * shape.classes)
                    change = np.hstack([w.class_w[of] - first.class_w[of],
                                        (w.member_w[wide] - first.member_w[wide]).reshape(-1, shape.buckets)])
                    yield pa.RecordBatch.from_pydict({
                        "block": [i // step_rows], "share": [mine], "met": [met[of].astype("<i8").tobytes()],
                        "change": [(change * met[of, None]).astype("<f4").tobytes()]})

        dealt = (texts.where(slot % rounds == n)
                 .select("doc_id", "text", code.alias("code"), F.floor(slot / rounds).cast("long").alias("share"))
                 .repartitionById(shares, F.col("share").cast("int")).sortWithinPartitions("code", "doc_id"))
        parts = dealt.select("share", "text").mapInArrow(walk, schema).withColumn("part", F.col("share") % FAN_IN)
        parts = parts.groupBy("block", "part").applyInPandas(add, schema)
        rows = parts.groupBy("block").applyInPandas(add, schema).orderBy("block").collect()
        if rows:
            met = np.concatenate([np.frombuffer(r["met"], "<i8") for r in rows])
            change = np.concatenate([np.frombuffer(r["change"], "<f4") for r in rows]).reshape(shape.rows, width)
            weights = weights.moved(change / np.maximum(met, 1).astype(np.float32)[:, None])
        sent.unpersist()
    return weights


def head_words(counts: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, at most ``size``, most frequent first.

    Words are counted by level (a 64th of a power of two of their count, at most a few thousand
    levels), whole levels are taken from the top while they fit, and only their words are
    fetched: no task sends words that the driver then drops."""
    level = F.floor(F.log2("c") * 64)
    taken, low = 0, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        taken += r["count"]
        if taken > size:
            break
        low = r["level"]
    if low is None:
        return []
    rows = counts.where(level >= low).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def lexicon_of(counts: DataFrame, vocabulary: int, head_size: int) -> Lexicon:
    """The head (at most ``head_size`` words) and the bucket totals (a row a bucket) of all counts."""
    shape = Shape.of(vocabulary)
    top = head_words(counts, head_size)
    words = [w for w, _ in top]
    per = counts.groupBy((F.crc32("word") % (shape.buckets - shape.own)).cast("int").alias("rest")).agg(
        F.sum("c").alias("c"), F.count("c").alias("n")).collect()
    tokens_, words_ = np.zeros(shape.buckets), np.zeros(shape.buckets)
    for r in per:
        tokens_[shape.own + r["rest"]], words_[shape.own + r["rest"]] = r["c"], r["n"]
    bucket = np.array([shape.hashed_bucket(zlib.crc32(w)) for w in words] + [0])
    # frequent words leave the bucket of their hash for their own
    for i, (_, c) in enumerate(top[:shape.own]):
        tokens_[bucket[i]] -= c
        words_[bucket[i]] -= 1
        tokens_[i], words_[i], bucket[i] = c, 1, i
    # one more entry, for the place -1
    return Lexicon({w: i for i, w in enumerate(words)},
                   np.append(np.log10(np.array([c for _, c in top], float) + 1), 0.0),
                   bucket, np.array([zlib.crc32(w) for w in words] + [0], np.uint32), shape, tokens_, words_)


def bucket_logs(lexicon: Lexicon, w: Weights, bucket: np.ndarray, hashed: np.ndarray, is_end: np.ndarray) -> np.ndarray:
    """log10 P(bucket | history) of every token, SLICE tokens at a time: a long document alone can
    exceed a slice."""
    k, m = lexicon.shape.spread(bucket)
    rows, logs = features(hashed, is_end, lexicon.shape.rows), np.empty(len(k))
    for i in range(0, len(k), SLICE):
        part = slice(i, i + SLICE)
        classes, members = forward(w, rows[:, part], k[part])
        j = np.arange(len(classes))
        logs[part] = (np.log10(np.maximum(classes[j, k[part]], 1e-30).astype(float))
                      + np.log10(np.maximum(members[j, m[part]], 1e-30).astype(float)))
    return logs


def score_documents(docs: DataFrame, head_size: int = HEAD, share: int = SHARE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns ignored): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score (add-one unigram) and score (the model), both
    log10 of the whole text's probability.

    A null or empty text is its end token alone. Repeated rows give repeated results (and count
    as often in training). Rows with a null id are held out. Without training rows every
    base score is 0 and the model is uniform over buckets; an empty table gives no rows."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out().alias("held_out"), whole_text().alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = checkpointed(word_counts(training))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("c").alias("v")).first()
    n, v = int(sums["n"]), int(sums["v"])
    lexicon = lexicon_of(counts, v, head_size)
    lexicon_sent = spark.sparkContext.broadcast(lexicon)
    weights = train(training, lexicon_sent, start_weights(lexicon), n, share=share)
    sent = spark.sparkContext.broadcast(weights)
    in_bucket = np.log10(lexicon.bucket_tokens + lexicon.bucket_words + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, w = lexicon_sent.value, sent.value
        for b in batches:
            at = 0
            for words, sizes in slices(b.column("text").to_pylist()):
                ends = np.cumsum(sizes)
                starts = ends - sizes
                place, bucket, hashed = look_up(lexicon, words)
                is_end = np.zeros(len(words), bool)
                is_end[ends - 1] = True
                logs = bucket_logs(lexicon, w, bucket, hashed, is_end)
                logs -= in_bucket[bucket]
                rare = [Counter(words[i] for i in (np.flatnonzero(place[s:e] < 0) + s).tolist())
                        for s, e in zip(starts.tolist(), ends.tolist())]
                cuts = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id")[at:at + len(sizes)], b.column("held_out")[at:at + len(sizes)],
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((place >= 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(lexicon.log_count[place], starts)),
                    pa.array(np.add.reduceat(logs, starts)),
                    pa.ListArray.from_arrays(cuts, pa.array([x for c in rare for x in c], pa.binary())),
                    pa.ListArray.from_arrays(cuts, pa.array([x for c in rare for x in c.values()], pa.int32())),
                ], ["doc_id", "held_out", "n_tokens", "known", "log_count", "log_model", "rare", "times"])
                at += len(sizes)

    schema = ("doc_id long, held_out boolean, n_tokens long, known long, log_count double, log_model double, "
              "rare array<binary>, times array<int>")
    scored = stored(rows.mapInArrow(score, schema).withColumn("row_id", F.monotonically_increasing_id()))
    # words beyond the head, joined with the full counts; a word without a row has c = 0
    rare = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select("row_id", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    more = (rare.join(counts, "word").groupBy("row_id")
            .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_log")))
    out = scored.drop("rare", "times").join(more, "row_id", "left")
    log_count = F.col("log_count") + F.coalesce("more_log", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (log_count - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("log_model") + log_count).alias("score"))


def op4_lm(spark, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
