"""Byte-level BPE encoding and decoding by DuckDB recursive queries in every partition
(operator 10).

A task cuts its texts into pieces with the tokenizer's pattern and hands the distinct pieces
it has not met before to an in-process DuckDB. There a piece is a set of token-position
rows, each with the token to its right; a recursive query joins the adjacent pairs with the
merge table and contracts every piece's leftmost pair of minimum rank, until no pair is
left. An ordered aggregation over the vocabulary joined to the ids decodes them.

Memory is bounded: texts are worked off in slices, pieces in batches of bounded rows, and the
memo of pieces is emptied when it is full. A piece too long for a query is contracted in
arrays of its length. Tasks share nothing, so a lost one is simply run again."""

from __future__ import annotations

import base64
import ctypes
import threading
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, whole_text

# Texts of one slice, in characters; pieces of one recursive query; pieces and bytes the memo holds.
SLICE_CHARS = 3_000_000
QUERY_PIECES = 15_000
MEMO_PIECES = 300_000
MEMO_BYTES = 30_000_000
# Pieces longer than this are contracted table by table (see _long).
LONG_BYTES = 512
# The recursion keeps every round, at most bytes^2 / 2 rows a piece: squared bytes of one query. Tables of
# long pieces keep a row a byte: bytes of one query; a piece beyond that is contracted in arrays (see _giant).
QUERY_SQUARES = 5_000_000
QUERY_BYTES = 500_000
# Ids of one decoding query.
DECODE_IDS = 1_500_000
# Seconds after which an idle worker drops its tables and memos: other stages need the memory.
IDLE_SECONDS = 5.0
NO_MERGE = np.iinfo(np.int32).max
SCHEMA = "doc_id long, ids array<int>, decoded binary"

_TOKENS = """
  s(it, wid, pos, npos, l, r, key) AS (
  SELECT 0, wid, pos, npos, l, r, (g.m::BIGINT << 12) | pos FROM start LEFT JOIN merges g USING (l, r)
  UNION ALL
  SELECT it, wid, pos, npos, u.l, u.r, CASE WHEN fresh THEN (g.m::BIGINT << 12) | pos ELSE key END
  FROM (SELECT s.it + 1 AS it, s.wid, s.npos, s.key,
               CASE WHEN s.pos = b.npos THEN b.pos ELSE s.pos END AS pos,
               CASE WHEN s.pos = b.npos THEN b.m ELSE s.l END AS l,
               CASE WHEN s.npos = b.pos THEN b.m ELSE s.r END AS r,
               s.pos = b.npos OR s.npos = b.pos AS fresh
        FROM s JOIN (SELECT wid, (min(key) & 4095)::INT AS pos, (min(key) >> 12)::INT AS m,
                            arg_min(npos, key) AS npos
                     FROM s WHERE key IS NOT NULL GROUP BY wid) b ON s.wid = b.wid
        WHERE s.pos <> b.pos) u
  LEFT JOIN merges g ON fresh AND g.l = u.l AND g.r = u.r)"""

# The rows of a piece's last round are its tokens in order.
_RESULT = """
SELECT wid, list(l ORDER BY pos) AS ids FROM {rows} GROUP BY wid"""

# The bytes of a row's tokens, in order, are its text.
_DECODE = """
SELECT wid, string_agg(hex, '' ORDER BY pos) AS hex FROM ids JOIN vocabulary ON id = l GROUP BY wid"""

_SHORT = f"""WITH RECURSIVE {_TOKENS},
  done AS (SELECT s.* FROM s JOIN (SELECT wid, max(it) AS it FROM s GROUP BY wid) USING (wid, it))
{_RESULT.format(rows='done')}"""

# One round over long pieces: the pairs of minimum rank that do not overlap, from the left.
_LONG_HITS = """
CREATE OR REPLACE TEMP TABLE hits AS
WITH h AS (SELECT s.wid, s.pos, s.npos, s.m, lag(s.npos) OVER (PARTITION BY s.wid ORDER BY s.pos) AS before
           FROM long s JOIN (SELECT wid, min(m) AS m FROM long GROUP BY wid) b ON s.wid = b.wid AND s.m = b.m),
i AS (SELECT *, sum(CASE WHEN before = pos THEN 0 ELSE 1 END) OVER (PARTITION BY wid ORDER BY pos) AS run FROM h)
SELECT wid, pos, npos, m FROM i QUALIFY row_number() OVER (PARTITION BY wid, run ORDER BY pos) % 2 = 1"""
_LONG_ROUND = """
CREATE OR REPLACE TEMP TABLE long AS
SELECT u.wid, u.pos, u.npos, u.l, u.r, g.m
FROM (SELECT s.wid, coalesce(y.pos, s.pos) AS pos, s.npos, coalesce(y.m, s.l) AS l, coalesce(x.m, s.r) AS r
      FROM long s LEFT JOIN hits x ON s.wid = x.wid AND s.npos = x.pos
      LEFT JOIN hits y ON s.wid = y.wid AND s.pos = y.npos
      WHERE NOT EXISTS (SELECT 1 FROM hits z WHERE s.wid = z.wid AND s.pos = z.pos)) u
LEFT JOIN merges g ON g.l = u.l AND g.r = u.r"""


def batches(costs: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most QUERY_PIECES pieces whose costs add up to at most ``most``, or of one."""
    start = total = 0
    for i, cost in enumerate(costs):
        if i > start and (total + cost > most or i - start == QUERY_PIECES):
            yield start, i
            start, total = i, 0
        total += cost
    if start < len(costs):
        yield start, len(costs)


class Codec:
    """One vocabulary in one process: ranks (token bytes -> id), the pattern, and the tables."""

    def __init__(self, rank_file: bytes, pattern: str):
        import duckdb       # found when first used: importing the package takes no module that Spark does not need
        import regex

        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.token = {rank: t for t, rank in self.ranks.items()}
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items()
                  for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        # no temporary folder: what does not fit in memory fails instead of filling a disk
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self._table("merges", dict(zip("lrm", np.array(merges, np.int32).T)))
        l, r, m = np.array(sorted(merges), np.int64).T
        self.pair, self.merged = l << 32 | r, m.astype(np.int32)
        self._table("vocabulary", {"id": np.array(list(self.ranks.values()), np.int32),
                                   "hex": [t.hex() for t in self.ranks]})
        # what each known piece encodes to (32-bit ids, packed)
        self.ids_of: dict[str, bytes] = {}
        self.held = 0       # bytes of the memo's pieces

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _rows(self, name: str, pieces: list[bytes]) -> None:
        """Token-position rows of the pieces' bytes; -1 stands right of the last."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = sizes.cumsum()
        l = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        r = np.append(l[1:], -1).astype(np.int32)
        r[ends - 1] = -1
        pos = (np.arange(len(l)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        self._table(name, {"wid": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes),
                           "pos": pos, "npos": pos + np.int32(1), "l": l, "r": r})

    def _long(self, pieces: list[bytes]):
        """Long pieces: the same contraction, but all non-overlapping pairs of a piece's minimum
        rank in one round, and each round replaces the table instead of adding to it."""
        self._rows("start", pieces)
        self.db.execute("CREATE OR REPLACE TEMP TABLE long AS "
                        "SELECT s.*, g.m FROM start s LEFT JOIN merges g USING (l, r)")
        while self.db.execute("SELECT count(m) FROM long").fetchall()[0][0]:
            self.db.execute(_LONG_HITS)
            self.db.execute(_LONG_ROUND)
        return self.db.sql(_RESULT.format(rows="long")).to_arrow_table()

    def _short(self, pieces: list[bytes]):
        self._rows("start", pieces)
        return self.db.sql(_SHORT).to_arrow_table()

    def _ranks(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """The merged token of every pair (l, r); NO_MERGE where there is none."""
        out = np.full(len(l), NO_MERGE, np.int32)
        for at in range(0, len(l), QUERY_BYTES):
            pair = l[at:at + QUERY_BYTES].astype(np.int64) << 32 | r[at:at + QUERY_BYTES]
            place = np.minimum(self.pair.searchsorted(pair), len(self.pair) - 1)
            out[at:at + QUERY_BYTES] = np.where(self.pair[place] == pair, self.merged[place], NO_MERGE)
        return out

    def _giant(self, piece: bytes) -> np.ndarray:
        """The ids of one piece by the rounds of _long, in arrays that shrink with its tokens."""
        l = self.of_byte[np.frombuffer(piece, np.uint8)]
        m = self._ranks(l[:-1], l[1:])       # of every token and the one to its right
        while len(m) and (low := m.min()) != NO_MERGE:
            hits = np.flatnonzero(m == low)
            run = np.flatnonzero(np.diff(hits, prepend=-2) > 1)       # where runs of overlapping pairs start
            hits = hits[(np.arange(len(hits)) - np.repeat(run, np.diff(run, append=len(hits)))) % 2 == 0]
            l[hits] = low
            keep = np.ones(len(l), bool)
            keep[hits + 1] = False
            place = hits - np.arange(len(hits))       # where the merged tokens stand now
            l, m = l[keep], m[keep[1:]]
            # a dropped token's pair with its right goes, the merged token takes that place
            fresh = np.unique(np.concatenate([place, place - 1]))
            fresh = fresh[(fresh >= 0) & (fresh < len(l) - 1)]
            m[fresh] = self._ranks(l[fresh], l[fresh + 1])
        return l

    def learn(self, pieces: set[str]) -> None:
        """Encode and decode the pieces that the memo does not hold."""
        new = [p for p in pieces if p not in self.ids_of]
        raw = [p.encode("utf-8") for p in new]
        self.held += sum(map(len, raw))
        todo: dict[bool, list[int]] = {False: [], True: []}
        for i, b in enumerate(raw):
            token = self.ranks.get(b)
            if token is not None:
                self.ids_of[new[i]] = token.to_bytes(4, "little")
            elif len(b) > max(LONG_BYTES, QUERY_BYTES):
                self.ids_of[new[i]] = self._giant(b).astype("<i4").tobytes()
            else:
                todo[len(b) > LONG_BYTES].append(i)
        for is_long, places in todo.items():
            places.sort(key=lambda i: len(raw[i]))       # pieces of a query need about as many rounds
            costs = [len(raw[i]) if is_long else len(raw[i]) ** 2 for i in places]
            for lo, hi in batches(costs, QUERY_BYTES if is_long else QUERY_SQUARES):
                some = places[lo:hi]
                done = (self._long if is_long else self._short)([raw[i] for i in some])
                names = [new[some[w]] for w in done["wid"].to_pylist()]
                ids = done["ids"].combine_chunks()
                packed = np.ascontiguousarray(ids.values.to_numpy(), "<i4").tobytes()
                cuts = (ids.offsets.to_numpy() * 4).tolist()
                self.ids_of.update(zip(names, [packed[i:j] for i, j in zip(cuts, cuts[1:])]))

    def forget(self, most: int = MEMO_PIECES) -> None:
        if len(self.ids_of) > most or self.held > MEMO_BYTES:
            self.ids_of.clear()
            self.held = 0

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each row of ids, by ordered aggregation over the vocabulary joined to
        them; rows go into queries of bounded size, a row beyond that in parts."""
        sizes = np.array([len(x) for x in rows], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32)
        ends = sizes.cumsum()
        out: list[list[bytes]] = [[] for _ in rows]
        for at in range(0, len(flat), DECODE_IDS):
            some = np.arange(at, min(at + DECODE_IDS, len(flat)))
            wid = np.searchsorted(ends, some, "right").astype(np.int32)
            self._table("ids", {"wid": wid, "pos": (some - at).astype(np.int32), "l": flat[some]})
            done = self.db.sql(_DECODE).to_arrow_table()
            for i, h in zip(done["wid"].to_pylist(), done["hex"].to_pylist()):
                out[i].append(bytes.fromhex(h))
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


def encode_slice(codec: Codec, texts: list[str]) -> tuple[list[np.ndarray], list[bytes]]:
    """ids of every text, and the bytes that these ids decode to."""
    codec.forget()
    pieces = [codec.cut(t) for t in texts]
    codec.learn(set(chain.from_iterable(pieces)))
    known = codec.ids_of.__getitem__
    rows = [np.frombuffer(b"".join(map(known, p)), "<i4") for p in pieces]
    del pieces
    return rows, codec.decode(rows)


_CODECS: dict[tuple[int, str], Codec] = {}
_IDLE: list[threading.Timer] = []


def codec(rank_file: bytes, pattern: str) -> Codec:
    """This process's codec of a vocabulary; tasks that follow in a worker reuse it."""
    while _IDLE:
        _IDLE.pop().cancel()
    key = (hash(rank_file), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


def give_back() -> None:
    """Return freed memory to the system, and the codec too if no task follows soon: a worker outlives
    its task and may idle through the stages that follow."""
    def release() -> None:
        _CODECS.clear()
        trim()

    trim()
    timer = threading.Timer(IDLE_SECONDS, release)
    timer.daemon = True
    timer.start()
    _IDLE.append(timer)


def trim() -> None:
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc
    if give:
        give(0)


def _slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded for every row of ``docs`` (doc_id, text; other columns ignored): the
    ids of the whole text under the rank file at ``rank_path``, and the bytes they decode to.
    Null and empty texts have no ids and no bytes; repeated rows give repeated results; an
    empty table gives an empty one. The rank file (under 1 MB) is sent to the tasks."""
    with open(rank_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(sent.value, pattern)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in _slices(texts):
                ids, out = encode_slice(c, texts[lo:hi])
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[lo:hi], lists, pa.array(out, pa.binary())],
                                                 ["doc_id", "ids", "decoded"])
                del ids, out, lists
            del texts
        give_back()

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, SCHEMA)


def decode(rows: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, decoded for every row of ``rows`` (doc_id, ids): the general decoder."""
    with open(rank_path, "rb") as f:
        sent = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(sent.value, pattern)
        for b in batches:
            ids = [np.array(x or [], np.int32) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(c.decode(ids), pa.binary())],
                                             ["doc_id", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame, *more) -> DataFrame:
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(encode_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN))
