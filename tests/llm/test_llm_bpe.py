import random

import public_tokenizers
import pytest
import tiktoken

from shipcast.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, decoded string"


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return B.codec(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def cases():
    rnd = random.Random(1)
    out = ["", " ", "  a", "a  b ", "it's  \n\n they'll", "a" * 3000, "abab" * 400, " " * 1000, "é" * 700,
           "日本語テキスト" * 200, "x  y", "1234567890" * 100, "don't stop'd 'sa", "\x1c a", "a \x85b", "<|endoftext|> hi",
           "the" * 800, "=-" * 900, "!" * 2222, "a b  c", "tab\tand \r\n", "\x00\x01 \x7f", "😀😀 👩‍👩‍👧 z",
           "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)),
           "".join(rnd.choice("etaoin") for _ in range(3000))]
    out += ["".join(rnd.choice("aAbe. ,'s\n1é\t") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    return out + ["".join(rnd.choice("theinganr") for _ in range(rnd.randint(513, 900))) for _ in range(20)]


def test_slices_equal_the_library(codec, reference):
    texts = cases()
    ids, decoded = B.encode_slice(codec, texts)
    assert [x.tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert decoded == [t.encode() for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_memo_limits_do_not_change_results(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "QUERY_PIECES", 7)
    monkeypatch.setattr(B, "LONG_BYTES", 6)
    codec.ids_of.clear()
    texts = cases()[:60]
    ids, _ = B.encode_slice(codec, texts)
    assert [x.tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    codec.forget(0)
    assert not codec.ids_of


def test_frame(spark, reference):
    texts = [None, *cases()[:40], "word " * 30_000]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "a null id", "", "")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    out = B.encode_decode(df, PATH, public_tokenizers.PATTERN)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a null id" if r.doc_id is None else texts[r.doc_id] or ""
        assert r.ids == reference.encode_ordinary(text) and bytes(r.decoded) == text.encode()
    back = {r.doc_id: bytes(r.decoded) for r in B.decode(out, PATH, public_tokenizers.PATTERN).collect()}
    assert back == {r.doc_id: bytes(r.decoded) for r in got}
    assert B.encode_decode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, reference):
    import hashlib

    from conftest import SMALL
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = B.op10_bpe(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_slices_of_long_pieces_fit_the_memory(codec, reference):
    """Long runs of letters: queries are cut by the rows they make, not by their pieces alone."""
    rnd = random.Random(2)
    run = lambda letters, n: "".join(rnd.choices(letters, k=n))
    texts = [" ".join([run("ACGT", 100) for _ in range(12_000)]), " ".join([run("日本語中文字符", 27) for _ in range(4_000)]),
             " ".join([run("acgt", 500) for _ in range(100)]), " ".join(["a" * n for n in range(513, 1_500)]),
             run("ACGT", 2_500_000)]
    for t in texts:
        ids, decoded = B.encode_slice(codec, [t])
        assert ids[0].tolist() == reference.encode_ordinary(t) and decoded == [t.encode()]


def test_pieces_beyond_a_query_equal_the_library(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "QUERY_BYTES", 6)
    monkeypatch.setattr(B, "QUERY_SQUARES", 50)
    monkeypatch.setattr(B, "LONG_BYTES", 4)
    codec.ids_of.clear()
    texts = cases()[:60]
    ids, decoded = B.encode_slice(codec, texts)
    assert [x.tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert decoded == [t.encode() for t in texts]
    codec.forget(0)
    assert not codec.held
