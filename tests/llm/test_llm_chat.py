import hashlib
import random
import re

from pyspark.sql import functions as F

from shipcast.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, turns string, blocks int, formatted string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


def read(df):
    out = C.format_conversations(df)
    return {r.conv_id: r for r in out.select(
        "conv_id", "formatted", C.read_turns(F.col("formatted")).alias("turns"),
        C.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(0)
    parts = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "[", "<", "/", "s>", "INST]", " ", "é", "😀", "[\\INST]", "<\\\\/s>", "\n", "$1"]
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 6)):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "", "<s>"]),
                         "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))))
    got = read(frame(spark, rows))
    for conv in range(120):
        mine = [(r, t) for c, _, r, t in rows if c == conv]
        assert [tuple(t) for t in got[conv].turns] == mine
        assert got[conv].loss == "".join(t for r, t in mine if r == "assistant")


def test_adjacent_turns_merge_into_one_block(spark):
    got = read(frame(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]))
    assert got[1].formatted == "[INST]user[/INST]a<s>b</s>[INST]assistant[/INST]c</s>[INST]user[/INST]d</s>"


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", "x"), (2, None, "user", "first"), (2, 0, None, None), (2, 1, "assistant", "z"),
            (2, 1, "assistant", "y"), (2, 1, "assistant", "y")]
    got = read(frame(spark, rows))
    assert [tuple(t) for t in got[None].turns] == [("user", "x")]
    assert [tuple(t) for t in got[2].turns] == [
        ("user", "first"), ("", ""), ("assistant", "y"), ("assistant", "y"), ("assistant", "z")]
    assert got[2].loss == "yyz"


def test_long_text_and_empty_table(spark):
    text = "word [INST] " * 100_000
    assert [tuple(t) for t in read(frame(spark, [(1, 0, "assistant", text)]))[1].turns] == [("assistant", text)]
    assert C.format_conversations(frame(spark, [])).count() == 0


def test_query_holds_the_planted_conversation(spark):
    from conftest import SMALL
    out = C.op5_chat(spark, SMALL)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
    r = out.where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert r.n_turns == 2 and r.loss_chars == len(said)
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_conversation_of_many_turns(spark):
    """More turns than a chunk, of alternating and of equal roles."""
    rnd = random.Random(1)
    rows = [(c, i, rnd.choice(roles), f"{i} <s> é" * rnd.randint(0, 2))
            for c, n, roles in ((1, 5000, ["user", "assistant"]), (2, C.CHUNK, ["assistant"]), (3, C.CHUNK + 1, ["user"]))
            for i in range(n)]
    got = read(frame(spark, rows))
    for c in (1, 2, 3):
        mine = [(r, t) for x, _, r, t in rows if x == c]
        assert [tuple(t) for t in got[c].turns] == mine
        assert got[c].loss == "".join(t for r, t in mine if r == "assistant")
