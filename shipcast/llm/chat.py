"""Relational chat formatting (operator 5), with Spark expressions only: collect a
conversation's turns, sort them, merge adjacent turns of one role into a block, concatenate,
and read everything back from the formatted string. The work of a conversation grows with its
turns, but for the copying of one place a chunk of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents

# The template's control strings, fixed values: [INST]role[/INST]text<s>text</s>
OPEN, HEAD, NEXT, CLOSE = "[INST]", "[/INST]", "<s>", "</s>"
# A control string with any number of backslashes after its first character. Escaping adds one
# backslash there and unescaping takes one away, so no text holds a control string and
# every text comes back as it was.
_REST = r"(/?INST\]|/?s>)"
ESCAPE = (r"([<\[])(\\*)" + _REST, r"$1\\$2$3")
UNESCAPE = (r"([<\[])\\(\\*)" + _REST, r"$1$2$3")
LOSS_ROLE = "assistant"
SPAN = "struct<start:int,chars:int>"
# Running places are added up in chunks of this many turns, so that no array grows turn by turn.
CHUNK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE[0]), F.lit(ESCAPE[1]))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE[0]), F.lit(UNESCAPE[1]))


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conv_id of ``turns`` (conv_id, turn, role, text; other columns are ignored):
    ``formatted`` and ``loss_spans``, an array of (start, chars) of the escaped texts of
    ``loss_role`` in it (places count code points from 0).

    Turns are sorted by turn (null first), then role, then text; repeated rows are repeated
    turns. Null roles and texts are empty strings; a null conv_id is a conversation. An empty
    table gives an empty result. A conversation is one output string, so its turns meet in
    one row; nothing else is gathered."""
    clean = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    conv = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # where the role changes, and the block of escaped texts from there to the next change
    role = lambda i: F.get("turns", i)["role"]
    starts = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))
    conv = conv.select("conv_id", "turns", starts.alias("starts"))
    conv = conv.select("conv_id", F.transform("starts", lambda s, k: F.struct(
        escape(role(s)).alias("role"), (role(s) == loss_role).alias("loss"),
        F.transform(F.sequence(s, F.coalesce(F.get("starts", k + 1), F.size("turns")) - 1),
                    lambda i: escape(F.get("turns", i)["text"])).alias("texts"))).alias("blocks"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit(HEAD), F.array_join(b["texts"], NEXT), F.lit(CLOSE))), "")
    # every text with the number of characters of markup before and after it
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda x, i: F.struct(
        b["loss"].alias("loss"), F.length(x).alias("chars"),
        F.when(i == 0, F.length(b["role"]) + len(OPEN + HEAD)).otherwise(len(NEXT)).alias("lead"),
        F.when(i == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(0).alias("tail")))))
    conv = conv.select("conv_id", formatted.alias("formatted"), pieces.alias("pieces"))
    # spans from the start of their chunk, then moved by what stands before the chunk
    local = F.transform(_chunks("pieces"), lambda c: F.aggregate(
        c, F.expr(f"named_struct('at', 0, 'spans', cast(array() as array<{SPAN}>))"),
        lambda acc, p: F.struct(
            (acc["at"] + p["lead"] + p["chars"] + p["tail"]).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["lead"]).alias("start"), p["chars"].alias("chars")))))
            .otherwise(acc["spans"]).alias("spans"))))
    spans = F.aggregate(
        local, F.expr(f"named_struct('at', 0, 'spans', cast(array() as array<array<{SPAN}>>))"),
        lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["spans"], F.array(F.transform(
            c["spans"], lambda x: F.struct((acc["at"] + x["start"]).alias("start"), x["chars"].alias("chars"))))
        ).alias("spans")),
        lambda acc: F.flatten(acc["spans"]))
    return conv.select("conv_id", "formatted", spans.alias("loss_spans"))


def _chunks(array: str | Column) -> Column:
    """The array in parts of CHUNK elements."""
    array = F.col(array) if isinstance(array, str) else array
    at = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1, F.lit(CHUNK)))
    return F.transform(F.coalesce(at, F.expr("cast(array() as array<int>)")), lambda i: F.slice(array, i + 1, CHUNK))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order, unescaped."""
    quote = "\\Q{}\\E".format
    blocks = F.split(formatted, quote(CLOSE), -1)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.split(b, quote(HEAD), 2)[1], quote(NEXT), -1),
        lambda x: F.struct(
            unescape(F.substring(F.split(b, quote(HEAD), 2)[0], len(OPEN) + 1, 1 << 30)).alias("role"),
            unescape(x).alias("text")))))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped piece by piece; the spans of a chunk are cut from the
    part of the string that holds them."""
    def cut(part: Column) -> Column:
        return F.array_join(F.transform(part["spans"], lambda x: unescape(
            F.substring(part["text"], x["start"] - part["at"] + 1, x["chars"]))), "")

    parts = F.transform(_chunks(spans), lambda c: F.struct(
        F.get(c, F.lit(0))["start"].alias("at"), c.alias("spans"),
        F.substring(formatted, F.get(c, F.lit(0))["start"] + 1, F.element_at(c, -1)["start"]
                    + F.element_at(c, -1)["chars"] - F.get(c, F.lit(0))["start"]).alias("text")))
    return F.array_join(F.transform(parts, cut), "")


def op5_chat(spark, sf_dir: str) -> DataFrame:
    said = CLOSE + OPEN + " ok " + HEAD
    extra = spark.sql("SELECT -7L AS conv_id, t.* FROM VALUES (0L, 'user', '%s'), (1L, 'assistant', '%s') "
                      "AS t(turn, role, text)" % (said, said))
    turns = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = format_conversations(turns.unionByName(extra))
    out = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                     read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
