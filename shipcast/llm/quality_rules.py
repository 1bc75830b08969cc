"""Quality rules (operator 3): a short-circuit cascade in Spark expressions.

A rule tests a few measures of a text. On a sample every rule is run alone, which gives its
cost (seconds) and selectivity (share rejected); rules are then tried in order of rejection per
cost, as the branches of one CASE expression, so a document pays only for the rules up
to the first that rejects it. The order changes the cost and the named reason, never the verdict."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORD, checkpointed, documents, whole_text

SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
# Rows of the sample that only decides the order of the rules.
SAMPLE_ROWS = 2000
_PLACE_BITS = 31


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, and only where the result is asked for."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SPACE_WORD), F.lit(0))


def n_words(text: Column, words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(text: Column, words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column, words: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOL)).cast("long")


def n_shouted(text: Column, words: Column) -> Column:
    """Words that end in two exclamation marks."""
    return F.regexp_count(text, F.lit(r"!!(?=[\x20\x09-\x0D]|\z)")).cast("long")


def n_stuttered(text: Column, words: Column) -> Column:
    """Words that equal the word before."""
    return let(words, lambda x: F.size(F.filter(x, lambda w, i: F.get(x, i - 1).eqNullSafe(w))).cast("long"))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(SPACE_WORD))


def n_dup_lines(text: Column, words: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(text: Column, words: Column) -> Column:
    """Words in windows of WINDOW words that the text holds twice or more.

    Sorting replaces grouping, so nothing is quadratic and nothing leaves the row: each
    window becomes one number, a 33-bit hash above its place; equal hashes stand together
    after a primitive sort. Windows whose hash is unique are unique; the others are
    compared as text, so a shared hash never counts."""
    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW)).bitwiseAND(F.lit(-(1 << _PLACE_BITS)))
            .bitwiseOR(i.cast("long"))))

    def suspects(s: Column) -> Column:
        def key(j: Column) -> Column:
            return F.shiftright(F.get(s, j), _PLACE_BITS)
        return F.transform(
            F.filter(s, lambda x, j: key(j + 1).eqNullSafe(F.shiftright(x, _PLACE_BITS))
                     | key(j - 1).eqNullSafe(F.shiftright(x, _PLACE_BITS))),
            lambda x: x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"))

    def repeated(w: Column, places: Column) -> Column:
        named = F.sort_array(F.transform(places, lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("window"), i.alias("place"))))
        return let(named, lambda x: F.sort_array(F.transform(
            F.filter(x, lambda y, j: F.get(x, j + 1)["window"].eqNullSafe(y["window"])
                     | F.get(x, j - 1)["window"].eqNullSafe(y["window"])), lambda y: y["place"])))

    def covered(places: Column) -> Column:
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(places, zero, lambda a, p: F.struct(
            (p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
            lambda a: a["n"].cast("long"))

    none = F.lit(0).cast("long")
    return let(words, lambda w: F.when(F.size(w) <= WINDOW, none).otherwise(
        let(windows(w), lambda s: let(suspects(s), lambda p: F.when(
            F.size(p) == 0, none).otherwise(covered(repeated(w, p)))))))


MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_shouted, n_stuttered, n_dup_lines, n_repeat_words)}


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``test`` over its measures holds."""
    name: str
    measures: tuple[str, ...]
    test: Callable[..., Column]
    base: bool = False


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20, base=True),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: r * 100 > n * 30, base=True),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: s * 10 > n * 3),
    Rule("shouting", ("n_shouted", "n_words"), lambda s, n: s * 10 > n * 3),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < n * 2) | (c > n * 25)),
    Rule("repeated_lines", ("n_dup_lines", "n_words"), lambda d, n: (d >= 3) & (d * 20 > n)),
    Rule("stuttering", ("n_stuttered", "n_words"), lambda s, n: s * 10 > n * 3),
)


def rejects(rule: Rule, text: Column, have: tuple[str, ...] = ()) -> Column:
    """The rule's test; measures that already are columns (``have``) are not computed again."""
    return rule.test(*[F.col(m) if m in have else MEASURES[m](text, words_of(text)) for m in rule.measures])


def rule_order(docs: DataFrame, rules=RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejection per cost on a sample of about ``rows`` documents, drawn by a hash
    of the text over the whole table. Rules that reject nothing there come last, cheapest first."""
    n = docs.count()
    keep = F.pmod(F.xxhash64(whole_text()), F.lit(max(1, n // rows))) == 0
    sample = checkpointed(docs.where(keep).select(whole_text().alias("text")))
    seen = max(1, sample.count())
    ranked = []
    for rule in rules:
        began = time.perf_counter()
        out = sample.agg(F.count_if(rejects(rule, F.col("text"))).alias("n")).first()["n"]
        cost = time.perf_counter() - began
        ranked.append((-(out / seen) / cost, cost, rule))
    return [r for _, _, r in sorted(ranked, key=lambda x: x[:2])]


def first_rejection(order: list[Rule], text: Column, have: tuple[str, ...] = ()) -> Column:
    """The name of the first rule in ``order`` that rejects the text; null if all accept it."""
    out = F
    for rule in order:
        out = out.when(rejects(rule, text, have), F.lit(rule.name))
    return out


def quality_filter(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that every rule accepts, with all their columns. Null and empty texts
    fail ``few_words``; repeated rows share a verdict; an empty table stays empty."""
    return docs.where(first_rejection(rule_order(docs, rules), whole_text()).isNull())


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    order = [r for r in rule_order(docs) if not r.base]
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = docs.select("doc_id", whole_text().alias("text"), words_of(whole_text()).alias("words"))
    out = out.select("doc_id", "text", *[MEASURES[m](F.col("text"), F.col("words")).alias(m) for m in base])
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = out.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & first_rejection(order, F.col("text"), base).isNull()
    return out.select("doc_id", *base, "base_failed", kept.alias("kept"))
