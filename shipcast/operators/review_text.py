"""What bad reviews say (FLT-05, TX-03..TX-07, TK-03).

Texts are processed whole. Word counts are an ``explode`` followed by a keyed count with
map-side combining, so a very frequent word is pre-aggregated in every task; top-k lists are
``orderBy().limit()`` (bounded per task), never a collect.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx

# fixed values of the reference: score thresholds, context width, list sizes, patterns,
# keywords and the pain-point lookup (word, translation, action)
BAD_MAX_SCORE = 2
GOOD_MIN_SCORE = 4
CONTEXT_WORDS = 5
TOP_WORDS = 30
TOP_CONTEXT = 15
CONTEXT_TARGETS = ["recebi", "veio", "prazo"]
PHRASE_PATTERNS = {
    "damage": {"quebrado": "quebrado|quebrou", "defeito": "defeito|defeituoso",
               "riscado": "riscado|arranhado", "amassado": "amassado",
               "incompleto": "incompleto|faltando"},
    "deadline": {"dentro do prazo": "dentro do prazo", "fora do prazo": "fora do prazo",
                 "prazo estourado": "prazo estourado", "prazo expirado": "prazo expirado"},
    "product": {"produto não funciona": "produto não funciona|produto nao funciona",
                "produto com defeito": "produto com defeito|produto defeituoso",
                "produto diferente": "produto diferente",
                "produto pequeno": "produto pequeno|produto grande",
                "produto quebrado": "produto quebrado"},
    "receipt": {"não recebi": "não recebi|nao recebi"},
}
# the word whose bad-review mention count is the denominator of each group's share
PHRASE_DENOMINATOR = {"product": "produto", "receipt": "recebi"}
DELIVERY_KEYWORDS = ["prazo", "entrega", "atraso", "chegou", "demorou", "demora", "prazo",
                     "transportadora", "correios"]
PAIN_POINTS = [
    ("produto", "product", "Improve product descriptions and quality checks"),
    ("recebi", "received", "Fix delivery tracking and carrier issues"),
    ("entrega", "delivery", "Accurate delivery estimates (Option B)"),
    ("prazo", "deadline", "Improve delivery time predictions"),
    ("loja", "store", "Seller performance monitoring"),
]


def commented_by_sentiment(reviews: DataFrame) -> DataFrame:
    """FLT-05: bad (score <= 2) and good (score >= 4) reviews that carry a comment."""
    c = reviews.where(F.col("review_comment_message").isNotNull())
    subset = (F.when(F.col("review_score") <= BAD_MAX_SCORE, "bad")
              .when(F.col("review_score") >= GOOD_MIN_SCORE, "good"))
    return c.select("*", subset.alias("subset")).where(F.col("subset").isNotNull())


def review_tokens(reviews: DataFrame) -> DataFrame:
    """TX-02 per review: content tokens (the normalised text itself, TX-01, is derived only
    where it is reported)."""
    return reviews.select("*", tx.tokenise("review_comment_message").alias("tokens"))


def word_counts(reviews: DataFrame, keys: Sequence[str] = ("subset",)) -> DataFrame:
    """TX-03: frequency of the content tokens per subset (every word). All tokens are counted; stop
    words and short ones are dropped from the counted words, not looked up for every mention."""
    keys = list(keys)
    counted = (reviews.select(*keys, F.explode(tx.pieces("review_comment_message")).alias("word"))
               .groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("count")))
    return counted.where(tx.is_content(F.col("word")))


def top_words(counts: DataFrame, subsets: Sequence[str] = ("bad", "good"), k: int = TOP_WORDS) -> DataFrame:
    """TK-03: the k most common words of each subset (ties broken by the word)."""
    parts = [counts.where(F.col("subset") == s).orderBy(F.desc("count"), "word").limit(k)
             for s in subsets]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def context_counts(bad: DataFrame, targets: Sequence[str] = CONTEXT_TARGETS,
                   width: int = CONTEXT_WORDS) -> DataFrame:
    """TX-04, every target in one pass over the texts: for each review whose raw tokens
    contain a target, the content tokens within ``width`` of its first occurrence, counted
    per (target, context word)."""
    t = F.col("t")

    def around(word: str):
        pos = F.array_position(t, word)
        start = F.greatest(pos - width, F.lit(1))
        end = F.least(pos + width, F.size(t))
        ctx = F.when(pos > 0, tx.content_tokens(F.slice(t, start, end - start + 1)))
        return F.struct(F.lit(word).alias("target"), ctx.alias("ctx"))

    toks = bad.select(tx.raw_tokens("review_comment_message").alias("t"))   # tokenised once
    hits = toks.select(F.explode(F.array(*[around(w) for w in targets])).alias("h")) \
               .where(F.col("h.ctx").isNotNull())
    return (hits.select("h.target", F.explode("h.ctx").alias("context_word"))
            .groupBy("target", "context_word").agg(F.count(F.lit(1)).alias("count")))


def top_context(counts: DataFrame, targets: Sequence[str] = CONTEXT_TARGETS,
                k: int = TOP_CONTEXT) -> DataFrame:
    """TX-04: the k most common context words of each target (ties broken by the word)."""
    parts = [counts.where(F.col("target") == w).orderBy(F.desc("count"), "context_word").limit(k)
             for w in targets]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("target", "context_word", "count")


def holds(text: Column, pattern: str) -> Column:
    """Whether ``text`` matches a pattern: literal alternatives are searched as substrings, anything else
    as a regular expression."""
    parts = pattern.split("|")
    if any(not p or re.escape(p).replace("\\ ", " ") != p for p in parts):
        return text.rlike(pattern)
    found = [text.contains(p) for p in parts]
    return reduce(lambda a, b: a | b, found)


def phrase_counts(bad: DataFrame, counts: DataFrame,
                  patterns: Mapping[str, Mapping[str, str]] = PHRASE_PATTERNS,
                  denominators: Mapping[str, str] = PHRASE_DENOMINATOR) -> DataFrame:
    """TX-05: number of bad reviews matching each phrase pattern (lower-cased text, one pass
    for all patterns), with the share of the group's word mentions where one is defined."""
    items = [(g, n, p) for g, d in patterns.items() for n, p in d.items()]
    low = bad.select(F.lower(F.col("review_comment_message")).alias("m"))  # lower-cased once
    row = low.agg(*[F.count_if(holds(F.col("m"), p)).alias(f"p{i}") for i, (_, _, p) in enumerate(items)])
    body = ", ".join(f"'{g}', '{n}', '{p}', p{i}" for i, (g, n, p) in enumerate(items))
    long = row.selectExpr(f"stack({len(items)}, {body}) AS (pattern_group, name, pattern, n_reviews)")
    denom = (counts.where((F.col("subset") == "bad") & F.col("word").isin(*denominators.values()))
             .select("word", "count"))
    groups = F.create_map(*[x for g, w in denominators.items() for x in (F.lit(g), F.lit(w))])
    long = long.withColumn("denominator_word", groups[F.col("pattern_group")])
    out = long.join(denom, long["denominator_word"] == denom["word"], "left")
    return out.select("pattern_group", "name", "pattern", "n_reviews", "denominator_word",
                      F.col("count").alias("denominator"),
                      (F.col("n_reviews") / F.col("count") * 100).alias("share_pct"))


def keyword_hit_rates(reviews: DataFrame, keywords: Sequence[str] = DELIVERY_KEYWORDS) -> DataFrame:
    """TX-06: percent of 1-star and of 5-star comments containing each keyword."""
    kws = list(dict.fromkeys(keywords))
    c = reviews.where(F.col("review_comment_message").isNotNull()).select(
        "review_score", F.lower("review_comment_message").alias("m"))
    aggs = []
    for i, kw in enumerate(kws):
        hit = F.col("m").contains(kw).cast("double")
        aggs += [F.avg(F.when(F.col("review_score") == 1, hit)).alias(f"l{i}"),
                 F.avg(F.when(F.col("review_score") == 5, hit)).alias(f"h{i}")]
    row = c.agg(*aggs)
    body = ", ".join(f"'{kw}', l{i}, h{i}" for i, kw in enumerate(kws))
    long = row.selectExpr(f"stack({len(kws)}, {body}) AS (keyword, low_rate, high_rate)")
    return long.select("keyword", (F.col("low_rate") * 100).alias("one_star_hit_pct"),
                       (F.col("high_rate") * 100).alias("five_star_hit_pct"))


def comment_shares(reviews: DataFrame) -> DataFrame:
    """TX-06: share of 1-star and of 5-star reviews that carry a comment."""
    has = F.col("review_comment_message").isNotNull()
    return reviews.agg(
        (F.count_if((F.col("review_score") == 1) & has) / F.count_if(F.col("review_score") == 1))
        .alias("one_star_comment_share"),
        (F.count_if((F.col("review_score") == 5) & has) / F.count_if(F.col("review_score") == 5))
        .alias("five_star_comment_share"))


def pain_points(counts: DataFrame, points: Sequence[tuple[str, str, str]] = PAIN_POINTS) -> DataFrame:
    """TX-07: bad-review mention counts of the pain-point words, with translation and action,
    ranked by mentions (the counts are computed, not hard-coded)."""
    spark = counts.sparkSession
    lookup = spark.createDataFrame(points, "word string, translation string, action string")
    bad = counts.where(F.col("subset") == "bad").select("word", "count")
    out = lookup.join(bad, "word", "left").select(
        "word", "translation", F.coalesce("count", F.lit(0)).alias("frequency"), "action")
    # one row per looked-up word
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("frequency"), "word")))
