"""Queries: review text (FLT-05, TX-01..TX-07, TK-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import review_text as rt
from .catalog import finalize, market, query, shared
from .q_reports import EDA_CTES


def sentiment_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no column of the orders is read, so the texts are not moved to meet them
    reviews = market(spark, sf_dir).reviews.select("review_id", "review_score", "review_comment_message")
    return rt.review_tokens(rt.commented_by_sentiment(reviews))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "word_counts", lambda: rt.word_counts(sentiment_tokens(spark, sf_dir)))


TEXT_CTES = EDA_CTES + f""",
x_sent AS (SELECT *, CASE WHEN review_score <= {rt.BAD_MAX_SCORE} THEN 'bad' ELSE 'good' END AS subset FROM e_rwo
  WHERE review_comment_message IS NOT NULL AND (review_score <= {rt.BAD_MAX_SCORE} OR review_score >= {rt.GOOD_MIN_SCORE})),
x_tok AS (SELECT review_id, subset, review_comment_message, {tx.normalise_sql('review_comment_message')} AS clean_text,
  {tx.tokenise_sql('review_comment_message')} AS tokens FROM x_sent),
x_counts AS (SELECT subset, word, count(*) AS count FROM (SELECT subset, unnest(tokens) AS word FROM x_tok) GROUP BY subset, word)"""


@query("flt_05", "SELECT review_id, subset FROM x_sent", TEXT_CTES)
def flt_05(spark, sf_dir):
    """FLT-05: bad (<= 2) and good (>= 4) reviews with a comment."""
    return finalize(sentiment_tokens(spark, sf_dir).select("review_id", "subset"))


@query("tx_01", "SELECT review_id, clean_text FROM x_tok", TEXT_CTES)
def tx_01(spark, sf_dir):
    t = sentiment_tokens(spark, sf_dir)
    return finalize(t.select("review_id", tx.normalise("review_comment_message").alias("clean_text")))


@query("tx_02", """SELECT review_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS BIGINT) AS n_tokens
 FROM x_tok""", TEXT_CTES)
def tx_02(spark, sf_dir):
    t = sentiment_tokens(spark, sf_dir)
    return finalize(t.select("review_id", F.array_join("tokens", " ").alias("tokens"),
                             F.size("tokens").alias("n_tokens")))


@query("tx_03", "SELECT subset, word, count FROM x_counts", TEXT_CTES)
def tx_03(spark, sf_dir):
    """TX-03: word frequency in bad vs good reviews (every word)."""
    return finalize(counts(spark, sf_dir))


@query("tk_03", """SELECT subset, word, count FROM (SELECT *, row_number() OVER (PARTITION BY subset ORDER BY count DESC, word) AS rn
 FROM x_counts) WHERE rn <= 30""", TEXT_CTES)
def tk_03(spark, sf_dir):
    """TK-03: 30 most common words of bad and of good reviews."""
    return finalize(rt.top_words(counts(spark, sf_dir)))


def _context_sql(word: str) -> str:
    pos = f"list_position(t, '{word}')"
    ctx = tx.content_tokens_sql(f"list_slice(t, greatest({pos} - {rt.CONTEXT_WORDS}, 1), least({pos} + {rt.CONTEXT_WORDS}, len(t)))")
    return f"""SELECT * FROM (SELECT '{word}' AS target, context_word, count(*) AS count FROM (
 SELECT unnest({ctx}) AS context_word FROM (SELECT {tx.raw_tokens_sql('review_comment_message')} AS t FROM x_sent WHERE subset = 'bad')
 WHERE {pos} IS NOT NULL) GROUP BY context_word ORDER BY count DESC, context_word LIMIT {rt.TOP_CONTEXT})"""


# The driver's texts are invented prose in four languages, so the Portuguese words above hardly
# occur in them. These frequent words run the same operators on rows that are not empty.
FOUND_TARGETS = ["the", "que", "der"]
FOUND_PATTERNS = {"article": {"of the": "of the|in the", "de la": "de la"}, "link": {"und": "und|and"}}
FOUND_DENOMINATOR = {"article": "the", "link": "and"}
FOUND_KEYWORDS = ["tion", "the", "zu"]
FOUND_POINTS = [("the", "article", "none"), ("and", "and", "none"), ("absent", "absent", "none")]


@query("tx_04", " UNION ALL ".join(_context_sql(w) for w in rt.CONTEXT_TARGETS), TEXT_CTES)
def tx_04(spark, sf_dir):
    """TX-04: context words around 'recebi', 'veio' and 'prazo' in bad reviews. The texts
    are tokenised and counted once for all targets; the checkpointed counts feed the per-target
    top-k (so the target filter is not pushed back into the text scan three times)."""
    def build():
        bad = sentiment_tokens(spark, sf_dir).where(F.col("subset") == "bad")
        return rt.context_counts(bad)
    return finalize(rt.top_context(shared(spark, sf_dir, "context_counts", build)))


@query("tx_04_found", " UNION ALL ".join(_context_sql(w) for w in FOUND_TARGETS), TEXT_CTES)
def tx_04_found(spark, sf_dir):
    """TX-04 around words that occur in the driver's texts."""
    def build():
        bad = sentiment_tokens(spark, sf_dir).where(F.col("subset") == "bad")
        return rt.context_counts(bad, FOUND_TARGETS)
    return finalize(rt.top_context(shared(spark, sf_dir, "context_counts_found", build), FOUND_TARGETS))


def _phrase_sql(patterns=rt.PHRASE_PATTERNS, denominators=rt.PHRASE_DENOMINATOR) -> str:
    rows = []
    for g, d in patterns.items():
        for n, p in d.items():
            w = denominators.get(g)
            wsql = f"'{w}'" if w else "CAST(NULL AS VARCHAR)"
            rows.append(f"""SELECT '{g}' AS pattern_group, '{n}' AS name, '{p}' AS pattern,
 (SELECT count(*) FROM x_sent WHERE subset = 'bad' AND regexp_matches(lower(review_comment_message), '{p}')) AS n_reviews,
 {wsql} AS denominator_word""")
    return f"""WITH ph AS ({" UNION ALL ".join(rows)})
 SELECT ph.*, c.count AS denominator, round(ph.n_reviews / c.count * 100, 6) AS share_pct
 FROM ph LEFT JOIN x_counts c ON c.subset = 'bad' AND c.word = ph.denominator_word"""


@query("tx_05", _phrase_sql(), TEXT_CTES)
def tx_05(spark, sf_dir):
    """TX-05: damage, deadline, product and negated-receipt phrase counts in bad reviews."""
    bad = sentiment_tokens(spark, sf_dir).where(F.col("subset") == "bad")
    return finalize(rt.phrase_counts(bad, counts(spark, sf_dir)))


@query("tx_05_found", _phrase_sql(FOUND_PATTERNS, FOUND_DENOMINATOR), TEXT_CTES)
def tx_05_found(spark, sf_dir):
    """TX-05 with patterns that occur in the driver's texts."""
    bad = sentiment_tokens(spark, sf_dir).where(F.col("subset") == "bad")
    return finalize(rt.phrase_counts(bad, counts(spark, sf_dir), FOUND_PATTERNS, FOUND_DENOMINATOR))


def _keyword_sql(keywords=rt.DELIVERY_KEYWORDS) -> str:
    parts = []
    for kw in dict.fromkeys(keywords):
        hit = f"CAST(contains(lower(review_comment_message), '{kw}') AS DOUBLE)"
        parts.append(f"""SELECT '{kw}' AS keyword,
 round(avg(CASE WHEN review_score = 1 THEN {hit} END) * 100, 6) AS one_star_hit_pct,
 round(avg(CASE WHEN review_score = 5 THEN {hit} END) * 100, 6) AS five_star_hit_pct
 FROM v_reviews WHERE review_comment_message IS NOT NULL""")
    return " UNION ALL ".join(parts)


@query("tx_06", _keyword_sql())
def tx_06(spark, sf_dir):
    """TX-06: delivery keyword hit rates in 1-star vs 5-star comments (keywords deduplicated)."""
    return finalize(rt.keyword_hit_rates(market(spark, sf_dir).reviews))


@query("tx_06_found", _keyword_sql(FOUND_KEYWORDS))
def tx_06_found(spark, sf_dir):
    """TX-06 with keywords that occur in the driver's texts."""
    return finalize(rt.keyword_hit_rates(market(spark, sf_dir).reviews, FOUND_KEYWORDS))


@query("tx_06_share", """SELECT round(count(*) FILTER (WHERE review_score = 1 AND review_comment_message IS NOT NULL)
 / count(*) FILTER (WHERE review_score = 1), 6) AS one_star_comment_share,
 round(count(*) FILTER (WHERE review_score = 5 AND review_comment_message IS NOT NULL)
 / count(*) FILTER (WHERE review_score = 5), 6) AS five_star_comment_share FROM v_reviews""")
def tx_06_share(spark, sf_dir):
    """TX-06: share of 1-star and 5-star reviews with a comment."""
    return finalize(rt.comment_shares(market(spark, sf_dir).reviews))


def _points_sql(points=rt.PAIN_POINTS) -> str:
    return "WITH lk AS (" + " UNION ALL ".join(
        f"SELECT '{w}' AS word, '{tr}' AS translation, '{a}' AS action" for w, tr, a in points) + """)
 SELECT lk.word, lk.translation, coalesce(c.count, 0) AS frequency, lk.action,
 row_number() OVER (ORDER BY coalesce(c.count, 0) DESC, lk.word) AS rank FROM lk
 LEFT JOIN x_counts c ON c.subset = 'bad' AND c.word = lk.word"""


@query("tx_07_found", _points_sql(FOUND_POINTS), TEXT_CTES)
def tx_07_found(spark, sf_dir):
    """TX-07 with words that occur in the driver's texts."""
    return finalize(rt.pain_points(counts(spark, sf_dir), FOUND_POINTS))


@query("tx_07", _points_sql(), TEXT_CTES)
def tx_07(spark, sf_dir):
    """TX-07: pain-point words with computed mention counts, translation and action."""
    return finalize(rt.pain_points(counts(spark, sf_dir)))
