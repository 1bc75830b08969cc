"""Review-text expressions (TX-01, TX-02): normalise, tokenise, drop stop words.

All of it is built-in column expressions (regexp_replace, split, higher-order filter) with
Spark ML's stop-word lists; the same patterns run unchanged in DuckDB's RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import PORTUGUESE

# Explicit whitespace class so that Java regex and RE2 agree (RE2's \s lacks \x0B).
WS = r" \t\n\x0B\f\r"
NON_WORD = rf"[^\p{{L}}\p{{N}}_{WS}]"      # Unicode \W without whitespace: punctuation, symbols
DIGITS = r"\p{Nd}+"
SPACES = rf"[{WS}]+"
RAW_TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]+"   # words, or runs of punctuation
# what survives normalisation as part of a token: letters, numbers other than decimal
# digits (digits are removed), underscore; every other character separates tokens
TOKEN_SEPARATORS = r"[^\p{L}\p{Nl}\p{No}_]+"
MIN_TOKEN_LENGTH = 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(text) -> Column:
    """TX-01: lower case, punctuation and digits to spaces, squeeze spaces, trim; NULL -> ''."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    t = F.regexp_replace(t, NON_WORD, " ")
    t = F.regexp_replace(t, DIGITS, " ")
    t = F.regexp_replace(t, SPACES, " ")
    return F.trim(t)


def normalise_sql(expr: str) -> str:
    inner = f"lower(coalesce({expr}, ''))"
    inner = f"regexp_replace({inner}, '{NON_WORD}', ' ', 'g')"
    inner = f"regexp_replace({inner}, '{DIGITS}', ' ', 'g')"
    inner = f"regexp_replace({inner}, '{SPACES}', ' ', 'g')"
    return f"trim({inner})"


def raw_tokens(text) -> Column:
    """Tokens of the lower-cased raw text: words and punctuation runs (TX-04)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(RAW_TOKEN), 0)


def raw_tokens_sql(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '{RAW_TOKEN}')"


STOP_WORDS = {"portuguese": PORTUGUESE}


def stop_words(language: str = "portuguese") -> tuple[str, ...]:
    """The stop-word list of ``language``; packaged, so it needs neither a session nor jars."""
    return STOP_WORDS[language]


def content_tokens(tokens, language: str = "portuguese") -> Column:
    """TX-02: drop stop words and tokens shorter than three characters."""
    return F.filter(_c(tokens), lambda x: is_content(x, language))


def content_tokens_sql(expr: str, language: str = "portuguese") -> str:
    sw = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words(language))
    return f"list_filter({expr}, lambda x: length(x) >= {MIN_TOKEN_LENGTH} AND NOT list_contains([{sw}], x))"


def is_content(token: Column, language: str = "portuguese") -> Column:
    """TX-02 for one token: at least three characters and no stop word."""
    # ``isin`` over the literal list becomes a hash-set lookup (InSet) in the optimizer
    return (F.length(token) >= MIN_TOKEN_LENGTH) & ~token.isin(*stop_words(language))


def pieces(text) -> Column:
    """Every token of the text, stop words and short ones too (see ``tokenise``)."""
    return F.split(F.lower(F.coalesce(_c(text), F.lit(""))), TOKEN_SEPARATORS)


def tokenise(text, language: str = "portuguese") -> Column:
    """TX-01 + TX-02: content tokens of the normalised text. Same tokens as splitting the
    normalised text on spaces, but one regex split instead of three replacements: the
    characters that normalisation keeps inside tokens are letters, non-decimal numbers and
    underscore; every run of anything else separates tokens (empty pieces are shorter than
    the minimum length and drop out)."""
    return content_tokens(pieces(text), language)


def tokenise_sql(expr: str, language: str = "portuguese") -> str:
    return content_tokens_sql(f"string_split({normalise_sql(expr)}, ' ')", language)
