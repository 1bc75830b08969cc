import random
import re

from pyspark.sql import functions as F

from shipcast.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, words string, n_words int, kept string"


def brute(text):
    text = text or ""
    words = re.findall(Q.SPACE_WORD, text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(Q.SPACE_WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(Q.SYMBOL, text)), len(lines) - len(set(lines)), len(covered),
            sum(w.endswith("!!") for w in words), sum(a == b for a, b in zip(words, words[1:])))


def texts():
    rnd = random.Random(0)
    out = [None, "", " \t\n", "a", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 5000, "line one\nline one\n\n\nline one",
           "é ñ 😀!! a!! !!", "a b!!\u0085", "wow!!", "a\x00b c\x1cd", "# * $ % & | < > " * 30]
    for _ in range(150):
        vocabulary = "abc" if rnd.random() < 0.5 else "abcdefghijklmnop"
        out.append("".join(rnd.choice(vocabulary) + rnd.choice("     \n!#") for _ in range(rnd.randint(0, 300))))
    half = " ".join(rnd.choice("uvwxyz") + str(rnd.randint(0, 99)) for _ in range(3000))
    return out + [half + " " + half, half]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouted", "n_stuttered")


def test_measures_equal_brute_force(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, "clash", 0, "clash") for i, x in enumerate(t)], SCHEMA)
    df = df.select("doc_id", Q.whole_text().alias("text"))
    got = df.select("doc_id", *[Q.MEASURES[m](F.col("text"), Q.words_of(F.col("text"))).alias(m)
                                for m in MEASURES]).collect()
    for r in got:
        assert tuple(r[m] for m in MEASURES) == brute(t[r.doc_id]), t[r.doc_id]


def test_cascade_verdict_does_not_depend_on_the_order(spark):
    t = texts()
    df = spark.createDataFrame([(i, x, "clash", 0, "clash") for i, x in enumerate(t)] * 2, SCHEMA)
    kept = {}
    for order in (list(Q.RULES), list(Q.RULES)[::-1]):
        reason = Q.first_rejection(order, Q.whole_text())
        kept[order[0].name] = sorted(r.doc_id for r in df.where(reason.isNull()).collect())
    first, second = kept.values()
    assert first == second
    alone = df.where(~F.greatest(*[Q.rejects(r, Q.whole_text()) for r in Q.RULES]))
    assert sorted(r.doc_id for r in alone.collect()) == first
    out = Q.quality_filter(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == first


def test_order_prefers_rejection_per_cost(spark):
    rows = [(i, "w!! " * 40 if i % 2 else " ".join(f"word{j}" for j in range(40)), "", 0, "") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    order = [r.name for r in Q.rule_order(df)]
    assert sorted(order) == sorted(r.name for r in Q.RULES)
    rejecting = {"shouting", "repeated_words", "stuttering"}
    assert set(order[:3]) == rejecting


def test_empty_table(spark):
    assert Q.quality_filter(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a", "", 0, "")], SCHEMA)
    assert not re.search("Python|Arrow|Pandas", Q.quality_filter(df)._jdf.queryExecution().toString())
