"""Exact quantiles, k-th row, running sums and rolling windows over many partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shipcast.functions.ordinal import global_running_sum, keys_at, kth_key
from shipcast.functions import quantile as Q
from shipcast.functions.quantile import quantiles


@pytest.fixture(params=[3, 211])
def partitions(spark, request):
    """Few partitions, and more than the keys have rows to fill; none merged."""
    names = {"spark.sql.shuffle.partitions": str(request.param),
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def _data(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 800), "x": np.round(rng.normal(size=800), 2)})
    pdf.loc[pdf.g == 2, "x"] = 4.0          # a constant group
    pdf.loc[::11, "x"] = np.nan             # skipped like pandas
    return pdf, spark.createDataFrame(pdf)


def test_grouped_quantiles_equal_pandas(spark, partitions):
    pdf, df = _data(spark)
    got = quantiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.99}, ["g"]).toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g").x.quantile([0.1, 0.5, 0.99]).unstack()
    np.testing.assert_allclose(got[["a", "b", "c"]].to_numpy(), exp.to_numpy(), rtol=1e-12)
    glob = quantiles(df, "x", {"m": 0.37}).first()["m"]
    assert abs(glob - pdf.x.quantile(0.37)) < 1e-12


def test_kth_key_equals_sort(spark, partitions):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 20, 500), "b": rng.permutation(500)})
    pdf.loc[:200, "a"] = 7                   # a hot key holding 40 % of the rows
    df = spark.createDataFrame(pdf)
    srt = pdf.sort_values(["a", "b"]).reset_index(drop=True)
    for k in (0, 150, 250, 499):
        assert kth_key(df, ["a", "b"], k) == tuple(srt.loc[k, ["a", "b"]])


def test_several_ranks_from_one_exchange(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("pmod(id * 37, 1000) AS a")
    assert keys_at(df, ["a"], lambda n: [0, n // 2, n - 1, n, 500, -1]) == [(0,), (500,), (999,), None, (500,), None]
    assert keys_at(df.where("a < 0"), ["a"], lambda n: [int(n * 0.7), n]) == [None, None]


def test_global_running_sum(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(300), "v": rng.integers(0, 5, 300).astype(float)})
    df = spark.createDataFrame(pdf)
    out = global_running_sum(df, [F.desc("v"), F.asc("id")], "v").toPandas().sort_values("__rank")
    exp = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert out["id"].tolist() == exp["id"].tolist()
    np.testing.assert_allclose(out["__cum"].to_numpy(), exp["v"].cumsum().to_numpy())
    assert out["__rank"].tolist() == list(range(1, 301))


def test_rolling_equals_plain_window_under_skew(spark, partitions):
    from pyspark.sql.window import Window
    from shipcast.functions.grouped import grouped_rolling
    rng = np.random.default_rng(11)
    n = 2000
    key = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 40, n))   # key 1 holds ~60 % of rows
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(n), "v": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    got = grouped_rolling(df, ["k"], [F.col("t")], "v", 50,
                          {"n": F.count, "a": F.avg}).toPandas().sort_values("t")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-50, -1)
    ref = df.select("t", F.count("v").over(w).alias("n"), F.avg("v").over(w).alias("a")).toPandas().sort_values("t")
    assert got["n"].tolist() == ref["n"].tolist()
    np.testing.assert_allclose(got["a"].fillna(0).to_numpy(), ref["a"].fillna(0).to_numpy(), rtol=1e-9, atol=1e-12)


def test_quantiles_of_missing_values(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan")), (2, 5.0), (None, 7.0)], "g int, x double")
    got = {r["g"]: r["m"] for r in quantiles(df, "x", {"m": 0.5}, ["g"]).collect()}
    assert got == {1: None, 2: 5.0, None: 7.0}
    assert quantiles(df.where("g = 1"), "x", {"m": 0.5}).first()["m"] is None


@pytest.mark.parametrize("last_rows", [0, 10**6])
def test_radix_selection_equals_pandas(spark, monkeypatch, last_rows):
    """Both with all three passes and with the short cut to single values."""
    monkeypatch.setattr(Q, "LAST_ROWS", last_rows)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000), np.full(1500, -2.5), [0.0, -0.0, 5e-324]])
    pdf = pd.DataFrame({"g": rng.choice(["a", 'q"\\', "é"], len(x), p=[0.8, 0.1, 0.1]), "x": x, "y": np.round(rng.normal(size=len(x)), 1)})
    pdf.loc[::7, "y"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    probs = {"lo": 0.0, "a": 0.013, "m": 0.5, "b": 0.77, "hi": 1.0}
    got = quantiles(df, "x", probs, ["g"]).toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g").x.quantile(list(probs.values())).unstack()
    np.testing.assert_allclose(got[list(probs)].to_numpy(), exp.to_numpy(), rtol=1e-12)
    found = Q.column_quantiles(df.withColumn("none", F.lit(None)), ["y", "none", "x"], [0.25, 0.5])
    assert found["none"] == [None, None]
    for c in ("x", "y"):
        np.testing.assert_allclose(found[c], pdf[c].quantile([0.25, 0.5]), rtol=1e-12)
    assert Q.column_quantiles(df.limit(0), ["x"], [0.5]) == {"x": [None]}


def test_ordered_bits_keep_the_order():
    x = np.array([-np.inf, -1e300, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, np.inf])
    keys = Q.ordered_bits(x)
    assert (np.diff(keys) >= 0).all() and keys[4] == keys[5]
    assert [Q.from_ordered_bits(int(k)) for k in keys] == x.tolist()


def test_dealt_quantiles_of_many_groups_and_other_keys(spark, monkeypatch):
    """Beyond the bound of open buckets, and for keys that are not plain values."""
    pdf, df = _data(spark)
    exp = pdf.groupby("g").x.quantile(0.3).tolist()
    monkeypatch.setattr(Q, "OPEN_BUCKETS", 2)
    assert Q._selected(df.selectExpr("string(g) AS g", "x AS x0"), 1, [0.3]) is None
    assert [r["q"] for r in quantiles(df, "x", {"q": 0.3}, ["g"]).orderBy("g").collect()] == pytest.approx(exp)
    got = quantiles(df.selectExpr("double(g) AS g", "x"), "x", {"q": 0.3}, ["g"]).orderBy("g").collect()
    assert [r["q"] for r in got] == pytest.approx(exp)


def test_selection_moves_counts_only(spark):
    """No value is shuffled and nothing is checkpointed: the plan exchanges counted buckets."""
    df = spark.range(100).selectExpr("cast(id AS double) AS x", "id AS payload")
    plan = Q._counted(df.selectExpr("'' AS g", "x AS x0"), 1, 42, None)._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan and "partial_sum" in plan


def test_statistics_of_few_keys_are_broadcast_and_rows_stay(spark, monkeypatch):
    from shipcast.operators import split as sp

    rows = spark.createDataFrame([(i, f"k{i % 5}" if i % 7 else None) for i in range(200)] * 2, "i long, k string")
    stats = spark.createDataFrame([(f"k{i}", float(i)) for i in range(4)], "k string, v double")
    want = sorted(((r["i"], r["k"], r["v"]) for r in rows.join(stats, "k", "left").collect()), key=str)
    for most, hint in ((5, True), (3, False)):
        monkeypatch.setattr(sp, "MAX_BROADCAST_KEYS", most)
        out = sp.join_stats(rows, stats, "k")
        assert sorted(((r["i"], r["k"], r["v"]) for r in out.collect()), key=str) == want
        plan = out._jdf.queryExecution().analyzed().toString()
        assert ("strategy=broadcast" in plan or "ResolvedHint" in plan) == hint
