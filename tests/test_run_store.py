"""A stored run is loaded, not fitted again; other settings, inputs or half-written folders are not taken for it."""

import shutil

import pytest

from conftest import SMALL
from shipcast.operators import model as md
from shipcast.plans import q_model as Q


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "_RUNS", {})
    spark.conf.set("shipcast.run.store", str(tmp_path / "store"))
    yield tmp_path / "store"
    spark.conf.unset("shipcast.run.store")


def test_second_session_fits_nothing(spark, store, monkeypatch):
    first = Q.main_run(spark, SMALL)
    a = {r["order_id"]: r["prediction"] for r in first["best"].transform(first["test"]).collect()}
    Q._RUNS.clear()
    fail = lambda *a, **k: pytest.fail("fitted again")
    monkeypatch.setattr(md, "compare", fail)
    again = Q.main_run(spark, SMALL)
    b = {r["order_id"]: r["prediction"] for r in again["best"].transform(again["test"]).collect()}
    assert a == b and len(a) > 100
    assert again["comp"].best_name == first["comp"].best_name
    assert again["comp"].feature_names == first["comp"].feature_names
    assert again["test_metrics"] == pytest.approx(first["test_metrics"])
    rows = [sorted(map(str, c["comp"].results.collect())) for c in (first, again)]
    assert len(rows[0]) == len(rows[1]) == 7
    enc = again["comp"].encoded_train
    assert enc.count() == first["comp"].encoded_train.count() and "features" in enc.columns
    assert len(list(store.iterdir())) == 1


def test_path_follows_settings_and_input(spark, store, tmp_path):
    here = Q.store_path(spark, SMALL, "main", 5)
    assert here == Q.store_path(spark, SMALL + "/", "main", 5)
    assert here != Q.store_path(spark, SMALL, "main", 6) and here != Q.store_path(spark, SMALL, "notebook", 5)
    copy = str(tmp_path / "sf0.001")                                # a folder of the same name
    shutil.copytree(SMALL, copy)
    assert here != Q.store_path(spark, copy, "main", 5)


def test_only_whole_runs_count_and_the_first_wins(spark, tmp_path):
    path = str(tmp_path / "run")

    def write(text):
        return lambda p: spark.createDataFrame([(text,)], "a string").write.parquet(f"{p}/t")

    assert not md.committed(spark, path)
    with pytest.raises(ZeroDivisionError):
        md.commit_run(spark, path, lambda p: 1 / 0)
    assert not md.committed(spark, path)
    md.commit_run(spark, path, write("first"))
    md.commit_run(spark, path, write("second"))
    assert md.committed(spark, path)
    assert [r["a"] for r in spark.read.parquet(f"{path}/t").collect()] == ["first"]
    assert [p.name for p in tmp_path.iterdir() if p.is_dir()] == ["run"]
