"""Spark ML pipeline: metric band, importances, save/load, row-count guard."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from zonefare.model import training as M
from zonefare.plans import serving as S


@pytest.fixture(scope="module")
def frame(spark):
    h = S.surge_history(spark, SF001, "hour")
    f = S.feature_rows(h, S.historical_baseline(h))
    return M.to_training_frame(f, S.label_column())


def test_train_evaluate_save_load(spark, frame, tmp_path):
    t = M.train(frame, max_iter=5, min_rows=100)
    m = M.metrics(t.model, t.test).first()
    assert m.test_rows > 0 and m.mae < 0.1 and m.r2 > 0.8
    imp = M.importances(spark, t.model, 21).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    path = str(tmp_path / "model")
    M.save(t.model, path)
    again = M.load(path)
    a = t.model.transform(t.test).select("zone_id", "timestamp", "prediction")
    b = again.transform(t.test).select("zone_id", "timestamp", "prediction")
    assert a.exceptAll(b).count() == 0


def test_split_is_deterministic(frame):
    tr1, _ = M.split(frame)
    tr2, te2 = M.split(frame.repartition(7))
    assert tr1.count() == tr2.count() and tr1.count() + te2.count() == frame.count()


def test_minimum_rows_guard(frame):
    with pytest.raises(ValueError):
        M.train(frame.limit(10), max_iter=2)


def test_fallback_without_a_model(spark, frame, tmp_path):
    h = S.surge_history(spark, SF001, "hour")
    feats = S.feature_rows(h, S.historical_baseline(h))
    assert M.load_or_none(spark, str(tmp_path / "none")) is None
    none = M.predict_or_fallback(None, feats)
    assert {tuple(r) for r in none.select("ml_prediction", "ml_confidence", "ml_available").distinct().collect()} == {(1.0, 0.0, False)}
    t = M.train(frame, max_iter=2, min_rows=100)
    M.save(t.model, str(tmp_path / "m"))
    got = M.predict_or_fallback(M.load_or_none(spark, str(tmp_path / "m")), feats)
    r = got.agg({"ml_prediction": "min", "ml_confidence": "min"}).first()
    assert got.count() == feats.count() and r[0] is not None and got.filter("NOT ml_available").count() == 0


def test_registered_queries_train_with_the_configs_defaults(spark, monkeypatch):
    from conftest import SF01
    from zonefare.config import DEFAULT
    from zonefare.plans import queries as Q
    trees, pipeline = [], M.build_pipeline

    def build(cfg=DEFAULT, max_iter=None):
        p = pipeline(cfg, max_iter)
        trees.append(p.getStages()[-1].getMaxIter())
        return pipeline(cfg, 1)

    monkeypatch.setattr(M, "build_pipeline", build)
    monkeypatch.setattr(Q, "_MODELS", {})
    with pytest.raises(ValueError, match="training rows"):  # the guard is on
        Q._trained(spark, SF001)
    assert Q._trained(spark, SF01)[0].train_rows >= DEFAULT.training_min_samples
    assert trees == [DEFAULT.gbt_max_iter] == [200]


def test_compiled_ensemble_equals_the_pipeline(spark, frame):
    """Every row's prediction, with missing and NaN features among them; the shipped ensemble has the same form."""
    from zonefare.model import compile as C
    t = M.train(frame, max_iter=12, min_rows=100)
    e = C.from_pipeline(t.model)
    assert len(e.trees) == len(e.weights) == 12 and C.Ensemble.from_json(e.to_json()) == e
    holes = frame.withColumn("temperature", F.when(F.col("hour_of_day") % 3 == 0, F.lit(None)).when(F.col("hour_of_day") % 3 == 1, F.lit(float("nan")))
                             .otherwise(F.col("temperature"))) \
        .withColumn("supply_ratio", F.when(F.col("hour_of_day") % 4 > 0, F.col("supply_ratio")))
    want = t.model.transform(holes).select("zone_id", "timestamp", F.col("prediction").alias("want"))
    got = C.with_prediction(holes, e).join(want, ["zone_id", "timestamp"])
    assert got.count() == frame.count() and got.filter(F.abs(F.col("prediction") - F.col("want")) > 1e-9).count() == 0
    plan = C.with_prediction(holes, e)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and C.with_prediction(holes, e).columns == [*holes.columns, "prediction"]
    assert C.default_ensemble().features == e.features


def test_live_prices_gate_and_fallback(spark, frame):
    from zonefare.config import DEFAULT
    from zonefare.model import compile as C
    h = S.surge_history(spark, SF001, "hour")
    f = S.feature_rows(h, S.historical_baseline(h))
    none = S.live_prices(f, None).collect()
    assert all(not r.ml_available and r.ml_confidence == 0.0 and r.ml_multiplier == 1.0 and r.final_multiplier == r.rule_multiplier for r in none)
    high = C.Ensemble(C.default_ensemble().features, (0.0,) * 21, (0.0,) * 21, (1.0,) * 21, (1.0,), (2.0,))
    for r in S.live_prices(f, high).collect():  # a model that always says 2.0
        assert r.ml_available and r.ml_multiplier == 2.0
        raised = r.ml_confidence >= DEFAULT.confidence_threshold
        assert r.final_multiplier == (max(2.0, r.rule_multiplier) if raised else r.rule_multiplier)
    newest = h.agg({"timestamp": "max"}).first()[0]
    assert S.price_all(h, "2031-01-01 00:00:00", high).count() == 0  # everything has expired
    alive = S.price_all(h, f"{newest + timedelta(seconds=3600 + 119)}", high)
    assert alive.count() == h.filter(F.col("timestamp") == newest).select("zone_id").distinct().count() > 0
    assert S.price_all(h, f"{newest + timedelta(seconds=3600 + 120)}", high).count() == 0
