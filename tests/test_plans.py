"""Physical-plan checks: JVM-only pricing, broadcast dimensions, pruned scans."""

from conftest import SF001
import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pricing_plans_have_no_python(spark):
    q = E.queries()
    for name in ("surge_by_zone_day", "hybrid_price", "feature_vector", "expected_demand_supply",
                 "weather_asof", "event_interval_join", "dashboard_table"):
        p = _plan(q[name](spark, SF001))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_zone_dimension_is_broadcast(spark):
    p = _plan(E.queries()["surge_by_zone_day"](spark, SF001))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_scan_is_pruned(spark):
    df = E.queries()["surge_by_zone_day"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    # value and event_type are not needed by the flagship
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in p


BATCH = [n for n in E.queries() if not n.startswith(("stream_", "gbt_")) and n != "feature_zscore"]


def test_every_batch_plan_is_equi_join_and_jvm_only(spark):
    """Every batch query joins on an equality (no nested-loop or cartesian
    join) and runs without Python evaluation."""
    for name in BATCH:
        p = _plan(E.queries()[name](spark, SF001))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_latest_uses_aggregate_not_sort(spark):
    p = _plan(E.queries()["latest_surge_per_zone"](spark, SF001))
    assert "max_by" in p
