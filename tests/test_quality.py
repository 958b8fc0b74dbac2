import pytest

from corpreg.operators import quality
from corpreg.params import Params

S1 = "corporate_name_S1 string, address string, activity_places string, top_suppliers string"
S2 = "corporate_name_S2 string, main_customers string, revenue double, profit double"


def _verdicts(spark, s1_rows, s2_rows, s2_schema=S2):
    s1 = spark.createDataFrame(s1_rows, S1)
    s2 = spark.createDataFrame(s2_rows, s2_schema)
    return {(r["source"], r["rule"]): r["passed"] for r in quality.dq_verdicts(s1, s2).collect()}


def test_blank_name_fails_whitespace_passes(spark):
    v = _verdicts(spark, [("   ", None, None, None)], [("", None, 20000.0, 1.0)])
    assert v[("supply_chain", "null_or_blank_name")] is True
    assert v[("financial", "null_or_blank_name")] is False


def test_average_revenue_threshold(spark):
    low = _verdicts(spark, [("a", None, None, None)], [("b", None, 9999.99, 1.0)])
    ok = _verdicts(spark, [("a", None, None, None)], [("b", None, 10000.0, 1.0)])
    none = _verdicts(spark, [("a", None, None, None)], [("b", None, None, 1.0)])
    assert low[("financial", "min_avg_revenue")] is False
    assert ok[("financial", "min_avg_revenue")] is True
    assert none[("financial", "min_avg_revenue")] is True


def test_rule_two_needs_revenue_column(spark):
    v = _verdicts(spark, [("a", None, None, None)], [("b", None)], "corporate_name_S2 string, main_customers string")
    assert ("financial", "min_avg_revenue") not in v


def test_require_contracts_raises(spark):
    s1 = spark.createDataFrame([(None, None, None, None)], S1)
    s2 = spark.createDataFrame([("b", None, 5.0, 1.0)], S2)
    with pytest.raises(quality.CircuitBreakerError, match="null_or_blank_name"):
        quality.require_contracts(quality.dq_verdicts(s1, s2))


@pytest.mark.parametrize("golden_rows,drift", [(50, False), (80, False), (49, True), (81, True)])
def test_drift_band_is_inclusive(spark, golden_rows, drift):
    g = spark.range(golden_rows).withColumnRenamed("id", "corporate_id")
    s2 = spark.range(100)
    row = quality.drift_check(quality.match_rate(g, s2), Params()).first()
    assert row["drift_triggered"] is drift
    assert row["pipeline_health_status"] == ("CRITICAL" if drift else "HEALTHY")


def test_match_rate_empty_source(spark):
    g = spark.range(3).withColumnRenamed("id", "corporate_id")
    assert float(quality.match_rate(g, spark.range(0)).first()["match_rate_pct"]) == 0.0


def test_reconcile_delivery(spark):
    reg = spark.createDataFrame([("a",), ("b",), ("c",)], "corporate_id string")
    batch = spark.createDataFrame([("a",), ("b",), ("z",)], "corporate_id string")
    r = quality.reconcile_delivery(reg, batch).first()
    assert r["registry_distinct_ids"] == 3 and r["batch_rows"] == 3
    assert float(r["delivery_index_pct"]) == 100.0 and r["meets_target"] is True
    assert float(r["batch_coverage_pct"]) == pytest.approx(66.67)
    empty = quality.reconcile_delivery(reg, batch.limit(0)).first()
    assert empty["delivery_index_pct"] is None


def test_drift_uses_unrounded_rate(spark):
    # 999999 / 2000000 = 49.99995 %: displayed as 50.000 but below the band
    g = spark.range(999999).withColumnRenamed("id", "corporate_id")
    row = quality.drift_check(quality.match_rate(g, spark.range(2000000)), Params()).first()
    assert float(row["match_rate_pct"]) == 50.0
    assert row["drift_triggered"] is True


def test_delivery_target_uses_unrounded_index(spark):
    reg = spark.range(99899).selectExpr("cast(id as string) AS corporate_id")
    batch = spark.range(100000).selectExpr("cast(id as string) AS corporate_id")
    r = quality.reconcile_delivery(reg, batch).first()
    assert float(r["delivery_index_pct"]) == 99.9 and r["meets_target"] is False
    reg2 = spark.range(99900).selectExpr("cast(id as string) AS corporate_id")
    assert quality.reconcile_delivery(reg2, batch).first()["meets_target"] is True


def test_check_contracts_per_source(spark):
    s1 = spark.createDataFrame([("a", None, None, None)], S1)
    s2 = spark.createDataFrame([("b", None, 5.0, 1.0)], S2)
    v1 = {r["rule"]: r["passed"] for r in quality.check_contracts(s1, "s1", "corporate_name_S1").collect()}
    v2 = {r["rule"]: r["passed"] for r in quality.check_contracts(s2, "s2", "corporate_name_S2").collect()}
    assert v1 == {"null_or_blank_name": True}
    assert v2 == {"null_or_blank_name": True, "min_avg_revenue": False}


def test_require_source_contracts(spark):
    ok = spark.createDataFrame([("a", None, 20000.0, 1.0)], S2)
    quality.require_source_contracts(ok, "financial", "corporate_name_S2")
    low = spark.createDataFrame([("a", None, 5.0, 1.0)], S2)
    with pytest.raises(quality.CircuitBreakerError, match="min_avg_revenue"):
        quality.require_source_contracts(low, "financial", "corporate_name_S2")


def test_drift_history_edges(spark):
    """First run, a run without rows, bands by the configured deviation and by the spread."""
    import statistics
    from datetime import datetime, timedelta

    from corpreg.operators.quality import drift_history
    from corpreg.params import Params

    rates = [65, 85, 60, None, 62, 61, 30, 64, 63, 62, 61, 60, 90, 62]
    start = datetime(2024, 1, 1)
    rows = [("p", f"r{i:02d}", start + timedelta(days=i if i < 8 else i + 30), None if r is None else r * 10, 0 if r is None else 1000) for i, r in enumerate(rates)]
    rows += [("other", "r0", start, 81, 100), ("other", "r1", start, None, 100)]
    frame = spark.createDataFrame(rows, "pipeline string, run_id string, finished_at timestamp, golden_rows bigint, s2_rows bigint").repartition(3)
    p = Params(history_runs=4, history_deviations=2.0)
    got = {(r["pipeline"], r["run_id"]): r for r in drift_history(frame, p).collect()}
    for i, r in enumerate(rates):
        before = [x for x in rates[max(0, i - 4) : i] if x is not None]
        base = statistics.fmean(before) if before else 65.0
        width = max(15.0, 2 * statistics.pstdev(before) if before else 0.0)
        own = got["p", f"r{i:02d}"]
        assert own["runs_before"] == len(before) and own["match_rate_pct"] == (None if r is None else float(r))
        assert abs(own["baseline_pct"] - base) < 1e-6 and abs(own["deviation_pct"] - width) < 1e-5
        assert own["drift_triggered"] == (r is not None and abs(r - base) > width)
    assert got["other", "r0"]["drift_triggered"] and got["other", "r0"]["baseline_pct"] == 65.0
    assert got["other", "r1"]["match_rate_pct"] == 0.0 and got["other", "r1"]["baseline_pct"] == 81.0
    assert drift_history(frame.where("false"), p).collect() == []


def test_contracts_of_the_name_groups_equal_their_own_scan(spark, sf_small):
    from corpreg.operators import golden, quality
    from corpreg.params import S1_NAME, S2_NAME, Params
    from corpreg.sources import fixtures

    for source, name, rank, tag in (
        (fixtures.supply_chain(spark, sf_small), S1_NAME, golden.S1_RANK, quality.SOURCE_1),
        (fixtures.financial(spark, sf_small), S2_NAME, golden.S2_RANK, quality.SOURCE_2),
        (fixtures.financial(spark, sf_small).where("false"), S2_NAME, golden.S2_RANK, quality.SOURCE_2),
    ):
        best, metrics = golden.checked_best_per_name(source, tag, name, rank, Params())
        want = quality.contract_metrics(source, tag, name, validate_columns=True)
        a, b = quality.verdicts(metrics).collect(), quality.verdicts(want).collect()
        assert a == b
        assert metrics.select("row_count", "non_null_cells").first() == want.select("row_count", "non_null_cells").first()
        plain = golden.best_per_name(source, name, rank, Params())
        assert sorted(best.collect(), key=repr) == sorted(plain.collect(), key=repr)
