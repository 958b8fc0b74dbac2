from corpreg.plans.pipeline import run_pipeline
from corpreg.session import scratch_path
from corpreg.sources import fixtures


def test_end_to_end(spark, sf_small, tmp_path):
    s1 = fixtures.with_names(fixtures.supply_chain(spark, sf_small))
    s2 = fixtures.with_names(fixtures.financial(spark, sf_small))
    root = scratch_path(spark, "pipeline")
    res = run_pipeline(
        spark, s1, s2, fixtures.headline_feed(spark), root,
        model_path=str(tmp_path / "model"), runs_path=str(tmp_path / "runs"), health_path=str(tmp_path / "health"),
    )
    assert res.snapshot_id == 1
    # the batch is registered as a temp view for SQL users
    assert spark.table("incoming_batch_records").count() == 364
    assert res.match_rate["golden_rows"] == 364
    assert float(res.match_rate["match_rate_pct"]) == 105.81
    assert res.drift["drift_triggered"] is True
    assert res.reconciliation["meets_target"] is True
    assert res.training["status"] == "ok"
    assert res.health["pipeline_health_status"] == "CRITICAL"
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 1
    import json

    health = spark.read.json(str(tmp_path / "health")).collect()
    assert len(health) == 1 and health[0]["pipeline_health_status"] == "CRITICAL"
    tel = json.loads(health[0]["telemetry"])
    assert tel["source_1_supply_chain_row_count"] == 344 and tel["fuzzy_match_rate_pct"] == 105.81
    assert tel["model_version"].startswith("v_run_")
    # second run of the same batch: ids unchanged, a new snapshot
    res2 = run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), root, train=False)
    assert res2.snapshot_id == 2 and res2.reconciliation["registry_distinct_ids"] == 364


def test_health_record_rounds_exact_rate_once(spark):
    import json

    from corpreg.plans.health import health_record

    counts = spark.createDataFrame([("supply_chain", 10), ("financial", 100000)], "source string, row_count bigint")
    rate = spark.createDataFrame([(21094, 100000)], "golden_rows bigint, s2_rows bigint")  # 21.094 %
    rec = health_record(counts, rate, {"version": "v_run_x", "accuracy": 0.91234, "baseline": 0.85}).first()
    tel = json.loads(rec["telemetry"])
    assert tel["fuzzy_match_rate_pct"] == 21.09 and tel["entity_drift_triggered"] is True
    assert tel["model_accuracy_auc"] == 0.9123 and rec["pipeline_health_status"] == "CRITICAL"
    assert rec["timestamp"].endswith("Z")


def test_scratch_scope_deletes_intermediates(spark, sf_small):
    import os

    from corpreg.operators.golden import golden_records
    from corpreg.session import scratch_scope

    with scratch_scope(spark) as paths:
        n = golden_records(fixtures.supply_chain(spark, sf_small), fixtures.financial(spark, sf_small)).count()
        local = [p.replace("file:", "") for p in paths]
        assert n == 364 and len(local) == 4 and all(os.path.exists(p) for p in local)
    assert not any(os.path.exists(p) for p in local)


def test_params_from_config(tmp_path):
    import json

    from corpreg.params import Params, params_from_config

    cfg = {
        "entity_resolution": {"levenshtein_threshold": 1},
        "drift_monitoring": {"historical_average_pct": 60.0, "threshold_deviation_pct": 10.0},
        "data_quality": {"min_avg_revenue": 5000},
        "ml_training": {"lr_max_iterations": 20, "random_split_ratio": [0.7, 0.3], "profit_threshold": 1.0},
    }
    path = tmp_path / "t.json"
    path.write_text(json.dumps(cfg))
    p = params_from_config(str(path))
    assert (p.max_edits, p.historical_match_rate_pct, p.match_rate_deviation_pct) == (1, 60.0, 10.0)
    assert (p.min_avg_revenue, p.lr_max_iter, p.train_fraction, p.profit_threshold) == (5000, 20, 0.7, 1.0)
    assert p.suffix_regex == Params().suffix_regex


def test_cli_runs_from_landing_folder(spark, sf_small, tmp_path):
    import json

    from corpreg.__main__ import main
    from corpreg.session import scratch_path

    root = str(tmp_path / "landing")
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fixtures.with_names(fixtures.supply_chain(spark, sf_small)).write.options(**options).csv(f"{root}/a")
    fixtures.with_names(fixtures.financial(spark, sf_small)).write.options(**options).csv(f"{root}/b")
    feed = tmp_path / "feed.txt"
    feed.write_text("Red tape fines suspected\nBlue chip shares rise\n\nData breach at cold store\n")
    assert main(["--landing", root, "--registry", scratch_path(spark, "cli"), "--feed", str(feed), "--no-train"]) == 0
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "x.csv").write_text("corporate_name_S1,address,activity_places,top_suppliers\nA,,,\n")
    assert main(["--landing", str(empty), "--registry", scratch_path(spark, "cli"), "--feed", str(feed)]) == 1


def test_scratch_scopes_are_per_thread(spark):
    import threading

    from corpreg.session import materialize, scratch_scope

    seen = {}

    def other():
        df = materialize(spark.range(5), "other")
        seen["n"] = df.count()

    with scratch_scope(spark) as paths:
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert paths == []  # the other thread's table is not in this scope
    assert seen["n"] == 5


def test_cluster_conf_is_accepted(spark):
    from corpreg.session import CLUSTER_CONF

    for k, v in CLUSTER_CONF.items():
        spark.conf.get(k)  # known keys
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_pipeline_with_merge_into_table(spark, sf_small, monkeypatch):
    """The run makes the table, upserts the batch into it and goes on from it. The
    statement itself needs a format that this session lacks; here it appends."""
    import corpreg.plans.pipeline as pipeline

    calls = []

    def ensure(spark, table, using):
        calls.append(using)
        ensure_registry_table(spark, table, "parquet")

    def upsert(spark, table, batch):
        calls.append(table)
        spark.table(table).limit(0).unionByName(batch).write.mode("append").insertInto(table)

    from corpreg.sources.registry import ensure_registry_table

    monkeypatch.setattr(pipeline, "ensure_registry_table", ensure)
    monkeypatch.setattr(pipeline, "merge_into_table", upsert)
    s1 = fixtures.with_names(fixtures.supply_chain(spark, sf_small))
    s2 = fixtures.with_names(fixtures.financial(spark, sf_small))
    spark.sql("DROP TABLE IF EXISTS companies_of_test")
    res = run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), None, train=False, table="companies_of_test")
    assert calls == ["delta", "companies_of_test"] and res.snapshot_id is None and res.reconciliation["meets_target"] is True
    spark.sql("DROP TABLE companies_of_test")


def test_pipeline_with_bucketed_table_and_metrics_history(spark, sf_small, tmp_path):
    s1 = fixtures.with_names(fixtures.supply_chain(spark, sf_small))
    s2 = fixtures.with_names(fixtures.financial(spark, sf_small))
    options = dict(train=False, table="corpreg_run_db.companies", table_format="parquet", metrics_path=str(tmp_path / "metrics"))
    spark.sql(f"CREATE DATABASE corpreg_run_db LOCATION '{tmp_path}/db'")
    first = run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), None, **options)
    again = run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), None, **options)
    assert first.reconciliation["registry_distinct_ids"] == again.reconciliation["registry_distinct_ids"] == 364
    # against the configured rate the first run drifts; the second is like the one before it
    assert first.drift_history["drift_triggered"] and first.drift_history["runs_before"] == 0
    assert not again.drift_history["drift_triggered"] and again.drift_history["runs_before"] == 1
    assert again.drift["drift_triggered"]
    spark.sql("DROP DATABASE corpreg_run_db CASCADE")


def test_pipeline_scans_each_source_once(spark, sf_small):
    """Rows that leave the sources are counted as they pass."""
    import pandas as pd
    from pyspark.sql import functions as F

    seen = {}

    def counted(df, column):
        total = seen[column] = spark.sparkContext.accumulator(0)

        @F.pandas_udf("string")
        def passing(values: pd.Series) -> pd.Series:
            total.add(len(values))
            return values

        return df.withColumn(column, passing.asNondeterministic()(column))

    s1 = fixtures.with_names(fixtures.supply_chain(spark, sf_small))
    s2 = fixtures.with_names(fixtures.financial(spark, sf_small))
    n = s1.count(), s2.count()
    root = scratch_path(spark, "once")
    run_pipeline(spark, counted(s1, "corporate_name_S1"), counted(s2, "corporate_name_S2"), fixtures.headline_feed(spark), root, train=False)
    assert (seen["corporate_name_S1"].value, seen["corporate_name_S2"].value) == n


def test_failing_contract_stops_before_the_registry(spark, sf_small):
    import pytest

    from corpreg.operators.quality import CircuitBreakerError
    from corpreg.sources.registry import SnapshotRegistry

    root = scratch_path(spark, "stopped")
    s1, s2 = fixtures.supply_chain(spark, sf_small), fixtures.financial(spark, sf_small)  # with null names
    with pytest.raises(CircuitBreakerError, match="null_or_blank_name"):
        run_pipeline(spark, s1, s2, fixtures.headline_feed(spark), root, train=False)
    assert SnapshotRegistry(spark, root).snapshots().count() == 0


def test_health_records_under_their_contract(spark, tmp_path):
    import json

    from corpreg.plans.health import health_records

    tel = {"source_1_supply_chain_row_count": 1, "source_2_financial_row_count": 2, "fuzzy_match_rate_pct": 50.0, "entity_drift_triggered": False}
    line = lambda status="HEALTHY", at="2024-05-01T10:00:00.000001Z", **t: json.dumps({"timestamp": at, "pipeline_health_status": status, "telemetry": json.dumps({**tel, **t})})
    lines = {
        "fine": line(model_version="v1", model_accuracy_auc=0.9),
        "status": line(status="FINE"),
        "type": line(source_1_supply_chain_row_count="many"),
        "missing": line(fuzzy_match_rate_pct=None),
        "no json": "{not json",
        "telemetry": json.dumps({"timestamp": "2024-05-01T10:00:00.000001Z", "pipeline_health_status": "HEALTHY", "telemetry": "[1"}),
        "format": line(at="2024-05-01 10:00:00"),
        "no such day": line(at="2024-02-31T10:00:00.000001Z"),
        "early": line(at="2024-04-30T23:59:59.999999Z"),
        "late": line(at="2024-05-02T00:00:00.000001Z"),
    }
    got = {}
    for name, text in lines.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text(text + "\n")
        got[name] = health_records(spark, str(tmp_path / name), "2024-05-01T00:00:00", "2024-05-02T00:00:00").first()
    assert {n for n, r in got.items() if not r["record_ok"]} == {"status", "type", "missing", "no json", "telemetry"}
    assert {n for n, r in got.items() if not r["time_ok"]} == {"no json", "format", "no such day", "early", "late"}
    assert got["fine"]["model_accuracy_auc"] == 0.9 and got["type"]["source_2_financial_row_count"] == 2
