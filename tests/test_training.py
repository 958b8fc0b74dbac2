import pytest

from corpreg.operators import training
from corpreg.params import Params
from corpreg.plans.catalog import QUERIES

SCHEMA = "corporate_id string, top_suppliers string, revenue double, profit double"


def test_features_edges(spark):
    rows = [
        ("1a", None, None, 100000.0),
        ("2b", "  ", 5.0, 100000.01),
        ("3c", "a,b,", float("nan"), None),
        ("4d", "a;b", 1.0, 1.0),
    ]
    f = {r["corporate_id"]: r for r in training.profit_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [f[k]["high_profit_indicator"] for k in ("1a", "2b", "3c", "4d")] == [0, 1, 0, 0]
    assert [f[k]["supplier_count"] for k in ("1a", "2b", "3c", "4d")] == [0, 0, 3, 1]
    assert f["1a"]["revenue"] == 0.0 and f["3c"]["revenue"] == 0.0
    assert f["3c"]["profit"] is None


def test_split_is_deterministic(spark):
    df = spark.range(2000).selectExpr("md5(cast(id as string)) AS corporate_id")
    a = {r[0]: r[1] for r in training.with_split(df).collect()}
    b = {r[0]: r[1] for r in training.with_split(df.repartition(13)).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.75 < share < 0.85


def test_rank_auc_equals_evaluator(spark):
    df = QUERIES["profit_auc"](spark, "/root/testdata/sf0.01").first()
    assert df["auc_rank"] == pytest.approx(df["area_under_roc"], abs=1e-9)


def test_rank_auc_with_ties(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.2, 1), (0.2, 0), (0.9, 1)]
    df = spark.createDataFrame(rows, "score double, label int").repartition(3)
    got = training.rank_sum_auc(df, "label").first()["auc_rank"]
    pos = [s for s, l in rows if l == 1]
    neg = [s for s, l in rows if l == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)


def test_one_class_labels_are_reported(spark):
    rows = [(f"{i:04x}", None, float(i), 1.0) for i in range(50)]
    res = training.run_training(spark.createDataFrame(rows, SCHEMA))
    assert res["status"] == "degenerate_labels" and res["accuracy"] is None


def test_empty_registry(spark):
    res = training.run_training(spark.createDataFrame([], SCHEMA))
    assert res["version"] == "N/A" and res["accuracy"] == 0.0 and res["baseline"] == 0.85


def test_model_save_and_load(spark, tmp_path):
    feats = training.profit_features(QUERIES["risk_screen"](spark, "/root/testdata/sf0.01"))
    train, test = training.train_test_split(feats)
    model = training.fit_profit_model(train)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = training.load_profit_model(path)
    a = sorted(r[0] for r in model.transform(test).select("prediction").collect())
    b = sorted(r[0] for r in again.transform(test).select("prediction").collect())
    assert a == b


def test_split_meets_any_fraction(spark):
    import dataclasses

    ids = spark.range(20_000).selectExpr("md5(cast(id as string)) AS corporate_id")
    for fraction in (0.0, 0.75, 0.8, 0.85, 0.95, 0.96, 1.0):
        train, test = training.train_test_split(ids, dataclasses.replace(Params(), train_fraction=fraction))
        assert abs(train.count() / 20_000 - fraction) < 0.01 and train.count() + test.count() == 20_000


def _companies(spark, n, label, seed=4):
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        revenue, k = rng.uniform(0, 3e6), rng.randint(0, 6)
        rows.append((f"{i:04x}", ",".join("s" * k) or None, revenue, 200_000.0 if label(revenue, k, rng) else 1.0))
    return spark.createDataFrame(rows, SCHEMA)


def test_both_fits_agree_at_convergence(spark):
    import dataclasses
    import math

    label = lambda revenue, k, rng: rng.random() < 1 / (1 + math.exp(-(revenue / 1e6 - 1.5 + 0.3 * k)))
    feats = training.profit_features(_companies(spark, 2000, label))
    irls = dataclasses.replace(Params(), fit="irls")
    a = training.model_summary(training.fit_profit_model(feats, irls), 0)
    b = training.model_summary(training.fit_profit_model(feats, dataclasses.replace(Params(), lr_max_iter=500)), 0)
    assert a["intercept"] == pytest.approx(b["intercept"], abs=2e-4)
    assert a["coefficients"] == [pytest.approx(x, rel=2e-4) for x in b["coefficients"]]
    one, two = (training.score(training.fit_profit_model(feats, p), feats, p).select("corporate_id", "probability_1", "prediction", "score") for p in (irls, dataclasses.replace(Params(), lr_max_iter=500)))
    one, two = ({r[0]: r[1:] for r in x.collect()} for x in (one, two))
    assert all(one[i][0] == pytest.approx(two[i][0], abs=1e-4) and one[i][1] == two[i][1] for i in one)
    with pytest.raises(ValueError):
        training.fit_profit_model(feats, dataclasses.replace(Params(), fit="guess"))


@pytest.mark.parametrize("fit", ["irls", "logistic"])
def test_separable_labels_are_reported(spark, fit):
    import dataclasses

    got = training.run_training(_companies(spark, 400, lambda revenue, k, rng: revenue > 1e6), dataclasses.replace(Params(), fit=fit, lr_max_iter=100))
    assert got["status"] == "separable_labels" and got["accuracy"] == pytest.approx(1.0)


def test_saved_models_are_found_by_version_and_time(spark, tmp_path):
    import dataclasses
    from datetime import datetime, timedelta

    p = dataclasses.replace(Params(), fit="irls")
    noisy = lambda revenue, k, rng: rng.random() < revenue / 3e6
    runs, results, frames = str(tmp_path / "runs"), [], []
    for n in range(2):
        frames.append(_companies(spark, 300, noisy, seed=n))
        results.append(training.run_training(frames[n], p, model_path=str(tmp_path / f"m{n}"), runs_path=runs))
    unsaved = training.run_training(frames[0], p, runs_path=runs)
    table = spark.read.schema(training.RUNS).parquet(runs)
    assert table.count() == 3 and training.model_run(table)["model_version"] == results[1]["version"]
    times = {r["model_version"]: r["finished_at"] for r in table.collect()}
    at = times[results[1]["version"]] - timedelta(microseconds=1)
    assert training.model_run(table, at=at)["model_version"] == results[0]["version"]
    assert training.model_run(table, version=results[0]["version"])["model_path"].endswith("m0")
    for wanted in ({"version": "v_none"}, {"version": unsaved["version"]}, {"at": datetime(2000, 1, 1)}):
        with pytest.raises(training.MissingModelError):
            training.model_run(table, **wanted)
    with pytest.raises(training.MissingModelError):
        training.score_saved(training.profit_features(frames[0], p), table.where("false"), p)
    feats = training.profit_features(frames[0], p)
    again = training.score_saved(feats, table, p, version=results[0]["version"])
    train, _ = training.train_test_split(feats, p)
    fresh = training.score(training.fit_profit_model(train, p), feats, p)
    a, b = ({r[0]: r[1] for r in x.select("corporate_id", "probability_1").collect()} for x in (again, fresh))
    assert a == {i: pytest.approx(v, abs=1e-12) for i, v in b.items()}
    assert {r[0] for r in again.select("model_version").distinct().collect()} == {results[0]["version"]}
