"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator. Each reads the shared test tables in full (through the source
views of :mod:`corpreg.sources.fixtures`)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpreg.functions.names import corporate_id, normalized_name
from corpreg.operators import fuzzy, golden, quality, risk, training
from corpreg.params import REGISTRY_COLUMNS, S1_NAME, S2_NAME, Params
from corpreg.plans.health import health_export, health_record, health_records
from corpreg.session import delete_paths, delete_when_unused, materialize, scratch_path
from corpreg.sources import csv_sources, fixtures
from corpreg.sources.registry import CatalogRegistry, SnapshotRegistry, merge_frames

P = Params()
BATCH_VIEW = "incoming_batch_records"
# fitted by a method that anyone can repeat
IRLS = replace(P, fit="irls")
REGISTRY_ORDER = REGISTRY_COLUMNS


def _s1(spark, d):
    return fixtures.supply_chain(spark, d)


def _s2(spark, d):
    return fixtures.financial(spark, d)


def _names(spark, d, fn, out: str) -> DataFrame:
    a = _s1(spark, d).where(F.col(S1_NAME).isNotNull()).select(
        F.lit("supply_chain").alias("source"), F.col(S1_NAME).alias("raw_name"), fn(S1_NAME).alias(out)
    )
    b = _s2(spark, d).where(F.col(S2_NAME).isNotNull()).select(
        F.lit("financial").alias("source"), F.col(S2_NAME).alias("raw_name"), fn(S2_NAME).alias(out)
    )
    return a.unionByName(b)


def q_name_not_null(spark, d):
    a = _s1(spark, d).where(F.col(S1_NAME).isNotNull()).select(
        F.lit("supply_chain").alias("source"), F.col(S1_NAME).alias("corporate_name")
    )
    b = _s2(spark, d).where(F.col(S2_NAME).isNotNull()).select(
        F.lit("financial").alias("source"), F.col(S2_NAME).alias("corporate_name")
    )
    return a.unionByName(b)


def q_normalize_names(spark, d):
    return _names(spark, d, lambda c: normalized_name(c, P.suffix_regex), "norm_name")


def q_corporate_id(spark, d):
    return _names(spark, d, lambda c: corporate_id(c, P.suffix_regex), "corporate_id")


def q_distinct_corporate_ids(spark, d):
    return q_corporate_id(spark, d).select("corporate_id").distinct()


def q_fuzzy_pairs(spark, d):
    return fuzzy.fuzzy_pairs(_s1(spark, d), _s2(spark, d), P)


def q_unmatched_s1(spark, d):
    s1, s2 = _s1(spark, d), _s2(spark, d)
    return fuzzy.unmatched_s1(s1, fuzzy.fuzzy_pairs(s1, s2, P), P).drop("norm_1", "norm_2")


def q_unmatched_s2(spark, d):
    s1, s2 = _s1(spark, d), _s2(spark, d)
    return fuzzy.unmatched_s2(s2, fuzzy.fuzzy_pairs(s1, s2, P), P)


def q_fuzzy_full_outer(spark, d):
    return fuzzy.fuzzy_full_outer(_s1(spark, d), _s2(spark, d), params=P)


def q_canonical_name(spark, d):
    """Distinct (canonical name, id) of the full outer join: every Source-1
    name, plus the Source-2 names that match nothing."""
    s1, s2 = _s1(spark, d), _s2(spark, d)
    pairs = fuzzy.fuzzy_pairs(s1, s2, P)
    a = s1.where(F.col(S1_NAME).isNotNull()).select(F.col(S1_NAME).alias("canonical_corporate_name"))
    b = fuzzy.unmatched_s2(s2, pairs, P).select(F.col(S2_NAME).alias("canonical_corporate_name"))
    return (
        a.unionByName(b)
        .distinct()
        .withColumn("corporate_id", corporate_id("canonical_corporate_name", P.suffix_regex))
    )


def _golden(spark, d):
    return golden.golden_records(_s1(spark, d), _s2(spark, d), P)


def q_golden_records(spark, d):
    return _golden(spark, d)


def q_golden_count(spark, d):
    return _golden(spark, d).agg(F.count(F.lit(1)).alias("golden_rows"))


def q_source_counts(spark, d):
    return quality.source_counts(_s1(spark, d), _s2(spark, d))


def q_dq_null_names(spark, d):
    return quality.dq_null_names(_s1(spark, d), _s2(spark, d))


def q_dq_avg_revenue(spark, d):
    return quality.dq_avg_revenue(_s2(spark, d))


def q_dq_verdicts(spark, d):
    return quality.dq_verdicts(_s1(spark, d), _s2(spark, d), P)


def q_match_rate(spark, d):
    s1, s2 = _s1(spark, d), _s2(spark, d)
    g, pairs = golden.golden_and_pairs(s1, s2, P)
    return quality.match_rate(g, s2, pairs, P)


def q_drift_check(spark, d):
    s1, s2 = _s1(spark, d), _s2(spark, d)
    return quality.drift_check(quality.match_rate(golden.golden_records(s1, s2, P), s2), P)


def _tagged(spark, d, keep: bool = False):
    """The registry batch (risk-tagged golden records); ``keep`` writes it
    once for queries that read it twice."""
    tagged = risk.risk_screen(_golden(spark, d), fixtures.headline_feed(spark), P)
    return materialize(tagged, "batch") if keep else tagged


def _tagged_first_batch(spark, d):
    """Registry batch 1: the earlier financial delivery arrives alone."""
    s2 = fixtures.earlier_financial(spark, d)
    return risk.risk_screen(golden.golden_records(None, s2, P), fixtures.headline_feed(spark), P)


def q_risk_screen(spark, d):
    return risk.risk_screen(_golden(spark, d), fixtures.headline_feed(spark), P)


def q_batch_view(spark, d):
    """What a SQL user reads from the view of the batch: companies, revenue and
    suppliers by risk tag."""
    _tagged(spark, d).createOrReplaceTempView(BATCH_VIEW)
    try:
        return spark.sql(
            f"SELECT adverse_media_news, count(*) AS companies, count(revenue) AS with_revenue, "
            f"CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue, count(top_suppliers) AS with_suppliers FROM {BATCH_VIEW} GROUP BY adverse_media_news"
        )
    finally:
        spark.catalog.dropTempView(BATCH_VIEW)


def q_risk_screen_documents(spark, d):
    """The risk tag from a feed that grows with the data: every document."""
    keywords = replace(P, risk_keywords=fixtures.DOCUMENT_KEYWORDS)
    return risk.risk_screen(_golden(spark, d), fixtures.document_feed(spark, d), keywords)


def _merged(spark, d, batch=None):
    batch = _tagged(spark, d) if batch is None else batch
    return merge_frames(_tagged_first_batch(spark, d), batch).select(*REGISTRY_ORDER)


def q_registry_merge(spark, d):
    return _merged(spark, d)


def _committed_registry(spark, d) -> tuple[SnapshotRegistry, str]:
    root = scratch_path(spark, "registry")
    reg = SnapshotRegistry(spark, root)
    reg.merge(_tagged_first_batch(spark, d))
    reg.merge(_tagged(spark, d))
    return reg, root


def _reads(df: DataFrame, path: str) -> DataFrame:
    """``df``, whose folder ``path`` goes when nothing reads it any more."""
    delete_when_unused(df, path)
    return df


def q_registry_scan(spark, d):
    reg, root = _committed_registry(spark, d)
    return _reads(reg.current(), root)


def q_registry_snapshots(spark, d):
    """Newest commits; the commit time is left out, as it differs from run to run."""
    reg, root = _committed_registry(spark, d)
    return _reads(reg.history(5), root).select("snapshot_id", "operation")


def q_registry_table_merge(spark, d):
    """Both batches upserted into a bucketed catalog table that did not exist before."""
    root, name = scratch_path(spark, "warehouse"), uuid.uuid4().hex
    reg = CatalogRegistry(spark, f"corpreg_{name}.companies", buckets=16, location=root)
    reg.merge(_tagged_first_batch(spark, d))
    reg.merge(_tagged(spark, d))
    found = _reads(reg.current(), root)
    spark.sql(f"DROP DATABASE corpreg_{name} CASCADE")  # the files stay, as they lie outside its folder
    return found


def q_registry_count(spark, d):
    return _merged(spark, d).agg(F.count(F.lit(1)).alias("row_count"))


def q_registry_distinct_ids(spark, d):
    return _merged(spark, d).agg(F.count_distinct("corporate_id").alias("distinct_ids"))


def q_registry_preview(spark, d):
    return _merged(spark, d).orderBy("corporate_id").limit(20)


def q_reconcile_delivery(spark, d):
    batch = _tagged(spark, d, keep=True)
    return quality.reconcile_delivery(_merged(spark, d, batch), batch, P)


def q_profit_features(spark, d):
    f = training.profit_features(_tagged(spark, d), P)
    return f.select(*REGISTRY_ORDER, P.label_col, "supplier_count")


def q_train_test_split(spark, d):
    return training.with_split(_tagged(spark, d), P).select("corporate_id", "split")


def q_profit_vectors(spark, d):
    v = training.profit_vectors(training.profit_features(_tagged(spark, d), P), P)
    return v.select("corporate_id", P.label_col, training.vector_to_array("features").alias("features"))


def _fit(spark, d):
    feats = training.profit_features(_tagged(spark, d, keep=True), IRLS)
    train, test = training.train_test_split(feats, IRLS)
    return training.fit_profit_model(train, IRLS), train, test


def q_profit_model(spark, d):
    """The coefficients at the maximum of the likelihood, to about their first ten digits."""
    model, train, _ = _fit(spark, d)
    s = training.model_summary(model, train.count())
    digits = {"revenue": 12}
    row = [(round(s["intercept"], 6), *(round(x, digits.get(c, 6)) for c, x in zip(IRLS.feature_cols, s["coefficients"])), s["train_rows"])]
    cols = ["intercept double", *[f"coef_{c} double" for c in IRLS.feature_cols], "train_rows bigint"]
    return spark.createDataFrame(row, ", ".join(cols))


def _predictions(scored: DataFrame) -> DataFrame:
    return scored.select("corporate_id", IRLS.label_col, F.round("probability_1", 6).alias("probability_1"), "prediction")


def q_profit_predictions(spark, d):
    model, _, test = _fit(spark, d)
    return _predictions(training.score(model, test, IRLS))


def q_score_with_saved_model(spark, d):
    """Two training runs, on the registry after the first batch and on the present
    one, save their models; the newest is found in the runs table by its
    version, loaded and applied to the test side of the present batch."""
    runs, models = scratch_path(spark, "runs"), scratch_path(spark, "models")
    present = _tagged(spark, d, keep=True)
    for n, registry in enumerate((_tagged_first_batch(spark, d), present)):
        training.run_training(registry, IRLS, model_path=f"{models}/{n}", runs_path=runs)
    _, test = training.train_test_split(training.profit_features(present, IRLS), IRLS)
    table = spark.read.schema(training.RUNS).parquet(runs)
    newest = training.model_run(table)
    scored = training.score_saved(test, table, IRLS, version=newest["model_version"])
    delete_paths(spark, [runs, models])  # the loaded model is part of the plan
    return _predictions(scored)


def q_profit_auc(spark, d):
    model, _, test = _fit(spark, d)
    scored = training.score(model, test, IRLS)
    auc = training.evaluator_auc(scored, IRLS)
    return training.rank_sum_auc(scored, IRLS.label_col).select(
        F.lit(round(auc, 6)).alias("area_under_roc"), F.round("auc_rank", 6).alias("auc_rank"), "positives", "negatives"
    )


def q_revenue_auc(spark, d):
    """The exact AUC with revenue as the score, which SQL can repeat."""
    feats = training.profit_features(_tagged(spark, d), P)
    return training.rank_sum_auc(feats, P.label_col, "revenue").withColumn("auc_rank", F.round("auc_rank", 6))


def q_training_runs(spark, d):
    """The row of a run, without what differs from run to run: ids, path and time."""
    row = training.training_runs_row(spark, training.run_training(_tagged(spark, d), IRLS), IRLS)
    return row.drop("run_id", "model_version", "model_path", "finished_at").withColumn("area_under_roc", F.round("area_under_roc", 6))


def q_drift_history(spark, d):
    return quality.drift_history(fixtures.metrics_history(spark, d), P)


def _utc_now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")


def q_health_export(spark, d):
    """The health record of a run with training, exported to JSON and read back
    under its contract. The model's version and the time differ from run to run:
    the version is checked against that of the run, the time for its format and
    for lying within the run."""
    s1, s2 = _s1(spark, d), _s2(spark, d)
    path, started = scratch_path(spark, "health"), _utc_now()
    tagged = _tagged(spark, d, keep=True)
    run = training.run_training(tagged, IRLS)
    health_export(health_record(quality.source_counts(s1, s2), quality.match_rate(tagged, s2), run, P), path)
    found = _reads(health_records(spark, path, started, _utc_now()), path)
    return found.withColumn("version_ok", F.col("model_version") == run["version"]).drop("model_version")


def _landing(spark, d) -> str:
    """Both sources written as CSV landing files (several part files per role,
    mixed in one folder tree) under the shared folder."""
    root = scratch_path(spark, "landing")
    for source, folder in ((_s1(spark, d), "supply"), (_s2(spark, d), "finance")):
        # blank names stay as they are: the writer would trim them
        source.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{root}/{folder}")
    return root


def _read_landing(spark, d) -> tuple[DataFrame, DataFrame]:
    root = _landing(spark, d)
    s1, s2 = csv_sources.read_sources(spark, root)
    _reads(s1.unionByName(s2, allowMissingColumns=True), root)
    return s1, s2


def q_read_source(spark, d):
    """Both sources: routed by header from one landing area and read back
    strictly, with the columns of the other source as NULL."""
    s1, s2 = _read_landing(spark, d)
    return s1.unionByName(s2, allowMissingColumns=True)


def q_route_sources(spark, d):
    """Rows per routed role after header routing and strict reads."""
    return quality.source_counts(*_read_landing(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "name_not_null": q_name_not_null,
    "normalize_names": q_normalize_names,
    "corporate_id": q_corporate_id,
    "canonical_name": q_canonical_name,
    "fuzzy_pairs": q_fuzzy_pairs,
    "unmatched_s1": q_unmatched_s1,
    "unmatched_s2": q_unmatched_s2,
    "fuzzy_full_outer": q_fuzzy_full_outer,
    "golden_records": q_golden_records,
    "golden_count": q_golden_count,
    "source_counts": q_source_counts,
    "dq_null_names": q_dq_null_names,
    "dq_avg_revenue": q_dq_avg_revenue,
    "dq_verdicts": q_dq_verdicts,
    "match_rate": q_match_rate,
    "drift_check": q_drift_check,
    "risk_screen": q_risk_screen,
    "batch_view": q_batch_view,
    "risk_screen_documents": q_risk_screen_documents,
    "registry_merge": q_registry_merge,
    "registry_scan": q_registry_scan,
    "registry_snapshots": q_registry_snapshots,
    "registry_table_merge": q_registry_table_merge,
    "registry_count": q_registry_count,
    "registry_distinct_ids": q_registry_distinct_ids,
    "registry_preview": q_registry_preview,
    "distinct_corporate_ids": q_distinct_corporate_ids,
    "reconcile_delivery": q_reconcile_delivery,
    "profit_features": q_profit_features,
    "train_test_split": q_train_test_split,
    "profit_vectors": q_profit_vectors,
    "profit_model": q_profit_model,
    "profit_predictions": q_profit_predictions,
    "profit_auc": q_profit_auc,
    "revenue_auc": q_revenue_auc,
    "training_runs": q_training_runs,
    "score_with_saved_model": q_score_with_saved_model,
    "drift_history": q_drift_history,
    "health_export": q_health_export,
    "read_source": q_read_source,
    "route_sources": q_route_sources,
}
