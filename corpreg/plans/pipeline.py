"""End-to-end run: contracts -> golden records -> risk tag -> registry commit
-> reconciliation -> drift -> training -> health record.

Each source is scanned once. Actions happen at named points only: the per-name
rows with the contract verdict, the name pairs, the headline ranges, the batch
checkpoint, the registry commit, the metric rows and the model fit. The
tagged batch is written once to the shared folder (``spark.checkpoint.dir``)
so that a lost executor never forces the fuzzy join to be recomputed; after
the commit every consumer reads the committed snapshot.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpreg.operators import golden, quality, risk, training
from corpreg.params import S1_NAME, S2_NAME, Params
from corpreg.plans.health import health_export, health_record
from corpreg.session import materialize, scratch_scope
from corpreg.sources.registry import CatalogRegistry, SnapshotRegistry, ensure_registry_table, merge_into_table

FILE_FORMATS = ("parquet", "orc")  # without MERGE INTO: a bucketed table for each version


@dataclass
class RunResult:
    snapshot_id: int | None
    verdicts: list
    source_counts: dict
    match_rate: dict
    drift: dict
    reconciliation: dict
    training: dict | None
    health: dict
    drift_history: dict | None = None


def run_pipeline(
    spark: SparkSession,
    s1: DataFrame,
    s2: DataFrame,
    feed: DataFrame,
    registry_root: str | None,
    params: Params = Params(),
    train: bool = True,
    model_path: str | None = None,
    runs_path: str | None = None,
    health_path: str | None = None,
    batch_view: str | None = "incoming_batch_records",
    metrics_path: str | None = None,
    table: str | None = None,
    table_format: str = "delta",
) -> RunResult:
    """One run. The registry is a folder of snapshots (``registry_root``) or,
    with ``table``, a catalog table: bucketed versions behind a view for a plain
    file format, ``MERGE INTO`` for a format that supports it. It is made when
    missing, and ``snapshot_id`` is then None."""
    if (registry_root is None) == (table is None):
        raise ValueError("give either registry_root or table")
    # intermediates of the resolution are deleted once the batch is written;
    # the batch itself stays (the temp view reads it)
    with scratch_scope(spark):
        # 1. one scan per source: the best row of every name, with the counts and
        #    data contracts written by the same job; raises on violation
        best_1, metrics_1 = golden.checked_best_per_name(s1, quality.SOURCE_1, S1_NAME, golden.S1_RANK, params)
        best_2, metrics_2 = golden.checked_best_per_name(s2, quality.SOURCE_2, S2_NAME, golden.S2_RANK, params)
        metric_rows = metrics_1.unionByName(metrics_2).collect()
        metrics_df = spark.createDataFrame(metric_rows, metrics_1.schema)
        verdicts = quality.verdicts(metrics_df, params)
        verdict_rows = [r.asDict() for r in verdicts.collect()]
        quality.require_contracts(verdicts)
        counts = {r["source"]: r["row_count"] for r in metric_rows}
        counts_df = metrics_df.select("source", "row_count")

        # 2. golden records with risk tags, materialized once in the shared folder
        tagged = risk.risk_screen(golden.golden_of_names(best_1, best_2, params)[0], feed, params)
        batch = materialize(tagged, "batch", scoped=False)
    if batch_view:
        batch.createOrReplaceTempView(batch_view)

    # 3. keyed upsert into the registry
    if table:
        if table_format in FILE_FORMATS:
            CatalogRegistry(spark, table, using=table_format).merge(batch)
        else:
            ensure_registry_table(spark, table, table_format)
            merge_into_table(spark, table, batch)
        sid, current = None, spark.table(table)
    else:
        registry = SnapshotRegistry(spark, registry_root)
        sid = registry.merge(batch, source_is_written=True)
        current = registry.current()

    # 4. metrics; with a history of earlier runs, the drift against them too
    run_id, finished_at, history_row = uuid.uuid4().hex, datetime.now(timezone.utc).replace(tzinfo=None), None
    rate = quality.match_rate_of(batch, counts[quality.SOURCE_2])
    rate_row = rate.first().asDict()
    drift = quality.drift_check(rate, params)
    drift_row = drift.first().asDict()
    if metrics_path:
        quality.metrics_row(spark, run_id, finished_at, rate).write.mode("append").parquet(metrics_path)
        history = quality.drift_history(spark.read.parquet(metrics_path), params)
        history_row = history.where(F.col("run_id") == run_id).first().asDict()
    recon = quality.reconcile_delivery(current, batch, params).first().asDict()

    # 5. training on the committed registry
    run = training.run_training(current, params, model_path, runs_path) if train else None

    # 6. health record
    record = health_record(counts_df, rate, run, params)
    if health_path:
        health_export(record, health_path)
    return RunResult(
        snapshot_id=sid,
        verdicts=verdict_rows,
        source_counts=counts,
        match_rate=rate_row,
        drift=drift_row,
        reconciliation=recon,
        training=run,
        health=record.first().asDict(),
        drift_history=history_row,
    )
