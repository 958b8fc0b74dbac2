"""Data contracts, counts, match rate, drift and delivery reconciliation.

Every metric is a DataFrame built from one aggregate pass. Metrics that need
two inputs tag and union the inputs and aggregate once, rather than joining
one-row aggregates together. Verdicts reach the driver only in
:func:`require_contracts`, which collects a handful of verdict rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpreg.functions.names import blank, normalized_name
from corpreg.params import S1_NAME, S2_NAME, Params
from corpreg.session import shuffled

SOURCE_1 = "supply_chain"
SOURCE_2 = "financial"
METRIC_TYPE = "double"


class CircuitBreakerError(Exception):
    """A data contract failed; the batch must not be processed."""


def _tagged_count(df: DataFrame, source: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(source).alias("source"), "row_count")


def source_counts(s1: DataFrame, s2: DataFrame) -> DataFrame:
    """(source, row_count) for both sources."""
    return _tagged_count(s1, SOURCE_1).unionByName(_tagged_count(s2, SOURCE_2))


def contract_metrics(df: DataFrame, source: str, name_col: str, validate_columns: bool = False) -> DataFrame:
    """One row per source from a single scan: row count, NULL-or-"" names and,
    when the source has a ``revenue`` column, its average.

    With ``validate_columns`` the same scan also counts the non-NULL cells of
    every column (``non_null_cells``), which makes a strict CSV reader parse
    every typed column, so malformed values fail here, at the contract gate.
    """
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(blank(name_col)).alias("null_or_blank_names"),
    ]
    has_revenue = "revenue" in df.columns
    if has_revenue:
        aggs.append(F.avg("revenue").alias("avg_revenue"))
    else:
        aggs.append(F.lit(None).cast("double").alias("avg_revenue"))
    extra = []
    if validate_columns:
        cells = None
        for c in df.columns:
            n = F.count(F.col(c))
            cells = n if cells is None else cells + n
        aggs.append(cells.alias("non_null_cells"))
        extra = ["non_null_cells"]
    return df.agg(*aggs).select(
        F.lit(source).alias("source"), F.lit(name_col).alias("name_column"), "row_count",
        "null_or_blank_names", "avg_revenue", F.lit(has_revenue).alias("has_revenue"), *extra,
    )


# Counters that ride along with the per-name aggregate of a source.
COUNTERS = ("__rows", "__blank_names", "__revenue", "__revenue_rows", "__cells")


def counters(df: DataFrame, name_col: str) -> list[Column]:
    """Aggregates of any grouping of a source's rows whose sums over all groups
    give its :func:`contract_metrics`."""
    revenue = F.col("revenue") if "revenue" in df.columns else F.lit(None).cast("double")
    cells = sum((F.count(F.col(c)) for c in df.columns[1:]), F.count(F.col(df.columns[0])))
    found = (F.count(F.lit(1)), F.count_if(blank(name_col)), F.sum(revenue), F.count(revenue), cells)
    return [c.alias(n) for c, n in zip(found, COUNTERS, strict=True)]


def summed_metrics(grouped: DataFrame, source: str, name_col: str, has_revenue: bool) -> DataFrame:
    """The :func:`contract_metrics` row of a source from the written groups that
    carry its :func:`counters`.

    The counters are read from the written rows, not observed by the write: a
    repeated shuffle task would count observed values twice, and a session that
    holds an ``Observation`` can no longer ship Spark ML's fitted models."""
    rows, blanks, revenue, n, cells = COUNTERS
    return grouped.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(blanks), F.lit(0)).alias("null_or_blank_names"),
        F.try_divide(F.sum(revenue), F.sum(n)).alias("avg_revenue"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("non_null_cells"),
    ).select(
        F.lit(source).alias("source"), F.lit(name_col).alias("name_column"), "row_count", "null_or_blank_names",
        "avg_revenue", F.lit(has_revenue).alias("has_revenue"), "non_null_cells",
    )


def dq_null_names(s1: DataFrame, s2: DataFrame) -> DataFrame:
    """(source, name_column, null_or_blank_names)."""
    m = contract_metrics(s1, SOURCE_1, S1_NAME).unionByName(contract_metrics(s2, SOURCE_2, S2_NAME))
    return m.select("source", "name_column", "null_or_blank_names")


def dq_avg_revenue(s2: DataFrame) -> DataFrame:
    """(source, avg_revenue) rounded to cents, for the source with revenue."""
    m = contract_metrics(s2, SOURCE_2, S2_NAME)
    return m.select("source", F.round("avg_revenue", 2).cast(METRIC_TYPE).alias("avg_revenue"))


def verdicts(metrics: DataFrame, params: Params = Params()) -> DataFrame:
    """(source, rule, metric_value, threshold, passed), one row per applicable
    rule. Rule 1 fails on any NULL or "" name; rule 2 applies only to a
    source with revenue and fails iff the average is non-NULL and below the
    minimum."""
    rule1 = metrics.select(
        "source",
        F.lit("null_or_blank_name").alias("rule"),
        F.col("null_or_blank_names").cast(METRIC_TYPE).alias("metric_value"),
        F.lit(0).cast(METRIC_TYPE).alias("threshold"),
        (F.col("null_or_blank_names") == 0).alias("passed"),
    )
    rule2 = metrics.where(F.col("has_revenue")).select(
        "source",
        F.lit("min_avg_revenue").alias("rule"),
        F.round("avg_revenue", 2).cast(METRIC_TYPE).alias("metric_value"),
        F.lit(params.min_avg_revenue).cast(METRIC_TYPE).alias("threshold"),
        (F.col("avg_revenue").isNull() | (F.col("avg_revenue") >= params.min_avg_revenue)).alias("passed"),
    )
    return rule1.unionByName(rule2)


def dq_verdicts(s1: DataFrame, s2: DataFrame, params: Params = Params()) -> DataFrame:
    """Verdict rows of both sources."""
    m = contract_metrics(s1, SOURCE_1, S1_NAME).unionByName(contract_metrics(s2, SOURCE_2, S2_NAME))
    return verdicts(m, params)


def check_contracts(df: DataFrame, source: str, name_col: str, params: Params = Params()) -> DataFrame:
    """Verdict rows for one source; rule 2 only if it has a revenue column."""
    return verdicts(contract_metrics(df, source, name_col), params)


def require_contracts(verdict_rows: DataFrame) -> None:
    """Raise :class:`CircuitBreakerError` if any verdict failed."""
    failed = verdict_rows.where(~F.col("passed")).collect()
    if failed:
        msg = "; ".join(
            f"{r['source']}: {r['rule']} violated (value {r['metric_value']}, threshold {r['threshold']})"
            for r in failed
        )
        raise CircuitBreakerError(msg)


def require_source_contracts(df: DataFrame, source: str, name_col: str, params: Params = Params()) -> None:
    """Check one source and raise :class:`CircuitBreakerError` on a violation."""
    require_contracts(check_contracts(df, source, name_col, params))


def match_rate(golden: DataFrame, s2: DataFrame, pairs: DataFrame | None = None, params: Params = Params()) -> DataFrame:
    """Golden rows per raw Source-2 row, in percent (0 when Source 2 is empty).

    With ``pairs`` also reports the share of Source-2 rows that matched at
    least one Source-1 name (``matched_s2_pct``).
    """
    g = golden.select(F.lit(1).alias("g"), F.lit(0).alias("s"), F.lit(0).alias("m"))
    if pairs is None:
        s = s2.select(F.lit(0).alias("g"), F.lit(1).alias("s"), F.lit(0).alias("m"))
    else:
        matched = pairs.select(F.col("norm_2").alias("_n")).distinct()
        s = (
            s2.withColumn("_n", normalized_name(S2_NAME, params.suffix_regex))
            .join(shuffled(matched.withColumn("_hit", F.lit(1))), "_n", "left")
            .select(F.lit(0).alias("g"), F.lit(1).alias("s"), F.coalesce("_hit", F.lit(0)).alias("m"))
        )
    agg = g.unionByName(s).agg(
        F.sum("g").cast("bigint").alias("golden_rows"),
        F.sum("s").cast("bigint").alias("s2_rows"),
        F.sum("m").cast("bigint").alias("matched_s2_rows"),
    )
    return agg.select(
        F.coalesce("golden_rows", F.lit(0)).cast("bigint").alias("golden_rows"),
        F.coalesce("s2_rows", F.lit(0)).cast("bigint").alias("s2_rows"),
        F.coalesce("matched_s2_rows", F.lit(0)).cast("bigint").alias("matched_s2_rows"),
        _pct("golden_rows", "s2_rows").alias("match_rate_pct"),
        _pct("matched_s2_rows", "s2_rows").alias("matched_s2_pct"),
    )


def match_rate_of(golden: DataFrame, s2_rows: int) -> DataFrame:
    """Match rate when the Source-2 row count is already known."""
    agg = golden.agg(F.count(F.lit(1)).alias("golden_rows")).select(
        "golden_rows", F.lit(int(s2_rows)).cast("bigint").alias("s2_rows")
    )
    return agg.select("golden_rows", "s2_rows", _pct("golden_rows", "s2_rows").alias("match_rate_pct"))


def _pct(num: str, den: str) -> Column:
    n = F.coalesce(F.col(num), F.lit(0))
    d = F.coalesce(F.col(den), F.lit(0))
    return F.when(d > 0, F.bround(n.cast("double") * 100.0 / d, 2)).otherwise(F.lit(0.0))


def drift_check(rate: DataFrame, params: Params = Params()) -> DataFrame:
    """Adds bounds, ``drift_triggered`` (strictly outside the band) and the
    health status (CRITICAL iff drift). The band test uses the unrounded
    rate ``golden_rows * 100 / s2_rows``; ``match_rate_pct`` is for display."""
    lo = params.historical_match_rate_pct - params.match_rate_deviation_pct
    hi = params.historical_match_rate_pct + params.match_rate_deviation_pct
    g, s = F.coalesce(F.col("golden_rows"), F.lit(0)), F.coalesce(F.col("s2_rows"), F.lit(0))
    r = F.when(s > 0, g * 100.0 / s).otherwise(F.lit(0.0))
    drift = (r < F.lit(lo)) | (r > F.lit(hi))
    return rate.select(
        "match_rate_pct",
        F.lit(lo).alias("lower_bound_pct"),
        F.lit(hi).alias("upper_bound_pct"),
        drift.alias("drift_triggered"),
        F.when(drift, "CRITICAL").otherwise("HEALTHY").alias("pipeline_health_status"),
    )


def metrics_row(spark, run_id: str, finished_at, rate: DataFrame, pipeline: str = "registry") -> DataFrame:
    """One row of the metrics history: pipeline, run_id, finished_at, golden_rows, s2_rows."""
    return rate.select(
        F.lit(pipeline).alias("pipeline"), F.lit(run_id).alias("run_id"), F.lit(finished_at).cast("timestamp").alias("finished_at"),
        F.col("golden_rows").cast("bigint").alias("golden_rows"), F.col("s2_rows").cast("bigint").alias("s2_rows"),
    )


def drift_history(history: DataFrame, params: Params = Params()) -> DataFrame:
    """Drift of every run against the runs before it.

    ``history`` holds one row a run: pipeline, run_id, finished_at, golden_rows,
    s2_rows. The baseline of a run is the mean match rate of the
    ``params.history_runs`` runs of its pipeline before it, in order of time and
    run id, and the band is ``params.history_deviations`` population standard
    deviations of them on each side, but at least
    ``params.match_rate_deviation_pct``. Runs without Source-2 rows have no rate:
    they take a place among the runs before but add nothing to mean and
    deviation, and are never drift. A run with no rate before it is held
    against the historical rate of ``params``.
    """
    by_time = Window.partitionBy("pipeline").orderBy("finished_at", "run_id")
    before = by_time.rowsBetween(-params.history_runs, -1)
    rate = F.when(F.col("s2_rows") > 0, F.coalesce(F.col("golden_rows"), F.lit(0)) * 100.0 / F.col("s2_rows"))
    seen = history.withColumn("rate", rate).select(
        "pipeline", "run_id", "rate", F.count("rate").over(before).alias("runs_before"),
        F.avg("rate").over(before).alias("mean"), F.stddev_pop("rate").over(before).alias("spread"),
    )
    base = F.coalesce("mean", F.lit(params.historical_match_rate_pct))
    width = F.greatest(F.coalesce(F.col("spread") * params.history_deviations, F.lit(0.0)), F.lit(params.match_rate_deviation_pct))
    drift = F.coalesce(F.abs(F.col("rate") - base) > width, F.lit(False))
    return seen.select(
        "pipeline", "run_id", F.bround("rate", 2).alias("match_rate_pct"), "runs_before",
        F.round(base, 6).alias("baseline_pct"), F.round(width, 6).alias("deviation_pct"), drift.alias("drift_triggered"),
        F.when(drift, "CRITICAL").otherwise("HEALTHY").alias("pipeline_health_status"),
    )


def reconcile_delivery(registry: DataFrame, batch: DataFrame, params: Params = Params()) -> DataFrame:
    """Delivery index = distinct registry ids / batch rows x 100 (pass at or
    above the target; NULL when the batch is empty) and batch coverage = share
    of batch rows whose id is present in the registry. One shuffle by id."""
    r = registry.select("corporate_id", F.lit(1).alias("in_reg"), F.lit(0).alias("in_batch"))
    b = batch.select("corporate_id", F.lit(0).alias("in_reg"), F.lit(1).alias("in_batch"))
    per_id = r.unionByName(b).groupBy("corporate_id").agg(
        F.max("in_reg").alias("in_reg"), F.sum("in_batch").alias("n_batch")
    )
    agg = per_id.agg(
        F.count_if(F.col("corporate_id").isNotNull() & (F.col("in_reg") == 1)).alias("registry_distinct_ids"),
        F.coalesce(F.sum("n_batch"), F.lit(0)).cast("bigint").alias("batch_rows"),
        F.coalesce(F.sum(F.when(F.col("in_reg") == 1, F.col("n_batch"))), F.lit(0)).cast("bigint").alias("covered"),
    )
    exact = F.when(F.col("batch_rows") > 0, F.col("registry_distinct_ids") * 100.0 / F.col("batch_rows"))
    idx = F.bround(exact, 2)
    cov = F.when(F.col("batch_rows") > 0, F.bround(F.col("covered") * 100.0 / F.col("batch_rows"), 2))
    return agg.select(
        "registry_distinct_ids",
        "batch_rows",
        idx.alias("delivery_index_pct"),
        (exact >= F.lit(params.delivery_target_pct)).alias("meets_target"),
        cov.alias("batch_coverage_pct"),
    )
