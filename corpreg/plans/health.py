"""Health record of one pipeline run, as a one-row DataFrame.

Inputs are small aggregate frames (source counts, match-rate counts, training
result); they are combined by union + aggregate, not by joining one-row
frames. ``health_export`` appends the record as JSON lines; ``health_records``
reads such lines back under a typed contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpreg.params import BASELINE_ACCURACY, DEFAULT_MODEL_VERSION, Params


def health_record(
    counts: DataFrame, rate: DataFrame, training: dict | None, params: Params = Params()
) -> DataFrame:
    """Columns: ``timestamp`` (UTC ISO-8601 with Z), ``pipeline_health_status``
    (CRITICAL iff drift) and ``telemetry`` (JSON object).

    ``counts`` has (source, row_count); ``rate`` has golden_rows and s2_rows.
    The match rate is computed once from the counts and rounded once.
    """
    c = counts.select(
        F.when(F.col("source") == "supply_chain", F.col("row_count")).alias("s1"),
        F.when(F.col("source") == "financial", F.col("row_count")).alias("s2"),
        F.lit(None).cast("bigint").alias("golden"),
        F.lit(None).cast("bigint").alias("s2_rows"),
    )
    r = rate.select(
        F.lit(None).cast("bigint").alias("s1"),
        F.lit(None).cast("bigint").alias("s2"),
        F.col("golden_rows").cast("bigint").alias("golden"),
        F.col("s2_rows").cast("bigint").alias("s2_rows"),
    )
    one = c.unionByName(r).agg(*[F.max(x).alias(x) for x in ("s1", "s2", "golden", "s2_rows")])
    den = F.coalesce(F.col("s2_rows"), F.lit(0))
    exact = F.when(den > 0, F.coalesce(F.col("golden"), F.lit(0)) * 100.0 / den).otherwise(F.lit(0.0))
    lo = params.historical_match_rate_pct - params.match_rate_deviation_pct
    hi = params.historical_match_rate_pct + params.match_rate_deviation_pct
    drift = (exact < F.lit(lo)) | (exact > F.lit(hi))
    fields = [
        F.col("s1").alias("source_1_supply_chain_row_count"),
        F.col("s2").alias("source_2_financial_row_count"),
        F.bround(exact, 2).alias("fuzzy_match_rate_pct"),
        drift.alias("entity_drift_triggered"),
    ]
    if training:
        acc = training.get("accuracy")
        fields += [
            F.lit(training.get("version", DEFAULT_MODEL_VERSION)).alias("model_version"),
            F.bround(F.lit(acc).cast("double"), 4).alias("model_accuracy_auc"),
            F.bround(F.lit(float(training.get("baseline", BASELINE_ACCURACY))), 4).alias(
                "historical_baseline_accuracy"
            ),
            F.lit(training.get("status", "ok")).alias("model_status"),
        ]
    utc_now = F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )
    return one.select(
        F.concat(utc_now, F.lit("Z")).alias("timestamp"),
        F.when(drift, "CRITICAL").otherwise("HEALTHY").alias("pipeline_health_status"),
        F.to_json(F.struct(*fields)).alias("telemetry"),
    )


TELEMETRY = (
    "source_1_supply_chain_row_count bigint, source_2_financial_row_count bigint, fuzzy_match_rate_pct double, "
    "entity_drift_triggered boolean, model_version string, model_accuracy_auc double, "
    "historical_baseline_accuracy double, model_status string"
)
STATUSES = ("CRITICAL", "HEALTHY")
TIME_FORMAT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"


def health_records(spark, path: str, started=None, ended=None) -> DataFrame:
    """Exported records, typed: the status, the telemetry's fields and two verdicts.

    ``record_ok``: the line is JSON of the declared types, the telemetry is, too,
    the status is a known one and the counts and the match rate are there. Lines
    that break the contract are kept, with what could be read of them.
    ``time_ok``: the timestamp has the export's format and, where ``started``
    and ``ended`` (UTC, as strings or datetimes) are given, lies between them.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    lines = spark.read.text(path).select(
        F.from_json("value", "timestamp string, pipeline_health_status string, telemetry string, corrupt string", options).alias("r")
    )
    parsed = lines.select("r.*", F.from_json("r.telemetry", f"{TELEMETRY}, corrupt string", options).alias("t"))
    needed = ("source_1_supply_chain_row_count", "source_2_financial_row_count", "fuzzy_match_rate_pct", "entity_drift_triggered")
    whole = F.col("corrupt").isNull() & F.col("t").isNotNull() & F.col("t.corrupt").isNull()
    for c in needed:
        whole = whole & F.col(f"t.{c}").isNotNull()
    at = F.try_to_timestamp(F.regexp_replace("timestamp", "Z$", "+00:00"))
    in_time = F.col("timestamp").rlike(TIME_FORMAT) & at.isNotNull()
    for bound, holds in ((started, lambda b: at >= b), (ended, lambda b: at <= b)):
        if bound is not None:
            in_time = in_time & holds(F.to_timestamp(F.lit(f"{bound}+00:00")))
    return parsed.select(
        "pipeline_health_status",
        "t.*",
        F.coalesce(whole & F.col("pipeline_health_status").isin(*STATUSES), F.lit(False)).alias("record_ok"),
        F.coalesce(in_time, F.lit(False)).alias("time_ok"),
    ).drop("corrupt")


def health_export(record: DataFrame, path: str) -> None:
    """Append the record to a JSON-lines dataset."""
    record.coalesce(1).write.mode("append").json(path)
