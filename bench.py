"""Benchmark of the headline queries.

Runs every headline query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line. Each query is executed in full
through the ``noop`` sink (no driver collect): one warm-up pass over all
queries, then $BENCH_REPEAT timed runs each; the median is reported. ``value`` is the sum of the
medians. The direct formulation (theta full outer join + window) is timed
once as ``baseline_direct`` for comparison and is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "golden_records",
    "fuzzy_pairs",
    "fuzzy_full_outer",
    "risk_screen",
    "dq_verdicts",
    "match_rate",
    "registry_merge",
    "reconcile_delivery",
    "profit_features",
    "training_runs",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    with_direct = os.environ.get("BENCH_DIRECT", "0") == "1"

    from pyspark.sql import SparkSession

    from corpreg.plans.catalog import QUERIES

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpreg-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus) if cpus.isdigit() else 16)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    # one warm-up pass over every query first, so that JIT compilation and
    # first-use costs do not land on whichever query happens to come first
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))

    times: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)

    # the whole run: contracts, golden records, risk tags, registry commit,
    # reconciliation, drift, training and the health record
    from corpreg.plans.pipeline import run_pipeline
    from corpreg.session import scratch_path
    from corpreg.sources import fixtures as fx

    def pipeline_once() -> None:
        run_pipeline(
            spark,
            fx.with_names(fx.supply_chain(spark, sf_dir)),
            fx.with_names(fx.financial(spark, sf_dir)),
            fx.headline_feed(spark),
            scratch_path(spark, "bench-registry"),
        )

    pipeline_once()
    samples = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        pipeline_once()
        samples.append(time.perf_counter() - t0)
    times["pipeline_end_to_end"] = round(statistics.median(samples), 3)

    # skew: Source 1 where one company holds most rows (every lineitem row
    # becomes a supply-chain record of the same company), next to the usual
    # rows; the per-name partial aggregate must absorb the hot name
    from pyspark.sql import functions as F

    from corpreg.operators.golden import golden_records

    def hot_source_1():
        li = fx.load_table(spark, sf_dir, "lineitem")
        hot = li.select(
            F.lit("red widget Inc.").alias("corporate_name_S1"),
            F.concat(F.col("l_orderkey").cast("string"), F.lit(" Dock Rd")).alias("address"),
            F.col("l_returnflag").alias("activity_places"),
            F.col("l_linestatus").alias("top_suppliers"),
        )
        return fx.supply_chain(spark, sf_dir).unionByName(hot)

    run(golden_records(hot_source_1(), fx.financial(spark, sf_dir)))
    samples = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        run(golden_records(hot_source_1(), fx.financial(spark, sf_dir)))
        samples.append(time.perf_counter() - t0)
    times["golden_records_hot_name"] = round(statistics.median(samples), 3)

    extra = {}
    if with_direct:
        from corpreg.operators.fuzzy import fuzzy_full_outer_naive
        from corpreg.operators.golden import golden_from_harmonized
        from corpreg.sources import fixtures

        s1 = fixtures.supply_chain(spark, sf_dir)
        s2 = fixtures.financial(spark, sf_dir)
        t0 = time.perf_counter()
        run(golden_from_harmonized(fuzzy_full_outer_naive(s1, s2)))
        extra["baseline_direct_golden_sec"] = round(time.perf_counter() - t0, 3)

    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "repeat": repeat,
        **extra,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
