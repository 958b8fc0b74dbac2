"""Run the whole pipeline from a landing folder of CSV files.

    python -m corpreg (--landing <uri> | --roles <s1 dir> <s2 dir>) (--registry <uri> | --table <name>) [--config thresholds.json]
                      [--feed headlines.txt] [--model <uri>] [--runs <uri>] [--health <uri>]

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
credentials and ``spark.checkpoint.dir`` are whatever spark-submit or the
cluster defaults provide.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpreg.operators.quality import CircuitBreakerError
from corpreg.params import Params, params_from_config
from corpreg.plans.pipeline import run_pipeline
from corpreg.sources.csv_sources import MissingSourceError, read_role_folders, read_sources


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="corpreg")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing", help="folder (any Hadoop URI) holding the source CSV files, routed by header")
    src.add_argument("--roles", nargs=2, metavar=("SUPPLY_CHAIN_DIR", "FINANCIAL_DIR"),
                     help="one folder per source role; no per-file header reads")
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--registry", help="registry root folder")
    where.add_argument("--table", help="registry as a catalog table")
    ap.add_argument("--table-format", default="delta", help="its format: parquet or orc (bucketed versions) or one that supports MERGE INTO")
    ap.add_argument("--metrics", help="folder of the metrics history: drift against earlier runs, too")
    ap.add_argument("--config", help="thresholds JSON file")
    ap.add_argument("--feed", required=True, help="text file or folder with one headline per line")
    ap.add_argument("--policy", default="union", choices=["union", "last"], help="several files of one role")
    ap.add_argument("--model", help="folder for the fitted model")
    ap.add_argument("--runs", help="training runs table folder")
    ap.add_argument("--health", help="health record JSON folder")
    ap.add_argument("--no-train", action="store_true")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("corpreg").getOrCreate()
    params = params_from_config(args.config) if args.config else Params()
    # the first matching headline wins, so positions must follow the order
    # of files, then of blocks, then of lines, whatever order splits are read in
    lines = (
        spark.read.text(args.feed)
        .select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
        .where(F.trim("value") != "")
        .select(F.struct("file_path", "file_block_start", "line").alias("at"), F.col("value").alias("headline"))
    )
    feed = lines.repartitionByRange("at").sortWithinPartitions("at").select(F.monotonically_increasing_id().alias("position"), "headline")
    try:
        if args.landing:
            s1, s2 = read_sources(spark, args.landing, policy=args.policy)
        else:
            s1, s2 = read_role_folders(spark, *args.roles)
        result = run_pipeline(
            spark, s1, s2, feed, args.registry, params,
            train=not args.no_train, model_path=args.model, runs_path=args.runs, health_path=args.health,
            table=args.table, table_format=args.table_format, metrics_path=args.metrics,
        )
    except (MissingSourceError, CircuitBreakerError) as e:
        print(f"pipeline stopped: {e}", file=sys.stderr)
        return 1
    print(json.dumps(result.health, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
