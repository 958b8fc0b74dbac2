"""Plan-shape guards for the properties the design relies on at scale."""

import pytest
from pyspark.sql import functions as F

from corpreg.operators import fuzzy, golden, quality, risk
from corpreg.plans.catalog import QUERIES
from corpreg.sources import fixtures
from corpreg.sources.registry import merge_frames

SF = "/root/testdata/sf0.01"


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["fuzzy_pairs", "golden_records", "risk_screen", "fuzzy_full_outer", "match_rate", "registry_merge"]
)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(spark, name)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["golden_records", "risk_screen", "fuzzy_pairs", "dq_verdicts"])
def test_no_python_on_data_path(spark, name):
    plan = _plan(spark, name)
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_golden_has_no_window_over_ids(spark):
    # ranking is a partial max(struct) aggregate, never a per-id window
    plan = _plan(spark, "golden_records")
    assert "Window" not in plan
    assert "partial_max" in plan


def test_candidates_verified_inside_the_join(spark):
    plan = _plan(spark, "fuzzy_pairs")
    assert "levenshtein" in plan
    join_lines = [l for l in plan.splitlines() if "Join" in l and "levenshtein" in l]
    assert join_lines, "edit-distance check should be a join condition, before the pair shuffle"


def test_source_scans_prune_and_push_down(spark):
    df = QUERIES["dq_verdicts"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # contract checks read only the columns they need
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string" in plan
    # every part takes part, so only the join key of lineitem is filtered
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _company_names(spark):
    name = F.concat(F.lit("global logistics "), F.md5(F.col("id").cast("string")))
    return spark.range(100).select(name.alias("name"))


def test_segment_joins_are_shuffled(spark):
    # the planner's estimate is that of the names, not of the segments that they become
    names = _company_names(spark)
    assert "Broadcast" not in _executed(fuzzy.similar_pairs(names, names, 2))


def test_golden_joins_are_shuffled(spark):
    best_1 = _company_names(spark).select(F.col("name").alias("norm"), F.struct(*[F.col("name").alias(c) for c in golden.S1_RANK]).alias("best"))
    best_2 = best_1.select("norm", F.struct(*[F.col("norm").alias(c) for c in golden.S2_RANK]).alias("best"))
    pairs = best_1.select(F.col("norm").alias("norm_1"), F.col("norm").alias("norm_2"))
    assert "Broadcast" not in _executed(golden.golden_from_best(best_1, best_2, pairs))


def test_parts_are_not_broadcast(spark):
    assert "Broadcast" not in _executed(fixtures.financial(spark, SF))


def test_registry_and_match_rate_joins_are_shuffled(spark):
    # one small column of a wide table: the estimate is small, however many rows there are
    ids = _company_names(spark).select(F.col("name").alias("corporate_id"), F.lit(1.0).alias("revenue"))
    assert "Broadcast" not in _executed(merge_frames(ids, ids))
    source = _company_names(spark).select(F.col("name").alias("corporate_name_S2"))
    pairs = _company_names(spark).select(F.col("name").alias("norm_1"), F.col("name").alias("norm_2"))
    assert "Broadcast" not in _executed(quality.match_rate(ids, source, pairs))


def test_risk_gram_join_is_shuffled(spark):
    tokens = _company_names(spark).select(F.col("name").alias("token"))
    grams = risk.headline_grams(_company_names(spark).select(F.lit(1).alias("position"), F.col("name").alias("lower_headline")))
    assert "Broadcast" not in _executed(risk.rarest_grams(tokens, grams))


def test_probes_are_made_row_by_row(spark):
    # about a hundred rows a name: functions on arrays run interpreted
    plan = _executed(fuzzy.segment_probes(_company_names(spark), 2))
    assert "transform(" not in plan and "lambda" not in plan
