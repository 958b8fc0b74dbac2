"""Intermediates go when nothing reads them any more."""

import gc
import os
import time

import pytest

from corpreg.plans.catalog import QUERIES
from corpreg.session import delete_unused, materialize, shared_dir


def scratch_files(spark):
    root = shared_dir(spark).replace("file:", "")
    return {os.path.join(at, f) for at, _, files in os.walk(os.path.join(root, "corpreg")) for f in files if f.endswith(".parquet") or f.endswith(".csv") or f.endswith(".json")}


def settle(spark, wanted, tries=20):
    """Collect garbage here and in the JVM until ``wanted`` holds."""
    for _ in range(tries):
        gc.collect()
        spark._jvm.java.lang.System.gc()
        delete_unused()
        if wanted():
            return True
        time.sleep(0.2)
    return False


def test_folder_lives_as_long_as_any_plan_made_from_it(spark):
    first = materialize(spark.range(1000), "lifecycle")
    path = first.inputFiles()[0].replace("file://", "")
    child = first.selectExpr("id * 2 AS twice").where("twice > 10")
    del first
    assert not settle(spark, lambda: not os.path.exists(path), tries=5)
    assert child.count() == 994
    child.createOrReplaceTempView("lifecycle_view")
    del child
    assert not settle(spark, lambda: not os.path.exists(path), tries=5)
    assert spark.table("lifecycle_view").count() == 994
    spark.catalog.dropTempView("lifecycle_view")
    assert settle(spark, lambda: not os.path.exists(path))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_leaves_nothing_behind(spark, sf_small, name):
    settle(spark, lambda: False, tries=1)
    before = scratch_files(spark)
    df = QUERIES[name](spark, sf_small)
    df.select(*sorted(df.columns)).count()
    del df
    assert settle(spark, lambda: not scratch_files(spark) - before), sorted(scratch_files(spark) - before)[:5]
