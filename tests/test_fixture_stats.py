"""Our outputs against the statistics recorded in FIXTURES.md (sf0.01),
which were computed separately by brute force."""

from pyspark.sql import functions as F

from corpreg.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_fixture_statistics(spark):
    rate = QUERIES["match_rate"](spark, SF).first()
    assert (rate["golden_rows"], rate["s2_rows"], rate["matched_s2_rows"]) == (2630, 3500, 1572)
    assert rate["match_rate_pct"] == 75.14
    assert QUERIES["drift_check"](spark, SF).first()["drift_triggered"] is False

    feats = QUERIES["profit_features"](spark, SF)
    assert QUERIES["golden_records"](spark, SF).where(F.col("revenue").isNull()).count() == 1216
    assert feats.where("high_profit_indicator = 1").count() == 535
    dist = {r[0]: r[1] for r in feats.groupBy("supplier_count").count().collect()}
    assert dist == {0: 1967, 1: 64, 2: 522, 3: 77}
    split = {r[0]: r[1] for r in QUERIES["train_test_split"](spark, SF).groupBy("split").count().collect()}
    assert split == {"train": 2133, "test": 497}
    assert QUERIES["fuzzy_full_outer"](spark, SF).count() == 61517
    assert QUERIES["unmatched_s1"](spark, SF).count() == 1545
    assert QUERIES["unmatched_s2"](spark, SF).count() == 1898


def test_views_keep_every_row(spark):
    """No view leaves out a row: Source 1 has every part and customer, Source 2 every
    customer and every part with line items."""
    from corpreg.sources import fixtures as fx

    for sf in (SF, "/root/testdata/sf0.1"):
        part, lines = fx.load_table(spark, sf, "part"), fx.load_table(spark, sf, "lineitem")
        sold = lines.select("l_partkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        customers = fx.load_table(spark, sf, "customer").count()
        assert fx.supply_chain(spark, sf).count() == part.count() + customers
        assert fx.financial(spark, sf).count() == sold.count() + customers


def test_views_reach_every_branch(spark):
    """Names that fail the contract, and a first registry batch with ids that the second lacks."""
    verdicts = {(r["source"], r["rule"]): r["passed"] for r in QUERIES["dq_verdicts"](spark, SF).collect()}
    assert verdicts == {
        ("supply_chain", "null_or_blank_name"): False,
        ("financial", "null_or_blank_name"): False,
        ("financial", "min_avg_revenue"): True,
    }
    recon = QUERIES["reconcile_delivery"](spark, SF).first()
    assert recon["registry_distinct_ids"] == 3249 and recon["batch_rows"] == 2630
