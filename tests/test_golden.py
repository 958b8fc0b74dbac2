import pytest

from corpreg.operators.golden import golden_records, top_row_per_key, top_row_per_key_window

SCHEMA = "corporate_id string, corporate_name string, address string, revenue double, profit double"


def test_conflicting_financials_keep_row_with_address(spark):
    rows = [
        ("techcorp_id", "TechCorp", "123 Innovation Way", 500000.0, 120000.0),
        ("techcorp_id", "TechCorp", None, 450000.0, 110000.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for fn in (top_row_per_key, top_row_per_key_window):
        out = fn(df, "corporate_id", ["address"]).collect()
        assert len(out) == 1
        assert out[0]["address"] == "123 Innovation Way"
        assert out[0]["revenue"] == 500000.0


def test_top_row_total_order_on_ties(spark):
    rows = [("k", "n", "same", 1.0, 5.0), ("k", "n", "same", 3.0, 1.0), ("k", "n", None, 9.0, 9.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = top_row_per_key(df, "corporate_id", ["address", "revenue"]).collect()
    b = top_row_per_key_window(df, "corporate_id", ["address", "revenue"]).collect()
    assert a == b and a[0]["revenue"] == 3.0


def test_hot_name_is_one_golden_row(spark):
    # one name holds most rows on both sides
    s1 = spark.createDataFrame(
        [(f"Acme{'' if i % 3 else ' Inc.'}", f"{i} Main St", "x", None) for i in range(3000)]
        + [("Other Co", "1 Side St", "y", "A,B")],
        "corporate_name_S1 string, address string, activity_places string, top_suppliers string",
    )
    s2 = spark.createDataFrame(
        [("ACME LLC", "c", float(i), float(i) / 10) for i in range(2000)] + [("Zeta", None, 1.0, 0.1)],
        "corporate_name_S2 string, main_customers string, revenue double, profit double",
    )
    g = {r["corporate_name"]: r for r in golden_records(s1, s2).collect()}
    assert len(g) == 3
    acme = [r for n, r in g.items() if n.lower().startswith("acme")][0]
    assert acme["address"] == "999 Main St" and acme["revenue"] == 1999.0
    assert g["Zeta"]["address"] is None and g["Zeta"]["revenue"] == 1.0


def test_financial_only_batch(spark):
    s2 = spark.createDataFrame(
        [("Beta Inc.", "a", 1.0, 0.5), ("beta", "b", 2.0, 0.1), ("Gamma", None, None, None)],
        "corporate_name_S2 string, main_customers string, revenue double, profit double",
    )
    g = sorted(golden_records(None, s2).collect(), key=lambda r: r["corporate_name"])
    assert [r["corporate_name"] for r in g] == ["Gamma", "beta"]
    assert g[1]["revenue"] == 2.0


def _random_sources(spark, seed):
    import random

    rng = random.Random(seed)
    bases = ["acme", "acne", "acm", "beta", "bet", "zeta co", "", "x", "ab", "global logistics"]
    suffixes = ["", " Inc.", " LLC", ", Ltd.", "_7", " Corp", " international", "   "]
    s1_rows, s2_rows = [], []
    for _ in range(rng.randint(5, 40)):
        name = rng.choice([None, "Inc.", "   "] + [rng.choice(bases).title() + rng.choice(suffixes) for _ in range(6)])
        s1_rows.append(
            (name, rng.choice([None, "1 Main", "2 Main", "1 Main"]), rng.choice([None, "a", "b"]), rng.choice([None, "s,t", "s"]))
        )
    for _ in range(rng.randint(5, 40)):
        name = rng.choice([None, "LLC"] + [rng.choice(bases).upper() + rng.choice(suffixes) for _ in range(6)])
        s2_rows.append(
            (name, rng.choice([None, "c", "d"]), rng.choice([None, 1.0, 2.0, 2.0]), rng.choice([None, 0.5, 0.7]))
        )
    s1 = spark.createDataFrame(
        s1_rows, "corporate_name_S1 string, address string, activity_places string, top_suppliers string"
    )
    s2 = spark.createDataFrame(
        s2_rows, "corporate_name_S2 string, main_customers string, revenue double, profit double"
    )
    return s1, s2


@pytest.mark.parametrize("seed", range(6))
def test_rank_before_join_equals_direct_plan(spark, seed):
    from corpreg.operators.fuzzy import fuzzy_full_outer_naive
    from corpreg.operators.golden import golden_from_harmonized

    s1, s2 = _random_sources(spark, seed)
    fast = golden_records(s1, s2)
    slow = golden_from_harmonized(fuzzy_full_outer_naive(s1, s2)).select(fast.columns)
    assert sorted(fast.collect(), key=repr) == sorted(slow.collect(), key=repr)


def test_empty_sources(spark):
    from corpreg.operators.risk import risk_screen
    from corpreg.sources import fixtures

    s1 = spark.createDataFrame([], "corporate_name_S1 string, address string, activity_places string, top_suppliers string")
    s2 = spark.createDataFrame([], "corporate_name_S2 string, main_customers string, revenue double, profit double")
    assert golden_records(s1, s2).count() == 0
    one = spark.createDataFrame([("Acme Inc.", None, 1.0, 0.1)], s2.schema)
    g = golden_records(s1, one).collect()
    assert len(g) == 1 and g[0]["corporate_name"] == "Acme Inc." and g[0]["address"] is None
    assert risk_screen(golden_records(s1, s2), fixtures.headline_feed(spark)).count() == 0
