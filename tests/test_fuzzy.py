import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpreg.operators import fuzzy
from corpreg.operators.golden import golden_from_harmonized, golden_records
from corpreg.params import S1_NAME, S2_NAME, Params
from corpreg.plans.oracle import oracle_sql
from corpreg.sources import fixtures
from tools.oracle_check import duck


def duck_rows(name, sf_dir):
    """Rows of a query's SQL on DuckDB."""
    return duck(sf_dir).execute(f"SELECT count(*) FROM ({oracle_sql()[name]})").fetchall()[0][0]


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def brute(a_names, b_names, k):
    return {(a, b) for a in set(a_names) for b in set(b_names) if lev(a, b) <= k}


def spark_pairs(spark, a_names, b_names, k):
    a = spark.createDataFrame([(x,) for x in set(a_names)], "name string")
    b = spark.createDataFrame([(x,) for x in set(b_names)], "name string")
    return {(r["a"], r["b"]) for r in fuzzy.similar_pairs(a, b, k).collect()}


def mutate(s, rng, k):
    s = list(s)
    for _ in range(rng.randint(0, k + 1)):
        op = rng.randint(0, 2)
        pos = rng.randint(0, len(s))
        if op == 0:
            s.insert(pos, rng.choice("abc "))
        elif s and op == 1:
            s.pop(min(pos, len(s) - 1))
        elif s:
            s[min(pos, len(s) - 1)] = rng.choice("abc ")
    return "".join(s)


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_segment_join_equals_brute_force(spark, k):
    rng = random.Random(7 + k)
    base = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    a = base + [mutate(s, rng, k) for s in base]
    b = [mutate(s, rng, k) for s in base] + ["", "a", "ab"]
    assert spark_pairs(spark, a, b, k) == brute(a, b, k)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.text(alphabet="ab c", max_size=9), min_size=1, max_size=12),
    st.lists(st.text(alphabet="ab c", max_size=9), min_size=1, max_size=12),
)
def test_segment_join_property(spark, a, b):
    assert spark_pairs(spark, a, b, 2) == brute(a, b, 2)


def test_full_outer_equals_theta_join(spark, sf_small):
    s1 = fixtures.supply_chain(spark, sf_small)
    s2 = fixtures.financial(spark, sf_small)
    fast = fuzzy.fuzzy_full_outer(s1, s2)
    slow = fuzzy.fuzzy_full_outer_naive(s1, s2)
    cols = sorted(fast.columns)
    assert sorted(fast.select(cols).collect(), key=repr) == sorted(slow.select(cols).collect(), key=repr)
    assert fast.count() == duck_rows("fuzzy_full_outer", sf_small)


def test_full_outer_makes_the_rows_of_a_hot_name_in_many_tasks(spark, monkeypatch):
    # every second row is the same, the rest differ; one name has a close partner, others have none
    s1 = [("Acme Inc.", f"{i % 2 * i} Main St", None, "Alpha") for i in range(300)] + [("Lonely LLC", None, None, None), (None, "x", None, None)]
    s2 = [("ACME LLC", "Apple", float(i % 2 * i), None) for i in range(200)] + [("Acmee Co.", None, 1.0, 0.5), ("Nowhere Corp.", "Ford", None, None), (None, "y", None, None)]
    s1 = spark.createDataFrame(s1, f"{S1_NAME} string, address string, activity_places string, top_suppliers string")
    s2 = spark.createDataFrame(s2, f"{S2_NAME} string, main_customers string, revenue double, profit double")
    monkeypatch.setattr(fuzzy, "BLOCK_ROWS", 16, raising=False)
    slow = fuzzy.fuzzy_full_outer_naive(s1, s2)
    want = sorted(slow.collect(), key=repr)
    assert len(want) == 300 * 201 + 2
    for pairs in (None, fuzzy.fuzzy_pairs(s1, s2)):
        fast = fuzzy.fuzzy_full_outer(s1, s2, pairs)
        assert fast.columns == slow.columns and sorted(fast.collect(), key=repr) == want
        parts = [r["count"] for r in fast.groupBy(F.spark_partition_id()).count().collect()]
        assert max(parts) < sum(parts) / 3  # in one task before


def test_pairs_plan_has_no_nested_loop(spark, sf_small):
    s1 = fixtures.supply_chain(spark, sf_small)
    s2 = fixtures.financial(spark, sf_small)
    plan = fuzzy.fuzzy_pairs(s1, s2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_min_name_length(spark):
    a = spark.createDataFrame([("ab",), ("abcdef",)], "corporate_name_S1 string")
    b = spark.createDataFrame([("ab",), ("abcdeg",), ("",)], "corporate_name_S2 string")
    got = {tuple(r) for r in fuzzy.fuzzy_pairs(a, b, Params(min_name_length=3)).collect()}
    assert got == {("ab", "ab"), ("abcdef", "abcdeg")}
    got0 = {tuple(r) for r in fuzzy.fuzzy_pairs(a, b, Params()).collect()}
    assert ("ab", "") in got0


def test_golden_equals_window_over_full_outer(spark, sf_small):
    s1 = fixtures.supply_chain(spark, sf_small)
    s2 = fixtures.financial(spark, sf_small)
    fast = golden_records(s1, s2)
    slow = golden_from_harmonized(fuzzy.fuzzy_full_outer_naive(s1, s2))
    assert sorted(fast.collect(), key=repr) == sorted(slow.select(fast.columns).collect(), key=repr)
    assert fast.count() == duck_rows("golden_records", sf_small)


def test_golden_independent_of_partitioning(spark, sf_small):
    s1 = fixtures.supply_chain(spark, sf_small)
    s2 = fixtures.financial(spark, sf_small)
    a = sorted(golden_records(s1, s2).collect(), key=repr)
    b = sorted(golden_records(s1.repartition(7), s2.repartition(3)).collect(), key=repr)
    assert a == b


def test_index_side_does_not_change_pairs(spark):
    rng = random.Random(11)
    a = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 10))) for _ in range(80)]
    b = [mutate(s, rng, 2) for s in a[:50]] + ["", "b"]
    n1 = spark.createDataFrame([(x,) for x in set(a)], "name string")
    n2 = spark.createDataFrame([(x,) for x in set(b)], "name string")
    p1 = {tuple(r) for r in fuzzy.fuzzy_pairs_of_names(n1, n2, Params(), 1).collect()}
    p2 = {tuple(r) for r in fuzzy.fuzzy_pairs_of_names(n1, n2, Params(), 2).collect()}
    assert p1 == p2 == brute(a, b, 2)


@pytest.mark.parametrize("k", [1, 2])
def test_all_short_strings_exhaustive(spark, k):
    from itertools import product

    def upto(n):
        return ["".join(p) for m in range(n + 1) for p in product("ab ", repeat=m)]

    a, b = upto(k + 1), upto(2 * k)
    assert spark_pairs(spark, a, b, k) == brute(a, b, k)


def test_salted_segment_join_equals_brute_force(spark):
    rng = random.Random(5)
    a = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 9))) for _ in range(70)]
    b = [mutate(s, rng, 2) for s in a] + ["", "a"]
    n1 = spark.createDataFrame([(x,) for x in set(a)], "name string")
    n2 = spark.createDataFrame([(x,) for x in set(b)], "name string")
    got = {tuple(r) for r in fuzzy.similar_pairs(n1, n2, 2, salt=4).collect()}
    assert got == brute(a, b, 2)
    via_params = {tuple(r) for r in fuzzy.fuzzy_pairs_of_names(n1, n2, Params(segment_salt_buckets=3)).collect()}
    assert via_params == got


def names_that_share_words(n, seed):
    rng = random.Random(seed)
    return ["global logistics holdings " + "".join(rng.choice("0123456789abcdef") for _ in range(10)) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 2])
def test_long_names_equal_brute_force(spark, k):
    """Names long enough for more than k+1 segments, with edits at every place."""
    rng = random.Random(23)
    a = names_that_share_words(40, 1) + ["".join(rng.choice("abc ") for _ in range(rng.randint(9, 40))) for _ in range(60)]
    b = [mutate(s, rng, k) for s in a for _ in range(3)]
    assert spark_pairs(spark, a, b, k) == brute(a, b, k)


def test_candidates_of_names_that_share_words(spark):
    """What all names have in common is no key, and the rest counts twice: candidates
    stay far below all pairs."""
    found = {}
    for n in (500, 2000):
        a = spark.createDataFrame([(x,) for x in names_that_share_words(n, 1)], "name string")
        b = spark.createDataFrame([(x,) for x in names_that_share_words(n, 2)], "name string")
        found[n] = fuzzy.candidate_pairs(a, b, 2).distinct().count()
        assert found[n] < n * n / 5000
    assert found[2000] < 20 * max(found[500], 10)


def test_candidates_of_the_sources_follow_the_pairs(spark):
    """On the sources at sf0.01 and sf0.1 candidates stay near the pairs, and grow as the names do."""
    found = {}
    for sf in ("sf0.01", "sf0.1"):
        s1, s2 = (f(spark, f"/root/testdata/{sf}") for f in (fixtures.supply_chain, fixtures.financial))
        n1, n2 = (fuzzy._norms(s, c, Params()).persist() for s, c in ((s1, S1_NAME), (s2, S2_NAME)))
        found[sf] = fuzzy.candidate_pairs(n1, n2, 2).distinct().count(), fuzzy.similar_pairs(n1, n2, 2).count(), n1.count()
        n1.unpersist(), n2.unpersist()
    assert all(c < 3.2 * p for c, p, _ in found.values())
    growth = [b / a for a, b in zip(*found.values())]
    assert growth[0] < 1.3 * growth[2]


def test_one_name_of_each_side_shares_no_segment_with_others(spark):
    """Equal segments everywhere (ties in rarity) still leave k+1 to meet on."""
    a = ["ab" * n for n in range(1, 16)]
    b = ["ab" * n + "a" for n in range(16)] + ["ba" * n for n in range(1, 16)]
    assert spark_pairs(spark, a, b, 2) == brute(a, b, 2)
