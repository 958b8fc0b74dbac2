"""Neighbour search on hard vectors, fingerprints of repeating windows, and odd url rules."""

import random

import numpy as np
import pytest

from corpreg.llm import ann, decontam, url_filter
from corpreg.llm.textutil import mix


def test_very_large_and_very_small_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1.0, 1.0]), (3, [1e-200, 2e-200]), (4, [5e-324, 5e-324]), (5, [1e308, -1e308])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in ann.search(vectors, vectors.where("vec_id = 0"), k=5).orderBy("rank").collect()]
    assert [v for v, _ in got] == [2, 4, 3, 1, 5]
    assert [s for _, s in got] == [pytest.approx(x, abs=1e-15) for x in (1, 1, 3 / 10**0.5, 0.5**0.5, 0)]


def test_scores_are_those_of_the_original_vectors():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(50, 16)) * 3.7, rng.normal(size=(50, 16)) * 0.01
    cosine = lambda x, y: (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
    assert (cosine(a, b) == cosine(ann.scaled(a), ann.scaled(b))).all()


@pytest.mark.parametrize("clusters", [5, 100])
def test_tight_clusters_are_reached(clusters):
    rng = np.random.default_rng(clusters)
    middles = rng.normal(size=(clusters, 32))
    vectors = (middles[np.arange(2000) % clusters] + rng.normal(size=(2000, 32)) * 0.01).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = ann.Graph(vectors)
    asked = vectors[::20]
    found = graph.search(asked)
    scores = asked @ vectors.T
    recall = []
    for q, own in enumerate(found):
        want = np.argsort(-scores[q], kind="stable")[:6]
        recall.append(len(set(want.tolist()) & set(own[:12].tolist())) / 6)
    assert min(recall) > 0.3 and np.mean(recall) >= 0.9
    parts = ann.one_of_each_part(graph.levels[0][1])
    assert 1 <= len(parts) <= clusters


def test_queries_are_not_broadcast_and_go_once_to_every_bin(spark, monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.normal(size=(600, 8))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 20 = 0")
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, -2)
    want = {(i, r + 1, int(j)) for i in range(0, 600, 20) for r, j in enumerate(np.argsort(-cosine[i], kind="stable")[:5])}
    for bins, group in ((7, 131_072), (96, 4), (1, 1)):  # 120 shards or so; groups of queries
        monkeypatch.setattr(ann, "BINS", bins, raising=False)
        monkeypatch.setattr(ann, "BIN", 1_000, raising=False)
        monkeypatch.setattr(ann, "ASKED", group, raising=False)
        got = ann.search(vectors, asked, shard=5)
        assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "Broadcast" not in plan and "Join" not in plan  # the blocks of queries, repeated for every shard, were broadcast


def test_parts_of_a_graph():
    near = np.array([[1, -1], [0, -1], [3, 4], [2, -1], [2, -1], [-1, -1], [7, -1], [8, -1], [7, 6]])
    assert ann.one_of_each_part(near).tolist() == [0, 2, 5, 6]


@pytest.mark.parametrize("size", [1, 3, 10, 40])
def test_window_sums_number_the_occurrences_within_each_window(size):
    rng = np.random.default_rng(size)
    shingles = mix(rng.integers(0, 4, 40).astype(np.uint64))
    got = decontam.window_sums(shingles, size)
    for s in range(len(shingles) - size + 1):
        seen, total = {}, np.zeros(64, int)
        for x in shingles[s : s + size]:
            n = seen[int(x)] = seen.get(int(x), -1) + 1
            total += decontam.bit_signs(decontam._numbered(np.array([x]), np.array([n])))[0]
        assert (got[s] == total).all()


def test_windows_with_a_repeated_word_are_found(spark):
    """An item cut off at 85 % and filled up with one repeated word stays within the radius."""
    rng = random.Random(3)
    items, docs, want = [], [], set()
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(100)]
        items.append((i, " ".join(words)))
        docs.append((i, " ".join([*(f"x{rng.randrange(5000)}" for _ in range(30)), *words[:92], *["again"] * 8, *(f"y{rng.randrange(5000)}" for _ in range(30))])))
        want.add((i, i))
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want & {(r[0], r[1]) for r in got}) >= 59


def test_long_texts_are_judged_in_parts(monkeypatch):
    rng = random.Random(4)
    item = " ".join(f"w{rng.randrange(300)}" for _ in range(30))
    text = " ".join(rng.choice([item, " ".join(f"w{rng.randrange(300)}" for _ in range(20))]) for _ in range(40))
    bench = decontam.Benchmark([(1, item)])
    want = bench.matches([text])
    monkeypatch.setattr(decontam, "STARTS_AT_ONCE", 7)
    assert bench.matches([text]) == want and want[0]


def test_rules_are_checked_alike_and_lowered_in_ascii_only(spark):
    pages = spark.createDataFrame([(1, "http://K.example/a"), (2, "http://\u212a.example/a"), (3, "http://\u0130x/")], "page_id long, url string")
    ddl = "host string, path string, verdict string"
    rules = spark.createDataFrame([("K.EXAMPLE", "/a", "block"), ("\u0130X", None, "block")], ddl)
    for judge in (url_filter.filter_urls, url_filter.filter_urls_joined):
        assert {r["page_id"]: r["verdict"] for r in judge(pages, rules).collect()} == {1: "block", 2: "allow", 3: "block"}
        for wrong in ((None, "/", "block"), ("", "/", "block"), ("a", "/", None), ("a", "/", "deny")):
            with pytest.raises(ValueError):
                judge(pages, rules.unionByName(spark.createDataFrame([wrong], ddl)))
