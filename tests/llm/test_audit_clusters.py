"""Centroid clustering and the filter audit against plain-Python statements of their rules."""

import hashlib
import math
import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from corpreg.llm import centroids, filter_audit, queries

VECTORS = "vec_id long, embedding array<float>, cluster int, inertia string"


def plain_clusters(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for vec_id, x, *_ in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            own = [math.floor(scale * float(np.float32(v))) for v in x]
            if max(map(abs, own)) < centroids.LIMIT:
                kept.append((vec_id, own))
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in first]
    for n in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, own)), j) for j, own in enumerate(c)) for _, v in kept] if c else []
        if n < rounds:
            for j in range(len(c)):
                of = [v for (_, v), (_, at) in zip(kept, near) if at == j]
                if of:
                    c[j] = [sum(p) // len(of) for p in zip(*of)]
    if not c:
        return []
    total = sum(d for d, _ in near)
    per = [sum(d for d, at in near if at == j) for j in range(len(c))]
    digest = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c]
    return [(i, j, d, per[j], total, digest[j]) for (i, _), (d, j) in zip(kept, near)]


def clustered(spark, rows, parts=4, **options):
    made = spark.createDataFrame(rows, VECTORS).repartition(parts)
    return [tuple(r) for r in centroids.cluster(made, **options).collect()]


def some_vectors(n, seed=3, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (6, 64))
    return [(int(i), [float(v) for v in middles[i % 6] + rng.normal(0, spread, 64)], 7, "x") for i in range(n)]


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_clusters_equal_brute_force(spark, spread):
    rows = some_vectors(150, spread=spread)
    rows += rows[:9] * 3  # repeated rows
    rows += [(900, None, 1, None), (901, [0.5] * 63, 1, ""), (902, [None, *[0.5] * 63], 1, ""), (903, [float("nan")] * 64, 1, ""), (904, [float("-inf")] * 64, 1, "")]
    rows += [(None, [0.25] * 64, 1, "a"), (905, [0.0] * 64, 1, ""), (906, [-1e-9] * 64, 1, ""), (907, [3e6] * 64, 1, "")]
    assert sorted(clustered(spark, rows), key=repr) == sorted(plain_clusters(rows), key=repr)


def test_ties_few_vectors_and_empty_tables(spark):
    same = [(i, [1.0] * 64, 0, "") for i in range(30)]  # all centroids alike: the smallest number wins
    got = clustered(spark, same)
    assert sorted(got) == sorted(plain_clusters(same)) and {r[1] for r in got} == {0}
    few = some_vectors(5)
    assert sorted(clustered(spark, few)) == sorted(plain_clusters(few))
    assert clustered(spark, []) == [] and clustered(spark, [(1, [1.0], 0, "")]) == []
    assert clustered(spark, [(None, [1.0] * 64, 0, "")]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.uniform(-2e6, 2e6))) for _ in range(64)], 0, "") for i in range(40)]
    assert sorted(clustered(spark, rows)) == sorted(plain_clusters(rows))


def test_only_changed_components_are_added():
    rng = np.random.default_rng(1)
    values, before = rng.integers(-500, 500, (200, 64)), rng.integers(-500, 500, (16, 64))
    after = before.copy()
    after[3, 5] += 7
    after[9, ::2] -= 1
    dots = before @ values.T
    dots = np.ascontiguousarray(dots.T)
    centroids.shift(dots, values, after - before)
    assert (dots == values @ after.T).all()
    still = dots.copy()
    centroids.shift(dots, values, np.zeros_like(before))
    assert (dots == still).all()
    big = rng.integers(-(1 << 26), 1 << 26, (20, 64))
    assert (centroids.exact_product(big, big.T) == big.astype(object) @ big.T.astype(object)).all()


def test_clusters_on_the_smallest_tables(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_small}/embeddings.parquet')")
    rows = con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    got = [tuple(r) for r in queries.op11_centroid_clusters(spark, sf_small).collect()]
    assert sorted(got) == sorted(plain_clusters(rows))


DOCS = "doc_id long, text string, source string, part string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int, n int"


def plain_failures(docs):
    smallest = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    out = []
    for doc_id, text, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        if len(words) < 50:
            fails += "A"
        if 100 * len(set(words)) < 65 * len(words):
            fails += "B"
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails += "C"
        if re.search(r"[#$%&*|]", text):
            fails += "D"
        if doc_id is not None and doc_id > smallest[text]:
            fails += "E"
        out.append(set(fails))
    return out


def plain_audit(docs, labels):
    good = {i for i, q, t, _ in labels if q == 1}
    toxic = {i for i, q, t, _ in labels if t == 1}
    fails, out = plain_failures(docs), {}
    for part in {s or "" for _, _, s, *_ in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                sums[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def some_documents(rng, n=120):
    words = ["alpha", "Beta", "GAMMA", "delta#", "été", "x|y", "中文", "q"]
    texts = [" ".join(rng.choice(words[: rng.randint(1, 8)]) + (str(rng.randint(0, 999)) if rng.random() < 0.7 else "") for _ in range(rng.randint(0, 90))) for _ in range(n // 3)]
    texts += [None, "", " \t\n\x0b\x0c\r ", " ", "A" * 40, "word " * 20_000, "\x85a\x1cb", "a b\x1fc"]
    return [(i if rng.random() < 0.9 else None, rng.choice(texts), rng.choice([None, "", "hot", "hot", "hot", "b"]), "z", 1, 2) for i in range(n)]


def test_audit_equals_brute_force(spark):
    rng = random.Random(8)
    docs = some_documents(rng)
    docs += docs[:10] + [(docs[0][0], "other text", "b", "z", 1, 2)]  # repeated rows, an id with two texts
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1]), 5) for i in range(0, 150, 2)] + [(4, 1, 0, 5), (4, 0, 1, 5), (None, 1, 1, 5)]
    got = filter_audit.audit(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == plain_audit(docs, [x for x in labels if x[0] is not None])
    assert filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    none = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    assert none.agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[:] == (0, 0)


def test_gray_walk_stores_the_survivors_of_every_subset():
    counts = np.random.default_rng(4).integers(0, 50, (3, 2, 32))
    states = filter_audit.survivors(counts)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (states[..., subset] == counts[..., alive].sum(-1)).all()


def test_audit_plan_reads_texts_once_and_splits_hot_texts(spark):
    """All rows but one share one text: the join that finds copies has an id in its key."""
    docs = [(i, "same text", "hot", "", 0, 0) for i in range(500)] + [(1000, "other", "b", "", 0, 0)]
    got = filter_audit.cells(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "text" not in plan
    assert sorted(tuple(r) for r in got.collect()) == [("b", 1, 1, 0, 0), ("hot", 1, 1, 0, 0), ("hot", 17, 499, 0, 0)]
