"""Packing, formatting, search, filters and the trained models."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpreg.llm import ann, gru, langid, lm, packing, preference, queries, toxicity, url_filter

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_best_fit_decreasing(seed):
    rng, capacity = random.Random(seed), 50
    lengths = [rng.randint(1, capacity) for _ in range(400)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = packing.best_fit_plan(counts, capacity)
    room: list[int] = []
    for n in sorted(lengths, reverse=True):  # one by one
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(capacity - n)
    used: dict[int, int] = {}
    for n, total in counts.items():
        own = steps[steps[:, 0] == n]
        for k in range(total):
            s = own[np.searchsorted(own[:, 1], k, "right") - 1]
            q, at = s[2] + (k - s[1]) // s[3], s[4] + (k - s[1]) % s[3] * n
            assert at + n <= capacity
            used[q] = used.get(q, 0) + n
    assert sorted(capacity - u for u in used.values()) == sorted(room)


def test_pack_places_every_token_once(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Apple", "pear,", "l'été", "x1y", "don't", "Straße!?", "...", "ΣΑΣ", "ﬁne", "it's"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "a\x1cb \x1d c", "<|endoftext|> z", texts[0], "word " * 500]
    rows = [(i % 50 if i < 64 else None, t) for i, t in enumerate(texts)]
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(4), queries.tokenizer_file(), capacity=64, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k // 64, k, tuple(ids[k : k + 64])) for k in range(0, len(ids), 64)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in got), key=str) == sorted(want, key=str)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) for r in got)
    by: dict = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack(spark.createDataFrame([], DOCS), queries.tokenizer_file()).collect() == []


def test_preferences_with_nulls_ties_and_prefixes(spark, tmp_path):
    rows = [
        (0, 0, "system", "s"), (0, 1, "user", "a"), (0, 2, "assistant", "b"), (0, 3, "user", "c"), (1, 0, "user", "x"), (1, 1, "assistant", "y <|user|>"),
        (2, 0, "user", None), (2, None, None, "t"), (2, 1, "assistant", None), (2, 1, "assistant", "tie"), (4, 0, "user", "alone"), (5, 0, "assistant", ""), (None, 0, "user", "n"), (6, 0, "user", "q"), (6, 1, "assistant", "é"), (7, 0, "assistant", "é"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.withColumn("chosen", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op5_preference_pairs(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op5_preference_pairs"])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
    by = {r["pair_id"]: r for r in got.collect()}
    assert by[0]["prompt_turns"] == 2 and by[0]["rejected"] == "<|assistant|>\ny < |user|><|end|>\n"
    a, b = map(int, by[0]["chosen_spans"].split("-"))
    assert by[0]["chosen"][a:b] == "b<|end|>\n"
    assert by[4]["chosen"] == by[4]["rejected"] == "" and by[4]["prompt_turns"] == 1
    empty = preference.format_pairs(preference.swapped_reply_pairs(frame.where("false")))
    assert empty.collect() == []
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_neighbours_against_brute_force(spark, sf_small):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    got = ann.search(vectors, vectors.where("vec_id % 50 = 0"), shard=400).collect()
    rows = vectors.orderBy("vec_id").collect()
    ids, raw = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    cosine = (raw @ raw.T) / np.outer(np.linalg.norm(raw, axis=1), np.linalg.norm(raw, axis=1))
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        order = [j for j in np.lexsort((ids, -cosine[i])) if j != i][:5]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == ids[i])
        assert [r[0] for r in own] == [1, 2, 3, 4, 5] and all(abs(s - cosine[i, np.flatnonzero(ids == v)[0]]) < 1e-12 for _, v, s in own)
        hits, total = hits + len({r[1] for r in own} & set(ids[order].tolist())), total + 5
    assert hits / total >= 0.95


def test_neighbours_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows + [(100 + i, [1.0, 0.0]) for i in range(200)], "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(vectors, vectors.where("vec_id % 50 = 0")).collect())
    assert [g for g in got if g[0] == 0] == [(0, k + 1, v) for k, v in enumerate([1, 2, 100, 101, 102])]
    assert [g for g in got if g[0] == 50] == [(50, k + 1, v) for k, v in enumerate([0, 1, 2, 100, 101])] or [g[2] for g in got if g[0] == 50][0] in (0, 3)
    assert not [g for g in got if g[2] in (4, 5, 6, 7, 8, 9, 10)] and ann.search(vectors.where("false"), vectors).collect() == []


def test_url_filter_against_rules_one_by_one(spark):
    hosts = ["net", "a.net", "xnet", "Example.NET", "example.com", "m.example.com", "org", "b.org", "", "net.", "user@net:80"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/", "?q=/fr/", "#/", "/EN/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "x://y://", "", "://") for h in hosts for p in paths] + [None, "", "://", "nothing"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] + [(None, urls[0], "old")], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    con = duckdb.connect()
    frame = pages.toPandas()  # noqa: F841
    con.sql("create view pages as select * from frame")
    want = sorted((tuple(r) for r in con.sql(queries.ORACLE_SQL["op9_url_digest_filter"]).fetchall()), key=str)
    for judge in (url_filter.filter_urls, url_filter.filter_urls_joined):
        got = judge(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()
        assert sorted(((None if r[0] is None else int(r[0]), *r[1:]) for r in got), key=str) == sorted(((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in want), key=str)
    assert url_filter.filter_urls(pages.where("false"), rules).collect() == []
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.where("false")).collect()} == {"allow"}


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda raw: len(raw) % 3)
    path = str(tmp_path / "list")
    url_filter.write_digest_file([("a.com", "/", "block"), ("b.com", "/", "allow"), ("c.com", "/x", "block")], path)
    held = url_filter.DigestFile(path)
    assert held.judge(["a.com", "b.com", "c.com", "d.com"], ["/", "/", "/x", "/"]) == [("a.com/", "block"), ("b.com/", "allow"), ("c.com/x", "block"), (None, None)]


def test_gru_gradients_are_right():
    rng = np.random.default_rng(0)
    x, h, w = rng.normal(size=(5, 3, 12)), np.zeros((3, 4)), rng.normal(size=(4, 12)) * 0.5
    mask, target = np.array([[1, 1, 1], [1, 1, 1], [1, 0, 1], [1, 0, 1], [1, 0, 0]], bool), rng.normal(size=(5, 3, 4))
    loss = lambda a, b: (gru.forward(a, mask, h, b)[0].astype(float) * target).sum()
    _, kept = gru.forward(x, mask, h, w)
    d_x, d_w = gru.backward(target, mask, kept, w)
    for value, grad in ((x, d_x), (w, d_w)):
        for _ in range(10):
            at = tuple(rng.integers(0, n) for n in value.shape)
            old = value[at]
            value[at] = old + 1e-2
            up = loss(x, w)
            value[at] = old - 1e-2
            down = loss(x, w)
            value[at] = old
            assert abs((up - down) / 2e-2 - grad[at]) < 5e-3


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(None, "the the", None, None, None), (-1, None, "en", None, None), (-2, "", "en", None, None), (-3, "123 !!", "en", None, None), (-4, "x" * 5000, None, None, None)], docs.schema)
    docs = docs.unionByName(odd).withColumn("lang_pred", F.lit("old"))
    model = langid.train(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(4, 2)).select("doc_id", "text", "lang"))
    got = langid.identify(docs, model).select("doc_id", "lang", "lang_pred", "score", langid.held_out(4, 2).alias("h")).collect()
    held = [r for r in got if r["h"] and r["lang"]]
    assert len(held) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {-1, -2, -3}
    none = langid.train(docs.where("false").select("doc_id", "text", "lang"))
    assert none is None and {r["lang_pred"] for r in langid.identify(docs.limit(5), none).collect()} == {"und"}


def test_folding():
    assert toxicity.fold("1D10T!") == " idiot " and toxicity.fold("ѕtuріd") == " stupid "
    assert toxicity.fold("Ｓｃｕｍ tr​ash, é 99") == " scum trash e " and toxicity.fold(None) == " " == toxicity.fold("99 !")


def test_toxicity_held_out_exceptions_and_edges(spark):
    rng = random.Random(3)
    plain = "green table walks under seven quiet rivers while paper birds count slow trains".split()
    rows, labels = [], []
    for i in range(900):
        words, bad = [rng.choice(plain) for _ in range(rng.randint(3, 60))], i % 6 == 0
        if bad:
            words.insert(rng.randint(0, len(words)), rng.choice(["morblin", "gr4ble", "zonkering", "zonkers"]))
        elif i % 6 == 1:
            words += ["morblin", "county"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "a zonkering")]
    labels += [(None, 1), (2000, None), (2001, 7), (5, 0)]
    docs, marks = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn(toxicity.sample(docs, marks.where(~langid.held_out(5, 0))), added={"blarg": 9.0}, exceptions=["blarg festival"])
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, lexicon).withColumn("h", langid.held_out(5, 0)).collect()}
    held = [got[i]["predicted"] == y for i, y in labels[:900] if got[i]["h"]]
    assert len(held) > 100 and np.mean(held) > 0.97
    assert got[2000]["predicted"] == got[2001]["predicted"] == 0 and got[None]["predicted"] == 1
    matcher = lexicon.matcher()
    assert toxicity.score("you BLARG you", matcher, lexicon.curve) > 0.5 > toxicity.score("the blarg festival", matcher, lexicon.curve)
    empty = toxicity.learn(toxicity.sample(docs, marks.where("false")))
    assert {r["predicted"] for r in toxicity.score_documents(docs, empty).collect()} == {0}


def test_language_model_is_a_distribution_and_beats_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, "the of"), (900, None), (901, ""), (902, "neverseen neverseen")], DOCS))
    held = langid.held_out(10, 0)
    got = {r["doc_id"]: r for r in lm.score_documents(docs, F.col("doc_id").isNotNull() & ~held, held, head=300, vocabulary=100, epochs=1).collect()}
    counts: dict = {}
    texts = [tuple(r) for r in docs.collect()]
    for i, t in texts:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            for w in [*lm.words(t), b""]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, t in texts:
        own = [*lm.words(t), b""]
        want = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), n) and abs(r["base_score"] - want) < 1e-6
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 10 == 0)
    assert got[900]["n_tokens"] == got[901]["n_tokens"] == 1 and np.mean([r["score"] > r["base_score"] for r in got.values()]) > 0.9
    network = lm.ClassModel.fresh(np.arange(10.0), hidden=4)
    state = np.random.default_rng(1).normal(size=(1, 4)).astype(np.float32)
    assert abs(np.exp(network.log_probs(np.repeat(state, 10, 0), np.arange(10))).sum() - 1) < 1e-5
    assert {r["base_score"] for r in lm.score_documents(docs.limit(3), F.lit(False), held).collect()} == {0.0}


def test_language_model_learns_from_long_texts_and_a_growing_share(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(["ab", "cd", "ef", "gh"] * 3500) for _ in range(6)]  # all over 32 KB
    rows = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = lm.score_documents(rows, F.lit(True), F.lit(False), vocabulary=10).collect()
    assert all(r["score"] > 0.5 * r["base_score"] for r in got)  # the order of the words was learned
    seen = []
    monkeypatch.setattr(lm, "learn", lambda sample, model, tasks, **o: seen.append((sample.count(), tasks)))
    for n in (50, 400, 1600):
        rows = spark.createDataFrame([(i, " ".join(rng.choice(["a", "b"]) for _ in range(5))) for i in range(n)], DOCS)
        lm.train(rows, lm.token_counts(rows), docs=50, share=0.5)
    assert seen[0] == (50, 1) and 150 < seen[1][0] < 250 and 700 < seen[2][0] < 900 and [t for _, t in seen] == [1, 4, 16]


def test_windows_of_the_language_model_do_not_change_scores():
    rng = np.random.default_rng(2)
    network = lm.ClassModel.fresh(np.arange(20.0), hidden=6)
    docs = [rng.integers(0, 20, n) for n in (1, 7, 30, 30, 3)]
    one, many = network.score(docs), network.score(docs, states_at_once=5)
    assert np.allclose(one, many) and np.allclose(one, [network.score([d])[0] for d in docs], atol=1e-4)
