"""The trained operators against plain forms: a scan of all patterns, an unrolled network, exact cuts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpreg.llm import langid, lm, toxicity

DOCS = "doc_id long, text string"


def plain_evidence(text, lexicon):
    """Every pattern looked for at every place of the folded text."""
    folded = toxicity.fold(text)
    words = folded.split()
    if not words:
        return 0.0, 0.0, 0
    cancelled = set()
    for phrase in lexicon.exceptions:
        for at in range(len(folded)):
            if folded.startswith(phrase, at):
                cancelled.update(range(at, at + len(phrase) - 1))
    found = []
    for at in range(len(folded)):
        own = [p for p in lexicon.weights if p not in lexicon.exceptions and folded.startswith(p, at)]
        if own and at not in cancelled:
            found.append(lexicon.weights[max(own, key=len)])
    return sum(found), max(found, default=0.0), len(words)


@pytest.mark.parametrize("seed", range(3))
def test_matches_equal_a_scan_of_all_patterns(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(30)]
    weights = {f" {s} ": rng.random() + 0.1 for s in stems[:15]} | {f" {s}": rng.random() + 0.1 for s in stems[10:]}
    phrases = [f" {rng.choice(stems)} {rng.choice(stems)} " for _ in range(5)]
    lexicon = toxicity.Lexicon(weights, phrases)
    matcher = lexicon.matcher()
    for _ in range(200):
        text = " ".join(rng.choice(stems) + rng.choice(["", "", "a", "bc", "!", "1"]) for _ in range(rng.randint(0, 25)))
        got, want = toxicity.evidence(text, matcher), plain_evidence(text, lexicon)
        assert got[2] == want[2] and got[0] == pytest.approx(want[0]) and got[1] == pytest.approx(want[1])


def test_batches_without_patterns(spark):
    rows = spark.createDataFrame([("99 !", 1), (None, 0), ("", 0), ("word", 1)], "text string, toxic int").repartition(4)
    assert toxicity._counted(rows, lambda folded: set()).collect() == []
    assert [tuple(r) for r in toxicity._counted(rows, lambda folded: set(folded.split())).collect()] == [("word", 1, 0)]
    lexicon = toxicity.learn(rows.where("text is null or text <> 'word'"))
    docs = spark.createDataFrame([(1, "99 !"), (2, None), (None, "x")], DOCS)
    assert {r["predicted"] for r in toxicity.score_documents(docs, lexicon).collect()} <= {0, 1}
    assert toxicity.score_documents(docs.where("false"), lexicon).collect() == []
    none = toxicity.learn(toxicity.sample(docs.where("false"), spark.createDataFrame([], "doc_id long, toxic int")))
    assert none.weights == {}


def test_toxicity_sample_holds_an_id_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, f"t{i}") for i in range(2, 2000)], DOCS)
    marks = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(1, 0)] * 50, "doc_id long, toxic int")
    got = toxicity.sample(docs, marks, rows=300).collect()
    assert 100 < len(got) < 400 and sum(r["text"].startswith("text") for r in got) <= 1
    assert toxicity.sample(docs, marks, rows=10_000).count() == 1999


def unrolled(model, text):
    """Document probabilities by one byte, one gate and one run at a time."""
    p, total, n = model.params, np.zeros(len(model.languages)), 0
    hidden = len(p["rec_f"])
    sig = lambda v: 1 / (1 + np.exp(-v))
    for part in text.split():
        raw = part.encode("utf-8", "surrogatepass")
        for at in range(0, len(raw), langid.MAX_RUN):
            data = b" " + raw[at : at + langid.MAX_RUN] + b" "
            states = {}
            for side, order in (("f", range(len(data))), ("b", reversed(range(len(data))))):
                h = np.zeros(hidden)
                for t in order:
                    x, hh = p[f"in_{side}"][data[t]].astype(float), h @ p[f"rec_{side}"].astype(float)
                    z, r = sig(x[:hidden] + hh[:hidden]), sig(x[hidden : 2 * hidden] + hh[hidden : 2 * hidden])
                    c = np.tanh(x[2 * hidden :] + r * hh[2 * hidden :])
                    h = z * h + (1 - z) * c
                    states[side, t] = h
            for t in range(len(data)):
                logits = np.concatenate([states["f", t], states["b", t]]) @ p["out"] + p["bias"]
                total += logits - np.log(np.exp(logits).sum())
                n += 1
    probs = np.exp(total / n)
    return probs / probs.sum()


def test_document_scores_equal_an_unrolled_network(monkeypatch):
    monkeypatch.setattr(langid, "CACHE_RUNS", 5)  # the sums are dropped again and again
    model = langid.ByteTagger.fresh(["aa", "bb", "cc"], 6, 3)
    held = langid.Predictor(model)
    texts = ["one two two", "ä ö   ü", "x" * 200 + " y", "日本語のテキスト" * 20, "a", "b c d e f g h i j"]
    got = held.predict([*texts, None, "", "12 !"])
    for text, lang, score in zip(texts, got["lang_pred"], got["score"]):
        want = unrolled(model, text)
        assert lang == model.languages[int(want.argmax())] and abs(score - want.max()) < 1e-4
    assert got["lang_pred"].tolist()[len(texts) :] == ["und"] * 3 and got["score"].tolist()[len(texts) :] == [0.0] * 3


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(2)
    words = lambda abc, n: " ".join("".join(rng.choice(abc) for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = [(i, words("abcdefgh", 300), "aa") for i in range(100)] + [(1000 + i, "zyx", "bb") for i in range(100)] + [(2000 + i, "日本語文章" * 30, "cc") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_runs(frame, runs=2000).collect()
    sizes = {lang: sum(r["lang"] == lang for r in sample) for lang in ("aa", "bb", "cc")}
    assert sizes["bb"] == 1 and 1 <= sizes["cc"] <= 15 and sum(sizes.values()) == 2000
    assert max(len(r["run"]) for r in sample) <= langid.MAX_RUN
    model = langid.train(frame, runs=2000)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(frame, model).collect()}
    assert model.languages == ["aa", "bb", "cc"] and np.mean([got[i] == lang for i, _, lang in rows]) > 0.95
    assert langid.identify(frame.where("false"), model).collect() == []


def test_quotas():
    assert langid.quotas({"a": 1, "b": 1000, "c": 1000}, 101) == {"a": 1, "b": 50, "c": 50}
    assert langid.quotas({"a": 5, "b": 6}, 100) == {"a": 5, "b": 6}
    assert langid.quotas({"a": 5, "b": 6, "c": 7}, 2) == {"a": 1, "b": 1, "c": 1}


@pytest.mark.parametrize("head", [0, 1, 7, 40, 100, 5000])
def test_most_frequent_words_fit_the_bound(spark, head):
    rng = random.Random(head)
    counts = {f"w{i}": int(10_000 / (i + 1)) + rng.randint(1, 2) for i in range(1500)}
    frame = spark.createDataFrame(list(counts.items()), "word string, c long")
    got = {r["word"]: r["c"] for r in lm.most_frequent(frame, head).collect()}
    assert len(got) <= head and all(counts[w] == c for w, c in got.items())
    if head >= len(counts):
        assert got == counts
    elif got:
        rest = max(c for w, c in counts.items() if w not in got)
        assert min(got.values()) * 1.03 >= rest  # equal up to one step of the histogram
    same = spark.createDataFrame([(f"w{i}", 3) for i in range(1000)], "word string, c long")
    assert min(head, 1000) * 0.9 - 30 <= lm.most_frequent(same, head).count() <= head
    assert lm.most_frequent(frame.where("false"), head).collect() == []


def test_class_outputs_are_computed_in_bounded_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    model = lm.ClassModel.fresh(rng.integers(1, 90, 23).astype(float), hidden=4)
    states, sizes, log_softmax = rng.normal(size=(30, 4)).astype(np.float32), [], lm._log_softmax
    whole = model.log_probs(np.repeat(states, 23, 0), np.tile(np.arange(23), 30))
    monkeypatch.setattr(lm, "_AT_ONCE", 7, raising=False)
    monkeypatch.setattr(lm, "_log_softmax", lambda x: sizes.append(len(x)) or log_softmax(x))
    parts = model.log_probs(np.repeat(states, 23, 0), np.tile(np.arange(23), 30))
    assert max(sizes) <= 7
    assert np.allclose(whole, parts, atol=1e-5) and np.allclose(np.exp(parts).reshape(30, 23).sum(1), 1, atol=1e-4)
    targets = rng.integers(0, 23, 30)
    _, grads, d_states = model.gradients(states, targets)
    for array, grad, at in ((model.params["word"], grads["word"], (1, 2, 1)), (model.params["word_bias"], grads["word_bias"], (0, 2)), (states, d_states, (4, 1))):
        kept, losses = array[at], []
        for move in (1e-2, -1e-2):
            array[at] = kept + np.float32(move)
            losses.append(-model.log_probs(states, targets).mean())
        array[at] = kept
        assert abs((losses[0] - losses[1]) / 2e-2 - grad[at]) < 1e-3


def test_language_model_of_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert lm.score_documents(none, F.lit(True), F.lit(False)).collect() == []


def test_language_model_learns_from_every_training_row(spark, monkeypatch):
    rows, learned = spark.range(3000).selectExpr("id AS doc_id", "concat('word ', id % 7) AS text"), []
    monkeypatch.setattr(lm, "learn", lambda sample, model, tasks, **options: learned.append((sample.count(), tasks)))
    lm.train(rows, lm.token_counts(rows))
    assert learned == [(3000, 3)]
