"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a white-space separated run of the text
(between two space bytes; longer runs are cut every ``MAX_RUN`` bytes), from
both ends, and labels every byte with language probabilities. A document's
probabilities are the softmax of the mean log-probabilities of all its bytes.
The state starts anew at every run, so a run's sum of log-probabilities does
not depend on where it stands and is computed once for the runs seen lately.

It is trained in numpy by back-propagation through time, on a bounded,
hash-chosen sample of the labelled rows' runs (``TRAIN_DOCS`` documents and
``TRAIN_RUNS`` distinct runs, the same number of every language that has as many).

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
with no training rows everything is ``und`` with score 0; a single learned
language is always predicted with score 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from . import gru
from .textutil import bounded, release_memory, set_batch_rows

UND = "und"
MAX_RUN = 30
TRAIN_DOCS = 2_000
TRAIN_RUNS = 24_000
CACHE_RUNS, RUNS_AT_ONCE = 400_000, 2_048
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteTagger:
    """Parameters of the network and the languages of its outputs."""

    languages: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> ByteTagger:
        rng, params = np.random.default_rng(seed), {}
        for side in "fb":
            params[f"in_{side}"] = gru.uniform(rng, 256, 3 * hidden, scale=0.3)
            params[f"rec_{side}"] = gru.uniform(rng, hidden, 3 * hidden)
        params["out"] = gru.uniform(rng, 2 * hidden, len(languages))
        params["bias"] = np.zeros(len(languages), gru.FLOAT)
        return cls(languages, params)

    def _states(self, data: np.ndarray, mask: np.ndarray):
        p, n = self.params, len(self.params["rec_f"])
        start = np.zeros((data.shape[1], n), gru.FLOAT)
        ahead = gru.forward(p["in_f"][data], mask, start, p["rec_f"])
        back = gru.forward(p["in_b"][data[::-1]], mask[::-1], start, p["rec_b"])
        states = np.concatenate([ahead[0], back[0][::-1]], 2)
        return states, ahead[1], back[1]

    def _log_probs(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.params["out"] + self.params["bias"]
        logits -= logits.max(-1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(-1, keepdims=True))

    def learn(self, data: np.ndarray, mask: np.ndarray, label: np.ndarray, adam: gru.Adam, rate: float) -> float:
        """One step on a batch: cross-entropy of the label at every byte."""
        states, kept_f, kept_b = self._states(data, mask)
        log_probs = self._log_probs(states)
        weight = mask[..., None] / gru.FLOAT(mask.sum())
        wanted = np.eye(len(self.languages), dtype=gru.FLOAT)[label][None]
        d_logits = ((np.exp(log_probs) - wanted) * weight).astype(gru.FLOAT)
        flat_d, flat_s = d_logits.reshape(-1, d_logits.shape[2]), states.reshape(-1, states.shape[2])
        d_states = d_logits @ self.params["out"].T
        n, grads = len(self.params["rec_f"]), {"out": flat_s.T @ flat_d, "bias": flat_d.sum(0)}
        for side, part, kept, turn in (("f", d_states[..., :n], kept_f, 1), ("b", d_states[::-1, :, n:], kept_b, -1)):
            d_x, grads[f"rec_{side}"] = gru.backward(part, mask[::turn], kept, self.params[f"rec_{side}"])
            grads[f"in_{side}"] = np.zeros_like(self.params[f"in_{side}"])
            np.add.at(grads[f"in_{side}"], data[::turn].ravel(), d_x.reshape(-1, d_x.shape[2]))
        adam.update(grads, rate)
        return float(-(log_probs * wanted * weight).sum())

    def run_sums(self, runs: list[bytes]) -> np.ndarray:
        """Of each run: the sums over its bytes of the log-probabilities, and their number."""
        out = np.empty((len(runs), len(self.languages) + 1), gru.FLOAT)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        for at in range(0, len(order), RUNS_AT_ONCE):
            own = order[at : at + RUNS_AT_ONCE]
            data, mask = padded([runs[i] for i in own])
            log_probs = self._log_probs(self._states(data, mask)[0])
            out[own, :-1] = (log_probs * mask[..., None]).sum(0)
            out[own, -1] = mask.sum(0)
        return out


def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(time, batch) bytes of the runs between two spaces, and which are theirs."""
    lengths = np.fromiter((len(r) + 2 for r in runs), np.int64, len(runs))
    width = int(lengths.max(initial=2))
    data = np.frombuffer(b"".join((b" " + r + b" ").ljust(width, b"\0") for r in runs), np.uint8).reshape(len(runs), width)
    return data.T, np.arange(width)[:, None] < lengths


def runs_of(text: str) -> list[bytes]:
    out = []
    for part in text.split():
        raw = part.encode("utf-8", "surrogatepass")
        out += [raw] if len(raw) <= MAX_RUN else [raw[i : i + MAX_RUN] for i in range(0, len(raw), MAX_RUN)]
    return out


def quotas(sizes: dict[str, int], total: int) -> dict[str, int]:
    """``total`` shared out evenly; what a language can't use goes to the others."""
    out, left = {}, total
    for i, (n, lang) in enumerate(sorted((n, lang) for lang, n in sizes.items())):
        out[lang] = min(n, max(1, left // (len(sizes) - i)))
        left -= out[lang]
    return out


def training_runs(rows: DataFrame, docs: int = TRAIN_DOCS, runs: int = TRAIN_RUNS) -> DataFrame:
    """(lang, run, n): a hash-chosen sample of about ``docs`` documents of
    ``rows`` (doc_id, text, lang), and of their distinct runs (bytes, cut to
    ``MAX_RUN``) those with the least hashes, ``runs`` at most in all and as
    many of every language (or one each, with more languages than ``runs``)."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return rows.sparkSession.createDataFrame([], "lang string, run binary, n long")
    by_lang = lambda of: F.create_map(*[F.lit(x) for lang, v in sorted(of.items()) for x in (lang, v)])[F.col("lang")]
    shares = {lang: min(1.0, docs / len(counts) / n) for lang, n in counts.items()}
    draw = F.pmod(F.xxhash64(F.lit("docs"), "doc_id", F.octet_length("text")), F.lit(1_000_003)) / 1_000_003.0
    words = rows.where(draw < by_lang(shares)).select("lang", F.explode(F.split("text", r"\s+")).alias("run")).where("run <> ''")
    starts = F.sequence(F.lit(0), F.floor((F.octet_length("run") - 1) / MAX_RUN).cast("int"))
    raw = F.col("run").cast("binary")
    cut = words.select("lang", F.explode(F.transform(starts, lambda i: F.substring(raw, i * MAX_RUN + 1, F.lit(MAX_RUN)))).alias("run"))
    cut = materialize(cut.groupBy("lang", "run").agg(F.count("*").alias("n")), "language-runs")
    sizes = {r["lang"]: r["n"] for r in cut.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not sizes:
        return cut
    wanted = quotas(sizes, runs)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("lang", "run"), "run"))
    # cut to the greatest quota in each task, before the shuffle
    return cut.withColumn("place", place).where(F.col("place") <= max(wanted.values())).where(F.col("place") <= by_lang(wanted)).drop("place")


def train(rows: DataFrame, hidden: int = 16, epochs: int = 4, batch: int = 256, rate: float = 0.02, seed: int = 7, **bounds: int) -> ByteTagger | None:
    """Fit the network on a bounded sample of ``rows`` (doc_id, text, lang);
    None if no row is labelled."""
    with scratch_scope(rows.sparkSession):
        sample = sorted((r["lang"], bytes(r["run"]), r["n"]) for r in training_runs(rows, **bounds).collect())
    if not sample:
        return None
    languages = sorted({lang for lang, _, _ in sample})
    model = ByteTagger.fresh(languages, hidden, seed)
    if len(languages) == 1:
        return model
    index = {lang: i for i, lang in enumerate(languages)}
    runs, labels, weights = [], [], []
    for lang, run, n in sample:
        runs.append(run)
        labels.append(index[lang])
        weights.append(1 + np.log(n))  # frequent runs more often, but not in proportion
    labels, weights = np.array(labels), np.array(weights)
    per_language = np.bincount(labels, weights, len(languages))
    weights = weights / per_language[labels]
    rng, adam = np.random.default_rng(seed), gru.Adam(model.params, rate)
    steps = max(60, epochs * len(runs) // batch)
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    for k in range(steps):
        own = rng.choice(len(runs), batch, p=weights / weights.sum())
        own = own[np.argsort(lengths[own])]
        data, mask = padded([runs[i] for i in own])
        model.learn(data, mask, labels[own], adam, rate * (1 - k / steps) + rate / 50)
    return model


class Predictor:
    """Document predictions of a trained network, with the sums of recent parts kept."""

    def __init__(self, model: ByteTagger | None):
        self.model, self.place = model, {}
        self.sums = np.zeros((0, len(model.languages) + 1 if model else 0), gru.FLOAT)

    def _held(self, parts: set[str]) -> dict[str, int]:
        """Where each of ``parts`` is in ``sums``; all else is dropped when there are too many."""
        missing = list(parts - self.place.keys())
        if len(self.place) + len(missing) > CACHE_RUNS:
            self.place, self.sums, missing = {}, self.sums[:0], list(parts)
        if missing:
            cut = [runs_of(p) for p in missing]
            sums = self.model.run_sums([r for c in cut for r in c])
            sums = np.add.reduceat(sums, np.cumsum([0, *map(len, cut[:-1])]), 0)
            self.place.update(zip(missing, range(len(self.sums), len(self.sums) + len(missing)), strict=True))
            self.sums = np.concatenate([self.sums, sums])
        return self.place

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        labels, scores = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.model else []
        for group in bounded(((i,) for i in known), lambda r: len(texts[r[0]])):
            split = [texts[i].split() for (i,) in group]
            held = self._held(set().union(*split))
            for (i,), parts in zip(group, split, strict=True):
                at = np.fromiter(map(held.__getitem__, parts), np.int64, len(parts))
                total = self.sums[at].sum(0, dtype=np.float64)
                mean = total[:-1] / max(total[-1], 1)
                probs = np.exp(mean - mean.max())
                best = int(probs.argmax())
                labels[i], scores[i] = self.model.languages[best], float(probs[best] / probs.sum())
        return pd.DataFrame({"lang_pred": labels, "score": scores})


def predictor(spark, model: ByteTagger | None):
    """A column function: text -> struct of lang_pred and score."""
    set_batch_rows(spark)
    shared, own = spark.sparkContext.broadcast(model), {}  # a few ten thousand numbers

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_memory()
        held = own.setdefault("p", Predictor(shared.value))
        for part in parts:
            yield held.predict(part.tolist())

    return predict.asNondeterministic()


def held_out(mod: int, remainder: int) -> Column:
    """Whether crc32(doc_id as text) leaves this remainder; false for a null doc_id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == remainder, F.lit(False))


def identify(docs: DataFrame, model: ByteTagger | None) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced)."""
    named = docs.withColumn("__lang", predictor(docs.sparkSession, model)(F.col("text").cast("string")))
    return named.withColumns({"lang_pred": F.col("__lang.lang_pred"), "score": F.col("__lang.score")}).drop("__lang")
