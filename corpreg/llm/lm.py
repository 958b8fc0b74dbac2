"""Scoring documents with a gated recurrent language model.

Tokens are the words of the text (A-Z lower-cased, split at ASCII white space)
and one end token. The corpus gives the count of every word of all training
rows; the most frequent words are the model's vocabulary, and every other word
is the unknown token times its smoothed share among the words outside the
vocabulary, so the model is a distribution over all words. The output softmax
is factored into classes of words of similar frequency. The network is trained
in numpy by truncated back-propagation through time on all training rows, whole
texts of any length (callers may ask for a hash-chosen ``share`` of the rows). It
learns in Spark tasks of about ``TRAIN_DOCS`` rows, whose parameters are averaged
after every round, so both the rows and the tasks grow with the input. Scoring carries the state through
the whole text, window by window.

Counts reach the documents in two ways: those of the ``HEAD`` most frequent
words (a bounded table) are shipped to every task, and the occurrences of all
other words meet the counts in an equi-join on the word.

Edge cases: a null or empty text is the end token alone; rows with a null
doc_id are scored but not learned from; repeated rows count and are scored as
often as they occur; without training rows every probability is the smoothed
one of nothing (base score 0) and the network is untrained.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import gru
from .textutil import bounded, set_batch_rows

HEAD = 200_000
VOCABULARY = 4_000
HIDDEN = 24
TRAIN_DOCS, TRAIN_SHARE = 1_200, 1.0
CHUNK_TOKENS = 4_000_000  # of texts that a training task holds at a time
UNKNOWN, END = 0, 1
SMOOTHING = 0.1
_FLUSH = 300_000
_AT_ONCE = 4_096  # states whose outputs are computed together


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def token_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all ``rows`` (text); the end token is the empty word.
    Counted in each task first, so a frequent word is a few rows per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in held], pa.string()), pa.array(held.values(), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(words(text))
                held[b""] += 1
                if len(held) > _FLUSH:
                    yield flush()
                    held.clear()
        yield flush()

    return rows.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class ClassModel:
    """The network: embedding of inputs into gate inputs, recurrence, class and
    in-class outputs. ``place``: vocabulary index -> rank by frequency; rank
    ``r`` is slot ``r % width`` of class ``r // width``."""

    place: np.ndarray
    width: int
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 11) -> ClassModel:
        """``counts`` of each vocabulary index give the order and the first biases."""
        n = len(counts)
        width = max(2, int(np.ceil(np.sqrt(n))))
        classes = -(-n // width)
        place = np.empty(n, np.int64)
        place[np.argsort(-counts, kind="stable")] = np.arange(n)
        share = np.full(classes * width, 0.0)
        share[place] = counts + SMOOTHING
        share = share.reshape(classes, width)
        rng = np.random.default_rng(seed)
        log = lambda x: np.log(np.maximum(x, 1e-300)).astype(gru.FLOAT)
        in_class = np.where(share > 0, log(share / share.sum(1, keepdims=True)), -1e4).astype(gru.FLOAT)
        return cls(place, width, {
            "in": gru.uniform(rng, n, 3 * hidden, scale=0.2),
            "rec": gru.uniform(rng, hidden, 3 * hidden),
            "class": gru.uniform(rng, hidden, classes, scale=0.05),
            "class_bias": log(share.sum(1) / share.sum()),
            "word": gru.uniform(rng, classes, hidden, width, scale=0.05),
            "word_bias": in_class,
        })

    def _groups(self, targets: np.ndarray):
        rank = self.place[targets]
        of_class, slot = rank // self.width, rank % self.width
        order = np.argsort(of_class, kind="stable")
        found, begin = np.unique(of_class[order], return_index=True)
        return of_class, slot, order, found, begin

    def _inner(self, states: np.ndarray, found: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """In-class log-probabilities of all slots; the states of class
        ``found[i]`` are those from ``begin[i]`` on."""
        out = np.empty((len(states), self.width), gru.FLOAT)
        for c, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(states)], strict=True):
            np.matmul(states[a:b], self.params["word"][c], out=out[a:b])
            out[a:b] += self.params["word_bias"][c]
        return _log_softmax(out)

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target after its state."""
        out = np.empty(len(targets))
        for at in range(0, len(targets), _AT_ONCE):  # small enough to stay in the processor's cache
            own = slice(at, at + _AT_ONCE)
            of_class, slot, order, found, begin = self._groups(targets[own])
            rows = np.arange(len(order))
            part = _log_softmax(states[own] @ self.params["class"] + self.params["class_bias"])[rows, of_class].astype(np.float64)
            part[order] += self._inner(states[own][order], found, begin)[rows, slot[order]]
            out[own] = part
        return out

    def gradients(self, states: np.ndarray, targets: np.ndarray):
        """Mean loss, its gradients of the output layers and of the states."""
        of_class, slot, order, found, begin = self._groups(targets)
        n, rows, p = gru.FLOAT(len(targets)), np.arange(len(targets)), self.params
        log_probs = _log_softmax(states @ p["class"] + p["class_bias"])
        loss = -log_probs[rows, of_class].sum()
        d = np.exp(log_probs)
        d[rows, of_class] -= 1
        d /= n
        grads = {"class": states.T @ d, "class_bias": d.sum(0), "word": np.zeros_like(p["word"]), "word_bias": np.zeros_like(p["word_bias"])}
        d_states = d @ p["class"].T
        ranked = states[order]
        inner = self._inner(ranked, found, begin)
        loss -= inner[rows, slot[order]].sum()
        d = np.exp(inner, out=inner)
        d[rows, slot[order]] -= 1
        d /= n
        back = np.empty_like(ranked)
        for c, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
            np.matmul(ranked[a:b].T, d[a:b], out=grads["word"][c])
            np.matmul(d[a:b], p["word"][c].T, out=back[a:b])
            grads["word_bias"][c] = d[a:b].sum(0)
        d_states[order] += back
        return float(loss / n), grads, d_states

    def learn(self, docs: list[np.ndarray], epochs: int = 2, batch: int = 64, window: int = 24, rate: float = 0.01, last: float = 0.001, seed: int = 13, adam: gru.Adam | None = None) -> None:
        """Truncated back-propagation through time over documents (arrays of
        vocabulary indices that end with the end token), state carried on; the
        rate falls to ``last``."""
        p, hidden, rng = self.params, len(self.params["rec"]), np.random.default_rng(seed)
        adam = adam or gru.Adam(p, rate)
        docs = sorted(docs, key=lambda d: (len(d), d.tobytes()))
        groups = [docs[i : i + batch] for i in range(0, len(docs), batch)]
        total, done = max(1, epochs * sum(-(-len(g[-1]) // window) for g in groups)), 0
        for _ in range(epochs):
            for k in rng.permutation(len(groups)):
                own, longest = groups[k], len(groups[k][-1])
                h = np.zeros((len(own), hidden), gru.FLOAT)
                for at in range(0, longest, window):
                    ended = next(i for i, doc in enumerate(own) if len(doc) > at)  # the shortest come first
                    own, h = own[ended:], h[ended:]
                    n = min(window, longest - at)
                    tokens, m = np.full((n + 1, len(own)), END), np.zeros((n, len(own)), bool)
                    for i, doc in enumerate(own):
                        part = doc[at : at + n]
                        tokens[1 : len(part) + 1, i], m[: len(part), i] = part, True
                        if at:
                            tokens[0, i] = doc[at - 1]
                    states, kept = gru.forward(p["in"][tokens[:-1]], m, h, p["rec"])
                    h = states[-1].copy()
                    _, grads, d_flat = self.gradients(states[m], tokens[1:][m])
                    d_states = np.zeros_like(states)
                    d_states[m] = d_flat
                    d_x, grads["rec"] = gru.backward(d_states, m, kept, p["rec"])
                    grads["in"] = _summed_rows(tokens[:-1].ravel(), d_x.reshape(-1, d_x.shape[2]), len(p["in"]))
                    adam.update(grads, rate + (last - rate) * done / total)
                    done += 1

    def score(self, docs: list[np.ndarray], states_at_once: int = 65_536) -> np.ndarray:
        """Natural log-likelihood of each whole document; the documents run side
        by side, longest first, and the state goes on from window to window."""
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        lengths = np.array([len(docs[i]) for i in order], np.int64)
        flat = np.concatenate([docs[i] for i in order]) if docs else np.zeros(0, np.int64)
        begin = np.cumsum(lengths) - lengths
        out = np.zeros(len(docs))
        h, prior = np.zeros((len(docs), len(self.params["rec"])), gru.FLOAT), np.full(len(docs), END)
        at, longest = 0, int(lengths.max(initial=0))
        active = np.searchsorted(-lengths, -np.arange(longest), "left")  # documents longer than each step
        while at < longest:
            steps = min(longest - at, max(1, min(512, states_at_once // int(active[at]))))
            states, targets, owners = [], [], []
            for t in range(at, at + steps):
                a = int(active[t])
                new, _ = gru.step(self.params["in"][prior[:a]], h[:a], self.params["rec"])
                h[:a] = new
                prior[:a] = flat[begin[:a] + t]
                states.append(new)
                targets.append(prior[:a].copy())
                owners.append(np.arange(a))
            found = self.log_probs(np.concatenate(states), np.concatenate(targets))
            out += np.bincount(np.concatenate(owners), found, len(docs))
            at += steps
        back = np.empty(len(docs))
        back[order] = out
        return back


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    x -= np.log(np.exp(x).sum(1, keepdims=True))
    return x


def _summed_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    order = np.argsort(index, kind="stable")
    found, begin = np.unique(index[order], return_index=True)
    out[found] = np.add.reduceat(rows[order], begin)
    return out


@dataclass
class LanguageModel:
    """What scoring tasks need: counts of the most frequent words, the network
    over the first ``size`` of them, and the corpus totals."""

    head: dict[bytes, int]
    counts: np.ndarray
    size: int
    tokens: int
    types: int
    network: ClassModel

    def index(self, heads: np.ndarray) -> np.ndarray:
        """Vocabulary indices: heads are 0 for the end, 1.. by frequency, -1 for others."""
        return np.where((heads >= 0) & (heads <= self.size), heads + 1, UNKNOWN)

    @property
    def outside(self) -> tuple[int, int]:
        """Tokens and types that are not in the vocabulary."""
        inside = int(self.counts[: self.size + 1].sum())
        return self.tokens - inside, self.types - int((self.counts[: self.size + 1] > 0).sum())

    def heads(self, text: str | None) -> tuple[np.ndarray, list[bytes]]:
        parts = words(text)
        found = np.fromiter((self.head.get(w, -1) for w in parts), np.int64, len(parts))
        return np.append(found, 0), parts


def most_frequent(counts: DataFrame, head: int) -> DataFrame:
    """The rows of ``counts`` (word, c) with the greatest counts, ``head`` at
    most in all. Where to cut is found from histograms of a few thousand rows: of
    the counts' sizes (64 steps to a doubling), then of the words' hashes among
    the counts of the step in which the limit falls."""
    step, cell = F.floor(F.log2(F.col("c").cast("double")) * 64), F.pmod(F.xxhash64("word"), F.lit(4096))
    sizes = sorted(tuple(r) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect())  # a row a step
    last, room = -1, head
    while sizes and sizes[-1][1] <= room:
        last, n = sizes.pop()
        room -= n
    if not sizes:
        return counts
    cut, above = sizes[-1][0], F.lit(False) if last < 0 else step >= last
    cells = sorted(tuple(r) for r in counts.where(step == cut).groupBy(cell.alias("h")).agg(F.count("*").alias("n")).collect())  # 4096 rows
    upto = 0
    for h, n in cells:
        if n > room:
            break
        room, upto = room - n, h + 1
    return counts.where(above | ((step == cut) & (cell < upto)))


def train(rows: DataFrame, counts: DataFrame, head: int = HEAD, vocabulary: int = VOCABULARY, docs: int = TRAIN_DOCS, share: float = TRAIN_SHARE, **options) -> LanguageModel:
    """``rows``: doc_id, text of the training rows; ``counts``: their token counts."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == "", F.col("c"))).alias("ends")).first()
    top = sorted(most_frequent(counts.where("word <> ''"), head).collect(), key=lambda r: (-r["c"], r["word"]))  # at most ``head`` words
    numbers = np.array([total["ends"] or 0, *[r["c"] for r in top]], np.int64)
    size = min(vocabulary, len(top))
    model = LanguageModel({r["word"].encode("utf-8"): i + 1 for i, r in enumerate(top)}, numbers, size, total["n"] or 0, total["v"], None)
    model.network = ClassModel.fresh(np.concatenate([[model.outside[0]], numbers[: size + 1]]).astype(np.float64))
    n = int(numbers[0])  # every training row has one end token
    if n:
        chosen = max(share, min(1.0, docs / n))
        draw = F.pmod(F.xxhash64(F.lit("lm"), "doc_id", F.octet_length("text")), F.lit(1_000_003)) / 1_000_003.0
        sample = rows.where(draw < chosen) if chosen < 1 else rows
        learn(sample, model, -(-int(n * chosen) // docs), **options)
    return model


def learn(sample: DataFrame, model: LanguageModel, tasks: int, epochs: int = 2, rate: float = 0.01, **options) -> None:
    """Train the network on all rows of ``sample`` (text): in each round every
    one of ``tasks`` tasks goes through its rows from the same parameters, and
    the new ones are averaged by the number of tokens, in a few tasks first."""
    set_batch_rows(sample.sparkSession)
    texts = materialize(sample.select("text").repartition(max(1, tasks)), "lm-sample")
    spark, names = sample.sparkSession, sorted(model.network.params)
    words_of = spark.sparkContext.broadcast((dict(list(model.head.items())[: model.size]), model.network.place, model.network.width))

    def flat(params: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([params[k].ravel() for k in names]).astype(np.float64)

    shapes = [model.network.params[k].shape for k in names]

    def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
        parts = np.split(values.astype(gru.FLOAT), np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
        return {k: v.reshape(s).copy() for k, v, s in zip(names, parts, shapes, strict=True)}

    def row(slot: int, tokens: int, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([tokens], pa.int64()), pa.array([values.tobytes()], pa.binary())], names=["slot", "tokens", "params"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, values = 0, None
        for batch in batches:
            for n, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.float64)
                tokens, values = tokens + n, own if values is None else values + own
        if tokens:
            yield row(0, tokens, values)

    for k in range(epochs):
        shared = spark.sparkContext.broadcast(flat(model.network.params))
        first, last = (rate * (1 - 0.9 * x / epochs) for x in (k, k + 1))

        def work(batches: Iterator[pa.RecordBatch], shared=shared, first=first, last=last, k=k) -> Iterator[pa.RecordBatch]:
            known, place, width = words_of.value
            network = ClassModel(place, width, unflat(shared.value))
            adam, tokens = gru.Adam(network.params, first), 0

            def docs() -> Iterator[tuple[np.ndarray]]:
                for batch in batches:
                    for text in batch.column(0).to_pylist():
                        parts = words(text)
                        found = np.fromiter((known.get(w, -1) for w in parts), np.int32, len(parts))
                        yield (np.append(np.where(found > 0, found + 1, UNKNOWN), END).astype(np.int32),)

            for group in bounded(docs(), lambda d: len(d[0]), CHUNK_TOKENS):
                network.learn([d for (d,) in group], 1, rate=first, last=last, seed=13 + k, adam=adam, **options)
                tokens += sum(len(d) for (d,) in group)
            if tokens:
                yield row(TaskContext.get().partitionId() % 16, tokens, flat(network.params) * tokens)

        schema = "slot int, tokens long, params binary"
        found = texts.mapInArrow(work, schema).repartition(16, "slot").mapInArrow(summed, schema).collect()  # at most a few rows
        total = sum(r["tokens"] for r in found)
        if total:
            model.network.params = unflat(sum(np.frombuffer(r["params"], np.float64) for r in sorted(found, key=lambda r: bytes(r["params"]))) / total)
        shared.unpersist()


def partial_scores(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: what the shipped counts and the network give, and
    the words that are not among them (``rest``, with repetitions)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string())]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, row_id = shared.value, TaskContext.get().partitionId() << 40
        outside, outside_types = m.outside
        base = np.log10((m.counts + SMOOTHING) / (m.tokens + SMOOTHING * (m.types + 1)))
        among = np.log10((m.counts + SMOOTHING) / (outside + SMOOTHING * (outside_types + 1)))
        among[: m.size + 1] = 0
        for batch in batches:
            heads, rest, out = [], [], []
            for text in batch.column(2).to_pylist():
                found, parts = m.heads(text)
                heads.append(found)
                rest.append([parts[i].decode("utf-8", "replace") for i in np.flatnonzero(found < 0)])
            scores = m.network.score([m.index(h) for h in heads]) / np.log(10)
            for h, s in zip(heads, scores, strict=True):
                known = h[h >= 0]
                out.append((len(h), int((m.counts[known] > 0).sum()), float(base[known].sum()), float(s + among[known].sum())))
            ids = pa.array(np.arange(row_id, row_id + len(heads)))
            row_id += len(heads)
            columns = [list(c) for c in zip(*out, strict=True)] or [[]] * 4
            arrays = [ids, batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types[3:7], strict=True)], pa.array(rest, types[7])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<string>"
    return docs.select(F.col("doc_id").cast("long"), "held_out", F.col("text").cast("string")).mapInArrow(measure, schema)


def score_documents(docs: DataFrame, training, held_out, **options) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text). ``training`` and ``held_out`` are
    boolean columns over doc_id: which rows to learn from, and which to mark."""
    spark = docs.sparkSession
    set_batch_rows(spark, 8000)
    rows = docs.where(training).select("doc_id", F.col("text").cast("string").alias("text"))
    counts = materialize(token_counts(rows), "token-counts")
    model = train(rows, counts, **options)
    made = materialize(partial_scores(docs.withColumn("held_out", held_out), model), "partial-scores")
    outside, outside_types = model.outside
    low = SMOOTHING * (model.types + 1) + model.tokens
    low_outside = SMOOTHING * (outside_types + 1) + outside
    rest = made.select("row_id", F.explode("rest").alias("word"))
    c = F.coalesce("c", F.lit(0)) + F.lit(SMOOTHING)
    added = rest.join(counts, "word", "left").groupBy("row_id").agg(
        F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("known"),
        F.sum(F.log10(c / F.lit(float(low)))).alias("base"),
        F.sum(F.log10(c / F.lit(float(low_outside)))).alias("model"),
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    out = made.drop("rest").join(added, "row_id", "left")
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "known"), F.lit(model.tokens).cast("long").alias("train_tokens"), plus("base_score", "base"), plus("score", "model"))


