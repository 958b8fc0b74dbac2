"""Secrets in texts: fixed patterns, and a character convolutional network for the rest.

The patterns find assignments to a secret's name, access keys and long
hexadecimal runs. Beside them every candidate is looked at: a maximal run of
value characters (``CANDIDATE``) of ``LEAST`` characters or more that has a
digit or changes from small to capital letters. A network reads the characters
of a candidate and ``CONTEXT`` characters on each side of it: character
embeddings that know whether they lie inside, a convolution, the greatest
response inside and outside, and a small dense layer. A long candidate is read
in overlapping pieces, whole, and its highest score counts.

It is trained in numpy on labelled findings: candidates that a pattern covers
are positive, the others negative. So that the shape of a value counts and not
the name in front of it alone, some positives get the context of a negative or
another value in their place, and numbers, dates and joined words made from
the contexts are added to the negatives. What no pattern covers may be a secret
all the same: negatives that a network trained on the others takes for secrets
are left out. At most about ``TRAIN_FINDINGS``
different windows of each class, chosen by hash, are learned from; a fifth of
all windows (by hash) is never learned from. Over that fifth, counted in the
whole corpus, the scores are calibrated (a logistic curve over a histogram).
The threshold is a probability of one half, or the highest lower one that still
finds ``RECALL`` of the positives. Candidates at or above it that touch no
pattern's span are added with kind ``net``.

The texts are read once. A table of spans and windows is written and scored;
it grows with the candidates, not with the texts.

Edge cases: a null text counts as empty; null and repeated ids are ordinary
rows, one row comes out for each row. Without positives or without negatives to
learn from nothing is added. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from . import gru
from .textutil import bounded, set_batch_rows

# The patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, LEAST_ACCESS = re.compile(r"AKIA[A-Z0-9]+"), 20
HEX, LEAST_HEX = re.compile(r"[0-9a-f]{24,}"), 24
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "net")

NAMES = ("password", "passwd", "secret", "token", "api")
LEAST, CONTEXT, PIECE = 8, 24, 64
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LEAST},}}")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
TRAIN_FINDINGS = 4_000
RECALL = 0.98
BINS, REACH = 2_000, 20.0  # scores (log-odds) are counted in bins from -REACH to REACH


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping
    within a kind, in order."""
    found = []
    if ("=" in text or ":" in text) and any(n in text.lower() for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]  # a maximal run of LEAST_HEX or more
    return sorted(found)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, end, label, window) of every candidate: label 1 where it touches
    one of ``spans``; the window reaches ``CONTEXT`` characters beyond it."""
    starts, ends, out = [], [], []  # the spans, joined where they meet
    for start, _, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    for m in CANDIDATE.finditer(text):
        if _MIXED.search(m.group()):
            start, end = m.span()
            at = bisect_right(ends, start)
            label = int(at < len(starts) and starts[at] < end)
            out.append((start, end, label, text[max(0, start - CONTEXT) : end + CONTEXT]))
    return out


# A window in numbers: ASCII codes, OTHER or PAD, plus INSIDE within the candidate.
OTHER, PAD, INSIDE = 128, 129, 130
WIDTH = PIECE + 2 * CONTEXT


def pieces(window: str, left: int, size: int) -> np.ndarray:
    """(pieces, WIDTH) symbols of a window whose candidate begins at ``left``."""
    codes = np.minimum(np.frombuffer(window.encode("utf-32-le", "surrogatepass"), "<u4"), OTHER).astype(np.int64)
    codes[left : left + size] += INSIDE
    starts = range(0, max(1, size - PIECE // 2), PIECE // 2)
    out = np.full((len(starts), WIDTH), PAD)
    for row, at in zip(out, starts, strict=True):
        lo, hi = max(0, left + at - CONTEXT), min(len(codes), left + at + PIECE + CONTEXT)
        row[: hi - lo] = codes[lo:hi]
    return out


class ConvNet:
    """Embedding, convolution over ``REACH_OF`` characters, greatest response
    inside and outside the candidate, one dense layer, log-odds."""

    EMBED, FILTERS, HIDDEN, REACH_OF = 8, 24, 16, 5

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        e, f, h, r = self.EMBED, self.FILTERS, self.HIDDEN, self.REACH_OF
        self.params = {
            "embed": gru.uniform(rng, 2 * INSIDE, e, scale=0.5),
            "conv": gru.uniform(rng, r * e, f),
            "conv_bias": np.zeros(f, gru.FLOAT),
            "dense": gru.uniform(rng, 2 * f, h),
            "dense_bias": np.zeros(h, gru.FLOAT),
            "out": gru.uniform(rng, h, 1),
            "out_bias": np.zeros(1, gru.FLOAT),
        }

    def forward(self, x: np.ndarray):
        """Log-odds of the pieces ``x`` and what the gradient needs."""
        p, half = self.params, self.REACH_OF // 2
        embedded = np.pad(p["embed"][x], ((0, 0), (half, half), (0, 0)))
        seen = np.concatenate([embedded[:, i : i + x.shape[1]] for i in range(self.REACH_OF)], 2)
        response = np.maximum(seen @ p["conv"] + p["conv_bias"], 0)
        zones = [x >= INSIDE, x < PAD]
        masked = [np.where(z[..., None], response, 0) for z in zones]
        best = [m.argmax(1) for m in masked]
        pooled = np.concatenate([m.max(1) for m in masked], 1)
        hidden = np.tanh(pooled @ p["dense"] + p["dense_bias"])
        return (hidden @ p["out"])[:, 0] + p["out_bias"][0], (seen, best, pooled, hidden)

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of a batch and its gradients."""
        p, n, half = self.params, len(x), self.REACH_OF // 2
        odds, (seen, best, pooled, hidden) = self.forward(x)
        loss = float(np.mean(np.logaddexp(0, odds) - label * odds))
        d_odds = ((gru.sigmoid(odds) - label) / n).astype(gru.FLOAT)[:, None]
        d_hidden = d_odds @ p["out"].T * (1 - hidden * hidden)
        d_pooled = np.where(pooled > 0, d_hidden @ p["dense"].T, 0)
        d_response = np.zeros((*x.shape, self.FILTERS), gru.FLOAT)
        rows, columns = np.arange(n)[:, None], np.arange(self.FILTERS)[None]
        for zone, at in enumerate(best):
            np.add.at(d_response, (rows, at, columns), d_pooled[:, zone * self.FILTERS : (zone + 1) * self.FILTERS])
        flat = d_response.reshape(-1, self.FILTERS)
        d_seen = (flat @ p["conv"].T).reshape(*x.shape, -1)
        d_embedded = np.zeros((n, x.shape[1] + 2 * half, self.EMBED), gru.FLOAT)
        for i in range(self.REACH_OF):
            d_embedded[:, i : i + x.shape[1]] += d_seen[..., i * self.EMBED : (i + 1) * self.EMBED]
        d_embed = np.zeros_like(p["embed"])
        np.add.at(d_embed, x.ravel(), d_embedded[:, half : half + x.shape[1]].reshape(-1, self.EMBED))
        grads = {
            "embed": d_embed,
            "conv": seen.reshape(-1, seen.shape[2]).T @ flat,
            "conv_bias": flat.sum(0),
            "dense": pooled.T @ d_hidden,
            "dense_bias": d_hidden.sum(0),
            "out": hidden.T @ d_odds,
            "out_bias": d_odds.sum(0),
        }
        return loss, grads

    def score(self, windows: list[tuple[str, int, int]]) -> np.ndarray:
        """Log-odds of (window, left, size): the highest of its pieces."""
        out = np.full(len(windows), -REACH)
        # a window comes often where texts are copies
        places: dict[tuple[str, int, int], list[int]] = {}
        for i, w in enumerate(windows):
            places.setdefault(w, []).append(i)
        for group in bounded(((w,) for w in places), lambda w: len(w[0][0]), 32_000):
            cut = [pieces(*w) for (w,) in group]
            odds = self.forward(np.concatenate(cut))[0].astype(np.float64)
            for (w,), own in zip(group, np.split(odds, np.cumsum([len(c) for c in cut])[:-1]), strict=True):
                out[places[w]] = np.clip(own.max(), -REACH, REACH)
        return out


_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789")


class Augmenter:
    """Training windows: labelled ones, and ones made from them."""

    def __init__(self, positive: list[tuple[str, int, int]], negative: list[tuple[str, int, int]], rng: np.random.Generator):
        self.positive, self.negative, self.rng = positive, negative, rng
        around = " ".join(w[:left] + " " + w[left + size :] for w, left, size in negative)
        self.words = sorted({w for w in re.findall(r"[A-Za-z]{2,12}", around)}) or ["word"]

    def _value(self) -> str:
        alphabet = _ALPHABETS[self.rng.integers(len(_ALPHABETS))]
        return "".join(alphabet[i] for i in self.rng.integers(0, len(alphabet), self.rng.integers(16, 45)))

    def _harmless(self) -> str:
        kind, rng = self.rng.integers(3), self.rng
        if kind == 0:
            return "".join(str(d) for d in rng.integers(0, 10, rng.integers(8, 20)))
        if kind == 1:
            return "{:04d}-{:02d}-{:02d}".format(rng.integers(1900, 2100), rng.integers(1, 13), rng.integers(1, 29))
        sign = "-_./"[rng.integers(4)]
        parts = [self.words[i] for i in rng.integers(0, len(self.words), rng.integers(2, 5))]
        return sign.join([*parts, str(rng.integers(0, 100))])

    def _placed(self, value: str, into: tuple[str, int, int]) -> tuple[str, int, int]:
        window, left, size = into
        return window[:left] + value + window[left + size :], left, len(value)

    def draw(self, n: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
        """``n`` positives and ``n`` negatives, with their labels."""
        pick = lambda of: of[self.rng.integers(len(of))]
        out = []
        for _ in range(n):
            window, left, size = own = pick(self.positive)
            draw = self.rng.random()
            if draw < 0.3:
                out.append(self._placed(window[left : left + size], pick(self.negative)))
            elif draw < 0.7:
                out.append(self._placed(self._value(), own if draw < 0.4 else pick(self.negative)))
            else:
                out.append(own)
        for _ in range(n):
            own = pick(self.negative)
            out.append(self._placed(self._harmless(), own) if self.rng.random() < 0.3 else own)
        return out, np.repeat([1.0, 0.0], n)


def without_likely_secrets(positive: list[tuple[str, int, int]], negative: list[tuple[str, int, int]], steps: int = 200) -> list[tuple[str, int, int]]:
    """The negatives that a network which has not learned from them takes for
    negatives, too (all, if there are none): each third is judged by what the
    other two teach."""
    thirds, out = [negative[i::3] for i in range(3)], []
    for i, own in enumerate(thirds):
        others = [w for j, third in enumerate(thirds) if j != i for w in third]
        if own and others:
            out += [w for w, z in zip(own, fit(positive, others, steps).score(own), strict=True) if z < 0]
    return out or negative


def fit(positive: list[tuple[str, int, int]], negative: list[tuple[str, int, int]], steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 11) -> ConvNet:
    """A network trained on (window, left, size) of both classes."""
    net, rng = ConvNet(seed), np.random.default_rng(seed)
    make, adam = Augmenter(positive, negative, rng), gru.Adam(net.params, rate)
    for k in range(steps):
        windows, labels = make.draw(batch)
        cut = [pieces(*w) for w in windows]
        of = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        x = np.concatenate(cut)
        # a long candidate learns from its strongest piece
        odds = net.forward(x)[0] if len(x) > len(cut) else np.zeros(len(x))
        order = np.lexsort((-odds, of))
        first = order[np.r_[True, of[order][1:] != of[order][:-1]]]
        adam.update(net.gradients(x[first], labels)[1], rate * (1 - 0.95 * k / steps))
    return net


@dataclass
class Detector:
    """A network, the calibration (slope, offset) of its log-odds, and the least
    log-odds to report."""

    net: ConvNet
    slope: float
    offset: float
    threshold: float

    def probability(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * odds + self.offset, -50, 50)))


def calibrate(net: ConvNet, counts: np.ndarray, recall: float = RECALL, least: float = 0.5) -> Detector | None:
    """``counts``: (2, BINS) held-out negatives and positives by score."""
    if not counts[0].sum() or not counts[1].sum():
        return None
    width = 2 * REACH / BINS
    z = -REACH + width * (np.arange(BINS) + 0.5)
    x, w = np.column_stack([z, np.ones(BINS)]), counts.sum(0)
    # the usual smoothed targets, so that separable scores have a finite curve
    low, high = 1 / (counts[0].sum() + 2), (counts[1].sum() + 1) / (counts[1].sum() + 2)
    target = (counts[0] * low + counts[1] * high) / np.maximum(w, 1)
    beta = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        change = np.linalg.solve(hessian, x.T @ (w * (target - p)))
        change *= min(1.0, 2.0 / max(np.abs(change).max(), 1e-12))
        beta = beta + change
        if np.abs(change).max() < 1e-9:
            break
    slope, offset = map(float, beta)
    if slope <= 0:
        return None
    above = np.cumsum(counts[1][::-1])[::-1]  # positives at or above each bin
    bin_ = int(np.flatnonzero(above >= recall * counts[1].sum()).max())
    even = (np.log(least / (1 - least)) - offset) / slope
    return Detector(net, slope, offset, min(-REACH + width * bin_, float(even)))


SCANNED = "doc_id long, spans array<struct<start:long,kind:int,end:long>>, cands array<struct<start:long,end:long,label:int,window:string>>"
FOUND = "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_CANDS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("window", pa.string())]))
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _structs(rows: list[list[tuple]], kind: pa.ListType) -> pa.Array:
    """A list array of structs from lists of tuples."""
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    flat = [x for r in rows for x in r]
    fields = list(kind.value_type)
    columns = [pa.array([x[i] for x in flat], f.type) for i, f in enumerate(fields)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=fields))


def scan(docs: DataFrame) -> DataFrame:
    """Pattern spans and candidates of every row of ``docs`` (doc_id, text)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group in bounded(rows, lambda r: len(r[1] or "")):
                spans = [pattern_spans(t or "") for _, t in group]
                cands = [candidates(t or "", s) for (_, t), s in zip(group, spans, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in group], pa.int64()), _structs(spans, _SPANS), _structs(cands, _CANDS)], names=["doc_id", "spans", "cands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(look, SCANNED)


def findings(scanned: DataFrame) -> DataFrame:
    """(window, left, size, label, held_out): the different windows. One that
    a pattern covers anywhere is positive."""
    c = scanned.select(F.explode("cands").alias("c")).select(
        F.col("c.window").alias("window"), F.least(F.col("c.start"), F.lit(CONTEXT)).cast("int").alias("left"), (F.col("c.end") - F.col("c.start")).cast("int").alias("size"), "c.label"
    )
    one = c.groupBy("window", "left", "size").agg(F.max("label").alias("label"))
    return one.withColumn("held_out", F.pmod(F.xxhash64(F.lit("held out"), "window"), F.lit(5)) == 0)


def train(found: DataFrame, bound: int = TRAIN_FINDINGS, recall: float = RECALL, **options) -> Detector | None:
    """Fit and calibrate on ``found`` (see :func:`findings`)."""
    learned = found.where(~F.col("held_out"))
    n = {r["label"]: r["n"] for r in learned.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if not n.get(0) or not n.get(1):
        return None
    draw = F.pmod(F.xxhash64(F.lit("sample"), "window", "left"), F.lit(1_000_003)) / 1_000_003.0
    share = F.when(F.col("label") == 1, bound / n[1]).otherwise(bound / n[0])
    rows = sorted(tuple(r) for r in learned.where(draw < share).select("label", "window", "left", "size").collect())  # about 2 * bound
    classes = [[r[1:] for r in rows if r[0] == label] for label in (0, 1)]
    if not classes[0] or not classes[1]:
        return None
    net = fit(classes[1], without_likely_secrets(classes[1], classes[0]), **options)
    shared = found.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                odds = shared.value.score(list(zip(*(batch.column(c).to_pylist() for c in ("window", "left", "size")), strict=True)))
                at = np.clip((odds + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at)], names=["label", "bin"])

    counts = np.zeros((2, BINS))
    per = found.where("held_out").mapInArrow(score, "label int, bin int").groupBy("label", "bin").agg(F.count("*").alias("n"))
    for r in per.collect():  # 2 * BINS rows at most
        counts[r["label"], r["bin"]] = r["n"]
    return calibrate(net, counts, recall)


def find(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its spans in order of start
    and kind, each with a probability (1 for the patterns')."""
    spark = docs.sparkSession
    set_batch_rows(spark)
    scanned = materialize(scan(docs), "secret-candidates")
    with scratch_scope(spark):
        detector = train(materialize(findings(scanned), "secret-windows"), **options)
    shared = spark.sparkContext.broadcast(detector)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = [[(KINDS[s["kind"]], s["start"], s["end"], 1.0) for s in spans] for spans in batch.column("spans").to_pylist()]
            if known is not None:
                open_ = [(row, c) for row, cands in enumerate(batch.column("cands").to_pylist()) for c in cands if not c["label"]]
                odds = known.net.score([(c["window"], min(c["start"], CONTEXT), c["end"] - c["start"]) for _, c in open_])
                p = known.probability(odds)
                for i in np.flatnonzero(odds >= known.threshold):
                    row, c = open_[i]
                    out[row].append((KINDS[-1], c["start"], c["end"], float(p[i])))
            out = [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for spans in out]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _structs(out, _FOUND)], names=["doc_id", "spans"])

    return scanned.mapInArrow(name, FOUND)
