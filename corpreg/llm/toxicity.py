"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, compatibility forms and accents removed,
letters that look like Latin ones mapped to them, zero-width characters
dropped, and digits or signs that stand for letters mapped inside words; what
is not a letter is then a space. The lexicon holds whole words and word
beginnings with log-odds weights, both learned from labelled rows, plus what
the caller adds. Exception phrases (a lexicon match with a neighbouring word
that mostly occurs in clean rows, or phrases given by the caller) cancel the
matches they cover. A document's evidence is the summed weight of its matches
per word; a logistic curve over it and over the strongest match gives the score.

The lexicon and the curve are fitted on a bounded, hash-chosen sample of the
labelled rows (``TRAIN_ROWS``).

Edge cases: null, empty and wordless texts have no evidence and get the
curve's value for none; without labelled rows, or with one class only, the
lexicon holds only what the caller adds and a fixed curve is used. Rows whose
label is neither 0 nor 1 are not learned from.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from .textutil import set_batch_rows

TRAIN_ROWS = 20_000
LEXICON_SIZE = 2_000
MIN_LOG_ODDS, STEM = 1.5, (4, 8)

# letters of other scripts that look like Latin letters, and digits and signs used for letters
LOOKALIKES = dict(zip("авсԁеһіјкӏмпорԛѕтцухѵԝуαβγεηικνορτυχωϲϳℓıɑɡ", "abcdehijklmnopqstuyxvwyabyenikvoptuxwcjliag", strict=True))
SUBSTITUTES = dict(zip("0134578@$!+|€", "oieastbasitie", strict=True))
ZERO_WIDTH = "​‌‍⁠﻿­"


def _table() -> dict[int, str]:
    table = {}
    for code in range(128, 0x3000):
        base = unicodedata.normalize("NFKD", chr(code).lower())
        kept = "".join(c for c in base if not unicodedata.combining(c))
        table[code] = "".join(LOOKALIKES.get(c, c) for c in kept)
    for code in range(0xFF01, 0xFF5F):  # full-width ASCII
        table[code] = chr(code - 0xFEE0).lower()
    return table | {ord(c): "" for c in ZERO_WIDTH}


_FOLD = _table()
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_SIGNS = "0134578@$!+|€"
_MIXED = re.compile(rf"(?<!\S)[^\s{_SIGNS}]*[{_SIGNS}]\S*")
_LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _substituted(match: re.Match) -> str:
    word = match.group()
    if not _LETTER.search(word):
        return word
    core = word.rstrip("!+|")  # a closing exclamation mark is no letter
    return core.translate(_SUBSTITUTE) + word[len(core) :]


def fold(text: str | None) -> str:
    """Folded words, separated, led and followed by one space (one space if there are none)."""
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    text = _MIXED.sub(_substituted, text)
    words = _NOT_LETTERS.sub(" ", text).strip()
    return f" {words} " if words else " "


@dataclass
class Lexicon:
    """``weights``: pattern -> weight, a pattern being `` word `` or `` beginning``.
    ``exceptions``: folded phrases led and followed by a space. ``curve``: bias and
    slopes of the score."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)

    def matcher(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0, True))
        for pattern, weight in self.weights.items():
            if pattern not in found:
                found.add_word(pattern, (len(pattern), weight, False))
        if not len(found):
            return None
        found.make_automaton()
        return found


def evidence(text: str | None, matcher) -> tuple[float, float, int]:
    """Summed weight, greatest weight and number of words of a text; of
    matches that begin at the same word the longest counts."""
    folded = fold(text)
    n = folded.count(" ") - 1
    if matcher is None or n == 0:
        return 0.0, 0.0, n
    best: dict[int, tuple[int, float]] = {}
    covered = []
    for end, (size, weight, cancels) in matcher.iter(folded):
        start = end - size + 1
        if cancels:
            covered.append((start, end))
        elif size > best.get(start, (0, 0.0))[0]:
            best[start] = (size, weight)
    weights = [w for s, (_, w) in best.items() if not any(a <= s < b for a, b in covered)] if covered else [w for _, w in best.values()]
    return math.fsum(weights), max(weights, default=0.0), n


def features(total: float, most: float, n: int) -> tuple[float, float]:
    return math.log1p(100 * max(total, 0.0) / max(n, 1)), most


def score(text: str | None, matcher, curve: tuple[float, float, float]) -> float:
    rate, most = features(*evidence(text, matcher))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, curve[0] + curve[1] * rate + curve[2] * most))))


def _patterns(folded: str) -> set[str]:
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(" " + word[:n] for n in range(STEM[0], min(STEM[1], len(word)) + 1))
    return out


def _counted(rows: DataFrame, patterns) -> DataFrame:
    """(pattern, toxic rows, clean rows) of ``rows`` (text, toxic), counted in each task first."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            by = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                by[toxic].update(patterns(fold(text)))
            names = sorted(by[0].keys() | by[1].keys())
            if names:  # columns of no values would have no type
                yield pd.DataFrame({"pattern": names, "toxic": [by[1][n] for n in names], "clean": [by[0][n] for n in names]}, columns=["pattern", "toxic", "clean"])

    partial = rows.mapInPandas(count, "pattern string, toxic long, clean long")
    return partial.groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of about ``rows`` labelled documents at most, chosen by
    hash of the id; of an id with several texts the smallest one."""
    ids = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = ids.where(draw < rows / max(ids.count(), 1))
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about ``rows`` pairs of numbers
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def learn(rows: DataFrame, added: dict[str, float] | None = None, exceptions: list[str] | None = None, size: int = LEXICON_SIZE) -> Lexicon:
    """A lexicon from ``rows`` (text, toxic), a bounded sample; ``added`` words
    and ``exceptions`` phrases of the caller are folded and kept as they are."""
    with scratch_scope(rows.sparkSession):
        return _learn(rows, added, exceptions, size)


def _learn(rows: DataFrame, added: dict[str, float] | None, exceptions: list[str] | None, size: int) -> Lexicon:
    given = {fold(w): x for w, x in (added or {}).items()}
    phrases = [fold(p) for p in exceptions or []]
    rows = materialize(rows, "toxic-sample")  # it is read once for each of four counts
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon(given, phrases)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    share, seen = n_toxic / (n_toxic + n_clean), F.col("toxic") + F.col("clean")
    part = lambda k, p: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (seen * p))).otherwise(0.0)
    counted = materialize(_counted(rows, _patterns), "toxic-patterns")
    # log-likelihood ratio against the base rate; the bound grows with the number of patterns tried
    ranked = counted.select("pattern", odds.alias("odds"), "toxic", (2 * (part("toxic", share) + part("clean", 1 - share))).alias("g"))
    bound = 2 * math.log(max(counted.count(), 2)) - 5
    ranked = ranked.where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("g") >= bound)).orderBy(F.desc("g"), F.desc(F.length("pattern")), "pattern").limit(20 * size)
    weights: dict[str, float] = {}
    longer: dict[str, int] = {}  # beginning -> most toxic rows of a chosen pattern that starts with it
    for pattern, odds_of, toxic in ranked.select("pattern", "odds", "toxic").collect():
        known = any(pattern[:n] in weights for n in range(STEM[0] + 1, len(pattern)))
        if len(weights) < size and not known and longer.get(pattern, 0) < 0.9 * toxic:
            weights[pattern] = odds_of
            for n in range(STEM[0] + 1, len(pattern)):
                longer[pattern[:n]] = max(toxic, longer.get(pattern[:n], 0))
    lexicon = Lexicon(weights | given, phrases)
    lexicon.exceptions = phrases + _learned_exceptions(rows, weights)
    lexicon.curve = _curve(rows, lexicon)
    return lexicon


def _learned_exceptions(rows: DataFrame, weights: dict[str, float]) -> list[str]:
    """Two-word phrases with a match that occur in clean rows, and mostly there."""

    def phrases(folded: str) -> set[str]:
        words = folded.split()
        hit = [f" {w} " in weights or any(f" {w[:n]}" in weights for n in range(STEM[0], STEM[1] + 1)) for w in words]
        return {f" {words[i]} {words[i + 1]} " for i in range(len(words) - 1) if hit[i] or hit[i + 1]}

    found = _counted(rows, phrases).where((F.col("clean") >= 3) & (F.col("clean") > 4 * F.col("toxic")))
    return [r["pattern"] for r in found.orderBy(F.desc("clean"), "pattern").limit(LEXICON_SIZE).collect()]


def _curve(rows: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic regression (Newton's method with a small ridge) on the sample's features."""
    # a greatest weight and a rate for each row of the sample, of one row an id
    points = np.array([(r["rate"], r["most"], r["toxic"]) for r in rows.select(_featured(rows.sparkSession, lexicon)("text").alias("f"), "toxic").select("f.*", "toxic").collect()])
    x, y = np.column_stack([np.ones(len(points)), points[:, :2]]), points[:, 2]
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - 0.01 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        change = np.linalg.solve(hessian, gradient)
        w = w + change
        if np.abs(change).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _featured(spark, lexicon: Lexicon):
    shared, own = spark.sparkContext.broadcast(lexicon), {}

    @F.pandas_udf("struct<rate:double,most:double>")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = own.setdefault("m", shared.value.matcher())
        for part in parts:
            yield pd.DataFrame([features(*evidence(t, matcher)) for t in part], columns=["rate", "most"])

    return measure


def scorer(spark, lexicon: Lexicon):
    """A column function: text -> score. The lexicon is bounded by its size parameter."""
    set_batch_rows(spark)
    shared, own = spark.sparkContext.broadcast(lexicon), {}

    @F.pandas_udf("double")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = own.setdefault("m", shared.value.matcher())
        for part in parts:
            yield pd.Series([score(t, matcher, shared.value.curve) for t in part], dtype="float64")

    return measure.asNondeterministic()


def score_documents(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score and predicted (columns of these names are replaced)."""
    out = docs.withColumn("score", scorer(docs.sparkSession, lexicon)(F.col("text").cast("string")))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
