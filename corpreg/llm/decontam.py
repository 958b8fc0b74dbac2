"""Benchmark decontamination by SimHash of item-sized windows.

For every benchmark item, windows of as many words as the item are taken from
every document, at every start at which the window shares a five-word shingle
with the item (a window that shares none has similarity 0). A window's SimHash
is the sign, bit by bit, of the sum of its shingles' hashes, in which each further
occurrence of a shingle counts as a shingle of its own; a multi-index over
blocks of the fingerprint names the items within ``RADIUS`` bits: of
``BLOCKS`` blocks at least one differs in at most ``RADIUS // BLOCKS`` bits, so
no item within the radius is missed. These candidates are verified by exact
weighted-shingle similarity (sum of the smaller over sum of the larger counts)
of at least ``THRESHOLD``.

The items are shipped to every task, in passes of at most ``ITEMS_PER_PASS``
items, so their number is bounded whatever the benchmark's size.

Edge cases: a null text or item, or one without a word, matches nothing; an
item of fewer than five words is one shingle of all its words; a document
shorter than the item is one window; equal items are reported each; rows with
a null doc_id or item_id are matched like others; of a document's windows for
an item the most similar is reported, the first of equally similar ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textutil import bounded, mix, set_batch_rows, shingle_hashes, word_hashes

WORDS, THRESHOLD = 5, 0.8
BITS, RADIUS, BLOCKS = 64, 20, 7
ITEMS_PER_PASS = 4_000
STARTS_AT_ONCE = 32_768  # windows of a long text whose sums are held at a time
MATCH = "array<struct<item:long,start:long,words:long,similarity:double>>"


def bit_signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of summed signs (rows of ``BITS`` numbers)."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _numbered(shingles: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, occurrence number)."""
    return mix(shingles + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def window_sums(shingles: np.ndarray, size: int) -> np.ndarray:
    """Summed signs of every window of ``size`` shingles, the occurrences of a
    shingle within a window counting as different shingles: a window differs from
    the one before it by the last occurrence of the shingle that it leaves and by
    one more of the shingle that it takes in."""
    n = len(shingles)
    code = np.unique(shingles, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    keys = code[order] * (n + 1) + order  # (code, place), sorted

    def among(of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many shingles with these codes lie in places a to b."""
        return np.searchsorted(keys, of * (n + 1) + b) - np.searchsorted(keys, of * (n + 1) + a)

    at = np.arange(n)
    first = bit_signs(_numbered(shingles[:size], among(code[:size], np.zeros(size, np.int64), at[:size]))).sum(0)
    out = np.empty((n - size + 1, BITS), np.int32)
    out[0] = first
    if n > size:
        a = at[: n - size]
        left = among(code[a], a, a + size) - 1
        taken = among(code[a + size], a + 1, a + size)
        out[1:] = bit_signs(_numbered(shingles[a + size], taken)) - bit_signs(_numbered(shingles[a], left))
        np.cumsum(out, axis=0, out=out)
    return out


def blocks_of(prints: np.ndarray) -> list[np.ndarray]:
    """The values of the fingerprint's blocks."""
    edges = np.linspace(0, BITS, BLOCKS + 1).astype(int)
    return [((prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class MultiIndex:
    """Which fingerprints are within the radius of a given one."""

    def __init__(self, prints: np.ndarray):
        self.prints, self.tables = prints, []
        edges = np.linspace(0, BITS, BLOCKS + 1).astype(int)
        for values, a, b in zip(blocks_of(prints), edges[:-1], edges[1:], strict=True):
            table = np.zeros((1 << (b - a), len(prints)), bool)
            for flips in range(RADIUS // BLOCKS + 1):
                for bits in combinations(range(b - a), flips):
                    table[values ^ sum(1 << k for k in bits), np.arange(len(prints))] = True
            self.tables.append(table)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) pairs within the radius."""
        found = np.zeros((len(prints), len(self.prints)), bool)
        for table, values in zip(self.tables, blocks_of(prints), strict=True):
            found |= table[values]
        query, item = np.nonzero(found)
        close = np.bitwise_count(prints[query] ^ self.prints[item]) <= RADIUS
        return query[close], item[close]


    def near_in_parts(self, prints: np.ndarray, cells: int = 1 << 24) -> Iterator[tuple[int, int]]:
        """The pairs of :meth:`near`, a bounded number of comparisons at a time."""
        step = max(1, cells // max(len(self.prints), 1))
        for at in range(0, len(prints), step):
            query, item = self.near(prints[at : at + step])
            yield from zip((query + at).tolist(), item.tolist(), strict=True)


@dataclass
class Item:
    key: int
    words: int
    shingles: np.ndarray
    counts: dict[int, int]


class Benchmark:
    """The items of one pass: postings of their shingles by shingle length,
    and a multi-index of the fingerprints for each window size."""

    def __init__(self, items: list[tuple[int, str]]):
        hashes, begin = word_hashes([t for _, t in items])
        self.items: list[Item] = []
        for (key, _), a, b in zip(items, begin[:-1], begin[1:], strict=True):
            if b > a:
                own = shingle_hashes(hashes[a:b], min(WORDS, int(b - a)))
                self.items.append(Item(key, int(b - a), own, _counts(own)))
        self.postings: dict[int, tuple] = {}
        for k in sorted({min(WORDS, i.words) for i in self.items}):
            pairs = [(s, j) for j, item in enumerate(self.items) if min(WORDS, item.words) == k for s in item.counts]
            shingle, item = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs])
            order = np.argsort(shingle, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(shingle >> np.uint64(44)).astype(np.int64)] = True
            self.postings[k] = (shingle[order], item[order], seen)
        self.by_size: dict[int, tuple[np.ndarray, MultiIndex]] = {}
        for n in sorted({i.words for i in self.items}):
            own = np.array([j for j, item in enumerate(self.items) if item.words == n])
            prints = np.concatenate([fingerprints(window_sums(self.items[j].shingles, len(self.items[j].shingles))) for j in own])
            self.by_size[n] = (own, MultiIndex(prints))

    def matches(self, texts: list[str], threshold: float = THRESHOLD) -> list[list[tuple]]:
        """Of each text: (item position, start word, words, similarity)."""
        hashes, begin = word_hashes(texts)
        out: list[list[tuple]] = [[] for _ in texts]
        for k, (shingles, owners, seen) in self.postings.items():
            own = shingle_hashes(hashes, k)
            at = np.flatnonzero(seen[(own >> np.uint64(44)).astype(np.int64)])
            left = np.searchsorted(shingles, own[at], "left")
            right = np.searchsorted(shingles, own[at], "right")
            text = np.searchsorted(begin, at, "right") - 1
            real = (right > left) & (at + k <= begin[text + 1])
            hits: dict[tuple[int, int], list[int]] = {}
            for p, t, a, b in zip(at[real].tolist(), text[real].tolist(), left[real].tolist(), right[real].tolist(), strict=True):
                for j in owners[a:b].tolist():
                    hits.setdefault((t, self.items[j].words), []).append(p)
            for (t, n), found in hits.items():
                first, last = int(begin[t]), int(begin[t + 1])
                out[t] += self._windows(own, first, last, n, k, found, threshold)
        return out

    def _windows(self, shingles: np.ndarray, first: int, last: int, n: int, k: int, found: list[int], threshold: float) -> list[tuple]:
        size = min(n, last - first)  # words of a window
        if size < k:
            return []
        marked = np.zeros(last - size - first + 2, np.int64)  # starts whose window holds a shared shingle
        for p in found:
            marked[max(0, p + k - size - first)] += 1
            marked[min(p, last - size) - first + 1] -= 1
        starts = np.flatnonzero(np.cumsum(marked[:-1]) > 0)
        if not len(starts):
            return []
        items, index = self.by_size[n]
        best: dict[int, tuple] = {}
        cuts = np.flatnonzero(np.diff(starts) > size) + 1  # separate stretches of the text
        for run in np.split(starts, np.union1d(cuts, np.arange(STARTS_AT_ONCE, len(starts), STARTS_AT_ONCE))):
            a, b = first + int(run[0]), first + int(run[-1]) + size - k + 1
            prints = fingerprints(window_sums(shingles[a:b], size - k + 1)[run + first - a])
            for q, i in index.near_in_parts(prints):
                item, start = self.items[items[i]], int(run[q])
                similarity = weighted_similarity(item.counts, _counts(shingles[first + start : first + start + size - k + 1]))
                known = best.get(items[i])
                if similarity >= threshold and (known is None or (-similarity, start) < (-known[3], known[1])):
                    best[items[i]] = (int(items[i]), start, size, similarity)
        return list(best.values())


def _counts(shingles: np.ndarray) -> dict[int, int]:
    found, n = np.unique(shingles, return_counts=True)
    return dict(zip(found.tolist(), n.tolist(), strict=True))


def weighted_similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Sum of the smaller weights over the sum of the larger ones."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def matcher(spark, items: list[tuple[int, str]], threshold: float = THRESHOLD):
    """A column function: text -> array of matches with these (key, text) items;
    ``item`` is the position in ``items``."""
    set_batch_rows(spark)
    shared, own = spark.sparkContext.broadcast([t for _, t in items]), {}

    @F.pandas_udf(MATCH)
    def match(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = own.setdefault("b", Benchmark(list(enumerate(shared.value))))
        for part in parts:
            out: list = []
            for group in bounded(((t or "",) for t in part), lambda r: len(r[0])):
                for found in held.matches([t for (t,) in group], threshold):
                    out.append([{"item": held.items[j].key, "start": s, "words": n, "similarity": x} for j, s, n, x in found])
            yield pd.Series(out, dtype=object)

    return match.asNondeterministic()


def passes(benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) that hold a word, in passes of about ``items_per_pass``."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text")).where("text is not null")
    n = -(-items.count() // items_per_pass)
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if own:
            yield [(r["item_id"], r["text"]) for r in own]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity) of every match."""
    spark, out = docs.sparkSession, None
    for items in passes(benchmark, items_per_pass):
        ids = F.array(*[F.lit(k).cast("long") for k, _ in items])
        found = docs.select(F.col("doc_id").cast("long"), F.explode(matcher(spark, items, threshold)(F.col("text").cast("string"))).alias("m"))
        found = found.select("doc_id", F.get(ids, F.col("m.item").cast("int")).alias("item_id"), F.col("m.start").alias("start_word"), F.col("m.words").alias("n_words"), F.col("m.similarity").alias("similarity"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, start_word long, n_words long, similarity double")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``docs`` without the rows that match an item; all columns are kept."""
    out = docs
    for items in passes(benchmark, items_per_pass):
        found = out.withColumn("__matches", matcher(docs.sparkSession, items, threshold)(F.col("text").cast("string")))
        out = found.where(F.size("__matches") == 0).drop("__matches")
    return out
