"""Shared helpers of the text operators: batches of bounded size and word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1


def _odd_base() -> tuple[int, int]:
    base = 0x9E3779B97F4A7C15
    return base, pow(base, -1, 1 << 64)


_BASE, _BASE_INV = _odd_base()
SEGMENT = 1 << 20

_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = np.array([chr(b).isalnum() or b >= 128 or b == 95 for b in range(256)])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _POW_INV = _powers(_BASE, SEGMENT + 1), _powers(_BASE_INV, SEGMENT + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _segment_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = np.zeros(len(data) + 2, dtype=bool)
    word[1:-1] = _IS_WORD[data]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _POW[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * _POW_INV[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every text, and where each text's words begin
    (one more entry than texts). Words are runs of ASCII letters, digits,
    underscores and non-ASCII characters of the lower-cased text, hashed by a
    polynomial over their bytes; ``None`` counts as empty."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw) + b"\n"
    lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        if end < len(data):  # cut where no word is cut
            tail = ~_IS_WORD[np.frombuffer(data, np.uint8, SEGMENT, at)]
            gaps = np.flatnonzero(tail)
            if len(gaps):
                end = at + int(gaps[-1]) + 1
        s, h = _segment_hashes(np.frombuffer(data, np.uint8, end - at, at))
        starts.append(s + at)
        hashes.append(h)
        at = end
    begin = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(lengths, out=begin[1:])
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.searchsorted(where, begin)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (``len(words) - k + 1``)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(_BASE) + words[i : i + n]
    return mix(h)


def bounded(items: Iterable[tuple], size_of, limit: int = 4 << 20) -> Iterator[list[tuple]]:
    """Cut a stream of items into lists of at most ``limit`` total size (a
    larger single item gets a list of its own)."""
    held, size = [], 0
    for item in items:
        n = size_of(item)
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append(item)
        size += n
    if held:
        yield held


class TwoGenerationCache:
    """Keeps the values computed for recent keys: at most twice ``size``
    entries; filling up drops only those not used since the last time."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def fetch(self, keys: set, compute) -> dict:
        """A dict that holds all ``keys``; ``compute(list)`` gives the values of missing ones."""
        absent = keys - self.new.keys()
        if len(self.new) + len(absent) > self.size:
            self.old, self.new = self.new, {}
            absent = set(keys)
        found = [k for k in absent if k in self.old]
        for k in found:
            self.new[k] = self.old[k]
        absent.difference_update(found)
        if absent:
            missing = list(absent)
            self.new.update(zip(missing, compute(missing), strict=True))
        return self.new


# What an operator keeps in a worker from task to task; the next operator's tasks drop it.
KEPT: dict = {}


def release_memory() -> None:
    """Give back what earlier tasks left in this Python worker, which serves all
    operators of a session one after the other: kept caches, and freed memory
    that the allocators still hold."""
    KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def set_batch_rows(spark, rows: int = 2000) -> None:
    """Lower the rows per Arrow batch, so that a batch of long texts stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
