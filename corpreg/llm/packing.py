"""Best-fit decreasing packing of tokenized documents into fixed-length sequences.

Documents are tokenized in parallel and cut only where they exceed the
sequence length. Best-fit decreasing puts the longest piece first, each into
the open sequence with the least room that still takes it. Pieces of equal
length are interchangeable, so the packing is decided on the histogram of
lengths (at most ``capacity`` rows, whatever the corpus size): a segment tree
over remaining capacities names the tightest open sequence in logarithmic
time, and a run of equally long pieces fills a run of equally full sequences
in one step. The steps are then applied to all pieces in parallel: a piece's
rank among those of its length names its sequence and offset.

Edge cases: a null or empty text has only the end token; repeated rows are
packed as often as they occur; an empty table gives no rows; doc_id may be
null or repeated (it is only carried along); other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textutil import KEPT, TwoGenerationCache, bounded, release_memory, set_batch_rows

CAPACITY = 4096
END_ID = 1
CACHE_PARTS, CACHE_WORDS = 500_000, 250_000


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others in turn from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


_BYTES = _byte_letters()
_MARKS = ".,;:!?"


class Tokenized:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its white-space separated parts, which are kept for the
    parts seen lately. A part that is a word of Latin-1 letters, with marks
    after it or not, is the word and the marks to the tokenizer; the word goes
    straight to its merge step, lower-cased and with its bytes mapped."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.merges = self.tokenizer.model
        self.cache, self.words = TwoGenerationCache(CACHE_PARTS), TwoGenerationCache(CACHE_WORDS)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _whole(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def _merged(self, words: list[str]) -> list[bytes]:
        mapped = (w if w.isascii() else "".join(_BYTES[b] for b in w.encode("utf-8")) for w in words)
        return [b"".join([self.id_bytes[t.id] for t in self.merges.tokenize(m)]) for m in mapped]

    def _encode(self, parts: list[str]) -> list[bytes]:
        split: list[tuple[str, str] | None] = []
        for part in parts:
            word = part.rstrip(_MARKS)
            plain = word.isalpha() and (word.isascii() or max(word) <= "\xff")
            split.append((word.lower(), part[len(word) :]) if plain else None)
        words = self.words.fetch({s[0] for s in split if s}, self._merged)
        marks = {m: self._whole(m) if m else b"" for m in {s[1] for s in split if s}}
        return [words[s[0]] + marks[s[1]] if s else self._whole(part) for s, part in zip(split, parts, strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        # the four separators are spaces to str.split() but not to the tokenizer
        split = [[t] if "\x1c" in t or "\x1d" in t or "\x1e" in t or "\x1f" in t else t.split() for t in texts]
        known = self.cache.fetch(set().union(*split), self._encode) if split else {}
        return [b"".join(map(known.__getitem__, parts)) for parts in split]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids,
    if kept), with the task that made it and its rank there among pieces of its length."""
    set_batch_rows(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", *["ids"] * keep_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * keep_ids]
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in KEPT:
            release_memory()
            KEPT[tokenizer_file] = Tokenized(tokenizer_file)
        tokenized, task, seen = KEPT[tokenizer_file], TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group in bounded(rows, lambda r: len(r[1] or "")):
                out = [[] for _ in names]
                for (doc, _), ids in zip(group, tokenized.ids([t or "" for _, t in group]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        for column, value in zip(out, (doc, k, at // 4, n, zlib.crc32(own), task, int(seen[n])), strict=False):
                            column.append(value)
                        seen[n] += 1
                        if keep_ids:
                            out[-1].append(np.frombuffer(own, "<u4").astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long" + ", ids array<long>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


class Tightest:
    """Segment tree over remaining capacities: which of them have an open sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def at_least(self, length: int) -> int | None:
        """The smallest marked capacity that is not under ``length``."""
        i = length + self.size
        while not self.open[i]:
            while i & 1:  # a right child: what follows it starts above
                i //= 2
                if i <= 1:
                    return None
            if i <= 1:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Steps (length, first rank, first sequence, pieces per sequence, offset
    of the first) of best-fit decreasing over ``counts`` pieces of each length;
    pieces from a step's first rank to the next step's go to consecutive sequences."""
    tree, rooms, opened, steps = Tightest(capacity), [deque() for _ in range(capacity + 1)], 0, []

    def give(room: int, run: tuple[int, int]) -> None:
        if room and run[1]:
            rooms[room].append(run)
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:
                room, run = capacity, (opened, -(-left // (capacity // length)))
                opened += run[1]
            else:
                run = rooms[room].popleft()
                tree.mark(room, bool(rooms[room]))
            first, n = run
            each = room // length
            full = min(n, left // each)
            if full:
                steps.append((length, rank, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                give(room - each * length, (first, full))
            if left and full < n:  # the last of them in a sequence that could take more
                steps.append((length, rank, first + full, left, capacity - room))
                give(room - left * length, (first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                rooms[room].appendleft((first + full, n - full))
                tree.mark(room, True)
    return np.array(steps, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset.

    The tokenized pieces are written once. Ranks within a length come from
    each task's own count plus the counts of earlier tasks, so no length is
    ever gathered in one place."""
    spark = docs.sparkSession
    made = materialize(pieces(docs, tokenizer_file, capacity, end_id, keep_ids), "pieces")
    per_task = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, capacity))

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = plan.value[np.lexsort((plan.value[:, 1], plan.value[:, 0]))]
        starts = (steps[:, 0] << 48) + steps[:, 1]
        for part in parts:
            length, rank = part["length"].to_numpy(), part["rank"].to_numpy() + part["before"].to_numpy()
            step = steps[np.searchsorted(starts, (length << 48) + rank, "right") - 1]
            turn = rank - step[:, 1]
            part["sequence_id"] = step[:, 2] + turn // np.maximum(step[:, 3], 1)
            part["offset"] = step[:, 4] + turn % np.maximum(step[:, 3], 1) * length
            yield part.drop(columns=["task", "rank", "before"])

    joined = made.join(offsets, ["length", "task"]).select(*made.columns, "before")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids + ", sequence_id long, offset long"
    return joined.mapInPandas(place, schema)
