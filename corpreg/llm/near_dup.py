"""Near-duplicate documents by order MinHash, verified by banded alignment.

A text's k-mers are its runs of two words, labelled with their occurrence
number so that repetitions count. Each of ``SKETCHES`` random orders picks the
``PICKS`` smallest labelled k-mers and keeps them in text order: two texts get
the same sketch only if they share these k-mers in the same order, which makes
the collision rate follow edit similarity rather than set overlap. A text of
at most ``SHORT`` words has all its ordered pairs of k-mers as sketches.

Texts that share a sketch with a leader (the smallest key of the bucket) are
candidates; they are accepted if their word sequences have an edit similarity
(1 - distance / longer length) of at least ``THRESHOLD``, found by an
alignment in a band that can hold that many edits. Texts that their leader
rejects get a new leader among themselves, for up to ``ROUNDS`` rounds; that
only gathers large groups cheaply. Then the buckets that still hold several
classes are parted by length (see :func:`length_groups`), and the texts of
different classes in a group are candidates. Groups that would make more than
``MEETS`` pairs a text are compared by a prefix filter instead that is complete
for the threshold (see :func:`prefix_grams`): every two of their texts that are
similar and not yet in one class share a gram there and are aligned, accepted or
rejected before. So two similar texts that share a sketch are always in one
class, the connected components of accepted links.

Before texts are fetched for an alignment, pairs go whose lengths, or whose
samples of labelled k-mers, show that they cannot be within the threshold (see
:func:`may_be_similar`).

Equal texts are one text throughout (their links are those of one of them), and
a bucket is reduced by aggregation and an equi-join, so a group of copies is
neither gathered nor expanded into pairs. Candidate search is randomized: a
pair is missed if no sketch agrees. At the threshold itself a text of 100
words or more with every fifth word replaced, the worst case, has a k-mer
overlap of about 0.43, so one sketch agrees with chance 0.18 and all
``SKETCHES`` miss at about 4 in 10,000 (20 words: 1 in 1,000; 15 words: 2 in
1,000). Two texts of at most ``SHORT`` words are never missed.

Edge cases: a null text, or one without a word, is alone in its class; a text
of one word is one k-mer; rows with equal text are one class,
also when their doc_id repeats; a class is named by its smallest doc_id, null
if all are null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope, shuffles_deleted
from .textutil import bounded, mix, release_memory, set_batch_rows, shingle_hashes, word_hashes

WORDS, SKETCHES, PICKS, THRESHOLD, ROUNDS = 2, 40, 2, 0.8, 4
SHORT = 12
MEETS = 32  # pairs a text of a group of a bucket, up to which all of them are met
GRAM, COMMON = 2, 3  # words of a gram of the samples and of the prefix filter; grams that it wants in common
CELLS, CELL_PARTS = 1 << 20, 16
GRAM_PARTS, ROWS_AT_ONCE = 16, 10_000_000
SAMPLE, SURE = 128, 5.5
_TOP = np.uint64((1 << 64) - 1)
_LAST = np.uint32((1 << 32) - 1)
_ODD = np.random.Generator(np.random.PCG64(97)).integers(0, 1 << 31, 256, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def labelled(shingles: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, occurrence number within its text)."""
    keyed = mix(shingles + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    same = np.concatenate([[False], keyed[order[1:]] == keyed[order[:-1]]])
    if not same.any():
        return mix(shingles)
    at = np.arange(len(order))
    number = at - np.maximum.accumulate(np.where(same, 0, at))
    count = np.empty(len(order), np.uint64)
    count[order] = number
    return mix(shingles + count * np.uint64(0xD1B54A32D192ED03))


def sketch(texts: list[str], words: int = WORDS, sketches: int = SKETCHES, picks: int = PICKS, short: int = SHORT, samples: list[bytes] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct sketches of each text, and the number of words of each text.
    ``samples`` takes the :func:`gram_samples` of the texts, if the k-mers are grams."""
    hashes, begin = word_hashes(texts)
    counts = np.diff(begin)
    parts, sizes = [], np.maximum(np.where(counts >= words, counts - words + 1, np.minimum(counts, 1)), 0)
    whole = shingle_hashes(hashes, words)
    for i, n in enumerate(counts.tolist()):
        if n >= words:
            parts.append(whole[begin[i] : begin[i] + n - words + 1])
        elif n:
            parts.append(shingle_hashes(hashes[begin[i] : begin[i + 1]], n))
    out = np.zeros((len(texts), sketches), np.uint64)
    owners = np.flatnonzero(sizes)
    if not len(owners):
        if samples is not None:
            samples += [b""] * len(texts)
        return [out[i, :0] for i in range(len(texts))], counts
    shingles, size = np.concatenate(parts), sizes[owners]
    start = np.cumsum(size) - size
    labels = (labelled(shingles, np.repeat(np.arange(len(owners)), size)) >> np.uint64(32)).astype(np.uint32)
    if samples is not None:
        samples += [b""] * len(texts)
        for i, a, n in zip(owners.tolist(), start.tolist(), size.tolist(), strict=True):
            samples[i] = _sample(labels[a : a + n])
    for j in range(sketches):
        ranks = labels * _ODD[j]
        chosen = np.zeros((picks, len(owners)), np.int64)
        for k in range(picks):
            least = np.minimum.reduceat(ranks, start)
            hits = np.flatnonzero(ranks == np.repeat(least, size))
            of = np.searchsorted(start, hits, "right") - 1
            first = np.concatenate([[True], of[1:] != of[:-1]])  # one for each text
            chosen[k] = hits[first]
            ranks[chosen[k]] = _LAST
            if k:  # a text with fewer k-mers repeats its first
                chosen[k] = np.where(size > k, chosen[k], chosen[0])
        value = np.zeros(len(owners), np.uint64)  # an order's picks may meet any others
        for at in np.sort(chosen, 0):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + shingles[at])
        out[owners, j] = value
    found = [np.unique(out[i]) if counts[i] else out[i, :0] for i in range(len(texts))]
    for i, part in zip(np.flatnonzero(sizes).tolist(), parts, strict=True):
        if counts[i] <= short and picks <= len(part):
            found[i] = np.unique(_all_picks(part, picks))
    return found, counts


def _all_picks(shingles: np.ndarray, picks: int) -> np.ndarray:
    """The sketches of every choice of ``picks`` k-mers in text order."""
    chosen = np.array(list(combinations(range(len(shingles)), picks))).T
    value = np.zeros(chosen.shape[1], np.uint64)
    for at in chosen:
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + shingles[at])
    return value


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common beginning and end, the shorter one first."""
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differs[0]) if len(differs) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    return (a, b) if len(a) <= len(b) else (b, a)


def similar_pairs(pairs: list[tuple[np.ndarray, np.ndarray]], threshold: float = THRESHOLD) -> list[bool]:
    """Whether the edit similarity of two word sequences reaches ``threshold``,
    for many pairs: banded alignment, in a band that is widened up to as many
    edits as the threshold allows for the pairs that a narrow one leaves open."""
    out, open_ = [False] * len(pairs), []
    for k, (a, b) in enumerate(pairs):
        allowed = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) > allowed:
            continue
        a, b = _trimmed(a, b)
        if not len(a):
            out[k] = len(b) <= allowed
            continue
        # words that have no partner must be edited
        values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        one, two = np.bincount(index[: len(a)], minlength=len(values)), np.bincount(index[len(a) :], minlength=len(values))
        least = len(b) - int(np.minimum(one, two).sum())
        if least <= allowed:
            open_.append((k, a, b, allowed, least))
    edits = 8
    while open_:
        # a band narrower than the edits that are sure is of no use
        now, left = [p for p in open_ if p[4] <= edits], [p for p in open_ if p[4] > edits]
        for (k, a, b, allowed, least), d in zip(now, banded_distances([(p[1], p[2]) for p in now], min(edits, max((p[3] for p in now), default=0))), strict=True):
            if d <= min(edits, allowed):
                out[k] = True
            elif edits < allowed:
                left.append((k, a, b, allowed, least))
        open_, edits = left, 4 * edits
    return out


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    return similar_pairs([(a, b)], threshold)[0]


def banded_distance(a: np.ndarray, b: np.ndarray, edits: int) -> int:
    return int(banded_distances([(a, b) if len(a) <= len(b) else (b, a)], edits)[0])


def banded_distances(pairs: list[tuple[np.ndarray, np.ndarray]], edits: int, cells: int = 2_000_000) -> np.ndarray:
    """Edit distances of pairs (shorter, longer) as far as they are at most
    ``edits``, else something above it. With lengths n apart, so many edits reach
    (edits + n) / 2 diagonals above the main one and (edits - n) / 2 below it at most."""
    out = np.full(len(pairs), edits + 1, np.int64)
    apart = np.array([len(b) - len(a) for a, b in pairs], np.int64)
    for least, most in ((0, edits // 4), (edits // 4 + 1, edits)):
        own = np.flatnonzero((apart >= least) & (apart <= most))
        if len(own):
            out[own] = _banded([pairs[k] for k in own], edits, (edits - least) // 2, (edits + most) // 2, cells)
    return out


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], edits: int, below: int, above: int, cells: int) -> np.ndarray:
    """Row by row over the diagonals from -below to above, for pairs of like length side by side."""
    out = np.full(len(pairs), edits + 1, np.int64)
    order = sorted(range(len(pairs)), key=lambda k: -len(pairs[k][0]))
    width, far, at = below + above + 1, np.int32(2 * edits + 2), 0
    step = np.arange(width, dtype=np.int32)
    while at < len(order):
        longest = max(len(pairs[order[at]][1]), 1)
        own = order[at : at + max(1, cells // (2 * longest + 10 * width))]
        at += len(own)
        sizes = np.array([len(pairs[k][0]) for k in own])
        reach = max(len(pairs[k][1]) for k in own)
        one, two = np.full((len(own), int(sizes[0])), _TOP, np.uint64), np.full((len(own), reach + 2 * width), _TOP - np.uint64(1), np.uint64)
        for i, k in enumerate(own):  # b[j] is at j + width
            one[i, : sizes[i]], two[i, width : width + len(pairs[k][1])] = pairs[k]
        row = np.where(step >= below, step - np.int32(below), far) + np.zeros((len(own), 1), np.int32)
        deleted = np.full(row.shape, far, np.int32)
        result = np.where(sizes == 0, [len(pairs[k][1]) for k in own], 0)
        final = np.array([len(pairs[k][1]) - len(pairs[k][0]) for k in own]) + below
        alive = len(own)
        for i in range(1, int(sizes[0]) + 1):
            while sizes[alive - 1] < i:
                alive -= 1
            row = row[:alive]
            first = i - 1 - below + width
            best = row + (two[:alive, first : first + width] != one[:alive, i - 1 : i])
            deleted = deleted[:alive]
            deleted[:, :-1] = row[:, 1:]
            deleted[:, -1] = far
            np.minimum(best, deleted + 1, out=best)
            if i <= below:  # cells left of the first column, and the column of no words
                best[:, : below - i], best[:, below - i] = far, i
            row = np.minimum(np.minimum.accumulate(best - step, axis=1) + step, far).astype(np.int32)
            ended = np.flatnonzero(sizes[:alive] == i)
            result[ended] = row[ended, final[ended]]
        out[own] = np.minimum(result, edits + 1)
    return out


def allowed_edits(words, threshold: float = THRESHOLD):
    """How many edits the threshold allows if the longer text has ``words`` words (a column)."""
    return F.floor((1 - threshold) * words + 1e-9)


def gram_samples(texts: list[str]) -> list[bytes]:
    """Of each text the ``SAMPLE`` smallest 32-bit hashes of its labelled grams, in order."""
    labels, owner, _ = _grams(texts)
    small = (labels >> np.uint64(32)).astype(np.uint32)
    return [_sample(x) for x in np.split(small, np.searchsorted(owner, np.arange(1, len(texts))))] if texts else []


def _sample(labels: np.ndarray) -> bytes:
    return np.unique(np.partition(labels, SAMPLE - 1)[:SAMPLE] if len(labels) > SAMPLE else labels).tobytes()


def may_be_similar(a: np.ndarray, b: np.ndarray, a_words: int, b_words: int, threshold: float = THRESHOLD) -> bool:
    """Whether texts with these samples can be within the threshold. So many
    edits as it allows leave a known number of labelled grams common, hence a
    least overlap of the gram sets. Of two whole sets it is counted; otherwise
    the grams below both samples' ends are a random sample of the union, and
    an overlap ``SURE`` standard deviations below the least one rules the pair out
    (wrongly with a chance below 1 in 10 million)."""
    longer = max(a_words, b_words)
    wanted = longer - GRAM + 1 - GRAM * int((1 - threshold) * longer + 1e-9)
    a_grams, b_grams = max(a_words - GRAM + 1, 1), max(b_words - GRAM + 1, 1)
    if wanted <= 0:
        return True
    if wanted > min(a_grams, b_grams):
        return False
    ends = [x[-1] for x, n in ((a, a_grams), (b, b_grams)) if n > SAMPLE]
    if ends:
        a, b = (x[: np.searchsorted(x, min(ends), "right")] for x in (a, b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    if not ends:  # grams of one text whose short hashes are equal count once
        return shared + (a_grams - len(a)) + (b_grams - len(b)) >= wanted
    n, least = len(a) + len(b) - shared, wanted / (a_grams + b_grams - wanted)
    return shared + 1 >= n * least - SURE * np.sqrt(n * least * (1 - least))


def text_key(text):
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def sketched(docs: DataFrame, **options) -> DataFrame:
    """doc_id, key, words, sketches and sample of every row; key is null without words."""
    set_batch_rows(docs.sparkSession)
    names = ["doc_id", "key", "words", "sketches", "sample"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group in bounded(rows, lambda r: len(r[1] or "")):
                texts: dict[str, int] = {}
                at = [texts.setdefault(t or "", len(texts)) for _, t in group]
                samples: list[bytes] = []
                values, counts = sketch(list(texts), samples=samples, **options)
                values = [v.view(np.int64) for v in values]
                keys = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() if n else None for t, n in zip(texts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in group], pa.int64()), pa.array([keys[i] for i in at], pa.binary()),
                    pa.array(counts[at], pa.int64()), pa.array([values[i] for i in at], pa.list_(pa.int64())),
                    pa.array([samples[i] for i in at], pa.binary()),
                ], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, key binary, words long, sketches array<long>, sample binary")


def plausible(pairs: DataFrame, samples: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose lengths and samples leave the threshold possible;
    ``samples``: key, words, sample of every text."""
    left, right = (samples.select(F.col("key").alias(k), F.col("words").alias(f"{k}_words"), F.col("sample").alias(f"{k}_sample")) for k in "ab")
    joined = pairs.join(left, "a").join(right, "b").where(F.abs(F.col("a_words") - F.col("b_words")) <= allowed_edits(F.greatest("a_words", "b_words"), threshold))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a_sample", "b_sample", "a_words", "b_words")), strict=True)
            near = pa.array([may_be_similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), n, m, threshold) for x, y, n, m in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    return joined.select("a", "b", "a_sample", "b_sample", "a_words", "b_words").mapInArrow(work, "a binary, b binary")


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled grams of all texts (a text of one word is its own gram), their texts, and the words of each text."""
    hashes, begin = word_hashes(texts)
    counts = np.diff(begin)
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), counts
    whole = shingle_hashes(hashes, GRAM)
    parts = [whole[a : b - GRAM + 1] if b - a >= GRAM else shingle_hashes(hashes[a:b], max(int(b - a), 1)) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
    return labelled(np.concatenate(parts), owner), owner, counts


def prefix_length(words: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """How many of its first grams, in any one order of all grams, a text of so
    many words needs. Of two texts, the longer of L words, d edits apart, at
    least L - g + 1 - g * d labelled grams of g words are common; so the first
    n - L + g * d + COMMON grams of a text of n words have COMMON in common with
    those of the other (all, if fewer are sure).
    The greatest is at an L less than one more allowed edit away."""
    more = np.arange(int(np.ceil(1 / (1 - threshold))) + 1)
    edits = ((1 - threshold) * (words[:, None] + more) + 1e-9).astype(np.int64)
    return (GRAM * edits - more).max(1) + COMMON


def prefix_grams(bodies: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, label, size, words, gram): the rarest labelled grams of each of ``bodies`` (id, label, size, text),
    as many as :func:`prefix_length` says: two texts within the threshold share
    one of them. Rarity is the number of texts by hash cell (a bounded table),
    which only serves to keep the groups small: any order is complete."""
    spark = bodies.sparkSession

    def groups(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
        return bounded(zip(*(c.to_pylist() for c in batch.columns), strict=True), lambda r: len(r[-1]))

    # a task's counts are a few packed rows, whatever it read
    def rows(total: np.ndarray) -> pa.RecordBatch:
        parts = np.minimum(total, (1 << 32) - 1).astype(np.uint32).reshape(CELL_PARTS, -1)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(CELL_PARTS, dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for group in groups(batch):
                total += np.bincount((_grams([r[-1] for r in group])[0] % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        if total.any():
            yield rows(total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[part] = held.get(part, 0) + np.frombuffer(raw, np.uint32).astype(np.int64)
        if held:
            packed = [np.minimum(x, (1 << 32) - 1).astype(np.uint32).tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])

    schema = "part int, counts binary"
    with shuffles_deleted(spark):
        found = bodies.select("text").mapInArrow(count, schema).repartition(CELL_PARTS, "part").mapInArrow(summed, schema).collect()  # CELL_PARTS rows
    table = np.zeros((CELL_PARTS, CELLS // CELL_PARTS), np.uint32)
    for r in found:
        table[r["part"]] = np.frombuffer(r["counts"], np.uint32)
    table = table.ravel()
    shared = spark.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for group in groups(batch):
                labels, owner, counts = _grams([r[-1] for r in group])
                order = np.lexsort((labels, shared.value[(labels % np.uint64(CELLS)).astype(np.int64)], owner))
                sizes = np.bincount(owner, minlength=len(group))
                rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                own = order[rank < np.repeat(prefix_length(counts, threshold), sizes)]
                ids, classes_, sizes_ = (np.array([r[k] for r in group], np.int64) for k in (0, 1, 2))
                columns = [ids[owner[own]], classes_[owner[own]], sizes_[owner[own]], counts[owner[own]].astype(np.int32), labels[own].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "label", "size", "words", "gram"])

    return bodies.select("id", "label", "size", "text").mapInArrow(work, "id long, label long, size long, words int, gram long")


def length_groups(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``members`` (bucket, key, words, label) of groups that hold several labels:
    bucket, band, key, words, label, the group's most frequent label ``most``, and
    whether it makes at most ``MEETS`` pairs of different labels a text (``few``).
    A text is in the band of its length and the next one, each wider than the
    threshold lets lengths differ, so similar texts of a bucket share a group."""
    width = 1.001 * max(-float(np.log(threshold)), 0.01)
    band = F.floor(F.log(F.col("words").cast("double")) / width).cast("int")
    placed = members.select("bucket", F.explode(F.array(band, band + 1)).alias("band"), "key", "words", "label")
    of_label = placed.groupBy("bucket", "band", "label").agg(F.count("*").alias("n"))
    n = F.sum("n")
    groups = of_label.groupBy("bucket", "band").agg(F.max_by("label", F.struct("n", "label")).alias("most"), ((n * n - F.sum(F.col("n") * F.col("n"))) <= 2 * MEETS * n).alias("few"), F.count("*").alias("labels"))
    return placed.join(groups.where("labels > 1").drop("labels"), ["bucket", "band"])


def pairs_within(groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All pairs (a, b) of :func:`length_groups` with different labels whose lengths
    leave the threshold possible. One of a pair has not the most frequent label."""
    one = groups.where("label <> most").select("bucket", "band", F.col("key").alias("a"), F.col("words").alias("a_words"), F.col("label").alias("a_label"))
    two = groups.select("bucket", "band", "most", F.col("key").alias("b"), F.col("words").alias("b_words"), F.col("label").alias("b_label"))
    near = F.abs(F.col("a_words") - F.col("b_words")) <= allowed_edits(F.greatest("a_words", "b_words"), threshold)
    met = one.join(two, ["bucket", "band"]).where("b_label = most or a_label < b_label").where(near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def pairs_across(bodies: DataFrame, samples: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All pairs (a, b) of ``bodies`` (key, text) with different ``labels`` (key,
    label) that the prefix filter, lengths and samples leave possible. A group of
    one label is met as a whole, so it is not expanded into its own pairs."""
    # 64 bits stand for a key and a label in the join: equal ids of two texts add a candidate, equal
    # labels of two classes (chance below 1 in 10 million up to a million classes) would hide theirs
    ids = samples.select("key", F.xxhash64("key").alias("id"))
    tagged = labels.select("key", F.xxhash64("key").alias("id"), F.xxhash64("label").alias("label"))
    # small tables are written first: the planner then sees their sizes, and need not shuffle the texts or the grams to meet them
    tagged = materialize(tagged.join(tagged.groupBy("label").agg(F.count("*").alias("size")), "label"), "tagged")
    with scratch_scope(bodies.sparkSession):
        part = F.pmod("gram", F.lit(GRAM_PARTS)).cast("int").alias("part")
        grams = materialize(prefix_grams(bodies.join(tagged, "key"), threshold).select("*", part), "grams", partition_by=["part"])
        # grams of one label go. Parts are taken one after the other, so that the shuffles of a few million rows are on disk at a time
        step = max(1, GRAM_PARTS * ROWS_AT_ONCE // max(grams.count(), 1))
        met = []
        for at in range(0, GRAM_PARTS, step):
            own = grams.where((F.col("part") >= at) & (F.col("part") < at + step)).drop("part")
            mixed = own.groupBy("gram").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("gram")
            met.append(materialize(own.join(materialize(mixed, "mixed-grams"), "gram"), "grams", scoped=False))
        grams = reduce(DataFrame.unionByName, met)
    one = grams.select("gram", F.col("id").alias("a"), F.col("label").alias("a_label"), F.col("words").alias("a_words"), F.col("size").alias("a_size"))
    two = grams.select("gram", F.col("id").alias("b"), F.col("label").alias("b_label"), F.col("words").alias("b_words"), F.col("size").alias("b_size"))
    near = F.abs(F.col("a_words") - F.col("b_words")) <= allowed_edits(F.greatest("a_words", "b_words"), threshold)
    alone = one.join(two.where("b_size = 1"), "gram").where("a_label < b_label or a_size > 1").where(near).select("a", "b", "a_words", "b_words")
    one, two = one.where("a_size > 1"), two.where("b_size > 1")
    meets = two.select("gram", "b_label").distinct()
    groups = one.join(meets, "gram").where("a_label < b_label").join(two, ["gram", "b_label"]).where(near).select("a", "b", "a_words", "b_words")
    shared = alone.unionByName(groups).groupBy("a", "b").agg(F.count("*").alias("n"), F.max(F.greatest("a_words", "b_words")).alias("longer"))
    sure = F.col("longer") - GRAM + 1 - GRAM * allowed_edits(F.col("longer"), threshold)
    pairs = materialize(shared.where(F.col("n") >= F.greatest(F.lit(1), F.least(F.lit(COMMON), sure))).select("a", "b"), "pairs")
    left, right = (ids.select(F.col("id").alias(f"{k}_id"), F.col("key").alias(k)) for k in "ab")
    pairs = pairs.withColumnsRenamed({"a": "a_id", "b": "b_id"}).join(left, "a_id").join(right, "b_id").select("a", "b")
    return materialize(plausible(pairs, samples, threshold), "pairs")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) with the outcome of the alignment; ``texts``: key, text."""
    left, right = texts.select(F.col("key").alias("a"), F.col("text").alias("one")), texts.select(F.col("key").alias("b"), F.col("text").alias("two"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            found = []
            for group in bounded(rows, lambda r: len(r[0]) + len(r[1])):
                hashes, begin = word_hashes([t for r in group for t in r])
                found += similar_pairs([(hashes[begin[i] : begin[i + 1]], hashes[begin[i + 1] : begin[i + 2]]) for i in range(0, 2 * len(group), 2)], threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.bool_())], names=["a", "b", "same"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two").mapInArrow(work, "a binary, b binary, same boolean")


def components(links: DataFrame) -> DataFrame:
    """(key, label) of the connected components of ``links`` (a, b): every key
    takes the least label of its neighbours, then its label's label, until
    nothing changes. Each round is written to the shared folder."""
    both = materialize(links.select(F.col("a").alias("key"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("key"), F.col("a").alias("other"))).distinct(), "links")
    labels = materialize(both.groupBy("key").agg(F.least("key", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("key").alias("other"), "label"), "other").groupBy("key").agg(F.min("label").alias("near"))
        lower = labels.join(near, "key").select("key", F.col("label").alias("was"), F.least("label", "near").alias("via"))
        jump = labels.select(F.col("key").alias("via"), F.col("label").alias("further"))
        step = lower.join(jump, "via").select("key", "was", F.least("via", "further").alias("label"))
        step = materialize(step, "labels")
        labels = step.select("key", "label")
        if step.where(F.col("was") != F.col("label")).isEmpty():
            return labels


def classes(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, key, class_id,
    class_key (the key of the row that names the class) and copies (rows of the class)."""
    rows = materialize(sketched(docs, **options), "sketches")
    with scratch_scope(docs.sparkSession):
        of_key = materialize(_classes_of_keys(docs, rows, threshold, rounds), "classes", scoped=False)
    out = rows.select("doc_id", "key").join(of_key, "key", "left")
    return out.select(
        "doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "class_key", F.coalesce("copies", F.lit(1)).alias("copies")
    )


def _classes_of_keys(docs: DataFrame, rows: DataFrame, threshold: float, rounds: int) -> DataFrame:
    # a null doc_id comes after all others
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    texts = rows.where("key is not null").groupBy("key").agg(F.first("sketches").alias("sketches"), F.first("words").alias("words"), F.first("sample").alias("sample"), first.alias("first"), F.count("*").alias("copies"))
    texts = materialize(texts, "texts")
    members = texts.select("key", F.explode("sketches").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    rest = materialize(members.join(leaders, "bucket"), "members")
    wanted = rest.select("key").distinct()
    bodies = docs.select(text_key(F.col("text").cast("string")).alias("key"), F.col("text").cast("string").alias("text"))
    bodies = bodies.join(wanted.hint("shuffle_hash"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    bodies = materialize(bodies, "bodies")
    all_members, samples, links = rest.select("bucket", "key"), texts.select("key", "words", "sample"), None
    for k in range(rounds):
        pairs = rest.where("key <> leader").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
        pairs = materialize(plausible(pairs, samples, threshold), "pairs")
        good = materialize(verified(pairs, bodies, threshold).where("same").select("a", "b"), "links")
        links = good if links is None else links.unionByName(good)
        if k + 1 == rounds:
            break
        left = rest.where("key <> leader").join(good.select(F.col("a").alias("leader"), F.col("b").alias("key")), ["leader", "key"], "left_anti").select("bucket", "key")
        heads = left.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
        rest = materialize(left.join(heads, "bucket"), "members")
        if rest.isEmpty():
            break
    labels = components(links)
    tagged = materialize(wanted.join(labels, "key", "left").select("key", F.coalesce("label", "key").alias("label")), "tagged")
    # the two texts of a bucket of two have met in the first round
    mixed = all_members.join(tagged, "key").groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n")).where("least <> most and n > 2").select("bucket")
    left = all_members.join(mixed, "bucket").join(tagged, "key").join(texts.select("key", "words"), "key")
    left = materialize(length_groups(left, threshold), "left")
    if not left.isEmpty():
        pairs = materialize(plausible(pairs_within(left.where("few"), threshold), samples, threshold), "pairs")
        many = materialize(left.where("not few").select("key").distinct(), "many")
        if not many.isEmpty():
            across = pairs_across(bodies.join(many, "key", "left_semi"), samples, tagged.join(many, "key", "left_semi"), threshold)
            pairs = materialize(pairs.unionByName(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct(), "pairs")
        more = materialize(verified(pairs, bodies, threshold).where("same").select("a", "b"), "links")
        if not more.isEmpty():
            # classes by their labels: only the classes that the new links touch change
            of_a, of_b = (tagged.select(F.col("key").alias(k), F.col("label").alias(f"{k}_label")) for k in "ab")
            joined = components(more.join(of_a, "a").join(of_b, "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct())
            merged = joined.select(F.col("key").alias("label"), F.col("label").alias("new"))
            labels = tagged.join(merged, "label", "left").select("key", F.coalesce("new", "label").alias("label"))
    named = texts.select("key", "first", "copies").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    heads = named.groupBy("label").agg(F.min("first").alias("head"), F.sum("copies").alias("copies"))
    return named.select("key", "label").join(heads, "label").select("key", F.col("head.doc_id").alias("class_id"), F.col("head.key").alias("class_key"), "copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (of the
    smallest key, if that id has several texts). All columns are kept."""
    with scratch_scope(docs.sparkSession):
        found = materialize(classes(docs, **options).where("copies > 1"), "copies", scoped=False)
    is_head = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
    heads, others = found.where(is_head), found.where(~is_head)
    names = docs.columns
    keyed = docs.withColumns({"__key": text_key(F.col("text").cast("string")), "__doc": F.col("doc_id").cast("long")})

    def side(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("key").alias("__k"), F.col("doc_id").alias("__d")).distinct().hint("shuffle_hash")

    same = (F.col("__key") == F.col("__k")) & F.col("__doc").eqNullSafe(F.col("__d"))
    kept = keyed.join(side(others), same, "left_anti")
    again = heads.groupBy("key", "doc_id").agg(F.count("*").alias("n")).where("n > 1")  # rows that repeat wholly
    if again.isEmpty():
        return kept.select(*names)
    again = materialize(again, "repeated")
    once = kept.join(side(again), same, "left_semi").dropDuplicates(["__key", "__doc"])
    return kept.join(side(again), same, "left_anti").unionByName(once).select(*names)
