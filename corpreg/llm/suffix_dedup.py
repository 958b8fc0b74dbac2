"""Removal of long strings that an earlier document already has, by suffix arrays.

Every byte of a document that is covered by a ``LENGTH``-byte string which also
starts in a document with a smaller doc_id is removed. Strings are compared as
UTF-8 bytes, never across documents, and on the input, not on what is left.

How the work is cut up, without losing a string:

1. Anchors. Of the ``GRAM``-byte grams in each ``LENGTH``-byte window the one
   with the least hash is an anchor, so equal windows have equal anchors at
   equal places. Anchors that occur in one text only can be dropped: no window
   around them repeats. Which occur in several is decided by hash buckets.
2. Contexts. Around each remaining anchor the bytes of all windows that it may
   stand for (at most ``2 * LENGTH - GRAM``) go to the anchor's group.
3. Suffix arrays. The distinct contexts of many groups are sorted by two-stage
   suffix sorting; adjacent common prefixes of ``LENGTH`` bytes or more join
   windows to classes, and a window goes if its class has a smaller doc_id.

Equal texts are one text until the end, and a task that meets an equal context
twice sends it on once (that of the smallest doc_id; the others are decided), so
copies and common passages do not meet in one place. An anchor of very many
texts (more than ``HOT``, and than a millionth of all anchors, so that there are
at most a million of them) is replaced by its windows, each a group of its own.

Edge cases: a null text is empty; a null doc_id comes after all others, and is
not smaller than another null; rows with the same doc_id do not remove each
other's strings; texts shorter than ``LENGTH`` bytes are kept; other columns are
ignored (:func:`deduplicate` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from .near_dup import text_key
from .textutil import _BASE, _POW, _POW_INV, _TABLE, SEGMENT, mix, release_memory, set_batch_rows

LENGTH, GRAM = 50, 20
REACH = LENGTH - GRAM  # a window's anchor starts at most so many bytes after the window
HOT = 20_000
ANCHORS_PER_BUCKET, LEAST_BUCKETS, CONTEXT_BYTES = 1_500_000, 32, 8 << 20
LAST = (1 << 63) - 1  # stands for a null doc_id
_SEPARATOR = 255  # occurs in no UTF-8 text
_DEPTH = 7  # words of 8 bytes that direct sorting compares


# --- two-stage suffix sorting -------------------------------------------------


def _words_at(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as big-endian numbers."""
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view(">u8").ravel().astype(np.uint64)


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the suffix that starts one byte later
    (the last one is not: the empty suffix is smallest)."""
    n = len(data)
    change = np.flatnonzero(data[:-1] != data[1:])  # last positions of runs of one byte
    up = np.concatenate([data[change] < data[change + 1], [False]])
    ends = np.append(change, n - 1)
    return np.repeat(up, np.diff(np.concatenate([[-1], ends])))


def _sorted_directly(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions ordered by their next ``8 * _DEPTH`` bytes: those that tie after
    a word are ordered by the next one, within their group."""
    keys = _words_at(padded, at)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    group = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])]) if len(at) else np.zeros(0, np.int64)
    where = np.arange(len(at))
    for depth in range(1, _DEPTH):
        size = np.bincount(group) if len(group) else group
        tied = size[group] > 1
        where, group = where[tied], group[tied]
        if not len(where):
            break
        own = at[where]
        keys = _words_at(padded, np.minimum(own + 8 * depth, len(padded) - 8))
        order = np.lexsort((keys, group))
        own, keys = own[order], keys[order]
        at[where] = own
        group = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]) | (group[1:] != group[:-1]))])
    return at


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``data`` (uint8), ordered by at least their
    first ``8 * _DEPTH`` bytes. Suffixes smaller than their successors are
    sorted directly; a scan over the buckets of first bytes, in order, induces
    the others: one that is larger than its successor follows the successor's
    place, and comes before the directly sorted ones of its own bucket."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(8 * _DEPTH + 8, np.uint8)])
    small = smaller_than_next(data)
    direct = _sorted_directly(padded, np.flatnonzero(small))
    bounds = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def scan(at: np.ndarray, byte: int) -> np.ndarray:
        """Give the larger predecessors of these suffixes to their buckets; those of this bucket are returned."""
        prior = at[at > 0] - 1
        prior = prior[~small[prior]]
        first = data[prior]
        same = prior[first == byte]
        others, first = prior[first != byte], first[first != byte]
        if len(others):
            order = np.argsort(first, kind="stable")
            others, first = others[order], first[order]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for part, b in zip(np.split(others, cuts), first[np.concatenate([[0], cuts])], strict=True):
                induced[b].append(part)
        return same

    induced[data[-1]].append(np.array([n - 1]))  # the predecessor of the empty suffix
    for byte in range(256):
        at = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        while len(at):
            out.append(at)
            at = scan(at, byte)
        at = direct[bounds[byte] : bounds[byte + 1]]
        if len(at):
            out.append(at)
            scan(at, byte)
    return np.concatenate(out)


def adjacent_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbours in the suffix array (one fewer than
    suffixes), counted up to ``8 * _DEPTH`` bytes."""
    padded = np.concatenate([data, np.zeros(8 * _DEPTH + 8, np.uint8)])
    out = np.zeros(max(len(order) - 1, 0), np.int64)
    live = np.arange(len(out))
    for depth in range(_DEPTH):
        differs = _words_at(padded, np.minimum(order[live] + 8 * depth, len(padded) - 8)) ^ _words_at(padded, np.minimum(order[live + 1] + 8 * depth, len(padded) - 8))
        out[live] += sum((differs < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8)) + (differs == 0)
        live = live[differs == 0]
    return np.minimum(out, len(data) - np.maximum(order[:-1], order[1:])) if len(out) else out


def earlier_runs(contexts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, stop) of the bytes covered by ``length``-byte windows
    that also occur in a context of a smaller doc, runs of adjacent windows joined."""
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    order = suffix_array(data)
    cut = adjacent_prefixes(data, order) < length
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    real = order + length <= (begin + sizes)[owner[order]]  # windows that end within their context
    group = np.concatenate([[0], np.cumsum(cut)])
    place, group = order[real], group[real]
    if not len(place):
        return (np.zeros(0, np.int64),) * 3
    own = docs[owner[place]]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.append(starts, len(group))))
    gone = np.sort(place[own > least])  # windows of two contexts are never adjacent: each ends with a separator
    first = np.flatnonzero(np.diff(gone, prepend=-2) > 1)
    last = np.append(first[1:], len(gone)) - 1 if len(gone) else first
    of = owner[gone[first]]
    return of, gone[first] - begin[of], gone[last] - begin[of] + length


def earlier_windows(contexts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context the starts of its ``length``-byte windows that also
    occur in a context of a smaller doc."""
    out: list[list[np.ndarray]] = [[] for _ in contexts]
    for of, a, b in zip(*earlier_runs(contexts, docs, length), strict=True):
        out[of].append(np.arange(a, b - length + 1))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


# --- anchors ------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    done, out = 1, values
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of a text's anchors, in order."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, hashes = [], []
    room = SEGMENT - 4 * LENGTH
    for at in range(0, len(text) - LENGTH + 1, room):  # windows that start in at .. at + room
        # with the windows before and after, whose anchors are found again and dropped below
        data = np.frombuffer(text, np.uint8, min(len(text) - at, room + LENGTH - 1), at)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * _POW[: len(data)], out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * _POW_INV[: len(data) - GRAM + 1]) | np.uint64(1)
        least = _sliding(grams, REACH + 1, np.minimum)  # of each window
        edge = np.zeros(REACH, np.uint64)
        most = _sliding(np.concatenate([edge, least, edge]), REACH + 1, np.maximum)
        found = np.flatnonzero(most == grams)
        starts.append(found + at)
        hashes.append(grams[found])
    at, found = np.concatenate(starts), np.concatenate(hashes)
    if len(starts) > 1:
        at, first = np.unique(at, return_index=True)
        found = found[first]
    return at, found


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(column).to_pylist()]


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def shared_anchors(docs: DataFrame, buckets: int, hot: int) -> DataFrame:
    """(id, found): for texts (``id``: the first 64 bits of their key) the
    hashes of their anchors that occur in another text too, as 64-bit numbers;
    a row without an id has anchors of more than ``hot`` texts.

    A task sends an anchor that it meets in several texts to the anchor's
    bucket once; it knows already that it is shared."""
    names = ["bucket", "id", "found", "n"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for text in _texts(batch, 0):
                key = _short(hashlib.md5(text).digest())
                if len(text) >= LENGTH and key not in held:
                    held[key] = np.unique(anchors(text)[1])
                    size += len(text)
                if size > 16 << 20:
                    yield sent(held)
                    held, size = {}, 0
        if held:
            yield sent(held)

    def sent(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        ids, counts = np.array(list(held), np.int64), [len(v) for v in held.values()]
        owner, found = np.repeat(np.arange(len(ids)), counts), np.concatenate(list(held.values()))
        order = np.argsort(found, kind="stable")
        owner, found = owner[order], found[order]
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        times = np.diff(np.append(starts, len(found)))
        rows: list[tuple] = []
        # one of each to its bucket, with the number of texts here
        first, value = owner[starts], found[starts]
        bucket = (value >> np.uint64(32)).astype(np.int64) % buckets
        for b in range(buckets):
            own = np.flatnonzero(bucket == b)
            rows.append((b, ids[first[own]].tobytes(), value[own].tobytes(), np.minimum(times[own], 1 << 30).astype(np.int32).tobytes()))
        # the other texts of those met more than once are sure of them
        again = np.ones(len(found), bool)
        again[starts] = False
        if again.any():
            n = np.repeat(times, times)[again]
            rows.append((-1 - int(ids[0] % buckets), ids[owner[again]].tobytes(), found[again].tobytes(), np.minimum(n, 1 << 30).astype(np.int32).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def decide(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        release_memory()
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in part["id"].to_pylist()])
        found = np.concatenate([np.frombuffer(x, np.uint64) for x in part["found"].to_pylist()])
        often = np.zeros(0, np.uint64)
        if key[0].as_py() >= 0 and len(found):
            n = np.concatenate([np.frombuffer(x, np.int32) for x in part["n"].to_pylist()]).astype(np.int64)
            order = np.argsort(found, kind="stable")
            ids, found, n = ids[order], found[order], n[order]
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            times, total = np.diff(np.append(starts, len(found))), np.add.reduceat(n, starts)
            several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
            often = found[starts[total > hot]]
            shared = np.repeat(several | (total > times), times)
            ids, found = ids[shared], found[shared]
        order = np.argsort(ids, kind="stable")
        ids, found = ids[order], found[order]
        cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
        parts = np.split(found, cuts) if len(ids) else []
        names = [*ids[np.concatenate([[0], cuts])].tolist(), None] if len(ids) else [None]
        return pa.table({"id": pa.array(names, pa.int64()), "found": pa.array([x.tobytes() for x in [*parts, often]], pa.binary())})

    rows = docs.select(F.col("text").cast("string")).mapInArrow(collect, "bucket int, id binary, found binary, n binary")
    return rows.groupBy("bucket").applyInArrow(decide, "id long, found binary")


def contexts(texts: DataFrame, groups: int, often: np.ndarray) -> DataFrame:
    """``texts``: key, doc, text and found (array of binaries); ``often``: the
    anchors whose windows are taken singly. Rows for the suffix arrays: group,
    anchor, context, key, doc, start; without a context the span from start on,
    of as many bytes as the anchor says, is known to go."""
    names = ["group", "anchor", "context", "key", "doc", "start"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    singly = texts.sparkSession.sparkContext.broadcast(often)  # at most a million numbers

    def places(text: bytes, wanted: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
        at, value = anchors(text)
        chosen = np.isin(value, wanted)
        at, value = at[chosen], value[chosen]
        for a, v, single in zip(at.tolist(), value.view(np.int64).tolist(), np.isin(value, singly.value).tolist(), strict=True):
            first, last = max(0, a - REACH), min(len(text), a + LENGTH)
            if single:
                for s in range(first, last - LENGTH + 1):
                    yield _short(hashlib.md5(text[s : s + LENGTH]).digest()), text[s : s + LENGTH], s
            else:
                yield v, text[first:last], first

    def rows(met: dict[bytes, list[tuple]]) -> pa.RecordBatch:
        out = []
        for context, owners in met.items():
            least = min(o[2] for o in owners)
            for anchor, key, doc, start in owners:
                if doc > least:
                    out.append((-1 - int.from_bytes(key[:4], "big") % groups, len(context), None, key, doc, start))
                else:
                    out.append((anchor % groups, anchor, context, key, doc, start))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        met: dict[bytes, list[tuple]] = {}
        n = 0
        for batch in batches:
            keys, docs, found = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for key, doc, text, own in zip(keys, docs, _texts(batch, 2), found, strict=True):
                for anchor, context, start in places(text, np.frombuffer(b"".join(own), np.uint64)):
                    met.setdefault(context, []).append((anchor, key, doc, start))
                    n += 1
                    if n >= 200_000:
                        yield rows(met)
                        met, n = {}, 0
        yield rows(met)

    return texts.select("key", "doc", "text", "found").mapInArrow(pick, "group int, anchor long, context binary, key binary, doc long, start long")


_FULL = 2 * LENGTH - GRAM  # bytes of a context that no end of the text cuts short
_WEIGHTS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, _FULL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _meets_another(anchor: np.ndarray, contexts: pa.Array) -> np.ndarray:
    """Which rows may hold a window that another row holds, too; ``anchor`` is sorted.

    The anchor of a window is at the same place of it wherever the window
    occurs, so of the window's other ``REACH`` bytes two rows share half on the
    left of the anchor, or half on its right. A row whose left half and right
    half no other row of its anchor has is left out. In contexts that an end of
    the text cuts short the place of the anchor is unknown: they, and all rows
    of their anchors, stay."""
    sizes = pc.binary_length(contexts).to_numpy(zero_copy_only=False)
    full = sizes == _FULL
    starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    times = np.diff(np.append(starts, len(anchor)))
    keep = np.repeat(~np.logical_and.reduceat(full, starts), times)
    own = np.flatnonzero(~keep)
    if not len(own):
        return keep
    raw = b"".join(contexts.take(pa.array(own)).to_pylist())
    data = np.frombuffer(raw, np.uint8).reshape(-1, _FULL)
    half = -(-REACH // 2)
    for a, b in ((REACH - half, REACH), (REACH + GRAM, REACH + GRAM + half)):
        side = anchor[own].astype(np.uint64) * np.uint64(_BASE)
        for column in range(a, b):
            side = (side + data[:, column]) * _WEIGHTS[column]
            side ^= side >> np.uint64(29)
        order = np.argsort(side, kind="stable")
        same = side[order][1:] == side[order][:-1]
        keep[own[order[1:][same]]] = True
        keep[own[order[:-1][same]]] = True
    return keep


def judged(rows: DataFrame) -> DataFrame:
    """(key, start, stop) byte spans to remove, from the rows of :func:`contexts`."""

    def judge(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        release_memory()
        part = part.combine_chunks()
        if key[0].as_py() < 0:
            stop = pc.add(part["start"], part["anchor"])
            return pa.table({"key": part["key"], "start": part["start"], "stop": stop})
        part = part.take(pa.array(np.argsort(part["anchor"].to_numpy(), kind="stable")))
        near = _meets_another(part["anchor"].to_numpy(), part["context"].combine_chunks())
        part = part.filter(pa.array(near))
        anchor, start, doc = (part[c].to_numpy() for c in ("anchor", "start", "doc"))
        sizes = np.cumsum(pc.binary_length(part["context"]).to_numpy())
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = 0
        while at < len(anchor):  # all rows of some anchors, of about a megabyte
            end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (1 << 20)))
            end = int(np.searchsorted(anchor, anchor[min(end, len(anchor) - 1)], "right"))
            out += [(own + at, a, b) for own, a, b in _spans(part["context"].slice(at, end - at), doc[at:end])]
            at = end
        own, a, b = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))
        return pa.table({"key": part["key"].take(pa.array(own, pa.int64())), "start": pa.array(start[own] + a, pa.int64()), "stop": pa.array(start[own] + b, pa.int64())})

    return rows.groupBy("group").applyInArrow(judge, "key binary, start long, stop long")


def _spans(contexts: pa.ChunkedArray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, start, stop) of what goes from some rows' contexts."""
    coded = contexts.combine_chunks().dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    least = np.full(len(distinct), LAST, np.int64)
    np.minimum.at(least, code, doc)
    later = np.flatnonzero(doc > least[code])  # an equal context is in a smaller document
    whole = np.array([len(c) for c in distinct], np.int64)[code[later]]
    of, a, b = earlier_runs(distinct, least)
    # the rows of the smallest document lose the runs of their context
    first = np.flatnonzero(doc == least[code])
    begin, end = np.searchsorted(of, code[first], "left"), np.searchsorted(of, code[first], "right")
    many = end - begin
    run = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
    return [(later, np.zeros(len(later), np.int64), whole), (np.repeat(first, many), a[run], b[run])]


def removals(docs: DataFrame) -> DataFrame:
    """(key, least, spans) of the texts from which something may go: ``least`` is
    the smallest doc_id with this text (rows with a larger one go as a whole if
    they are long enough), ``spans`` what goes from that row."""
    set_batch_rows(docs.sparkSession, 4000)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    total = 2 * size // (REACH + 2)
    shared = materialize(shared_anchors(rows, max(LEAST_BUCKETS, -(-total // ANCHORS_PER_BUCKET)), max(HOT, total // 1_000_000)), "anchors")
    often = np.frombuffer(b"".join(bytes(r[0]) for r in shared.where("id is null and octet_length(found) > 0").select("found").collect()), np.uint64)
    named = rows.select(text_key(F.col("text")).alias("key"), "doc")
    texts = named.groupBy("key").agg(F.min("doc").alias("least"), (F.min("doc") != F.max("doc")).alias("copied"))
    texts = materialize(texts, "texts")
    number = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    found = shared.where("id is not null").groupBy("id").agg(F.collect_list("found").alias("found"))
    wanted = texts.join(found, number == F.col("id")).select(F.col("key").alias("__key"), F.col("least").alias("__least"), "found")
    keyed = rows.withColumn("key", text_key(F.col("text")))
    chosen = keyed.join(wanted.hint("shuffle_hash"), (F.col("key") == F.col("__key")) & (F.col("doc") == F.col("__least")))
    bytes_of_contexts = (shared.agg(F.sum(F.octet_length("found"))).first()[0] or 0) // 8 * (2 * LENGTH - GRAM)
    spans = judged(contexts(chosen, max(1, -(-bytes_of_contexts // CONTEXT_BYTES)), often))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(spans, "key", "left").where("copied or spans is not null").drop("copied")


def cut(docs: DataFrame, digest_only: bool = False) -> DataFrame:
    """``docs`` (all its columns) with the struct ``__cut``: n_bytes, n_removed,
    n_spans and the bytes kept (or only their SHA-256, in hex)."""
    with scratch_scope(docs.sparkSession):
        away = materialize(removals(docs), "removals", scoped=False)
    away = away.select(F.col("key").alias("__key"), F.col("least").alias("__least"), F.col("spans").alias("__spans"))
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.withColumns({"__k": text_key(body), "__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))}).join(away.hint("shuffle_hash"), F.col("__k") == F.col("__key"), "left")
    kind = "string" if digest_only else "binary"

    @F.pandas_udf(f"n_bytes long, n_removed long, n_spans long, kept {kind}")
    def apply(texts: pd.Series, whole: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, all_of_it, own in zip(texts, whole, spans, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            runs = [(0, len(raw))] if all_of_it and len(raw) >= LENGTH else [] if all_of_it else _merged(own)
            kept = b"".join(raw[a:b] for a, b in zip([0, *[r[1] for r in runs]], [*[r[0] for r in runs], len(raw)], strict=True))
            out.append((len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest() if digest_only else kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    whole = F.coalesce(F.col("__doc") > F.col("__least"), F.lit(False))
    return joined.withColumn("__cut", apply.asNondeterministic()(body, whole, F.col("__spans"))).drop("__k", "__doc", "__key", "__least", "__spans")


def _merged(spans) -> list[tuple[int, int]]:
    if spans is None:
        return []
    out: list[tuple[int, int]] = []
    for start, stop in sorted({(int(s["start"]), int(s["stop"])) for s in spans}):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    out = cut(docs.select("doc_id", "text"), digest_only=True)
    return out.select("doc_id", *[F.col(f"__cut.{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.col("__cut.kept").alias("kept_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of each text (a character that a cut splits
    goes as a whole); rows of which nothing is left are dropped, and a column
    n_chars is set anew. Rows whose text was null or empty stay as they are."""
    names = docs.columns
    out = cut(docs).where("__cut.n_removed = 0 or __cut.n_removed < __cut.n_bytes")

    @F.pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return kept.map(lambda raw: bytes(raw).decode("utf-8", "ignore"))

    out = out.withColumn("text", F.when(F.col("__cut.n_removed") > 0, readable(F.col("__cut.kept"))).otherwise(F.col("text")))
    if "n_chars" in names:
        changed = F.when(F.col("__cut.n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
