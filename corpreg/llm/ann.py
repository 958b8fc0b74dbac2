"""Approximate nearest neighbours by navigable small-world graphs.

Distinct vectors are spread over shards by hash, about ``SHARD`` to each.
Every shard gets a hierarchical navigable small-world graph: a vector is on
level 0 and on each further level with probability 1 / ``LINKS``; on a level it
is linked to diverse near neighbours (a candidate is skipped when it is nearer
to one already chosen) and these links are kept in both directions, in flat
arrays of neighbour numbers. A search descends greedily to level 0 and keeps
the ``BEAM`` nearest there; all queries of a block go through a graph side by
side. Each shard's results are measured exactly, in double precision, and the
results of all shards are merged.

Every query meets every shard. The shards are dealt to bins, and each query goes
once to every bin, not to every shard: the task of a bin builds its graphs one
after the other and searches them at once, so no graph is written or shuffled.
Where there are more than ``ASKED`` queries they go in groups, and a bin has a
task for each. Nothing is joined, so nothing can be broadcast. A graph may fall
into parts that no link joins (tight clusters): a search starts in the nearest
parts, too, by one vector of each.

Vectors are scaled by powers of two first, so that very large and very small
ones neither overflow nor vanish.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows with a null id; vectors of different
dimensions are never compared; equal vectors are one vector of the graph and
their smallest ids are the results, so copies do not crowd out others of
the same rank; a query's own row is left out, by id; with fewer candidates than asked
for all found are returned; a repeated id counts once per distinct vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import materialize

SHARD, LINKS, CANDIDATES, BEAM, BLOCK = 2_000, 16, 64, 96, 512
#: Bins of shards, unless there are fewer shards or more than BIN shards to a bin; queries in a group.
BINS, BIN, ASKED = 96, 64, 131_072
#: A place of a search's beam that is not taken. The others hold the bits of the negative score, the number of the vector and whether it was expanded.
NONE = np.iinfo(np.int64).max
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def one_of_each_part(near: np.ndarray) -> np.ndarray:
    """The first member of every connected part of a graph of neighbour lists."""
    label, rows = np.arange(len(near)), np.arange(len(near))[:, None]
    while True:
        lower = np.minimum(label, np.where(near >= 0, label[near], rows).min(1, initial=len(near))) if near.size else label
        np.minimum.at(lower, near[near >= 0], np.broadcast_to(lower[:, None], near.shape)[near >= 0])
        lower = lower[lower]
        if (lower == label).all():
            return np.unique(label)
        label = lower


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by powers of two that bring their largest components near 1:
    cosines stay the same to the last bit, and no square over- or underflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


class Graph:
    """The graph of one shard: ``vectors`` are unit rows; ``levels`` holds for
    each level its members and their neighbours (members' positions, -1 for none)."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, candidates: int = CANDIDATES, seed: int = 5):
        self.vectors = vectors
        rng, n = np.random.default_rng(seed), len(vectors)
        height = np.floor(-np.log(rng.random(n) + 1e-12) / np.log(links)).astype(int) if n else np.zeros(0, int)
        self.levels = []
        for level in range(int(height.max(initial=0)) + 1):
            members = np.flatnonzero(height >= level)
            self.levels.append((members, self._linked(members, 2 * links if level == 0 else links, candidates)))
        self.entries = one_of_each_part(self.levels[0][1])

    def _linked(self, members: np.ndarray, links: int, candidates: int) -> np.ndarray:
        n, own = len(members), self.vectors[members]
        near = np.full((n, links), -1, np.int32)
        if n < 2:
            return near
        width = min(candidates, n - 1)
        chosen: list[np.ndarray] = []
        for at in range(0, n, 512):
            scores = own[at : at + 512] @ own.T
            scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
            found = np.argpartition(-scores, width - 1, axis=1)[:, :width]
            order = np.argsort(-np.take_along_axis(scores, found, 1), axis=1, kind="stable")
            found = np.take_along_axis(found, order, 1)
            to_query = np.take_along_axis(scores, found, 1)
            between = np.matmul(own[found], own[found].transpose(0, 2, 1))
            keep, count = np.zeros(found.shape, bool), np.zeros(len(found), int)
            for j in range(width):  # nearer to the vector than to any neighbour chosen so far
                crowded = ((between[:, j, :] > to_query[:, j, None]) & keep).any(1)
                take = ~crowded & (count < links // 2)
                keep[:, j], count = take, count + take
            order = np.argsort(~keep, axis=1, kind="stable")[:, : links // 2]  # the others fill up what is left
            chosen.append(np.take_along_axis(found, order, 1))
        target = np.concatenate(chosen)
        source = np.repeat(np.arange(n), target.shape[1])
        target = target.ravel()
        both = np.unique(np.concatenate([source * n + target, target * n + source]))
        source, target = both // n, both % n
        score = np.einsum("id,id->i", own[source], own[target])
        order = np.lexsort((-score, source))
        source, target = source[order], target[order]
        rank = np.arange(len(source)) - np.searchsorted(source, source, "left")
        fits = rank < links
        near[source[fits], rank[fits]] = target[fits]
        return near

    def search(self, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """(queries, beam) rows of ``vectors``, nearest first, -1 where there are no more."""
        n, many = len(self.vectors), len(queries)
        if not n or not many:
            return np.full((many, beam), -1)
        rows = np.arange(many)
        # in a graph of a shard's size a search meets most vectors: one product is less work than fetching the vectors of each step
        scores = queries @ self.vectors.T
        members, _ = self.levels[-1]
        entry = np.full(many, members[0])
        for members, near in self.levels[:0:-1]:  # greedy descent
            place = np.full(n, -1)
            place[members] = np.arange(len(members))
            at = place[entry]
            best = scores[rows, entry]
            while True:
                around = near[at]
                found = scores[rows[:, None], members[around]]
                found[around < 0] = -np.inf
                j = found.argmax(1)
                better = found[rows, j] > best
                if not better.any():
                    break
                at = np.where(better, around[rows, j], at)
                best = np.where(better, found[rows, j], best)
            entry = members[at]
        near = self.levels[0][1]
        near = np.where(near < 0, n, near)
        # what a search has met is NONE from then on, and so is column n, for no vector
        keys = np.full((many, n + 1), NONE)
        bits = np.subtract(0, scores, dtype=np.float32).view(np.int32)
        keys[:, :n] = np.where(bits < 0, bits ^ 0x7FFFFFFF, bits).astype(np.int64) << 32 | np.arange(n) << 1
        flat, first = keys.reshape(-1), rows * (n + 1)
        held = np.full((many, beam), NONE)
        held[:, 0], flat[first + entry] = flat[first + entry], NONE
        # the links may leave parts of the graph apart from each other: start in the nearest ones, too
        others = np.sort(keys[:, self.entries], axis=1)[:, : beam - 1]
        held[:, 1 : others.shape[1] + 1] = others
        flat[first[:, None] + np.where(others == NONE, n, _number(others))] = NONE
        done, active = held.copy(), rows
        while True:
            waiting = np.where(held & 1, NONE, held)
            j = waiting.argmin(1)  # the nearest not yet expanded
            nearest = waiting[np.arange(len(active)), j]
            going = nearest != NONE
            if not going.all():
                done[active[~going]] = held[~going]
                held, active, j, nearest = held[going], active[going], j[going], nearest[going]
            if not len(active):
                break
            held[np.arange(len(active)), j] |= 1
            around = first[active, None] + near[_number(nearest)]
            held = np.concatenate([held, flat[around]], 1)
            flat[around] = NONE
            held.partition(beam - 1, axis=1)
            held = held[:, :beam]
        done.sort(axis=1)
        return np.where(done == NONE, -1, _number(done))


def _number(key: np.ndarray) -> np.ndarray:
    return (key & 0xFFFFFFFF) >> 1


def usable(embedding):
    """Whether a vector takes part."""
    values = embedding.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest ids of each query: query_id, rank, vec_id, score.
    ``vectors`` and ``queries`` have vec_id and embedding; a query finds every
    row but those of its own id."""
    keep = k + 1
    clean = lambda rows: rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    smallest = clean(vectors).withColumn("r", rank).where(F.col("r") <= keep)  # cut to ``keep`` in each task before the shuffle
    distinct = smallest.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = materialize(distinct.withColumn("dim", F.size("embedding")), "distinct-vectors")
    sizes = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row a dimension
    shards = {dim: max(1, -(-n // shard)) for dim, n in sizes.items()}
    if not shards:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = F.create_map(*[F.lit(x) for pair in sorted(shards.items()) for x in pair])
    kind = distinct.schema["embedding"].dataType.elementType
    values = F.col("embedding") if isinstance(kind, (FloatType, DoubleType)) else F.col("embedding").cast("array<double>")
    asked = clean(queries).withColumn("dim", F.size("embedding"))
    asked = asked.where(count[F.col("dim")].isNotNull())
    many = {r["dim"]: r["n"] for r in asked.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row a dimension
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = {dim: min(n, max(-(-n // BIN), min(BINS, 3 * tasks))) for dim, n in shards.items()}
    groups = {dim: max(1, -(-many.get(dim, 0) // ASKED)) for dim in shards}
    of = lambda sizes: F.create_map(*[F.lit(x) for pair in sorted(sizes.items()) for x in pair])[F.col("dim")]
    every = lambda sizes: F.explode(F.sequence(F.lit(0), of(sizes) - 1))
    shard = F.pmod(F.xxhash64("embedding"), count[F.col("dim")]).cast("int")
    placed = distinct.select("dim", "ids", "embedding", shard.alias("shard")).withColumn("group", every(groups)).withColumn("bin", F.col("shard") % of(bins))
    group = F.pmod(F.xxhash64("vec_id", "embedding"), of(groups)).cast("int")
    spread = asked.withColumn("group", group).withColumn("bin", every(bins))

    def dealt(rows: DataFrame):
        # with a number, as the work is not in the bytes by which small partitions would be joined
        keys = sum(bins[dim] * groups[dim] for dim in bins)
        return rows.withColumn("embedding", values).repartition(keys, "dim", "bin", "group").groupBy("dim", "bin", "group")

    look = lambda index, asked: _looked_up(index, asked, keep, beam)
    found = dealt(placed).cogroup(dealt(spread)).applyInArrow(look, "query_id long, vec_id long, score double")
    top = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", top).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scaled_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a table, scaled, their norms, and in single precision as unit rows."""
    raw = pa.concat_arrays(table["embedding"].chunks).flatten().to_numpy(zero_copy_only=False)
    raw = scaled(raw.astype(np.float64).reshape(len(table), -1))
    norms = np.sqrt((raw * raw).sum(1))
    return raw, norms, (raw / norms[:, None]).astype(np.float32)


def _nearest(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, owner: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of each query the ``keep`` rows with the highest scores, its own id left out; ``owner``: the ids of the queries."""
    order = np.lexsort((vec_id, -score, query))
    order = order[vec_id[order] != owner[query[order]]]
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order], "left")
    best = order[place < keep]
    return query[best], vec_id[best], score[best]


def _looked_up(index: pa.Table, asked: pa.Table, keep: int, beam: int) -> pa.Table:
    """The ``keep`` nearest rows of every query of ``asked`` in the shards of ``index``."""
    if not len(index) or not len(asked):
        return FOUND.empty_table()
    asked = asked.take(np.argsort(asked["vec_id"].to_numpy(), kind="stable"))
    owner = asked["vec_id"].to_numpy()
    questions, asked_norms, asked_units = _scaled_rows(asked)
    lists = pa.concat_arrays(index["ids"].chunks)
    held = np.arange(keep) < lists.value_lengths().to_numpy()[:, None]
    ids = np.full(held.shape, -1, np.int64)
    ids[held] = lists.flatten().to_numpy()
    shard = index["shard"].to_numpy()
    order = np.lexsort((ids[:, 0], shard))
    ids, shard = ids[order], shard[order]
    raw, norms, units = (x[order] for x in _scaled_rows(index))
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)  # query, vec_id, score
    for members in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
        graph, found = Graph(units[members]), [best]
        for at in range(0, len(owner), BLOCK):
            hits = graph.search(asked_units[at : at + BLOCK], beam)[:, : 4 * keep]
            query, place = np.nonzero(hits >= 0)
            query, hit = query + at, members[hits[query, place]]
            score = (questions[query] * raw[hit]).sum(1) / (asked_norms[query] * norms[hit])
            own = ids[hit] >= 0
            many = own.sum(1)
            found.append(_nearest(np.repeat(query, many), ids[hit][own], np.repeat(score, many), owner, keep))
        best = _nearest(*(np.concatenate(x) for x in zip(*found, strict=True)), owner, keep)
    query, vec_id, score = best
    return pa.Table.from_arrays([pa.array(owner[query]), pa.array(vec_id), pa.array(score)], schema=FOUND)
