"""Centroid clustering in exact integers with an incremental distance matrix.

Every vector becomes integers once. The state of a round is a written table
that holds, next to each vector, its dot products with all centroids. A
centroid that moves changes them only by its nonzero component changes: the
next table adds ``values[changed] . change[changed]`` to the products of that
centroid and leaves those of centroids at rest as they are; nearest centroids
are then found again from ``|c|^2 - 2 dot``. Everything is exact: products run
in doubles while no sum can pass 2^53, else in 64-bit integers.

A round reads and writes the state once, in tasks of any number of rows; per
component sums of the clusters are partial aggregates, and only ``k`` centroids
reach the driver. A lost executor costs the tasks it ran, as each round starts
from a written table; the table before it is deleted then.

Edge cases: vectors that are null, of another length, or hold null, NaN or
infinite components take no part. Neither do those with a component of
``LIMIT`` or more in absolute value once scaled: their squared distances do not
fit a long. Rows of one id are clustered one by one; a null id takes part but
is no first centroid. With fewer than ``k`` usable ids there are fewer
centroids (repeated rows count as often as they come; ties in the hash by the
components); without any there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_paths, scratch_path

LIMIT = 1 << 27  # 64 components: (2 * 2^27)^2 * 64 = 2^62
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
STATE = "vec_id long, values array<int>, norm long, dots array<long>, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, values): floor(scale * x) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    inside = F.forall(x, lambda v: F.coalesce(F.abs(v) < LIMIT / scale, F.lit(False)) & ~F.isnan(v))
    kept = vectors.where((F.size("embedding") == dims) & inside)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale).cast("int")).alias("values"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """(k, dims): the vectors with the smallest hashes of ``seed:<vec_id>``."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = rows.where(F.col("vec_id").isNotNull()).orderBy(drawn, "values").limit(k).collect()  # k rows
    return np.array([r["values"] for r in top], np.int64)


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of integers, in doubles where every partial sum is below 2^53."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def shift(dots: np.ndarray, values: np.ndarray, change: np.ndarray) -> None:
    """Bring the products up to date after each centroid moved by its row of ``change``."""
    for j in np.flatnonzero(change.any(1)):
        at = np.flatnonzero(change[j])
        dots[:, j] += exact_product(values[:, at], change[j, at][:, None])[:, 0]


def nearest(norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster (ties: the smaller number) and squared distance of every vector."""
    rest = (centroids * centroids).sum(1)[None] - 2 * dots
    cluster = rest.argmin(1)
    return cluster, norm + rest[np.arange(len(rest)), cluster]


def _lists(values: np.ndarray, kind) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def _advanced(rows: DataFrame, centroids: np.ndarray, change: np.ndarray | None) -> DataFrame:
    """The state for ``centroids``: from vectors alone (``change`` None) or from
    the state before the centroids moved by ``change``. Both are k x dims numbers."""

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)
            if change is None:
                norm, dots = (values * values).sum(1), exact_product(values, centroids.T)
            else:
                norm = batch.column("norm").to_numpy()
                dots = batch.column("dots").flatten().to_numpy().reshape(batch.num_rows, -1).copy()
                shift(dots, values, change)
            cluster, distance = nearest(norm, dots, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _lists(values, pa.int32()), pa.array(norm), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "values", "norm", "dots", "cluster", "distance"],
            )

    return rows.mapInArrow(advance, STATE)


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of the componentwise mean of every cluster; empty ones stay."""
    sums = [F.sum(F.get("values", F.lit(i)).cast("long")) for i in range(centroids.shape[1])]
    out = centroids.copy()
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*sums).alias("sums")).collect():  # one row a cluster
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per vector that takes part: its cluster after ``rounds`` rounds,
    the squared distance, both inertias (null beyond a long) and the SHA-256 of
    the cluster's centroid."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, dims, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], SCHEMA)

    def written(state: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        state.write.parquet(path)
        return spark.read.schema(STATE).parquet(path), path

    state, path = written(_advanced(rows, centroids, None), "centroids-0")
    for n in range(rounds):
        after = moved(state, centroids)
        change, centroids, before = after - centroids, after, path
        if not change.any():
            break  # every later round would repeat this one
        state, path = written(_advanced(state, centroids, change), f"centroids-{n + 1}")
        delete_paths(spark, [before])

    per = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # one row a cluster
    inertia = {r["cluster"]: int(r["d"]) for r in per}
    as_long = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = lambda of: F.element_at(F.create_map(*[x for c, v in sorted(of.items()) for x in (F.lit(c), v)]), F.col("cluster"))
    return state.select(
        "vec_id",
        "cluster",
        "distance",
        own({c: as_long(n) for c, n in inertia.items()}).alias("cluster_inertia"),
        as_long(sum(inertia.values())).alias("inertia"),
        own({c: F.lit(digests[c]) for c in inertia}).alias("centroid_sha256"),
    )
