"""Session helpers: the shared scratch folder and a local session for tests.

Library code never builds a session; callers pass theirs. Scratch data
(registry snapshots written by the registered queries, lineage cuts) goes
under the folder named by ``spark.checkpoint.dir``, which on a cluster is a
shared file system. Only when that setting is absent (a bare local test
session) is a temporary folder chosen and registered as the checkpoint dir.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set to a new temporary folder only
    when the session names none (bare local sessions)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return conf
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        conf = tempfile.mkdtemp(prefix="corpreg-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


# Settings for large clusters: many shuffle partitions that AQE coalesces to
# ~256 MB, skew splitting on, scan splits of 256 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even where that adds a shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/corpreg/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "corpreg") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_LOCAL = threading.local()


def _scopes() -> list[list[str]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on exit, the intermediate tables that :func:`materialize`
    writes inside the ``with`` block in the same thread. DataFrames built
    from them must be consumed before the block ends."""
    paths: list[str] = []
    _scopes().append(paths)
    try:
        yield paths
    finally:
        _scopes().pop()
        delete_paths(spark, paths)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Recursively delete folders through the Hadoop file system of each path."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None or not paths:
        return
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


# Folders that plans still read: (session, weak references to what the plans read, folder).
_IN_USE: list[tuple[SparkSession, list, str]] = []
_IN_USE_LOCK = threading.Lock()


def delete_when_unused(df, path: str) -> None:
    """Delete the folder ``path``, which the scans of ``df`` read, once nothing
    reads it any more.

    A plan holds the relations that it scans, and so does every plan, view or
    cached table made from it. They are watched through weak references, not
    through the Python object, so ``df`` itself may go before what was made from
    it. Folders whose relations the JVM has collected are deleted when the next
    intermediate is written (:func:`delete_unused`), all others when the process
    ends. Sessions without a JVM of their own keep their folders.
    """
    jvm = getattr(df.sparkSession, "_jvm", None)
    if jvm is None:
        return
    leaves, refs = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            refs.append(jvm.java.lang.ref.WeakReference(leaf.relation()))
    if refs:
        with _IN_USE_LOCK:
            _IN_USE.append((df.sparkSession, refs, path))


def delete_unused(everything: bool = False) -> int:
    """Delete the folders of :func:`delete_when_unused` whose plans are gone
    (``everything``: all of them); returns how many are left."""
    with _IN_USE_LOCK:
        held = list(_IN_USE)
        _IN_USE.clear()
    kept = []
    for spark, refs, path in held:
        try:
            if everything or all(r.refersTo(None) for r in refs):
                delete_paths(spark, [path])
            else:
                kept.append((spark, refs, path))
        except Exception:  # noqa: BLE001 - the session has ended; its file system is gone with it
            continue
    with _IN_USE_LOCK:
        _IN_USE.extend(kept)
        return len(_IN_USE)


atexit.register(delete_unused, everything=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Delete the shuffle files of each query in the ``with`` block as it ends.
    For writes that cut lineage, and for frames that are collected once: what
    comes later does not read them, so a long chain of steps never holds more
    than one step's shuffles on disk."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shuffled(df):
    """``df`` as the side of a join that is shuffled, never broadcast.

    For joins of frames that both grow with the input. The planner's estimates
    see the compressed size of the columns read from Parquet, not the rows that
    ``explode`` makes of them, so they would have the driver collect and
    broadcast millions of rows as a table of a few MB.
    """
    return df.hint("merge")


def materialize(df, name: str = "stage", scoped: bool = True, partition_by: list[str] | None = None):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used where one intermediate feeds several branches of a plan (Spark
    would otherwise recompute it per branch) and to cut lineage before
    expensive stages: a lost executor re-reads the files instead of
    recomputing the inputs. Unlike ``Dataset.checkpoint`` on an unpersisted
    plan, the plan runs once (the checkpoint write would run it again), the
    files are columnar and compressed, and the optimizer sees their real size.
    Inside :func:`scratch_scope` the folder is deleted when the scope ends,
    otherwise when no plan reads it any more (:func:`delete_when_unused`).
    """
    spark = df.sparkSession
    delete_unused()
    path = scratch_path(spark, name)
    with shuffles_deleted(spark):
        df.write.mode("error").partitionBy(*partition_by or []).parquet(path)
    scopes = _scopes()
    written = spark.read.schema(df.schema).parquet(path)
    if scoped and scopes:
        scopes[-1].append(path)
    else:
        delete_when_unused(written, path)
    return written
