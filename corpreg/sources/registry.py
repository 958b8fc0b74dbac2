"""The company registry: keyed upsert into snapshot-versioned Parquet.

Layout under ``root``::

    root/snapshots/<n>/part-*.parquet                  one full table per commit
    root/_commits/part-*.parquet                       snapshot_id, committed_at,
                                                       operation, path, row_count

A commit writes the new snapshot first and appends its commit row last, so
a failed or partial write is never visible: readers resolve the newest
committed snapshot. Rows are sorted by ``corporate_id`` inside each file so
that id lookups can skip row groups by their min/max statistics.

:class:`CatalogRegistry` keeps the registry in the session catalog instead: a
bucketed table for each version and a view that names the newest. With a table
format that supports ``MERGE INTO``, :func:`merge_into_table` issues that
statement.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from corpreg.schemas import REGISTRY, REGISTRY_DDL
from corpreg.session import delete_paths, materialize, scratch_scope, shuffled

KEY = "corporate_id"
COMMITS = StructType(
    [
        StructField("snapshot_id", LongType(), False),
        StructField("committed_at", TimestampType(), False),
        StructField("operation", StringType(), False),
        StructField("path", StringType(), False),
        StructField("row_count", LongType(), False),
    ]
)


class DuplicateKeyError(ValueError):
    """The upsert source holds a key more than once."""


def assert_unique_keys(source: DataFrame, key: str = KEY) -> None:
    dups = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not dups.isEmpty():
        raise DuplicateKeyError(f"upsert source repeats {key} values, e.g. {dups.first()[key]!r}")


def merge_frames(target: DataFrame, source: DataFrame, key: str = KEY) -> DataFrame:
    """Keyed upsert as a plan: source rows replace target rows with the same
    key, new keys are inserted, other target rows stay."""
    cols = target.columns
    kept = target.join(shuffled(source.select(key)), key, "left_anti")
    return kept.select(*cols).unionByName(source.select(*cols))


class SnapshotRegistry:
    def __init__(self, spark: SparkSession, root: str, schema: StructType = REGISTRY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    @property
    def commits_path(self) -> str:
        return f"{self.root}/_commits"

    def snapshots(self) -> DataFrame:
        """Commit log; empty before the first commit."""
        try:
            return self.spark.read.schema(COMMITS).parquet(self.commits_path)
        except Exception as e:  # path does not exist yet
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return self.spark.createDataFrame([], COMMITS)
            raise

    def _latest(self):
        return self.snapshots().orderBy(F.col("snapshot_id").desc()).select("snapshot_id", "path").first()

    def current(self) -> DataFrame:
        """The newest committed snapshot (an empty table before any commit)."""
        latest = self._latest()
        if latest is None:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(self.schema).parquet(latest["path"])
        return df.select(*self.schema.fieldNames())

    def merge(self, source: DataFrame, source_is_written: bool = False) -> int:
        """Upsert ``source`` by key and commit it as a new snapshot; returns
        the snapshot id. Raises :class:`DuplicateKeyError` first if the source
        repeats a key.

        The source is written once first: the key check, the commit-type check
        and the write all read it, and a lazy source would otherwise be
        recomputed for each. That copy is deleted when the commit is done.
        ``source_is_written=True`` skips the copy for a source that is already
        a scan of written files.
        """
        with scratch_scope(self.spark):
            source = source.select(*self.schema.fieldNames())
            if not source_is_written:
                source = materialize(source, "upsert")
            assert_unique_keys(source)
            latest = self._latest()
            sid = 1 if latest is None else latest["snapshot_id"] + 1
            target = self.current()
            touched = latest is not None and not target.join(shuffled(source.select(KEY)), KEY, "left_semi").isEmpty()
            merged = merge_frames(target, source)
            # a folder of its own for every attempt: what a lost driver left is never in the way
            path = f"{self.root}/snapshots/{sid}-{uuid.uuid4().hex}"
            # rows sorted by id inside each file: Parquet min/max statistics
            # then let id lookups skip row groups, without a directory per
            # prefix (which would make every task write hundreds of files)
            merged.sortWithinPartitions(KEY).write.mode("error").parquet(path)
        rows = self.spark.read.parquet(path).count()
        op = "overwrite" if touched else "append"
        commit = self.spark.createDataFrame(
            [(sid, datetime.now(timezone.utc).replace(tzinfo=None), op, path, rows)], COMMITS
        )
        commit.coalesce(1).write.mode("append").parquet(self.commits_path)
        return sid

    def preview(self, n: int = 20) -> DataFrame:
        """First ``n`` rows by id, for inspection."""
        return self.current().orderBy(KEY).limit(n)

    def inspect(self, sample_rows: int = 20) -> dict:
        """Row count, first rows by id and the newest commits, for a quick look."""
        return {
            "row_count": self.current().count(),
            "sample": self.preview(sample_rows),
            "history": self.history(5),
        }

    def history(self, n: int = 5) -> DataFrame:
        """Newest ``n`` commits: snapshot_id, committed_at, operation."""
        return (
            self.snapshots()
            .orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc())
            .select("snapshot_id", "committed_at", "operation")
            .limit(n)
        )


class CatalogRegistry:
    """The registry as a catalog table in a plain file format.

    ``table`` (``database.name``) is a view of the newest version, a table
    clustered by id into ``buckets`` buckets. An upsert joins the newest version
    with the batch in full, bucket by bucket: only the batch is shuffled, as its
    target is read in buckets already, and every task writes one bucket of the
    next version. Replacing the view commits it, so readers see the old or the
    new registry, and what a failed upsert leaves is never read. The version
    before the newest is kept for queries that still run; older ones are dropped.

    Databases and tables are made if they are missing; ``location`` is the folder
    of the tables (default: the database's). One writer at a time.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int = 64, using: str = "parquet", location: str | None = None):
        self.spark, self.table, self.buckets, self.using = spark, table, buckets, using
        self.location = location and location.rstrip("/")
        database, _, name = table.rpartition(".")
        self._prefix = f"{database}." if database else ""
        self._name = name
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if not spark.catalog.tableExists(table):
            self._commit(self._new_version(), None)

    def _new_version(self) -> str:
        version = f"{self._prefix}{self._name}_{uuid.uuid4().hex}"
        at = f" LOCATION '{self.location}/{version.rpartition('.')[2]}'" if self.location else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {version} ({REGISTRY_DDL}) USING {self.using} "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS{at}"
        )
        return version

    def _commit(self, version: str, before: str | None) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('version' = '{version}', 'before' = '{before or ''}') AS SELECT * FROM {version}"
        )

    def versions(self) -> tuple[str, str | None]:
        """The tables of the newest version and of the one before."""
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()}
        return found["version"], found["before"] or None

    def current(self) -> DataFrame:
        return self.spark.table(self.table)

    def merged(self, source: DataFrame) -> DataFrame:
        """The registry after the upsert, in the partitions of its buckets."""
        target = self.spark.table(self.versions()[0]).alias("t")
        batch = source.select(*REGISTRY.fieldNames()).repartition(self.buckets, KEY).alias("s")
        # a full outer join: it is never broadcast, and ids are unique on both sides, so no key is hot
        met = target.join(batch, F.col(f"t.{KEY}") == F.col(f"s.{KEY}"), "full_outer")
        new = F.col(f"s.{KEY}").isNotNull()
        return met.select(*[F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in REGISTRY.fieldNames()])

    def merge(self, source: DataFrame) -> str:
        """Keyed upsert of ``source``; returns the table of the new version.
        Raises :class:`DuplicateKeyError` for a source that repeats a key, and
        ``ValueError`` for one with a null key."""
        with scratch_scope(self.spark):
            source = materialize(source.select(*REGISTRY.fieldNames()), "upsert")
            assert_unique_keys(source)
            if not source.where(F.col(KEY).isNull()).isEmpty():
                raise ValueError(f"upsert source has a null {KEY}")
            newest, before = self.versions()
            version = self._new_version()
            self.merged(source).createOrReplaceTempView("__corpreg_merged")
            try:
                self.spark.sql(f"INSERT OVERWRITE TABLE {version} SELECT * FROM __corpreg_merged")
            finally:
                self.spark.catalog.dropTempView("__corpreg_merged")
            self._commit(version, newest)
        if before:
            self.spark.sql(f"DROP TABLE IF EXISTS {before}")
            if self.location:  # dropping a table with a folder of its own leaves the files
                delete_paths(self.spark, [f"{self.location}/{before.rpartition('.')[2]}"])
        return version


def ensure_registry_table(spark: SparkSession, table: str, using: str) -> None:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for a catalog table."""
    parts = table.split(".")
    if len(parts) > 1:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {'.'.join(parts[:-1])}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({REGISTRY_DDL}) USING {using}")


def merge_into_table(spark: SparkSession, table: str, source: DataFrame) -> None:
    """Keyed upsert into a catalog table whose format supports MERGE."""
    assert_unique_keys(source)
    cols = [c for c in REGISTRY.fieldNames() if c != KEY]
    sets = ", ".join(f"target.{c} = source.{c}" for c in cols)
    spark.sql(
        f"MERGE INTO {table} AS target USING {{src}} AS source ON target.{KEY} = source.{KEY} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT *",
        src=source,
    )
