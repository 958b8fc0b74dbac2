"""CSV landing files: discovery, header routing and strict typed reads.

* Discovery uses Spark's own (parallel) file listing through the
  ``binaryFile`` source with only file metadata selected, so file contents
  are not read; folders are skipped and only ``*.csv`` names are kept,
  recursively. Any Hadoop file system URI works (``s3a://``, ``abfss://``,
  ``hdfs://``, ``file:``); credentials belong in the caller's session config.
* Routing takes the header lines of all files from one scan of them as text
  (:func:`headers`), whatever their number: each task keeps the first line of
  the files that begin in its splits (``_metadata.file_block_start = 0``), and
  the role is an expression over it: Source 1 when the header has
  ``corporate_name_S1`` (tested first), Source 2 when it has
  ``corporate_name_S2``; other files are ignored. Only the routed names reach
  the driver, where Spark's file index holds them for any read.
* All files of one role are then read by ONE scan with the declared schema,
  ``FAILFAST`` and ``enforceSchema=False``: a header whose names differ from
  the schema raises instead of being read by position.
* :func:`read_role_folders` skips routing when each role has its own folder.
* Parse errors surface lazily in Spark; :func:`validated_counts` forces them
  inside the caller's check by an aggregate touching every typed column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpreg.params import S1_NAME, S2_NAME
from corpreg.schemas import FINANCIAL, SUPPLY_CHAIN

SOURCE_1, SOURCE_2 = "supply_chain", "financial"


class MissingSourceError(RuntimeError):
    """A required source role has no file."""


def discover_sources(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of every ``*.csv`` file under root."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def header_fields(line: Column) -> Column:
    """Field names of a CSV header line: split at commas outside quotes, quotes
    and a byte order mark removed, doubled quotes made single."""
    line = F.regexp_replace(line, "^\\x{FEFF}", "")
    fields = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    bare = lambda f: F.regexp_replace(F.regexp_replace(F.trim(f), r'^"([\s\S]*)"$', "$1"), '""', '"')
    return F.transform(fields, bare)


def role(columns: Column) -> Column:
    """The role of a file with these header fields, null for none."""
    return F.when(F.array_contains(columns, S1_NAME), SOURCE_1).when(F.array_contains(columns, S2_NAME), SOURCE_2)


def headers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, columns): the header fields of every ``*.csv`` file under
    ``paths`` (files or folders, searched recursively), from one scan.

    The first line that is not blank counts. A header is looked for where its
    file begins, so it lies within the first split; a line break inside quotes
    ends it. Files without such a line (empty files) are left out.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(paths)
    # url_decode takes "+" for a space, a file URI does not
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    begun = lines.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")).select(path.alias("path"), "value")
    # a file begins in one task, which meets its lines in order and keeps one of them
    first = begun.groupBy("path").agg(F.first("value").alias("line"))
    return first.select("path", header_fields(F.col("line")).alias("columns"))


def sniff_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line of one CSV file."""
    found = headers(spark, path).first()
    return list(found["columns"]) if found else []


def routed_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, role) of every file under ``paths`` that has a role."""
    return headers(spark, paths).select("path", role(F.col("columns")).alias("role")).where("role is not null")


def route_sources(spark: SparkSession, paths: list[str] | str) -> dict[str, list[str]]:
    """Role -> files in path order. Files with no known name column are left out."""
    found: dict[str, list[str]] = {SOURCE_1: [], SOURCE_2: []}
    if paths:
        for r in routed_files(spark, paths).collect():
            found[r["role"]].append(r["path"])
    return {of: sorted(files) for of, files in found.items()}


def read_source(spark: SparkSession, paths: list[str] | str, schema: StructType) -> DataFrame:
    """Typed, strict CSV scan of one or more files with the declared schema."""
    return spark.read.csv(
        paths, schema=schema, header=True, mode="FAILFAST", enforceSchema=False
    )


def read_sources(
    spark: SparkSession, root: str, policy: str = "union"
) -> tuple[DataFrame, DataFrame]:
    """Route and read both sources under ``root``: one scan for the headers,
    then one for each role.

    ``policy="union"`` reads every file of a role; ``policy="last"`` keeps
    only the last file of each role in listing order (path order).
    """
    routed = route_sources(spark, root)
    missing = [r for r, ps in routed.items() if not ps]
    if missing:
        raise MissingSourceError(f"no file for source role(s): {', '.join(missing)}")
    if policy == "last":
        routed = {r: ps[-1:] for r, ps in routed.items()}
    elif policy != "union":
        raise ValueError(f"unknown policy {policy!r}")
    s1 = read_source(spark, routed[SOURCE_1], SUPPLY_CHAIN)
    s2 = read_source(spark, routed[SOURCE_2], FINANCIAL)
    return s1, s2


def read_role_folders(spark: SparkSession, supply_chain_path: str, financial_path: str) -> tuple[DataFrame, DataFrame]:
    """Both sources when each role's files sit under their own folder: one
    strict scan per role and no per-file header reads, which suits landing
    areas with very many files. Headers are still checked by name."""
    s1 = read_csv_folder(spark, supply_chain_path, SUPPLY_CHAIN)
    s2 = read_csv_folder(spark, financial_path, FINANCIAL)
    return s1, s2


def read_csv_folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Strict typed scan of every ``*.csv`` file under ``path`` (recursive)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .csv(path)
    )


def validated_counts(df: DataFrame) -> dict[str, int]:
    """Row count and non-null count of every column, from one scan that
    parses every typed column (so FAILFAST errors are raised here)."""
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    ).first()
    return row.asDict()
