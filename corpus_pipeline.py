"""A corpus pipeline made of the operators of ``corpreg.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns the documents it keeps, the last one the packed pieces. ``run``
applies them in turn to the documents of ``sf_dir``; every stage's result is
written to the shared folder and read back for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpreg.llm import decontam, langid, near_dup, packing, suffix_dedup
from corpreg.llm.queries import tokenizer_file
from corpreg.session import materialize

MIN_LANGUAGE_SCORE = 0.3  # four languages: not far above an even split


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is one of the learned ones, with a score
    of at least ``MIN_LANGUAGE_SCORE``; texts that are null or have no letter go."""
    names = docs.columns
    model = langid.train(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    named = docs.withColumn("__lang", langid.predictor(spark, model)(F.col("text").cast("string")))
    return named.where((F.col("__lang.lang_pred") != langid.UND) & (F.col("__lang.score") >= MIN_LANGUAGE_SCORE)).select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each class of near duplicates."""
    return near_dup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out strings of 50 bytes or more that a document with a smaller
    doc_id has too; documents of which nothing is left go."""
    return suffix_dedup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item. Null, empty and wordless texts
    hold none and stay, as do all documents if the benchmark is empty; rows with
    a null or repeated doc_id are judged one by one."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 tokens. A null or empty
    text is the end token alone; repeated rows are packed as often as they come;
    without documents there are no rows."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained network decides the first stage, which SQL can't express.
ORACLE_SQL = None
