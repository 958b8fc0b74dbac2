"""How the filters of a corpus interact: what each one removes in every order.

One pass turns each document into a mask of the filters it fails. Documents
are counted by (part, mask), 32 cells a part for five filters, and everything
else follows from the cells. A walk over the subsets of filters in Gray-code
order toggles one filter at a time: it keeps, for every cell, the number of
active filters that the cell fails, and the running survivors, to which a
cell is added when its number falls to zero and from which it is taken when
the number leaves zero. The survivors of all subsets are stored, and what a
filter removes after others is a difference of two of them.

Exact copies are found by the SHA-256 of the text: the smallest id of each
text is a partial aggregate, and a document is a copy if (text, id) is not
among those. The keys of that join are text and id together, so a text that a
third of all rows share is one row on one side and spread over its ids on the
other. The texts themselves are read once; a table of about a hundred bytes a
document is written for the rest.

Edge cases: a null text counts as empty, a null part as "". A null id has no
smaller id and is none: such rows never count as copies. Rows of one id and
text count one by one, none is a copy of the other. An id with several label
rows is good or toxic if one of them says so; other ids are neither. Without
documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FILTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
SPACE = r"[\x20\x09-\x0D]+"
PARTS_AT_ONCE = 32


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: under 50 words, under 65 %
    distinct words, over 5 % capitals, a sign of code."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return F.transform(
        F.array(F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct"))),
        lambda w: (
            F.when(w["n"] < 50, 1).otherwise(0)
            + F.when(F.lit(100) * w["distinct"] < F.lit(65) * w["n"], 2).otherwise(0)
            + F.when(F.lit(100).cast("long") * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(5) * F.length(text), 4).otherwise(0)
            + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)
        ),
    )[0]


def cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_failures(text).alias("fails"),
    )
    slim = slim.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n"))
    slim = materialize(slim, "filter-masks")
    firsts = slim.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    met = slim.join(firsts, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    mask = F.col("fails") + F.when(copy, 16).otherwise(0)
    return met.groupBy("part", mask.alias("mask")).agg(F.sum("n").alias("n"), marked("quality").alias("good"), marked("toxic").alias("toxic"))


def survivors(counts: np.ndarray, filters: int = len(FILTERS)) -> np.ndarray:
    """Survivors of every subset of filters. ``counts``: (..., 2^filters) by
    the mask of failures; the result has a subset's bits in the same place."""
    states = np.empty_like(counts)
    masks = np.arange(1 << filters)
    failing = np.zeros(1 << filters, np.int64)  # active filters that a cell fails
    running, active = counts.sum(-1), 0
    states[..., 0] = running
    for k in range(1, 1 << filters):
        bit = (k & -k).bit_length() - 1  # the one that the Gray code toggles
        hit = masks[(masks >> bit & 1) == 1]
        active ^= 1 << bit
        if active >> bit & 1:
            running = running - counts[..., hit[failing[hit] == 0]].sum(-1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[..., hit[failing[hit] == 0]].sum(-1)
        states[..., active] = running
    return states


def steps(parts: list[str], counts: np.ndarray, filters: str = FILTERS) -> pd.DataFrame:
    """The report of ``parts``; ``counts``: (parts, 3, 2^filters) of documents,
    good and toxic ones."""
    states, size = survivors(counts, len(filters)), len(filters)
    orders = list(permutations(range(size)))
    bits = 1 << np.array(orders)
    after = np.cumsum(bits, 1)
    before = after - bits
    which = np.array(orders)
    lost = states[..., before] - states[..., after]  # parts, 3, orders, steps
    fails = states[:, 0, :1] - states[:, 0, 1 << np.arange(size)]
    shapley = np.stack([lost[:, 0][:, which == f].sum(1) for f in range(size)], 1)
    found = {
        "kept": states[:, 0][:, after],
        "removed": lost[:, 0],
        "redundant": fails[:, which] - lost[:, 0],
        "unique_fails": counts[:, 0][:, bits],
        "good_lost": lost[:, 1],
        "toxic_lost": lost[:, 2],
        "shapley": shapley[:, which],
    }
    names = np.array(["".join(filters[f] for f in o) for o in orders])
    out = {
        "part": np.repeat(np.array(parts, object), len(orders) * size),
        "filter_order": np.tile(np.repeat(names, size), len(parts)),
        "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(parts) * len(orders)),
    }
    return pd.DataFrame(out | {c: found[c].ravel() for c in COUNTS})


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step. ``docs`` has doc_id,
    text and ``part``; ``labels`` doc_id, quality and toxic."""
    rows = cells(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PARTS_AT_ONCE):
                own = batch.iloc[at : at + PARTS_AT_ONCE]
                counts = np.zeros((len(own), 3, 1 << len(FILTERS)), np.int64)
                for i, of in enumerate(own["cells"]):
                    for c in of:
                        counts[i, :, c["mask"]] = c["n"], c["good"], c["toxic"]
                yield steps(own["part"].tolist(), counts)

    return rows.mapInPandas(walk, SCHEMA)
