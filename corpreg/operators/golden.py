"""One golden record per corporate id.

Ranking rule inside an id (a total order, so the result is deterministic):
address desc, then the other Source-1 columns, then revenue, profit and the
other Source-2 columns, every key descending with NULLs last.

All rows of one id share one normalized name, hence one set of matching
names. The best row of an id is therefore the best Source-1 row of that name
combined with the best Source-2 row among all matching names, and ids of
Source-2-only names never meet a Source-1 row. So the operator ranks *before*
the join:

1. ``max(struct(...))`` per normalized name on each source. Struct order is
   field by field with NULL lowest, which is exactly "desc, NULLs last" under
   ``max``. It is a partial (map-side) aggregate, so a name that holds a
   third of all rows is reduced inside every input partition before the
   shuffle, and no task ever sees all rows of one name.
2. Fuzzy pairs between the distinct names (segment equi-join).
3. Best Source-2 struct per Source-1 name through the pairs, again a partial
   aggregate.

The row-level full outer join is never materialized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpreg.functions.names import corporate_id, normalized_name
from corpreg.operators.fuzzy import fuzzy_pairs_of_names, matched_names
from corpreg.operators.quality import counters, summed_metrics
from corpreg.params import S1_NAME, S2_NAME, Params
from corpreg.session import materialize, shuffled

# Rank keys in priority order (all descending, NULLs last).
S1_RANK = ("address", "corporate_name_S1", "activity_places", "top_suppliers")
S2_RANK = ("revenue", "profit", "corporate_name_S2", "main_customers")

GOLDEN_COLUMNS = (
    "corporate_id",
    "corporate_name",
    "address",
    "activity_places",
    "top_suppliers",
    "main_customers",
    "revenue",
    "profit",
)


def best_per_name(df: DataFrame, name_col: str, rank_cols, params: Params) -> DataFrame:
    """(norm, best): the highest-ranked row of every normalized name."""
    return _best(df.where(F.col(name_col).isNotNull()), name_col, rank_cols, params)


def _best(df: DataFrame, name_col: str, rank_cols, params: Params, *more) -> DataFrame:
    row = F.struct(*[F.col(c) for c in rank_cols])
    return df.groupBy(normalized_name(name_col, params.suffix_regex).alias("norm")).agg(F.max(row).alias("best"), *more)


def checked_best_per_name(df: DataFrame, source: str, name_col: str, rank_cols, params: Params) -> tuple[DataFrame, DataFrame]:
    """The written :func:`best_per_name` and the contract metrics of a source,
    both from one scan of it.

    The metrics' counters are further aggregates of the same groups (rows
    without a name are a group of their own here), written with them."""
    written = materialize(_best(df, name_col, rank_cols, params, *counters(df, name_col)), "best")
    metrics = summed_metrics(written, source, name_col, "revenue" in df.columns)
    return written.where("norm is not null").select("norm", "best"), metrics


def golden_from_best(
    best_s1: DataFrame, best_s2: DataFrame, pairs: DataFrame, params: Params = Params()
) -> DataFrame:
    """Golden records from per-name best rows and the (norm_1, norm_2) pairs."""
    s2_for_s1 = (
        pairs.join(shuffled(best_s2), pairs["norm_2"] == best_s2["norm"])
        .groupBy("norm_1")
        .agg(F.max("best").alias("best2"))
    )
    with_s1 = best_s1.join(shuffled(s2_for_s1), best_s1["norm"] == s2_for_s1["norm_1"], "left").select(
        F.md5("norm").alias("corporate_id"),
        F.col("best.corporate_name_S1").alias("corporate_name"),
        F.col("best.address").alias("address"),
        F.col("best.activity_places").alias("activity_places"),
        F.col("best.top_suppliers").alias("top_suppliers"),
        F.col("best2.main_customers").alias("main_customers"),
        F.col("best2.revenue").cast("double").alias("revenue"),
        F.col("best2.profit").cast("double").alias("profit"),
    )
    m2 = shuffled(matched_names(pairs, 2))
    s2_only = _as_golden_s2(best_s2.join(m2, best_s2["norm"] == m2["_matched"], "left_anti"))
    return with_s1.unionByName(s2_only)


def _as_golden_s2(best_s2: DataFrame) -> DataFrame:
    """Golden rows for Source-2 names that match no Source-1 name."""
    return best_s2.select(
        F.md5("norm").alias("corporate_id"),
        F.col("best.corporate_name_S2").alias("corporate_name"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("activity_places"),
        F.lit(None).cast("string").alias("top_suppliers"),
        F.col("best.main_customers").alias("main_customers"),
        F.col("best.revenue").cast("double").alias("revenue"),
        F.col("best.profit").cast("double").alias("profit"),
    )


def golden_records(
    s1: DataFrame | None, s2: DataFrame, params: Params = Params(), materialize_steps: bool = True
) -> DataFrame:
    """One golden row per corporate id; see :func:`golden_and_pairs`."""
    return golden_and_pairs(s1, s2, params, materialize_steps)[0]


def golden_and_pairs(
    s1: DataFrame | None, s2: DataFrame, params: Params = Params(), materialize_steps: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Golden records and the name pairs they were built from.

    One row per corporate id: ``corporate_id, corporate_name, address,
    activity_places, top_suppliers, main_customers, revenue, profit``.

    ``s1=None`` means Source 1 has not arrived: every Source-2 name is its
    own company.

    With ``materialize_steps`` the per-name best rows and the pairs (one row
    per distinct name or pair, far smaller than the input) are written once
    to the shared folder: each source is then scanned and aggregated once,
    although three branches of the plan use it, and the fuzzy join starts
    from a lineage cut.
    """
    keep = materialize if materialize_steps else (lambda df: df)
    if s1 is None:
        return _as_golden_s2(best_per_name(s2, S2_NAME, S2_RANK, params)), None
    best_s1 = keep(best_per_name(s1, S1_NAME, S1_RANK, params))
    best_s2 = keep(best_per_name(s2, S2_NAME, S2_RANK, params))
    return golden_of_names(best_s1, best_s2, params, materialize_steps)


def golden_of_names(
    best_s1: DataFrame, best_s2: DataFrame, params: Params = Params(), materialize_steps: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Golden records and name pairs from the per-name best rows of both sources."""
    keep = materialize if materialize_steps else (lambda df: df)
    # index the larger name set (counts are cheap once written)
    index_side = 1
    if materialize_steps and best_s2.count() > best_s1.count():
        index_side = 2
    pairs = keep(
        fuzzy_pairs_of_names(
            best_s1.select(F.col("norm").alias("name")),
            best_s2.select(F.col("norm").alias("name")),
            params,
            index_side,
            keep,
        )
    )
    return golden_from_best(best_s1, best_s2, pairs, params), pairs


def top_row_per_key(df: DataFrame, key: str, order_cols) -> DataFrame:
    """Keep the first row of every ``key`` when sorted by ``order_cols``, each
    descending with NULLs last, remaining columns as final tie-breakers.

    Implemented as a partial ``max(struct)`` aggregate, not a window: a key
    holding a third of the rows is reduced map-side before the shuffle.
    """
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c != key and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in (*order_cols, *rest)])
    out = df.groupBy(key).agg(F.max(packed).alias("_top"))
    return out.select(key, *[F.col(f"_top.{c}").alias(c) for c in df.columns if c != key])


def top_row_per_key_window(df: DataFrame, key: str, order_cols) -> DataFrame:
    """Same result as :func:`top_row_per_key` via ``row_number`` (all rows of
    a key go to one task). Kept as the direct formulation for tests."""
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c != key and c not in order_cols]
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in (*order_cols, *rest)])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def golden_from_harmonized(harmonized: DataFrame) -> DataFrame:
    """Golden records from the row-level fuzzy join (direct formulation)."""
    rows = harmonized.select(
        "corporate_id",
        F.col("canonical_corporate_name").alias("corporate_name"),
        *S1_RANK,
        *S2_RANK,
    )
    top = top_row_per_key_window(rows, "corporate_id", (*S1_RANK, *S2_RANK))
    return top.select(
        *[F.col(c).cast("double").alias(c) if c in ("revenue", "profit") else F.col(c) for c in GOLDEN_COLUMNS]
    )


__all__ = [
    "GOLDEN_COLUMNS",
    "best_per_name",
    "checked_best_per_name",
    "corporate_id",
    "golden_from_best",
    "golden_from_harmonized",
    "golden_and_pairs",
    "golden_of_names",
    "golden_records",
    "top_row_per_key",
    "top_row_per_key_window",
]
