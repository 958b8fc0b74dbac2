"""Fuzzy name matching (edit distance <= k) as distributed equi-joins.

A theta join on ``levenshtein(a, b) <= k`` plans as a nested loop over both
inputs. Here the candidate pairs come from an equi-join on keys made of
segments (after the partition-based similarity join, Li et al., PVLDB 5(3),
2011):

* every index name of length L is cut into up to ``SEGMENTS_PER_EDIT * (k+1)``
  segments. Of those only the k+2 rarest are used: k edits break at most k of
  them, so a name within k edits holds two of them intact, each close to its
  own position. Each two of the k+2 make one key, so names meet on what tells
  them apart twice over: a key is as selective as the product of both segments;
* a probe name looks, for each feasible L and segment, at the substrings that
  could be that intact segment. Those that are a used segment of no index name
  go first (a semi-join on the segment's hash); each two of the others that
  the same k edits allow make one key;
* names too short for k+2 segments of two characters meet on one of k+1;
* each candidate is verified with ``levenshtein(a, b, k)`` before any shuffle
  of the pairs. Keys are 64-bit hashes: a collision adds a candidate at most.

Index names of length <= k have empty segments; they meet the short probe
names (length <= 2k) on deletion variants instead (see :func:`_short_pairs`).

Every step works on *distinct* names, so a name repeated in a third of all
rows is a single row here. The joins are plain inner joins on hashed keys,
planned as shuffled ones (:func:`corpreg.session.shuffled`): AQE's skew-join
split applies to them when a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpreg.functions.names import canonical_name, corporate_id, normalized_name
from corpreg.params import S1_NAME, S2_NAME, Params
from corpreg.session import materialize, shuffled


def _seq(lo: Column, hi: Column) -> Column:
    """Ascending integer range, empty when lo > hi (Spark would count down)."""
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


SEGMENTS_PER_EDIT, SEGMENT_LENGTH = 6, 3


def _parts(L: Column, k: int) -> Column:
    """Number of segments of a length-L string: of ``SEGMENT_LENGTH`` characters
    or more, at most ``SEGMENTS_PER_EDIT * (k+1)`` of them, but k+2 where that
    leaves two characters each, and k+1 otherwise."""
    least = F.when(L >= 2 * (k + 2), k + 2).otherwise(k + 1)
    wanted = F.floor(L / SEGMENT_LENGTH).cast("int")
    return F.least(F.lit(SEGMENTS_PER_EDIT * (k + 1)), F.greatest(least, wanted))


def _paired(L: Column, k: int) -> Column:
    """Whether names of length L meet on two segments."""
    return _parts(L, k) >= k + 2


def _segment(L: Column, j: Column, parts: Column) -> tuple[Column, Column]:
    """0-based start and length of segment j of a length-L string in ``parts`` parts.

    The first ``parts - L % parts`` segments are ``L div parts`` long, the
    others one longer.
    """
    q = F.floor(L / parts).cast("int")
    n_short = parts - (L % parts)
    length = q + F.when(j >= n_short, 1).otherwise(0)
    start = j * q + F.greatest(F.lit(0), j - n_short)
    return start, length


def _hash(L: Column, j: Column, name: Column, at: Column, length: Column) -> Column:
    return F.xxhash64(L, j, F.substring(name, at + 1, length))


def _pair_keys(found: Column, fits) -> Column:
    """Keys of each two elements (j, seg, ..) of ``found`` with growing j that ``fits`` allows."""
    return F.flatten(
        F.transform(found, lambda c: F.transform(F.filter(found, lambda d: (d["j"] > c["j"]) & fits(c, d)), lambda d: F.xxhash64(c["seg"], d["seg"])))
    )


def segments(names: DataFrame, k: int, name: str = "name") -> DataFrame:
    """(name, L, j, seg): all segments of every name longer than k, hashed
    together with L and j."""
    rows = names.select(F.col(name).alias("name"), F.length(name).alias("L")).where(F.col("L") > k)
    parts = _parts(F.col("L"), k)
    rows = rows.select("name", "L", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("j"))
    start, length = _segment(F.col("L"), F.col("j"), F.col("parts"))
    return rows.select("name", "L", "j", _hash(F.col("L"), F.col("j"), F.col("name"), start, length).alias("seg"))


def chosen_segments(index_names: DataFrame, probe_names: DataFrame, k: int) -> DataFrame:
    """(name, L, chosen): of every index name longer than k its k+2 segments
    (j, seg) that the fewest names of both sides have (ties: the first ones);
    all k+1 of a name that has no more."""
    own = segments(index_names, k)
    shared = own.select("seg").unionByName(segments(probe_names, k).select("seg")).groupBy("seg").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct("n", "j", "seg")))  # at most SEGMENTS_PER_EDIT * (k+1) of a name
    some = own.join(shuffled(shared), "seg").groupBy("name", "L").agg(F.slice(ranked, 1, k + 2).alias("chosen"))
    return some.select("name", "L", F.transform("chosen", lambda c: F.struct(c["j"].alias("j"), c["seg"].alias("seg"))).alias("chosen"))


def index_keys(chosen: DataFrame, k: int) -> DataFrame:
    """(key, a): the keys of every index name longer than k."""
    single = F.transform("chosen", lambda c: c["seg"])
    keys = F.when(_paired(F.col("L"), k), _pair_keys(F.col("chosen"), lambda c, d: F.lit(True))).otherwise(single)
    return chosen.select(F.explode(keys).alias("key"), F.col("name").alias("a"))


def segment_probes(names: DataFrame, k: int, name: str = "name") -> DataFrame:
    """(name, L, j, shift, seg): the substrings of each probe name that can equal
    an intact segment of an index name of length L within k edits.

    A shift by s leaves |s| edits to the left of the segment and |T - L - s| to
    its right, k in all. Where a name has k+1 segments only, all of them are
    indexed, and one even has at most j edits to the left and k - j to the right."""
    T, L, j, parts, start, length = (F.col(c) for c in ("T", "L", "j", "parts", "start", "length"))
    # every name becomes about a hundred rows: spread over all tasks, not by the size of the names
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # row by row and not by functions on arrays, which run interpreted and repeat what they share
    rows = names.repartition(spread, name).select(F.col(name).alias("name"), F.length(name).alias("T"))
    rows = rows.select("name", "T", F.explode(_seq(F.greatest(F.lit(k + 1), T - k), T + k)).alias("L"))
    rows = rows.select("name", "T", "L", _parts(L, k).alias("parts"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("j"))
    at, size = _segment(L, j, parts)
    rows = rows.select("*", at.alias("start"), size.alias("length"))
    delta = T - L
    left = F.when(parts == k + 1, j).otherwise(k)
    right = F.when(parts == k + 1, F.lit(k) - j).otherwise(k)
    lo = F.greatest(-start, -left, delta - right, F.ceil((delta - k) / 2).cast("int"))
    hi = F.least(T - length - start, left, delta + right, F.floor((delta + k) / 2).cast("int"))
    rows = rows.select("name", "L", "j", "start", "length", F.explode(_seq(lo, hi)).alias("shift"))
    return rows.select("name", "L", "j", "shift", _hash(L, j, F.col("name"), start + F.col("shift"), length).alias("seg"))


def probe_keys(probes: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """(key, b): the keys that each probe name can share with an index name.
    ``probes``: see :func:`segment_probes`; ``chosen``: of the index names."""
    used = chosen.select(F.explode("chosen").alias("c")).select("c.seg").distinct()
    # at most as many rows of a name and a length as it has probes for it
    found = probes.join(shuffled(used), "seg", "left_semi").groupBy("name", "L").agg(F.collect_list(F.struct("j", "shift", "seg")).alias("found"))
    delta = F.length("name") - F.col("L")
    fits = lambda c, d: F.abs(c["shift"]) + F.abs(d["shift"] - c["shift"]) + F.abs(delta - d["shift"]) <= k
    single = F.transform("found", lambda c: c["seg"])
    keys = F.when(_paired(F.col("L"), k), _pair_keys(F.col("found"), fits)).otherwise(single)
    return found.select(F.explode(keys).alias("key"), F.col("name").alias("b"))


def deletion_variants(names: DataFrame, k: int, max_len: int) -> DataFrame:
    """(name, v): every string made from ``name`` by deleting at most k
    characters, for names of at most ``max_len`` characters."""
    cur = names.where(F.length("name") <= max_len).select("name", F.col("name").alias("v"))
    out = cur
    for _ in range(k):
        cur = (
            cur.where(F.length("v") > 0)
            .select("name", "v", F.explode(F.sequence(F.lit(1), F.length("v"))).alias("i"))
            .select("name", F.concat(F.expr("substring(v, 1, i - 1)"), F.expr("substring(v, i + 1)")).alias("v"))
        )
        out = out.unionByName(cur)
    return out.distinct()


def _salted_join(idx: DataFrame, prb: DataFrame, keys: list[str], salt: int) -> DataFrame:
    """Equi-join on ``keys``; with ``salt`` > 1 every key is split ``salt``
    ways: probe rows take a salt from a hash of their name, index rows are
    repeated once per salt value."""
    if salt <= 1:
        return idx.join(shuffled(prb), keys)
    idx = idx.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    prb = prb.withColumn("_salt", F.pmod(F.xxhash64("b"), F.lit(salt)).cast("int"))
    return idx.join(shuffled(prb), [*keys, "_salt"])


def _short_pairs(index_names: DataFrame, probe_names: DataFrame, k: int, salt: int = 1) -> DataFrame:
    """Candidates for index names of length <= k (they have empty segments).

    If ``levenshtein(a, b) <= k``, deleting at most k characters from each
    leaves a common string (a substitution is one deletion on each side), so
    the names meet on their deletion variants. Only names up to k (index)
    and 2k (probe) characters take part: at most 11 variants each for k = 2.
    The broadest key, "", pairs names of at most k characters, which are all
    true matches.
    """
    idx = deletion_variants(index_names, k, k).withColumnRenamed("name", "a")
    prb = deletion_variants(probe_names, k, 2 * k).withColumnRenamed("name", "b")
    return _salted_join(idx, prb, ["v"], salt).select("a", "b")


def candidate_pairs(index_names: DataFrame, probe_names: DataFrame, k: int, salt: int = 1, keep=lambda df: df) -> DataFrame:
    """Pairs (a, b) that share a key, possibly repeated, not yet verified.
    ``keep`` may write the chosen segments, which two branches read."""
    chosen = keep(chosen_segments(index_names, probe_names, k))
    long_pairs = _salted_join(index_keys(chosen, k), probe_keys(segment_probes(probe_names, k), chosen, k), ["key"], salt).select("a", "b")
    return long_pairs.unionByName(_short_pairs(index_names, probe_names, k, salt))


def similar_pairs(index_names: DataFrame, probe_names: DataFrame, k: int, salt: int = 1, keep=lambda df: df) -> DataFrame:
    """All distinct (a, b), a from ``index_names.name``, b from
    ``probe_names.name``, with ``levenshtein(a, b) <= k``. Inputs should be
    distinct, non-null names.

    Hot keys are split at run time by AQE; ``salt`` > 1 splits every key
    that many ways up front instead (index rows are repeated ``salt`` times).
    """
    return candidate_pairs(index_names, probe_names, k, salt, keep).where(F.levenshtein("a", "b", k) >= 0).distinct()


def _norms(df: DataFrame, name_col: str, params: Params) -> DataFrame:
    return (
        df.where(F.col(name_col).isNotNull())
        .select(normalized_name(name_col, params.suffix_regex).alias("name"))
        .distinct()
    )


def fuzzy_pairs_of_names(
    norm_1: DataFrame, norm_2: DataFrame, params: Params = Params(), index_side: int = 1, keep=lambda df: df
) -> DataFrame:
    """Pairs (norm_1, norm_2) of distinct normalized names within k edits.

    ``norm_1`` / ``norm_2`` hold one column ``name``. Names shorter than
    ``params.min_name_length`` match only when equal. ``index_side`` picks
    the side cut into segments; the other side looks at up to
    ``SEGMENTS_PER_EDIT * (k+1)`` segments at 13 shifts (k = 2) per name against
    six index keys, so the larger side should be the index.
    """
    k = params.max_edits
    m = params.min_name_length
    salt = params.segment_salt_buckets
    if index_side == 1:
        pairs = similar_pairs(norm_1, norm_2, k, salt, keep).select(F.col("a").alias("norm_1"), F.col("b").alias("norm_2"))
    else:
        pairs = similar_pairs(norm_2, norm_1, k, salt, keep).select(F.col("b").alias("norm_1"), F.col("a").alias("norm_2"))
    if m > 0:
        short = (F.length("norm_1") < m) | (F.length("norm_2") < m)
        pairs = pairs.where(~short | (F.col("norm_1") == F.col("norm_2")))
    return pairs


def fuzzy_pairs(
    s1: DataFrame, s2: DataFrame, params: Params = Params(), materialize_steps: bool = True
) -> DataFrame:
    """Distinct matching (norm_1, norm_2) name pairs between the two sources.

    The distinct normalized names of each source are written once first (one
    row per name): the segment join reads them from three branches, and
    without the cut each branch would rescan its source and normalize every
    row again.
    """
    n1, n2 = _norms(s1, S1_NAME, params), _norms(s2, S2_NAME, params)
    if not materialize_steps:
        return fuzzy_pairs_of_names(n1, n2, params)
    n1, n2 = materialize(n1), materialize(n2)
    side = 2 if n2.count() > n1.count() else 1
    return fuzzy_pairs_of_names(n1, n2, params, side, materialize)


def _with_norm(df: DataFrame, name_col: str, norm_col: str, params: Params) -> DataFrame:
    return df.where(F.col(name_col).isNotNull()).withColumn(
        norm_col, normalized_name(name_col, params.suffix_regex)
    )


def matched_names(pairs: DataFrame, side: int) -> DataFrame:
    """Distinct names of one side that have at least one partner. Anti-joins
    use this instead of ``pairs`` so that a name with many partners is one
    row on the build side."""
    col = "norm_1" if side == 1 else "norm_2"
    return pairs.select(F.col(col).alias("_matched")).distinct()


def unmatched_s1(s1: DataFrame, pairs: DataFrame, params: Params = Params()) -> DataFrame:
    """Source-1 rows (non-null name) whose name matches no Source-2 name."""
    a = _with_norm(s1, S1_NAME, "norm_name_s1", params)
    m = shuffled(matched_names(pairs, 1))
    return a.join(m, a["norm_name_s1"] == m["_matched"], "left_anti")


def unmatched_s2(s2: DataFrame, pairs: DataFrame, params: Params = Params()) -> DataFrame:
    """Source-2 rows (non-null name) whose name matches no Source-1 name."""
    b = _with_norm(s2, S2_NAME, "norm_name_s2", params)
    m = shuffled(matched_names(pairs, 2))
    return b.join(m, b["norm_name_s2"] == m["_matched"], "left_anti")


BLOCK_ROWS = 4096


def _cells(pairs: DataFrame, n1: DataFrame, n2: DataFrame) -> DataFrame:
    """(norm_1, norm_2, _pair, _n1, _n2): every pair with a number and how many blocks of
    about ``BLOCK_ROWS`` rows each of its names has; ``n1``, ``n2``: rows (n) of each name."""
    blocks = lambda names, side: shuffled(names.select(F.col("name").alias(f"norm_{side}"), F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias(f"_n{side}")))
    return pairs.join(blocks(n1, 1), "norm_1").join(blocks(n2, 2), "norm_2").withColumn("_pair", F.monotonically_increasing_id())


def _in_cells(rows: DataFrame, norm: str, cells: DataFrame, side: int) -> DataFrame:
    """``rows`` with the keys (_pair, _k1, _k2) of their cells: of each pair that has the row's
    name the row is in one block of its own side and meets every block of the other."""
    own, other = f"_k{side}", f"_k{3 - side}"
    cells = shuffled(cells.select(F.col(f"norm_{side}").alias("_name"), "_pair", "_n1", "_n2"))
    met = rows.join(cells, rows[norm] == F.col("_name")).withColumn(own, F.pmod(F.xxhash64("_row"), F.col(f"_n{side}")).cast("int"))
    met = met.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"_n{3 - side}") - 1)))
    # with a number: the rows that come out are not in the bytes by which small partitions would be joined
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.drop("_name", "_n1", "_n2", "_row").repartition(spread, "_pair", "_k1", "_k2")


def fuzzy_full_outer(
    s1: DataFrame, s2: DataFrame, pairs: DataFrame | None = None, params: Params = Params()
) -> DataFrame:
    """Row-level full outer fuzzy join with canonical name and corporate id.

    Same rows as ``s1 FULL OUTER JOIN s2 ON norm equal OR levenshtein <= k``,
    built from equi-joins only:

    * the rows of each pair of names are met in cells: each name's rows go in
      blocks of about ``BLOCK_ROWS``, and every block of the one name meets every
      block of the other under a key of its own;
    * ``LEFT ANTI JOIN pairs`` gives the rows that only one source has.

    The output of a pair of names is the product of their rows. A join on the
    names would make it in one task a name, or in fewer, as adaptive execution
    goes by the bytes read; a cell makes ``BLOCK_ROWS ** 2`` rows or so from
    ``2 * BLOCK_ROWS``, so tasks are even and as many as there are cores to
    take them. Both sources, with a number for every row that a repeated task
    finds again, and the pairs (distinct names only) are written once, as several
    branches read them.
    """
    a = _with_norm(s1, S1_NAME, "norm_name_s1", params)
    b = _with_norm(s2, S2_NAME, "norm_name_s2", params)
    a_cols = a.columns
    b_cols = b.columns
    # the id of a row is the MD5 of its canonical name's normalized form,
    # i.e. of norm_name_s1 when a Source-1 row is present, else norm_name_s2:
    # hash once per input row, not once per (much larger) output row
    a = materialize(a.withColumn("_id1", F.md5("norm_name_s1")).withColumn("_row", F.monotonically_increasing_id()))
    b = materialize(b.withColumn("_id2", F.md5("norm_name_s2")).withColumn("_row", F.monotonically_increasing_id()))
    rows_of = lambda df, norm: materialize(df.groupBy(F.col(norm).alias("name")).agg(F.count(F.lit(1)).alias("n")))
    n1, n2 = rows_of(a, "norm_name_s1"), rows_of(b, "norm_name_s2")
    if pairs is None:
        side = 2 if n2.count() > n1.count() else 1
        pairs = materialize(fuzzy_pairs_of_names(n1.select("name"), n2.select("name"), params, side, materialize))
    cells = materialize(_cells(pairs, n1, n2))
    in_a, in_b = _in_cells(a, "norm_name_s1", cells, 1), _in_cells(b, "norm_name_s2", cells, 2)
    # names are not null here, so the canonical one is known by the branch
    matched = in_a.join(shuffled(in_b), ["_pair", "_k1", "_k2"]).select(
        *a_cols, *b_cols, F.col(S1_NAME).alias("canonical_corporate_name"), F.col("_id1").alias("corporate_id")
    )
    m1, m2 = shuffled(matched_names(pairs, 1)), shuffled(matched_names(pairs, 2))
    left = a.join(m1, a["norm_name_s1"] == m1["_matched"], "left_anti").select(
        *a_cols,
        *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in b_cols],
        F.col(S1_NAME).alias("canonical_corporate_name"),
        F.col("_id1").alias("corporate_id"),
    )
    right = b.join(m2, b["norm_name_s2"] == m2["_matched"], "left_anti").select(
        *[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in a_cols],
        *b_cols,
        F.col(S2_NAME).alias("canonical_corporate_name"),
        F.col("_id2").alias("corporate_id"),
    )
    return matched.unionByName(left).unionByName(right)


def fuzzy_full_outer_naive(s1: DataFrame, s2: DataFrame, params: Params = Params()) -> DataFrame:
    """The theta-join formulation (nested loop); kept for benchmarks and tests."""
    a = _with_norm(s1, S1_NAME, "norm_name_s1", params)
    b = _with_norm(s2, S2_NAME, "norm_name_s2", params)
    cond = (a["norm_name_s1"] == b["norm_name_s2"]) | (
        F.levenshtein(a["norm_name_s1"], b["norm_name_s2"]) <= params.max_edits
    )
    joined = a.join(b, cond, "full_outer")
    return joined.withColumn("canonical_corporate_name", canonical_name(S1_NAME, S2_NAME)).withColumn(
        "corporate_id", corporate_id("canonical_corporate_name", params.suffix_regex)
    )
