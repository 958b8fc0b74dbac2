"""Oracle SQL (DuckDB dialect) for the registered queries.

The oracle is written the direct way: a theta full outer join on
``levenshtein <= 2``, ``row_number`` for golden rows, a nested-loop join for
the risk tag. It shares only the source views with the Spark plans, so a
match is an independent check of the rewrites.

DuckDB differences handled here: ``regexp_replace`` needs the ``'g'`` flag
to replace every match; its ``\\b`` and ``\\s`` are ASCII (the test tables
are ASCII).
"""

from __future__ import annotations

from corpreg.operators.training import IRLS_MAX_ITER
from corpreg.params import SUFFIX_REGEX, LEVENSHTEIN_THRESHOLD, Params
from corpreg.sources.fixtures import DOCUMENT_KEYWORDS, duckdb_view_sql

P = Params()


def _norm(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '{SUFFIX_REGEX}', '', 'g'))"


def _risk_tagged(golden: str, out: str, feed: str = "feed", keywords=P.risk_keywords) -> str:
    kw = " OR ".join(f"contains(lower(f.headline), '{k}')" for k in keywords)
    return f"""
{out}_tok AS (SELECT corporate_id, regexp_extract(lower(corporate_name), '^\\s*(\\S+)', 1) AS tok FROM {golden}),
{out}_hit AS (SELECT t.corporate_id, min(f.position) AS pos FROM {out}_tok t JOIN {feed} f
              ON t.tok <> '' AND contains(lower(f.headline), t.tok) AND ({kw})
              GROUP BY t.corporate_id),
{out} AS (SELECT g.*, CASE WHEN f.headline IS NULL THEN 'None Identified'
                          ELSE 'Flagged Local Risk Scan: ' || f.headline END AS adverse_media_news
          FROM {golden} g LEFT JOIN {out}_hit h ON g.corporate_id = h.corporate_id
          LEFT JOIN {feed} f ON f.position = h.pos)"""


RANK_ORDER = (
    "address DESC NULLS LAST, corporate_name_S1 DESC NULLS LAST, activity_places DESC NULLS LAST, "
    "top_suppliers DESC NULLS LAST, revenue DESC NULLS LAST, profit DESC NULLS LAST, "
    "corporate_name_S2 DESC NULLS LAST, main_customers DESC NULLS LAST"
)
GOLDEN_SELECT = (
    "corporate_id, canonical_corporate_name AS corporate_name, address, activity_places, top_suppliers, "
    "main_customers, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit"
)


def base_ctes() -> str:
    v = duckdb_view_sql()
    k = LEVENSHTEIN_THRESHOLD
    return f"""WITH corp_s1 AS ({v['corp_s1']}),
corp_s2 AS ({v['corp_s2']}),
corp_s2_earlier AS ({v['corp_s2_earlier']}),
feed AS ({v['feed']}),
document_feed AS ({v['document_feed']}),
s1 AS (SELECT *, {_norm('corporate_name_S1')} AS norm_name_s1 FROM corp_s1 WHERE corporate_name_S1 IS NOT NULL),
s2 AS (SELECT *, {_norm('corporate_name_S2')} AS norm_name_s2 FROM corp_s2 WHERE corporate_name_S2 IS NOT NULL),
fo AS (SELECT s1.*, s2.* FROM s1 FULL OUTER JOIN s2
       ON s1.norm_name_s1 = s2.norm_name_s2 OR levenshtein(s1.norm_name_s1, s2.norm_name_s2) <= {k}),
harm AS (SELECT *, coalesce(corporate_name_S1, corporate_name_S2) AS canonical_corporate_name,
                md5({_norm('coalesce(corporate_name_S1, corporate_name_S2)')}) AS corporate_id FROM fo),
golden AS (SELECT {GOLDEN_SELECT} FROM (
             SELECT *, row_number() OVER (PARTITION BY corporate_id ORDER BY {RANK_ORDER}) AS rn FROM harm)
           WHERE rn = 1),
{_risk_tagged('golden', 'tagged')},
{_risk_tagged('golden', 'tagged_documents', 'document_feed', DOCUMENT_KEYWORDS)},
harm_a AS (SELECT NULL::VARCHAR AS corporate_name_S1, NULL::VARCHAR AS address, NULL::VARCHAR AS activity_places,
                  NULL::VARCHAR AS top_suppliers, e.*, corporate_name_S2 AS canonical_corporate_name,
                  md5({_norm('corporate_name_S2')}) AS corporate_id
           FROM corp_s2_earlier e WHERE corporate_name_S2 IS NOT NULL),
golden_a AS (SELECT {GOLDEN_SELECT} FROM (
             SELECT *, row_number() OVER (PARTITION BY corporate_id ORDER BY {RANK_ORDER}) AS rn FROM harm_a)
           WHERE rn = 1),
{_risk_tagged('golden_a', 'tagged_a')},
registry AS (SELECT * FROM tagged_a WHERE corporate_id NOT IN (SELECT corporate_id FROM tagged)
             UNION ALL SELECT * FROM tagged),
features AS (SELECT *, CASE WHEN profit > {P.profit_threshold} THEN 1 ELSE 0 END AS high_profit_indicator,
                    CASE WHEN top_suppliers IS NULL OR trim(top_suppliers) = '' THEN 0
                         ELSE CAST(len(string_split(top_suppliers, ',')) AS INTEGER) END AS supplier_count0
             FROM tagged)
"""


def _q(body: str) -> str:
    return base_ctes() + body


IRLS_STEPS = 25


def _irls() -> str:
    """Iteratively reweighted least squares in plain SQL: both features are
    standardized, each step solves the 3 x 3 normal equations by cofactors."""
    sql = f""", rows_ AS MATERIALIZED (
  SELECT corporate_id, high_profit_indicator AS y, coalesce(revenue, 0.0) AS revenue, CAST(supplier_count0 AS DOUBLE) AS suppliers,
         ('0x' || substr(md5(corporate_id), 1, 13))::BIGINT < {P.train_fraction * 16.0**13} AS train
  FROM features),
scale AS MATERIALIZED (SELECT avg(revenue) AS m1, stddev_pop(revenue) AS s1, avg(suppliers) AS m2, stddev_pop(suppliers) AS s2, count(*) AS n FROM rows_ WHERE train),
t AS MATERIALIZED (SELECT y, (revenue - m1) / s1 AS x1, (suppliers - m2) / s2 AS x2 FROM rows_, scale WHERE train),
b0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS c0, 0.0::DOUBLE AS c1, 0.0::DOUBLE AS c2)"""
    for n in range(IRLS_STEPS):
        sql += f""",
b{n + 1} AS MATERIALIZED (
  SELECT c0 + ((s11 * s22 - s12 * s12) * g0 + (s02 * s12 - s01 * s22) * g1 + (s01 * s12 - s02 * s11) * g2) / det AS c0,
         c1 + ((s02 * s12 - s01 * s22) * g0 + (s00 * s22 - s02 * s02) * g1 + (s01 * s02 - s00 * s12) * g2) / det AS c1,
         c2 + ((s01 * s12 - s02 * s11) * g0 + (s01 * s02 - s00 * s12) * g1 + (s00 * s11 - s01 * s01) * g2) / det AS c2
  FROM (SELECT *, s00 * (s11 * s22 - s12 * s12) - s01 * (s01 * s22 - s12 * s02) + s02 * (s01 * s12 - s11 * s02) AS det
        FROM (SELECT any_value(c0) AS c0, any_value(c1) AS c1, any_value(c2) AS c2, sum(w) AS s00, sum(w * x1) AS s01, sum(w * x2) AS s02,
                     sum(w * x1 * x1) AS s11, sum(w * x1 * x2) AS s12, sum(w * x2 * x2) AS s22, sum(y - p) AS g0, sum((y - p) * x1) AS g1, sum((y - p) * x2) AS g2
              FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(c0 + c1 * x1 + c2 * x2))) AS p FROM t, b{n})))))"""
    return sql + f""",
model AS MATERIALIZED (SELECT c0 - c1 * m1 / s1 - c2 * m2 / s2 AS intercept, c1 / s1 AS coef_revenue, c2 / s2 AS coef_supplier_count, n AS train_rows FROM b{IRLS_STEPS}, scale),
scored AS MATERIALIZED (SELECT corporate_id, y, intercept + coef_revenue * revenue + coef_supplier_count * suppliers AS eta FROM rows_, model WHERE NOT train),
auc AS MATERIALIZED (
  SELECT CASE WHEN p > 0 AND n > 0 THEN (ranks - p * (p + 1) / 2.0) / (p * n) END AS auc, p, n
  FROM (SELECT sum(CASE WHEN y = 1 THEN mean_rank END) AS ranks, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n
        FROM (SELECT y, rank() OVER (ORDER BY eta) + (count(*) OVER (PARTITION BY eta) - 1) / 2.0 AS mean_rank FROM scored)))
"""


PREDICTIONS = """SELECT corporate_id, y AS high_profit_indicator, round(1 / (1 + exp(-eta)), 6) AS probability_1,
       CASE WHEN eta > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM scored"""


def oracle_sql() -> dict[str, str]:
    reg_cols = (
        "corporate_id, corporate_name, address, activity_places, top_suppliers, main_customers, "
        "revenue, profit, adverse_media_news"
    )
    return {
        "name_not_null": _q(
            "SELECT 'supply_chain' AS source, corporate_name_S1 AS corporate_name FROM corp_s1 "
            "WHERE corporate_name_S1 IS NOT NULL UNION ALL SELECT 'financial', corporate_name_S2 FROM corp_s2 "
            "WHERE corporate_name_S2 IS NOT NULL"
        ),
        "normalize_names": _q(
            "SELECT 'supply_chain' AS source, corporate_name_S1 AS raw_name, norm_name_s1 AS norm_name FROM s1 "
            "UNION ALL SELECT 'financial', corporate_name_S2, norm_name_s2 FROM s2"
        ),
        "corporate_id": _q(
            "SELECT 'supply_chain' AS source, corporate_name_S1 AS raw_name, md5(norm_name_s1) AS corporate_id FROM s1 "
            "UNION ALL SELECT 'financial', corporate_name_S2, md5(norm_name_s2) FROM s2"
        ),
        "canonical_name": _q("SELECT DISTINCT canonical_corporate_name, corporate_id FROM harm"),
        "fuzzy_pairs": _q(
            "SELECT DISTINCT norm_name_s1 AS norm_1, norm_name_s2 AS norm_2 FROM fo "
            "WHERE norm_name_s1 IS NOT NULL AND norm_name_s2 IS NOT NULL"
        ),
        "unmatched_s1": _q(
            "SELECT corporate_name_S1, address, activity_places, top_suppliers, norm_name_s1 FROM fo "
            "WHERE norm_name_s2 IS NULL"
        ),
        "unmatched_s2": _q(
            "SELECT corporate_name_S2, main_customers, revenue, profit, norm_name_s2 FROM fo WHERE norm_name_s1 IS NULL"
        ),
        "fuzzy_full_outer": _q("SELECT * FROM harm"),
        "golden_records": _q("SELECT * FROM golden"),
        "golden_count": _q("SELECT count(*) AS golden_rows FROM golden"),
        "source_counts": _q(
            "SELECT 'supply_chain' AS source, count(*) AS row_count FROM corp_s1 "
            "UNION ALL SELECT 'financial', count(*) FROM corp_s2"
        ),
        "dq_null_names": _q(
            "SELECT 'supply_chain' AS source, 'corporate_name_S1' AS name_column, "
            "count(*) FILTER (WHERE corporate_name_S1 IS NULL OR corporate_name_S1 = '') AS null_or_blank_names "
            "FROM corp_s1 UNION ALL SELECT 'financial', 'corporate_name_S2', "
            "count(*) FILTER (WHERE corporate_name_S2 IS NULL OR corporate_name_S2 = '') FROM corp_s2"
        ),
        "dq_avg_revenue": _q(
            "SELECT 'financial' AS source, round(avg(revenue), 2) AS avg_revenue FROM corp_s2"
        ),
        "dq_verdicts": _q(
            f"""SELECT 'supply_chain' AS source, 'null_or_blank_name' AS rule,
                   CAST(count(*) FILTER (WHERE corporate_name_S1 IS NULL OR corporate_name_S1 = '') AS DOUBLE) AS metric_value,
                   CAST(0 AS DOUBLE) AS threshold,
                   count(*) FILTER (WHERE corporate_name_S1 IS NULL OR corporate_name_S1 = '') = 0 AS passed FROM corp_s1
            UNION ALL
            SELECT 'financial', 'null_or_blank_name',
                   CAST(count(*) FILTER (WHERE corporate_name_S2 IS NULL OR corporate_name_S2 = '') AS DOUBLE),
                   CAST(0 AS DOUBLE),
                   count(*) FILTER (WHERE corporate_name_S2 IS NULL OR corporate_name_S2 = '') = 0 FROM corp_s2
            UNION ALL
            SELECT 'financial', 'min_avg_revenue', round(avg(revenue), 2),
                   CAST({P.min_avg_revenue} AS DOUBLE),
                   avg(revenue) IS NULL OR avg(revenue) >= {P.min_avg_revenue} FROM corp_s2"""
        ),
        "match_rate": _q(
            """SELECT g.n AS golden_rows, s.n AS s2_rows, s.m AS matched_s2_rows,
                      CASE WHEN s.n > 0 THEN round_even(CAST(g.n AS DOUBLE) * 100.0 / s.n, 2) ELSE 0.0 END AS match_rate_pct,
                      CASE WHEN s.n > 0 THEN round_even(CAST(s.m AS DOUBLE) * 100.0 / s.n, 2) ELSE 0.0 END AS matched_s2_pct
               FROM (SELECT count(*) AS n FROM golden) g,
                    (SELECT count(*) AS n,
                            count(*) FILTER (WHERE EXISTS (SELECT 1 FROM s1 WHERE s1.norm_name_s1 = s2n.nn
                                     OR levenshtein(s1.norm_name_s1, s2n.nn) <= 2)) AS m
                     FROM (SELECT """
            + _norm("corporate_name_S2")
            + """ AS nn FROM corp_s2) s2n) s"""
        ),
        "drift_check": _q(
            f"""SELECT round_even(r, 2) AS match_rate_pct,
                       CAST({P.historical_match_rate_pct - P.match_rate_deviation_pct} AS DOUBLE) AS lower_bound_pct,
                       CAST({P.historical_match_rate_pct + P.match_rate_deviation_pct} AS DOUBLE) AS upper_bound_pct,
                       (r < {P.historical_match_rate_pct - P.match_rate_deviation_pct}
                        OR r > {P.historical_match_rate_pct + P.match_rate_deviation_pct}) AS drift_triggered,
                       CASE WHEN r < {P.historical_match_rate_pct - P.match_rate_deviation_pct}
                                 OR r > {P.historical_match_rate_pct + P.match_rate_deviation_pct}
                            THEN 'CRITICAL' ELSE 'HEALTHY' END AS pipeline_health_status
                FROM (SELECT CASE WHEN s.n > 0 THEN CAST(g.n AS DOUBLE) * 100.0 / s.n ELSE 0.0 END AS r
                      FROM (SELECT count(*) AS n FROM golden) g, (SELECT count(*) AS n FROM corp_s2) s)"""
        ),
        "risk_screen": _q("SELECT * FROM tagged"),
        "risk_screen_documents": _q("SELECT * FROM tagged_documents"),
        "registry_snapshots": _q(
            """SELECT 1::BIGINT AS snapshot_id, 'append' AS operation
               UNION ALL SELECT 2, CASE WHEN EXISTS (SELECT 1 FROM tagged_a JOIN tagged USING (corporate_id))
                                        THEN 'overwrite' ELSE 'append' END"""
        ),
        "batch_view": _q(
            "SELECT adverse_media_news, count(*) AS companies, count(revenue) AS with_revenue, "
            "CAST(sum(CAST(revenue AS DECIMAL(18, 2))) AS DOUBLE) AS revenue, count(top_suppliers) AS with_suppliers FROM tagged GROUP BY adverse_media_news"
        ),
        "registry_table_merge": _q(f"SELECT {reg_cols} FROM registry"),
        "profit_model": _q(
            _irls() + "SELECT round(intercept, 6) AS intercept, round(coef_revenue, 12) AS coef_revenue, "
            "round(coef_supplier_count, 6) AS coef_supplier_count, train_rows FROM model"
        ),
        "profit_predictions": _q(_irls() + PREDICTIONS),
        "score_with_saved_model": _q(_irls() + PREDICTIONS),
        "profit_auc": _q(_irls() + "SELECT round(auc, 6) AS area_under_roc, round(auc, 6) AS auc_rank, p AS positives, n AS negatives FROM auc"),
        "training_runs": _q(
            _irls()
            + f"""SELECT 'GeneralizedLinearRegression' AS estimator_class, {IRLS_MAX_ITER}::BIGINT AS max_iterations, round(auc, 6) AS area_under_roc,
                   {P.baseline_accuracy}::DOUBLE AS baseline_accuracy, 'ok' AS status, train_rows, p + n AS test_rows FROM auc, model"""
        ),
        "drift_history": f"""
WITH history AS ({duckdb_view_sql()['metrics_history']}),
rates AS (SELECT *, CASE WHEN s2_rows > 0 THEN golden_rows * 100.0::DOUBLE / s2_rows END AS rate FROM history),
seen AS (
  SELECT pipeline, run_id, rate, count(rate) OVER w AS runs_before, avg(rate) OVER w AS mean, stddev_pop(rate) OVER w AS spread
  FROM rates WINDOW w AS (PARTITION BY pipeline ORDER BY finished_at, run_id ROWS BETWEEN {P.history_runs} PRECEDING AND 1 PRECEDING)),
bands AS (
  SELECT *, coalesce(mean, {P.historical_match_rate_pct}::DOUBLE) AS base,
         greatest(coalesce(spread * {P.history_deviations}, 0.0), {P.match_rate_deviation_pct}::DOUBLE) AS width FROM seen)
SELECT pipeline, run_id, round_even(rate, 2) AS match_rate_pct, runs_before, round(base, 6) AS baseline_pct, round(width, 6) AS deviation_pct,
       coalesce(abs(rate - base) > width, FALSE) AS drift_triggered,
       CASE WHEN coalesce(abs(rate - base) > width, FALSE) THEN 'CRITICAL' ELSE 'HEALTHY' END AS pipeline_health_status
FROM bands""",
        "health_export": _q(
            _irls()
            + f"""SELECT CASE WHEN drift THEN 'CRITICAL' ELSE 'HEALTHY' END AS pipeline_health_status,
                       n1 AS source_1_supply_chain_row_count, n2 AS source_2_financial_row_count,
                       round_even(r, 2) AS fuzzy_match_rate_pct, drift AS entity_drift_triggered,
                       round_even(auc, 4) AS model_accuracy_auc, {P.baseline_accuracy}::DOUBLE AS historical_baseline_accuracy, 'ok' AS model_status,
                       TRUE AS record_ok, TRUE AS time_ok, TRUE AS version_ok
                FROM (SELECT *, abs(r - {P.historical_match_rate_pct}) > {P.match_rate_deviation_pct} AS drift
                      FROM (SELECT n1, n2, CASE WHEN n2 > 0 THEN CAST(g AS DOUBLE) * 100.0 / n2 ELSE 0.0 END AS r
                            FROM (SELECT (SELECT count(*) FROM corp_s1) AS n1, (SELECT count(*) FROM corp_s2) AS n2,
                                         (SELECT count(*) FROM golden) AS g))), auc"""
        ),
        "revenue_auc": _q(
            """SELECT round(CASE WHEN p > 0 AND n > 0 THEN (ranks - p * (p + 1) / 2.0) / (p * n) END, 6) AS auc_rank,
                      p AS positives, n AS negatives
               FROM (SELECT sum(CASE WHEN high_profit_indicator = 1 THEN mean_rank END) AS ranks,
                            count(*) FILTER (WHERE high_profit_indicator = 1) AS p,
                            count(*) FILTER (WHERE high_profit_indicator = 0) AS n
                     FROM (SELECT high_profit_indicator, rank() OVER (ORDER BY coalesce(revenue, 0.0))
                                  + (count(*) OVER (PARTITION BY coalesce(revenue, 0.0)) - 1) / 2.0 AS mean_rank
                           FROM features))"""
        ),
        "registry_merge": _q(f"SELECT {reg_cols} FROM registry"),
        "registry_scan": _q(f"SELECT {reg_cols} FROM registry"),
        "registry_count": _q("SELECT count(*) AS row_count FROM registry"),
        "registry_distinct_ids": _q("SELECT count(DISTINCT corporate_id) AS distinct_ids FROM registry"),
        "registry_preview": _q(f"SELECT {reg_cols} FROM registry ORDER BY corporate_id LIMIT 20"),
        "distinct_corporate_ids": _q(
            "SELECT DISTINCT corporate_id FROM (SELECT md5(norm_name_s1) AS corporate_id FROM s1 "
            "UNION ALL SELECT md5(norm_name_s2) FROM s2)"
        ),
        "reconcile_delivery": _q(
            f"""SELECT r.n AS registry_distinct_ids, b.n AS batch_rows,
                       CASE WHEN b.n > 0 THEN round_even(CAST(r.n AS DOUBLE) * 100.0 / b.n, 2) END AS delivery_index_pct,
                       CASE WHEN b.n > 0 THEN CAST(r.n AS DOUBLE) * 100.0 / b.n >= {P.delivery_target_pct} END AS meets_target,
                       CASE WHEN b.n > 0 THEN round_even(CAST(c.n AS DOUBLE) * 100.0 / b.n, 2) END AS batch_coverage_pct
                FROM (SELECT count(DISTINCT corporate_id) AS n FROM registry) r,
                     (SELECT count(*) AS n FROM tagged) b,
                     (SELECT count(*) AS n FROM tagged WHERE corporate_id IN (SELECT corporate_id FROM registry)) c"""
        ),
        "profit_features": _q(
            f"""SELECT {reg_cols.replace('revenue', 'coalesce(revenue, 0.0) AS revenue')}, high_profit_indicator,
                       supplier_count0 AS supplier_count FROM features"""
        ),
        "profit_vectors": _q(
            """SELECT corporate_id, high_profit_indicator,
                      [coalesce(revenue, 0.0), CAST(supplier_count0 AS DOUBLE)]::DOUBLE[] AS features
               FROM features"""
        ),
        # an empty field of a CSV file is read as NULL
        "read_source": _q(
            "SELECT nullif(corporate_name_S1, '') AS corporate_name_S1, address, activity_places, nullif(top_suppliers, '') AS top_suppliers, "
            "NULL::VARCHAR AS corporate_name_S2, NULL::VARCHAR AS main_customers, NULL::DOUBLE AS revenue, NULL::DOUBLE AS profit FROM corp_s1 "
            "UNION ALL SELECT NULL, NULL, NULL, NULL, nullif(corporate_name_S2, ''), main_customers, revenue, profit FROM corp_s2"
        ),
        "route_sources": _q(
            "SELECT 'supply_chain' AS source, count(*) AS row_count FROM corp_s1 "
            "UNION ALL SELECT 'financial', count(*) FROM corp_s2"
        ),
        "train_test_split": _q(
            f"""SELECT corporate_id,
                       CASE WHEN ('0x' || substr(md5(corporate_id), 1, 13))::BIGINT < {P.train_fraction * 16.0**13}
                            THEN 'train' ELSE 'test' END AS split
                FROM tagged"""
        ),
    }
