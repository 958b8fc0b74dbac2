"""Company sources derived from the shared test tables.

The two sources and the headline feed are defined once as SQL text. The
same text runs on Spark (tables bound as DataFrame arguments of
``spark.sql``) and on DuckDB (tables bound by name), so the oracle checks
start from identical inputs. All views scan whole tables.

Every part and every customer is a company of Source 1, every part with line
items and every customer one of Source 2. Parts give few names with many rows
each; customers give as many names as rows, which share their words and differ
in ten hexadecimal digits. Some customers have a null, empty or blank name, so
that the name contracts fail on the sources as they are (:func:`with_names`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpreg.functions.names import blank
from corpreg.params import S1_NAME, S2_NAME
from corpreg.session import shuffled

# Source 1, supply chain: one row per part. Parts that begin with "hot" are
# renamed, so that Source 1 has companies that Source 2 lacks.
CORP_S1_SQL = """
SELECT CASE WHEN p_partkey % 10 = 0 THEN name || '_' || CAST(p_partkey AS VARCHAR(20))
            ELSE name || CASE p_partkey % 7 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Corp.'
                 WHEN 3 THEN ' Incorporated' WHEN 4 THEN ' Group' WHEN 5 THEN ' Co.' ELSE ', Ltd.' END
       END AS corporate_name_S1,
       CASE WHEN p_partkey % 5 = 1 THEN NULL
            ELSE CAST(100 + p_partkey % 900 AS VARCHAR(20)) || ' Main St, ' || p_brand END AS address,
       p_type || '; ' || p_brand AS activity_places,
       CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Alpha Parts' WHEN 2 THEN 'Alpha Parts,Beta Log'
            ELSE 'Alpha Parts,Beta Log,Gamma Mfg' END AS top_suppliers
FROM (SELECT *, CASE WHEN p_name LIKE 'hot %' THEN 'supply of ' || p_name ELSE p_name END AS name FROM {part}) p
UNION ALL
SELECT CASE c_custkey % 50 WHEN 7 THEN NULL WHEN 17 THEN '' WHEN 27 THEN '   '
            ELSE CASE WHEN c_custkey % 4 = 3 THEN 'western ' ELSE '' END || 'global logistics '
                 || substr(md5(CAST(c_custkey AS VARCHAR(20))), 1, 10)
                 || CASE c_custkey % 7 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Corp.'
                    WHEN 3 THEN ' Incorporated' WHEN 4 THEN ' Group' WHEN 5 THEN ' Co.' ELSE ', Ltd.' END
       END AS corporate_name_S1,
       CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_mktsegment || ' Plaza ' || CAST(c_nationkey AS VARCHAR(20)) END AS address,
       'Nation ' || CAST(c_nationkey AS VARCHAR(20)) AS activity_places,
       CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Alpha Parts,Gamma Mfg' END AS top_suppliers
FROM {customer}
"""

# Source 2, financial: revenue and profit summed from lineitem per part. Parts
# that begin with "small" and every third part are renamed, so that Source 2 has
# companies that Source 1 lacks.
CORP_S2_SQL = """
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'holding of ' || p_name WHEN p_name LIKE 'small %' THEN 'finance of ' || p_name ELSE p_name END || CASE (p_partkey + 3) % 7 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Corp.'
            WHEN 3 THEN ' Incorporated' WHEN 4 THEN ' Group' WHEN 5 THEN ' Co.' ELSE ', Ltd.' END AS corporate_name_S2,
       CASE p_size % 3 WHEN 0 THEN 'Apple;Ford' WHEN 1 THEN 'Amazon' ELSE NULL END AS main_customers,
       r.revenue, r.profit
FROM {part} JOIN (SELECT l_partkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
                       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS profit
                FROM {lineitem} GROUP BY l_partkey) r ON p_partkey = l_partkey
UNION ALL
SELECT CASE c_custkey % 50 WHEN 8 THEN NULL WHEN 18 THEN '' WHEN 28 THEN '   '
            ELSE CASE WHEN c_custkey % 5 = 4 THEN 'eastern ' ELSE '' END || 'global logistics '
                 || CASE c_custkey % 3 WHEN 0 THEN substr(md5(CAST(c_custkey AS VARCHAR(20))), 1, 10)
                    WHEN 1 THEN substr(md5(CAST(c_custkey AS VARCHAR(20))), 1, 9)
                    ELSE substr(md5(CAST(c_custkey AS VARCHAR(20))), 2, 9) || 'zz' END
                 || CASE (c_custkey + 3) % 7 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Corp.'
                    WHEN 3 THEN ' Incorporated' WHEN 4 THEN ' Group' WHEN 5 THEN ' Co.' ELSE ', Ltd.' END
       END AS corporate_name_S2,
       CASE c_custkey % 3 WHEN 0 THEN 'Apple;Ford' WHEN 1 THEN NULL ELSE 'Amazon' END AS main_customers,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal * 128 END AS revenue,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal * 16 END AS profit
FROM {customer}
"""

# The financial delivery before that one: some companies have since left Source
# 2 (their names are not in it), the others had half the revenue and profit.
CORP_S2_EARLIER_SQL = """
SELECT CASE WHEN corporate_name_S2 LIKE 'holding of %' OR corporate_name_S2 LIKE 'eastern %' THEN 'former ' || corporate_name_S2
            ELSE corporate_name_S2 END AS corporate_name_S2,
       main_customers, revenue / 2 AS revenue, profit / 2 AS profit
FROM {corp_s2}
"""

# Headline feed used with the derived sources. Five headlines
# whose words overlap the first words of the part names.
FEED_SQL = """
SELECT * FROM (VALUES (1, 'Red tape fines suspected'), (2, 'Blue chip shares rise'),
  (3, 'Old mill fraud inquiry opened'), (4, 'Data breach at cold store'), (5, 'Second RED fraud case')) AS f(position, headline)
"""

# A feed that grows with the data: every document with a text is a headline.
# Its words are invented, so the query on it looks for common ones.
DOCUMENT_FEED_SQL = "SELECT doc_id AS position, text AS headline FROM {documents} WHERE text IS NOT NULL"
DOCUMENT_KEYWORDS = ("the", "with")


# A history of match rates: every order priority is a pipeline, every month one of
# its runs. Julys delivered nothing, and there was no run in any March.
METRICS_HISTORY_SQL = """
SELECT o_orderpriority AS pipeline, CAST(month AS VARCHAR(20)) AS run_id, MAX(CAST(o_orderdate AS TIMESTAMP)) AS finished_at,
       CAST(SUM(CASE WHEN o_totalprice > 150000 AND month % 100 <> 7 THEN 1 ELSE 0 END) AS BIGINT) AS golden_rows,
       CAST(SUM(CASE WHEN month % 100 <> 7 THEN 1 ELSE 0 END) AS BIGINT) AS s2_rows
FROM (SELECT *, EXTRACT(YEAR FROM o_orderdate) * 100 + EXTRACT(MONTH FROM o_orderdate) AS month FROM {orders}) o
WHERE month % 100 <> 3
GROUP BY o_orderpriority, month
"""


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supply_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        CORP_S1_SQL, part=load_table(spark, sf_dir, "part"), customer=load_table(spark, sf_dir, "customer")
    )


def financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: load_table(spark, sf_dir, t) for t in ("part", "lineitem", "customer")}
    tables["part"] = shuffled(tables["part"])  # joined with as many sums of line items
    return spark.sql(CORP_S2_SQL, **tables)


def earlier_financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CORP_S2_EARLIER_SQL, corp_s2=financial(spark, sf_dir))


def with_names(source: DataFrame) -> DataFrame:
    """The rows of either source that pass the name contract."""
    name = S1_NAME if S1_NAME in source.columns else S2_NAME
    return source.where(~blank(name))


def headline_feed(spark: SparkSession) -> DataFrame:
    return spark.sql(FEED_SQL)


def document_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOCUMENT_FEED_SQL, documents=load_table(spark, sf_dir, "documents"))


def metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(METRICS_HISTORY_SQL, orders=load_table(spark, sf_dir, "orders"))


def duckdb_view_sql() -> dict[str, str]:
    """The same views with plain table names, for a DuckDB ``WITH``."""
    views = {
        "corp_s1": CORP_S1_SQL,
        "corp_s2": CORP_S2_SQL,
        "corp_s2_earlier": CORP_S2_EARLIER_SQL,
        "feed": FEED_SQL,
        "document_feed": DOCUMENT_FEED_SQL,
        "metrics_history": METRICS_HISTORY_SQL,
    }
    names = {t: t for t in ("part", "lineitem", "customer", "documents", "orders", "corp_s2")}
    return {view: sql.format(**names).strip() for view, sql in views.items()}
