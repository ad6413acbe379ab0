"""

Each query runs an objectlake operator over the driver tables mapped to
CRM-style objects (see ``objectlake/sampledata.py``) and reads whole tables.
Doubles that come out of sums or averages are rounded in both the Spark query
and the SQL so the order of summation does not matter.

Query names start with the SURVEY §2 item they exercise (``s`` scans and
sources, ``p`` projections, ``f`` filters, ``j`` joins, ``a`` aggregates,
``o`` ordering, ``c`` date functions, ``d`` decode/encode, ``w`` writes,
``t`` change streams); ``r`` names are multi-object reports.
``docs/COVERAGE.md`` maps every item to its queries and tests.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

# the package lives next to this file; make it importable however the file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake import ObjectQuery, fld
from objectlake.functions import (avg_, calendar_month, calendar_quarter, calendar_year,
                                  convert_timezone, count_, count_distinct_, day_in_month,
                                  day_in_week, day_in_year, day_only, fiscal_month, fiscal_quarter,
                                  fiscal_year, grouping_, hour_in_day, max_, min_, sum_,
                                  week_in_month, week_in_year)
from objectlake.sampledata import sample_catalog, table_path
from objectlake.session import tune

SMOKE_DIR = "/root/testdata/sf0.001"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)   # UTC session zone and AQE, whatever session runs it
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def _cat(spark, sf_dir):
    return sample_catalog(spark, sf_dir)


def _round(df: DataFrame, *cols, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# Opportunity as the oracle sees it (deleted = status F; Priority null when
# not specified).
OPP = """(SELECT o_orderkey AS Id, o_custkey AS AccountId, o_orderstatus AS StageName,
  o_totalprice AS Amount, CAST(o_orderdate AS DATE) AS CloseDate,
  NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS Priority, o_orderdate AS LastModifiedDate,
  (o_orderstatus = 'F') AS IsDeleted FROM orders)"""
OPP_LIVE = f"(SELECT * FROM {OPP} WHERE NOT IsDeleted)"


# ------------------------------------------------------------------ flagship
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per account segment: count and total amount of opportunities (deleted
    ones included) modified in [1996-01-01, 1997-01-01)."""
    cat = _cat(spark, sf_dir)
    q = (ObjectQuery(cat, "Opportunity").include_deleted(True)
         .modified(since="1996-01-01", until="1997-01-01")
         .select(fld("Account.Segment").alias("segment"), count_().alias("n"), sum_("Amount").alias("amount"))
         .group_by("Account.Segment"))
    return _round(q.to_df(), "amount")


register("flagship_segment_amounts", """
SELECT c.c_mktsegment AS segment, COUNT(*) AS n, ROUND(SUM(o.o_totalprice), 2) AS amount
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1997-01-01'
GROUP BY c.c_mktsegment""")(flagship)


def entry(spark: SparkSession) -> DataFrame:
    return flagship(spark, SMOKE_DIR)


# ------------------------------------------------------- report queries
@register("r01_revenue_by_brand_and_region", """
SELECT p.p_brand AS brand, r.r_name AS vendor_region, COUNT(*) AS lines,
       ROUND(SUM(l.l_extendedprice), 2) AS revenue, ROUND(AVG(l.l_discount), 6) AS avg_discount
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE year(o.o_orderdate) = 1997 AND l.l_returnflag <> 'R'
GROUP BY p.p_brand, r.r_name HAVING COUNT(*) >= 20""")
def r01_revenue_by_brand_and_region(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "LineItem")
         .select(fld("Product.Brand").alias("brand"), fld("Vendor.Territory.Region.Name").alias("vendor_region"),
                 count_().alias("lines"), sum_("Price").alias("revenue"), avg_("Discount").alias("avg_discount"))
         .where((calendar_year("Opportunity.CloseDate") == 1997) & (fld("Flag") != "R"))
         .group_by("Product.Brand", "Vendor.Territory.Region.Name")
         .having(count_() >= 20))
    return _round(_round(q.to_df(), "revenue"), "avg_discount", digits=6)


@register("r02_top_accounts_by_open_pipeline", f"""
SELECT c.c_custkey AS account, c.c_mktsegment AS segment, n.n_name AS territory, COUNT(*) AS open_opps,
       ROUND(SUM(o.Amount), 2) AS pipeline
FROM {OPP_LIVE} o LEFT JOIN customer c ON o.AccountId = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.StageName = 'O'
GROUP BY c.c_custkey, c.c_mktsegment, n.n_name
ORDER BY pipeline DESC, account LIMIT 10""")
def r02_top_accounts_by_open_pipeline(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
         .select(fld("Account.Id").alias("account"), fld("Account.Segment").alias("segment"),
                 fld("Account.Territory.Name").alias("territory"), count_().alias("open_opps"),
                 sum_("Amount").alias("pipeline"))
         .where(fld("StageName") == "O")
         .group_by("Account.Id", "Account.Segment", "Account.Territory.Name")
         .order_by(sum_("Amount").desc(), "Account.Id").limit(10))
    return _round(q.to_df(), "pipeline")


# ------------------------------------------------------------- scans S-01..S-13
@register("s01_object_scan_interval", f"""
SELECT * FROM {OPP_LIVE} WHERE LastModifiedDate >= TIMESTAMP '1998-01-01'
  AND LastModifiedDate < TIMESTAMP '1998-07-01'""")
def s01_object_scan_interval(spark, sf_dir):
    return _cat(spark, sf_dir).object("Opportunity", since="1998-01-01", until="1998-07-01")


@register("f10_object_scan_range", f"""
SELECT * FROM {OPP_LIVE} WHERE LastModifiedDate >= TIMESTAMP '1997-05-22'
  AND LastModifiedDate < TIMESTAMP '1997-12-01'""")
def f10_object_scan_range(spark, sf_dir):
    # end = 1998-01-01 - 1 month; start = end - 6 months - 10 days
    return _cat(spark, sf_dir).object("Opportunity", as_of="1998-01-01T00:00:00Z",
                                      duration="6 months, 10 days", offset="1 months")


@register("f10_nanos", f"""
SELECT Id FROM {OPP_LIVE} WHERE LastModifiedDate >= TIMESTAMP '1996-12-31 23:59:55'
  AND LastModifiedDate < TIMESTAMP '1998-01-01 00:00:00'""")
def f10_nanos(spark, sf_dir):
    return _cat(spark, sf_dir).object(
        "Opportunity", as_of="1998-01-01T00:00:00Z", duration="1 years, 5000000000 nanos",
        schema=T.StructType([T.StructField("Id", T.LongType())]))


@register("f10_upper_bound_only", f"""
SELECT Id, Amount FROM {OPP_LIVE} WHERE LastModifiedDate < TIMESTAMP '1995-06-01'""")
def f10_upper_bound_only(spark, sf_dir):
    return _cat(spark, sf_dir).object(
        "Opportunity", as_of="1995-06-03T00:00:00Z", offset="2 days",
        schema=T.StructType([T.StructField("Id", T.LongType()), T.StructField("Amount", T.DoubleType())]))


@register("p07_schema_projection", f"SELECT Id AS ID, Amount, Priority AS priority FROM {OPP_LIVE}")
def p07_schema_projection(spark, sf_dir):
    # fields come in object order, named as in the provided schema
    schema = T.StructType([T.StructField("priority", T.StringType()), T.StructField("Amount", T.DoubleType()),
                           T.StructField("ID", T.LongType())])
    return _cat(spark, sf_dir).object("Opportunity", schema=schema)


@register("s02_query_scan", """
SELECT c_custkey AS Id, c_name AS Name, c_acctbal AS Balance FROM customer WHERE c_acctbal > 5000""")
def s02_query_scan(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id", "Name", "Balance")
            .where(fld("Balance") > 5000).to_df())


@register("s10_query_hides_deleted", f"""
SELECT Id, StageName, IsDeleted FROM {OPP_LIVE} WHERE Amount > 400000""")
def s10_query_hides_deleted(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "StageName", "IsDeleted")
            .where(fld("Amount") > 400000).to_df())


@register("s10_query_all", f"""
SELECT Id, StageName, IsDeleted FROM {OPP} WHERE Amount > 400000""")
def s10_query_all(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select("Id", "StageName", "IsDeleted").where(fld("Amount") > 400000).to_df())


@register("s03_multi_object_union", """
SELECT * FROM (
  SELECT c_custkey AS Id, c_name AS Name, c_nationkey AS TerritoryId, c_acctbal AS Balance,
         c_mktsegment AS Segment, 'Account' AS tablename FROM customer
  UNION ALL BY NAME
  SELECT s_suppkey AS Id, s_name AS Name, s_nationkey AS TerritoryId, s_acctbal AS Balance,
         'Vendor' AS tablename FROM supplier)""")
def s03_multi_object_union(spark, sf_dir):
    return _cat(spark, sf_dir).objects(allow="Account, Vendor").union()


@register("s03_multi_object_deny", """
SELECT n_nationkey AS Id, n_name AS Name, n_regionkey AS RegionId, 'Territory' AS obj FROM nation
UNION ALL BY NAME
SELECT r_regionkey AS Id, r_name AS Name, 'Region' AS obj FROM region""")
def s03_multi_object_deny(spark, sf_dir):
    deny = ["Account", "Opportunity", "LineItem", "Product", "Vendor", "Activity"]
    return _cat(spark, sf_dir).objects(deny=deny, name_field="obj").union()


@register("s08_key_chunks", """
SELECT CAST(FLOOR((o_orderkey - (SELECT MIN(o_orderkey) FROM orders)) / 1000) AS BIGINT) AS chunk_id,
       MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi, COUNT(*) AS "rows"
FROM orders GROUP BY 1""")
def s08_key_chunks(spark, sf_dir):
    from objectlake.operators.chunking import key_chunks
    return key_chunks(_cat(spark, sf_dir).table("Opportunity"), "Id", 1000)


@register("s08_read_chunked", """
SELECT o_orderkey AS Id, o_totalprice AS Amount,
       CAST(FLOOR((o_orderkey - (SELECT MIN(o_orderkey) FROM orders)) / 2500) AS BIGINT) AS chunk_id
FROM orders""")
def s08_read_chunked(spark, sf_dir):
    from objectlake.operators.chunking import read_chunked
    q = ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True).select("Id", "Amount")
    return read_chunked(q.to_df(), "Id", 2500, query=q)


@register("s11_wide_fetch", f"""
SELECT * FROM {OPP_LIVE} WHERE Priority = '1-URGENT' AND Amount > 300000""")
def s11_wide_fetch(spark, sf_dir):
    from objectlake.operators.widefetch import wide_fetch
    q = (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id")
         .where((fld("Priority") == "1-URGENT") & (fld("Amount") > 300000)))
    return wide_fetch(q)


@register("s12_sample", """
SELECT LEAST(25, COUNT(*)) AS n, LEAST(25, COUNT(*)) AS distinct_ids, TRUE AS typed FROM customer""")
def s12_sample(spark, sf_dir):
    # a sampling operator: which 25 rows is not fixed, so check size, whole rows and types
    s = _cat(spark, sf_dir).sample("Account", 25)
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Id").alias("distinct_ids"),
                 F.lit(dict(s.dtypes)["Balance"] == "double").alias("typed"))


@register("s13_summary", """
SELECT 'Region' AS name, 'Region' AS label, TRUE AS queryable, COUNT(*) AS row_count,
       CAST(NULL AS TIMESTAMP) AS last_modified FROM region
UNION ALL SELECT 'Territory', 'Territory', TRUE, COUNT(*), CAST(NULL AS TIMESTAMP) FROM nation
UNION ALL SELECT 'Account', 'Account', TRUE, COUNT(*), CAST(NULL AS TIMESTAMP) FROM customer
UNION ALL SELECT 'Opportunity', 'Opportunity', TRUE, COUNT(*), MAX(o_orderdate) FROM orders
UNION ALL SELECT 'LineItem', 'LineItem', TRUE, COUNT(*), MAX(l_shipdate) FROM lineitem
UNION ALL SELECT 'Product', 'Product', TRUE, COUNT(*), CAST(NULL AS TIMESTAMP) FROM part
UNION ALL SELECT 'Vendor', 'Vendor', TRUE, COUNT(*), CAST(NULL AS TIMESTAMP) FROM supplier
UNION ALL SELECT 'Activity', 'Activity', TRUE, COUNT(*), MAX(ts) FROM events""")
def s13_summary(spark, sf_dir):
    return _cat(spark, sf_dir).summary()


# ------------------------------------------------------- projections / paths
@register("j01_three_hop_paths", f"""
SELECT o.Id, c.c_name AS Account_Name, n.n_name AS Account_Territory_Name,
       r.r_name AS Account_Territory_Region_Name
FROM {OPP_LIVE} o LEFT JOIN customer c ON o.AccountId = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE o.Amount > 450000""")
def j01_three_hop_paths(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
            .select("Id", "Account.Name", "Account.Territory.Name", "Opportunity.Account.Territory.Region.Name")
            .where(fld("Amount") > 450000).to_df())


@register("j01_region_counts", f"""
SELECT r.r_name AS region, COUNT(*) AS n
FROM {OPP_LIVE} o LEFT JOIN customer c ON o.AccountId = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name""")
def j01_region_counts(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
            .select(fld("Account.Territory.Region.Name").alias("region"), count_().alias("n"))
            .group_by("account.territory.region.name").to_df())


@register("j01_null_parents", f"""
SELECT k.c_mktsegment AS key_segment, COUNT(*) AS n, COUNT(k.c_name) AS with_key_account,
       ROUND(SUM(o.Amount), 2) AS amount
FROM {OPP_LIVE} o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) k ON o.AccountId = k.c_custkey
GROUP BY k.c_mktsegment""")
def j01_null_parents(spark, sf_dir):
    """A reference to a filtered parent object: opportunities of other
    accounts get null parent fields (left join), they are not dropped."""
    cat = _cat(spark, sf_dir)
    cust = spark.read.parquet(table_path(sf_dir, "customer"))
    cat.register("KeyAccount", cust.filter(F.col("c_acctbal") > 5000),
                 {"Id": "c_custkey", "Name": "c_name", "Segment": "c_mktsegment"})
    cat.add_reference("Opportunity", "KeyAccount", "AccountId", "KeyAccount")
    q = (ObjectQuery(cat, "Opportunity")
         .select(fld("KeyAccount.Segment").alias("key_segment"), count_().alias("n"),
                 count_("KeyAccount.Name").alias("with_key_account"), sum_("Amount").alias("amount"))
         .group_by("KeyAccount.Segment"))
    return _round(q.to_df(), "amount")


@register("p09_case_insensitive_fields", """
SELECT c_custkey AS Id, c_mktsegment AS Segment, n_name AS Territory_Name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0""")
def p09_case_insensitive_fields(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "account").select("ID", "segment", "territory.NAME")
            .where(fld("BALANCE") < 0).to_df().toDF("Id", "Segment", "Territory_Name"))


@register("p06_normalize_names", """
SELECT page_id, regexp_replace(CASE WHEN regexp_matches(url, '^[A-Za-z_]') THEN url ELSE 'A' || url END,
                               '[^A-Za-z0-9_]', '_', 'g') AS url_name FROM pages""")
def p06_normalize_names(spark, sf_dir):
    """The output-name rule applied to values held in data (whole URLs)."""
    from objectlake.naming import normalize_name_col
    pages = spark.read.parquet(table_path(sf_dir, "pages"))
    return pages.select("page_id", normalize_name_col(F.col("url")).alias("url_name"))


# ---------------------------------------------------------------- predicates
@register("f01_comparisons", """
SELECT c_custkey AS Id, c_acctbal AS Balance FROM customer
WHERE c_acctbal >= 9000 AND c_mktsegment != 'BUILDING' AND c_custkey <> 7 AND c_nationkey < 20
  AND c_nationkey <= 18 AND c_nationkey > 1""")
def f01_comparisons(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id", "Balance")
            .where((fld("Balance") >= 9000) & (fld("Segment") != "BUILDING") & (fld("Id") != 7)
                   & (fld("TerritoryId") < 20) & (fld("TerritoryId") <= 18) & (fld("TerritoryId") > 1))
            .to_df())


@register("f02_like", """
SELECT p_partkey AS Id, p_name AS Name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '_ld b%'""")
def f02_like(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Product").select("Id", "Name")
            .where(fld("Name").like("red%") | fld("Name").like("_ld b%")).to_df())


@register("f02_like_case_insensitive", """
SELECT p_partkey AS Id FROM part WHERE p_name ILIKE 'RED%'""")
def f02_like_case_insensitive(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Product").select("Id")
            .where(fld("Name").like("RED%", ci=True)).to_df())


@register("f03_in_lists", f"""
SELECT Id, Priority FROM {OPP_LIVE}
WHERE Priority IN ('1-URGENT', '2-HIGH') AND StageName NOT IN ('P')""")
def f03_in_lists(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "Priority")
            .where(fld("Priority").isin(["1-URGENT", "2-HIGH"]) & fld("StageName").notin(["P"])).to_df())


@register("f04_null_tests", f"""
SELECT Id, Priority IS NULL AS unspecified FROM {OPP_LIVE}
WHERE (Priority IS NULL AND Amount > 300000) OR (Priority IS NOT NULL AND Amount > 480000)""")
def f04_null_tests(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
            .select("Id", (fld("Priority") == None).alias("unspecified"))  # noqa: E711
            .where(((fld("Priority") == None) & (fld("Amount") > 300000))  # noqa: E711
                   | ((fld("Priority") != None) & (fld("Amount") > 480000)))  # noqa: E711
            .to_df())


TAGS = "string_split(replace(p_name, ' ', ';'), ';')"


@register("f05_includes", f"""
SELECT p_partkey AS Id, replace(p_name, ' ', ';') AS Tags FROM part
WHERE list_has_all({TAGS}, ['red', 'bolt']) OR list_has_all({TAGS}, ['hot'])""")
def f05_includes(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Product").select("Id", "Tags")
            .where(fld("Tags").includes(["red;bolt", "hot"])).to_df())


@register("f06_excludes", f"""
SELECT p_partkey AS Id FROM part
WHERE NOT (list_has_all({TAGS}, ['small']) OR list_has_all({TAGS}, ['blue', 'gear']))""")
def f06_excludes(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Product").select("Id")
            .where(fld("Tags").excludes(["small", "blue;gear"])).to_df())


@register("f07_boolean_logic", """
SELECT c_custkey AS Id FROM customer
WHERE (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY') AND NOT (c_acctbal < 0)
  AND (c_nationkey = 3 OR (c_nationkey = 4 AND c_acctbal > 5000))""")
def f07_boolean_logic(spark, sf_dir):
    seg = (fld("Segment") == "BUILDING") | (fld("Segment") == "MACHINERY")
    nat = (fld("TerritoryId") == 3) | ((fld("TerritoryId") == 4) & (fld("Balance") > 5000))
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
            .where(seg & ~(fld("Balance") < 0) & nat).to_df())


@register("f12_date_literals", f"""
SELECT Id, CloseDate FROM {OPP_LIVE}
WHERE CloseDate >= DATE '1997-03-01' AND LastModifiedDate < TIMESTAMP '1997-03-15 12:00:00'""")
def f12_date_literals(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "CloseDate")
            .where((fld("CloseDate") >= dt.date(1997, 3, 1))
                   & (fld("LastModifiedDate") < dt.datetime(1997, 3, 15, 12, 0))).to_df())


# F-13: as_of 1998-05-20 (a Wednesday), weeks start on Sunday, fiscal year in April.
_REL = [
    ("YESTERDAY", "=", "CloseDate = DATE '1998-05-19'"),
    ("TODAY", "=", "CloseDate = DATE '1998-05-20'"),
    ("TOMORROW", "=", "CloseDate = DATE '1998-05-21'"),
    ("LAST_WEEK", "=", "CloseDate >= DATE '1998-05-10' AND CloseDate < DATE '1998-05-17'"),
    ("THIS_WEEK", "=", "CloseDate >= DATE '1998-05-17' AND CloseDate < DATE '1998-05-24'"),
    ("NEXT_WEEK", "=", "CloseDate >= DATE '1998-05-24' AND CloseDate < DATE '1998-05-31'"),
    ("LAST_MONTH", "=", "CloseDate >= DATE '1998-04-01' AND CloseDate < DATE '1998-05-01'"),
    ("THIS_MONTH", "=", "CloseDate >= DATE '1998-05-01' AND CloseDate < DATE '1998-06-01'"),
    ("NEXT_MONTH", "=", "CloseDate >= DATE '1998-06-01' AND CloseDate < DATE '1998-07-01'"),
    ("LAST_90_DAYS", "=", "CloseDate >= DATE '1998-02-19' AND CloseDate < DATE '1998-05-21'"),
    ("NEXT_90_DAYS", "=", "CloseDate >= DATE '1998-05-21' AND CloseDate < DATE '1998-08-19'"),
    ("THIS_QUARTER", "=", "CloseDate >= DATE '1998-04-01' AND CloseDate < DATE '1998-07-01'"),
    ("LAST_QUARTER", "=", "CloseDate >= DATE '1998-01-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_QUARTER", "=", "CloseDate >= DATE '1998-07-01' AND CloseDate < DATE '1998-10-01'"),
    ("THIS_YEAR", "=", "CloseDate >= DATE '1998-01-01' AND CloseDate < DATE '1999-01-01'"),
    ("LAST_YEAR", "=", "CloseDate >= DATE '1997-01-01' AND CloseDate < DATE '1998-01-01'"),
    ("NEXT_YEAR", "=", "CloseDate >= DATE '1999-01-01' AND CloseDate < DATE '2000-01-01'"),
    ("THIS_FISCAL_QUARTER", "=", "CloseDate >= DATE '1998-04-01' AND CloseDate < DATE '1998-07-01'"),
    ("LAST_FISCAL_QUARTER", "=", "CloseDate >= DATE '1998-01-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_FISCAL_QUARTER", "=", "CloseDate >= DATE '1998-07-01' AND CloseDate < DATE '1998-10-01'"),
    ("THIS_FISCAL_YEAR", "=", "CloseDate >= DATE '1998-04-01' AND CloseDate < DATE '1999-04-01'"),
    ("LAST_FISCAL_YEAR", "=", "CloseDate >= DATE '1997-04-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_FISCAL_YEAR", "=", "CloseDate >= DATE '1999-04-01' AND CloseDate < DATE '2000-04-01'"),
    ("LAST_N_DAYS:30", "=", "CloseDate >= DATE '1998-04-20' AND CloseDate < DATE '1998-05-21'"),
    ("NEXT_N_DAYS:10", "=", "CloseDate >= DATE '1998-05-21' AND CloseDate < DATE '1998-05-31'"),
    ("LAST_N_WEEKS:2", "=", "CloseDate >= DATE '1998-05-03' AND CloseDate < DATE '1998-05-17'"),
    ("NEXT_N_WEEKS:3", "=", "CloseDate >= DATE '1998-05-24' AND CloseDate < DATE '1998-06-14'"),
    ("LAST_N_MONTHS:3", "=", "CloseDate >= DATE '1998-02-01' AND CloseDate < DATE '1998-05-01'"),
    ("NEXT_N_MONTHS:2", "=", "CloseDate >= DATE '1998-06-01' AND CloseDate < DATE '1998-08-01'"),
    ("LAST_N_QUARTERS:2", "=", "CloseDate >= DATE '1997-10-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_N_QUARTERS:2", "=", "CloseDate >= DATE '1998-07-01' AND CloseDate < DATE '1999-01-01'"),
    ("LAST_N_YEARS:2", "=", "CloseDate >= DATE '1996-01-01' AND CloseDate < DATE '1998-01-01'"),
    ("NEXT_N_YEARS:1", "=", "CloseDate >= DATE '1999-01-01' AND CloseDate < DATE '2000-01-01'"),
    ("LAST_N_FISCAL_QUARTERS:2", "=", "CloseDate >= DATE '1997-10-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_N_FISCAL_QUARTERS:1", "=", "CloseDate >= DATE '1998-07-01' AND CloseDate < DATE '1998-10-01'"),
    ("LAST_N_FISCAL_YEARS:1", "=", "CloseDate >= DATE '1997-04-01' AND CloseDate < DATE '1998-04-01'"),
    ("NEXT_N_FISCAL_YEARS:2", "=", "CloseDate >= DATE '1999-04-01' AND CloseDate < DATE '2001-04-01'"),
    ("LAST_YEAR", ">", "CloseDate >= DATE '1998-01-01'"),
    ("THIS_YEAR", "<", "CloseDate < DATE '1998-01-01'"),
    ("THIS_MONTH", "<=", "CloseDate < DATE '1998-06-01'"),
    ("THIS_MONTH", ">=", "CloseDate >= DATE '1998-05-01'"),
    ("THIS_QUARTER", "!=", "(CloseDate < DATE '1998-04-01' OR CloseDate >= DATE '1998-07-01')"),
]


def _rel_counts(spark, sf_dir):
    """Rows inside each relative range: one scan, one flag per literal."""
    cat = _cat(spark, sf_dir)
    flags = [fld("CloseDate").within(lit_, as_of="1998-05-20", op=op, week_start=1, fy_start=4).alias(f"f{i}")
             for i, (lit_, op, _) in enumerate(_REL)]
    rows = ObjectQuery(cat, "Opportunity").select("Id", *flags).to_df()
    counts = rows.agg(*[F.count_if(F.col(f"f{i}")).alias(f"f{i}") for i in range(len(_REL))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f"{op} {lit_}").alias("literal"), F.col(f"f{i}").alias("n"))
        for i, (lit_, op, _) in enumerate(_REL)])))


register("f13_relative_dates", "\nUNION ALL\n".join(
    f"SELECT '{op} {lit_}' AS literal, COUNT(*) AS n FROM {OPP_LIVE} WHERE {cond}"
    for lit_, op, cond in _REL))(_rel_counts)


@register("f13_relative_dates_in_zone", """
SELECT 'TODAY' AS literal, COUNT(*) AS n FROM events
WHERE CAST(timezone('Asia/Tokyo', timezone('UTC', ts)) AS DATE) = DATE '2024-01-15'
UNION ALL
SELECT 'LAST_N_DAYS:3', COUNT(*) FROM events
WHERE CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE) BETWEEN DATE '2024-01-12' AND DATE '2024-01-15'
UNION ALL
SELECT 'THIS_WEEK', COUNT(*) FROM events
WHERE CAST(timezone('Europe/Berlin', timezone('UTC', ts)) AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-20'""")
def f13_relative_dates_in_zone(spark, sf_dir):
    """Relative dates on a datetime field, counted in a local calendar."""
    cat = _cat(spark, sf_dir)
    cases = [("TODAY", "Asia/Tokyo"), ("LAST_N_DAYS:3", "America/Los_Angeles"), ("THIS_WEEK", "Europe/Berlin")]
    parts = []
    for lit_, tz in cases:
        q = (ObjectQuery(cat, "Activity").select("Id")
             .where(fld("CreatedDate").within(lit_, as_of="2024-01-15", tz=tz)))
        parts.append(q.to_df().agg(F.count(F.lit(1)).alias("n")).select(F.lit(lit_).alias("literal"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("f16_parent_field_filter", f"""
SELECT o.Id, o.Amount FROM {OPP_LIVE} o JOIN customer c ON o.AccountId = c.c_custkey
WHERE c.c_mktsegment = 'AUTOMOBILE' AND o.Amount > 250000""")
def f16_parent_field_filter(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "Amount")
            .where((fld("Account.Segment") == "AUTOMOBILE") & (fld("Amount") > 250000)).to_df())


@register("f17_using_scope", f"""
SELECT Id, Amount FROM {OPP_LIVE} WHERE Amount > 400000 AND Priority = '1-URGENT'""")
def f17_using_scope(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    cat.register_scope("Opportunity", "big", fld("Amount") > 400000)
    return (ObjectQuery(cat, "Opportunity").select("Id", "Amount").scope("big")
            .where(fld("Priority") == "1-URGENT").to_df())


def _geo_catalog(spark, sf_dir):
    """Category tree derived from the tables: NATION_i → region → WORLD."""
    cat = _cat(spark, sf_dir)
    nation = spark.read.parquet(table_path(sf_dir, "nation"))
    region = spark.read.parquet(table_path(sf_dir, "region"))
    edges = (nation.join(region, nation.n_regionkey == region.r_regionkey)
             .select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
             .unionByName(region.select(F.col("r_name").alias("child"), F.lit("WORLD").alias("parent"))))
    cat.register_category_group("Geography", edges, "Territory.Name", ["Account"])
    return cat


@register("f18_category_below", """
SELECT c_custkey AS Id FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'ASIA')""")
def f18_category_below(spark, sf_dir):
    return (ObjectQuery(_geo_catalog(spark, sf_dir), "Account").select("Id")
            .with_category("Geography", "BELOW", ["EUROPE", "ASIA"]).to_df())


@register("f18_category_above_and_at", """
SELECT c_custkey AS Id FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = 'NATION_3' AND n_name IN ('NATION_3', 'NATION_4')""")
def f18_category_above_and_at(spark, sf_dir):
    return (ObjectQuery(_geo_catalog(spark, sf_dir), "Account").select("Id")
            .with_category("Geography", "ABOVE", ["NATION_3"])
            .with_category("Geography", "AT", ["NATION_3", "NATION_4"]).to_df())


def _region_catalog(spark, sf_dir):
    """Accounts assigned to inner nodes: segment -> region-sized group -> root."""
    cat = _cat(spark, sf_dir)
    customer = spark.read.parquet(table_path(sf_dir, "customer"))
    edges = (customer.select(F.concat(F.col("c_mktsegment"), F.lit("/"), (F.col("c_custkey") % 40).cast("string")).alias("child"),
                             F.col("c_mktsegment").alias("parent")).distinct()
             .unionByName(customer.select(F.col("c_mktsegment").alias("child"), F.lit("ALL").alias("parent")).distinct()))
    cat.register_category_group("Segments", edges, "Segment", ["Account"])
    return cat


@register("f18_category_above_inner", """
SELECT c_custkey AS Id FROM customer WHERE c_mktsegment = 'BUILDING'""")
def f18_category_above_inner(spark, sf_dir):
    return (ObjectQuery(_region_catalog(spark, sf_dir), "Account").select("Id")
            .with_category("Segments", "ABOVE", ["BUILDING/1", "BUILDING/7"]).to_df())


@register("f18_category_above_or_below", """
SELECT c_custkey AS Id FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def f18_category_above_or_below(spark, sf_dir):
    return (ObjectQuery(_region_catalog(spark, sf_dir), "Account").select("Id")
            .with_category("Segments", "ABOVE_OR_BELOW", ["BUILDING/1", "MACHINERY"]).to_df())


@register("f12_text_with_offset", f"""
SELECT Id FROM {OPP_LIVE} WHERE LastModifiedDate >= TIMESTAMP '1996-12-31 15:00:00'
  AND LastModifiedDate < TIMESTAMP '1997-06-01 04:00:00'""")
def f12_text_with_offset(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id")
            .where((fld("LastModifiedDate") >= "1997-01-01T00:00:00+09:00")
                   & (fld("LastModifiedDate") < "1997-06-01T00:00:00-04:00")).to_df())


@register("f19_with_filter", """
SELECT c_custkey AS Id FROM customer WHERE c_mktsegment = 'HOUSEHOLD' AND c_acctbal BETWEEN 100 AND 200""")
def f19_with_filter(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
            .where(fld("Segment") == "HOUSEHOLD")
            .with_filter((fld("Balance") >= 100) & (fld("Balance") <= 200)).to_df())


@register("f20_function_filter", f"""
SELECT Id FROM {OPP_LIVE} WHERE year(CloseDate) = 1997 AND month(CloseDate) = 2""")
def f20_function_filter(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id")
            .where((calendar_year("CloseDate") == 1997) & (calendar_month("CloseDate") == 2)).to_df())


# ----------------------------------------------------------------------- joins
@register("j02_children_flat", f"""
SELECT c.c_custkey AS Id, c.c_name AS Name, o.Id AS Opportunities_Id, o.Amount AS Opportunities_Amount
FROM customer c LEFT JOIN (SELECT * FROM {OPP_LIVE} WHERE Amount > 420000) o ON o.AccountId = c.c_custkey
WHERE c.c_mktsegment = 'BUILDING'""")
def j02_children_flat(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id", "Name")
            .where(fld("Segment") == "BUILDING")
            .children("Opportunities", select=["Id", "Amount"], where=fld("Amount") > 420000, flat=True)
            .to_df())


@register("j02_children_arrays", f"""
SELECT c.c_custkey AS Id, COALESCE(k.n, 0) AS n_children, COALESCE(k.total, 0) AS total
FROM customer c LEFT JOIN (SELECT AccountId, COUNT(*) AS n, ROUND(SUM(Amount), 2) AS total
  FROM {OPP_LIVE} WHERE Amount > 300000 GROUP BY AccountId) k ON k.AccountId = c.c_custkey""")
def j02_children_arrays(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .children("Opportunities", select=["Id", "Amount"], where=fld("Amount") > 300000).to_df())
    return df.select("Id", F.size("Opportunities").cast("long").alias("n_children"),
                     F.round(F.aggregate("Opportunities", F.lit(0.0), lambda a, x: a + x["Amount"]), 2)
                     .alias("total"))


@register("j02_children_pieces", f"""
WITH kids AS (
  SELECT AccountId, Id, Amount, row_number() OVER (PARTITION BY AccountId ORDER BY Amount DESC, Id) - 1 AS no
  FROM {OPP_LIVE})
SELECT c.c_custkey AS Id, COALESCE(k.no // 4, 0) AS piece, COUNT(k.Id) AS n_children,
       ROUND(COALESCE(SUM(k.Amount), 0), 2) AS total
FROM customer c LEFT JOIN kids k ON k.AccountId = c.c_custkey GROUP BY c.c_custkey, COALESCE(k.no // 4, 0)""")
def j02_children_pieces(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .children("Opportunities", select=["Id", "Amount"], order_by=[fld("Amount").desc(), fld("Id")], piece_rows=4).to_df())
    return df.select("Id", F.col("Opportunities_piece").alias("piece"), F.size("Opportunities").cast("long").alias("n_children"),
                     F.round(F.aggregate("Opportunities", F.lit(0.0), lambda a, x: a + x["Amount"]), 2).alias("total"))


@register("j02_children_pieces_unordered", f"""
WITH kids AS (SELECT AccountId, COUNT(*) AS n, ROUND(SUM(Amount), 2) AS total FROM {OPP_LIVE} GROUP BY AccountId)
SELECT c.c_custkey AS Id, CAST(greatest(1, ceil(COALESCE(k.n, 0) / 4.0)) AS BIGINT) AS pieces,
       CAST(least(4, COALESCE(k.n, 0)) AS BIGINT) AS largest, CAST(COALESCE(k.n, 0) AS BIGINT) AS n_children,
       COALESCE(k.total, 0) AS total
FROM customer c LEFT JOIN kids k ON k.AccountId = c.c_custkey""")
def j02_children_pieces_unordered(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .children("Opportunities", select=["Id", "Amount"], piece_rows=4).to_df())
    n = F.size("Opportunities").cast("long")
    return df.groupBy("Id").agg(
        (F.max("Opportunities_piece") + 1).alias("pieces"), F.max(n).alias("largest"), F.sum(n).alias("n_children"),
        F.round(F.sum(F.aggregate("Opportunities", F.lit(0.0), lambda a, x: a + x["Amount"])), 2).alias("total"))


@register("j03_children_top2", f"""
SELECT c.c_custkey AS Id, k.pos, k.Id AS child_id, k.Amount AS child_amount, k.Account_Name AS child_account
FROM customer c LEFT JOIN (
  SELECT o.Id, o.Amount, o.AccountId, cc.c_name AS Account_Name,
         row_number() OVER (PARTITION BY o.AccountId ORDER BY o.Amount DESC, o.Id) - 1 AS pos
  FROM {OPP_LIVE} o LEFT JOIN customer cc ON o.AccountId = cc.c_custkey WHERE o.Amount > 350000
  QUALIFY row_number() OVER (PARTITION BY o.AccountId ORDER BY o.Amount DESC, o.Id) <= 2
) k ON k.AccountId = c.c_custkey""")
def j03_children_top2(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .children("Opportunities", select=["Id", "Amount", "Account.Name"],
                    where=fld("Amount") > 350000, order_by=[fld("Amount").desc(), "Id"], limit=2)
          .to_df())
    return df.select("Id", F.posexplode_outer("Opportunities").alias("pos", "c")).select(
        "Id", F.col("pos").cast("long").alias("pos"), F.col("c.Id").alias("child_id"),
        F.col("c.Amount").alias("child_amount"), F.col("c.Account_Name").alias("child_account"))


@register("j03_children_offset", f"""
SELECT AccountId AS Id, Id AS child_id FROM {OPP_LIVE}
QUALIFY row_number() OVER (PARTITION BY AccountId ORDER BY CloseDate, Id) BETWEEN 2 AND 4""")
def j03_children_offset(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .children("Opportunities", select=["Id"], order_by=["CloseDate", "Id"], offset=1, limit=3)
          .to_df())
    return df.select("Id", F.explode("Opportunities").alias("c")).select("Id", F.col("c.Id").alias("child_id"))


@register("j03_children_of_filtered_parents", f"""
SELECT c.c_custkey AS Id, k.Id AS child_id, k.Amount AS child_amount
FROM customer c LEFT JOIN (
  SELECT Id, Amount, AccountId FROM {OPP_LIVE}
  QUALIFY row_number() OVER (PARTITION BY AccountId ORDER BY Amount DESC, Id) = 1
) k ON k.AccountId = c.c_custkey
WHERE c.c_mktsegment = 'MACHINERY' AND c.c_acctbal > 0""")
def j03_children_of_filtered_parents(spark, sf_dir):
    df = (ObjectQuery(_cat(spark, sf_dir), "Account").select("Id")
          .where((fld("Segment") == "MACHINERY") & (fld("Balance") > 0))
          .children("Opportunities", select=["Id", "Amount"], order_by=[fld("Amount").desc(), "Id"], limit=1)
          .to_df())
    return df.select("Id", F.explode_outer("Opportunities").alias("c")).select(
        "Id", F.col("c.Id").alias("child_id"), F.col("c.Amount").alias("child_amount"))


@register("j04_semi_join", f"""
SELECT c_custkey AS Id, c_name AS Name FROM customer
WHERE c_custkey IN (SELECT AccountId FROM {OPP_LIVE} WHERE Amount > 490000)""")
def j04_semi_join(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    sub = ObjectQuery(cat, "Opportunity").select("AccountId").where(fld("Amount") > 490000)
    return ObjectQuery(cat, "Account").select("Id", "Name").where(fld("Id").isin(sub)).to_df()


@register("j05_anti_join", f"""
SELECT c_custkey AS Id FROM customer
WHERE c_custkey NOT IN (SELECT AccountId FROM {OPP_LIVE} WHERE Priority = '1-URGENT' AND Amount > 150000)""")
def j05_anti_join(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    sub = (ObjectQuery(cat, "Opportunity").select("AccountId")
           .where((fld("Priority") == "1-URGENT") & (fld("Amount") > 150000)))
    return ObjectQuery(cat, "Account").select("Id").where(fld("Id").notin(sub)).to_df()


@register("j05_anti_join_with_nulls", f"""
SELECT Id FROM {OPP_LIVE}
WHERE Priority NOT IN (SELECT Priority FROM {OPP_LIVE} WHERE Amount > 495000)""")
def j05_anti_join_with_nulls(spark, sf_dir):
    # the sub-query returns a null priority, so SQL NOT IN keeps no row
    cat = _cat(spark, sf_dir)
    sub = ObjectQuery(cat, "Opportunity").select("Priority").where(fld("Amount") > 495000)
    return ObjectQuery(cat, "Opportunity").select("Id").where(fld("Priority").notin(sub)).to_df()


@register("j05_anti_join_nullable_side", f"""
SELECT Id FROM {OPP_LIVE}
WHERE Priority NOT IN (SELECT Priority FROM {OPP_LIVE} WHERE Amount > 495000 AND Priority IS NOT NULL)""")
def j05_anti_join_nullable_side(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    sub = (ObjectQuery(cat, "Opportunity").select("Priority")
           .where((fld("Amount") > 495000) & (fld("Priority") != None)))  # noqa: E711
    return ObjectQuery(cat, "Opportunity").select("Id").where(fld("Priority").notin(sub)).to_df()


_OR_SUB = f"(SELECT Priority FROM {OPP_LIVE} WHERE Amount > 495000)"


@register("j05_anti_join_under_or", f"""
SELECT Id, Priority NOT IN {_OR_SUB} OR StageName = 'P' AS kept FROM {OPP_LIVE}
WHERE Priority NOT IN {_OR_SUB} OR StageName = 'P'""")
def j05_anti_join_under_or(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    sub = ObjectQuery(cat, "Opportunity").select("Priority").where(fld("Amount") > 495000)
    df = (ObjectQuery(cat, "Opportunity").select("Id")
          .where(fld("Priority").notin(sub) | (fld("StageName") == "P")).to_df())
    return df.withColumn("kept", F.lit(True))


@register("j05_anti_join_under_or_null_safe", f"""
SELECT Id FROM {OPP_LIVE} o
WHERE NOT EXISTS (SELECT 1 FROM {_OR_SUB} s WHERE s.Priority = o.Priority) OR StageName = 'P'""")
def j05_anti_join_under_or_null_safe(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    sub = ObjectQuery(cat, "Opportunity").select("Priority").where(fld("Amount") > 495000)
    return (ObjectQuery(cat, "Opportunity").select("Id")
            .where(fld("Priority").notin(sub, null_safe=True) | (fld("StageName") == "P")).to_df())


@register("j06_aggregate_parent_field", f"""
SELECT o.StageName, COUNT(c.c_name) AS n, MAX(c.c_name) AS top_name, MIN(n.n_name) AS first_territory
FROM {OPP} o LEFT JOIN customer c ON o.AccountId = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY o.StageName""")
def j06_aggregate_parent_field(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select("StageName", count_("Account.Name").alias("n"), max_("Account.Name").alias("top_name"),
                    min_("Account.Territory.Name").alias("first_territory"))
            .group_by("StageName").to_df())


# ---------------------------------------------------------------- aggregates
@register("a01_a07_aggregates", """
SELECT l_returnflag AS Flag, l_linestatus AS Status, MIN(l_quantity) AS min_qty,
       MAX(l_extendedprice) AS max_price, ROUND(SUM(l_quantity), 2) AS sum_qty,
       ROUND(AVG(l_discount), 6) AS avg_disc, COUNT(*) AS n, COUNT(l_suppkey) AS n_vendor,
       COUNT(DISTINCT l_partkey) AS n_products, CAST(SUM(l_linenumber) AS BIGINT) AS sum_line
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a01_a07_aggregates(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "LineItem")
         .select("Flag", "Status", min_("Quantity").alias("min_qty"), max_("Price").alias("max_price"),
                 sum_("Quantity").alias("sum_qty"), avg_("Discount").alias("avg_disc"),
                 count_().alias("n"), count_("VendorId").alias("n_vendor"),
                 count_distinct_("ProductId").alias("n_products"), sum_("LineNumber").alias("sum_line"))
         .group_by("Flag", "Status"))
    return _round(_round(q.to_df(), "sum_qty"), "avg_disc", digits=6)


@register("a09_global_aggregate", f"""
SELECT COUNT(*) AS n, ROUND(SUM(Amount), 2) AS total, MIN(CloseDate) AS first_close,
       MAX(CloseDate) AS last_close, COUNT(Priority) AS with_priority FROM {OPP_LIVE}""")
def a09_global_aggregate(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
         .select(count_().alias("n"), sum_("Amount").alias("total"), min_("CloseDate").alias("first_close"),
                 max_("CloseDate").alias("last_close"), count_("Priority").alias("with_priority")))
    return _round(q.to_df(), "total")


@register("a11_group_without_aggregates", f"""
SELECT DISTINCT StageName, Priority FROM {OPP}""")
def a11_group_without_aggregates(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select("StageName", "Priority").group_by("StageName", "Priority").to_df())


@register("a12_group_by_function", """
SELECT CAST(hour(ts) AS INTEGER) AS h, COUNT(*) AS n, ROUND(SUM(value), 2) AS total
FROM events GROUP BY 1""")
def a12_group_by_function(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Activity")
         .select(hour_in_day("CreatedDate").alias("h"), count_().alias("n"), sum_("Value").alias("total"))
         .group_by(hour_in_day("CreatedDate")))
    return _round(q.to_df(), "total")


@register("a13_rollup_grouping", f"""
SELECT StageName, Priority, CAST(GROUPING(StageName) AS INTEGER) AS g_stage,
       CAST(GROUPING(Priority) AS INTEGER) AS g_priority, COUNT(*) AS n
FROM {OPP} GROUP BY ROLLUP (StageName, Priority)""")
def a13_rollup_grouping(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select("StageName", "Priority", grouping_("StageName").alias("g_stage"),
                    grouping_("Priority").alias("g_priority"), count_().alias("n"))
            .rollup("StageName", "Priority").to_df())


@register("a13_rollup_on_paths", f"""
SELECT c.c_mktsegment AS segment, o.StageName, CAST(GROUPING(c.c_mktsegment) AS INTEGER) AS g_segment,
       COUNT(*) AS n, ROUND(SUM(o.Amount), 2) AS amount
FROM {OPP} o LEFT JOIN customer c ON o.AccountId = c.c_custkey
GROUP BY ROLLUP (c.c_mktsegment, o.StageName)""")
def a13_rollup_on_paths(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
         .select(fld("Account.Segment").alias("segment"), "StageName",
                 grouping_("Account.Segment").alias("g_segment"), count_().alias("n"),
                 sum_("Amount").alias("amount"))
         .rollup("Account.Segment", "StageName"))
    return _round(q.to_df(), "amount")


@register("a14_cube", """
SELECT c_mktsegment AS Segment, r_name AS region, CAST(GROUPING(c_mktsegment) AS INTEGER) AS g_segment,
       COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS balance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY CUBE (c_mktsegment, r_name)""")
def a14_cube(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Account")
         .select("Segment", fld("Territory.Region.Name").alias("region"), grouping_("Segment").alias("g_segment"),
                 count_().alias("n"), sum_("Balance").alias("balance"))
         .cube("Segment", "Territory.Region.Name"))
    return _round(q.to_df(), "balance")


@register("a14_cube_count_distinct", f"""
SELECT StageName, Priority, COUNT(*) AS n, COUNT(DISTINCT AccountId) AS accounts, COUNT(DISTINCT CloseDate) AS days,
       ROUND(SUM(Amount), 2) AS amount
FROM {OPP} GROUP BY CUBE (StageName, Priority)""")
def a14_cube_count_distinct(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
         .select("StageName", "Priority", count_().alias("n"), count_distinct_("AccountId").alias("accounts"),
                 count_distinct_("CloseDate").alias("days"), sum_("Amount").alias("amount"))
         .cube("StageName", "Priority"))
    return _round(q.to_df(), "amount")


@register("a13_rollup_count_distinct", f"""
SELECT c.c_mktsegment AS segment, o.StageName, COUNT(DISTINCT o.AccountId) AS accounts
FROM {OPP} o LEFT JOIN customer c ON o.AccountId = c.c_custkey
GROUP BY ROLLUP (c.c_mktsegment, o.StageName)""")
def a13_rollup_count_distinct(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select(fld("Account.Segment").alias("segment"), "StageName", count_distinct_("AccountId").alias("accounts"))
            .rollup("Account.Segment", "StageName").to_df())


@register("a15_having", """
SELECT c_nationkey AS TerritoryId, COUNT(*) AS n, ROUND(AVG(c_acctbal), 4) AS avg_balance
FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 60 AND AVG(c_acctbal) > 4000""")
def a15_having(spark, sf_dir):
    q = (ObjectQuery(_cat(spark, sf_dir), "Account")
         .select("TerritoryId", count_().alias("n"), avg_("Balance").alias("avg_balance"))
         .group_by("TerritoryId").having((count_() > 60) & (avg_("Balance") > 4000)))
    return _round(q.to_df(), "avg_balance", digits=4)


# ------------------------------------------------------------ sort and limit
@register("o01_o04_order_limit_offset", f"""
SELECT Id, Priority, Amount FROM {OPP_LIVE}
ORDER BY Priority DESC NULLS LAST, Amount DESC, Id LIMIT 20 OFFSET 10""")
def o01_o04_order_limit_offset(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "Priority", "Amount")
            .order_by(fld("Priority").desc(nulls="last"), ("Amount", "desc"), "Id")
            .offset(10).limit(20).to_df())


@register("o02_nulls_first_default", f"""
SELECT Id, Priority FROM {OPP_LIVE} ORDER BY Priority ASC NULLS FIRST, Id DESC LIMIT 25""")
def o02_nulls_first_default(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "Priority")
            .order_by("Priority", ("Id", "desc", "first")).limit(25).to_df())


@register("o04_offset_without_limit", f"""
SELECT Id, Amount FROM {OPP_LIVE} ORDER BY Amount DESC, Id OFFSET 10000""")
def o04_offset_without_limit(spark, sf_dir):
    # the skipped prefix is found with the distributed row index, not one task
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "Amount")
            .order_by(("Amount", "desc"), "Id").offset(10000).to_df())


@register("o03_limit_zero", "SELECT c_custkey AS Id FROM customer LIMIT 0")
def o03_limit_zero(spark, sf_dir):
    return ObjectQuery(_cat(spark, sf_dir), "Account").select("Id").limit(0).to_df()


@register("o05_order_by_aggregate", """
SELECT c_mktsegment AS Segment, COUNT(*) AS n FROM customer
GROUP BY c_mktsegment ORDER BY COUNT(*) DESC, c_mktsegment LIMIT 3""")
def o05_order_by_aggregate(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Account").select("Segment", count_().alias("n"))
            .group_by("Segment").order_by(count_().desc(), "Segment").limit(3).to_df())


@register("o05_order_by_grouping", f"""
SELECT StageName, CAST(GROUPING(StageName) AS INTEGER) AS g, COUNT(*) AS n FROM {OPP}
GROUP BY ROLLUP (StageName) ORDER BY GROUPING(StageName) DESC, StageName LIMIT 2""")
def o05_order_by_grouping(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity").include_deleted(True)
            .select("StageName", grouping_("StageName").alias("g"), count_().alias("n"))
            .rollup("StageName").order_by(grouping_("StageName").desc(), "StageName").limit(2).to_df())


# ----------------------------------------------------------- date functions
@register("c01_c13_date_functions", f"""
SELECT Id, CAST(month(CloseDate) AS INTEGER) AS cm, CAST(quarter(CloseDate) AS INTEGER) AS cq,
  CAST(year(CloseDate) AS INTEGER) AS cy, CAST(day(CloseDate) AS INTEGER) AS dim,
  CAST(dayofweek(CloseDate) + 1 AS INTEGER) AS diw, CAST(dayofyear(CloseDate) AS INTEGER) AS diy,
  CAST(month(CloseDate - INTERVAL 3 MONTH) AS INTEGER) AS fm,
  CAST(quarter(CloseDate - INTERVAL 3 MONTH) AS INTEGER) AS fq,
  CAST(year(CloseDate - INTERVAL 3 MONTH) AS INTEGER) AS fy,
  CAST(year(CloseDate - INTERVAL 3 MONTH) + 1 AS INTEGER) AS fy_end,
  CAST(ceil(day(CloseDate) / 7) AS INTEGER) AS wim, CAST(ceil(dayofyear(CloseDate) / 7) AS INTEGER) AS wiy,
  CAST(LastModifiedDate AS DATE) AS d_only
FROM {OPP_LIVE}""")
def c01_c13_date_functions(spark, sf_dir):
    d = "CloseDate"
    return (ObjectQuery(_cat(spark, sf_dir), "Opportunity")
            .select("Id", calendar_month(d).alias("cm"), calendar_quarter(d).alias("cq"),
                    calendar_year(d).alias("cy"), day_in_month(d).alias("dim"), day_in_week(d).alias("diw"),
                    day_in_year(d).alias("diy"), fiscal_month(d, 4).alias("fm"),
                    fiscal_quarter(d, 4).alias("fq"), fiscal_year(d, 4).alias("fy"),
                    fiscal_year(d, 4, label="end").alias("fy_end"), week_in_month(d).alias("wim"),
                    week_in_year(d).alias("wiy"), day_only("LastModifiedDate").alias("d_only"))
            .to_df())


@register("c10_c14_hour_and_timezone", """
SELECT event_id AS Id, CAST(hour(ts) AS INTEGER) AS h,
       CAST(hour(timezone('America/New_York', timezone('UTC', ts))) AS INTEGER) AS h_ny,
       CAST(day(timezone('Asia/Tokyo', timezone('UTC', ts))) AS INTEGER) AS d_tokyo
FROM events""")
def c10_c14_hour_and_timezone(spark, sf_dir):
    return (ObjectQuery(_cat(spark, sf_dir), "Activity")
            .select("Id", hour_in_day("CreatedDate").alias("h"),
                    hour_in_day(convert_timezone("CreatedDate", "America/New_York")).alias("h_ny"),
                    day_in_month(convert_timezone("CreatedDate", "Asia/Tokyo")).alias("d_tokyo"))
            .to_df())


@register("c14_group_by_local_hour", """
SELECT CAST(hour(timezone('Europe/Paris', timezone('UTC', ts))) AS INTEGER) AS h, COUNT(*) AS n
FROM events GROUP BY 1""")
def c14_group_by_local_hour(spark, sf_dir):
    h = hour_in_day(convert_timezone("CreatedDate", "Europe/Paris"))
    return (ObjectQuery(_cat(spark, sf_dir), "Activity").select(h.alias("h"), count_().alias("n"))
            .group_by(h).to_df())


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """The training-data queries and their SQL, and the pipeline; none where
    that subpackage isn't there, and no pipeline where its module isn't."""
    import importlib

    def there(name: str):
        try:
            return importlib.import_module(name)
        except ModuleNotFoundError as e:
            if e.name not in (name, name.rpartition(".")[0]):
                raise
            return None
    registry = there("objectlake.llm.registry")
    if registry is None:
        return {}, {}
    pipeline = there("corpus_pipeline")     # imports the subpackage, so only looked for beside it

    def tuned(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run
    found, sql = dict(registry.QUERIES), dict(registry.SQL)
    if pipeline is not None:
        found["pipeline"] = pipeline.run
        if pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = pipeline.ORACLE_SQL
    return {name: tuned(fn) for name, fn in found.items()}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_llm()[1]}


# ===================================================== decode / encode (D-*)
def _text_orders(spark, sf_dir):
    """Orders as a text extract: odd names, blanks and junk values."""
    o = spark.read.parquet(table_path(sf_dir, "orders"))
    amount = (F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
              .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("x"))
              .otherwise(F.col("o_totalprice").cast("string")))
    won = (F.when(F.col("o_orderstatus") == "O", F.lit("TRUE"))
           .when(F.col("o_orderstatus") == "F", F.lit("false")).otherwise(F.lit("yes")))
    return o.select(F.col("o_orderkey").cast("string").alias("ID"), amount.alias("amount"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("Close Date"), won.alias("IsWon"),
                    F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456Z"))
                    .alias("LastModifiedDate"),
                    F.col("o_orderpriority").alias("Priority"), F.lit("junk").alias("Unknown"))


_TEXT_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType(), False), T.StructField("Amount", T.DoubleType()),
    T.StructField("Close_Date", T.DateType()), T.StructField("IsWon", T.BooleanType()),
    T.StructField("LastModifiedDate", T.TimestampType()), T.StructField("Missing", T.StringType())])


def _ntz(df: DataFrame) -> DataFrame:
    """Instants shown as UTC wall-clock time (session zone is UTC)."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if isinstance(f.dataType, T.TimestampType)})


@register("d01_typed_decode", """
SELECT o_orderkey AS Id,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS Amount,
  CAST(o_orderdate AS DATE) AS Close_Date, (o_orderstatus = 'O') AS IsWon,
  o_orderdate + INTERVAL 123 MILLISECOND AS LastModifiedDate, CAST(NULL AS VARCHAR) AS Missing
FROM orders""")
def d01_typed_decode(spark, sf_dir):
    from objectlake.operators.codec import decode
    return _ntz(decode(_text_orders(spark, sf_dir), _TEXT_SCHEMA, strict=False))


@register("d02_nested_decode", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type,
       CAST(NULL AS DOUBLE) AS missing FROM events""")
def d02_nested_decode(spark, sf_dir):
    """An array of string maps (keys with odd case and dots) decoded to an
    array of typed structs, then read back element by element."""
    from objectlake.operators.codec import decode
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    maps = ev.select("event_id", F.array(F.map_concat(
        F.from_json("props", "map<string,string>"),
        F.create_map(F.lit("Event.Type"), F.col("event_type")))).alias("Items"))
    item = T.StructType([T.StructField("K", T.LongType()), T.StructField("event_type", T.StringType()),
                         T.StructField("missing", T.DoubleType())])
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("items", T.ArrayType(item))])
    out = decode(maps, schema)
    return out.select("event_id", F.col("items")[0]["K"].alias("k"),
                      F.col("items")[0]["event_type"].alias("event_type"),
                      F.col("items")[0]["missing"].alias("missing"))


_CONF_SCHEMA = T.StructType(list(_TEXT_SCHEMA.fields) + [
    T.StructField("Priority", T.LongType()), T.StructField("Blob", T.BinaryType())])


@register("d07_conformance_report", """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
       WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'x' ELSE 'v' END AS amount FROM orders),
n AS (SELECT COUNT(*) AS c FROM orders)
SELECT 'Id' AS field, 'bigint' AS expected_type, (SELECT c FROM n) AS "rows", 0::BIGINT AS nulls,
       0::BIGINT AS blanks, 0::BIGINT AS bad_values, 'ok' AS verdict
UNION ALL SELECT 'Amount', 'double', (SELECT c FROM n), 0, (SELECT COUNT(*) FROM t WHERE amount = ''),
       (SELECT COUNT(*) FROM t WHERE amount = 'x'), 'type mismatch'
UNION ALL SELECT 'Close_Date', 'date', (SELECT c FROM n), 0, 0, 0, 'ok'
UNION ALL SELECT 'IsWon', 'boolean', (SELECT c FROM n), 0, 0, 0, 'ok'
UNION ALL SELECT 'LastModifiedDate', 'timestamp', (SELECT c FROM n), 0, 0, 0, 'ok'
UNION ALL SELECT 'Missing', 'string', (SELECT c FROM n), NULL, NULL, NULL, 'missing'
UNION ALL SELECT 'Priority', 'bigint', (SELECT c FROM n), 0, 0, (SELECT c FROM n), 'type mismatch'
UNION ALL SELECT 'Blob', 'binary', (SELECT c FROM n), NULL, NULL, NULL, 'missing'""")
def d07_conformance_report(spark, sf_dir):
    from objectlake.operators.codec import conformance
    return conformance(_text_orders(spark, sf_dir), _CONF_SCHEMA)


_FRAC = "(microsecond(ts) % 1000000)"


@register("d03_encode", f"""
SELECT CAST(event_id AS VARCHAR) AS Id, CAST(value AS VARCHAR) AS Value,
  CASE WHEN {_FRAC} // 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST({_FRAC} // 1000 AS VARCHAR), 3, '0') || 'Z' END AS Instant,
  CASE WHEN {_FRAC} = 0 THEN CASE WHEN second(ts) = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M')
                                  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END
       WHEN {_FRAC} % 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST({_FRAC} // 1000 AS VARCHAR), 3, '0')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS Local,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS Day,
  strftime(ts, '%H:%M:%S.') || lpad(CAST({_FRAC} // 1000 AS VARCHAR), 3, '0') || 'Z' AS TimeMicros,
  CASE WHEN {_FRAC} // 1000 = 0 THEN CASE WHEN second(ts) = 0 THEN strftime(ts, '%H:%M') ELSE strftime(ts, '%H:%M:%S') END
       ELSE strftime(ts, '%H:%M:%S.') || lpad(CAST({_FRAC} // 1000 AS VARCHAR), 3, '0') END AS TimeMillis,
  CAST(event_type = 'click' AS VARCHAR) AS Flag, CAST(NULL AS VARCHAR) AS Nothing, CAST(user_id AS VARCHAR) AS UserId
FROM events""")
def d03_encode(spark, sf_dir):
    from objectlake.operators.codec import TIME_MILLIS, encode, time_field
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    micros_of_day = (F.unix_micros(F.col("ts").cast("timestamp"))
                     - F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp"))))
    typed = ev.select(F.col("event_id").alias("Id"), F.col("value").alias("Value"),
                      F.col("ts").cast("timestamp").alias("Instant"), F.col("ts").alias("Local"),
                      F.to_date("ts").alias("Day"), micros_of_day.alias("TimeMicros"),
                      F.floor(micros_of_day / 1000).cast("long").alias("TimeMillis"),
                      (F.col("event_type") == "click").alias("Flag"), F.lit(None).cast("string").alias("Nothing"),
                      F.col("user_id").alias("UserId"))
    fields = [time_field("TimeMicros") if f.name == "TimeMicros" else
              time_field("TimeMillis", TIME_MILLIS) if f.name == "TimeMillis" else f
              for f in typed.schema.fields]
    return encode(typed.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in fields]))


@register("d05_flatten_nested_rows", """
SELECT o.o_orderkey AS Id, o.o_totalprice AS amt, k.c_name AS Account_Name, n.n_name AS Account_Territory_Name
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) k ON o.o_custkey = k.c_custkey
LEFT JOIN nation n ON k.c_nationkey = n.n_nationkey""")
def d05_flatten_nested_rows(spark, sf_dir):
    """Rows shaped like an object tree (parent objects as nested structs, a
    missing parent as null) flattened to columns."""
    from objectlake.operators.codec import flatten
    o = spark.read.parquet(table_path(sf_dir, "orders"))
    c = spark.read.parquet(table_path(sf_dir, "customer")).filter(F.col("c_acctbal") > 5000)
    n = spark.read.parquet(table_path(sf_dir, "nation"))
    acct = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey", F.struct(F.col("c_name").alias("Name"),
                              F.struct(F.col("n_name").alias("Name")).alias("Territory")).alias("Account"))
    rows = o.join(acct, o.o_custkey == acct.c_custkey, "left").select(
        F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("Amount"), "Account")
    return flatten(rows, ["Id", ("Amount", "amt"), "Account.Name", "Account.Territory.Name"])


def _documents_files(spark, sf_dir):
    from objectlake.operators.codec import split_attachments
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    rows = docs.select(F.col("doc_id").alias("Id"), F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))
                       .alias("Name"), F.base64(F.encode("text", "UTF-8")).alias("Body"))
    return split_attachments(rows, "Attachment", order_by="Id")


@register("d06_file_rows", """
SELECT doc_id AS Id, 'doc_' || doc_id || '.txt' AS Name,
       '#' || row_number() OVER (ORDER BY doc_id) || '_doc_' || doc_id || '.txt' AS Body FROM documents""")
def d06_file_rows(spark, sf_dir):
    return _documents_files(spark, sf_dir)[0]


@register("d06_file_payloads", """
SELECT row_number() OVER (ORDER BY doc_id) || '_doc_' || doc_id || '.txt' AS key,
       CAST(strlen(text) AS INTEGER) AS size, md5(text) AS digest FROM documents""")
def d06_file_payloads(spark, sf_dir):
    files = _documents_files(spark, sf_dir)[1]
    return files.select("key", F.col("size").cast("int").alias("size"), F.md5("content").alias("digest"))


# ============================================================= sinks (W-*)
_OPP_COLS = "Id, AccountId, StageName, Amount, CloseDate, Priority, LastModifiedDate, IsDeleted"


def _opp_all(spark, sf_dir):
    return _cat(spark, sf_dir).table("Opportunity")


@register("w01_insert", f"""
SELECT {_OPP_COLS} FROM {OPP} WHERE CloseDate < DATE '1998-01-01'
UNION ALL
SELECT Id, AccountId, StageName, Amount, NULL, NULL, NULL, NULL FROM {OPP} WHERE CloseDate >= DATE '1998-01-01'""")
def w01_insert(spark, sf_dir):
    from objectlake.sinks.write import apply_write, validate_write
    opp = _opp_all(spark, sf_dir)
    target = opp.filter(F.col("CloseDate") < F.lit(dt.date(1998, 1, 1)))
    inp = opp.filter(F.col("CloseDate") >= F.lit(dt.date(1998, 1, 1))).select(
        F.col("Id").alias("ID"), F.col("AccountId").alias("accountid"), F.col("StageName").alias("STAGENAME"),
        F.col("Amount").alias("amount"))
    failures = validate_write(target.schema, inp.schema, "insert", read_only=["IsDeleted", "LastModifiedDate"])
    if failures:
        raise ValueError("; ".join(failures))
    return apply_write(target, inp, "insert").table


_UPD_INPUT = f"""inp AS (
  SELECT Id, Amount + 1000 AS Amount, CASE WHEN Priority = '1-URGENT' THEN NULL ELSE Priority END AS Priority
  FROM {OPP} WHERE CloseDate >= DATE '1998-07-01'
  UNION ALL SELECT Id, Amount, Priority FROM {OPP} WHERE CloseDate = DATE '1998-07-01'
  UNION ALL SELECT Id + 100000000, Amount, Priority FROM {OPP} WHERE CloseDate >= DATE '2001-01-01'),
good AS (SELECT * FROM inp WHERE Id IN (SELECT Id FROM inp GROUP BY Id HAVING COUNT(*) = 1)
                               AND Id IN (SELECT Id FROM {OPP}))"""


def _update_input(opp):
    late = opp.filter(F.col("CloseDate") >= F.lit(dt.date(1998, 7, 1)))
    changed = late.select("Id", (F.col("Amount") + 1000).alias("Amount"),
                          F.when(F.col("Priority") == "1-URGENT", F.lit(None)).otherwise(F.col("Priority"))
                          .alias("Priority"))
    dups = opp.filter(F.col("CloseDate") == F.lit(dt.date(1998, 7, 1))).select("Id", "Amount", "Priority")
    unknown = opp.filter(F.col("CloseDate") >= F.lit(dt.date(2001, 1, 1))).select(
        (F.col("Id") + 100000000).alias("Id"), "Amount", "Priority")
    return changed.unionByName(dups).unionByName(unknown)


@register("w02_update", f"""
WITH {_UPD_INPUT}
SELECT t.Id, t.AccountId, t.StageName, CASE WHEN g.Id IS NOT NULL THEN g.Amount ELSE t.Amount END AS Amount,
       t.CloseDate, CASE WHEN g.Id IS NOT NULL THEN g.Priority ELSE t.Priority END AS Priority,
       t.LastModifiedDate, t.IsDeleted
FROM {OPP} t LEFT JOIN good g ON t.Id = g.Id""")
def w02_update(spark, sf_dir):
    from objectlake.sinks.write import write
    cat = _cat(spark, sf_dir)
    return write(cat, "Opportunity", _update_input(_opp_all(spark, sf_dir)), "update", on_error="skip").table


@register("w09_rejected_rows", f"""
WITH {_UPD_INPUT}
SELECT Id, Amount, Priority,
  CASE WHEN Id IN (SELECT Id FROM inp GROUP BY Id HAVING COUNT(*) > 1) THEN 'Duplicate Id in the input'
       ELSE 'Id does not exist' END AS error
FROM inp WHERE Id NOT IN (SELECT Id FROM good)""")
def w09_rejected_rows(spark, sf_dir):
    from objectlake.sinks.write import write
    cat = _cat(spark, sf_dir)
    return write(cat, "Opportunity", _update_input(_opp_all(spark, sf_dir)), "update", on_error="skip").rejected


@register("w03_upsert", f"""
WITH up AS (SELECT Id, Amount + 1 AS Amount FROM {OPP} WHERE CloseDate >= DATE '2000-01-01'),
ins AS (SELECT AccountId, 'N' AS StageName, Amount FROM {OPP} WHERE CloseDate >= DATE '2001-06-01')
SELECT t.Id, t.AccountId, t.StageName, COALESCE(u.Amount, t.Amount) AS Amount, t.CloseDate, t.Priority,
       t.LastModifiedDate, t.IsDeleted
FROM {OPP} t LEFT JOIN up u ON t.Id = u.Id
UNION ALL
SELECT NULL, AccountId, StageName, Amount, NULL, NULL, NULL, NULL FROM ins""")
def w03_upsert(spark, sf_dir):
    from objectlake.sinks.write import apply_write, write
    opp = _opp_all(spark, sf_dir)
    up = opp.filter(F.col("CloseDate") >= F.lit(dt.date(2000, 1, 1))).select(
        "Id", F.lit(None).cast("long").alias("AccountId"), F.lit(None).cast("string").alias("StageName"),
        (F.col("Amount") + 1).alias("Amount"))
    ins = opp.filter(F.col("CloseDate") >= F.lit(dt.date(2001, 6, 1))).select(
        F.lit(None).cast("long").alias("Id"), "AccountId", F.lit("N").alias("StageName"), "Amount")
    # two writes, because a column's presence decides what changes: update rows
    # supply only Id and Amount; new rows have no Id and supply other fields
    first = write(_cat(spark, sf_dir), "Opportunity", up.select("Id", "Amount"), "upsert", key="Id")
    return apply_write(first.table, ins, "upsert", key="Id").table


_MERGE_INPUT = f"""up AS (
  SELECT Id, Amount + 1 AS Amount FROM {OPP} WHERE Id BETWEEN (SELECT MAX(Id) // 2 FROM {OPP}) AND (SELECT MAX(Id) // 2 + 400 FROM {OPP})
  UNION ALL SELECT Id + 100000000, Amount FROM {OPP} WHERE CloseDate >= DATE '2001-07-01')"""


def _merged(spark, sf_dir, operation):
    """All opportunities as a folder of 24 files in order of Id, and a merge of
    some 400 neighbouring keys and of keys that it lacks; read again."""
    from objectlake.session import scratch_path
    from objectlake.sinks import merge, versions
    opp = _opp_all(spark, sf_dir)
    path = scratch_path(spark, "merged-opportunities")
    opp.repartitionByRange(24, "Id").write.parquet(path)
    middle = F.floor(F.lit(opp.agg(F.max("Id")).first()[0]) / 2)
    some = opp.where(F.col("Id").between(middle, middle + 400)).select("Id", (F.col("Amount") + 1).alias("Amount"))
    new = opp.where(F.col("CloseDate") >= F.lit(dt.date(2001, 7, 1))).select((F.col("Id") + 100000000).alias("Id"), "Amount")
    merge.merge(spark, path, some.unionByName(new), operation, "Id", on_error="skip")
    return versions.read_table(spark, path)


@register("w02_merge_update", f"""
WITH {_MERGE_INPUT}
SELECT t.Id, t.AccountId, t.StageName, COALESCE(u.Amount, t.Amount) AS Amount, t.CloseDate, t.Priority,
       t.LastModifiedDate, t.IsDeleted
FROM {OPP} t LEFT JOIN up u ON t.Id = u.Id""")
def w02_merge_update(spark, sf_dir):
    return _merged(spark, sf_dir, "update")


@register("w03_merge_upsert", f"""
WITH {_MERGE_INPUT}
SELECT COALESCE(t.Id, u.Id) AS Id, t.AccountId, t.StageName, COALESCE(u.Amount, t.Amount) AS Amount, t.CloseDate, t.Priority,
       t.LastModifiedDate, t.IsDeleted
FROM {OPP} t FULL JOIN up u ON t.Id = u.Id""")
def w03_merge_upsert(spark, sf_dir):
    return _merged(spark, sf_dir, "upsert")


@register("w06_pack_by_records", f"""
SELECT Id, CAST((row_number() OVER (ORDER BY Id) - 1) // 1000 AS BIGINT) AS batch_id FROM {OPP}""")
def w06_pack_by_records(spark, sf_dir):
    from objectlake.operators.packing import pack_batches
    return pack_batches(_opp_all(spark, sf_dir).select("Id"), max_records=1000, order_by=["Id"])


# greedy packing of all rows in order, a batch a step: the next one begins with the first row that
# would bring the batch (header of 27 bytes included) over the cap, or after 5000 rows
@register("w06_pack_by_bytes", f"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT Id, StageName, Amount, row_number() OVER (ORDER BY Id) AS k,
         length(CAST(Id AS VARCHAR)) + length(StageName) + length(CAST(Amount AS VARCHAR)) + 6 + 2 + 2 AS size FROM {OPP}),
sums AS MATERIALIZED (SELECT k, CAST(sum(size) OVER (ORDER BY k) AS BIGINT) AS upto, size FROM sized),
starts AS (
  SELECT CAST(1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS before, CAST(0 AS BIGINT) AS batch_id
  UNION ALL
  SELECT min(n.k), min(n.upto - n.size), any_value(s.batch_id) + 1
  FROM starts s JOIN sums n ON n.k > s.k AND (27 + n.upto - s.before > 20000 OR n.k = s.k + 5000)
  HAVING count(*) > 0)
SELECT z.Id, z.StageName, z.Amount, s.batch_id FROM sized z ASOF JOIN starts s ON z.k >= s.k""")
def w06_pack_by_bytes(spark, sf_dir):
    from objectlake.operators.packing import pack_batches
    return pack_batches(_opp_all(spark, sf_dir).select("Id", "StageName", "Amount"), max_records=5000,
                        max_bytes=20_000, order_by=["Id"])


@register("w06_pack_by_bytes_invariants", """
SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violations FROM orders""")
def w06_pack_by_bytes_invariants(spark, sf_dir):
    """Byte-capped greedy packing checked over the whole table: each batch
    holds at most max_records rows and max_bytes bytes (header included)
    unless it is a single record, and the first record of the next batch
    would not have fitted (the packing is greedy)."""
    from objectlake.operators.packing import check_packing, pack_batches
    max_records, max_bytes = 5000, 20_000
    data = _opp_all(spark, sf_dir).select("Id", "StageName", "Amount")
    packed = pack_batches(data, max_records=max_records, max_bytes=max_bytes, order_by=["Id"])
    return check_packing(packed, data.columns, "Id", max_records, max_bytes)


# greedy packing of each account's orders, row by row: the header counts but for the first record of a batch
@register("w06_pack_by_bytes_per_account", f"""
WITH RECURSIVE sized AS (
  SELECT o_custkey AS AccountId, o_orderkey AS Id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
         length(CAST(o_custkey AS VARCHAR)) + length(CAST(o_orderkey AS VARCHAR)) + coalesce(length(o_orderpriority), 0) + 8 + 2 + 16 + 3 AS size
  FROM orders),
packed AS (
  SELECT AccountId, Id, k, size AS used, 1 AS n, 0 AS batch_id FROM sized WHERE k = 1
  UNION ALL
  SELECT s.AccountId, s.Id, s.k,
         CASE WHEN p.n < 4 AND p.used + s.size + 40 <= 220 THEN p.used + s.size ELSE s.size END,
         CASE WHEN p.n < 4 AND p.used + s.size + 40 <= 220 THEN p.n + 1 ELSE 1 END,
         CASE WHEN p.n < 4 AND p.used + s.size + 40 <= 220 THEN p.batch_id ELSE p.batch_id + 1 END
  FROM packed p JOIN sized s ON s.AccountId = p.AccountId AND s.k = p.k + 1)
SELECT AccountId, Id, CAST(batch_id AS BIGINT) AS batch_id FROM packed""")
def w06_pack_by_bytes_per_account(spark, sf_dir):
    """Byte-capped packing within each account, whatever the task layout; the
    time column is longer written out than as Spark prints it."""
    from objectlake.operators.packing import pack_batches
    data = spark.read.parquet(table_path(sf_dir, "orders")).select(
        F.col("o_custkey").alias("AccountId"), F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("Priority"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ClosedAt"))
    packed = pack_batches(data, max_records=4, max_bytes=220, order_by=["Id"], partition_by=["AccountId"])
    return packed.select("AccountId", "Id", "batch_id")


@register("w08_result_check", f"""
SELECT Id, 'false' AS Success, 'false' AS Created, 'missing priority' AS Error FROM {OPP}
WHERE StageName = 'P' AND Priority IS NULL""")
def w08_result_check(spark, sf_dir):
    from objectlake.sinks.csvbatch import check_results
    opp = _opp_all(spark, sf_dir)
    failed = (F.col("StageName") == "P") & F.col("Priority").isNull()
    results = opp.select("Id", F.when(failed, F.lit("false")).otherwise(F.lit("TRUE")).alias("Success"),
                         F.lit("false").alias("Created"),
                         F.when(failed, F.lit("missing priority")).otherwise(F.lit("")).alias("Error"))
    return check_results(results, on_error="skip")[1]


# ============================================== bulk CSV round trip (S-07, W-07)
def _bulk_roundtrip(spark, sf_dir, df, schema, order):
    from objectlake.operators.packing import pack_batches
    from objectlake.session import scratch_path
    from objectlake.sinks.csvbatch import write_csv_batches
    from objectlake.sources.bulkcsv import read_bulk_results
    path = scratch_path(spark, "bulk")
    write_csv_batches(pack_batches(df, max_records=2000, order_by=order), path)
    return read_bulk_results(spark, path, schema)


@register("s07_bulk_csv_roundtrip", f"SELECT Id, StageName, Amount, CloseDate, Priority FROM {OPP_LIVE}")
def s07_bulk_csv_roundtrip(spark, sf_dir):
    q = ObjectQuery(_cat(spark, sf_dir), "Opportunity").select("Id", "StageName", "Amount", "CloseDate", "Priority")
    schema = T.StructType([T.StructField("Id", T.LongType(), False), T.StructField("StageName", T.StringType()),
                           T.StructField("Amount", T.DoubleType()), T.StructField("CloseDate", T.DateType()),
                           T.StructField("Priority", T.StringType())])
    return _bulk_roundtrip(spark, sf_dir, q.to_df(), schema, ["Id"])


@register("s07_bulk_csv_multiline_text", "SELECT doc_id, lang, md5(text) AS digest FROM documents")
def s07_bulk_csv_multiline_text(spark, sf_dir):
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "lang", "text")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("text", T.StringType())])
    back = _bulk_roundtrip(spark, sf_dir, docs, schema, ["doc_id"])
    return back.select("doc_id", "lang", F.md5("text").alias("digest"))


# ====================================================== change streams (T-*)
_OP = ("CASE event_type WHEN 'signup' THEN 'created' WHEN 'error' THEN 'deleted' ELSE 'updated' END")


_MESSAGE_FILES: dict = {}


def _message_files(spark, sf_dir, broken: bool = False) -> DataFrame:
    """The change messages as text files, read the way a stream source reads
    them (written once per session into the shared scratch folder)."""
    from objectlake.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir, broken)
    if key not in _MESSAGE_FILES:
        path = scratch_path(spark, "messages")
        _change_messages(spark, sf_dir, broken).write.text(path)
        _MESSAGE_FILES[key] = path
    return spark.read.text(_MESSAGE_FILES[key])


def _change_messages(spark, sf_dir, broken: bool = False) -> DataFrame:
    """One JSON change message per event: the user's record changed."""
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    op = (F.when(F.col("event_type") == "signup", "created").when(F.col("event_type") == "error", "deleted")
          .otherwise("updated"))
    changed = (F.when(F.col("event_type") == "click", F.array(F.lit("Value")))
               .when(F.col("event_type") == "view", F.array(F.lit("LastModifiedDate")))
               .when(F.col("event_type") == "purchase", F.array(F.lit("Value"), F.lit("type"))))
    msg = F.to_json(F.struct(
        F.struct(op.alias("type"), F.col("event_id").alias("replayId")).alias("event"),
        F.struct(F.col("user_id").alias("Id"), F.col("event_type").alias("type"), F.col("value").alias("Value"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("LastModifiedDate"),
                 F.from_json("props", "map<string,int>").alias("Props")).alias("sobject"),
        changed.alias("changedFields")))
    if broken:
        msg = F.when(F.col("event_type") == "error", F.concat(F.lit("broken:"), F.col("event_id"))).otherwise(msg)
    return ev.select(msg.alias("value"))


_CHANGE_SCHEMA = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Type", T.StringType()),
                               T.StructField("Value", T.DoubleType()),
                               T.StructField("LastModifiedDate", T.TimestampType())])


@register("t01_decode_changes", f"""
SELECT user_id AS Id, event_type AS Type, value AS Value, date_trunc('millisecond', ts) AS LastModifiedDate,
       {_OP} AS op, event_id AS replay_id FROM events""")
def t01_decode_changes(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes
    out = decode_changes(_message_files(spark, sf_dir), _CHANGE_SCHEMA)
    return _ntz(out.select("Id", "Type", "Value", "LastModifiedDate", F.col("_op").alias("op"),
                           F.col("_replay_id").alias("replay_id")))


@register("t02_operation_filter", """
SELECT user_id AS Id, event_id AS replay_id FROM events WHERE event_type <> 'error'""")
def t02_operation_filter(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes, notify
    out = notify(decode_changes(_message_files(spark, sf_dir), _CHANGE_SCHEMA), delete=False)
    return out.select("Id", F.col("_replay_id").alias("replay_id"))


@register("t03_referenced_fields", """
SELECT user_id AS Id, event_id AS replay_id FROM events
WHERE value > 20 AND event_type IN ('signup', 'error', 'click', 'purchase')""")
def t03_referenced_fields(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes, notify_for_fields
    rows = decode_changes(_message_files(spark, sf_dir), _CHANGE_SCHEMA)
    out = notify_for_fields(rows, "Referenced", select_fields=["Type"], where_fields=["Value"],
                            cond=F.col("Value") > 20)
    return out.select("Id", F.col("_replay_id").alias("replay_id"))


@register("t03_select_fields", """
SELECT user_id AS Id, event_id AS replay_id FROM events
WHERE event_type IN ('signup', 'error', 'view')""")
def t03_select_fields(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes, notify_for_fields
    rows = decode_changes(_message_files(spark, sf_dir), _CHANGE_SCHEMA)
    out = notify_for_fields(rows, "Select", select_fields=["lastmodifieddate"])
    return out.select("Id", F.col("_replay_id").alias("replay_id"))


@register("t04_stream_query_projection", """
SELECT user_id AS Id, value AS Value FROM events WHERE event_type = 'purchase' AND value >= 40""")
def t04_stream_query_projection(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes
    rows = decode_changes(_message_files(spark, sf_dir), _CHANGE_SCHEMA, keep_event=False)
    cat = _cat(spark, sf_dir)
    cat.register("UserState", rows, id_field="Id")
    q = (ObjectQuery(cat, "UserState").select("Id", "Value")
         .where((fld("Type") == "purchase") & (fld("Value") >= 40)))
    return q.over(rows)


@register("t07_quarantine", """
SELECT 'broken:' || event_id AS message FROM events WHERE event_type = 'error'""")
def t07_quarantine(spark, sf_dir):
    from objectlake.streaming.changes import decode_changes
    _, bad = decode_changes(_message_files(spark, sf_dir, broken=True), _CHANGE_SCHEMA, on_error="quarantine")
    return bad.select("message")


@register("t07_all_accounted", """
SELECT CASE WHEN event_type = 'click' AND value IS NOT NULL OR event_type = 'error' THEN 'bad' ELSE 'good' END AS kind,
       CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'click' AND value IS NOT NULL THEN 'Value' END AS fields,
       COUNT(*) AS n FROM events GROUP BY ALL""")
def t07_all_accounted(spark, sf_dir):
    """Messages with values that don't convert, with a key twice, without an
    operation and without JSON: each comes out once, good or bad."""
    from objectlake.streaming.changes import notify, tag_changes
    raw = _message_files(spark, sf_dir)
    kind = F.get_json_object("value", "$.sobject.type")
    raw = raw.select(F.when(kind == "error", F.lit("no JSON"))
                     .when(kind == "click", F.regexp_replace("value", r'"Value":[^,}]*', '"Value":"abc"'))
                     .when(kind == "view", F.regexp_replace("value", r'"Id":', '"ID":1,"Id":'))
                     .when(kind == "purchase", F.regexp_replace("value", r'"event":\{"type":"[a-z]*",', '"event":{'))
                     .otherwise(F.col("value")).alias("value"))
    # a click without a value stays readable: its text has no Value at all
    rows = notify(tag_changes(raw, _CHANGE_SCHEMA)).select(
        F.when(F.col("_good"), "good").otherwise("bad").alias("kind"),
        F.when(~F.col("_good"), F.array_join("_unread", ",")).alias("fields"))
    return rows.groupBy("kind", "fields").agg(F.count(F.lit(1)).alias("n"))
