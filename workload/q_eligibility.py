"""Candidate discovery, eligibility and routing."""

from pyspark.sql import functions as F

from navloom.functions import dates as fdates
from navloom.functions.text import has_any
from navloom.operators import eligibility as elig
from navloom.operators import timeseries as ts
from navloom.operators.quality import issues_of
from workload import bindings as b
from workload.q_timeseries import RECORD_COLUMNS, RECORD_CTE, RECORD_JOINS, nav_cte, window_cte
from workload.registry import query

SCOPE = """scope AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, c_custkey, c_acctbal, c_nationkey,
  c_mktsegment, c_nationkey % 5 <> 4 AND (c_nationkey < 10 OR c_nationkey >= 21) AS is_rmb_a,
  c_mktsegment = 'MACHINERY' AND c_nationkey < 21 AS is_listed, c_nationkey % 5 = 2 AS is_excluded,
  c_mktsegment IN ('BUILDING', 'FURNITURE') AS has_keyword FROM customer)"""


@query("flt01_share_filters", f"""WITH {SCOPE} SELECT code, is_rmb_a, is_rmb_a AND NOT is_listed AS is_otc,
  is_excluded, has_keyword FROM scope""")
def share_filters(spark, sf):
    """FLT-01 to FLT-04 as columns."""
    name, kind = F.col("name"), F.col("fund_type")
    return b.funds(spark, sf).select(
        "code", elig.is_rmb_a_share(name, kind).alias("is_rmb_a"), elig.is_otc_share(name, kind).alias("is_otc"),
        elig.is_excluded_type(kind).alias("is_excluded"), has_any(name, ["亚洲", "", "中国"]).alias("has_keyword"))


HELD = """held AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code,
  concat(CAST(year(o_orderdate) AS VARCHAR), CASE WHEN month(o_orderdate) <= 6 THEN '_2' ELSE '_4' END) AS period_key,
  max(o_totalprice) / 6000 AS institution_pct FROM orders GROUP BY 1, 2)"""
CANDIDATES = f"""{SCOPE}, {HELD}, candidates AS (
  SELECT h.code, h.period_key, h.institution_pct, s.c_acctbal, s.c_custkey, s.c_nationkey FROM held h JOIN scope s USING (code)
  WHERE is_rmb_a AND NOT is_listed AND NOT is_excluded AND NOT has_keyword)"""


@query("jn01_candidates", f"""WITH {CANDIDATES} SELECT code, period_key, institution_pct
FROM candidates""")
def candidates(spark, sf):
    found = elig.build_candidates(b.holders(spark, sf), b.funds(spark, sf), ["亚洲", "中国"])
    return found.select("code", "period_key", "institution_pct")


PERIODS = """halves AS (SELECT CASE WHEN month(o_orderdate) <= 6 THEN make_date(year(o_orderdate), 6, 30)
    ELSE make_date(year(o_orderdate), 12, 31) END AS report_date, count(DISTINCT o_custkey) AS fund_count
  FROM orders GROUP BY 1),
lagged AS (SELECT *, lag(fund_count) OVER (ORDER BY report_date) AS older_count FROM halves),
flagged AS (SELECT *, older_count IS NULL OR fund_count >= ceil(older_count * 0.95) AS complete FROM lagged)"""


@query("win06_select_period", f"""WITH {PERIODS},
best AS (SELECT max(report_date) AS d FROM flagged WHERE complete)
SELECT report_date, CAST(fund_count AS BIGINT) AS fund_count, CAST(older_count AS BIGINT) AS older_count,
  report_date = d AS selected, report_date > d AS skipped FROM flagged, best""")
def select_period(spark, sf):
    return elig.select_period(b.holder_periods(spark, sf)).drop("period_key")


@query("jn02_enrich_missing", f"""WITH {CANDIDATES}
SELECT code, period_key, c_acctbal >= 0 AS page_found, CASE WHEN c_acctbal < 0 THEN 'fund_page_missing' END AS reason
FROM candidates""")
def enrich_missing(spark, sf):
    found = elig.build_candidates(b.holders(spark, sf), b.funds(spark, sf), ["亚洲", "中国"])
    pages = b.fund_pages(spark, sf).where("purchase_status <> 'suspended'")
    enriched = elig.enrich(found, pages)
    fatal = elig.missing_pages(enriched).select("code", "reason").distinct()
    return enriched.select("code", "period_key", "page_found").join(fatal, "code", "left")


PAGES = """pages AS (SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'suspended' WHEN c_acctbal < 3000 THEN 'limited'
  WHEN c_acctbal < 9000 THEN 'open' ELSE 'unknown' END AS status, min(CAST(o_orderdate AS DATE)) AS inception
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query("flt05_eligible", f"""WITH {PAGES} SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, status AS purchase_status,
  inception AS inception_date FROM pages
WHERE c_acctbal / 100 > 3 AND status IN ('open', 'limited') AND inception < DATE '1998-06-30'""")
def eligible(spark, sf):
    pages = b.fund_pages(spark, sf).withColumn("name", F.lit("x"))
    return elig.filter_eligible(pages, as_of=b.AS_OF, min_scale=3.0).select(
        "code", "purchase_status", "inception_date")


@query("flt06_threshold_failures", f"""WITH {nav_cte()}, {RECORD_CTE},
h AS (SELECT DISTINCT code FROM wealth), p AS (SELECT h.code AS fund, {RECORD_COLUMNS} FROM h {RECORD_JOINS})
SELECT fund AS code, 'three_year_return_below_threshold' AS failure FROM p
  WHERE three_year_return_pct IS NULL OR three_year_return_pct < 30
UNION ALL SELECT fund, 'five_year_return_below_threshold' FROM p WHERE five_year_return_pct < 60
UNION ALL SELECT fund, 'ten_year_return_below_threshold' FROM p WHERE ten_year_return_pct < 100""")
def threshold_failures(spark, sf):
    record = ts.performance_record(b.nav_by_supplier(spark, sf), as_of=b.AS_OF)
    return record.select("code", F.explode(elig.performance_failures()).alias("failure"))


@query("ag19_history_issues", f"""WITH {nav_cte(as_of="DATE '1997-06-30'")}, {window_cte(3)},
h AS (SELECT code, min(date) AS first_date FROM wealth GROUP BY code)
SELECT h.code, 'nav_history_short' AS reason, CAST(first_date AS VARCHAR) AS detail, 'fatal' AS severity
FROM h LEFT JOIN win ON win.code = h.code WHERE win.code IS NULL""")
def history_issues(spark, sf):
    """Two and a half years of history: no three-year window yet."""
    return ts.history_issues(ts.performance_record(b.nav_by_supplier(spark, sf), as_of="1997-06-30"))


@query("flt08_visible", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(count(*) AS BIGINT) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate <= DATE '1999-01-01' AND l_shipdate <= DATE '1999-01-01' GROUP BY 1, 2""")
def visible(spark, sf):
    lines, orders = b.table(spark, sf, "lineitem"), b.table(spark, sf, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return ts.visible(joined, "1999-01-01", "o_orderdate", "l_shipdate").groupBy(
        "o_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber")).agg(
            F.count(F.lit(1)).alias("lines"))


@query("prj01_route", f"""WITH {SCOPE}, e AS (SELECT *, c_acctbal / 100 AS confirmed,
  c_mktsegment IN ('BUILDING', 'FURNITURE') AS geo FROM scope)
SELECT code, CASE WHEN NOT geo AND confirmed >= 50 THEN 'us_main' ELSE 'global_supplement' END AS ranking_list,
  CASE WHEN geo THEN 'us_main_name_geography_override' WHEN confirmed >= 50 THEN 'confirmed_us_exposure'
    ELSE 'us_exposure_below_threshold' END AS routing_reason FROM e""")
def route(spark, sf):
    pages = b.fund_pages(spark, sf).select("code", F.col("scale_100m_cny").alias("confirmed_pct"))
    return elig.with_route(b.funds(spark, sf).join(pages, "code")).select("code", "ranking_list", "routing_reason")


@query("prj03_purchase_status", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' THEN 'suspended'
    WHEN o_orderpriority = '2-HIGH' THEN 'limited'
    WHEN o_orderpriority = '3-MEDIUM' OR o_orderstatus = 'O' THEN 'open' ELSE 'unknown' END AS purchase_status
FROM orders""")
def purchase_status(spark, sf):
    from navloom.sources.raw import purchase_status as status

    state = F.expr("case o_orderpriority when '1-URGENT' then '暂停申购 限大额' when '2-HIGH' then '开放申购 限大额'"
                   " when '3-MEDIUM' then '开放申购' else '' end")
    buy = F.expr("case o_orderstatus when 'P' then '4' when 'O' then '1' end")
    sale = F.expr("case o_orderstatus when 'O' then true end")
    return b.table(spark, sf, "orders").select("o_orderkey", status(state, buy, sale).alias("purchase_status"))


@query("prj04_management_style", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code,
  CASE WHEN c_nationkey % 5 = 3 AND c_mktsegment <> 'HOUSEHOLD' THEN 'passive' ELSE 'active' END AS style,
  concat(CASE WHEN c_nationkey % 5 = 3 AND c_mktsegment <> 'HOUSEHOLD' THEN '被动' ELSE '主动' END, '|',
    CASE c_nationkey % 5 WHEN 1 THEN 'FOF' WHEN 3 THEN '指数' ELSE '股票/混合' END,
    CASE WHEN c_acctbal < 2000 THEN '' WHEN c_acctbal < 4000 THEN '|复合风格' WHEN c_acctbal < 5000 THEN '|杠杆'
      ELSE '|大盘' END,
    CASE WHEN c_nationkey < 8 AND NOT (c_acctbal >= 4000 AND c_acctbal < 5000) THEN '|杠杆' ELSE '' END) AS tags
FROM customer""")
def management_style(spark, sf):
    """PRJ-04 and PRJ-05."""
    base = b.table(spark, sf, "customer").select(
        b.code_of("c_custkey").alias("code"), F.expr(b.FUND_TYPE).alias("fund_type"),
        F.expr("case c_mktsegment when 'HOUSEHOLD' then '指数增强A' else '指数A' end").alias("name"),
        F.expr("case when c_acctbal < 2000 then '未识别' when c_acctbal < 4000 then '复合风格'"
               " when c_acctbal < 5000 then '杠杆' else '大盘' end").alias("style_label"),
        F.expr("case when c_acctbal < 2000 then 'unrecognized' when c_acctbal < 4000 then 'composite'"
               " else 'recognized' end").alias("status"),
        F.expr("case when c_nationkey < 8 then 'leveraged' else 'standard' end").alias("structure"))
    style = elig.management_style(F.col("name"), F.col("fund_type"))
    tagged = base.withColumn("style", style)
    tags = elig.product_tags(*[F.col(c) for c in ("style", "fund_type", "style_label", "status", "structure")])
    return tagged.select("code", "style", F.concat_ws("|", tags).alias("tags"))


@query("srt05_top_holders", f"""WITH {HELD} SELECT code, period_key, institution_pct
FROM held ORDER BY institution_pct DESC, code, period_key LIMIT 25""")
def top_holders(spark, sf):
    """A top-25 report."""
    best = elig.top_holders(b.holders(spark, sf), 25)
    return best.select("code", "period_key", "institution_pct")


@query("fn01_dates", """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT day, CAST(day - INTERVAL 3 YEAR AS DATE) AS three_years_ago, CAST(date_trunc('week', day) AS DATE) AS week_start,
  CASE month(day) WHEN 6 THEN concat(CAST(year(day) AS VARCHAR), '_2')
    WHEN 12 THEN concat(CAST(year(day) AS VARCHAR), '_4') END AS period_key FROM d""")
def date_functions(spark, sf):
    """FN-01, FN-02, FN-03."""
    days = b.table(spark, sf, "orders").select(F.expr("cast(o_orderdate as date)").alias("day")).distinct()
    day = F.col("day")
    return days.select("day", fdates.years_ago(day, 3).alias("three_years_ago"),
                       fdates.week_start(day).alias("week_start"), fdates.period_key(day).alias("period_key"))


@query("dq01_gate_status", """WITH f AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0),
r AS (SELECT count(*) AS n FROM supplier)
SELECT CAST(f.n AS BIGINT) AS fatal_count, CAST(r.n AS BIGINT) AS record_count, f.n = 0 AND r.n > 0 AS publishable FROM f, r""")
def gate_status(spark, sf):
    from navloom.operators.quality import gate_status as status

    issues = issues_of(b.fund_pages(spark, sf), F.col("code"),
                       F.when(F.col("purchase_status") == "suspended", "not_purchasable"))
    return status(issues, b.table(spark, sf, "supplier"))


@query("dq01_staged_gate", """WITH f AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0),
r AS (SELECT count(*) AS n FROM supplier)
SELECT CAST(f.n AS BIGINT) AS fatal_count, CAST(r.n AS BIGINT) AS record_count, f.n = 0 AND r.n > 0 AS publishable,
  CAST(f.n AS BIGINT) AS staged_issues, CAST(r.n AS BIGINT) AS staged_records FROM f, r""")
def staged_gate(spark, sf):
    """The gate with counts taken while its tables are staged, beside what the staged tables hold."""
    from navloom.operators.quality import staged_gate as judge

    issues = issues_of(b.fund_pages(spark, sf), F.col("code"),
                       F.when(F.col("purchase_status") == "suspended", "not_purchasable"))
    judged = judge(issues, b.table(spark, sf, "supplier"))
    both = judged.issues.select(F.lit(1).alias("issue"), F.lit(0).alias("record")).unionByName(
        judged.ranked.select(F.lit(0).alias("issue"), F.lit(1).alias("record")))
    held = both.agg(F.coalesce(F.sum("issue"), F.lit(0)).cast("long").alias("staged_issues"),
                    F.coalesce(F.sum("record"), F.lit(0)).cast("long").alias("staged_records"))
    return held.select(F.lit(judged.fatal_count).cast("long").alias("fatal_count"),
                       F.lit(judged.record_count).cast("long").alias("record_count"),
                       F.lit(judged.publishable).alias("publishable"), "staged_issues", "staged_records")
