"""Text jobs as round trips: compose texts from columns, parse them, compare with the columns.

The SQL side computes the expected facts from the columns and needs no pattern.
"""

import uuid

from pyspark.sql import functions as F

from navloom.functions.text import product_structure, share_aggregation, strip_tags
from navloom.operators import documents as doc
from navloom.operators.quality import union_all
from navloom.plans.incremental import Store, catalog_fingerprint, parse_once, stored_documents
from navloom.session import checkpoint_folder, staged
from navloom.sources import raw
from navloom.sources.catalogs import load_benchmarks
from workload import bindings as b
from workload.registry import query

NOTICE = """case o_orderpriority
 when '1-URGENT' then concat('自', year(o_orderdate), '年', month(o_orderdate), '月', day(o_orderdate),
   '日起调整。投资者通过直销机构单日累计申购金额不得超过', format_number(amount, 0), '元；通过代销机构累计申购金额不超过', amount + 7, '元。')
 when '2-HIGH' then concat('限制申购金额（单位：人民币元）', format_number(amount, 2), '。不同份额分别计算。')
 when '3-MEDIUM' then concat('限 制 申 购\\n金额（单位：元） ', amount, ' 。自2003年5月6日起，本基金将恢复暂停接受单笔超过500万元的申购申请。')
 when '4-NOT SPECIFIED' then '本基金恢复大额申购业务。'
 else '公告正文未能提取额度' end"""


def notices(spark, sf):
    orders = b.table(spark, sf, "orders").withColumn("amount", F.expr("cast(floor(o_totalprice) as bigint)"))
    return orders.select(
        b.code_of("o_custkey").alias("code"), F.col("o_orderkey").cast("string").alias("announcement_id"),
        F.expr("cast(o_orderdate as date)").alias("published_date"), F.lit("u").alias("source_url"),
        F.expr(NOTICE).alias("text"), F.lit(None).cast("string").alias("error"), F.col("o_orderkey").alias("notice_seq"))


@query("txt04_notice_roundtrip", """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS announcement_id, o_orderpriority AS p,
  CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice) AS BIGINT) AS a FROM orders)
SELECT announcement_id, CAST(0 AS BIGINT) AS transition_seq, d AS effective_date, CASE p WHEN '1-URGENT' THEN a END AS direct_amount_cny,
  CASE p WHEN '1-URGENT' THEN a + 7 END AS agency_amount_cny, CASE p WHEN '1-URGENT' THEN a WHEN '2-HIGH' THEN a WHEN '3-MEDIUM' THEN a END AS global_amount_cny,
  CASE p WHEN '4-NOT SPECIFIED' THEN 'unlimited' ELSE 'limited' END AS global_status,
  CASE p WHEN '2-HIGH' THEN 'A/C separate' END AS share_aggregation, CASE p WHEN '4-NOT SPECIFIED' THEN 'medium' ELSE 'high' END AS confidence
FROM o WHERE p <> '5-LOW' AND p <> '3-MEDIUM'
UNION ALL SELECT announcement_id, 0, DATE '2003-05-06', NULL, NULL, a, 'limited', NULL, 'high' FROM o WHERE p = '3-MEDIUM'""")
def notice_roundtrip(spark, sf):
    """TXT-01 to TXT-04."""
    return doc.parse_notices(notices(spark, sf)).select(
        "announcement_id", F.col("transition_seq").cast("long").alias("transition_seq"), "effective_date",
        "direct_amount_cny", "agency_amount_cny", "global_amount_cny", "global_status", "share_aggregation", "confidence")


@query("txt04_failed_notices", "SELECT CAST(o_orderkey AS VARCHAR) AS announcement_id FROM orders WHERE o_orderpriority = '5-LOW'")
def failed_notices(spark, sf):
    docs = notices(spark, sf)
    return doc.failed_notices(docs, doc.parse_notices(docs)).select("announcement_id")


REPORT = """concat('4.期末基金资产\\n净值\\n人民币A类 ', format_number(c_custkey + 1, 0), ',000,00\\n0.00\\n人民币C类 ',
 format_number(c_custkey + 1, 0), ',000,000.00\\n5.期末基金份额\\n净值 1.00\\n5.1 报告期末基金资产组合情况\\n1 权益投资 20.00 20.00\\n2 基金投资 ',
 if(c_mktsegment = 'BUILDING', '- -', concat(format_number(c_custkey + 1, 0), ',000,000.00 50.00')),
 '\\n9 合计 100.00 100.00\\n5.2 报告期末在各个国家（地区）证券市场的股票及存托 凭证投资分布\\n国家 公允价值 比例\\n',
 if(c_nationkey < 5, '日本', '美国'), ' 10.00 ', c_nationkey, '.25\\n合计 20.00 20.00\\n5.3 行业分类\\n',
 '5.9 报告期末按公允价值排序的前十名基金投资明细\\n1 TEST ', c_mktsegment, ' FUND ETF基金 交易型开放式 Manager 400.00 ',
 c_nationkey, '.50\\n2 GOLD\\nTRUST 商 品 型 开放式 Manager 7.00 3.', 10 + c_nationkey, '\\n5.10 投资组合报告附注\\n')"""


def reports(spark, sf):
    return b.table(spark, sf, "customer").select(
        b.code_of("c_custkey").alias("code"), b.code_of("c_custkey").alias("announcement_id"), F.expr(REPORT).alias("text"))


@query("txt08_report_totals", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS announcement_id,
  CASE WHEN c_nationkey < 5 THEN 0 ELSE c_nationkey + CAST(0.25 AS DOUBLE) END AS direct_us_pct,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 50 END AS DOUBLE) AS fund_investment_pct, CAST(NULL AS VARCHAR) AS report_issue FROM customer""")
def report_totals(spark, sf):
    """TXT-08, TXT-09 and AG-16: net assets of two classes, one split over lines."""
    return doc.parse_report_totals(reports(spark, sf)).drop("code")


@query("txt07_holdings_roundtrip", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS announcement_id, CAST(1 AS BIGINT) AS rank,
  concat('TEST ', c_mktsegment, ' FUND') AS fund_name, c_nationkey + CAST(0.5 AS DOUBLE) AS weight_pct, CAST(NULL AS VARCHAR) AS reported_category FROM customer
UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 2, 'GOLD TRUST', 7, 'commodity' FROM customer""")
def holdings_roundtrip(spark, sf):
    """TXT-07 and WIN-10; the first percentage up to 100 is the weight."""
    rows = doc.parse_holdings(reports(spark, sf).withColumn("text", F.replace("text", F.lit("Manager 400.00 "), F.lit("Manager 4,000.00 "))))
    return rows.select("announcement_id", F.col("rank").cast("long").alias("rank"), "fund_name", "weight_pct", "reported_category")


STATEMENT = """concat('前言。本基金的业绩比较基准为', case
 when c_mktsegment = 'AUTOMOBILE' then concat(c_nationkey + 50, '%×纳斯达克100指数收益率+', 50 - c_nationkey, '%×活期存款利率')
 when c_mktsegment = 'BUILDING' then concat(c_nationkey + 50, '% × 标普500 指数收益率 ＋ ', 50 - c_nationkey, '%×恒生指数收益率')
 when c_mktsegment = 'FURNITURE' then concat('德国DAX指数×', c_nationkey + 40, '%')
 when c_mktsegment = 'HOUSEHOLD' then 'MSCI世界指数收益率'
 else '某某未知指数收益率' end, '。风险收益特征')"""


@query("txt06_benchmark_roundtrip", """WITH c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS announcement_id, c_mktsegment AS s, c_nationkey AS n FROM customer)
SELECT announcement_id, 'nasdaq-100' AS benchmark_id, n + CAST(50 AS DOUBLE) AS weight_pct FROM c WHERE s = 'AUTOMOBILE'
UNION ALL SELECT announcement_id, 'sp-500', n + 50 FROM c WHERE s = 'BUILDING' UNION ALL SELECT announcement_id, 'hang-seng', 50 - n FROM c WHERE s = 'BUILDING'
UNION ALL SELECT announcement_id, 'dax', n + 40 FROM c WHERE s = 'FURNITURE' UNION ALL SELECT announcement_id, 'msci-world', 100 FROM c WHERE s = 'HOUSEHOLD'""")
def benchmark_roundtrip(spark, sf):
    """TXT-05, TXT-06 and JN-05 with the default catalog."""
    docs = b.table(spark, sf, "customer").select(
        b.code_of("c_custkey").alias("code"), b.code_of("c_custkey").alias("announcement_id"),
        F.col("c_name").alias("fund_name"), F.expr(STATEMENT).alias("text"))
    _, components = doc.parse_benchmarks(docs, load_benchmarks(spark))
    return components.select("announcement_id", "benchmark_id", "weight_pct")


@query("jn12_compare_components", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, CASE WHEN c_acctbal < 0 THEN 'missing'
  WHEN c_mktsegment = 'MACHINERY' THEN 'unreadable' WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 5000 THEN 'conflict' ELSE 'matched' END AS product_summary_status FROM customer""")
def compare_components(spark, sf):
    """Prospectus against summary; cheap household accounts name another index."""
    base = b.table(spark, sf, "customer").withColumn("text", F.expr(STATEMENT)).select(
        b.code_of("c_custkey").alias("code"), b.code_of("c_custkey").alias("announcement_id"), "c_acctbal", "c_mktsegment",
        F.col("c_name").alias("fund_name"), "text")
    catalog = load_benchmarks(spark)
    other = base.where("c_acctbal >= 0").withColumn("text", F.expr(
        "case when c_mktsegment = 'HOUSEHOLD' and c_acctbal < 5000 then replace(text, 'MSCI世界指数', '日经225指数') else text end"))
    left = doc.benchmark_profiles(*doc.parse_benchmarks(base, catalog))
    right = doc.benchmark_profiles(*doc.parse_benchmarks(other, catalog))
    return doc.compare_components(left, right)


@query("txt10_cost_roundtrip", """SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS announcement_id,
  CASE WHEN s_acctbal >= 0 AND s_nationkey < 20 THEN s_nationkey + CAST(0.25 AS DOUBLE) END AS annualized_pct,
  CASE WHEN s_acctbal < 0 THEN 'expense_missing' WHEN s_nationkey >= 20 THEN 'measurement_in_future' END AS cost_issue FROM supplier""")
def cost_roundtrip(spark, sf):
    text = ("case when s_acctbal < 0 then '未披露综合费率' else concat('基金运作综合费率\\n（ 年化 ） ', s_nationkey, '.25% 注：综合费率测算日期为 ',"
            " if(s_nationkey < 20, 2000, 2030), ' 年 8 月 3 日。') end")
    docs = b.table(spark, sf, "supplier").select(
        b.code_of("s_suppkey").alias("code"), b.code_of("s_suppkey").alias("announcement_id"), F.expr(text).alias("text"))
    return doc.parse_costs(docs, as_of=b.AS_OF).select("announcement_id", "annualized_pct", "cost_issue")


_STRIPPED = ("trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '),"
             " '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))")


@query("fn10_html_extract", f"""SELECT CAST(page_id AS BIGINT) AS page_id, md5({_STRIPPED}) AS digest, CAST(length({_STRIPPED}) AS BIGINT) AS chars,
  CAST(length(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>')) AS BIGINT) AS items FROM pages""")
def html_extract(spark, sf):
    """FN-10 and the cells of SRC-06 on whole pages."""
    text = strip_tags(F.col("html"))
    items = F.aggregate(F.transform(raw.html_cells(F.concat(F.lit("<all>"), "html", F.lit("</all>")), "all", "li"), F.size), F.lit(0), lambda a, n: a + n)
    return b.table(spark, sf, "pages").select(
        "page_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("chars"), items.cast("long").alias("items"))


@query("fn14_text_labels", """SELECT CAST(event_id AS BIGINT) AS event_id, CASE event_type WHEN 'click' THEN 'inverse' WHEN 'view' THEN 'leveraged'
  WHEN 'error' THEN 'volatility' ELSE 'standard' END AS structure, CASE event_type WHEN 'click' THEN 'A/C combined' WHEN 'view' THEN 'A/C separate' END AS share FROM events""")
def text_labels(spark, sf):
    """FN-14 and FN-15."""
    text = F.expr("concat('基金', user_id, case event_type when 'click' then ' 两倍做多 Inverse A类份额与C类份额合并计算' when 'view' then ' 三倍 杠杆 分 别计算'"
                  " when 'error' then '波动率' else '普通' end)")
    return b.table(spark, sf, "events").select(
        "event_id", product_structure(text, F.lit("standard")).alias("structure"), share_aggregation(text).alias("share"))


@query("snk03_incremental_parse", """WITH c AS (SELECT c_mktsegment AS s, c_acctbal >= 0 AS early FROM customer),
r(run, fresh, late) AS (VALUES ('first', true, false), ('second', false, true), ('third', false, false), ('changed catalog', true, true)),
t AS (SELECT s, early, CASE s WHEN 'BUILDING' THEN 2 WHEN 'AUTOMOBILE' THEN 1 WHEN 'FURNITURE' THEN 1 WHEN 'HOUSEHOLD' THEN 1 ELSE 0 END AS n FROM c)
SELECT run, CAST(count(*) FILTER (WHERE (early AND fresh) OR (NOT early AND late)) AS BIGINT) AS parsed,
  CAST(count(*) FILTER (WHERE n > 0 AND (early OR run <> 'first')) AS BIGINT) AS recognized,
  CAST(sum(CASE WHEN early OR run <> 'first' THEN n ELSE 0 END) AS BIGINT) AS components FROM r, t GROUP BY run""")
def incremental_parse(spark, sf):
    """Statements of the customers in credit, then of all, then again, then with one changed catalog entry."""
    docs = b.table(spark, sf, "customer").select(
        b.code_of("c_custkey").alias("code"), b.code_of("c_custkey").alias("announcement_id"),
        F.col("c_name").alias("fund_name"), F.lit("").alias("fund_identity"), "c_acctbal")
    texts = b.table(spark, sf, "customer").select(
        b.code_of("c_custkey").alias("announcement_id"), F.expr(STATEMENT).alias("text"), F.lit(None).cast("string").alias("error"))
    catalog = load_benchmarks(spark)
    changed = catalog.withColumn("display_name", F.when(F.col("id") == "dax", "DAX 40").otherwise(F.col("display_name")))
    store, rows = Store(f"{checkpoint_folder(spark)}/parsed-{uuid.uuid4().hex}"), []
    known = 0
    for name, some, entries in (("first", docs.where("c_acctbal >= 0"), catalog), ("second", docs, catalog),
                                ("third", docs, catalog), ("changed catalog", docs, changed)):
        def parse(pending, entries=entries):
            return doc.benchmark_profiles(*doc.parse_benchmarks(pending, entries)).withColumn("fund_identity", F.lit(""))

        profiles = parse_once(store, "benchmarks", some.drop("c_acctbal"), texts, parse, catalog_fingerprint(entries))
        total = stored_documents(docs, store, "benchmarks").count()
        rows.append(staged(profiles.agg(
            F.lit(name).alias("run"), F.lit(total - known).cast("long").alias("parsed"), F.count_if(F.size("components") > 0).alias("recognized"),
            F.sum(F.size("components")).alias("components"))))
        known = total
    return union_all(rows)


NEAREST = """concat('投资者通过直销机构上限', format_number(amount, 0), '元；代销机构上限', amount + 7, '万元。自2003年5月6日起恢复，累计申购金额不超过', amount + 1,
 '元。自2004年1月1日起，调整为累计申购金额不超过', amount + 2, '万元。自2005年2月', 1 + day(o_orderdate) % 28, '日起，暂停累计申购金额不得超过人民币', amount + 3, '元的业务。',
 if(o_orderstatus = 'F', '自2006年1月1日起，召开会议，申购金额不超过9元。', ''))"""


@query("txt02_nearest_amounts", """WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_orderdate AS DATE) AS d, CAST(floor(o_totalprice) AS BIGINT) AS a FROM orders)
SELECT k AS announcement_id, CAST(0 AS BIGINT) AS transition_seq, DATE '2003-05-06' AS effective_date, a AS direct_amount_cny, (a + 7) * 10000 AS agency_amount_cny,
  a + 1 AS global_amount_cny FROM o
UNION ALL SELECT k, 2, DATE '2004-01-01', NULL, NULL, (a + 2) * 10000 FROM o
UNION ALL SELECT k, 3, make_date(2005, 2, 1 + day(d) % 28), NULL, NULL, a + 3 FROM o""")
def nearest_amounts(spark, sf):
    """TXT-02 by the nearest amounts beside a limit word, and TXT-04 with several later changes; one sentence changes nothing."""
    found = doc.parse_notices(notices(spark, sf).join(
        b.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("announcement_id"), F.expr(NEAREST.replace("amount", "cast(floor(o_totalprice) as bigint)")).alias("t")),
        "announcement_id").withColumn("text", F.col("t")).drop("t"))
    return found.select("announcement_id", F.col("transition_seq").cast("long").alias("transition_seq"), "effective_date",
                        "direct_amount_cny", "agency_amount_cny", "global_amount_cny")


# Statements in the middle of whole documents, behind a preface longer than the opening that a fallback reads.
EMBEDDED = """concat(repeat('前言。', 1100), text, case doc_id % 4
 when 0 then concat('。本基金的业绩比较基准为', doc_id % 50 + 50, '%×标普500指数收益率。风险收益特征')
 when 1 then concat(' 业绩比较基准 ', doc_id % 50 + 40, '%×纳斯达克100指数收益率；风险收益特征')
 when 2 then '。业绩比较基准：标的指数收益率。本基金为'
 else concat('。业绩比较基准为德国DAX指数。业绩比较基准采用', doc_id % 50 + 1, '%×恒生指数收益率+5%×活期存款利率。如果今后') end, text)"""


@query("txt05_embedded_statements", """SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE doc_id % 4 WHEN 0 THEN 'sp-500' WHEN 3 THEN 'hang-seng' ELSE 'nasdaq-100' END AS benchmark_id,
  CAST(CASE doc_id % 4 WHEN 0 THEN doc_id % 50 + 50 WHEN 1 THEN doc_id % 50 + 40 WHEN 2 THEN 100 ELSE doc_id % 50 + 1 END AS DOUBLE) AS weight_pct FROM documents""")
def embedded_statements(spark, sf):
    """TXT-05 in whole documents: both headings, a weighted statement after a plain one, and the fallback to the fund's name."""
    docs = b.table(spark, sf, "documents").select(
        b.code_of("doc_id").alias("code"), F.col("doc_id").cast("string").alias("announcement_id"),
        F.expr("if(doc_id % 4 = 2, '纳斯达克100指数基金', '基金')").alias("fund_name"), F.expr(EMBEDDED).alias("text"))
    _, components = doc.parse_benchmarks(docs, load_benchmarks(spark))
    return components.select(F.col("announcement_id").cast("long").alias("doc_id"), "benchmark_id", "weight_pct")


# Reports inside whole documents; five of six lack one thing each.
EMBEDDED_REPORT = """case when doc_id % 6 = 1 then null else concat(text, '\n', if(doc_id % 6 = 5, '', '4.期末基金资产净值\n人民币A类 200.00\n5.期末基金份额净值 1.00\n'),
 if(doc_id % 6 = 3, '', concat('5.1 报告期末基金资产组合情况\n1 权益投资 20.00 20.00\n2 基金投资 ', if(doc_id % 6 = 4, '', '100.00 50.00'), '\n9 合计 100.00 100.00\n')),
 if(doc_id % 6 = 2, '', '5.2 报告期末在各个国家（地区）证券市场的权益投资分布\n国家 公允价值 比例\n美国 10.00 12.25\n5.3 行业分类\n'),
 '5.9 报告期末按公允价值排序的前十名基金投资明细\n1 SHORT ETF基金 交易型 9.00 ', doc_id % 50, '.50 GLOBAL TECH ETF\n2 AGGREGATE INCOME TOTAL 债 券 型 开放式 Manager 7.00 3.',
 10 + doc_id % 50, '\n3 基金 7\n5.10 投资组合报告附注\n', text) end"""


def embedded_reports(spark, sf):
    return b.table(spark, sf, "documents").select(
        b.code_of("doc_id").alias("code"), F.col("doc_id").cast("string").alias("announcement_id"), F.expr(EMBEDDED_REPORT).alias("text"))


@query("txt08_report_issues", """SELECT CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN doc_id % 6 = 0 THEN CAST(12.25 AS DOUBLE) END AS direct_us_pct,
  CASE WHEN doc_id % 6 = 0 THEN CAST(50 AS DOUBLE) END AS fund_investment_pct, CASE doc_id % 6 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'country_table_missing'
  WHEN 3 THEN 'asset_table_missing' WHEN 4 THEN 'fund_amount_missing' WHEN 5 THEN 'net_assets_missing' END AS report_issue FROM documents""")
def report_issues(spark, sf):
    """TXT-08: every issue a report can have, in whole documents."""
    return doc.parse_report_totals(embedded_reports(spark, sf)).select(
        F.col("announcement_id").cast("long").alias("doc_id"), "direct_us_pct", "fund_investment_pct", "report_issue")


@query("txt07_embedded_holdings", """SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(r AS BIGINT) AS rank,
  CASE r WHEN 1 THEN 'SHORT GLOBAL TECH ETF' WHEN 2 THEN 'AGGREGATE INCOME TOTAL' END AS fund_name,
  CASE r WHEN 1 THEN CAST(9 AS DOUBLE) WHEN 2 THEN 7 ELSE 5.1 END AS weight_pct, CASE r WHEN 2 THEN 'fixed_income' END AS reported_category,
  CASE r WHEN 3 THEN 'holding_row_unreadable' END AS row_issue FROM documents, range(1, 4) t(r) WHERE doc_id % 6 <> 1""")
def embedded_holdings(spark, sf):
    """TXT-07: a name that goes on behind the numbers, a bond fund and a row that cannot be read, in whole documents."""
    return doc.parse_holdings(embedded_reports(spark, sf)).select(
        F.col("announcement_id").cast("long").alias("doc_id"), F.col("rank").cast("long").alias("rank"), "fund_name", "weight_pct",
        "reported_category", "row_issue")
