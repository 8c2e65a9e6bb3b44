"""Bindings of the given star-schema tables to the fund domain tables.

Nothing is sampled: each binding covers its whole source table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom import schemas
from navloom.functions.text import normalize_instrument, normalize_name
from navloom.sources.catalogs import _with_aliases

AS_OF = date(2001, 6, 30)
EVENTS_AS_OF = date(2024, 1, 25)
RUN_AS_OF = date(2001, 7, 25)
NOTICES_AS_OF = date(2025, 6, 30)
# Days between the event log and the price history, for the run over both.
EVENT_SHIFT = 8220


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of(column: str):
    return F.expr(f"lpad(cast({column} as string), 6, '0')")


def _nav(rows: DataFrame, key: str) -> DataFrame:
    daily = rows.groupBy(code_of(key).alias("code"), F.expr("cast(l_shipdate as date)").alias("date")).agg(
        F.expr("max(l_extendedprice / l_quantity)").alias("nav"),
        F.expr("max(l_discount)").alias("discount"), F.expr("max(l_tax)").alias("tax"))
    return daily.selectExpr(
        "code", "date", "nav", "cast(rint(tax * 100) as double) as equity_return_pct",
        "case when discount >= 0.095D then concat('每份派现金', cast(rint(tax * 100) as int), '元')"
        " when discount < 0.005D then '份额折算' else '' end as unit_money")


def nav_by_supplier(spark, sf) -> DataFrame:
    return _nav(table(spark, sf, "lineitem"), "l_suppkey")


def nav_by_nation(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return _nav(lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey), "s_nationkey")


def index_levels(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.expr("cast(o_orderdate as date)").alias("date")).agg(
        F.max("o_totalprice").alias("value"))


def fx_rates(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.expr("cast(o_orderdate as date)").alias("date")).agg(
        (F.min("o_totalprice") / 1000).alias("value"))


SEGMENT = """case c_mktsegment when 'AUTOMOBILE' then '科技' when 'BUILDING' then '亚洲'
 when 'FURNITURE' then '中国' when 'HOUSEHOLD' then '消费' else 'ETF' end"""
SUFFIX = """case when c_nationkey < 5 then '人民币A' when c_nationkey < 10 then '(QDII)A'
 when c_nationkey < 14 then 'C' when c_nationkey < 18 then '美元A' when c_nationkey < 21 then '人民币C'
 else '联接A' end"""
FUND_TYPE = """case c_nationkey % 5 when 0 then 'QDII-股票' when 1 then 'QDII-FOF' when 2 then 'QDII-纯债'
 when 3 then '指数型-海外股票' else '股票型' end"""


def funds(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        code_of("c_custkey").alias("code"),
        F.expr(f"concat('环球', {SEGMENT}, {SUFFIX})").alias("name"), F.expr(FUND_TYPE).alias("fund_type"))


HALF_YEAR = """case when month({0}) <= 6 then make_date(year({0}), 6, 30)
 else make_date(year({0}), 12, 31) end"""
PERIOD_KEY = "concat(cast(year({0}) as {1}), case when month({0}) <= 6 then '_2' else '_4' end)"


def holders(spark, sf) -> DataFrame:
    key = F.expr(PERIOD_KEY.format("o_orderdate", "string")).alias("period_key")
    return table(spark, sf, "orders").groupBy(key, code_of("o_custkey").alias("code")).agg(
        (F.max("o_totalprice") / 6000).alias("institution_pct"))


def holder_periods(spark, sf) -> DataFrame:
    day = F.expr(HALF_YEAR.format("o_orderdate")).alias("report_date")
    key = F.expr(PERIOD_KEY.format("o_orderdate", "string")).alias("period_key")
    # Distinct pairs first, so that no half year counts its customers in one task.
    pairs = table(spark, sf, "orders").select(day, key, "o_custkey").distinct()
    return pairs.groupBy("report_date", "period_key").agg(F.count(F.lit(1)).alias("fund_count"))


STATUS = """case when c_acctbal < 0 then 'suspended' when c_acctbal < 3000 then 'limited'
 when c_acctbal < 9000 then 'open' else 'unknown' end"""


def fund_pages(spark, sf) -> DataFrame:
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.expr("cast(min(o_orderdate) as date)").alias("inception_date"))
    customers = table(spark, sf, "customer")
    return customers.join(first, customers.c_custkey == first.o_custkey, "left").select(
        code_of("c_custkey").alias("code"), "inception_date",
        (F.col("c_acctbal") / 100).alias("scale_100m_cny"), F.expr(STATUS).alias("purchase_status"),
        F.expr("case when c_acctbal >= 0 and c_acctbal < 3000 then cast(floor(c_acctbal) as bigint) end")
        .alias("page_agency_limit_cny"),
        F.concat(F.lit("https://page.test/"), F.col("c_custkey").cast("string")).alias("fund_page_url"))


def _event_day(shift: int) -> str:
    return f"date_sub(cast(ts as date), {shift})"


def transitions(spark, sf, shift: int = 0) -> DataFrame:
    day = _event_day(shift)
    return table(spark, sf, "events").where("event_type <> 'error'").selectExpr(
        "lpad(cast(user_id as string), 6, '0') as code", "event_id as notice_seq", "0 as transition_seq",
        f"date_add({day}, case when value > 50 then 3 else 0 end) as effective_date",
        f"{day} as published_date",
        "case when event_type = 'click' then cast(floor(value) as bigint) end as direct_amount_cny",
        "case when event_type = 'view' then cast(floor(value) as bigint) end as agency_amount_cny",
        "case when event_type = 'purchase' then cast(floor(value) as bigint) end as global_amount_cny",
        "case when event_type = 'signup' then 'unlimited' end as global_status",
        "case when value > 100 then 'A/C separate' when value < 1 then 'A/C combined' end as share_aggregation",
        "event_type = 'purchase' and value > 300 as all_channels_combined",
        "case when event_type = 'purchase' then 'high' else 'medium' end as confidence",
        "concat('https://notice.test/', cast(event_id as string)) as source_url")


def failed_notices(spark, sf, shift: int = 0) -> DataFrame:
    """Every error event is an unreadable notice; five neighbouring users share the fund it belongs to.

    So each event counts, and funds without an unreadable notice remain.
    """
    return table(spark, sf, "events").where("event_type = 'error'").selectExpr(
        "lpad(cast(user_id - user_id % 5 as string), 6, '0') as code", f"{_event_day(shift)} as published_date")


def instruments(spark) -> DataFrame:
    """Words of part names as look-through instruments, with unusable entries between."""
    rows = [
        (0, ["BLUE BOLT", "RED BOLT"], "us_equity", 100.0, None, "a", "https://i.test/0"),
        (1, ["BOLT"], "global_equity", 62.0, date(1998, 3, 1), "b", "https://i.test/1"),
        (2, ["GEAR"], "non_us_equity", 0.0, None, "c", "https://i.test/2"),
        (3, ["RED"], "us_equity", 100.0, None, "d", ""),
        (4, ["RING", "GIZMO"], "global_equity", 40.0, date(1998, 6, 1), "e", "https://i.test/4"),
        (5, ["HOT", ""], "fixed_income", 0.0, None, "f", "https://i.test/5"),
        (6, ["BOLT"], "us_equity", 36.0, None, "g", "https://i.test/6"),
    ]
    return _with_aliases(spark.createDataFrame(rows, schemas.INSTRUMENTS), normalize_instrument)


def holdings(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    reports = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        reports, lines.l_orderkey == reports.o_orderkey)
    return joined.selectExpr(
        "cast(l_orderkey as string) as announcement_id", "l_linenumber as rank", "p_name as fund_name",
        "l_quantity / 2 as weight_pct", "case when l_tax >= 0.075D then 'commodity' end as reported_category",
        "cast(o_orderdate as date) as report_date")


def report_totals(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as announcement_id", "cast(o_orderdate as date) as report_date",
        "cast(o_custkey % 45 as double) as direct_us_pct",
        "cast(o_custkey % 80 as double) as fund_investment_pct", "o_orderpriority as name",
        "concat('https://report.test/', cast(o_orderkey as string)) as source_url")


def premium_catalog(spark, sf) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr("o_custkey", "day(o_orderdate) as d").distinct()
    return rows.selectExpr(
        "concat(cast(o_custkey as string), '-', cast(d as string)) as code",
        "concat('fund ', cast(o_custkey as string)) as name",
        "case when d % 2 = 1 then 'SSE' else 'SZSE' end as exchange", "cast(d % 2 as int) as market_id",
        "'broad_market' as category", "'标普500' as benchmark_group", "'https://etf.test/' as source_url")


def quotes(spark, sf) -> DataFrame:
    price = "case when event_type = 'signup' and value < 5 then 0D else value + 1 end"
    rows = table(spark, sf, "events").withColumn("price", F.expr(price))
    return rows.selectExpr(
        "concat(cast(user_id as string), '-', cast(day(ts) as string)) as code", "event_id as arrival", "price",
        "case when event_type = 'view' and value > 200 then cast(null as double) else price * 0.98D end as iopv",
        "case when event_type = 'error' then -3.04D else -2.04D end as source_discount_pct",
        "value / 100 as change_pct", "value * 1000 as turnover_cny",
        "date_format(ts, 'yyyyMMdd') as quote_date_raw", "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as updated_seconds",
        "'' as quote_name")


def cached_quotes(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat(cast(o_custkey as string), '-', cast(day(o_orderdate) as string)) as code",
        "o_orderkey as seq", "o_totalprice / 1000 as market_price_cny", "o_totalprice / 1010 as iopv_cny",
        "-1D as source_discount_pct", "1D as premium_pct", "0.5D as change_pct",
        "case when o_orderstatus = 'P' then -1D else o_totalprice end as turnover_cny",
        "date'2024-01-10' as quote_date", "timestamp'2024-01-10 12:00:00' as updated_at",
        "'https://quote.test/' as quote_source_url")


TITLE = """case doc_id % 6
 when 0 then concat('某基金', cast(2023 + doc_id % 2 as string), '年第', cast(1 + doc_id % 4 as string), '季度报告')
 when 1 then '某基金招募说明书（更新）'
 when 2 then case when n_chars % 3 = 0 then '某基金(C类份额)基金产品资料概要更新' else '某基金(A类份额)基金产品资料概要更新' end
 when 3 then '关于调整大额申购限制金额的公告'
 when 4 then '某基金二〇二四年年度报告摘要'
 else '关于恢复大额申购业务的公告' end"""


def announcements(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.expr("lpad(cast(n_chars % 97 as string), 6, '0')").alias("code"),
        F.expr("lpad(cast(doc_id as string), 9, '0')").alias("announcement_id"),
        F.expr(TITLE).alias("title"),
        F.expr("date_add(date'2024-01-01', cast(doc_id % 700 as int))").alias("published_date"),
        (F.col("n_chars") % 2 == 0).alias("on_latest_page"))


def word_catalog(spark) -> DataFrame:
    """A benchmark catalog of frequent letter groups of the documents."""
    rows = [(i, f"w{i}", f"word {i}", aliases, "us", "美国", "equity", "宽基", "standard", False)
            for i, aliases in enumerate([["the and", "of the"], ["tion"], ["que", "eau x"], ["ung"], ["zzzz"]])]
    return _with_aliases(spark.createDataFrame(rows, schemas.BENCHMARKS), normalize_name)
