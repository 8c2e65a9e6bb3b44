"""Raw payload loaders: payload texts composed from columns, one per source row."""

from pyspark.sql import functions as F

from navloom.sources import raw
from workload import bindings as b
from workload.registry import query


@query("src01_load_funds", """SELECT lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS code, arg_max(c_name, c_custkey) AS name,
  arg_max(c_mktsegment, c_custkey) AS fund_type FROM customer GROUP BY c_nationkey""")
def load_funds(spark, sf):
    """Later duplicates of a code win, rows below four items are dropped."""
    payload = ("concat('var r = [[\"', lpad(cast(c_nationkey as string), 6, '0'), '\",\"X\",\"', c_name, '\",\"', c_mktsegment,"
               " '\",\"P\"],[\"short\",\"row\"]];')")
    return raw.load_funds(b.table(spark, sf, "customer").select(F.col("c_custkey").alias("seq"), F.expr(payload).alias("payload"))).rows


@query("src02_load_holder_periods", """WITH p AS (SELECT CAST(o_orderdate AS DATE) AS d, o_custkey AS n, o_orderstatus AS s FROM orders)
SELECT d AS report_date, CAST(n AS BIGINT) AS fund_count, concat(CAST(year(d) AS VARCHAR), CASE month(d) WHEN 6 THEN '_2' ELSE '_4' END) AS period_key
FROM p WHERE month(d) IN (6, 12) AND s <> 'P'""")
def load_holder_periods(spark, sf):
    payload = ("concat('var d={data:[[\"', date_format(o_orderdate, 'yyyy-MM-dd'), '\",\"', if(o_orderstatus = 'P', '', cast(o_custkey as string)),"
               " '\"],[\"short\"]],record:1}')")
    return raw.load_holder_periods(b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), F.expr(payload).alias("payload"))).rows


@query("src03_load_holders", """SELECT lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code, CAST(l_orderkey AS BIGINT) AS page,
  l_quantity AS institution_pct, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_tax + 0.0 END AS personal_pct,
  CAST(l_partkey + 1000 AS DOUBLE) AS total_shares_100m FROM lineitem WHERE l_returnflag <> 'R'""")
def load_holders(spark, sf):
    """Blank institution shares are dropped, blank personal shares stay null."""
    payload = ("concat('{data:[[\"', lpad(cast(l_suppkey as string), 6, '0'), '\",\"x\",\"', if(l_returnflag = 'R', '', cast(l_quantity as string)), '\",\"',"
               " if(l_returnflag = 'A', '', cast(l_tax + 0.0D as string)), '\",\"\",\"', format_number(l_partkey + 1000, 0), '\"]],record:9,pages:\"1\"}')")
    pages = b.table(spark, sf, "lineitem").select(F.lit("2001_2").alias("period_key"), F.col("l_orderkey").alias("page"), F.expr(payload).alias("payload"))
    return raw.load_holders(pages).rows.select("code", "page", "institution_pct", "personal_pct", "total_shares_100m")


@query("src04_load_nav", """WITH p AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code, CAST(l_shipdate + INTERVAL 8 HOUR + INTERVAL 17 HOUR AS DATE) AS date,
  l_extendedprice AS nav, l_tax + 0.0 AS r, l_discount > 0.05 AS event FROM lineitem WHERE l_quantity > 1)
SELECT code, date, max(nav) AS nav, arg_max(CASE WHEN event THEN 0 ELSE 1 END, nav) = 1 AS no_return FROM p GROUP BY 1, 2
""")
def load_nav(spark, sf):
    """Epoch milliseconds at 17:00 UTC fall on the next day at +08:00; quantity 1 marks an invalid value."""
    millis = "cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', l_shipdate) * 1000 + 61200000 as bigint)"
    payload = (f"concat('var x=1;var Data_netWorthTrend = [{{\"x\":', {millis}, ',\"y\":', if(l_quantity > 1, cast(l_extendedprice as string), '0'),"
               " ',\"equityReturn\":', if(l_discount > 0.05D, cast(l_tax + 0.0D as string), '\"\"'), ',\"unitMoney\":\"\"}];')")
    rows = b.table(spark, sf, "lineitem").select(b.code_of("l_suppkey").alias("fund"), F.expr(payload).alias("payload"), "l_extendedprice")
    # One history row per payload here: the dearest line of a day stands for its last row.
    loaded = raw.load_nav(rows.select(F.concat_ws("|", "fund", F.col("l_extendedprice").cast("string")).alias("code"), "payload")).rows
    daily = loaded.groupBy(F.element_at(F.split("code", r"\|"), 1).alias("code"), "date").agg(
        F.max("nav").alias("nav"), F.max_by(F.struct("equity_return_pct"), "nav").alias("last"))
    return daily.select("code", "date", "nav", F.col("last.equity_return_pct").isNull().alias("no_return"))


@query("src05_load_index_levels", """SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders
WHERE o_orderdate <= DATE '2001-06-30' GROUP BY 1""")
def load_index_levels(spark, sf):
    millis = "cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate) * 1000 + 86399000 as bigint)"
    payload = f"concat('[{{\"x\":', {millis}, ',\"y\":', cast(o_totalprice as string), '}}]')"
    return raw.load_index_levels(b.table(spark, sf, "orders").select(F.expr(payload).alias("payload")), b.AS_OF).rows


@query("src06_load_fx_html", """SELECT CAST(o_orderdate AS DATE) AS date, max(o_custkey + 0.5) / 100 AS value FROM orders
WHERE o_orderdate <= DATE '2001-06-30' GROUP BY 1""")
def load_fx_html(spark, sf):
    payload = ("concat('<table><TR class=a><td>日期</td><td>USD</td></TR><tr>\\n<td> ', date_format(o_orderdate, 'yyyy-MM-dd'), '</td><td align=x>&nbsp;<b>',"
               " format_number(o_custkey + 0.5D, 2), '</b></td></tr></table>')")
    return raw.load_fx_html(b.table(spark, sf, "orders").select(F.expr(payload).alias("payload")), b.AS_OF).rows


@query("src07_extract_fund_pages", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, DATE '2001-03-04' AS inception_date,
  CASE c_nationkey % 3 WHEN 0 THEN CAST(c_custkey AS DOUBLE) WHEN 1 THEN c_custkey / 2.0 ELSE CAST(0 AS DOUBLE) END AS scale_100m_cny,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'suspended' WHEN 'FURNITURE' THEN 'limited' ELSE 'open' END AS purchase_status,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_custkey * 10000 AS BIGINT) END AS page_agency_limit_cny, c_nationkey + CAST(0.5 AS DOUBLE) AS latest_nav_value
FROM customer WHERE c_acctbal >= 0""")
def extract_fund_pages(spark, sf):
    html = ("concat('规模</a>：', case c_nationkey % 3 when 0 then concat(c_custkey, '亿元') when 1 then concat(c_custkey * 5000, '.00万元') else '0元' end,"
            " if(c_acctbal < 0, '', '（2001-03-31）'), '<span>成 立 日</span>：2001-03-04 交易状态：<b>', case c_mktsegment when 'BUILDING' then '暂停申购'"
            " when 'FURNITURE' then concat('限大额 (单日累计购买上限', c_custkey, '万元)') else '开放申购' end, '</b> 购买手续费',"
            " '单位净值</a></span>(</span>2001-06-01)</p>x<dd class=\"dataNums\"><span class=a>', c_nationkey, '.5</span>')")
    pages = b.table(spark, sf, "customer").select(b.code_of("c_custkey").alias("code"), F.expr(html).alias("html"))
    return raw.extract_fund_pages(pages).rows.select(
        "code", "inception_date", "scale_100m_cny", "purchase_status", "page_agency_limit_cny", "latest_nav_value")


@query("src11_load_quotes", """SELECT CAST(event_id AS BIGINT) AS arrival, CAST(user_id AS VARCHAR) AS code, value AS price,
  CASE WHEN event_type = 'error' THEN NULL ELSE value + 1 END AS iopv FROM events""")
def load_quotes(spark, sf):
    payload = ("concat('{\"data\":{\"diff\":[{\"f12\":\"', user_id, '\",\"f2\":', cast(value as string), ',\"f441\":', if(event_type = 'error', '\"-\"', cast(value + 1 as string)), ',\"f14\":\"n\"}]}}')")
    rows = b.table(spark, sf, "events").select(F.col("event_id").alias("arrival"), F.expr(payload).alias("payload"))
    return raw.load_quotes(rows).rows.select("arrival", "code", "price", "iopv")


ANNOUNCED = ("concat('{\"Data\":[{\"ID\":\"A', o_orderkey, '\",\"TITLE\":\" ', o_orderpriority, ' \",\"PUBLISHDATEDesc\":\"',"
             " case o_orderstatus when 'P' then '31/12/99' when 'F' then date_format(o_orderdate, 'yyyy-MM-dd') else date_format(o_orderdate, 'yyyy-MM-dd HH:mm') end,"
             " '\"},{\"ID\":\"\",\"TITLE\":\"no id\",\"PUBLISHDATEDesc\":\"2001-01-01\"}]', if(o_orderpriority = '5-LOW', ',', '}'))")


def announcement_pages(spark, sf):
    """One page an order: part-filled orders state no date, those of low priority are cut off."""
    return b.table(spark, sf, "orders").select(
        b.code_of("o_custkey").alias("code"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("page"),
        F.expr(ANNOUNCED).alias("payload"))


@query("src08_load_announcements", """SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code, concat('A', CAST(o_orderkey AS VARCHAR)) AS announcement_id,
  o_orderpriority AS title, CAST(o_orderdate AS DATE) AS published_date, o_orderstatus = 'F' AS on_latest_page
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def load_announcements(spark, sf):
    return raw.load_announcements(announcement_pages(spark, sf)).rows


@query("src_bad_payloads", """SELECT reason, CAST(count(*) AS BIGINT) AS issues, CAST(count(DISTINCT place) AS BIGINT) AS places FROM (
  SELECT 'fund_list_unreadable' AS reason, CAST(c_custkey AS VARCHAR) AS place FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT 'holder_periods_unreadable', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL SELECT 'holder_page_unreadable', concat(CAST(s_nationkey AS VARCHAR), '/', CAST(s_suppkey AS VARCHAR)) FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT 'holder_pages_incomplete', CAST(s_nationkey AS VARCHAR) FROM supplier GROUP BY s_nationkey HAVING min(s_acctbal) < 0
  UNION ALL SELECT 'announcement_page_unreadable', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT 'announcement_date_invalid', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
  UNION ALL SELECT 'quote_page_unreadable', CAST(event_id AS VARCHAR) FROM events WHERE event_type IN ('error', 'view')) GROUP BY reason""")
def bad_payloads(spark, sf):
    """Payloads cut off, without their array or of another kind: each is an issue of its loader, none vanishes."""
    funds = raw.load_funds(b.table(spark, sf, "customer").selectExpr(
        "c_custkey as seq", "case c_mktsegment when 'BUILDING' then 'var r = [[\"1\",\"X\"' when 'MACHINERY' then null"
        " else 'var r = [[\"1\",\"X\",\"n\",\"t\"]];' end as payload"))
    periods = raw.load_holder_periods(b.table(spark, sf, "orders").selectExpr(
        "o_orderkey as page", "case o_orderpriority when '1-URGENT' then 'data:[[\"2001-06-30\"' when '2-HIGH' then 'data:[[1],oops],record:1'"
        " else 'data:[[\"2001-06-30\",\"5\"]],record:1' end as payload"))
    # The suppliers of a nation are its pages; the first one states their number.
    pages = b.table(spark, sf, "supplier").selectExpr(
        "cast(s_nationkey as string) as period_key", "row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as page",
        "s_suppkey", "count(*) over (partition by s_nationkey) as n", "s_acctbal < 0 as cut")
    holders = raw.load_holders(pages.selectExpr(
        "period_key", "cast(page as int) as page", "if(cut, 'data:[[', concat('data:[[\"', s_suppkey, '\",\"x\",\"1\",\"2\",\"\",\"3\"]],record:1,pages:\"', n, '\"')) as payload"))
    announced = raw.load_announcements(announcement_pages(spark, sf))
    quotes = raw.load_quotes(b.table(spark, sf, "events").selectExpr(
        "event_id as arrival", "case event_type when 'error' then 'oops' when 'view' then '{\"data\":null}'"
        " else '{\"data\":{\"diff\":[{\"f12\":\"1\"}]}}' end as payload"))
    found = raw.union_all([loaded.issues for loaded in (funds, periods, holders, announced, quotes)])
    place = F.when(F.col("reason").isin("holder_periods_unreadable", "announcement_date_invalid"), F.col("detail")).when(
        F.col("reason") == "holder_page_unreadable", F.concat_ws("/", "code", "detail")).otherwise(F.col("code"))
    return found.where("severity = 'fatal'").groupBy("reason").agg(
        F.count(F.lit(1)).alias("issues"), F.count_distinct(place).alias("places"))


@query("src12_refresh_series", """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS v FROM orders
  WHERE o_orderdate BETWEEN DATE '1998-06-30' - 21 AND DATE '2001-06-30' GROUP BY 1)
SELECT 'good' AS run, CAST((SELECT count(*) FROM s) AS BIGINT) AS points, CAST(0 AS BIGINT) AS fatal, CAST(NULL AS VARCHAR) AS warning
UNION ALL SELECT 'broken', (SELECT count(*) FROM s WHERE month(date) < 4), 0,
  concat('纳指100基准更新失败，使用完整缓存：Index 最新数据 ', CAST((SELECT max(date) FROM s WHERE month(date) < 4) AS VARCHAR), '。')
UNION ALL SELECT 'broken, nothing stored', 0, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') + CASE WHEN (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate <= DATE '2001-06-30') > 0 THEN 0 ELSE 1 END, NULL""")
def refresh_series(spark, sf):
    """New points over the stored ones of spring; where part-filled orders broke the payload, the stored series with a warning."""
    def landed(broken):
        millis = "cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate) * 1000 + 86399000 as bigint)"
        whole = f"concat('[{{\"x\":', {millis}, ',\"y\":', cast(day(o_orderdate) + 1 as string), '}}]')"
        payload = f"if(o_orderstatus = 'P', '[{{', {whole})" if broken else whole
        return raw.load_index_levels(b.table(spark, sf, "orders").select(F.expr(payload).alias("payload")), b.AS_OF)

    series = b.index_levels(spark, sf).select("date", "value")
    stored = series.where(F.month("date") < 4)
    rows = []
    for name, old, new in (("good", stored, landed(False)), ("broken", stored, landed(True)),
                           ("broken, nothing stored", stored.where("false"), landed(True))):
        loaded, warnings = raw.refresh_series(old, new, b.AS_OF, "Index")
        points = loaded.rows.agg(F.count(F.lit(1)).alias("points"))
        fatal = loaded.issues.agg(F.count_if(F.col("severity") == "fatal").alias("fatal"))
        warned = warnings.agg(F.max("text").alias("warning"))
        rows.append(points.join(F.broadcast(fatal), F.lit(True)).join(F.broadcast(warned), F.lit(True)).select(F.lit(name).alias("run"), "points", "fatal", "warning"))
    return raw.union_all(rows)
