"""The full ranking run over suppliers, and the ranking operators on it."""

from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.operators import ranking as rank
from navloom.operators import runs
from navloom.operators import validation as val
from navloom.plans import ranking as plan
from workload import bindings as b
from workload.q_quota import state_cte, state_select
from workload.q_timeseries import RECORD_CTE, RECORD_COLUMNS, RECORD_JOINS, bench_cte, fit_select, nav_cte
from workload.registry import query

DAY = "DATE '2001-07-25'"
TOP, MIN_OBS, LIMIT = 10, 60, 20


def tables(spark, sf) -> plan.Tables:
    """Suppliers as funds: prices, holders and holdings from their lines, notices from events."""
    code = b.code_of("s_suppkey").alias("code")
    suppliers = b.table(spark, sf, "supplier")
    lines = b.table(spark, sf, "lineitem")
    line_code = b.code_of("l_suppkey").alias("code")
    funds = suppliers.select(code, F.expr(
        "case when s_nationkey < 5 then '环球亚洲人民币A' when s_nationkey < 22 then '环球成长(QDII)A'"
        " when s_nationkey = 22 then '环球成长C' else '环球ETF人民币A' end").alias("name"),
        F.expr("case s_nationkey % 6 when 0 then 'QDII-股票' when 1 then 'QDII-FOF' when 2 then '指数型-海外股票'"
               " when 3 then 'QDII-混合' when 4 then 'QDII-普通股票' else 'QDII-商品' end").alias("fund_type"))
    held = lines.where("l_shipdate <= date'2001-07-25'")
    key = F.expr(b.PERIOD_KEY.format("l_shipdate", "string")).alias("period_key")
    holders = held.groupBy(key, line_code).agg((F.max("l_extendedprice") / 2000).alias("institution_pct"))
    day = F.expr(b.HALF_YEAR.format("l_shipdate")).alias("report_date")
    periods = held.groupBy(day, key).agg(F.count(F.lit(1)).alias("fund_count"))
    first = lines.groupBy(line_code).agg(F.expr("cast(min(l_shipdate) as date)").alias("inception_date"))
    pages = suppliers.select(code, (F.col("s_acctbal") / 100).alias("scale_100m_cny"), F.expr(
        "case when s_acctbal < 0 then 'suspended' when s_acctbal < 3000 then 'limited' else 'open' end")
        .alias("purchase_status"), F.expr(
        "case when s_acctbal >= 0 and s_acctbal < 3000 then cast(floor(s_acctbal) as bigint) end")
        .alias("page_agency_limit_cny"), F.lit("https://page.test/").alias("fund_page_url"),
        F.lit("").alias("purchase_status_text"), F.lit(None).cast("date").alias("scale_report_date")).join(first, "code")
    report = F.concat(F.lit("R"), b.code_of("l_suppkey")).alias("announcement_id")
    parts = b.table(spark, sf, "part").select("p_partkey", "p_name")
    named = lines.join(parts, lines.l_partkey == parts.p_partkey).groupBy(report, "p_name").agg(
        F.sum("l_quantity").alias("q"))
    totals_q = named.groupBy("announcement_id").agg(F.sum("q").alias("total"))
    holdings = named.join(totals_q, "announcement_id").selectExpr(
        "announcement_id", "cast(null as int) as rank", "p_name as fund_name",
        "floor(q * 9200 / total) / 100 as weight_pct", "cast(null as string) as reported_category")
    totals = suppliers.selectExpr(
        "lpad(cast(s_suppkey as string), 6, '0') as code",
        "concat('R', lpad(cast(s_suppkey as string), 6, '0')) as announcement_id", "date'1998-06-30' as report_date",
        "date'1998-07-20' as published_date", "'https://report.test/' as source_url",
        "s_nationkey * 2.5D as direct_us_pct", "92D as fund_investment_pct")
    return plan.Tables(
        funds=funds, holder_periods=periods, holders=holders, fund_pages=pages, nav=b.nav_by_supplier(spark, sf),
        index_levels=b.index_levels(spark, sf), fx_rates=b.fx_rates(spark, sf), report_totals=totals,
        report_holdings=holdings, instruments=b.instruments(spark),
        transitions=b.transitions(spark, sf, b.EVENT_SHIFT),
        failed_notices=b.failed_notices(spark, sf, b.EVENT_SHIFT))


def params() -> plan.Params:
    # Prices here are noise, so the thresholds and the fit minimum sit inside their range.
    return plan.Params(as_of=b.RUN_AS_OF, top=TOP, min_return_pct={3: -99.0, 5: -99.0, 10: 100.0},
                       min_observations=MIN_OBS, min_span_days=700, min_direct_limit_cny=LIMIT,
                       main_exclude_keywords=("亚洲",))


_RUNS: dict = {}


def _run(spark, sf):
    """One staged run per session and data set, read by all queries here."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = plan.build_ranking(tables(spark, sf), params())
    return _RUNS[key]


_PAGES = """SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS code, s_acctbal >= 3000 AS is_open,
  CASE WHEN s_acctbal >= 0 AND s_acctbal < 3000 THEN CAST(floor(s_acctbal) AS BIGINT) END AS page_limit FROM supplier"""

RUN = f"""WITH {nav_cte(as_of=DAY)}, {RECORD_CTE}, {bench_cte(DAY)}, fit AS ({fit_select(MIN_OBS, 700)}),
{state_cte(b.EVENT_SHIFT, DAY)}, {state_select(_PAGES)},
halves AS (SELECT CASE WHEN month(l_shipdate) <= 6 THEN make_date(year(l_shipdate), 6, 30)
    ELSE make_date(year(l_shipdate), 12, 31) END AS report_date, count(*) AS n FROM lineitem WHERE l_shipdate <= {DAY} GROUP BY 1),
chosen AS (SELECT max(report_date) AS d FROM (SELECT *, lag(n) OVER (ORDER BY report_date) AS older FROM halves)
  WHERE older IS NULL OR n >= ceil(older * 0.95)),
held AS (SELECT l_suppkey, max(l_extendedprice) / 2000 AS institution_pct FROM lineitem, chosen
  WHERE l_shipdate <= {DAY} AND l_shipdate > CASE WHEN month(d) = 6 THEN d - INTERVAL 6 MONTH - INTERVAL 1 DAY ELSE d - INTERVAL 6 MONTH END
    AND l_shipdate < d + INTERVAL 1 DAY GROUP BY 1),
firsts AS (SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS inception FROM lineitem GROUP BY 1),
eligible AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS fund, s_suppkey, s_nationkey, s_acctbal / 100 AS scale,
    CASE WHEN s_nationkey < 5 THEN '环球亚洲人民币A' ELSE '环球成长(QDII)A' END AS name, institution_pct
  FROM supplier JOIN held h ON h.l_suppkey = s_suppkey JOIN firsts f ON f.l_suppkey = s_suppkey
  WHERE s_nationkey < 22 AND s_nationkey % 6 <> 5 AND s_acctbal >= 0 AND inception < DATE '1998-07-25'),
hold AS (SELECT l_suppkey, p_name, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
cut AS (SELECT *, floor(q * 9200 / sum(q) OVER (PARTITION BY l_suppkey)) AS w FROM hold),
pct AS (SELECT l_suppkey, w, CASE WHEN contains(p_name, 'blue bolt') OR contains(p_name, 'red bolt') THEN 100
    WHEN contains(p_name, 'bolt') AND false THEN 62 WHEN contains(p_name, 'gear') THEN 0
    WHEN contains(p_name, 'ring') OR contains(p_name, 'gizmo') THEN 40 WHEN contains(p_name, 'hot') THEN 0
    WHEN contains(p_name, 'bolt') THEN 36 END AS p FROM cut),
expo AS (SELECT l_suppkey, sum(w * coalesce(p, 0)) / 10000 AS look, sum(CASE WHEN p IS NULL THEN w ELSE 0 END) / 100 AS unknown,
    92 - sum(w) / 100 AS rest FROM pct GROUP BY 1),
bounds AS (SELECT s_suppkey, round(least(100, s_nationkey * 2.5 + look), 2) AS confirmed,
    round(least(100, least(100, s_nationkey * 2.5 + look) + unknown + CASE WHEN rest > 0.01 THEN rest ELSE 0 END), 2) AS possible
  FROM expo JOIN supplier ON s_suppkey = l_suppkey),
h AS (SELECT fund AS code FROM eligible),
perf AS (SELECT h.code AS fund, {RECORD_COLUMNS} FROM h {RECORD_JOINS}),
joined AS (SELECT e.*, p.* EXCLUDE (fund), f.correlation, f.beta, b.confirmed, b.possible, s.* EXCLUDE (code),
    coalesce(three_year_return_pct < -99, true) AS f3, coalesce(five_year_return_pct < -99, false) AS f5,
    coalesce(ten_year_return_pct < 100, false) AS f10
  FROM eligible e JOIN perf p ON p.fund = e.fund LEFT JOIN fit f ON f.code = e.fund
  JOIN bounds b ON b.s_suppkey = e.s_suppkey JOIN state s ON s.code = e.fund),
evaluated AS (SELECT *, NOT (f3 OR f5 OR f10) AS passed,
    CASE WHEN name NOT LIKE '%亚洲%' AND confirmed >= 50 THEN 'us_main' ELSE 'global_supplement' END AS ranking_list,
    CASE WHEN name LIKE '%亚洲%' THEN 'us_main_name_geography_override' WHEN confirmed >= 50 THEN 'confirmed_us_exposure'
      ELSE 'us_exposure_below_threshold' END AS routing_reason,
    CASE WHEN has_unparsed_notice OR direct_status = 'unknown' THEN 'quota_unresolved'
      WHEN direct_status = 'limited' AND direct_amount < {LIMIT} THEN 'direct_limit_below_threshold' END AS quota_reason,
    (power(1 + three_year_return_pct / 100, 365.0 / date_diff('day', three_year_performance_start_date,
      three_year_performance_end_date)) - 1) * 100 AS yearly FROM joined),
qualified AS (SELECT *, yearly / nullif(abs(three_year_max_drawdown_pct), 0) AS ratio FROM evaluated WHERE passed AND quota_reason IS NULL),
main AS (SELECT *, row_number() OVER (ORDER BY correlation DESC, abs(beta - 1), confirmed DESC, institution_pct DESC,
    three_year_return_pct DESC, fund) AS rank FROM qualified WHERE ranking_list = 'us_main'),
supplement AS (SELECT *, row_number() OVER (ORDER BY round(ratio, 4) DESC NULLS FIRST, three_year_return_pct DESC,
    three_year_max_drawdown_pct DESC, institution_pct DESC, scale DESC, fund) AS rank FROM qualified WHERE ranking_list = 'global_supplement'),
everyone AS (SELECT * FROM main UNION ALL SELECT * FROM supplement),
ranked AS (SELECT * FROM everyone WHERE rank <= {TOP}),
exclusions AS (SELECT fund, 'three_year_return_below_threshold' AS reason FROM evaluated WHERE f3
  UNION ALL SELECT fund, 'five_year_return_below_threshold' FROM evaluated WHERE f5
  UNION ALL SELECT fund, 'ten_year_return_below_threshold' FROM evaluated WHERE f10
  UNION ALL SELECT fund, quota_reason FROM evaluated WHERE passed AND quota_reason IS NOT NULL
  UNION ALL SELECT fund, 'ranking_cap' FROM everyone WHERE rank > {TOP})"""

_LABELS = "CASE reason " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.EXCLUSION_LABELS.items()) + " END"


@query("pipe01_ranking", f"""{RUN} SELECT fund AS code, ranking_list, routing_reason, CAST(rank AS BIGINT) AS rank, correlation, beta,
  confirmed AS confirmed_pct, possible AS possible_pct, three_year_return_pct, three_year_max_drawdown_pct,
  round(ratio, 4) AS ratio, direct_status FROM ranked""")
def ranking(spark, sf):
    """PIPE-01 with SET-01: both ranked lists from raw tables."""
    return _run(spark, sf)["ranking"].select(
        "code", "ranking_list", "routing_reason", F.col("rank").cast("long").alias("rank"), "correlation", "beta",
        "confirmed_pct", "possible_pct", "three_year_return_pct", "three_year_max_drawdown_pct",
        F.round("drawdown_ratio", 4).alias("ratio"), F.col("direct_limit.status").alias("direct_status"))


@query("srt01_rank_main", f"""{RUN} SELECT fund AS code, CAST(rank AS BIGINT) AS rank FROM main WHERE rank <= 5""")
def rank_main(spark, sf):
    passed = _run(spark, sf)["evaluated"].where("ranking_list is not null and quota_reason is null")
    return rank.rank_main(passed, 5).select("code", F.col("rank").cast("long").alias("rank"))


@query("srt02_rank_supplement", f"""{RUN} SELECT fund AS code, CAST(rank AS BIGINT) AS rank FROM supplement WHERE rank <= 5""")
def rank_supplement(spark, sf):
    passed = _run(spark, sf)["evaluated"].where("ranking_list is not null and quota_reason is null")
    return rank.rank_supplement(passed, 5).select("code", F.col("rank").cast("long").alias("rank"))


@query("ag10_funnel", f"""{RUN} SELECT CAST(count(*) AS BIGINT) AS base_candidates_total, CAST(count(*) AS BIGINT) AS performance_candidates_scanned,
  CAST(count(*) FILTER (passed) AS BIGINT) AS performance_qualified_count, CAST(count(*) FILTER (passed) AS BIGINT) AS us_equity_candidates_scanned,
  CAST(count(*) FILTER (passed AND ranking_list = 'us_main') AS BIGINT) AS us_routed_count,
  CAST(count(*) FILTER (passed AND ranking_list <> 'us_main') AS BIGINT) AS global_routed_count,
  CAST(count(*) FILTER (passed AND ranking_list = 'us_main' AND quota_reason IS NULL) AS BIGINT) AS us_quota_qualified_count,
  CAST(count(*) FILTER (passed AND ranking_list <> 'us_main' AND quota_reason IS NULL) AS BIGINT) AS global_quota_qualified_count,
  true AS full_scan_completed FROM evaluated""")
def funnel(spark, sf):
    return _run(spark, sf)["funnel"]


@query("ag09_exclusion_summary", f"""{RUN} SELECT reason, {_LABELS} AS label, CAST(count(DISTINCT fund) AS BIGINT) AS excluded_count,
  min(fund) AS first_code FROM exclusions GROUP BY reason""")
def exclusion_summary(spark, sf):
    return _run(spark, sf)["exclusion_summary"]


@query("jn10_ranking_cap", f"{RUN} SELECT fund AS code, reason FROM exclusions")
def ranking_cap(spark, sf):
    """JN-10 among all exclusion codes of AG-09."""
    return _run(spark, sf)["exclusions"].select("code", "reason")


@query("dq13_digest", f"""{RUN}, t AS (SELECT 'interval' AS kind FROM ranked WHERE possible > confirmed
  UNION ALL SELECT 'override' FROM ranked WHERE routing_reason = 'us_main_name_geography_override'
  UNION ALL SELECT 'exclusion' FROM (SELECT DISTINCT reason FROM exclusions)
  UNION ALL SELECT 'warning' FROM evaluated WHERE passed AND (has_unparsed_notice OR direct_status = 'unknown')
  UNION ALL SELECT 'warning' FROM evaluated WHERE passed AND confirmed < 50 AND possible >= 50
  UNION ALL SELECT 'warning' FROM halves, chosen WHERE report_date > d
  UNION ALL SELECT 'warning' FROM (VALUES ('us_main'), ('global_supplement')) lists(list_name)
    WHERE (SELECT count(*) FROM ranked WHERE ranking_list = list_name) < {TOP})
SELECT kind, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY kind""")
def digest(spark, sf):
    """Lines of the digest by kind, every warning of the run included."""
    out = _run(spark, sf)
    return runs.digest(out["ranking"], out["exclusion_summary"], out["warnings"]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("dq04_check_exclusions", f"""{RUN}, c AS (SELECT reason, count(DISTINCT fund) AS n FROM exclusions GROUP BY reason)
SELECT 'exclusion_count' AS rule_id, reason AS key FROM c WHERE reason LIKE '%quota%'
UNION ALL SELECT 'exclusion_label', reason FROM c WHERE reason = 'ranking_cap'""")
def check_exclusions(spark, sf):
    """Counts of quota reasons and the label of the cap are falsified first."""
    out = _run(spark, sf)
    summary = out["exclusion_summary"].withColumn(
        "excluded_count", F.expr("excluded_count + if(contains(reason, 'quota'), 1, 0)")).withColumn(
        "label", F.expr("if(reason = 'ranking_cap', '', label)"))
    return val.check_exclusions(out["exclusions"], summary).select("rule_id", "key")


@query("ag11_observation_periods", f"""{RUN} SELECT DISTINCT three_year_performance_start_date AS start_date,
  three_year_performance_end_date AS end_date FROM evaluated WHERE three_year_performance_start_date IS NOT NULL ORDER BY 1, 2""")
def observation_periods(spark, sf):
    return rank.observation_periods(_run(spark, sf)["evaluated"], "three_year")


@query("set02_set_checks", """WITH a AS (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000),
b AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal < 3000),
n AS (SELECT k, count(*) AS c FROM (SELECT k FROM a UNION ALL SELECT k FROM b) GROUP BY k HAVING count(*) > 1)
SELECT CAST(k AS VARCHAR) AS code, 'duplicate' AS side, CAST(c AS BIGINT) AS occurrences FROM n
UNION ALL SELECT CAST(k AS VARCHAR), 'missing', CAST(1 AS BIGINT) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT CAST(k AS VARCHAR), 'unexpected', CAST(1 AS BIGINT) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def set_checks(spark, sf):
    """SET-02, SET-03 and SET-04 on the nations of two groups."""
    a = b.table(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").cast("string").alias("code"))
    c = b.table(spark, sf, "supplier").where("s_acctbal < 3000").select(F.col("s_nationkey").cast("string").alias("code"))
    twice = rank.duplicate_codes(a, c).select("code", F.lit("duplicate").alias("side"), "occurrences")
    return twice.unionByName(rank.set_difference(a, c).withColumn("occurrences", F.lit(1).cast("long")))


@query("dq07_order_check", """WITH n AS (SELECT conv_id, turn, length(text) AS size,
  lead(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS next_size FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS ranking_list, CAST(turn + 1 AS BIGINT) AS rank, CAST(turn AS VARCHAR) AS code,
  CAST(turn + 1 AS VARCHAR) AS next_code FROM n WHERE next_size > size""")
def order_check(spark, sf):
    """Turns of a conversation as stored ranks; the sort rule is longest text first."""
    stored = b.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("ranking_list"), (F.col("turn") + 1).alias("rank"),
        F.col("turn").alias("code"), F.length("text").alias("size"))
    breaks = val.order_breaks(stored, F.struct(-F.col("size"), F.col("code")))
    return breaks.select("ranking_list", F.col("rank").cast("long").alias("rank"),
                         F.col("code").cast("string").alias("code"), F.col("next_code").cast("string").alias("next_code"))


@query("win09_rank_gaps", """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS ranking_list FROM lineitem GROUP BY l_suppkey
HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(DISTINCT l_linenumber) OR count(*) <> count(DISTINCT l_linenumber)""")
def rank_gaps(spark, sf):
    ranks = b.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ranking_list"), F.col("l_linenumber").alias("rank"))
    return val.rank_gaps(ranks).select("ranking_list")


@query("dq06_recompute_check", f"""{RUN} SELECT fund AS code, CASE WHEN fund LIKE '%7' THEN 'score_annualized' END AS rule_id FROM supplement
WHERE fund LIKE '%7'""")
def recompute_check(spark, sf):
    """Stored scores of codes that end in 7 are falsified."""
    passed = _run(spark, sf)["evaluated"].where(
        "ranking_list = 'global_supplement' and quota_reason is null")
    from navloom.functions.numbers import exact_round

    stored = passed.withColumn("return_drawdown_ratio", exact_round("drawdown_ratio", 4)).withColumn(
        "shift", F.expr("if(endswith(code, '7'), 0.5D, 0D)")).withColumn(
        "three_year_annualized_return_pct", exact_round("annualized_pct", 2) + F.col("shift"))
    return val.check_scores(stored).select(F.col("key").alias("code"), "rule_id")


@query("dq12_triage", """WITH w AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'reportable' WHEN 'view' THEN 'blocking'
  WHEN 'error' THEN 'blocking' WHEN 'signup' THEN 'reportable' ELSE CASE WHEN value > 100 THEN 'reportable' ELSE 'blocking' END END AS triage FROM events)
SELECT CAST(event_id AS BIGINT) AS seq, triage FROM w""")
def triage(spark, sf):
    texts = b.table(spark, sf, "events").selectExpr(
        "event_id as seq", "case event_type when 'click' then concat('额度剔除 ', user_id) when 'view' then concat(user_id, ' 的净值历史不足 1 年')"
        " when 'error' then ' ' when 'signup' then concat(user_id, ' 的申购额度无法确定；引用前请核对关联公告。')"
        " else case when value > 100 then concat('无法按 ', user_id, ' 仓位仅计入可能上限') else '仓位仅计入可能上限' end end as text")
    return runs.triage(texts).select("seq", "triage")


@query("ag18_dedup_warnings", """SELECT CAST(min(event_id) AS BIGINT) AS seq, concat(event_type, CAST(user_id AS VARCHAR)) AS text
FROM events GROUP BY 2""")
def dedup_warnings(spark, sf):
    from navloom.operators.quality import distinct_warnings

    return distinct_warnings(b.table(spark, sf, "events").selectExpr(
        "event_id as seq", "concat(event_type, cast(user_id as string)) as text"))


@query("ag17_run_comparison", """WITH m AS (SELECT l_returnflag || l_linestatus AS metric, l_extendedprice AS v, l_shipdate < DATE '2000-01-01' AS old FROM lineitem),
p AS (SELECT metric, quantile_cont(v, 0.5) AS median, min(v) AS minimum, max(v) AS maximum FROM m WHERE old GROUP BY metric),
c AS (SELECT metric, max(v) / 3 AS value FROM m WHERE NOT old GROUP BY metric)
SELECT metric, median, minimum, maximum, value, round((median - value) / median * 100, 4) AS reduction_pct,
  CASE WHEN metric LIKE 'A%' THEN CASE WHEN value <= 30000 THEN 'PASS' ELSE 'WARN' END
    ELSE CASE WHEN (median - value) / median * 100 >= 10 THEN 'PASS' ELSE 'WARN' END END AS verdict FROM p JOIN c USING (metric)""")
def run_comparison(spark, sf):
    rows = b.table(spark, sf, "lineitem").selectExpr(
        "concat(l_returnflag, l_linestatus) as metric", "l_extendedprice as value", "l_shipdate < date'2000-01-01' as old")
    current = rows.where("not old").groupBy("metric").agg((F.max("value") / 3).alias("value"))
    targets = rows.select("metric").distinct().selectExpr(
        "metric", "if(startswith(metric, 'A'), 'at_most', 'reduction') as kind",
        "if(startswith(metric, 'A'), 30000D, 10D) as target")
    return runs.compare_runs(rows.where("old").select("metric", "value"), current, targets)


@query("ag17_median_outlier", """WITH m AS (SELECT l_returnflag AS metric, l_extendedprice AS v FROM lineitem
  UNION ALL SELECT DISTINCT l_returnflag, 1e12 FROM lineitem UNION ALL SELECT DISTINCT l_returnflag, -1e12 FROM lineitem WHERE l_returnflag = 'A')
SELECT metric, quantile_cont(v, 0.5) AS median, min(v) AS minimum, max(v) AS maximum, true AS balanced FROM m GROUP BY metric""")
def median_outlier(spark, sf):
    """One price of 1e12 for each flag: the median stays exact, and no range holds more than twice its share of values."""
    rows = b.table(spark, sf, "lineitem").selectExpr("l_returnflag as metric", "l_extendedprice as value")
    far = rows.select("metric").distinct()
    rows = rows.unionByName(far.selectExpr("metric", "1e12D as value")).unionByName(far.where("metric = 'A'").selectExpr("metric", "-1e12D as value"))
    sizes = runs.value_ranges(rows).groupBy("metric", "range").agg(F.count(F.lit(1)).alias("values"))
    balanced = sizes.groupBy("metric").agg((F.max("values") * runs.MEDIAN_RANGES <= 2 * F.sum("values")).alias("balanced"))
    return runs.baseline_summary(rows).join(balanced, "metric")


@query("dq11_parity", """SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderstatus = 'P' THEN 'parity_row'
  WHEN o_orderpriority = '1-URGENT' THEN 'parity_o_totalprice' ELSE 'parity_o_orderstatus' END AS rule_id FROM orders
WHERE o_orderstatus = 'P' OR o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def parity(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    flat = orders.where("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey", "cast(o_totalprice + if(o_orderpriority = '1-URGENT', 1, 0) as string) as o_totalprice",
        "concat(o_orderstatus, if(o_orderpriority = '2-HIGH', 'x', '')) as o_orderstatus")
    found = val.parity(orders, flat, ["o_totalprice", "o_orderstatus"], ["o_orderkey"])
    return found.select("key", "rule_id")
