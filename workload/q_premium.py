"""Premium snapshot over event quotes, an order catalog and stored records."""

from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.display import (
    format_beta, format_correlation, format_cost, format_limit, format_percentage, format_rule, format_turnover,
)
from navloom.functions.numbers import premium_band
from navloom.operators import premium as prem
from navloom.operators import validation as val
from navloom.sources.catalogs import exchange_fund_rules, order_by_list
from navloom.operators.quality import violations
from workload import bindings as b
from workload.registry import query

PREMIUM = """cat AS (SELECT DISTINCT o_custkey, day(o_orderdate) AS d,
    concat(CAST(o_custkey AS VARCHAR), '-', CAST(day(o_orderdate) AS VARCHAR)) AS code FROM orders),
q AS (SELECT concat(CAST(user_id AS VARCHAR), '-', CAST(day(ts) AS VARCHAR)) AS code, event_type, value, ts,
    CASE WHEN event_type = 'signup' AND value < 5 THEN 0 ELSE value + 1 END AS price FROM events),
cnt AS (SELECT code, count(*) AS n FROM q GROUP BY code),
checked AS (SELECT c.code, q.*, n, CASE WHEN n > 1 THEN 'duplicate_response'
    WHEN event_type = 'view' AND value > 200 THEN 'value_missing' WHEN price <= 0 OR price * 0.98 <= 0 THEN 'out_of_range'
    WHEN CAST(ts AS DATE) > DATE '2024-01-25' OR CAST(ts + INTERVAL 8 HOUR AS DATE) > DATE '2024-01-25' THEN 'future_data'
    WHEN event_type = 'error' THEN 'premium_mismatch' END AS reason
  FROM cat c JOIN cnt USING (code) JOIN q USING (code)),
stored AS (SELECT concat(CAST(o_custkey AS VARCHAR), '-', CAST(day(o_orderdate) AS VARCHAR)) AS code,
    arg_min(o_totalprice / 1000, o_orderkey) AS price FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
snap AS (SELECT cat.code, CASE WHEN f.code IS NOT NULL THEN 'fresh' WHEN s.code IS NOT NULL THEN 'stale' ELSE 'unavailable' END AS quote_status,
    CASE WHEN f.code IS NOT NULL THEN round(f.price, 4) ELSE s.price END AS market_price_cny,
    CASE WHEN f.code IS NOT NULL THEN CAST(2.04 AS DOUBLE) WHEN s.code IS NOT NULL THEN CAST(1 AS DOUBLE) END AS premium_pct
  FROM cat LEFT JOIN (SELECT * FROM checked WHERE reason IS NULL) f ON f.code = cat.code LEFT JOIN stored s ON s.code = cat.code)"""


@query("ag15_duplicate_quotes", f"WITH {PREMIUM} SELECT DISTINCT code, CAST(n AS BIGINT) AS responses FROM checked WHERE n > 1")
def duplicate_quotes(spark, sf):
    return prem.duplicate_quotes(b.quotes(spark, sf), b.premium_catalog(spark, sf))


@query("flt11_validate_quotes", f"""WITH {PREMIUM} SELECT code, min(coalesce(reason, 'valid')) AS reject_reason FROM checked GROUP BY code""")
def validate_quotes(spark, sf):
    checked = prem.validate_quotes(b.quotes(spark, sf), b.premium_catalog(spark, sf), as_of=b.EVENTS_AS_OF)
    return checked.select("code", F.coalesce("reject_reason", F.lit("valid")).alias("reject_reason"))


@query("jn09_missing_codes", f"WITH {PREMIUM} SELECT code FROM cat WHERE code NOT IN (SELECT code FROM q)")
def missing_codes(spark, sf):
    return prem.missing_codes(b.premium_catalog(spark, sf), b.quotes(spark, sf))


def _snapshot(spark, sf):
    return prem.premium_snapshot(b.premium_catalog(spark, sf), b.quotes(spark, sf), b.cached_quotes(spark, sf),
                                 as_of=b.EVENTS_AS_OF)


@query("jn08_premium_snapshot", f"WITH {PREMIUM} SELECT * FROM snap ORDER BY premium_pct DESC NULLS LAST, code")
def premium_snapshot(spark, sf):
    """JN-08 in the order of SRT-03."""
    return prem.sort_premium(_snapshot(spark, sf)).select("code", "quote_status", "market_price_cny", "premium_pct")


@query("ag14_premium_status", f"""WITH {PREMIUM}, c AS (SELECT count(*) AS e, count(*) FILTER (quote_status = 'fresh') AS f,
  count(*) FILTER (quote_status = 'stale') AS s FROM snap)
SELECT CAST(e AS BIGINT) AS expected_count, CAST(f AS BIGINT) AS fresh_count, CAST(s AS BIGINT) AS cache_hit_count,
  CASE WHEN f = e THEN 'fresh' WHEN f > 0 THEN 'partial' WHEN s > 0 THEN 'stale' ELSE 'unavailable' END AS status FROM c""")
def premium_status(spark, sf):
    return prem.snapshot_status(_snapshot(spark, sf))


@query("ag14_premium_warnings", f"""WITH {PREMIUM}, t AS (SELECT code, min(reason) AS reason FROM checked WHERE reason IS NOT NULL GROUP BY code
  UNION ALL SELECT code, 'missing' FROM cat WHERE code NOT IN (SELECT code FROM q))
SELECT reason, CAST(count(*) AS BIGINT) AS texts FROM t GROUP BY reason""")
def premium_warnings(spark, sf):
    catalog, quotes = b.premium_catalog(spark, sf), b.quotes(spark, sf)
    texts = prem.premium_warnings(prem.validate_quotes(quotes, catalog, as_of=b.EVENTS_AS_OF),
                                  prem.missing_codes(catalog, quotes))
    reason = F.element_at(F.split("text", " "), -1)
    return texts.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("texts"))


@query("dq10_check_premium", f"""WITH {PREMIUM}, w AS (SELECT code, 'premium_formula' AS rule_id FROM snap WHERE code LIKE '%-13' AND quote_status <> 'unavailable'
  UNION ALL SELECT 'premium', 'premium_counts') SELECT rule_id, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY rule_id""")
def check_premium(spark, sf):
    """Records of the 13th are falsified, and the stored status row is one off."""
    snapshot = _snapshot(spark, sf)
    status = prem.snapshot_status(snapshot).withColumn("fresh_count", F.col("fresh_count") + 1)
    wrong = F.when(F.col("code").endswith("-13"), F.col("premium_pct") + 5).otherwise(F.col("premium_pct"))
    broken = snapshot.withColumn("premium_pct", wrong).withColumn("source_discount_pct", -F.col("premium_pct"))
    found = val.check_premium(broken, b.premium_catalog(spark, sf), status, as_of=b.EVENTS_AS_OF)
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))


@query("fn09_premium_band", """SELECT CAST(event_id AS BIGINT) AS event_id, CASE WHEN event_type = 'error' THEN 'unavailable'
  WHEN value / 20 - 3 < 0 THEN 'discount' WHEN value / 20 - 3 <= 2 THEN 'normal' WHEN value / 20 - 3 <= 5 THEN 'elevated' ELSE 'high' END AS band
FROM events""")
def bands(spark, sf):
    value = F.expr("case when event_type <> 'error' then value / 20 - 3 end")
    return b.table(spark, sf, "events").select("event_id", premium_band(value).alias("band"))


_SHARE, _CHANNEL = fixed.SHARE_RULE_LABELS, fixed.CHANNEL_RULE_LABELS


@query("fn17_display", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '正常开放' WHEN o_orderpriority = '2-HIGH' THEN '待核实'
    WHEN o_orderpriority = '3-MEDIUM' THEN concat(format('{:,}', CAST(o_custkey + 1 AS BIGINT)), '万元')
    WHEN o_custkey = 0 THEN '0元' ELSE concat(format('{:,}', CAST(o_custkey AS BIGINT)), '元') END AS limit_text,
  CASE WHEN o_orderstatus = 'P' THEN '待核实' WHEN o_custkey % 2 = 1 THEN format('-{:d}.50%', CAST(o_custkey AS BIGINT))
    ELSE format('+{:d}.25%', CAST(o_custkey AS BIGINT)) END AS percent_text,
  CASE WHEN o_orderstatus = 'F' THEN format('{:d}元', CAST(o_custkey % 9000 AS BIGINT))
    ELSE format('{:d}.50亿元', CAST(o_custkey + 1 AS BIGINT)) END AS turnover_text,
  concat(format('{:.1f}', CAST(o_custkey % 40 * 2.5 AS DOUBLE)), '%') AS correlation_text,
  format('{:.2f}', CAST(o_custkey % 8 * 0.25 AS DOUBLE)) AS beta_text,
  CASE WHEN o_orderstatus = 'P' THEN '--' ELSE format('{:.2f}%/年', CAST(o_custkey % 8 * 0.25 AS DOUBLE)) END AS cost_text,
  CASE WHEN o_custkey % 2 = 0 AND o_custkey % 3 = 0 THEN '不适用' ELSE concat(CASE WHEN o_custkey % 2 = 0 THEN '""" + _SHARE["not applicable"] + """' ELSE '""" + _SHARE["A/C separate"] + """' END, '；',
    CASE WHEN o_custkey % 3 = 0 THEN '""" + _CHANNEL["same fund-level limit"] + """' ELSE '""" + _CHANNEL["direct and agency limits differ"] + """' END) END AS rule_text FROM orders""")
def display(spark, sf):
    orders = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "case o_orderpriority when '1-URGENT' then 'unlimited' when '2-HIGH' then 'unknown' else 'limited' end as status",
        "case when o_orderpriority = '3-MEDIUM' then (o_custkey + 1) * 10000 else o_custkey end as amount",
        "case when o_orderstatus = 'P' then null when o_custkey % 2 = 1 then -o_custkey - 0.5D else o_custkey + 0.25D end as pct",
        "case when o_orderstatus = 'F' then cast(o_custkey % 9000 as double) else (o_custkey + 1.5D) * 100000000 end as turnover",
        "o_custkey % 40 * 0.025D as correlation", "o_custkey % 8 * 0.25D as beta",
        "case when o_orderstatus <> 'P' then o_custkey % 8 * 0.25D end as cost",
        "if(o_custkey % 2 = 0, 'not applicable', 'A/C separate') as share_rule",
        "if(o_custkey % 3 = 0, 'same fund-level limit', 'direct and agency limits differ') as channel_rule")
    return orders.select("o_orderkey", format_limit(F.col("status"), F.col("amount")).alias("limit_text"),
                         format_percentage("pct", sign=True).alias("percent_text"),
                         format_turnover("turnover").alias("turnover_text"), format_correlation("correlation").alias("correlation_text"),
                         format_beta("beta").alias("beta_text"), format_cost("cost").alias("cost_text"),
                         format_rule(F.col("share_rule"), F.col("channel_rule")).alias("rule_text"))


@query("src10_exchange_fund_rules", """WITH f AS (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_size, p_type FROM part)
SELECT code, 'etf_name' AS rule_id FROM f WHERE p_size % 7 = 0 UNION ALL SELECT code, 'etf_exchange' FROM f WHERE p_type = 'PROMO'
UNION ALL SELECT code, 'etf_market' FROM f WHERE (p_type = 'ECONOMY') <> (p_size % 2 = 1)
UNION ALL SELECT code, 'etf_group' FROM f WHERE p_size > 45 UNION ALL SELECT code, 'etf_source' FROM f WHERE p_size < 3""")
def exchange_fund_violations(spark, sf):
    rows = b.table(spark, sf, "part").selectExpr(
        "lpad(cast(p_partkey as string), 6, '0') as code", "case when p_size % 7 = 0 then ' ' else p_name end as name",
        "case p_type when 'ECONOMY' then 'SSE' when 'PROMO' then 'NYSE' else 'SZSE' end as exchange",
        "cast(p_size % 2 as int) as market_id", "'broad_market' as category",
        "case when p_size > 45 then 'other' else '道琼斯' end as benchmark_group",
        "case when p_size < 3 then 'http://x' else 'https://x' end as source_url")
    return violations(rows, exchange_fund_rules(), F.col("code")).select(F.col("key").alias("code"), "rule_id")


@query("srt04_order_by_list", """SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_type FROM part
ORDER BY CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 2 ELSE 3 END, p_partkey""")
def category_order(spark, sf):
    return order_by_list(b.table(spark, sf, "part"), "p_type", ["PROMO", "SMALL"], "p_partkey").select("p_partkey", "p_type")
