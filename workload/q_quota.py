"""Quota states and document selection."""

from pyspark.sql import functions as F

from navloom.operators import documents as doc
from navloom.operators import quota as quo
from navloom.sources import raw, sinks
from navloom.functions.text import fund_identity
from workload import bindings as b
from workload.registry import query


def state_cte(shift: int = 0, as_of: str = "DATE '2024-01-25'") -> str:
    day = f"(CAST(ts AS DATE) - {shift})"
    return f"""ev AS (SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS code, user_id, event_id, event_type AS kind, value,
    CAST({day} AS DATE) AS published, CAST({day} + CASE WHEN value > 50 THEN 3 ELSE 0 END AS DATE) AS effective,
    CAST(floor(value) AS BIGINT) AS amount FROM events),
bad AS (SELECT lpad(CAST(user_id - user_id % 5 AS VARCHAR), 6, '0') AS code, max(published) AS failed FROM ev WHERE kind = 'error' GROUP BY 1),
live AS (SELECT ev.*, failed FROM ev LEFT JOIN bad USING (code)
  WHERE kind <> 'error' AND effective <= {as_of} AND (failed IS NULL OR published > failed)),
latest AS (SELECT *, row_number() OVER (PARTITION BY code, kind = 'view' ORDER BY effective DESC, published DESC, event_id DESC) AS rd,
    row_number() OVER (PARTITION BY code, kind = 'click' ORDER BY effective DESC, published DESC, event_id DESC) AS ra FROM live),
direct AS (SELECT code, CASE WHEN kind = 'signup' THEN 'unlimited' ELSE 'limited' END AS status,
    CASE WHEN kind <> 'signup' THEN amount END AS amount, effective, CASE WHEN kind = 'purchase' THEN 'high' ELSE 'medium' END AS conf
  FROM latest WHERE kind <> 'view' AND rd = 1),
agency AS (SELECT code, CASE WHEN kind = 'signup' THEN 'unlimited' ELSE 'limited' END AS status,
    CASE WHEN kind <> 'signup' THEN amount END AS amount, effective, CASE WHEN kind = 'purchase' THEN 'high' ELSE 'medium' END AS conf
  FROM latest WHERE kind <> 'click' AND ra = 1),
share AS (SELECT code, arg_max(CASE WHEN value > 100 THEN 'A/C separate' ELSE 'A/C combined' END,
    (epoch(effective) * 1000 + date_diff('day', DATE '1990-01-01', published)) * 1000000 + event_id) AS rule
  FROM live WHERE value > 100 OR value < 1 GROUP BY code),
comb AS (SELECT code, bool_or(kind = 'purchase' AND value > 300) AS c FROM live GROUP BY code)"""


def state_select(pages: str) -> str:
    """``pages(code, is_open, page_limit)``."""
    return f"""st AS (SELECT p.code, bad.failed,
    coalesce(d.status, CASE WHEN bad.failed IS NULL AND is_open THEN 'unlimited' ELSE 'unknown' END) AS ds, d.amount AS da,
    d.effective AS de, coalesce(d.conf, CASE WHEN bad.failed IS NULL AND is_open THEN 'medium' ELSE 'low' END) AS dc,
    coalesce(a.status, CASE WHEN bad.failed IS NOT NULL THEN 'unknown' WHEN is_open THEN 'unlimited'
      WHEN page_limit <> 0 THEN 'limited' ELSE 'unknown' END) AS as_,
    CASE WHEN a.status IS NOT NULL THEN a.amount WHEN bad.failed IS NULL AND NOT is_open AND page_limit <> 0 THEN page_limit END AS aa,
    coalesce(a.conf, CASE WHEN bad.failed IS NOT NULL THEN 'low' WHEN is_open OR page_limit <> 0 THEN 'medium' ELSE 'low' END) AS ac,
    coalesce(share.rule, 'not applicable') AS share_rule, coalesce(comb.c, false) AS combined
  FROM ({pages}) p LEFT JOIN bad USING (code) LEFT JOIN direct d USING (code) LEFT JOIN agency a USING (code)
  LEFT JOIN share USING (code) LEFT JOIN comb USING (code)),
state AS (SELECT code, ds AS direct_status, da AS direct_amount, de AS direct_date, as_ AS agency_status, aa AS agency_amount,
    CASE WHEN ds = 'unknown' OR as_ = 'unknown' THEN 'unknown' WHEN ds = 'limited' OR as_ = 'limited' THEN 'limited'
      ELSE 'unlimited' END AS quota_status,
    CASE WHEN ds = 'unknown' OR as_ = 'unknown' THEN 'low' WHEN (ds = 'limited' OR as_ = 'limited') AND dc = 'high' AND ac = 'high'
      THEN 'high' ELSE 'medium' END AS quota_confidence, share_rule AS share_class_rule,
    CASE WHEN combined THEN 'all sales channels combined' WHEN da IS DISTINCT FROM aa THEN 'direct and agency limits differ'
      ELSE 'same fund-level limit' END AS channel_rule, failed IS NOT NULL AS has_unparsed_notice FROM st)"""


CUSTOMER_PAGES = """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, c_acctbal >= 3000 AND c_acctbal < 9000 AS is_open,
  CASE WHEN c_acctbal >= 0 AND c_acctbal < 3000 THEN CAST(floor(c_acctbal) AS BIGINT) END AS page_limit FROM customer"""


def _state(spark, sf):
    return quo.quota_state(b.fund_pages(spark, sf), b.transitions(spark, sf), b.failed_notices(spark, sf), as_of=b.EVENTS_AS_OF)


@query("win07_quota_state", f"WITH {state_cte()}, {state_select(CUSTOMER_PAGES)} SELECT * FROM state")
def quota_state(spark, sf):
    return _state(spark, sf).select(
        "code", F.col("direct_limit.status").alias("direct_status"),
        F.col("direct_limit.amount_cny").alias("direct_amount"),
        F.col("direct_limit.effective_date").alias("direct_date"),
        F.col("agency_limit.status").alias("agency_status"), F.col("agency_limit.amount_cny").alias("agency_amount"),
        "quota_status", "quota_confidence", "share_class_rule", "channel_rule", "has_unparsed_notice")


@query("win07_quota_sources", f"""WITH {state_cte()} SELECT DISTINCT code,
  concat('https://notice.test/', CAST(event_id AS VARCHAR)) AS source_url FROM live""")
def quota_sources(spark, sf):
    return quo.quota_sources(b.transitions(spark, sf), b.failed_notices(spark, sf), as_of=b.EVENTS_AS_OF)


@query("flt12_quota_gate", f"""WITH {state_cte()}, {state_select(CUSTOMER_PAGES)}
SELECT code, CASE WHEN has_unparsed_notice OR direct_status = 'unknown' THEN 'quota_unresolved'
  WHEN direct_status = 'limited' AND direct_amount < 20 THEN 'direct_limit_below_threshold' END AS quota_reason FROM state""")
def quota_gate(spark, sf):
    """FLT-07 and FLT-12 with a threshold inside the range of the data."""
    return _state(spark, sf).select("code", quo.quota_gate(20).alias("quota_reason"))


@query("flt12_quota_warnings", f"""WITH {state_cte()}, {state_select(CUSTOMER_PAGES)}
SELECT CAST(count(*) FILTER (quota_status = 'unknown') AS BIGINT) AS unknown_texts,
  CAST(count(*) FILTER (has_unparsed_notice OR direct_status = 'unknown') AS BIGINT) AS excluded_texts FROM state""")
def quota_warnings(spark, sf):
    texts = quo.quota_warnings(_state(spark, sf))
    return texts.agg(F.count_if(F.col("text").contains("无法确定")).alias("unknown_texts"),
                     F.count_if(F.col("text").startswith("额度剔除")).alias("excluded_texts"))


ANNOUNCED = """ann AS (SELECT lpad(CAST(n_chars % 97 AS VARCHAR), 6, '0') AS code, lpad(CAST(doc_id AS VARCHAR), 9, '0') AS announcement_id,
  doc_id % 6 AS kind, n_chars % 3 = 0 AS is_c, DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER) AS published_date,
  n_chars % 2 = 0 AS on_latest_page, 2023 + doc_id % 2 AS y, 1 + doc_id % 4 AS q FROM documents)"""


@query("flt09_notice_selection", f"""WITH {ANNOUNCED}
SELECT code, announcement_id, CAST(published_date AS DATE) AS published_date FROM ann
WHERE kind IN (3, 5) AND published_date BETWEEN DATE '2025-06-30' - 550 AND DATE '2025-06-30'
QUALIFY row_number() OVER (PARTITION BY code ORDER BY published_date DESC, announcement_id) <= 12""")
def notice_selection(spark, sf):
    """The twelve latest notices per fund are the feature of this operator."""
    return quo.select_notices(b.announcements(spark, sf), as_of=b.NOTICES_AS_OF).select(
        "code", "announcement_id", "published_date")


@query("flt10_classify_documents", f"""WITH {ANNOUNCED} SELECT code, announcement_id,
  CASE kind WHEN 0 THEN 'periodic_report' WHEN 1 THEN 'prospectus' ELSE 'product_summary' END AS document_class,
  CASE kind WHEN 0 THEN last_day(make_date(y, q * 3, 1)) END AS report_date
FROM ann WHERE kind IN (0, 1) OR (kind = 2 AND NOT is_c)""")
def classify_documents(spark, sf):
    """FLT-10 and FN-04."""
    return doc.classify_documents(b.announcements(spark, sf)).select(
        "code", "announcement_id", "document_class", "report_date")


@query("ag07_latest_documents", f"""WITH {ANNOUNCED}, c AS (SELECT *, CASE kind WHEN 0 THEN 'periodic_report'
    WHEN 1 THEN 'prospectus' ELSE 'product_summary' END AS document_class FROM ann
  WHERE (kind IN (0, 1) OR (kind = 2 AND NOT is_c)) AND published_date <= DATE '2025-06-30')
SELECT code, document_class, announcement_id, CAST(published_date AS DATE) AS published_date FROM c
QUALIFY row_number() OVER (PARTITION BY code, document_class ORDER BY published_date DESC, announcement_id DESC) = 1""")
def latest_documents(spark, sf):
    classified = doc.classify_documents(b.announcements(spark, sf))
    return doc.latest_documents(classified, as_of=b.NOTICES_AS_OF).select(
        "code", "document_class", "announcement_id", "published_date")


@query("ag08_latest_report", f"""WITH {ANNOUNCED}, r AS (SELECT *, last_day(make_date(y, q * 3, 1)) AS report_date FROM ann
  WHERE kind = 0 AND published_date <= DATE '2025-06-30' AND last_day(make_date(y, q * 3, 1)) <= DATE '2025-06-30')
SELECT code, announcement_id, CAST(report_date AS DATE) AS report_date FROM r
QUALIFY row_number() OVER (PARTITION BY code ORDER BY report_date DESC, published_date DESC, announcement_id DESC) = 1""")
def latest_report(spark, sf):
    return doc.latest_report(b.announcements(spark, sf), as_of=b.NOTICES_AS_OF).select(
        "code", "announcement_id", "report_date")


@query("jn07_on_latest_page", f"""WITH {ANNOUNCED}, p AS (SELECT code, bool_or(on_latest_page AND kind < 3) AS listed FROM ann GROUP BY code)
SELECT announcement_id, code FROM ann JOIN p USING (code) WHERE (on_latest_page AND kind < 3) OR NOT listed""")
def on_latest_page(spark, sf):
    rows = b.announcements(spark, sf).withColumn(
        "on_latest_page", F.expr("on_latest_page and cast(announcement_id as bigint) % 6 < 3"))
    return quo.on_latest_page(rows).select("code", "announcement_id")


@query("src08_merge_announcements", f"""WITH {ANNOUNCED}, old AS (SELECT code, announcement_id, kind, published_date FROM ann WHERE kind < 4),
new AS (SELECT code, announcement_id, 9 AS kind, published_date + 2 AS published_date, on_latest_page FROM ann WHERE kind IN (2, 3, 4))
SELECT coalesce(n.code, o.code) AS code, coalesce(n.announcement_id, o.announcement_id) AS announcement_id,
  n.code IS NOT NULL AS is_new, CAST(coalesce(n.published_date, o.published_date) AS DATE) AS published_date,
  coalesce(n.on_latest_page, false) AS on_latest_page
FROM old o FULL OUTER JOIN new n ON o.code = n.code AND o.announcement_id = n.announcement_id
WHERE coalesce(n.published_date, o.published_date) <= DATE '2025-06-30'""")
def merge_announcements(spark, sf):
    rows = b.announcements(spark, sf).withColumn("kind", F.expr("cast(announcement_id as bigint) % 6"))
    landed = rows.where("kind in (2, 3, 4)").withColumn("title", F.lit("new")).withColumn(
        "published_date", F.date_add("published_date", 2))
    merged = raw.merge_announcements(rows.where("kind < 4"), landed, b.NOTICES_AS_OF)
    return merged.select("code", "announcement_id", (F.col("title") == "new").alias("is_new"),
                         "published_date", "on_latest_page")


@query("snk03_pending_documents", """SELECT CAST(o_orderkey AS VARCHAR) AS announcement_id, sha256(concat(CAST(o_custkey AS VARCHAR),
  chr(0), o_orderpriority, chr(0), o_orderstatus)) AS fund_identity FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AND o_totalprice < 300000)""")
def pending_documents(spark, sf):
    """Stored results of finished orders; urgent ones under another identity, dear ones under an old method."""
    orders = b.table(spark, sf, "orders")
    key = F.col("o_custkey").cast("string")
    docs = orders.select(F.col("o_orderkey").cast("string").alias("announcement_id"),
                         fund_identity(key, F.col("o_orderpriority"), F.col("o_orderstatus")).alias("fund_identity"))
    renamed = F.when(F.col("o_orderpriority") == "1-URGENT", "renamed").otherwise(F.col("o_orderpriority"))
    stored = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("announcement_id"),
        fund_identity(key, renamed, F.col("o_orderstatus")).alias("fund_identity"),
        F.lit("catalog").alias("catalog_fingerprint"),
        F.expr("case when o_totalprice < 300000 then 1 else 0 end").alias("method_version"))
    return sinks.pending_documents(docs, stored, "catalog", 1).select("announcement_id", "fund_identity")
