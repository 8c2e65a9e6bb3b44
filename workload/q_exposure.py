"""Look-through exposure and catalog matches."""

from pyspark.sql import functions as F

from navloom.functions.numbers import exact_round
from navloom.functions.text import fund_identity, normalize_name
from navloom.operators import documents as doc
from navloom.operators import exposure as expo
from workload import bindings as b
from workload.registry import query

# The first usable entry in catalog order: BLUE BOLT and RED BOLT, then BOLT while
# its allocation is recent, GEAR, RING and GIZMO likewise, HOT, BOLT without a date.
HOLDINGS = """named AS (
  SELECT l_orderkey, l_linenumber, l_quantity, p_name, CAST(o_orderdate AS DATE) AS report_date, l_tax >= 0.075 AS reported,
    contains(p_name, 'blue bolt') OR contains(p_name, 'red bolt') AS e0, contains(p_name, 'bolt') AS bolt,
    contains(p_name, 'gear') AS gear, contains(p_name, 'ring') OR contains(p_name, 'gizmo') AS ring,
    contains(p_name, 'hot') AS hot, date_diff('day', DATE '1998-03-01', CAST(o_orderdate AS DATE)) AS age1,
    date_diff('day', DATE '1998-06-01', CAST(o_orderdate AS DATE)) AS age4
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
resolved AS (
  SELECT *, CASE WHEN e0 THEN 'us_equity' WHEN bolt AND age1 BETWEEN 0 AND 120 THEN 'global_equity'
      WHEN gear THEN 'non_us_equity' WHEN ring AND age4 BETWEEN 0 AND 120 THEN 'global_equity'
      WHEN hot THEN 'fixed_income' WHEN bolt THEN 'us_equity' END AS category,
    CASE WHEN e0 THEN 100 WHEN bolt AND age1 BETWEEN 0 AND 120 THEN 62 WHEN gear THEN 0
      WHEN ring AND age4 BETWEEN 0 AND 120 THEN 40 WHEN hot THEN 0 WHEN bolt THEN 36 END AS pct FROM named),
weighed AS (
  SELECT *, CASE WHEN reported THEN 0 ELSE pct END AS final_pct,
    CAST(l_quantity * 100 AS BIGINT) AS w200 FROM resolved)"""


@query("jn06_resolve_instruments", f"""WITH {HOLDINGS}
SELECT p_name AS fund_name, report_date, coalesce(category, 'none') AS category, CAST(max(pct) AS DOUBLE) AS us_equity_pct,
  CAST(count(*) AS BIGINT) AS holdings FROM resolved GROUP BY 1, 2, 3""")
def resolve_instruments(spark, sf):
    resolved = expo.resolve_instruments(b.holdings(spark, sf), b.instruments(spark))
    return resolved.groupBy("fund_name", "report_date", F.coalesce("category", F.lit("none")).alias("category")).agg(
        F.max("us_equity_pct").alias("us_equity_pct"), F.count(F.lit(1)).alias("holdings"))


INTERVAL = f"""{HOLDINGS},
sums AS (SELECT l_orderkey, CAST(sum(w200) AS BIGINT) AS w, CAST(sum(w200 * coalesce(final_pct, 0)) AS BIGINT) AS c,
  CAST(sum(CASE WHEN final_pct IS NULL THEN w200 ELSE 0 END) AS BIGINT) AS u FROM weighed GROUP BY 1),
bounds AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS report_date,
  o_custkey % 45 AS direct, greatest(0, o_custkey % 80 - coalesce(w, 0) / 200) AS residual,
  coalesce(c, 0) / 20000 AS lookthrough, coalesce(u, 0) / 200 AS unknown FROM orders LEFT JOIN sums ON l_orderkey = o_orderkey),
intervals AS (SELECT *, least(100, direct + lookthrough) AS confirmed,
  unknown + CASE WHEN residual > 0.01 THEN residual ELSE 0 END AS unresolved FROM bounds)"""


@query("ag06_exposure_interval", f"""WITH {INTERVAL}
SELECT CAST(o_orderkey AS VARCHAR) AS announcement_id, round(confirmed, 2) AS confirmed_pct,
  round(least(100, confirmed + unresolved), 2) AS possible_pct, round(lookthrough, 2) AS lookthrough_confirmed_pct,
  round(unresolved, 2) AS unresolved_pct,
  CASE WHEN round(confirmed, 2) >= 50 THEN 'qualified' WHEN round(least(100, confirmed + unresolved), 2) < 50 THEN 'excluded'
    ELSE 'ambiguous' END AS status FROM intervals""")
def exposure_interval(spark, sf):
    """AG-06 and PRJ-02."""
    contributed = expo.contributions(expo.resolve_instruments(b.holdings(spark, sf), b.instruments(spark)))
    interval = expo.exposure_interval(b.report_totals(spark, sf), contributed)
    status = expo.classify_exposure(F.col("confirmed_pct"), F.col("possible_pct"))
    return interval.select("announcement_id", "confirmed_pct", "possible_pct", "lookthrough_confirmed_pct",
                           "unresolved_pct", status.alias("status"))


@query("ag06_exposure_components", f"""WITH {INTERVAL},
parts AS (SELECT CASE WHEN reported THEN 'commodity' ELSE coalesce(category, 'unresolved') END AS category, w200,
    w200 * coalesce(final_pct, 0) AS c, CASE WHEN final_pct IS NULL THEN w200 * 100 ELSE w200 * final_pct END AS p FROM weighed
  UNION ALL SELECT 'unresolved_residual', CAST(round(residual * 200) AS BIGINT), 0, CAST(round(residual * 200) AS BIGINT) * 100
  FROM intervals WHERE residual > 0.01)
SELECT category, CAST(count(*) AS BIGINT) AS positions, round(sum(w200) / 200, 2) AS weight_pct,
  round(sum(c) / 20000, 2) AS confirmed_pct, round(sum(p) / 20000, 2) AS possible_pct FROM parts GROUP BY 1""")
def exposure_components(spark, sf):
    contributed = expo.contributions(expo.resolve_instruments(b.holdings(spark, sf), b.instruments(spark)))
    parts = expo.exposure_components(b.report_totals(spark, sf), contributed)

    def total(name):
        return F.sum(F.col(name).cast("decimal(28,4)")).cast("double")

    return parts.groupBy("category").agg(
        F.count(F.lit(1)).alias("positions"), F.round(total("weight_pct"), 2).alias("weight_pct"),
        F.round(total("confirmed_contribution_pct"), 2).alias("confirmed_pct"),
        F.round(total("possible_contribution_pct"), 2).alias("possible_pct"))


@query("prj02_exposure_warnings", f"""WITH {INTERVAL},
t AS (SELECT CASE WHEN residual > 0.01 THEN 1 ELSE 0 END AS r,
  CASE WHEN round(confirmed, 2) < 50 AND round(least(100, confirmed + unresolved), 2) >= 50 THEN 1 ELSE 0 END AS a FROM intervals)
SELECT 'residual' AS kind, CAST(sum(r) AS BIGINT) AS texts FROM t UNION ALL SELECT 'interval', CAST(sum(a) AS BIGINT) FROM t""")
def exposure_warnings(spark, sf):
    contributed = expo.contributions(expo.resolve_instruments(b.holdings(spark, sf), b.instruments(spark)))
    interval = expo.exposure_interval(b.report_totals(spark, sf), contributed)
    texts = expo.exposure_warnings(interval.withColumn("code", F.col("announcement_id")))
    kind = F.when(F.col("text").contains("之外尚有"), "residual").otherwise("interval")
    return texts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("texts"))


_NORMAL = "regexp_replace(upper(replace({0}, 'ß', 'SS')), '[^A-Z0-9一-鿿]+', '', 'g')"


@query("fn12_normalize_name", f"""SELECT CAST(doc_id AS BIGINT) AS doc_id, md5({_NORMAL.format('text')}) AS digest,
  CAST(length({_NORMAL.format('text')}) AS BIGINT) AS kept_chars FROM documents""")
def normalize(spark, sf):
    """FN-12 over whole document texts."""
    name = normalize_name(F.col("text"))
    return b.table(spark, sf, "documents").select(
        "doc_id", F.md5(name).alias("digest"), F.length(name).cast("long").alias("kept_chars"))


@query("jn05_match_catalog", f"""WITH d AS (SELECT doc_id, {_NORMAL.format('text')} AS t FROM documents),
a(id, alias) AS (VALUES ('w0', 'THEAND'), ('w0', 'OFTHE'), ('w1', 'TION'), ('w2', 'QUE'), ('w2', 'EAUX'), ('w3', 'UNG'),
  ('w4', 'ZZZZ'))
SELECT DISTINCT CAST(doc_id AS BIGINT) AS doc_id, id FROM d JOIN a ON contains(t, alias)""")
def match_catalog(spark, sf):
    """JN-05: which catalog entries each whole document names."""
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    return doc.match_catalog(docs, "doc_id", "text", b.word_catalog(spark)).select("doc_id", "id")


@query("fn18_fund_identity", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code,
  sha256(concat(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), chr(0), c_name, chr(0), c_mktsegment)) AS identity FROM customer""")
def identity(spark, sf):
    code = b.code_of("c_custkey")
    return b.table(spark, sf, "customer").select(
        code.alias("code"), fund_identity(code, F.col("c_name"), F.col("c_mktsegment")).alias("identity"))


@query("fn08_exact_round", """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  sum(l_quantity / 4) AS whole, sum(CASE WHEN l_quantity / 4 - floor(l_quantity / 4) = 0.5
    THEN CASE WHEN CAST(floor(l_quantity / 4) AS BIGINT) % 2 = 0 THEN floor(l_quantity / 4) ELSE ceil(l_quantity / 4) END
    ELSE round(l_quantity / 4) END) AS rounded FROM lineitem GROUP BY 1, 2""")
def half_even(spark, sf):
    """Ties go to the even neighbour; quarters of quantities tie in every fourth row."""
    rows = b.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        (F.col("l_quantity") / 4).alias("quarter"))
    return rows.withColumn("r", exact_round("quarter")).groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("quarter").alias("whole"), F.sum("r").alias("rounded"))
