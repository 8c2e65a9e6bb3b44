"""Catalog files, streams, sinks and record checks: planted faults and round trips."""

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.operators import documents as doc
from navloom.operators import validation as val
from navloom.operators.quality import union_all
from navloom.plans import ranking as plan
from navloom.session import checkpoint_folder
from navloom.sources import sinks
from navloom.sources.catalogs import load_benchmarks
from navloom.streaming import upserts
from workload import bindings as b
from workload.q_premium import PREMIUM
from workload.q_ranking import RUN, _run, params
from workload.q_text import STATEMENT
from workload.registry import query


CATALOG_ENTRIES = 1000


def folder(spark) -> str:
    """A new folder beside the staged tables."""
    return f"{checkpoint_folder(spark)}/landing-{uuid.uuid4().hex}"


@query("src09_catalog_file", """SELECT CAST(p_partkey AS VARCHAR) AS id, upper(replace(p_name, ' ', '')) AS alias, p_brand AS market_label,
  p_size > 40 AS excluded_target FROM part""")
def catalog_file(spark, sf):
    """A JSON catalog of the parts, written and loaded again."""
    entries = b.table(spark, sf, "part").selectExpr(
        "cast(p_partkey as string) as id", "p_name as display_name", "array(p_name, '') as aliases", "'us' as market_scope",
        "p_brand as market_label", "'equity' as asset_class", "'s' as style_label", "'standard' as structure",
        "p_size > 40 as excluded_target")
    path = folder(spark)
    # Documents of some CATALOG_ENTRIES entries, each a file of its own; an empty catalog is one empty document.
    groups = max(1, -(-entries.count() // CATALOG_ENTRIES))
    held = entries.groupBy(F.expr(f"pmod(xxhash64(id), {groups}L)").alias("g")).agg(F.collect_list(F.struct("*")).alias("e"))
    spark.range(groups).join(held, F.col("id") == F.col("g"), "left").select(
        F.lit(1).alias("schema_version"), F.coalesce("e", F.array()).alias("entries")
    ).write.option("maxRecordsPerFile", 1).json(path)
    return load_benchmarks(spark, path).select(
        "id", F.element_at("normalized_aliases", 1).alias("alias"), "market_label", "excluded_target")


@query("jn05_large_catalog", """WITH d AS (SELECT doc_id, regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z0-9一-鿿]+', '', 'g') AS t FROM documents),
a AS (SELECT DISTINCT upper(replace(c_name, '#', '')) AS n, c_custkey FROM customer),
e AS (SELECT DISTINCT c_custkey % 1200 AS position, CASE c_custkey % 6 WHEN 0 THEN 'ERTHE' WHEN 1 THEN 'TION' WHEN 2 THEN 'UNGDER' WHEN 3 THEN 'QUELA'
  WHEN 4 THEN 'THEAND' ELSE 'ANDTHE' END || CASE WHEN c_custkey % 1200 < 12 THEN '' ELSE CAST(c_custkey % 1200 AS VARCHAR) END AS alias FROM customer)
SELECT DISTINCT CAST(doc_id AS BIGINT) AS doc_id, CAST(position AS BIGINT) AS position FROM d JOIN e ON contains(t, alias)""")
def large_catalog(spark, sf):
    """JN-05 with a catalog of 1,200 entries over whole documents; the plan is that of a small one."""
    alias = ("concat(case c_custkey % 6 when 0 then 'ERTHE' when 1 then 'TION' when 2 then 'UNGDER' when 3 then 'QUELA' when 4 then 'THEAND'"
             " else 'ANDTHE' end, if(c_custkey % 1200 < 12, '', cast(c_custkey % 1200 as string)))")
    catalog = b.table(spark, sf, "customer").selectExpr(
        "cast(c_custkey % 1200 as int) as position", f"array({alias}) as normalized_aliases").distinct()
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    return doc.match_catalog(docs, "doc_id", "text", catalog).select("doc_id", F.col("position").cast("long").alias("position"))


@query("str01_stream_quotes", f"""WITH {PREMIUM} SELECT code, round(price, 4) AS market_price_cny, CAST(2.04 AS DOUBLE) AS premium_pct
FROM checked WHERE reason IS NULL""")
def stream_quotes(spark, sf):
    """Event quotes landed as one file set and taken in one available-now batch."""
    source, state, marks = folder(spark), folder(spark), folder(spark)
    quotes = b.quotes(spark, sf)
    quotes.write.parquet(source)
    stream = spark.readStream.schema(quotes.schema).parquet(source)
    upserts.stream_quotes(stream, b.premium_catalog(spark, sf), state, marks, as_of=b.EVENTS_AS_OF).awaitTermination()
    upserts.compact(spark, state, ["code"])
    return upserts.premium_state(spark, state).select("code", "market_price_cny", "premium_pct")


@query("str02_stream_announcements", """WITH ann AS (SELECT lpad(CAST(n_chars % 97 AS VARCHAR), 6, '0') AS code, lpad(CAST(doc_id AS VARCHAR), 9, '0') AS announcement_id,
  doc_id % 6 AS kind, CAST(DATE '2024-01-01' + CAST(doc_id % 700 AS INTEGER) AS DATE) AS published_date FROM documents)
SELECT code, announcement_id, kind >= 2 AS is_new, published_date FROM ann WHERE published_date <= DATE '2025-06-30'""")
def stream_announcements(spark, sf):
    """Landed rows replace seeded ones; of two arrivals of an id the later one wins."""
    source, table, marks = folder(spark), folder(spark), folder(spark)
    rows = b.announcements(spark, sf).withColumn("kind", F.expr("cast(announcement_id as bigint) % 6"))
    late = rows.where("kind >= 2").drop("kind").withColumn("title", F.lit("new")).withColumn("arrival", F.lit(2).cast("long"))
    late.unionByName(late.withColumn("title", F.lit("old")).withColumn("arrival", F.lit(1).cast("long"))).write.parquet(source)
    stream = spark.readStream.schema(late.schema).parquet(source)
    upserts.stream_announcements(stream, table, marks).awaitTermination()
    merged = upserts.announcement_state(spark, table, rows.where("kind < 4").drop("kind"), as_of=b.NOTICES_AS_OF)
    return merged.select("code", "announcement_id", (F.col("title") == "new").alias("is_new"), "published_date")


@query("str02_late_arrivals", """SELECT lpad(CAST(n_chars % 97 AS VARCHAR), 6, '0') AS code, lpad(CAST(doc_id AS VARCHAR), 9, '0') AS announcement_id,
  CASE WHEN doc_id % 6 >= 3 THEN 'third' ELSE 'second' END AS title, CAST(CASE WHEN doc_id % 6 >= 3 THEN 3 ELSE 2 END AS BIGINT) AS arrival,
  CAST(1 AS BIGINT) AS batches_left FROM documents""")
def late_arrivals(spark, sf):
    """Three batches, the second of late rows, the third with repeated ones: arrivals decide, and two batches are folded away."""
    source, table, marks = folder(spark), folder(spark), folder(spark)
    rows = b.announcements(spark, sf)

    def land(*parts):
        for title, arrival, chosen in parts:
            rows.where(chosen).withColumn("title", F.lit(title)).withColumn("arrival", F.lit(arrival).cast("long")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        upserts.stream_announcements(stream, table, marks, compact_batches=2).awaitTermination()

    kind = "cast(announcement_id as bigint) % 6"
    land(("second", 2, "true"))
    land(("first", 1, "true"))
    land(("third", 3, f"{kind} >= 3"), ("second", 2, f"{kind} < 3"))
    left = spark.read.parquet(f"{table}/log").agg(F.count_distinct("batch_id").alias("batches_left"))
    found = upserts.state(spark, table, ["code", "announcement_id"])
    return found.join(F.broadcast(left), F.lit(True)).select("code", "announcement_id", "title", "arrival", "batches_left")


@query("snk01_latest_run", """WITH s AS (SELECT s_suppkey, s_acctbal FROM supplier)
SELECT 'history' AS shown, DATE '2001-07-24' AS run_date, CAST(count(*) AS BIGINT) AS records, CAST(sum(s_suppkey) AS BIGINT) AS keys FROM s
UNION ALL SELECT 'history', DATE '2001-07-25', count(*), sum(s_suppkey) FROM s WHERE s_acctbal > 1000
UNION ALL SELECT 'latest', DATE '2001-07-25', count(*), sum(s_suppkey) FROM s WHERE s_acctbal > 1000
UNION ALL SELECT 'of a date', DATE '2001-07-24', count(*), sum(s_suppkey) FROM s""")
def latest_run(spark, sf):
    """Two dates, a rerun of the second and an attempt at a third that fails half-way."""
    path = folder(spark)

    def records(day, chosen="true"):
        return b.table(spark, sf, "supplier").where(chosen).selectExpr("s_suppkey", "s_acctbal", f"date'{day}' as run_date")

    sinks.write_run(records("2001-07-24"), path)
    sinks.write_run(records("2001-07-25", "s_acctbal >= 0"), path)
    sinks.write_run(records("2001-07-25", "s_acctbal > 1000"), path)
    broken = records("2001-07-26").withColumn("s_acctbal", F.expr("if(s_suppkey = 7, raise_error('lost'), s_acctbal)"))
    try:
        sinks.write_run(broken, path)
        raise AssertionError("the attempt must fail")
    except PySparkException:
        pass
    schema = records("2001-07-24").schema
    shown = [("history", sinks.read_history(spark, path, schema)), ("latest", sinks.read_latest(spark, path, schema)),
             ("of a date", sinks.read_run(spark, path, schema, "2001-07-24"))]
    return union_all([frame.groupBy(F.lit(name).alias("shown"), "run_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("s_suppkey").alias("keys")) for name, frame in shown])


@query("txt11_document_profiles", """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code,
  CASE c_nationkey % 5 WHEN 0 THEN 'recognized' WHEN 1 THEN 'composite' WHEN 2 THEN 'recognized' WHEN 3 THEN 'recognized' ELSE 'unrecognized' END AS status,
  CASE c_nationkey % 5 WHEN 0 THEN 'nasdaq-100' WHEN 2 THEN 'dax' WHEN 3 THEN 'msci-world' END AS benchmark_id,
  CASE WHEN c_nationkey >= 20 THEN 'missing' WHEN c_nationkey % 5 = 4 THEN 'unreadable' WHEN c_nationkey % 5 = 3 THEN 'conflict' ELSE 'matched' END AS product_summary_status,
  CASE WHEN c_nationkey < 20 THEN c_nationkey + CAST(0.25 AS DOUBLE) END AS annualized_pct FROM customer""")
def document_profiles(spark, sf):
    """TXT-11: all customers of a nation list one prospectus and one summary."""
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    code = b.code_of("c_custkey").alias("code")
    funds = customers.select(code, F.col("c_name").alias("name"), F.lit("QDII-股票").alias("fund_type"))
    kinds = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"
    segment = F.expr(f"element_at(array{kinds}, c_nationkey % 5 + 1)")
    nations = customers.select(F.col("c_nationkey")).distinct().withColumn("c_mktsegment", segment)
    prospectus = nations.select(F.expr("concat('P', c_nationkey)").alias("announcement_id"), F.expr(STATEMENT).alias("text"))
    summary = nations.where("c_nationkey < 20").select(
        F.expr("concat('S', c_nationkey)").alias("announcement_id"), F.expr(
            f"concat(replace({STATEMENT}, 'MSCI世界指数', '日经225指数'), ' 基金运作综合费率（年化）', c_nationkey, '.25%')").alias("text"))
    texts = prospectus.unionByName(summary).withColumn("error", F.lit(None).cast("string"))
    listed = customers.select(code, F.expr("concat('P', c_nationkey)").alias("announcement_id"), F.lit("某基金招募说明书").alias("title")).unionByName(
        customers.where("c_nationkey < 20").select(code, F.expr("concat('S', c_nationkey)").alias("announcement_id"),
                                                   F.lit("某基金(A类份额)基金产品资料概要更新").alias("title")))
    announcements = listed.withColumns({"published_date": F.expr("date'2000-01-01'"), "on_latest_page": F.lit(True)})
    profiles = plan.parse_documents(announcements, texts, funds, load_benchmarks(spark), b.AS_OF)["profiles"]
    contract = F.col("contract_benchmark")
    return profiles.select("code", contract.status.alias("status"), contract.benchmark_id.alias("benchmark_id"),
                           contract.product_summary_status.alias("product_summary_status"),
                           F.col("holding_cost.annualized_pct").alias("annualized_pct"))


@query("prj06_ranking_record", f"""{RUN}, parts AS (SELECT l_suppkey, count(*) AS n, 92 - sum(w) / 100 AS rest FROM cut GROUP BY 1)
SELECT fund AS code, ranking_list, CAST(rank AS BIGINT) AS rank, confirmed AS confirmed_pct, direct_status,
  CAST(n + CASE WHEN rest > 0.01 THEN 1 ELSE 0 END AS BIGINT) AS components,
  CASE WHEN ranking_list = 'global_supplement' THEN round(ratio, 4) END AS ratio
FROM ranked JOIN parts ON l_suppkey = s_suppkey""")
def ranking_record(spark, sf):
    """PRJ-06, SNK-01: nested records, written as a run and read back."""
    return _read_run(spark, sf).select(
        "code", "ranking_list", F.col("rank").cast("long").alias("rank"),
        F.col("us_equity_exposure.confirmed_pct").alias("confirmed_pct"), F.col("direct_limit.status").alias("direct_status"),
        F.size("us_equity_exposure.components").cast("long").alias("components"),
        F.round("return_drawdown_ratio", 4).alias("ratio"))


def _records(spark, sf):
    out = _run(spark, sf)
    tables = out["tables"]
    codes = out["ranking"].select("code")
    none = F.lit(None).cast("date")
    components = "array<struct<benchmark_id:string,weight_pct:double>>"
    contract = F.struct(
        F.lit("unreadable").alias("status"), F.lit("-").alias("benchmark_text"), F.lit(None).cast("string").alias("benchmark_id"),
        F.lit("-").alias("benchmark_name"), F.lit(None).cast("double").alias("benchmark_weight_pct"), F.lit("unknown").alias("market_scope"),
        F.lit("-").alias("market_label"), F.lit("unknown").alias("asset_class"), F.lit("-").alias("style_label"),
        F.lit("standard").alias("structure"), F.lit(False).alias("excluded_target"), F.array().cast(components).alias("components"),
        F.lit("active").alias("management_style"), F.lit("").alias("prospectus_title"), none.alias("prospectus_published_date"),
        F.lit("").alias("source_url"), F.lit("missing").alias("product_summary_status"), none.alias("product_summary_published_date"),
        F.lit("").alias("product_summary_source_url"))
    cost = F.struct(F.lit("unavailable").alias("status"), F.lit(None).cast("double").alias("annualized_pct"), none.alias("measurement_date"),
                    F.lit("").alias("source_title"), none.alias("source_published_date"), F.lit("").alias("source_url"))
    tables = plan.replace(tables, profiles=codes.select("code", contract.alias("contract_benchmark"), cost.alias("holding_cost")))
    return plan.ranking_record(out["ranking"], tables, params())


def _read_run(spark, sf):
    records, path = _records(spark, sf), folder(spark)
    sinks.write_run(records, path)
    sinks.write_run(records, path)  # a rerun replaces its own date
    return sinks.read_history(spark, path, records.schema)


@query("snk02_flat_export", f"""{RUN} SELECT fund AS code, CAST(rank AS VARCHAR) AS rank, name, ranking_list FROM ranked""")
def flat_export(spark, sf):
    """The flat export written as CSV and read back as text."""
    path = folder(spark)
    sinks.write_flat_csv(sinks.flatten_ranking(_records(spark, sf)), path)
    return spark.read.csv(path, header=True, escape='"', multiLine=True).select("code", "rank", "name", "ranking_list")


@query("dq02_check_records", f"""{RUN} SELECT rule_id, fund AS code FROM (
  SELECT fund, rank, unnest([CASE WHEN rank = 1 THEN 'record_rank' END, CASE WHEN rank = 2 THEN 'record_name' END,
    CASE WHEN rank = 3 THEN 'record_type' END, CASE WHEN rank = 4 THEN 'record_purchase' END,
    CASE WHEN rank = 5 THEN 'record_age' END, CASE WHEN rank = 6 THEN 'record_three_year' END,
    CASE WHEN rank = 7 THEN 'exposure_interval' END, CASE WHEN rank = 8 THEN 'exposure_source' END]) AS rule_id FROM ranked)
WHERE rule_id IS NOT NULL""")
def check_records(spark, sf):
    """One fault planted for each rank of either list, checked against the limits of the run."""
    at = F.col("rank")
    wide = F.col("us_equity_exposure").withField("possible_pct", F.when(at == 7, 100.5).otherwise(F.col("us_equity_exposure.possible_pct")))
    records = _records(spark, sf).withColumn("us_equity_exposure", wide.withField(
        "source_url", F.when(at == 8, "").otherwise(F.col("us_equity_exposure.source_url"))))
    broken = records.withColumns({
        "name": F.when(at == 2, "").otherwise(F.col("name")),
        "fund_type": F.when(at == 3, fixed.EXCLUDED_FUND_TYPES[0]).otherwise(F.col("fund_type")),
        "purchase_status": F.when(at == 4, "suspended").otherwise(F.col("purchase_status")),
        "inception_date": F.when(at == 5, F.lit(b.RUN_AS_OF)).otherwise(F.col("inception_date")),
        "three_year_return_pct": F.when(at == 6, -99.5).otherwise(F.col("three_year_return_pct")),
    }).withColumn("rank", F.when(at == 1, 99).otherwise(at))
    found = val.check_records(broken, as_of=b.RUN_AS_OF, limits=params().limits())
    planted = ["record_rank", "record_name", "record_type", "record_purchase", "record_age", "record_three_year",
               "exposure_interval", "exposure_source"]
    return found.where(F.col("rule_id").isin(planted)).select("rule_id", F.col("key").alias("code"))


@query("dq08_check_limits", f"""{RUN} SELECT rule_id, fund AS code FROM (
  SELECT fund, unnest([CASE WHEN rank = 1 THEN 'direct_status' END, CASE WHEN rank = 2 THEN 'agency_status' END,
    CASE WHEN rank = 1 OR rank = 3 THEN 'direct_threshold' END]) AS rule_id FROM ranked) WHERE rule_id IS NOT NULL""")
def check_limits(spark, sf):
    at = F.col("rank")
    records = _records(spark, sf)
    direct = F.col("direct_limit").withField("status", F.when(at == 1, "unknown").when(at == 3, "limited").otherwise(F.col("direct_limit.status")))
    direct = direct.withField("amount_cny", F.when(at == 1, 0).when(at == 3, 1).otherwise(F.col("direct_limit.amount_cny")).cast("long"))
    agency = F.col("agency_limit").withField("status", F.when(at == 2, "odd").otherwise(F.col("agency_limit.status")))
    found = val.check_limits(records.withColumns({"direct_limit": direct, "agency_limit": agency}), params().limits())
    return found.where("rule_id in ('direct_status', 'agency_status', 'direct_threshold')").select("rule_id", F.col("key").alias("code"))


@query("dq09_check_fields", f"""{RUN} SELECT rule_id, fund AS code FROM (
  SELECT fund, unnest([CASE WHEN rank = 1 THEN 'contract_status' END, CASE WHEN rank = 2 THEN 'contract_structure' END,
    CASE WHEN rank = 3 THEN 'contract_summary' END, CASE WHEN rank = 4 THEN 'cost_status' END, CASE WHEN rank = 5 THEN 'cost_empty' END,
    CASE WHEN rank = 6 AND ranking_list = 'us_main' THEN 'fit_observations' END]) AS rule_id FROM ranked) WHERE rule_id IS NOT NULL""")
def check_fields(spark, sf):
    at, records = F.col("rank"), _records(spark, sf)

    def planted(column, changes):
        out = F.col(column)
        for field, place, value in changes:
            out = out.withField(field, F.when(at == place, value).otherwise(F.col(f"{column}.{field}")))
        return out

    broken = records.withColumns({
        "contract_benchmark": planted("contract_benchmark", [
            ("status", 1, "odd"), ("structure", 2, "odd"), ("product_summary_status", 3, "odd")]),
        "holding_cost": planted("holding_cost", [("status", 4, "odd"), ("annualized_pct", 5, 1.0)]),
        "benchmark_fit": planted("benchmark_fit", [("observations", 6, 1)])})
    rules = ["contract_status", "contract_structure", "contract_summary", "cost_status", "cost_empty", "fit_observations"]
    found = val.check_fields(broken, as_of=b.RUN_AS_OF, limits=params().limits())
    return found.where(F.col("rule_id").isin(rules)).select("rule_id", F.col("key").alias("code"))


@query("dq03_closure_check", """WITH f AS (SELECT c_nationkey AS n, count(*) AS c FROM customer GROUP BY 1)
SELECT rule_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest([CASE WHEN n % 7 = 0 THEN 'closure_scan' END,
  CASE WHEN n % 7 = 1 THEN 'closure_documents' END, CASE WHEN n % 7 IN (1, 2) THEN 'closure_routes' END,
  CASE WHEN n % 7 = 3 THEN 'closure_main_quota' END, CASE WHEN n % 7 = 4 THEN 'closure_supplement_quota' END,
  CASE WHEN n % 7 = 5 THEN 'closure_flag' END]) AS rule_id FROM f) WHERE rule_id IS NOT NULL GROUP BY rule_id""")
def closure_check(spark, sf):
    """One funnel a nation, counted from its customers; six of seven have a counter that is off."""
    counted = b.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    off = {i: F.expr(f"if(n % 7 = {i}, 1, 0)") for i in range(7)}
    funnels = counted.select(
        F.col("c").alias("base_candidates_total"), (F.col("c") - off[0]).alias("performance_candidates_scanned"),
        F.col("c").alias("performance_qualified_count"), (F.col("c") - off[1]).alias("us_equity_candidates_scanned"),
        (F.col("c") - off[2]).alias("us_routed_count"), F.lit(0).cast("long").alias("global_routed_count"),
        (F.col("c") - off[2] + off[3]).alias("us_quota_qualified_count"), off[4].cast("long").alias("global_quota_qualified_count"),
        (off[5] == 0).alias("full_scan_completed"))
    return val.check_closure(funnels).groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))


@query("dq05_check_benchmark", """WITH m AS (SELECT n_nationkey AS n, min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last
  FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT rule_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest([CASE WHEN n % 5 = 0 THEN 'benchmark_currency' END,
  CASE WHEN n % 5 = 1 THEN 'benchmark_window' END, CASE WHEN n % 5 = 2 THEN 'benchmark_minimum' END,
  CASE WHEN n % 5 = 3 THEN 'benchmark_index_source' END, CASE WHEN n % 5 = 4 THEN 'benchmark_fx_dates' END,
  CASE WHEN last > DATE '2001-06-30' THEN 'benchmark_index_dates' END,
  CASE WHEN date_diff('day', last, DATE '2001-06-30') > 7 THEN 'benchmark_index_stale' END]) AS rule_id FROM m)
WHERE rule_id IS NOT NULL GROUP BY rule_id""")
def check_benchmark(spark, sf):
    """One benchmark description a nation, with a planted fault each."""
    orders = b.table(spark, sf, "orders").join(b.table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
    ends = orders.groupBy(F.col("c_nationkey").alias("n")).agg(
        F.expr("cast(min(o_orderdate) as date)").alias("first"), F.expr("cast(max(o_orderdate) as date)").alias("last"))
    metadata = ends.selectExpr(
        "if(n % 5 = 0, 'USD', 'CNY') as currency", f"if(n % 5 = 1, 1, {fixed.BENCHMARK_WINDOW_YEARS}) as window_years",
        f"if(n % 5 = 2, 1, {fixed.MIN_OBSERVATIONS}) as min_observations", f"{fixed.MIN_SPAN_DAYS} as min_span_days",
        "first as index_start_date", "last as index_latest_date", "if(n % 5 = 4, date_add(date'2001-06-30', 1), first) as fx_start_date",
        "date'2001-06-30' as fx_latest_date", "if(n % 5 = 3, '', 'https://i.test/') as index_source_url", "'https://f.test/' as fx_source_url")
    return val.check_benchmark(metadata, as_of=b.AS_OF).groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
