from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from navloom import schemas
from navloom.operators import validation as val
from navloom.operators.quality import DataError
from navloom.plans import ranking as plan
from navloom.plans.incremental import Store, parse_once, stored_documents
from navloom.plans.validation import benchmark_metadata, validate_run
from navloom.sources import catalogs, sinks
from tests.compose import report
from tests.test_documents import HELD

D = date
AS_OF = D(2026, 8, 20)
MOVES = [0.01, -0.005, 0.02, -0.004]


def build(spark, change=lambda rows: rows):
    """A run over three funds; ``change`` may alter the ``(announcement_id, text, error)`` rows."""
    nav, index, level = [], [], 100.0
    wealth = {"000001": 1.0, "000002": 1.0, "000003": 1.0}
    for i in range(191):
        day = D(2022, 12, 26) + timedelta(7 * i)
        move = MOVES[i % 4]
        level *= 1 + move
        index.append((day, level))
        for code, factor in (("000001", 1.5), ("000002", 0.9), ("000003", -0.1)):
            wealth[code] *= 1 + factor * move
            nav.append((code, day, wealth[code], None, ""))
    funds = [("000001", "全球成长(QDII)A", "QDII-股票"), ("000002", "亚洲精选(QDII)A", "指数型-海外股票"),
             ("000003", "全球低迷(QDII)A", "QDII-股票")]
    pages = [(c, D(2015, 1, 1), 5.0, D(2026, 6, 30), "open", "开放申购", None, None, None, f"https://p/{c}") for c, _, _ in funds]
    announced, texts = [], []
    for c, _, _ in funds:
        for kind, title, text in (
                ("p", "某基金招募说明书", "本基金的业绩比较基准为92%×纳斯达克100指数收益率+8%×存款利率。"),
                ("s", "某基金(A类份额)基金产品资料概要更新",
                 "业绩比较基准 92%×纳斯达克100指数收益率+8%×存款利率 风险收益特征 基金运作综合费率（年化）0.66%"),
                ("r", "某基金2026年第2季度报告", report(us="60.00", funds="60.00 60.00", holdings=HELD)),
                ("n", "关于调整大额申购限制金额的公告", "限制申购金额（单位：元） 1,000.00")):
            announced.append((c, f"{kind}{c}", title, D(2026, 7, 20), True))
            texts.append((f"{kind}{c}", text, None))
    index_frame = spark.createDataFrame(index, schemas.SERIES)
    fx = spark.createDataFrame([(d, 7.0) for d, _ in index], schemas.SERIES)
    fund_frame = spark.createDataFrame(funds, schemas.FUNDS)
    given = plan.Disclosures(
        spark.createDataFrame(announced, schemas.ANNOUNCEMENTS),
        spark.createDataFrame(change(texts), "announcement_id string, text string, error string"), catalogs.load_benchmarks(spark))
    tables = plan.Tables(
        funds=fund_frame, holder_periods=spark.createDataFrame([(D(2025, 12, 31), 3, "2025_4")], schemas.HOLDER_PERIODS),
        holders=spark.createDataFrame([("2025_4", c, 10.0, 90.0, 1.0) for c, _, _ in funds], schemas.HOLDERS),
        fund_pages=spark.createDataFrame(pages, schemas.FUND_PAGES), nav=spark.createDataFrame(nav, schemas.NAV),
        index_levels=index_frame, fx_rates=fx, instruments=catalogs.load_instruments(spark), disclosures=given)
    params = plan.Params(as_of=AS_OF)
    results = plan.build_ranking(tables, params)
    records = plan.ranking_record(results["ranking"], results["tables"], params).cache()
    metadata = benchmark_metadata(index_frame, fx, "https://index", "https://fx")
    return results, records, metadata


@pytest.fixture(scope="module")
def run(spark):
    return build(spark)


def test_unreadable_report_blocks_publication(spark, tmp_path):
    def lose(rows):
        return [(k, None if k == "r000002" else t, "lost" if k == "r000002" else e) for k, t, e in rows]

    results, records, _ = build(spark, lose)
    assert ("000002", "unreadable") in {(r.code, r.reason) for r in results["issues"].collect()}
    with pytest.raises(DataError):
        plan.publish(results, records, str(tmp_path / "run"))
    assert not (tmp_path / "run").exists()


def test_ranked_records(run):
    results, records, _ = run
    got = {r.code: r for r in records.collect()}
    assert set(got) == {"000001", "000002"}
    first, second = got["000001"], got["000002"]
    assert (first.ranking_list, first.rank) == ("us_main", 1)
    assert (second.ranking_list, second.routing_reason) == ("global_supplement", "us_main_name_geography_override")
    assert first.benchmark_fit.beta == 1.5 and first.benchmark_fit.correlation == 1.0
    assert first.us_equity_exposure.confirmed_pct == 60.0 and len(first.us_equity_exposure.components) == 6
    assert first.direct_limit.amount_cny == 1000 and len(first.quota_source_urls) == 1
    assert first.contract_benchmark.benchmark_id == "nasdaq-100"
    assert first.contract_benchmark.product_summary_status == "matched"
    assert first.holding_cost.annualized_pct == 0.66
    assert first.product_structure_tags == ["主动", "股票/混合", "大盘成长"]
    assert results["issues"].count() == 0
    assert [(r.reason, r.code) for r in results["exclusions"].collect()] == [("three_year_return_below_threshold", "000003")]
    assert results["funnel"].first().full_scan_completed


def test_validation_accepts_and_rejects(run):
    results, records, metadata = run
    assert validate_run(records, results, as_of=AS_OF, benchmark=metadata).collect() == []

    def broken(change, check):
        return {r.rule_id for r in check(change).collect()}

    scaled = records.withColumn("three_year_return_pct", F.lit(29.99))
    assert "record_three_year" in broken(scaled, lambda r: val.check_records(r, as_of=AS_OF))
    assert broken(records.withColumn("five_year_return_pct", F.lit(59.99)), lambda r: val.check_records(r, as_of=AS_OF)) >= {"five_year_threshold"}
    moved = records.withColumn("ranking_list", F.lit("us_main"))
    assert "main_route" in broken(moved, lambda r: val.check_records(r, as_of=AS_OF))
    low = records.withColumn("direct_limit", F.col("direct_limit").withField("amount_cny", F.lit(199).cast("long")))
    assert "direct_threshold" in broken(low, val.check_limits)
    few = records.withColumn("benchmark_fit", F.col("benchmark_fit").withField("observations", F.lit(139).cast("long")))
    assert "fit_observations" in broken(few, lambda r: val.check_fields(r, as_of=AS_OF))
    stale = {r.rule_id for r in val.check_benchmark(metadata, as_of=AS_OF + timedelta(19)).collect()}
    assert stale == {"benchmark_index_stale", "benchmark_fx_stale"}


def test_sinks_and_parity(spark, run, tmp_path):
    results, records, _ = run
    plan.publish(results, records, str(tmp_path / "run"))
    plan.publish(results, records, str(tmp_path / "run"))
    assert sinks.read_latest(spark, str(tmp_path / "run"), records.schema).count() == 2
    flat = sinks.flatten_ranking(records)
    assert len(flat.columns) >= 69
    sinks.write_flat_csv(flat, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"', multiLine=True)
    columns = ["rank", "name", "three_year_return_pct", "nasdaq100_beta", "direct_limit", "contract_benchmark_components"]
    assert val.parity(flat, back, columns, ["code"]).collect() == []
    changed = back.withColumn("nasdaq100_beta", F.lit("1.0"))
    assert {r.rule_id for r in val.parity(flat, changed, columns, ["code"]).collect()} == {"parity_nasdaq100_beta"}


def test_known_documents_are_not_parsed_again(spark, run, tmp_path):
    kinds = ["benchmarks", "costs", "report_sections", "notices"]
    tables = run[0]["tables"]
    given, funds = tables.disclosures, tables.funds.where("code <> '000003'")

    def parse(store, texts=given.texts, catalog=given.benchmarks, funds=funds):
        parsed = plan.parse_documents(given.announcements, texts, funds, catalog, AS_OF, store)
        told = {k: sorted(map(repr, parsed[k].collect())) for k in ("transitions", "report_holdings", "profiles")}
        return told, {k: stored_documents(run[1], store, k).count() for k in kinds}

    store = Store(str(tmp_path / "parsed"))
    told, once = parse(store)
    assert once == {"benchmarks": 4, "costs": 2, "report_sections": 2, "notices": 2}
    assert len(told["transitions"]) == 2 and len(told["report_holdings"]) > 4
    # The second run reads no text at all.
    lost = given.texts.select("announcement_id", F.lit("broken").alias("text"), F.lit("gone").alias("error"))
    assert parse(store, lost) == (told, once)
    # A changed catalog entry: all statements again, nothing else.
    other = given.benchmarks.withColumn("display_name", F.when(F.col("id") == "dax", "DAX 40").otherwise(F.col("display_name")))
    assert parse(store, catalog=other) == (told, once | {"benchmarks": 8})
    # A renamed fund: its own statements and costs again.
    renamed = funds.withColumn("name", F.when(F.col("code") == "000001", "全球成长精选(QDII)A").otherwise(F.col("name")))
    assert parse(store, funds=renamed)[1] == once | {"benchmarks": 10, "costs": 3}


def test_a_failed_document_counts_as_parsed(spark, run, tmp_path):
    """An unreadable notice is stored and not tried again; one whose text has not landed is."""
    given = run[0]["tables"].disclosures
    store = Store(str(tmp_path / "parsed"))
    docs = given.announcements.where("announcement_id like 'n%'").select("announcement_id", "code", "published_date", F.lit("").alias("fund_identity"))

    def parse(texts):
        def found(pending):
            return pending.where("text is not null").select("announcement_id", "fund_identity", F.length("text").alias("n"))
        rows = parse_once(store, "kind", docs, texts, found)
        return {r.announcement_id for r in rows.collect()}, {
            r.announcement_id: r.n_results for r in stored_documents(docs, store, "kind").collect()}

    texts = given.texts.where("announcement_id <> 'n000003'").withColumn(
        "text", F.when(F.col("announcement_id") != "n000002", F.col("text")))
    assert parse(texts) == ({"n000001"}, {"n000001": 1, "n000002": 0})
    assert parse(given.texts) == ({"n000001", "n000003"}, {"n000001": 1, "n000002": 0, "n000003": 1})
