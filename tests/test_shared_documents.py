"""Share classes that list the same prospectus and report keep their own facts."""

from datetime import date

from navloom import schemas, session
from navloom.operators import documents as doc
from navloom.operators import exposure as expo
from navloom.plans import ranking as plan
from navloom.sources import catalogs
from tests.test_documents import REPORT

AS_OF = date(2026, 8, 20)


def test_two_codes_on_one_prospectus_and_report(spark):
    codes = ["000001", "000002"]
    announced = [(c, key, title, date(2026, 7, 20), True) for c in codes for key, title in (
        ("P", "某基金招募说明书"), ("R", "某基金2026年第2季度报告"))]
    texts = [("P", "本基金的业绩比较基准为92%×纳斯达克100指数收益率+8%×存款利率。", None), ("R", REPORT, None)]
    funds = spark.createDataFrame([(c, "全球成长(QDII)A", "QDII-股票") for c in codes], schemas.FUNDS)
    parsed = plan.parse_documents(
        spark.createDataFrame(announced, schemas.ANNOUNCEMENTS),
        spark.createDataFrame(texts, "announcement_id string, text string, error string"), funds,
        catalogs.load_benchmarks(spark), AS_OF)
    profiles = {r.code: r.contract_benchmark for r in parsed["profiles"].collect()}
    assert sorted(profiles) == codes and parsed["profiles"].count() == 2
    assert {p.status for p in profiles.values()} == {"recognized"}
    assert {p.benchmark_id for p in profiles.values()} == {"nasdaq-100"}
    assert parsed["report_totals"].count() == 2

    def interval(wanted):
        tables = plan.Tables(*[None] * 7, catalogs.load_instruments(spark), parsed["report_totals"], parsed["report_holdings"])
        reports, contributed = plan.contributed_holdings(tables, spark.createDataFrame([(c,) for c in wanted], "code string"))
        return {r.code: (r.confirmed_pct, r.possible_pct, r.unresolved_pct)
                for r in expo.exposure_interval(reports, contributed).collect()}

    alone, both = interval(codes[:1]), interval(codes)
    assert both == {c: alone["000001"] for c in codes}


def test_no_document_of_another_fund_is_missed(spark):
    """Funds outside the given set neither parse nor raise issues."""
    announced = [("000009", "X", "某基金招募说明书", date(2026, 7, 20), True)]
    funds = spark.createDataFrame([], schemas.FUNDS)
    parsed = plan.parse_documents(
        spark.createDataFrame(announced, schemas.ANNOUNCEMENTS),
        spark.createDataFrame([("X", "text", None)], "announcement_id string, text string, error string"), funds,
        catalogs.load_benchmarks(spark), AS_OF)
    assert parsed["issues"].count() == 0 and parsed["profiles"].count() == 0


def listing(spark, n=12, times=1):
    """``n`` funds on one prospectus, one summary and one report, each listed ``times`` times."""
    codes = [f"{i:06}" for i in range(n)]
    announced = [(c, key, title, date(2026, 7, 20), True) for c in codes for key, title in (
        ("P", "某基金招募说明书"), ("S", "某基金基金产品资料概要"), ("R", "某基金2026年第2季度报告"))] * times
    said = "本基金的业绩比较基准为92%×纳斯达克100指数收益率+8%×存款利率。"
    texts = [("P", said, None), ("S", said + "基金运作综合费率（年化）1.25%", None), ("R", REPORT, None)]
    # Parquet, whose sizes the planner reads.
    return plan.parse_documents(
        session.staged(spark.createDataFrame(announced, schemas.ANNOUNCEMENTS)),
        spark.createDataFrame(texts, "announcement_id string, text string, error string"),
        session.staged(spark.createDataFrame([(c, "全球成长(QDII)A", "QDII-股票") for c in codes], schemas.FUNDS)),
        catalogs.load_benchmarks(spark), AS_OF)


def test_no_table_of_funds_is_broadcast(spark, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.staged(df)

    monkeypatch.setattr(plan, "staged", seen)
    monkeypatch.setattr(doc, "staged", seen)
    profiles = listing(spark)["profiles"]
    plans.append(profiles._jdf.queryExecution().executedPlan().toString())
    joins = [line for p in plans for line in p.splitlines() if "Join [code#" in line]
    assert joins and not [line for line in joins if "Broadcast" in line]
    rows = profiles.collect()
    assert len(rows) == 12
    assert {(r.contract_benchmark.benchmark_id, r.contract_benchmark.product_summary_status, r.holding_cost.annualized_pct)
            for r in rows} == {("nasdaq-100", "matched", 1.25)}


def test_more_funds_mean_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 4)
    # 36 listed documents in tasks of four, which adaptive execution does not gather again.
    profiles = listing(spark)["profiles"]
    assert profiles.count() == 12 and profiles.rdd.getNumPartitions() == 9
    assert session.dealt(profiles, "code", rows=3).rdd.getNumPartitions() == 4


def test_one_copy_of_a_text_leaves_a_task(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(doc, "staged", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or session.staged(df))
    listing(spark)
    above, below = plans[0].split("RepartitionByExpression [announcement_id", 1)
    assert "Aggregate [announcement_id" in below.splitlines()[1]


def test_a_document_listed_twice_counts_once(spark):
    parsed = listing(spark, n=2, times=2)
    assert parsed["profiles"].count() == 2 and parsed["report_totals"].count() == 2
