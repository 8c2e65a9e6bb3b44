from datetime import date

import pytest
from pyspark.sql import functions as F

from navloom import schemas
from navloom.functions.dates import report_period_end
from navloom.functions.text import (
    match_spans, normalize_instrument, product_structure, share_aggregation,
)
from navloom.operators import documents as doc
from navloom.sources import catalogs
from tests.compose import day, report

D = date

START = {k: D(2031, m, d) for k, (m, d) in dict(
    cap=(2, 3), after=(3, 9), direct=(4, 5), channels=(5, 6), all=(6, 7), many=(7, 8), auto=(8, 9), open=(9, 10)).items()}
LATER = D(2031, 8, 20)
# One notice a branch: (publication date, text).
NOTICES = {
    "cap": (D(2031, 2, 1), f"自{day(START['cap'])}起，客户在本公司柜台的累计申购，\n甲乙成长（QDII）每日合并不应超过人民币3万元。"),
    "unit": (D(2031, 2, 2), "限制申购金额 （单位：元） 7,500.00"),
    "after": (D(2031, 3, 1), f"暂停业务 起始 日 {START['after'].year} 年 3 月 9 日\n丙丁份额的累计申购，每户每日不应超过 40 人民币元。"),
    "total": (D(2031, 3, 2), "每日转入的金额累计限额为35.00元"),
    "split": (D(2031, 3, 3), "\n".join("业务限额为") + "\n6\n,\n200\n.\n00\n元"),
    "direct": (D(2031, 4, 1), f"自{day(START['direct'])}起限制申购金额（单位：人民币元） 900.00，不同份额分别计算。\n"
                              "客户在直销渠道的累计申购高于8万元时，本公司可以拒绝。"),
    "both": (D(2031, 4, 2), "限制申购金额 300 元。\n在直销销售机构每日不得超过6万元；\n在非直销销售机构每日不得超过300元。"),
    "later": (D(2031, 4, 3), "恢复大额申购的具体时间，本公司将另行公告。"),
    "channels": (D(2031, 5, 1), f"自{day(START['channels'])}起调整。直销机构的A类基金份额、C类基金份额合计金额超过9万元可以拒绝。\n"
                                "代销机构继续暂停办理700元以上的业务。"),
    "all": (D(2031, 6, 1), f"自{day(START['all'])}起限制申购金额（单位：人民币元） 80,000.00\n"
                           "客户在全部销售机构累计，A类人民币份额或C类人民币份额均不超过此数。"),
    "many": (D(2031, 7, 1), f"自{day(START['many'])}起，每户业务限额为4,500.00元。\n经多家销售渠道的业务累计计算，各份额单独计算限额。"),
    "auto": (D(2031, 8, 1), f"暂停业务起始日 {day(START['auto'])}\n限制大额申购金额（单位：元） 600\n"
                            f"自{day(LATER)}起，恢复后暂停接受超过300万元的申购。"),
    "open": (D(2031, 9, 1), f"自{day(START['open'])}起恢复大额申购。"),
}


@pytest.fixture(scope="module")
def transitions(spark):
    rows = [("f", k, d, f"u/{k}", t, None, i) for i, (k, (d, t)) in enumerate(NOTICES.items())]
    docs = spark.createDataFrame(rows, schemas.DOCUMENTS + ", notice_seq long")
    parsed = doc.parse_notices(docs)
    failed = {r.announcement_id for r in doc.failed_notices(docs, parsed).collect()}
    out = {}
    for r in parsed.collect():
        out.setdefault(r.announcement_id, []).append(r)
    return out, failed


def test_notices(transitions):
    got, failed = transitions
    base = {k: min(v, key=lambda r: r.transition_seq) for k, v in got.items()}
    amounts = {k: (r.global_amount_cny, r.direct_amount_cny, r.agency_amount_cny) for k, r in base.items()}
    assert amounts["cap"] == (30000, None, None)
    assert amounts["unit"] == (7500, None, None)
    assert amounts["after"] == (40, None, None)
    assert amounts["total"][0] == 35 and amounts["split"][0] == 6200
    assert amounts["direct"][:2] == (900, 80000)
    assert base["direct"].share_aggregation == "A/C separate"
    assert amounts["both"] == (300, 60000, 300)
    assert amounts["channels"][1:] == (90000, 700) and base["channels"].share_aggregation == "A/C combined"
    assert amounts["all"][0] == 80000 and base["all"].all_channels_combined
    assert amounts["many"][0] == 4500 and base["many"].all_channels_combined
    assert base["many"].share_aggregation == "A/C separate"
    assert {k: base[k].effective_date for k in START} == START
    dated = {r.effective_date: r.global_amount_cny for r in got["auto"]}
    assert dated == {START["auto"]: 600, LATER: 3000000}
    assert base["open"].global_status == "unlimited"
    assert failed == {"later"}


HELD = [("ALPHA US ETF", "指数基 金 开放式", "House One", "40.00 40.00"), ("BETA ETF", "ETF 交易型开放式", "House One", "10.00 10.00"),
        ("GAMMA STOCK ETF", "股 票 型 交易型开放式", "House Two", "5.00 5.00"),
        ("DELTA METAL ETF", "商 品 型 开放式", "House Two", "5.00 5.00"),
        ("EPSILON GOLD ETF", "ETF 契约型开放式", "House Two", "5.00 5.00"),
        ("ZETA EQUITY ETF", "权 益 类 交易型开放式", "House Two", "5.00 5.00")]
REPORT = report(us="10.00", funds="60.00 60.00", holdings=HELD, spaced=True)
NO_FUNDS = report()
# Two share classes, both numbers split over lines.
WRAPPED = report(funds="1,800,000,000.00 90.00", net=("\n人民币A类 1,200,000,00\n0.00\n人民币C类", "800,000,00\n0.00"),
                 holdings=[("甲指数 ETF 乙丙", "ETF基金 交易型开放式", "乙丙基金", "1,800,000,000.00 90.00")])
# A row whose cells are wrapped; the report has no country table.
WRAPPED_ROW = "\n".join(["", "前十名基金投资明细", "1", "甲乙指数", "追踪", "200ETF", "（QDII）", "QDII 交易型开", "放式", "甲乙基金", "管理有限", "公司",
                         "3,210,987,654.32 77.25", "5.10 投资组合报告附注", ""])


def test_reports(spark):
    texts = {"a": REPORT, "b": NO_FUNDS, "c": WRAPPED, "d": WRAPPED_ROW, "e": None}
    docs = spark.createDataFrame([("f", k, None, None, t, None) for k, t in texts.items()], schemas.DOCUMENTS)
    totals = {r.announcement_id: r for r in doc.parse_report_totals(docs).collect()}
    assert (totals["a"].direct_us_pct, totals["a"].fund_investment_pct) == (10.0, 60.0)
    assert (totals["b"].direct_us_pct, totals["b"].fund_investment_pct) == (0.0, 0.0)
    assert (totals["c"].direct_us_pct, totals["c"].fund_investment_pct) == (0.0, 90.0)
    assert totals["d"].report_issue == "country_table_missing" and totals["e"].report_issue == "unreadable"
    rows = {}
    for r in doc.parse_holdings(docs).orderBy("row_seq").collect():
        assert r.row_issue is None
        rows.setdefault(r.announcement_id, []).append(r)
    assert [r.weight_pct for r in rows["a"]] == [40.0, 10.0, 5.0, 5.0, 5.0, 5.0]
    assert rows["a"][0].fund_name == "ALPHA US ETF" and rows["a"][3].reported_category == "commodity"
    assert [r.weight_pct for r in rows["c"]] == [90.0]
    assert [(r.fund_name, r.weight_pct) for r in rows["d"]] == [("甲乙指数 追踪 200ETF （QDII）", 77.25)]


def test_number_repair(spark):
    text = "12,345,678,90\n1.23 next 9,876,543,210\n.98 end"
    got = spark.createDataFrame([(text,)], "t string").select(doc.repair_text(F.col("t")).alias("t")).first().t
    assert "12,345,678,901.23" in got and "9,876,543,210.98" in got


def test_benchmarks(spark):
    texts = {
        "single": "业绩比较基准 93%×罗素1000 成长指数收益率+7%×存款利率 风险收益特征",
        "later": "前文提到标的指数。\n业绩比较基准 91%×纳斯达克100指数收益率+9%×存款利率 风险收益特征",
        "two": "本基金的业绩比较基准为70%×纳斯达克100指数收益率+30%×恒生指数收益率。",
        "low": "本基金的业绩比较基准为55%×MSCI所有国家世界指数+45%×国债收益率。",
        "opening": "甲乙纳斯达克100指数基金。业绩比较基准为标的指数收益率。",
        "none": "没有说明",
    }
    docs = spark.createDataFrame([("f", k, None, None, t, None) for k, t in texts.items()], schemas.DOCUMENTS)
    statements, components = doc.parse_benchmarks(
        docs.withColumn("fund_name", F.lit("甲乙成长股票人民币")), catalogs.load_benchmarks(spark))
    got = {r.announcement_id: r for r in doc.benchmark_profiles(statements, components).collect()}
    assert (got["single"].benchmark_id, got["single"].benchmark_weight_pct) == ("russell-1000-growth", 93.0)
    assert (got["later"].benchmark_id, got["later"].benchmark_weight_pct) == ("nasdaq-100", 91.0)
    assert got["two"].status == "composite"
    assert [(c.benchmark_id, c.weight_pct) for c in got["two"].components] == [("nasdaq-100", 70.0), ("hang-seng", 30.0)]
    assert (got["low"].status, got["low"].benchmark_weight_pct) == ("recognized", 55.0)
    assert got["opening"].benchmark_id == "nasdaq-100"
    assert "none" not in got


def test_costs(spark):
    texts = {"ok": "基金运作综合费率 （ 年化 ） 0.84% 另注：测算日期为 2026 年 07 月 02 日。",
             "none": "未披露综合费率", "future": "基金运作综合费率（年化）1.20% 测算日期为2026年08月21日"}
    docs = spark.createDataFrame([("f", k, None, None, t, None) for k, t in texts.items()], schemas.DOCUMENTS)
    got = {r.announcement_id: r for r in doc.parse_costs(docs, as_of=D(2026, 8, 20)).collect()}
    assert (got["ok"].annualized_pct, got["ok"].measurement_date) == (0.84, D(2026, 7, 2))
    assert got["none"].cost_issue == "expense_missing" and got["future"].cost_issue == "measurement_in_future"


def test_small_text_functions(spark):
    titles = ["某基金2026年第2季度报告", "某基金二〇二六年半年度报告", "某基金2025年年度报告",
              "某基金2026年第2季度报告摘要", "某基金2026年年度报告提示性公告"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string")
    got = [r.d for r in df.select("i", report_period_end(F.col("t")).alias("d")).orderBy("i").collect()]
    assert got == [D(2026, 6, 30), D(2026, 6, 30), D(2025, 12, 31), None, None]
    words = ["纳斯达克100两倍做多", "标普500反向", "VIX指数", "风险章节说明基金不得形成杠杆"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "i int, t string")
    got = [r.s for r in df.select("i", product_structure(F.col("t"), F.lit("standard")).alias("s"))
           .orderBy("i").collect()]
    assert got == ["leveraged", "inverse", "volatility", "standard"]
    df = spark.createDataFrame([("两类份额分开计算。", "甲乙纳斯 达克100 交易型开 放式", "ab12cd3")],
                               "a string, b string, c string")
    row = df.select(share_aggregation(F.col("a")).alias("a"), normalize_instrument(F.col("b")).alias("b"),
                    match_spans(F.col("c"), r"\d+").alias("c")).first()
    assert row.a == "A/C separate" and row.b == "甲乙纳斯达克100交易型开放式"
    assert [(s.start, s.stop, s.found) for s in row.c] == [(2, 4, "12"), (6, 7, "3")]
