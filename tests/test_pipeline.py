import json
import os
import shutil
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from navloom import schemas
from navloom.functions.numbers import annualized, return_drawdown_ratio
from navloom.operators import eligibility as elig
from navloom.operators import exposure as expo
from navloom.operators import matching
from navloom.operators import premium as prem
from navloom.operators import quota as quo
from navloom.operators import ranking as rank
from navloom.operators import validation as val
from navloom.operators.quality import DataError, staged_gate
from navloom.sources import catalogs, raw
from navloom.streaming import upserts

D = date


def test_share_class_names(spark):
    cases = [("某全球企业混合(QDII)A", "QDII-混合偏股", True), ("某全球配置(QDII)美元A", "QDII-混合", False),
             ("某全球配置(QDII)C", "QDII-混合", False), ("嘉实美国成长股票人民币", "QDII-股票", True),
             ("嘉实美国成长股票人民币D", "QDII-股票", False), ("嘉实美国成长股票港币", "QDII-股票", False),
             ("普通境内指数人民币A", "指数型-股票", False), ("纳斯达克100ETF人民币A", "指数型-海外股票", False),
             ("纳斯达克100ETF联接人民币A", "指数型-海外股票", True), ("美国成长LOF人民币A", "指数型-海外股票", True),
             ("建信纳斯达克100指数(QDII)A人民币", "指数型-海外股票", True),
             ("建信纳斯达克100指数(QDII)C人民币", "指数型-海外股票", False)]
    df = spark.createDataFrame(cases, "name string, fund_type string, expected boolean")
    wrong = df.where(elig.is_otc_share(F.col("name"), F.col("fund_type")) != F.col("expected"))
    assert wrong.collect() == []


def test_period_selection(spark):
    periods = spark.createDataFrame(
        [(D(2026, 6, 30), 1, "2026_2"), (D(2025, 12, 31), 24419, "2025_4"), (D(2025, 6, 30), 23094, "2025_2")],
        schemas.HOLDER_PERIODS)
    got = elig.select_period(periods)
    assert [r.report_date for r in got.where("selected").collect()] == [D(2025, 12, 31)]
    assert elig.period_warnings(got).count() == 1
    forced = elig.select_period(periods, allow_partial=True).where("selected").collect()
    assert [r.report_date for r in forced] == [D(2026, 6, 30)]


def test_boundaries(spark):
    rows = [("low", 29.99, None, None), ("ok", 30.0, None, None), ("five", 30.0, 59.99, None), ("ten", 40.0, 60.0, 99.99),
            ("none", None, 90.0, None)]
    df = spark.createDataFrame(rows, "code string, three_year_return_pct double, five_year_return_pct double, "
                                     "ten_year_return_pct double")
    got = {r.code: r.f for r in df.select("code", elig.performance_failures().alias("f")).collect()}
    assert got["ok"] == [] and [len(got[c]) for c in ("low", "five", "ten", "none")] == [1, 1, 1, 1]
    limits = spark.createDataFrame([("limited", 199), ("limited", 200), ("unlimited", None), ("unknown", None)],
                                   "s string, a long")
    assert [r.ok for r in limits.select(quo.direct_limit_ok(F.col("s"), F.col("a")).alias("ok")).collect()] \
        == [False, True, True, False]
    routes = spark.createDataFrame([("全球(QDII)A", 50.0), ("全球(QDII)A", 49.99), ("大成港股(QDII)A", 80.0)],
                                   "name string, confirmed_pct double")
    assert [(r.ranking_list, r.routing_reason) for r in elig.with_route(routes).collect()] == [
        ("us_main", "confirmed_us_exposure"), ("global_supplement", "us_exposure_below_threshold"),
        ("global_supplement", "us_main_name_geography_override")]
    score = spark.range(1).select(annualized(F.lit(30.0), F.lit(1096)).alias("a"))
    row = score.select("a", return_drawdown_ratio(F.col("a"), F.lit(0.0)).alias("r")).first()
    assert row.r is None and row.a == pytest.approx(((1.3 ** (365 / 1096)) - 1) * 100)
    funds = spark.createDataFrame([("old", "n", "open", D(2023, 8, 18), 5.0), ("exact", "n", "open", D(2023, 8, 19), 5.0)],
                                  "code string, name string, purchase_status string, inception_date date, scale_100m_cny double")
    assert [r.code for r in elig.filter_eligible(funds, as_of=D(2026, 8, 19), min_scale=3).collect()] == ["old"]


def _interval(spark, direct, total, holdings):
    totals = spark.createDataFrame([("r", D(2026, 6, 30), direct, total, "u")],
                                   "announcement_id string, report_date date, direct_us_pct double, "
                                   "fund_investment_pct double, source_url string")
    rows = spark.createDataFrame([("r", i, n, w, None, D(2026, 6, 30)) for i, (n, w) in enumerate(holdings)],
                                 schemas.REPORT_HOLDINGS + ", report_date date")
    contributed = expo.contributions(expo.resolve_instruments(rows, catalogs.load_instruments(spark)))
    got = expo.exposure_interval(totals, contributed).withColumn(
        "status", expo.classify_exposure(F.col("confirmed_pct"), F.col("possible_pct")))
    return got.first(), expo.exposure_components(totals, contributed).count()


def test_exposure_golden(spark):
    holdings = [("INVESCO QQQ TRUST SERIES 1", 12.09), ("INVESCO SEMICONDUCTORS ETF", 11.82),
                ("PWR S&P 500 EQ WGT TECH", 9.04), ("INVESCO NASDAQ 100 ETF", 6.73), ("VANECK SEMICONDUCTOR ETF", 6.50),
                ("FIRST TRUST NASDQ 100 TECH I", 6.41), ("SPDR BBG BARC 1-3 MONTH TBIL", 5.01),
                ("VANGUARD TOT WORLD STK ETF", 3.76), ("TECHNOLOGY SELECT SECT SPDR", 3.26),
                ("FRK FTSE KOREA UCITS ETF", 2.29)]
    got, parts = _interval(spark, 13.96, 72.4139, holdings)
    assert (got.confirmed_pct, got.status) == (69.81, "qualified") and got.possible_pct > got.confirmed_pct
    assert parts == 11
    assert _interval(spark, 50.0, 0.0, [])[0].status == "qualified"
    assert _interval(spark, 49.99, 0.0, [])[0].status == "excluded"
    assert _interval(spark, 49.99, 1.0, [("UNKNOWN", 1.0)])[0].status == "ambiguous"


def test_alias_hits_of_any_length(spark):
    texts = spark.createDataFrame([(1, "ABCDEFGHIJKL"), (2, "XXBCDYY"), (3, "ZQ"), (4, "")], "k int, t string")
    catalog = spark.createDataFrame([(0, ["CDEFGHIJK", "NOPE"]), (1, ["BCD"]), (2, ["Q"]), (3, ["ABCDEFGHX"])],
                                    "position int, normalized_aliases array<string>")
    assert sorted(map(tuple, matching.alias_hits(texts, "k", "t", catalog).collect())) == [(1, 0), (1, 1), (2, 1), (3, 2)]
    # Matches across the border of two pieces, and a catalog without aliases.
    long = spark.createDataFrame([(n, "A" * n + "CDEFGHIJK") for n in range(240, 262)], "k int, t string")
    assert sorted(r.k for r in matching.alias_hits(long, "k", "t", catalog).where("position = 0").collect()) == list(range(240, 262))
    assert matching.alias_hits(texts, "k", "t", catalog.where("false")).count() == 0
    rows = spark.createDataFrame([("r", 1, "Invesco QQQ Trust Series 1", 1.0, None, D(2026, 6, 30)),
                                  ("r", 2, "nothing", 1.0, None, D(2026, 6, 30))], schemas.REPORT_HOLDINGS + ", report_date date")
    got = {r.rank: r.category for r in expo.resolve_instruments(rows, catalogs.load_instruments(spark)).collect()}
    assert got == {1: "us_equity", 2: None}


def test_main_tie_breaks(spark):
    rows = [("001", 0.96, 1.25, 71.0, 10.0, 100.0), ("002", 0.95, 1.25, 70.0, 20.0, 90.0),
            ("003", 0.95, 1.0, 70.0, 20.0, 90.0), ("004", 0.95, 1.5, 70.0, 20.0, 80.0)]
    df = spark.createDataFrame(rows[::-1], "code string, correlation double, beta double, confirmed_pct double, "
                                           "institution_pct double, three_year_return_pct double")
    ranked = rank.rank_main(df.withColumn("ranking_list", F.lit("us_main")), 3)
    assert [r.code for r in ranked.orderBy("rank").collect()] == ["001", "003", "002"]
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan


def _quote(**change):
    base = dict(code="513500", arrival=1, price=2.672, iopv=2.4493, source_discount_pct=-9.09, change_pct=-0.11,
                turnover_cny=228746612.0, quote_date_raw="20260821", updated_seconds=1787299916, quote_name="")
    return tuple({**base, **change}.values())


def test_quotes(spark):
    catalog = spark.createDataFrame([("513500", "标普500ETF博时", "SSE", 1, "broad_market", "标普500", "https://x"),
                                     ("513100", "b", "SSE", 1, "broad_market", "纳指100", "https://x")], schemas.EXCHANGE_FUNDS)

    def check(rows, day=D(2026, 8, 21)):
        got = prem.validate_quotes(spark.createDataFrame(rows, schemas.QUOTES), catalog, as_of=day)
        return {r.code: r.reject_reason for r in got.collect()}

    assert check([_quote()]) == {"513500": None}
    assert check([_quote()], D(2026, 8, 20)) == {"513500": "future_data"}
    assert check([_quote(source_discount_pct=-1.0)]) == {"513500": "premium_mismatch"}
    # A repeated and an unknown code: no valid row; the other catalog code is missing.
    rows = [_quote(), _quote(arrival=2), _quote(code="999999")]
    assert check(rows) == {"513500": "duplicate_response"}
    quotes = spark.createDataFrame(rows, schemas.QUOTES)
    assert [r.code for r in prem.missing_codes(catalog, quotes).collect()] == ["513100"]
    empty = spark.createDataFrame([], schemas.PREMIUM_RECORDS + ", seq long")
    cold = prem.premium_snapshot(catalog, quotes, empty, as_of=D(2026, 8, 21))
    assert {r.quote_status for r in cold.collect()} == {"unavailable"}
    assert prem.snapshot_status(cold).first().status == "unavailable"


def test_streamed_quotes_and_announcements(spark, tmp_path):
    catalog = spark.createDataFrame([("513500", "a", "SSE", 1, "broad_market", "标普500", "https://x")], schemas.EXCHANGE_FUNDS)
    source, state, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))

    def land(*rows):
        spark.createDataFrame(list(rows), schemas.QUOTES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.QUOTES).parquet(source)
        upserts.stream_quotes(stream, catalog, state, mark, as_of=D(2026, 8, 21)).awaitTermination()
        return upserts.premium_state(spark, state).first().change_pct

    assert land(_quote()) == -0.11
    assert land(_quote(change_pct=0.5)) == 0.5
    assert land(_quote(change_pct=0.7), _quote(change_pct=0.8)) == 0.5  # repeated rows keep the old value
    assert land(_quote(price=-1.0)) == 0.5
    upserts.compact(spark, state, ["code"])
    upserts.compact(spark, state, ["code"])
    assert upserts.premium_state(spark, state).count() == 1
    assert land(_quote(change_pct=0.9)) == 0.9  # later batches over the snapshot
    upserts.compact(spark, state, ["code"])
    assert upserts.premium_state(spark, state).first().change_pct == 0.9
    kind = schemas.ANNOUNCEMENTS + ", arrival long"
    spark.createDataFrame([("f", "1", "new", D(2026, 1, 2), True, 2), ("f", "1", "mid", D(2026, 1, 2), True, 1)], kind) \
        .write.parquet(str(tmp_path / "a"))
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "a"))
    upserts.stream_announcements(stream, str(tmp_path / "t"), str(tmp_path / "m")).awaitTermination()
    seeded = spark.createDataFrame([("f", "1", "old", D(2026, 1, 1), False), ("f", "2", "x", D(2026, 1, 1), False),
                                    ("f", "3", "future", D(2027, 1, 1), False)], schemas.ANNOUNCEMENTS)
    merged = upserts.announcement_state(spark, str(tmp_path / "t"), seeded, as_of=D(2026, 2, 1))
    assert {(r.announcement_id, r.title) for r in merged.collect()} == {("1", "new"), ("2", "x")}


def test_stored_premium_order(spark):
    good = [(1, "b", 3.0), (2, "a", 2.0), (3, "c", 2.0), (4, "d", None)]
    schema = "rank int, code string, premium_pct double"
    assert val.check_premium_order(spark.createDataFrame(good, schema)).count() == 0
    bad = [(1, "b", 3.0), (2, "c", 2.0), (3, "a", 2.0), (4, "d", None), (5, "e", 1.0)]
    assert {r.key for r in val.check_premium_order(spark.createDataFrame(bad, schema)).collect()} == {"a", "e"}


def test_funds_without_visible_announcements(spark):
    codes = spark.createDataFrame([("1",), ("2",)], "code string")
    listed = spark.createDataFrame([("1", "x", "t", D(2026, 1, 1), True), ("2", "y", "t", D(2027, 1, 1), True)], schemas.ANNOUNCEMENTS)
    found = raw.invisible_announcements(codes, listed, D(2026, 8, 1)).collect()
    assert [(r.code, r.reason, r.severity) for r in found] == [("2", "announcements_missing", "fatal")]


def test_gate(spark):
    fatal = spark.createDataFrame([("f", "r", None, "fatal")], schemas.ISSUES)
    warned = spark.createDataFrame([("f", "r", None, "warning")] * 3, schemas.ISSUES)
    for issues, ranked, counts in ((fatal.union(warned), 1, (1, 1)), (warned, 0, (0, 0)), (fatal.where("false"), 0, (0, 0))):
        judged = staged_gate(issues, spark.range(ranked))
        assert judged[:2] == counts and not judged.publishable
        with pytest.raises(DataError):
            judged.check()
    staged_gate(warned, spark.range(1)).check()


def test_gate_computes_its_tables_once(spark):
    """The counts come from the write itself: an accumulator of all evaluations ends at the number of rows."""
    calls = spark.sparkContext.accumulator(0)

    def batches(frames):
        for frame in frames:
            calls.add(len(frame))
            yield frame

    issues = spark.createDataFrame([("f", "r", None, "warning")] * 7, schemas.ISSUES).mapInPandas(batches, schemas.ISSUES)
    judged = staged_gate(issues, spark.range(5))
    judged.check()
    assert calls.value == 7 and judged.issues.count() == 7 and judged.ranked.count() == judged.record_count == 5
    assert calls.value == 7


def test_catalog_of_another_version_is_refused(spark, tmp_path):
    entry = {"id": "x", "display_name": "X", "aliases": ["X index"], "market_scope": "us", "market_label": "us",
             "asset_class": "equity", "style_label": "s", "structure": "standard", "excluded_target": False}
    for version in (1, 2):
        (tmp_path / f"{version}.json").write_text(json.dumps({"schema_version": version, "entries": [entry]}))
    good = catalogs.load_benchmarks(spark, str(tmp_path / "1.json"))
    assert good.count() == 1 and catalogs.check_benchmarks(good).count() == 0
    assert {r.rule_id for r in catalogs.check_benchmarks(good.withColumn("id", F.lit(None).cast("string"))).collect()} == {"benchmark_id"}
    with pytest.raises(DataError):
        catalogs.load_benchmarks(spark, str(tmp_path / "2.json"))
    first = catalogs.fingerprint(good).first().fingerprint
    assert first == catalogs.fingerprint(good.repartition(3)).first().fingerprint
    assert first != catalogs.fingerprint(good.withColumn("id", F.lit("y"))).first().fingerprint


def test_default_catalogs(spark):
    loaded = catalogs.load_exchange_funds(spark)
    assert loaded.issues.count() == 0 and loaded.rows.count() == 25
    assert catalogs.check_benchmarks(catalogs.load_benchmarks(spark)).count() == 0
    assert len(catalogs.fingerprint(catalogs.load_instruments(spark)).first().fingerprint) == 64


def test_queries_have_sql():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80
    assert os.path.exists("/root/testdata/sf0.001")


def test_queries_without_the_training_data_operators(tmp_path):
    """A copy of the tree without those folders still lists its queries; so does one that kept the pipeline's file."""
    root = Path(__file__).resolve().parent.parent
    left_out = shutil.ignore_patterns("llm", "tests", ".git", "__pycache__", "corpus_pipeline.py")
    shutil.copytree(root, tmp_path / "tree", ignore=left_out)
    ask = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"

    def listed():
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        return subprocess.run([sys.executable, "-c", ask], cwd=tmp_path / "tree", env=env, capture_output=True, text=True, check=True).stdout

    assert listed().endswith("[]\n")
    (tmp_path / "tree" / "corpus_pipeline.py").write_text("import navloom.llm.simhash\n")
    assert listed().endswith("[]\n")
