from pyspark.sql import functions as F

from navloom import schemas
from navloom.operators import documents as doc
from navloom.operators import matching, runs
from navloom.plans import incremental
from navloom.sources import raw
from navloom.sources.catalogs import load_benchmarks


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_notices_search_each_channel_once(spark):
    # Not a local relation, which the optimizer would evaluate.
    docs = spark.createDataFrame(spark.sparkContext.emptyRDD(), schemas.DOCUMENTS + ", notice_seq long")
    # Dates, and the words and amounts of two channels.
    assert optimized(doc.parse_notices(docs)).count("regexp_extract_all(") == 5


def test_statements_clean_each_text_once(spark, monkeypatch):
    plans = []
    staged = doc.staged
    monkeypatch.setattr(doc, "staged", lambda df: plans.append(optimized(df)) or staged(df))
    docs = spark.createDataFrame([("f", "a", "F", "本基金的业绩比较基准为标普500指数。")], "code string, announcement_id string, fund_name string, text string")
    statements, _ = doc.parse_benchmarks(docs, load_benchmarks(spark))
    assert [r.statement for r in statements.collect()] == ["标普500指数"]
    assert plans[0].count("translate(") == 1


def test_values_are_counted_once_and_not_shuffled_by_metric(spark):
    rows = spark.range(5000).selectExpr("concat('m', id % 2) as metric", "cast(id * id % 3001 as double) as value")
    ranged = runs.value_ranges(rows)
    assert "Exchange hashpartitioning" not in ranged._jdf.queryExecution().executedPlan().toString()
    seen = ranged.groupBy("metric").agg(F.percentile_approx(
        "value", [i / runs.MEDIAN_RANGES for i in range(1, runs.MEDIAN_RANGES)], runs.SKETCH_ACCURACY).alias("cuts"))
    cuts = {r.metric: r.cuts for r in seen.collect()}
    assert all(r.range == sum(c < r.value for c in cuts[r.metric]) for r in ranged.collect())


def test_repeated_statements_are_matched_once(spark, monkeypatch):
    asked = []
    match_catalog = doc.match_catalog
    monkeypatch.setattr(doc, "match_catalog", lambda texts, *a: asked.append(texts.count()) or match_catalog(texts, *a))
    said = "本基金的业绩比较基准为%s。风险收益特征"
    docs = spark.createDataFrame(
        [("f", "a", "F", said % "60%×标普500指数"), ("g", "b", "G", said % "60%×标普500指数"), ("g", "a", "G", said % "60%×标普500指数"),
         ("h", "c", "纳斯达克100", said % "标的指数"), ("i", "c", "德国DAX指数", said % "标的指数"), ("j", "d", "J", None)],
        "code string, announcement_id string, fund_name string, text string")
    statements, components = doc.parse_benchmarks(docs, load_benchmarks(spark))
    found = sorted((r.code, r.announcement_id, r.benchmark_id, r.weight_pct) for r in components.collect())
    # Both statements once, and the openings of the two funds without an index in theirs.
    assert asked == [2, 2]
    assert found == [("f", "a", "sp-500", 60.0), ("g", "a", "sp-500", 60.0), ("g", "b", "sp-500", 60.0),
                     ("h", "c", "nasdaq-100", 100.0), ("i", "c", "dax", 100.0)]
    assert statements.count() == 5


def test_pending_documents_are_sought_once(spark, tmp_path):
    docs = spark.createDataFrame([(str(i), "") for i in range(6)], "announcement_id string, fund_identity string")
    texts = docs.selectExpr("announcement_id", "announcement_id as text", "cast(null as string) as error")
    store = incremental.Store(str(tmp_path / "store"))

    def parse(rows):
        # The parser reads what is pending from the stage, not through the store again.
        assert any("staged-" in f for f in rows.inputFiles())
        return rows.select("announcement_id", "fund_identity", "text")

    for n in (4, 6):
        some = docs.where(f"cast(announcement_id as int) < {n}")
        assert incremental.parse_once(store, "k", some, texts, parse).count() == n


def test_payloads_are_parsed_once(spark):
    pages = spark.createDataFrame(spark.sparkContext.emptyRDD(), "period_key string, page int, code string, payload string")
    for loaded, searches in ((raw.load_holders(pages), 1), (raw.load_holder_periods(pages), 1), (raw.load_nav(pages), 1)):
        plan = optimized(loaded.rows)
        assert plan.count("from_json(") == 1 and plan.count("regexp_extract(") == searches


def test_few_grams_are_sought_by_one_pattern(spark, monkeypatch):
    texts = spark.createDataFrame([("ABABABC标普500", ), ("",), (None,), ("X" * 300 + "ABC.A.C",), ("BAAB" * 100,)], "t string")
    grams = ["ABA", "ABC", "A", "BAA", "标普5", "A.C"]

    def windows():
        found = matching.candidate_windows(F.col("t"), 9, [1, 3], grams)
        return optimized(texts.select(found.alias("w"))), [r.w for r in texts.select(found.alias("w")).collect()]

    few = windows()
    monkeypatch.setattr(matching, "PATTERN_GRAMS", 0)
    many = windows()
    assert few[1] == many[1] and few[1][0][0] == "ABABABC标普"
    assert few[1][4] and "sequence(" not in few[0]


def test_report_searches_run_once_and_headers_stay_found(spark):
    docs = spark.createDataFrame(spark.sparkContext.emptyRDD(), "code string, announcement_id string, text string")
    # Two headings and net assets of the text, then two amounts, each with its test.
    assert optimized(doc.parse_report_totals(docs)).count("regexp_extract(") == 7
    lines = ["某基金2024年第1季度报告\n 3 \nrest", "a\n某基金 二〇二四 \n 年年度报告\n12\nb", "没有年份 报告\n3\n", "x 2024\ny 年\n2023年年度 报告\n7\n", None]
    texts = spark.createDataFrame([(line,) for line in lines], "t string")
    kept = [r.t for r in texts.select(doc.repair_text(F.col("t")).alias("t")).collect()]
    assert kept == [r.t for r in texts.select(F.regexp_replace("t", doc.fixed.REPORT_PAGE_HEADER, "").alias("t")).collect()]
    assert kept[0] == "rest" and kept[1] == "a\nb"
