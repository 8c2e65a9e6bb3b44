from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from navloom import schemas
from navloom.operators import timeseries as ts
from navloom.sources.history import bucketed_history

D = date


def nav_frame(spark, rows):
    full = [(r + (None, ""))[:5] if len(r) == 3 else r for r in rows]
    return spark.createDataFrame(full, schemas.NAV)


def record(spark, rows, as_of):
    return {r.code: r for r in ts.performance_record(nav_frame(spark, rows), as_of=as_of).collect()}


def test_return_and_drawdown_golden(spark):
    rows = [("a", D(2023, 8, 18), 1.00), ("a", D(2024, 8, 18), 1.20), ("a", D(2025, 8, 18), 0.90),
            ("a", D(2026, 8, 18), 1.08),
            ("b", D(2023, 8, 18), 1.0), ("b", D(2024, 8, 18), 1.5), ("b", D(2025, 8, 18), 1.2),
            ("b", D(2026, 8, 18), 2.0)]
    got = record(spark, rows, D(2026, 8, 20))
    assert (got["a"].three_year_return_pct, got["a"].three_year_max_drawdown_pct) == (8.0, -25.0)
    assert (got["b"].three_year_return_pct, got["b"].three_year_max_drawdown_pct) == (100.0, -20.0)
    assert got["a"].five_year_return_pct is None and got["a"].five_year_performance_start_date is None


def test_long_horizons(spark):
    rows = [("a", D(2016, 8, 18), 1.0), ("a", D(2021, 8, 18), 2.0), ("a", D(2026, 8, 18), 3.0)]
    got = record(spark, rows, D(2026, 8, 18))["a"]
    assert (got.five_year_return_pct, got.ten_year_return_pct) == (50.0, 200.0)


def test_dividend_and_event_factors(spark):
    nav = nav_frame(spark, [
        ("a", D(2026, 1, 1), 1.0, None, ""), ("a", D(2026, 1, 2), 0.9, None, "每份派现金0.2000元"),
        ("a", D(2026, 1, 3), 0.45, 1.0, "拆分：每份基金份额折算2份"),
        ("b", D(2026, 1, 1), 1.0, None, ""), ("b", D(2026, 1, 2), 0.5, None, "拆分"),
        ("b", D(2026, 1, 3), 0.6, None, "")])
    factors = {(r.code, r.date.day): r for r in ts.daily_factor(nav, as_of=D(2026, 2, 1)).collect()}
    assert factors["a", 2].factor == pytest.approx(1.10)
    assert factors["a", 3].factor == pytest.approx(1.01)
    assert factors["b", 2].factor is None and factors["b", 2].factor_issue == "nav_event_without_return"
    wealth = {(r.code, r.date.day): r.wealth for r in ts.wealth_series(nav, as_of=D(2026, 2, 1)).collect()}
    assert wealth["a", 3] == pytest.approx(1.10 * 1.01)
    # A missing factor voids everything after it instead of being skipped.
    assert wealth["b", 1] == 1.0 and wealth["b", 2] is None and wealth["b", 3] is None


def test_future_rows_change_nothing(spark):
    rows = [("a", D(2023, 1, 2), 1.0), ("a", D(2026, 1, 2), 1.4)]
    base = record(spark, rows, D(2026, 1, 3))
    assert record(spark, rows + [("a", D(2026, 1, 4), 9.0)], D(2026, 1, 3)) == base


def test_asof_tolerance(spark):
    left = spark.createDataFrame([(D(2026, 8, 20),), (D(2026, 8, 19),), (D(2026, 8, 18),)], "date date")
    right = spark.createDataFrame([(D(2026, 8, 12), 5.0), (D(2026, 8, 21), 7.0)], schemas.SERIES)
    got = {r.date.day: r.asof_value for r in ts.asof_join(left, right, on="date").collect()}
    assert got == {20: None, 19: 5.0, 18: 5.0}


def test_asof_matches_brute_force(spark):
    import random
    rng = random.Random(7)
    day0 = D(2026, 1, 1)
    right = [(k, day0 + timedelta(n), float(n)) for k in "xy" for n in range(120) if rng.random() < 0.15]
    left = [(k, day0 + timedelta(rng.randrange(130))) for k in "xyz" for _ in range(60)]
    got = ts.asof_join(spark.createDataFrame(left, "k string, date date"),
                       spark.createDataFrame(right, "k string, date date, value double"), on="date", by=["k"])
    for r in got.collect():
        before = [(d, v) for k, d, v in right if k == r.k and d <= r.date and (r.date - d).days <= 7]
        assert r.asof_value == (max(before)[1] if before else None)


def _fit_inputs(spark, weeks, flat=False):
    moves = [0.01, -0.005, 0.02, -0.012]
    level, wealth, index, nav = 100.0, 1.0, [], []
    for i in range(weeks):
        day = D(2023, 7, 3) + timedelta(7 * i)
        if i:
            level *= 1 + moves[i % 4]
            wealth *= 1 if flat else 1 + 2 * moves[i % 4]
        index.append((day, level))
        nav.append(("a", day, wealth))
    fx = [(d, 1.0) for d, _ in index]
    return (nav_frame(spark, nav), spark.createDataFrame(index, schemas.SERIES),
            spark.createDataFrame(fx, schemas.SERIES), nav[-1][1])


def test_fit_of_twice_the_index(spark):
    nav, index, fx, end = _fit_inputs(spark, 160)
    got = ts.benchmark_fit(nav, index, fx, as_of=end).collect()[0]
    assert (got.correlation, got.beta, got.fit_error) == (1.0, 2.0, None)
    assert got.observations >= 140


def test_fit_gates(spark):
    nav, index, fx, end = _fit_inputs(spark, 20)
    got = ts.benchmark_fit(nav, index, fx, as_of=end).collect()[0]
    assert (got.observations, got.fit_error, got.correlation) == (19, "too_few_observations", None)
    nav, index, fx, end = _fit_inputs(spark, 160, flat=True)
    assert ts.benchmark_fit(nav, index, fx, as_of=end).collect()[0].fit_error == "zero_variance"


def test_one_exchange_serves_all_windows(spark, tmp_path):
    path = str(tmp_path / "nav")
    nav_frame(spark, [("a", D(2023, 1, 2), 1.0), ("a", D(2026, 1, 2), 1.4)]).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ts.performance_record(spark.read.parquet(path), as_of=D(2026, 1, 3)) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(date), LessThanOrEqual(date,2026-01-03)]" in plan


def test_bucketed_history_needs_no_exchange(spark):
    """Record, weekly points and the value of the page's day come from buckets as they lie; the rows are the same."""
    rows = [(f"{c:02d}", D(2021, 1, 1) + timedelta(7 * i), 1.0 + ((c * i) % 17) / 50) for c in range(12) for i in range(200)]
    nav = nav_frame(spark, rows)
    table = bucketed_history(nav, "nav_buckets", 8)
    days = spark.createDataFrame([(f"{c:02d}", D(2021, 1, 1) + timedelta(7 * (c * 9))) for c in range(12)], "code string, page_date date")

    def measured(history):
        # The hint keeps the small side of the test from being broadcast.
        joined = history.join(days.hint("merge"), "code")
        return ts.performance_record(joined, as_of=D(2024, 10, 1), weekly_years=2, page_dates=True)

    def plan_of(df):
        df.collect()  # the plan that was run
        return df._jdf.queryExecution().executedPlan().toString()

    got = measured(table)
    plan = plan_of(got)
    assert plan.count("Exchange hashpartitioning") < plan_of(measured(nav)).count("Exchange hashpartitioning")
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    scan = next(i for i, line in enumerate(lines) if "nav_buckets" in line)
    deep = [line for line in lines[:scan + 1] if "Exchange" in line]
    assert "Bucketed: true" in plan and not deep, plan
    want = {(r.code, r.date): r.nav for r in nav.collect()}
    asked = {r.code: r.page_date for r in days.collect()}
    out = got.collect()
    assert {r.code: r.page_nav for r in out} == {c: want[c, d] for c, d in asked.items()}
    assert sorted(map(str, out)) == sorted(map(str, measured(nav).collect()))


def test_reconcile(spark):
    nav = nav_frame(spark, [("a", D(2026, 8, 19), 1.5)])
    kind = "code string, latest_nav_date date, latest_nav_value double"

    def status(day, value, reloaded=False, as_of=D(2026, 8, 28)):
        pages = spark.createDataFrame([("a", day, value)], kind)
        return ts.reconcile_nav(nav, pages, as_of=as_of, reloaded=reloaded).collect()[0].status

    assert status(D(2026, 8, 19), 1.5) == "ok"
    assert status(D(2026, 8, 19), 1.6) == "mismatch"
    assert status(D(2026, 8, 20), 1.6) == "missing"
    assert status(D(2026, 8, 20), 1.6, True) == "page_lead"
    assert status(D(2026, 8, 28), 1.6, True) == "missing"
    assert status(None, 1.6) == "skipped"
    assert status(D(2026, 8, 20), 1.6, as_of=D(2026, 8, 19)) == "skipped"


def test_coverage_and_monotonic(spark):
    series = spark.createDataFrame([(D(2023, 8, 1), 1.0), (D(2026, 8, 15), 1.0)], schemas.SERIES)
    got = ts.series_coverage(series, as_of=D(2026, 8, 20)).collect()[0]
    assert got.covered and got.fresh
    got = ts.series_coverage(series, as_of=D(2026, 8, 23)).collect()[0]
    assert not got.fresh
    points = spark.createDataFrame([("a", 1, D(2026, 1, 1)), ("a", 2, D(2026, 1, 1)), ("a", 3, D(2026, 1, 2))],
                                   "code string, seq long, date date")
    assert [r.seq for r in ts.check_monotonic(points).collect()] == [1]
