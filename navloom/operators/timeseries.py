"""Adjusted wealth, trailing performance and the benchmark fit.

``nav`` has one row per ``(code, date)``, so a window over one code holds at
most one row per calendar day however large the input is.  All windows here
share ``partitionBy(code).orderBy(date)``: one exchange and one sort serve the
factors, all horizons and the weekly series.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date, week_start, years_ago
from navloom.functions.numbers import exact_round, is_finite
from navloom.operators.quality import issues_of


def _by_code() -> WindowSpec:
    return Window.partitionBy("code")


def _running() -> WindowSpec:
    return _by_code().orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def visible(df: DataFrame, as_of, *columns: str) -> DataFrame:
    """FLT-08. Only rows all of whose ``columns`` lie on or before ``as_of``."""
    for column in columns:
        df = df.where(F.col(column) <= as_date(as_of))
    return df


def daily_factor(nav: DataFrame, *, as_of, keep: tuple = ()) -> DataFrame:
    """WIN-01. Adjusted growth from the previous point; the first point has none.

    A cash dividend is added back, another event takes the published daily
    return.  ``factor_issue`` names why a factor is missing.
    """
    before = F.lag("nav").over(_by_code().orderBy("date"))
    dividend = F.regexp_extract("unit_money", "(?U)" + fixed.CASH_DIVIDEND, 1)
    growth = (
        F.when(F.col("unit_money") == "", F.col("nav") / F.col("previous_nav"))
        .when(F.col("dividend") != "",
              (F.col("nav") + F.col("dividend").try_cast("double")) / F.col("previous_nav"))
        .otherwise(1 + F.col("equity_return_pct") / 100)
    )
    points = (
        visible(nav, as_of, "date")
        .withColumn("previous_nav", before)
        .withColumn("dividend", dividend)
        .withColumn("growth", growth)
    )
    follows = F.col("previous_nav").isNotNull()
    usable = is_finite(F.col("growth")) & (F.col("growth") > 0)
    issue = (
        F.when(follows & F.col("growth").isNull(), "nav_event_without_return")
        .when(follows & ~usable, "adjusted_factor_invalid")
    )
    return points.select(
        "code", "date", "nav", "previous_nav",
        F.when(follows & usable, F.col("growth")).alias("factor"),
        issue.alias("factor_issue"), *keep,
    )


def wealth_series(nav: DataFrame, *, as_of) -> DataFrame:
    """WIN-02. Wealth from 1.0 at the first point; null after a missing factor."""
    points = daily_factor(nav, as_of=as_of)
    wealth = F.product(F.coalesce("factor", F.lit(1.0))).over(_running())
    # A product skips nulls, so a missing factor must void what follows it.
    broken = F.count("factor_issue").over(_running())
    return points.select("code", "date", F.when(broken == 0, wealth).alias("wealth"))


def _horizon_points(nav: DataFrame, as_of, horizons: dict[int, str], keep: tuple = ()) -> DataFrame:
    """Per point and horizon: anchor, growth since the anchor and drawdown.

    WIN-05: the anchor is the last point on or before the code's own last date
    minus n years.  WIN-03: the peak starts at the anchor.
    """
    points = daily_factor(nav, as_of=as_of, keep=keep).withColumns({
        "last_date": F.max("date").over(_by_code()),
        "last_issue": F.max(F.when(F.col("factor_issue").isNotNull(), F.col("date"))).over(_by_code()),
    })
    anchors = {
        f"anchor_{prefix}": F.max(
            F.when(F.col("date") <= years_ago(F.col("last_date"), years), F.col("date"))
        ).over(_by_code())
        for years, prefix in horizons.items()
    }
    points = points.withColumns(anchors)
    growth = {}
    for prefix in horizons.values():
        after = F.col("date") > F.col(f"anchor_{prefix}")
        # A product skips nulls, so a missing factor voids the whole window.
        whole = F.coalesce(F.col("last_issue") <= F.col(f"anchor_{prefix}"), F.col("last_issue").isNull())
        product = F.product(F.when(after, F.col("factor")).otherwise(1.0)).over(_running())
        growth[f"growth_{prefix}"] = F.when(
            (F.col("date") >= F.col(f"anchor_{prefix}")) & whole, product)
    points = points.withColumns(growth)
    drawdown = {
        f"drawdown_{prefix}":
            F.col(f"growth_{prefix}") / F.max(f"growth_{prefix}").over(_running()) - 1
        for prefix in horizons.values()
    }
    return points.withColumns(drawdown)


def drawdown_series(nav: DataFrame, *, as_of, years: int) -> DataFrame:
    """WIN-03. Growth since the anchor and drawdown from its running peak."""
    points = _horizon_points(nav, as_of, {years: "window"})
    return points.where("date >= anchor_window").select(
        "code", "date", F.col("growth_window").alias("growth"),
        F.col("drawdown_window").alias("drawdown"))


def anchors(nav: DataFrame, *, as_of, horizons: dict[int, str] = fixed.RETURN_HORIZONS) -> DataFrame:
    """WIN-05. First and last date of each trailing window, one row per code."""
    last = visible(nav, as_of, "date").withColumn("last_date", F.max("date").over(_by_code()))
    return last.groupBy("code").agg(
        F.max("date").alias("last_date"),
        *[F.max(F.when(F.col("date") <= years_ago(F.col("last_date"), years), F.col("date")))
          .alias(f"{prefix}_anchor") for years, prefix in horizons.items()])


def performance_record(nav: DataFrame, *, as_of, horizons: dict[int, str] = fixed.RETURN_HORIZONS,
                       weekly_years: int | None = None, page_dates: bool = False) -> DataFrame:
    """AG-02, AG-03, AG-19. Returns and drawdowns of all horizons, one row per code.

    With ``page_dates`` every row of ``nav`` holds its fund's ``page_date``, and the same
    pass gives ``page_nav``, the value of that day (JN-11).

    With ``weekly_years`` the same pass also gives ``weekly``, the last wealth of
    each week of so many years (AG-01): at most 53 points a year.
    """
    points = _horizon_points(nav, as_of, horizons, ("page_date",) if page_dates else ())
    measures = [
        F.min("date").alias("nav_history_start_date"),
        F.max("date").alias("nav_history_end_date"),
        F.count("factor_issue").alias("factor_issue_count"),
    ]
    kept = ["code", "nav_history_start_date", "nav_history_end_date", "factor_issue_count"]
    results = []
    if page_dates:
        measures.append(F.max(F.when(F.col("date") == F.col("page_date"), F.col("nav"))).alias("page_nav"))
        kept.append("page_nav")
    if weekly_years is not None:
        points = points.withColumns({
            "next_date": F.lead("date").over(_by_code().orderBy("date")),
            "wealth": F.when(F.count("factor_issue").over(_running()) == 0,
                             F.product(F.coalesce("factor", F.lit(1.0))).over(_running()))})
        closes = F.col("next_date").isNull() | (week_start(F.col("next_date")) != week_start(F.col("date")))
        recent = F.col("date") >= years_ago(F.col("last_date"), weekly_years)
        measures.append(F.collect_list(F.when(closes & recent, F.struct("date", "wealth"))).alias("weekly"))
        kept.append("weekly")
    for prefix in horizons.values():
        measures += [
            F.max_by(f"growth_{prefix}", "date").alias(f"growth_{prefix}"),
            F.min(f"drawdown_{prefix}").alias(f"drawdown_{prefix}"),
            F.max(f"anchor_{prefix}").alias(f"anchor_{prefix}"),
        ]
        results += [
            exact_round(f"(growth_{prefix} - 1) * 100", 2).alias(f"{prefix}_return_pct"),
            exact_round(f"drawdown_{prefix} * 100", 2).alias(f"{prefix}_max_drawdown_pct"),
            F.col(f"anchor_{prefix}").alias(f"{prefix}_performance_start_date"),
            F.expr(f"if(anchor_{prefix} is null, null, nav_history_end_date)")
            .alias(f"{prefix}_performance_end_date"),
        ]
    return points.groupBy("code").agg(*measures).select(*kept, *results)


def trailing_return(nav: DataFrame, *, as_of, years: int) -> DataFrame:
    """AG-02. Return of one trailing window; null without an anchor."""
    record = performance_record(nav, as_of=as_of, horizons={years: "window"})
    return record.select("code", F.col("window_performance_start_date").alias("start_date"),
                         F.col("window_performance_end_date").alias("end_date"),
                         F.col("window_return_pct").alias("return_pct"))


def max_drawdown(nav: DataFrame, *, as_of, years: int) -> DataFrame:
    """AG-03. Largest fall from a peak inside one trailing window, not above zero."""
    record = performance_record(nav, as_of=as_of, horizons={years: "window"})
    return record.select("code", F.col("window_max_drawdown_pct").alias("max_drawdown_pct"))


def history_issues(performance: DataFrame, severity: str = "fatal") -> DataFrame:
    """AG-19. A missing one or three-year window; fatal because it blocks a run."""
    reason = F.when(F.col("three_year_performance_start_date").isNull()
                    | F.col("one_year_performance_start_date").isNull(), "nav_history_short")
    return issues_of(performance, F.col("code"), reason, F.col("nav_history_start_date"), severity)


def asof_calendar(series: DataFrame, *, on: str = "date", value: str = "value",
                  tolerance_days: int = fixed.MAX_STALENESS_DAYS) -> DataFrame:
    """JN-04. For each day the latest value of one series, at most ``tolerance_days`` old.

    A point is carried to the day before the next one, so no day has two sources.
    A series has one row per calendar day, which bounds the window.
    """
    points = series.groupBy(F.col(on).alias("source_date")).agg(F.max(value).alias("asof_value"))
    following = F.lead("source_date").over(Window.partitionBy(F.lit(0)).orderBy("source_date"))
    last = F.date_add("source_date", tolerance_days)
    until = points.withColumn("until", F.least(last, F.coalesce(F.date_sub(following, 1), last)))
    return until.select(F.explode(F.sequence("source_date", "until")).alias("asof_date"), "source_date", "asof_value")


def asof_join(left: DataFrame, right: DataFrame, *, on: str, by: list[str] = (), value: str = "value",
              tolerance_days: int = fixed.MAX_STALENESS_DAYS) -> DataFrame:
    """JN-03. Backward as-of join; exactly ``tolerance_days`` old is still allowed.

    Time is cut into spans of ``tolerance_days + 1`` days.  The points of a key in
    one span are one sorted array, of at most a point per day; a left row meets its
    own span and the one before, whatever the tolerance.
    """
    width = tolerance_days + 1

    def span(column: Column) -> Column:
        return F.floor(F.date_diff(column, F.lit(date(1970, 1, 1))) / width)

    daily = right.groupBy(*by, F.col(on).alias("source_date")).agg(F.max(value).alias("asof_value"))
    spans = daily.groupBy(*by, span(F.col("source_date")).alias("_span")).agg(
        F.array_sort(F.collect_list(F.struct("source_date", "asof_value"))).alias("points"))
    own = spans.withColumnRenamed("points", "own_points")
    before = spans.withColumn("_span", F.col("_span") + 1).withColumnRenamed("points", "earlier_points")
    key = [*by, "_span"]
    met = left.withColumn("_span", span(F.col(on))).join(own, key, "left").join(before, key, "left")
    nothing = F.array().cast(spans.schema["points"].dataType)
    usable = F.filter(
        F.concat(F.coalesce("earlier_points", nothing), F.coalesce("own_points", nothing)),
        lambda p: (p.source_date <= F.col(on)) & (F.date_diff(F.col(on), p.source_date) <= tolerance_days))
    found = F.try_element_at(usable, F.lit(-1))
    return met.withColumn("_found", found).select(
        *left.columns, F.col("_found.source_date").alias("source_date"), F.col("_found.asof_value").alias("asof_value"))


def benchmark_calendar(index: DataFrame, fx: DataFrame) -> DataFrame:
    """JN-04. Index level in local currency per day, where both series are fresh."""
    level = asof_calendar(index).select("asof_date", F.col("asof_value").alias("index_level"))
    rate = asof_calendar(fx).select("asof_date", F.col("asof_value").alias("fx_rate"))
    return level.join(rate, "asof_date").select(
        F.col("asof_date").alias("date"), (F.col("index_level") * F.col("fx_rate")).alias("level"))


def weekly_last(wealth: DataFrame, *, years: int = fixed.BENCHMARK_WINDOW_YEARS) -> DataFrame:
    """AG-01. Last point of each Monday week, from n years before the last date on."""
    dated = wealth.withColumn("last_date", F.max("date").over(_by_code()))
    recent = dated.where(F.col("date") >= years_ago(F.col("last_date"), years))
    return (
        recent.groupBy("code", week_start(F.col("date")).alias("week"))
        .agg(F.max_by(F.struct("date", "wealth"), "date").alias("p"))
        .select("code", "week", "p.*")
    )


def benchmark_level(weekly: DataFrame, index: DataFrame, fx: DataFrame) -> DataFrame:
    """JN-04. Weekly points that have a benchmark level on their own date."""
    return weekly.join(benchmark_calendar(index, fx), "date")


def weekly_returns(aligned: DataFrame) -> DataFrame:
    """WIN-04. Paired returns of weeks exactly seven days apart."""
    ordered = Window.partitionBy("code").orderBy("week")
    lagged = aligned.withColumns({
        f"previous_{name}": F.lag(name).over(ordered) for name in ("week", "date", "wealth", "level")
    })
    adjacent = lagged.where(F.date_diff("week", "previous_week") == 7)
    return adjacent.select(
        "code", F.col("previous_date").alias("start_date"), F.col("date").alias("end_date"),
        (F.col("wealth") / F.col("previous_wealth") - 1).alias("fund_return"),
        (F.col("level") / F.col("previous_level") - 1).alias("benchmark_return"))


def fit_statistics(pairs: DataFrame) -> DataFrame:
    """AG-04, unrounded. The correlation is guarded, not ``corr``, which fails on a constant."""
    stats = pairs.groupBy("code").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count("fund_return").alias("usable"),
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        F.covar_samp("fund_return", "benchmark_return").alias("cov"),
        F.var_samp("fund_return").alias("fund_var"),
        F.var_samp("benchmark_return").alias("benchmark_var"),
        F.stddev_samp(F.col("fund_return") - F.col("benchmark_return")).alias("active_dev"))
    spread = F.sqrt(F.nullif(F.col("fund_var") * F.col("benchmark_var"), F.lit(0.0)))
    return stats.select(
        "code", "observations", "usable", "start_date", "end_date", "fund_var", "benchmark_var",
        F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cov") / spread)).alias("correlation"),
        (F.col("cov") / F.nullif(F.col("benchmark_var"), F.lit(0.0))).alias("beta"),
        (F.col("active_dev") * F.sqrt(F.lit(float(fixed.WEEKS_PER_YEAR))) * 100)
        .alias("tracking_error_pct"))


def fit_error(min_observations: int, min_span_days: int) -> Column:
    """AG-05. Why a fit cannot be used; it only matters once a fund routes to main."""
    return (
        F.when(F.col("usable") < F.col("observations"), "invalid_wealth")
        .when(F.col("observations") < min_observations, "too_few_observations")
        .when(F.date_diff("end_date", "start_date") < min_span_days, "span_too_short")
        .when((F.col("fund_var") <= 0) | (F.col("benchmark_var") <= 0), "zero_variance")
    )


def weekly_points(performance: DataFrame) -> DataFrame:
    """AG-01. ``weekly`` of ``performance_record`` as rows."""
    rows = performance.select("code", F.explode("weekly").alias("p")).select("code", "p.*")
    return rows.withColumn("week", week_start(F.col("date")))


def fit_weekly(weekly: DataFrame, calendar: DataFrame, *, min_observations: int = fixed.MIN_OBSERVATIONS,
               min_span_days: int = fixed.MIN_SPAN_DAYS) -> DataFrame:
    """AG-04, AG-05. Fit of weekly points; ``calendar`` is ``benchmark_calendar``.

    All funds share the week-end dates, so the calendar is best read from storage:
    with its size known it is broadcast, and only a larger one is shuffled.
    """
    aligned = weekly.join(calendar, "date")
    return gated_fit(fit_statistics(weekly_returns(aligned)), min_observations, min_span_days)


def benchmark_fit(nav: DataFrame, index: DataFrame, fx: DataFrame, *, as_of,
                  min_observations: int = fixed.MIN_OBSERVATIONS,
                  min_span_days: int = fixed.MIN_SPAN_DAYS) -> DataFrame:
    """AG-04, AG-05. Rounded fit per code, or null metrics with ``fit_error``."""
    weekly = weekly_last(wealth_series(nav, as_of=as_of))
    stats = fit_statistics(weekly_returns(benchmark_level(weekly, index, fx)))
    return gated_fit(stats, min_observations, min_span_days)


def gated_fit(stats: DataFrame, min_observations: int, min_span_days: int) -> DataFrame:
    gated = stats.withColumn("fit_error", fit_error(min_observations, min_span_days))
    good = F.col("fit_error").isNull()
    return gated.select(
        "code",
        F.when(good, exact_round("correlation", 4)).alias("correlation"),
        F.when(good, exact_round("beta", 4)).alias("beta"),
        F.when(good, exact_round("tracking_error_pct", 2)).alias("tracking_error_pct"),
        "observations", "start_date", "end_date", "fit_error")


def required_start(as_of, years: int = fixed.BENCHMARK_WINDOW_YEARS) -> Column:
    return F.date_sub(years_ago(as_date(as_of), years), fixed.BENCHMARK_BUFFER_DAYS)


def series_coverage(series: DataFrame, *, as_of, years: int = fixed.BENCHMARK_WINDOW_YEARS) -> DataFrame:
    """AG-13. One row: first and last date and whether the window is covered and fresh."""
    ends = visible(series, as_of, "date").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    slack = fixed.MAX_STALENESS_DAYS
    covered = F.col("first_date") <= F.date_add(required_start(as_of, years), slack)
    fresh = F.date_diff(as_date(as_of), F.col("last_date")) <= slack
    return ends.select("first_date", "last_date", F.coalesce(covered, F.lit(False)).alias("covered"),
                       F.coalesce(fresh, F.lit(False)).alias("fresh"))


def check_monotonic(points: DataFrame) -> DataFrame:
    """WIN-08. Stored points ``(code, seq, date)`` that do not move forward.

    Rows are compared with their successor by an equi join on ``seq``, so that
    one long history needs no single task.
    """
    after = points.select("code", (F.col("seq") - 1).alias("seq"), F.col("date").alias("next_date"))
    pairs = points.select("code", "seq", "date").join(after, ["code", "seq"])
    return pairs.where("next_date <= date")


def reconcile_nav(nav: DataFrame, pages: DataFrame, *, as_of, reloaded: bool = False,
                  last_dates: DataFrame | None = None) -> DataFrame:
    """JN-11. Page's latest NAV against the series: ok, mismatch, page_lead, missing, skipped.

    The value comes by an equi join on code and date, the last date from an
    aggregate or from ``last_dates(code, series_date)``; no history meets its fund
    row by row.
    """
    shown = shown_values(pages)
    values = nav.select("code", F.col("date").alias("page_date"), F.col("nav").alias("series_value"))
    last = last_dates if last_dates is not None else visible(nav, as_of, "date").groupBy("code").agg(
        F.max("date").alias("series_date"))
    seen = shown.join(values, ["code", "page_date"], "left").join(last, "code", "left").select(
        "code", "page_date", "page_value", "series_value", "series_date")
    return seen.withColumn("status", reconcile_status(as_of, reloaded))


def shown_values(pages: DataFrame) -> DataFrame:
    """JN-11. The latest date and value that the pages of every code show."""
    return pages.groupBy("code").agg(
        F.max("latest_nav_date").alias("page_date"), F.max("latest_nav_value").alias("page_value"))


def reconcile_status(as_of, reloaded: bool = False) -> Column:
    """JN-11. Verdict on page_date and page_value beside series_value and series_date."""
    lead = F.date_diff("page_date", "series_date")
    return (
        F.when(F.col("page_date").isNull() | F.col("page_value").isNull()
               | (F.col("page_date") > as_date(as_of)), "skipped")
        .when(F.abs(F.col("series_value") - F.col("page_value")) <= fixed.NAV_MATCH_TOLERANCE, "ok")
        .when(F.col("series_value").isNotNull(), "mismatch")
        .when(F.lit(reloaded) & lead.between(1, fixed.MAX_STALENESS_DAYS), "page_lead")
        .otherwise("missing")
    )


def reconcile_issues(reconciled: DataFrame) -> DataFrame:
    """JN-11. A history that contradicts the fund page, or lacks its date, is fatal."""
    reason = F.when(F.col("status") == "mismatch", "nav_page_mismatch").when(F.col("status") == "missing", "nav_page_missing")
    return issues_of(reconciled, F.col("code"), reason, F.col("page_date"))


def reconcile_warnings(reconciled: DataFrame) -> DataFrame:
    """JN-11. Texts for pages that are ahead of a history that was reloaded."""
    text = F.concat("code", F.lit(" 的基金主页净值已更新至 "), F.col("page_date").cast("string"), F.lit("，历史净值至 "),
                    F.col("series_date").cast("string"), F.lit("，已强制重新验证完整历史并按后者计算。"))
    return reconciled.where("status = 'page_lead'").select(text.alias("text"))


def coverage_issues(coverage: DataFrame, name: str) -> DataFrame:
    """AG-13. A series that does not cover the window or is stale is fatal."""
    both = F.array_compact(F.array(
        F.when(~F.col("covered"), F.lit(f"{name}_not_covered")), F.when(~F.col("fresh"), F.lit(f"{name}_stale"))))
    rows = coverage.select("last_date", F.explode(both).alias("reason"))
    return issues_of(rows, F.lit(name), F.col("reason"), F.col("last_date"))
