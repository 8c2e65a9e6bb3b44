"""Candidate discovery, eligibility and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date, years_ago
from navloom.functions.numbers import annualized, return_drawdown_ratio
from navloom.functions.text import has_any
from navloom.operators.quality import issues_of


def is_rmb_a_share(name: Column, fund_type: Column) -> Column:
    """FLT-01. RMB A or explicit RMB primary share of an overseas fund."""
    in_scope = fund_type.startswith(fixed.QDII_PREFIX) | (fund_type == fixed.OVERSEAS_INDEX_TYPE)
    rejected = name.rlike("(?U)" + fixed.SHARE_REJECT)
    return in_scope & ~rejected & (name.rlike(fixed.SHARE_ACCEPT) | name.contains("人民币"))


def is_otc_share(name: Column, fund_type: Column) -> Column:
    """FLT-02. No exchange-only fund; feeders and LOFs stay."""
    upper = F.upper(name)
    listed = upper.contains("ETF") & ~name.contains("联接") & ~upper.contains("LOF")
    return is_rmb_a_share(name, fund_type) & ~listed


def is_excluded_type(fund_type: Column) -> Column:
    """FLT-03. Bond and commodity types."""
    return fund_type.isin(fixed.EXCLUDED_FUND_TYPES)


def select_period(periods: DataFrame, *, coverage: float = fixed.PERIOD_COVERAGE,
                  allow_partial: bool = False) -> DataFrame:
    """WIN-06. Periods with ``selected`` and ``skipped`` flags.

    ``periods`` has one row per half year, so the window without a partition
    holds at most two rows per calendar year.
    """
    newest_first = Window.partitionBy(F.lit(0)).orderBy(F.col("report_date").desc())
    older = F.lead("fund_count").over(newest_first)
    complete = older.isNull() | (F.col("fund_count") >= F.ceil(older * F.lit(coverage)))
    flagged = periods.withColumn("older_count", older).withColumn(
        "complete", F.lit(True) if allow_partial else complete)
    accepted = F.count_if("complete").over(
        newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return flagged.withColumn("accepted", accepted).select(
        "report_date", "fund_count", "period_key", "older_count",
        (F.col("complete") & (F.col("accepted") == 1)).alias("selected"),
        (F.col("accepted") == 0).alias("skipped"))


def period_warnings(selection: DataFrame) -> DataFrame:
    """WIN-06. One warning per skipped period."""
    text = F.format_string(
        "跳过未完整披露的持有人报告期 %s：仅 %d 只基金，低于上一报告期（%d 只）。",
        F.col("report_date").cast("string"), "fund_count", "older_count")
    return selection.where("skipped").select(F.lit(0).cast("long").alias("seq"), text.alias("text"))


def build_candidates(holders: DataFrame, funds: DataFrame, keywords=()) -> DataFrame:
    """JN-01. Holder rows of in-scope funds; the filters run before the join."""
    name, kind = F.col("name"), F.col("fund_type")
    scope = funds.where(
        is_otc_share(name, kind) & ~is_excluded_type(kind) & ~has_any(name, keywords))
    held = holders.where("institution_pct is not null")
    return held.join(scope.select("code", "name", "fund_type"), "code")


def enrich(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """JN-02. Candidates with their page; ``page_found`` is false where it is missing."""
    found = pages.withColumn("page_found", F.lit(True))
    return candidates.join(found, "code", "left").withColumn(
        "page_found", F.coalesce("page_found", F.lit(False)))


def missing_pages(enriched: DataFrame) -> DataFrame:
    """JN-02. Fatal issues of candidates without a page."""
    return issues_of(enriched, F.col("code"), F.when(~F.col("page_found"), "fund_page_missing"))


def filter_eligible(df: DataFrame, *, as_of, min_scale: float | None = None,
                    min_age_years: int = fixed.MIN_AGE_YEARS, exclude_keywords=()) -> DataFrame:
    """FLT-05. Open or limited, strictly larger and strictly older than the limits."""
    kept = df.where(F.col("purchase_status").isin("open", "limited"))
    if min_scale is not None:
        kept = kept.where(F.col("scale_100m_cny") > min_scale)
    if min_age_years:
        kept = kept.where(F.col("inception_date") < years_ago(as_date(as_of), min_age_years))
    return kept.where(~has_any(F.col("name"), exclude_keywords))


def top_holders(df: DataFrame, n: int | None = None) -> DataFrame:
    """SRT-05. Institution share descending, code ascending; optionally the first n."""
    ordered = df.orderBy(F.col("institution_pct").desc(), "code")
    return ordered if n is None else ordered.limit(n)


def performance_failures(thresholds: dict[int, float] = fixed.MIN_RETURN_PCT) -> Column:
    """FLT-06. Names of the failed return thresholds.

    Three years must be there and pass; longer windows only fail when present.
    """
    checks = []
    for years, limit in thresholds.items():
        prefix = fixed.RETURN_HORIZONS[years]
        value = F.col(f"{prefix}_return_pct")
        failed = value < limit
        if years == fixed.BENCHMARK_WINDOW_YEARS:
            failed = failed | value.isNull()
        checks.append(F.when(failed, f"{prefix}_return_below_threshold"))
    return F.array_compact(F.array(*checks))


def route(name: Column, confirmed_pct: Column, *, keywords=tuple(fixed.GEOGRAPHY_KEYWORDS),
          threshold: float = fixed.MIN_US_EQUITY_PCT) -> tuple[Column, Column]:
    """PRJ-01. Ranking list and reason; a geography keyword comes first."""
    geography = has_any(name, keywords)
    reason = (
        F.when(geography, fixed.ROUTE_GEOGRAPHY)
        .when(confirmed_pct >= threshold, fixed.ROUTE_CONFIRMED)
        .otherwise(fixed.ROUTE_BELOW)
    )
    in_main = ~geography & F.coalesce(confirmed_pct >= threshold, F.lit(False))
    return F.when(in_main, fixed.MAIN_LIST).otherwise(fixed.SUPPLEMENT_LIST), reason


def with_route(df: DataFrame, **params) -> DataFrame:
    chosen, reason = route(F.col("name"), F.col("confirmed_pct"), **params)
    return df.withColumn("ranking_list", chosen).withColumn("routing_reason", reason)


def management_style(name: Column, fund_type: Column) -> Column:
    """PRJ-04."""
    passive = (fund_type == fixed.OVERSEAS_INDEX_TYPE) & ~name.contains("增强")
    return F.when(passive, "passive").otherwise("active")


def product_tags(style: Column, fund_type: Column, style_label: Column, status: Column,
                 structure: Column) -> Column:
    """PRJ-05. Ordered tags: management, type, style, special structure."""
    from navloom.functions.display import label

    special = label(structure, fixed.STRUCTURE_TAGS, F.lit(None))
    known = ~style_label.isin(fixed.UNRECOGNIZED, fixed.COMPOSITE_STYLE)
    return F.array_distinct(F.array_compact(F.array(
        F.when(style == "passive", "被动").otherwise("主动"),
        label(fund_type, fixed.TYPE_TAGS, F.lit("股票/混合")),
        F.when(known, style_label).when(status == "composite", fixed.COMPOSITE_STYLE),
        special)))


def with_score(df: DataFrame) -> DataFrame:
    """FN-05, FN-06. Annualized three-year return and its ratio to the drawdown."""
    days = F.date_diff("three_year_performance_end_date", "three_year_performance_start_date")
    scored = df.withColumn("annualized_pct", annualized(F.col("three_year_return_pct"), days))
    return scored.withColumn(
        "drawdown_ratio",
        return_drawdown_ratio(F.col("annualized_pct"), F.col("three_year_max_drawdown_pct")))
