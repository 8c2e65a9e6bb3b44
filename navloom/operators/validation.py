"""Checks of a finished run; each returns ``(rule_id, key, message)`` rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date, years_ago
from navloom.functions.numbers import (
    annualized, exact_round, is_finite, premium_check, return_drawdown_ratio,
)
from navloom.functions.text import has_any
from navloom.operators.premium import snapshot_status
from navloom.operators.quality import Rule, union_all, violations
from navloom.operators.ranking import duplicate_codes, set_difference

_SIX_DIGITS = r"^\d{6}$"
_SHA256 = r"^[0-9a-f]{64}$"


@dataclass(frozen=True)
class Limits:
    """What a run was asked for; records are checked against these, not against the defaults."""

    top: int = fixed.TOP
    min_age_years: int = fixed.MIN_AGE_YEARS
    min_return_pct: dict = field(default_factory=lambda: dict(fixed.MIN_RETURN_PCT))
    min_us_equity_pct: float = fixed.MIN_US_EQUITY_PCT
    min_direct_limit_cny: int = fixed.MIN_DIRECT_LIMIT_CNY
    main_exclude_keywords: tuple = tuple(fixed.GEOGRAPHY_KEYWORDS)
    min_observations: int = fixed.MIN_OBSERVATIONS
    min_span_days: int = fixed.MIN_SPAN_DAYS


DEFAULTS = Limits()


def _no(condition: Column) -> Column:
    """Violated unless the condition is known to hold."""
    return ~F.coalesce(condition, F.lit(False))


def check_records(ranking: DataFrame, *, as_of, limits: Limits = DEFAULTS) -> DataFrame:
    """DQ-02. Scope, eligibility, threshold, window and routing rules of each record."""
    day = as_date(as_of)
    main = F.col("ranking_list") == fixed.MAIN_LIST
    geography = has_any(F.col("name"), limits.main_exclude_keywords)
    confirmed = F.col("us_equity_exposure.confirmed_pct")
    possible = F.col("us_equity_exposure.possible_pct")
    reason = F.col("routing_reason")
    rules = [
        Rule("record_code", _no(F.col("code").rlike(_SIX_DIGITS)), "code is not six digits"),
        Rule("record_rank", _no(F.col("rank").between(1, limits.top)), "rank is outside the list"),
        Rule("record_name", _no(F.col("name") != ""), "name is missing"),
        Rule("record_scope", _no(F.col("fund_type").startswith(fixed.QDII_PREFIX)
                                 | (F.col("fund_type") == fixed.OVERSEAS_INDEX_TYPE)), "type is out of scope"),
        Rule("record_type", F.col("fund_type").isin(fixed.EXCLUDED_FUND_TYPES), "type is excluded"),
        Rule("record_purchase", _no(F.col("purchase_status").isin("open", "limited")), "not purchasable"),
        Rule("record_scale", _no(is_finite(F.col("scale_100m_cny")) & (F.col("scale_100m_cny") >= 0)),
             "scale is invalid"),
        Rule("record_age", _no(F.col("inception_date") < years_ago(day, limits.min_age_years)),
             "not strictly older than the minimum age"),
        Rule("record_three_year", _no(F.col("three_year_return_pct") >= limits.min_return_pct[3]),
             "three-year return below the threshold"),
        Rule("record_numbers", _no(is_finite(F.col("one_year_return_pct"))
                                   & is_finite(F.col("one_year_max_drawdown_pct"))
                                   & is_finite(F.col("three_year_max_drawdown_pct"))), "a metric is missing"),
        Rule("record_history", _no((F.col("nav_history_start_date") <= F.col("nav_history_end_date"))
                                   & (F.col("nav_history_end_date") <= day)), "history dates are invalid"),
        Rule("exposure_interval", _no((confirmed >= 0) & (confirmed <= possible) & (possible <= 100)),
             "exposure interval is invalid"),
        Rule("exposure_source", _no(F.col("us_equity_exposure.source_url") != ""), "exposure has no source"),
        Rule("main_route", main & _no((reason == fixed.ROUTE_CONFIRMED) & ~geography
                                      & (confirmed >= limits.min_us_equity_pct)
                                      & (F.col("us_equity_exposure.status") == "qualified")),
             "main-list routing is inconsistent"),
        Rule("supplement_route", ~main & _no(
            ((reason == fixed.ROUTE_GEOGRAPHY) & geography)
            | ((reason == fixed.ROUTE_BELOW) & ~geography & (confirmed < limits.min_us_equity_pct))),
            "supplement routing is inconsistent"),
    ]
    for years in (5, 10):
        prefix = fixed.RETURN_HORIZONS[years]
        value = F.col(f"{prefix}_return_pct")
        start, end = F.col(f"{prefix}_performance_start_date"), F.col(f"{prefix}_performance_end_date")
        rules += [
            Rule(f"{prefix}_dates", value.isNull() & (start.isNotNull() | end.isNotNull()),
                 "incomplete window has dates"),
            Rule(f"{prefix}_window", value.isNotNull() & _no(
                (start <= end) & (end <= day) & (start <= years_ago(end, years))), "window is incomplete"),
            Rule(f"{prefix}_threshold", value.isNotNull() & _no(value >= limits.min_return_pct[years]),
                 "return below the conditional threshold"),
        ]
    return violations(ranking, rules, F.col("code"))


def check_closure(funnel: DataFrame) -> DataFrame:
    """DQ-03. Funnel counters that do not add up."""
    routed = F.col("us_routed_count") + F.col("global_routed_count")
    rules = [
        Rule("closure_scan", F.col("performance_candidates_scanned") != F.col("base_candidates_total"),
             "performance scan is incomplete"),
        Rule("closure_documents", F.col("us_equity_candidates_scanned") != F.col("performance_qualified_count"),
             "a qualified fund was not routed"),
        Rule("closure_routes", routed != F.col("us_equity_candidates_scanned"), "routes do not close"),
        Rule("closure_main_quota", F.col("us_quota_qualified_count") > F.col("us_routed_count"),
             "more main funds passed the quota gate than were routed"),
        Rule("closure_supplement_quota", F.col("global_quota_qualified_count") > F.col("global_routed_count"),
             "more supplement funds passed the quota gate than were routed"),
        Rule("closure_flag", ~F.col("full_scan_completed"), "the full scan was not completed"),
    ]
    return violations(funnel, rules, F.lit("funnel"))


def check_exclusions(codes: DataFrame, summary: DataFrame) -> DataFrame:
    """DQ-04. Reasons once, counts that match, codes of six digits, no metadata reason."""
    counted = codes.select("reason", "code").distinct().groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    repeated = codes.groupBy("reason", "code").agg(F.count(F.lit(1)).alias("n"))
    reasons = summary.groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"), F.max("excluded_count").alias("excluded_count"),
        F.max("label").alias("label"))
    joined = reasons.join(counted, "reason", "full_outer")
    return union_all([
        violations(joined, [
            Rule("exclusion_reason", F.coalesce("rows", F.lit(0)) != 1, "reason is not listed once"),
            Rule("exclusion_label", _no(F.col("label") != ""), "label is missing"),
            Rule("exclusion_metadata", F.col("reason") == "excluded_target_market",
                 "benchmark metadata must not exclude"),
            Rule("exclusion_count", ~F.col("n").eqNullSafe(F.col("excluded_count")), "count differs")],
            F.col("reason")),
        violations(codes, [Rule("exclusion_code", _no(F.col("code").rlike(_SIX_DIGITS)), "code is not six digits")],
                   F.concat_ws(":", "reason", "code")),
        violations(repeated, [Rule("exclusion_repeat", F.col("n") > 1, "code is listed twice")],
                   F.concat_ws(":", "reason", "code"))])


def check_benchmark(metadata: DataFrame, *, as_of, limits: Limits = DEFAULTS) -> DataFrame:
    """DQ-05. Fixed benchmark facts and sources at most seven days old."""
    day = as_date(as_of)
    rules = [
        Rule("benchmark_currency", _no(F.col("currency") == "CNY"), "benchmark is not in CNY"),
        Rule("benchmark_window", _no(F.col("window_years") == fixed.BENCHMARK_WINDOW_YEARS), "window differs"),
        Rule("benchmark_minimum", _no((F.col("min_observations") == limits.min_observations)
                                      & (F.col("min_span_days") == limits.min_span_days)), "minimums differ"),
    ]
    for prefix in ("index", "fx"):
        start, latest = F.col(f"{prefix}_start_date"), F.col(f"{prefix}_latest_date")
        rules += [
            Rule(f"benchmark_{prefix}_source", _no(F.col(f"{prefix}_source_url") != ""), "source is missing"),
            Rule(f"benchmark_{prefix}_dates", _no((start <= latest) & (latest <= day)), "dates are invalid"),
            Rule(f"benchmark_{prefix}_stale",
                 _no(F.date_diff(day, latest) <= fixed.MAX_STALENESS_DAYS), "source is stale")]
    return violations(metadata, rules, F.lit("benchmark"))


def check_scores(ranking: DataFrame) -> DataFrame:
    """DQ-06. Supplement scores against their recomputation."""
    days = F.date_diff("three_year_performance_end_date", "three_year_performance_start_date")
    drawdown = F.col("three_year_max_drawdown_pct")
    ranking = ranking.withColumn("expected", annualized(F.col("three_year_return_pct"), days)).withColumn(
        "expected_ratio", return_drawdown_ratio(F.col("expected"), drawdown))
    stored, ratio = F.col("three_year_annualized_return_pct"), F.col("return_drawdown_ratio")
    supplement = F.col("ranking_list") == fixed.SUPPLEMENT_LIST
    recomputed = exact_round("expected_ratio", 4)
    rules = [
        Rule("score_annualized", supplement & _no(F.abs(stored - exact_round("expected", 2)) <= 1e-9),
             "annualized return differs"),
        Rule("score_ratio", supplement & (drawdown != 0) & _no(F.abs(ratio - recomputed) <= 1e-9),
             "return to drawdown ratio differs"),
        Rule("score_infinite", supplement & (drawdown == 0) & ratio.isNotNull(), "ratio without a drawdown"),
    ]
    return violations(ranking, rules, F.col("code"))


def _main_key() -> Column:
    return F.struct(-F.col("benchmark_fit.correlation"), F.abs(F.col("benchmark_fit.beta") - 1),
                    -F.col("us_equity_exposure.confirmed_pct"), -F.col("institution_holding_ratio_pct"),
                    -F.col("three_year_return_pct"), F.col("code"))


def _supplement_key() -> Column:
    return F.struct(F.coalesce(-F.col("return_drawdown_ratio"), F.lit(float("-inf"))),
                    -F.col("three_year_return_pct"), -F.col("three_year_max_drawdown_pct"),
                    -F.col("institution_holding_ratio_pct"), -F.col("scale_100m_cny"), F.col("code"))


def order_breaks(ranked: DataFrame, key: Column) -> DataFrame:
    """DQ-07. Rows whose successor sorts before them.

    Neighbours meet in an equi join on ``(ranking_list, rank)``; that proves the
    whole order without sorting a list in one task.
    """
    own = ranked.select("ranking_list", "rank", "code", key.alias("sort_key"))
    after = own.select("ranking_list", (F.col("rank") - 1).alias("rank"),
                       F.col("sort_key").alias("next_key"), F.col("code").alias("next_code"))
    return own.join(after, ["ranking_list", "rank"]).where("next_key < sort_key").select(
        "ranking_list", "rank", "code", "next_code")


def rank_gaps(ranked: DataFrame) -> DataFrame:
    """WIN-09. Lists whose ranks are not exactly 1 to n."""
    ranks = ranked.groupBy("ranking_list", "rank").agg(F.count(F.lit(1)).alias("n"))
    lists = ranks.groupBy("ranking_list").agg(
        F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.count(F.lit(1)).alias("distinct_ranks"), F.max("n").alias("most"))
    return lists.where("low != 1 or high != distinct_ranks or most > 1")


def check_order(ranking: DataFrame) -> DataFrame:
    """DQ-07, WIN-09. Stored ranks against the sort rules of both lists."""
    breaks = order_breaks(ranking.where(F.col("ranking_list") == fixed.MAIN_LIST), _main_key()).unionByName(
        order_breaks(ranking.where(F.col("ranking_list") == fixed.SUPPLEMENT_LIST), _supplement_key()))
    return violations(breaks, [Rule("order", F.lit(True), "order differs from the sort rule")],
                      F.col("code")).unionByName(violations(
                          rank_gaps(ranking), [Rule("rank_gap", F.lit(True), "ranks are not contiguous")],
                          F.col("ranking_list")))


def check_limits(ranking: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """DQ-08. Status, amount and source of both channels."""
    rules = []
    for channel, allowed in (("direct", ["limited", "unlimited", "suspended"]),
                             ("agency", ["limited", "unlimited", "suspended", "unknown"])):
        limit = F.col(f"{channel}_limit")
        limited = limit.status == "limited"
        source = limit.source_url
        rules += [
            Rule(f"{channel}_status", _no(limit.status.isin(allowed)), "limit is unresolved"),
            Rule(f"{channel}_amount", limited & _no(limit.amount_cny > 0), "limit has no positive amount"),
            Rule(f"{channel}_source", limited & _no(source != ""), "limit has no source"),
            Rule(f"{channel}_listed", (F.coalesce(source, F.lit("")) != "")
                 & _no(source == F.col("fund_page_url"))
                 & _no(F.array_contains("quota_source_urls", source)), "source is not listed"),
        ]
    direct = F.col("direct_limit")
    rules += [
        Rule("direct_threshold", _no((direct.status == "unlimited")
                                     | (F.coalesce(direct.amount_cny, F.lit(0)) >= limits.min_direct_limit_cny)),
             "direct limit is below the threshold"),
        Rule("quota_sources", (F.col("quota_status") == "limited")
             & (F.coalesce(F.size("quota_source_urls"), F.lit(0)) <= 0), "limited quota has no notice"),
    ]
    return violations(ranking, rules, F.col("code"))


def check_fields(ranking: DataFrame, *, as_of, limits: Limits = DEFAULTS) -> DataFrame:
    """DQ-09. Benchmark, cost and fit fields of each record."""
    day = as_date(as_of)
    contract, cost, fit = F.col("contract_benchmark"), F.col("holding_cost"), F.col("benchmark_fit")
    count = F.coalesce(F.size(contract.components), F.lit(-1))
    status = contract.status
    main = F.col("ranking_list") == fixed.MAIN_LIST
    rules = [
        Rule("contract_status", _no(status.isin("recognized", "composite", "unrecognized", "unreadable")),
             "status is invalid"),
        *[Rule(f"contract_{name}", _no(contract[name] != ""), f"{name} is missing")
          for name in ("benchmark_text", "benchmark_name", "market_scope", "market_label")],
        Rule("contract_recognized", (status == "recognized") & _no(
            (count == 1) & contract.benchmark_weight_pct.between(0, 100) & contract.benchmark_id.isNotNull()),
            "recognized benchmark is incomplete"),
        Rule("contract_composite", (status == "composite") & _no((count >= 2) & contract.benchmark_id.isNull()),
             "composite benchmark is inconsistent"),
        Rule("contract_unresolved", status.isin("unrecognized", "unreadable")
             & _no((count == 0) & contract.benchmark_weight_pct.isNull()), "unresolved benchmark has parts"),
        Rule("contract_weights", ~F.forall(contract.components, lambda c: F.coalesce(
            c.weight_pct.between(0, 100), F.lit(False))), "a component weight is invalid"),
        Rule("contract_structure", _no(contract.structure.isin("standard", "leveraged", "inverse", "volatility")),
             "structure is invalid"),
        Rule("contract_style", _no(contract.management_style.isin("active", "passive")
                                   & (contract.management_style == F.col("management_style"))), "style differs"),
        Rule("contract_summary", _no(contract.product_summary_status.isin(
            "matched", "missing", "unreadable", "conflict")), "summary status is invalid"),
        Rule("contract_future", contract.prospectus_published_date > day, "prospectus is from the future"),
        Rule("record_tags", F.coalesce(F.size("product_structure_tags"), F.lit(0)) <= 0, "tags are missing"),
        Rule("cost_status", _no(cost.status.isin("parsed", "unavailable")), "cost status is invalid"),
        Rule("cost_value", (cost.status == "parsed") & _no(
            cost.annualized_pct.between(0, 100) & (cost.source_url != "")), "cost is invalid"),
        Rule("cost_empty", (cost.status == "unavailable") & cost.annualized_pct.isNotNull(), "cost must be null"),
        Rule("cost_future", (cost.measurement_date > day) | (cost.source_published_date > day),
             "cost is from the future"),
        Rule("fit_range", main & _no(fit.correlation.between(-1, 1) & is_finite(fit.beta)
                                     & (fit.tracking_error_pct >= 0)), "fit is invalid"),
        Rule("fit_decimals", main & _no((fit.correlation == exact_round("benchmark_fit.correlation", 4))
                                        & (fit.beta == exact_round("benchmark_fit.beta", 4))
                                        & (fit.tracking_error_pct
                                           == exact_round("benchmark_fit.tracking_error_pct", 2))),
             "fit has too many decimals"),
        Rule("fit_observations", main & _no(fit.observations >= limits.min_observations), "too few observations"),
        Rule("fit_span", main & _no((fit.end_date <= day) & (F.date_diff(
            fit.end_date, fit.start_date) >= limits.min_span_days)), "fit span is invalid"),
    ]
    return violations(ranking, rules, F.col("code"))


def check_premium(snapshot: DataFrame, catalog: DataFrame, status: DataFrame, *, as_of) -> DataFrame:
    """DQ-10. Premium records, their code set and the stored status row."""
    day = as_date(as_of)
    group, quote = F.col("benchmark_group"), F.col("quote_status")
    present = quote.isin("fresh", "stale")
    values = [F.col(c) for c in ("market_price_cny", "iopv_cny", "source_discount_pct", "premium_pct",
                                 "change_pct", "turnover_cny")]
    finite, empty = F.lit(True), F.lit(True)
    for value in values:
        finite, empty = finite & is_finite(value), empty & value.isNull()
    price, iopv, discount, premium = values[0], values[1], values[2], values[3]
    rules = [
        Rule("premium_name", _no(F.trim("name") != ""), "name is missing"),
        Rule("premium_exchange", _no(F.col("exchange").isin("SSE", "SZSE") & (
            (F.col("exchange") == "SSE") == (F.col("market_id") == 1))), "exchange is inconsistent"),
        Rule("premium_group", _no(group.isin(fixed.PREMIUM_GROUPS)
                                  & ((group == "行业主题") == (F.col("category") == "sector_theme"))),
             "group is inconsistent"),
        Rule("premium_status", _no(quote.isin("fresh", "stale", "unavailable")), "quote status is invalid"),
        Rule("premium_empty", (quote == "unavailable") & ~empty, "unavailable quote has values"),
        Rule("premium_values", present & _no(finite & (price > 0) & (iopv > 0) & (F.col("turnover_cny") >= 0)),
             "values are out of range"),
        Rule("premium_sign", present & _no(F.abs(discount + premium) <= 0.011), "sign differs"),
        Rule("premium_formula", present & _no(premium_check(price, iopv, -premium)),
             "premium differs from price over IOPV"),
        Rule("premium_future", present & _no((F.col("quote_date") <= day) & (F.to_date("updated_at") <= day)),
             "quote is from the future"),
        Rule("premium_url", present & _no(F.col("quote_source_url").startswith("https://")), "quote URL is invalid"),
    ]
    stored = status.select(*[F.col(c).alias(f"stored_{c}") for c in status.columns], F.lit(1).alias("one"))
    again = snapshot_status(snapshot).withColumn("one", F.lit(1)).join(stored, "one")
    differs = F.lit(False)
    for column in ("expected_count", "fresh_count", "cache_hit_count", "status"):
        differs = differs | ~F.col(column).eqNullSafe(F.col(f"stored_{column}"))
    return union_all([
        violations(snapshot, rules, F.col("code")),
        violations(set_difference(catalog, snapshot), [Rule("premium_codes", F.lit(True), "code set differs")],
                   F.col("code")),
        violations(again, [Rule("premium_counts", differs, "status row differs")], F.lit("premium"))])


def check_premium_order(stored: DataFrame) -> DataFrame:
    """DQ-10. Records stored by ``rank`` that are not by premium descending, unknown ones last, then code."""
    key = F.struct(F.col("premium_pct").isNull(), -F.col("premium_pct"), F.col("code"))
    breaks = order_breaks(stored.withColumn("ranking_list", F.lit("premium")), key)
    return violations(breaks, [Rule("premium_order", F.lit(True), "record order differs")], F.col("next_code"))


def check_lists(main: DataFrame, supplement: DataFrame) -> DataFrame:
    """SET-02. Codes in both lists or twice in one."""
    return violations(duplicate_codes(main, supplement),
                      [Rule("duplicate_code", F.lit(True), "code is ranked twice")], F.col("code"))


def parity(nested: DataFrame, flat: DataFrame, columns: list[str], key: list[str],
           tolerance: float = 1e-9) -> DataFrame:
    """DQ-11. Rows and fields that differ between two forms of the same records.

    ``nested`` is already flattened to the columns of ``flat``; numbers may
    differ by ``tolerance``.
    """
    pairs = nested.select(*key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a")).join(
        flat.select(*key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("in_b")),
        key, "full_outer")
    rules = [Rule("parity_row", F.col("in_a").isNull() | F.col("in_b").isNull(), "row is in one form only")]
    both = F.col("in_a") & F.col("in_b")
    numeric = {f.name for f in nested.schema.fields if f.dataType.typeName() in ("double", "long", "integer")}
    for column in columns:
        a, b = F.col(f"a_{column}"), F.col(f"b_{column}")
        if column in numeric:
            a, b = a.cast("double"), b.try_cast("double")
            same = (a.isNull() & b.isNull()) | (F.abs(a - b) <= tolerance)
        else:
            same = F.coalesce(a.cast("string"), F.lit("")) == F.coalesce(b.cast("string"), F.lit(""))
        rules.append(Rule(f"parity_{column}", both & _no(same), f"{column} differs"))
    return violations(pairs, rules, F.concat_ws(":", *key))
