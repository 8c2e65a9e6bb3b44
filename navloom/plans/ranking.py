"""The full ranking, composed from the operators.

Four tables of one row per fund and the holdings of the funds that pass are staged while a
run is built; what follows them is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.numbers import exact_round
from navloom.functions.text import fund_identity
from navloom.operators import documents as doc
from navloom.operators import eligibility as elig
from navloom.operators import exposure as expo
from navloom.operators import quota as quo
from navloom.operators import ranking as rank
from navloom.operators import timeseries as ts
from navloom.operators.quality import issues_of, staged_gate, union_all
from navloom.operators.validation import Limits
from navloom.plans.incremental import Store, catalog_fingerprint, parse_once
from navloom.session import dealt, merged, staged


@dataclass
class Disclosures:
    """Listings, ``texts(announcement_id, text, error)`` and the benchmark catalog.

    With a ``store`` of parsed documents only new ones are parsed.
    """

    announcements: DataFrame
    texts: DataFrame
    benchmarks: DataFrame
    store: Store | None = None


@dataclass
class Tables:
    """Input tables.

    The document tables come from ``disclosures``, parsed for the funds that pass
    the return thresholds, or are given.  ``report_holdings`` has one set of rows per
    document; ``report_totals`` says which funds list it.
    """

    funds: DataFrame
    holder_periods: DataFrame
    holders: DataFrame
    fund_pages: DataFrame
    nav: DataFrame
    index_levels: DataFrame
    fx_rates: DataFrame
    instruments: DataFrame
    report_totals: DataFrame | None = None  # code, announcement_id, report_date, published_date, source_url, ...
    report_holdings: DataFrame | None = None
    transitions: DataFrame | None = None
    failed_notices: DataFrame | None = None
    profiles: DataFrame | None = None  # contract_benchmark and holding_cost per code
    disclosures: Disclosures | None = None
    issues: DataFrame | None = None  # what the loaders found
    warnings: DataFrame | None = None  # what the loaders report, as text
    contributed: DataFrame | None = None  # holdings of qualified funds with what each contributes, of a run


@dataclass
class Params:
    as_of: date
    top: int = fixed.TOP
    min_scale: float | None = None
    min_age_years: int = fixed.MIN_AGE_YEARS
    min_return_pct: dict = field(default_factory=lambda: dict(fixed.MIN_RETURN_PCT))
    min_us_equity_pct: float = fixed.MIN_US_EQUITY_PCT
    min_direct_limit_cny: int = fixed.MIN_DIRECT_LIMIT_CNY
    main_exclude_keywords: tuple = tuple(fixed.GEOGRAPHY_KEYWORDS)
    min_observations: int = fixed.MIN_OBSERVATIONS
    min_span_days: int = fixed.MIN_SPAN_DAYS
    allow_partial_period: bool = False
    short_history_is_fatal: bool = True
    nav_reloaded: bool = False
    # Stages that several results read are written to the checkpoint folder once.
    materialize: bool = True

    def limits(self) -> Limits:
        """The limits that a finished run is validated against."""
        return Limits(**{f.name: getattr(self, f.name) for f in fields(Limits)})


def parse_documents(announcements: DataFrame, texts: DataFrame, funds: DataFrame,
                    benchmarks: DataFrame, as_of, store: Store | None = None) -> dict[str, DataFrame]:
    """Disclosures to the parsed tables of ``Tables``.

    ``texts(announcement_id, text, error)``.  One listing feeds legal documents,
    reports and notices; only selected documents of ``funds`` are parsed, and with a
    ``store`` only those that it does not know.
    """
    from navloom.sources.raw import document_url, invisible_announcements

    # Rows decide the number of tasks: listings of one fund or document repeat each other and look small packed.
    rows = announcements.count()
    listed = staged(merged(announcements, dealt(funds.select("code"), "code", rows=rows), "code", "left_semi"))

    def with_url(found: DataFrame) -> DataFrame:
        return found.where("announcement_id is not null").withColumn("source_url", document_url(F.col("announcement_id")))

    own = funds.select("code", F.col("name").alias("fund_name"),
                       fund_identity(F.col("code"), F.col("name"), F.col("fund_type")).alias("fund_identity"))
    legal = doc.latest_documents(
        dealt(doc.classify_documents(listed), "code", rows=rows), as_of=as_of).where("document_class != 'periodic_report'")
    legal = staged(merged(with_url(legal), own, "code", "left"))
    keys = ["code", "announcement_id"]

    def identified(found: DataFrame, docs: DataFrame) -> DataFrame:
        return merged(found, docs.select(*keys, "fund_identity"), keys)

    def benchmark_profiles(docs: DataFrame) -> DataFrame:
        return identified(doc.benchmark_profiles(*doc.parse_benchmarks(docs, benchmarks, rows), rows), docs)

    def costs_of(docs: DataFrame) -> DataFrame:
        return identified(doc.parse_costs(docs, as_of=date.max), docs)

    statements = dealt(legal.select(*keys, "fund_name", "fund_identity"), *keys, rows=rows).distinct()
    profiles = staged(parse_once(store, "benchmarks", statements, texts, benchmark_profiles,
                                 catalog_fingerprint(benchmarks) if store else "").drop("fund_identity"))
    summaries = dealt(legal.where("document_class = 'product_summary'").select(*keys, "fund_identity"), *keys, rows=rows).distinct()
    costs = doc.costs_as_of(parse_once(store, "costs", summaries, texts, costs_of).drop("fund_identity"), as_of)

    newest = doc.latest_report(quo.on_latest_page(listed), as_of=as_of)
    facts = with_url(newest).select("code", "announcement_id", "report_date", "published_date", "source_url")
    # Share classes list the same report; its text is parsed once, for whichever fund.
    single = facts.groupBy("announcement_id").agg(F.first("code").alias("code")).withColumn("fund_identity", F.lit(""))

    def sections_of(docs: DataFrame) -> DataFrame:
        return doc.report_sections(docs).drop("code").withColumn("fund_identity", F.lit(""))

    # Totals and holdings both read the short sections, so a long report is searched once.
    sections = staged(parse_once(store, "report_sections", single, texts, sections_of).drop("fund_identity").join(
        single.drop("fund_identity"), "announcement_id"))
    totals = facts.join(doc.section_totals(sections).drop("code"), "announcement_id")
    holdings = doc.section_holdings(sections).drop("code")

    selected = doc.notice_order(with_url(quo.select_notices(quo.on_latest_page(listed), as_of=as_of)))
    # The date of publication stands in for a date that a notice does not state.
    dated = F.concat_ws("|", "code", "published_date")

    def changes(docs: DataFrame) -> DataFrame:
        return doc.parse_notices(docs.withColumn("notice_seq", F.lit(0).cast("long"))).drop(
            "notice_seq").withColumn("fund_identity", dated)

    notices = selected.select("code", "announcement_id", "published_date", "source_url").withColumn("fund_identity", dated)
    transitions = parse_once(store, "notices", notices, texts, changes).drop("fund_identity").join(
        selected.select("code", "announcement_id", "notice_seq"), ["code", "announcement_id"])
    return {
        "report_totals": totals,
        "report_holdings": holdings,
        "transitions": transitions,
        "failed_notices": doc.failed_notices(selected, transitions),
        "profiles": doc.document_profiles(funds, legal, profiles, costs, rows),
        "issues": union_all([
            doc.report_issues(totals, facts.select("code", "announcement_id").join(holdings, "announcement_id")),
            doc.missing_reports(funds.select("code"), newest),
            invisible_announcements(funds.select("code"), listed, as_of)]),
    }


def eligible_funds(tables: Tables, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates of the selected period that pass the attribute filters.

    Returns ``(eligible, enriched, selection)``.
    """
    selection = elig.select_period(tables.holder_periods, allow_partial=params.allow_partial_period)
    chosen = selection.where("selected").select(
        "period_key", F.col("report_date").alias("holder_report_date"))
    # One row is selected, so this join is a filter on the partition key of holders.
    held = tables.holders.join(F.broadcast(chosen), "period_key")
    candidates = elig.build_candidates(held, tables.funds)
    enriched = elig.enrich(candidates, tables.fund_pages)
    eligible = elig.filter_eligible(
        enriched, as_of=params.as_of, min_scale=params.min_scale, min_age_years=params.min_age_years)
    return eligible, enriched, selection


def measure(eligible: DataFrame, tables: Tables, params: Params) -> DataFrame:
    """Eligible funds with performance, threshold failures, score and benchmark fit.

    The price history is read and dealt by fund once, and not dealt where it is a table of
    ``bucketed_history``: the same pass gives the record, the weekly points and the value of
    the day that the fund's pages show.  Fits are computed for funds that pass.
    """
    paged = shows_values(tables)
    if paged:
        days = eligible.select("code").join(ts.shown_values(tables.fund_pages).select("code", "page_date"), "code", "left")
        nav = tables.nav.join(days, "code")
    else:
        nav = tables.nav.join(eligible.select("code"), "code", "left_semi")
    performance = ts.performance_record(
        nav, as_of=params.as_of, weekly_years=fixed.BENCHMARK_WINDOW_YEARS, page_dates=paged)
    measured = stage(elig.with_score(eligible.join(performance, "code", "left").withColumn(
        "failures", elig.performance_failures(params.min_return_pct))), params)
    calendar = stage(ts.benchmark_calendar(tables.index_levels, tables.fx_rates), params)
    fit = ts.fit_weekly(
        ts.weekly_points(measured.where("size(failures) = 0")), calendar,
        min_observations=params.min_observations, min_span_days=params.min_span_days)
    joined = measured.drop("weekly").join(
        fit.withColumnRenamed("start_date", "fit_start_date").withColumnRenamed("end_date", "fit_end_date"),
        "code", "left")
    return joined.withColumn("fit_error", F.when(
        F.col("correlation").isNull(), F.coalesce("fit_error", F.lit("too_few_observations"))))


def with_documents(tables: Tables, measured: DataFrame, params: Params) -> Tables:
    """Tables with the disclosures of the funds that pass the thresholds, parsed."""
    if tables.disclosures is None:
        return tables
    funds = tables.funds.join(measured.where("size(failures) = 0").select("code"), "code", "left_semi")
    given = tables.disclosures
    parsed = parse_documents(given.announcements, given.texts, funds, given.benchmarks, params.as_of, given.store)
    found = parsed.pop("issues")
    issues = found if tables.issues is None else tables.issues.unionByName(found)
    parsed = {name: stage(df, params) for name, df in parsed.items()}
    return replace(tables, issues=stage(issues, params), **parsed)


def contributed_holdings(tables: Tables, qualified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports of the qualified funds, and their holdings with what each contributes."""
    # A report that could not be read has no totals; its fund lacks an exposure, which is fatal.
    read = tables.report_totals.where("direct_us_pct is not null and fund_investment_pct is not null")
    reports = read.join(qualified.select("code"), "code", "left_semi")
    if tables.contributed is not None:
        keys = ["code", "announcement_id"]
        return reports, tables.contributed.join(reports.select(*keys), keys, "left_semi")
    dated = tables.report_holdings.join(
        reports.select("code", "announcement_id", "report_date"), "announcement_id")
    return reports, expo.contributions(expo.resolve_instruments(dated, tables.instruments))


def with_contributions(tables: Tables, measured: DataFrame, params: Params) -> Tables:
    """Tables with the resolved holdings of the funds that pass the thresholds.

    The evaluation, the warnings and the records all read them: holdings are read and
    matched once in a run.
    """
    _, contributed = contributed_holdings(tables, measured.where("size(failures) = 0").select("code"))
    return replace(tables, contributed=stage(contributed, params))


def evaluate(measured: DataFrame, tables: Tables, params: Params) -> DataFrame:
    """Every eligible fund with performance, fit, exposure, quota, route and reasons.

    The return thresholds run before documents are joined; failed funds stay as
    rows with their reasons.
    """
    qualified = measured.where("size(failures) = 0").select("code")
    reports, contributed = contributed_holdings(tables, qualified)
    interval = expo.exposure_interval(reports, contributed).join(
        reports.select("code", "announcement_id", "published_date",
                       F.col("source_url").alias("exposure_source_url")), ["code", "announcement_id"])
    pages = tables.fund_pages.join(qualified, "code", "left_semi")
    state = quo.quota_state(
        pages.select("code", "purchase_status", "page_agency_limit_cny", "fund_page_url"),
        tables.transitions.join(qualified, "code", "left_semi"),
        tables.failed_notices.join(qualified, "code", "left_semi"), as_of=params.as_of)

    passed = F.size("failures") == 0
    joined = measured.join(interval, "code", "left").join(state, "code", "left")
    routed = elig.with_route(joined, keywords=params.main_exclude_keywords,
                             threshold=params.min_us_equity_pct)
    exposure_known = F.col("confirmed_pct").isNotNull()
    status = expo.classify_exposure(F.col("confirmed_pct"), F.col("possible_pct"), params.min_us_equity_pct)
    return routed.withColumns({
        "ranking_list": F.when(passed & exposure_known, F.col("ranking_list")),
        "routing_reason": F.when(passed & exposure_known, F.col("routing_reason")),
        "exposure_status": F.when(exposure_known, status),
        "quota_reason": F.when(passed & exposure_known, quo.quota_gate(params.min_direct_limit_cny)),
    })


def run_issues(enriched: DataFrame, evaluated: DataFrame, tables: Tables, params: Params,
               reconciled: DataFrame | None = None) -> DataFrame:
    """Fatal findings: of loading and parsing, of the evaluation, of pages and benchmark series.

    A missing fit only matters on the main list.
    """
    passed = F.size("failures") == 0
    fit = F.when((F.col("ranking_list") == fixed.MAIN_LIST) & F.col("fit_error").isNotNull(), "fit_unavailable")
    exposure = F.when(passed & F.col("confirmed_pct").isNull(), "exposure_missing")
    history = F.when(F.col("nav_history_start_date").isNull(), "nav_history_missing")
    factors = F.when(F.col("factor_issue_count") > 0, "adjusted_factor_missing")
    frames = [elig.missing_pages(enriched)]
    for reason in (fit, exposure, history, factors):
        frames.append(issues_of(evaluated, F.col("code"), reason, F.col("fit_error")))
    severity = "fatal" if params.short_history_is_fatal else "warning"
    frames.append(ts.history_issues(evaluated, severity))
    frames += [ts.coverage_issues(ts.series_coverage(series, as_of=params.as_of), name)
               for name, series in (("index", tables.index_levels), ("fx", tables.fx_rates))]
    if reconciled is not None:
        frames.append(ts.reconcile_issues(reconciled))
    if tables.issues is not None:
        frames.append(tables.issues)
    return union_all(frames)


def shows_values(tables: Tables) -> bool:
    """Whether the pages show a latest value, to be reconciled with the history."""
    return {"latest_nav_date", "latest_nav_value"} <= set(tables.fund_pages.columns)


def reconcile(evaluated: DataFrame, tables: Tables, params: Params) -> DataFrame | None:
    """JN-11 for the eligible funds, from the values that the pass over the history noted."""
    if not shows_values(tables):
        return None
    seen = ts.shown_values(tables.fund_pages).join(
        evaluated.select("code", F.col("page_nav").alias("series_value"), F.col("nav_history_end_date").alias("series_date")), "code")
    return seen.withColumn("status", ts.reconcile_status(params.as_of, params.nav_reloaded))


def run_warnings(selection: DataFrame, evaluated: DataFrame, main: DataFrame, supplement: DataFrame,
                 tables: Tables, params: Params, reconciled: DataFrame | None) -> DataFrame:
    """AG-18. Every distinct text that the run reports."""
    routed = evaluated.where("ranking_list is not null")
    _, contributed = contributed_holdings(tables, routed.select("code"))
    frames = [
        elig.period_warnings(selection), expo.exposure_warnings(routed), expo.holding_warnings(contributed),
        quo.quota_warnings(routed), rank.short_list_warnings(main, supplement, params.top)]
    if tables.profiles is not None:
        frames.append(doc.profile_warnings(tables.profiles.join(routed.select("code"), "code", "left_semi")))
    if reconciled is not None:
        frames.append(ts.reconcile_warnings(reconciled))
    if tables.warnings is not None:
        frames.append(tables.warnings)
    return union_all([f.select("text") for f in frames]).distinct()


def stage(df: DataFrame, params: Params) -> DataFrame:
    """Stage a table that is read several times."""
    return staged(df) if params.materialize else df


def build_ranking(tables: Tables, params: Params) -> dict:
    """PIPE-01. All results of a run as DataFrames, and ``tables`` with the parsed documents.

    The price history is read once; everything after works on one row per fund.
    """
    eligible, enriched, selection = eligible_funds(tables, params)
    eligible = stage(eligible, params)
    measured = stage(measure(eligible, tables, params), params)
    tables = with_contributions(with_documents(tables, measured, params), measured, params)
    evaluated = stage(evaluate(measured, tables, params), params)
    reconciled = reconcile(evaluated, tables, params)
    passed = evaluated.where("ranking_list is not null and quota_reason is null")
    main, supplement = rank.rank_main(passed, params.top), rank.rank_supplement(passed, params.top)
    ranked = main.unionByName(supplement)
    failures = evaluated.select("code", F.explode("failures").alias("failure"))
    exclusions = union_all([
        rank.exclusion_rows(failures, F.col("failure")),
        rank.exclusion_rows(evaluated, F.col("quota_reason")),
        rank.exclusion_rows(rank.capped(passed, ranked), "ranking_cap")])
    warnings = run_warnings(selection, evaluated, main, supplement, tables, params, reconciled)
    return {
        "eligible": eligible, "evaluated": evaluated, "main": main, "supplement": supplement,
        "ranking": rank.union_lists(main, supplement), "exclusions": rank.exclusion_codes(exclusions),
        "exclusion_summary": rank.exclusion_summary(exclusions), "funnel": rank.funnel(evaluated),
        "warnings": warnings, "issues": run_issues(enriched, evaluated, tables, params, reconciled),
        "selection": selection, "tables": tables,
    }


def ranking_record(ranked: DataFrame, tables: Tables, params: Params) -> DataFrame:
    """PRJ-06. Nested output records of the ranked funds, at most ``2 * top`` rows.

    Components and sources are collected for ranked funds only; a report lists
    ten positions and a fund has at most twelve selected notices.
    """
    codes = ranked.select("code")
    parts = expo.exposure_components(*contributed_holdings(tables, codes))
    nested = parts.groupBy("code").agg(
        F.array_sort(F.collect_list(F.struct(
            F.coalesce("rank", F.lit(99)).alias("rank"),
            *[c for c in parts.columns if c not in ("code", "announcement_id", "rank")]))).alias("components"))
    sources = quo.quota_sources(
        tables.transitions.join(codes, "code", "left_semi"), tables.failed_notices, as_of=params.as_of)
    sources = sources.groupBy("code").agg(F.array_sort(F.collect_set("source_url")).alias("quota_source_urls"))
    full = ranked.join(nested, "code", "left").join(sources, "code", "left")
    if tables.profiles is not None:
        full = full.join(tables.profiles, "code", "left")
    return full.select(*_record_columns(params))


def _record_columns(params: Params) -> list[Column]:
    supplement = F.col("ranking_list") == fixed.SUPPLEMENT_LIST
    contract = F.col("contract_benchmark")
    fit = F.struct("correlation", "beta", "tracking_error_pct", "observations",
                   F.col("fit_start_date").alias("start_date"), F.col("fit_end_date").alias("end_date"))
    exposure = F.struct("confirmed_pct", "possible_pct", "direct_us_pct", "lookthrough_confirmed_pct",
                        "unresolved_pct", "report_date", "published_date",
                        F.col("exposure_source_url").alias("source_url"),
                        F.col("exposure_status").alias("status"), "components")
    windows = []
    for prefix in fixed.RETURN_HORIZONS.values():
        windows.append(F.col(f"{prefix}_return_pct"))
        if prefix in ("one_year", "three_year"):
            windows.append(F.col(f"{prefix}_max_drawdown_pct"))
        windows += [F.col(f"{prefix}_performance_start_date"), F.col(f"{prefix}_performance_end_date")]
    return [
        F.lit(params.as_of).alias("run_date"), F.col("rank"), F.col("ranking_list"), F.col("routing_reason"),
        F.col("code"), F.col("name"), F.col("fund_type"), contract.management_style.alias("management_style"),
        elig.product_tags(contract.management_style, F.col("fund_type"), contract.style_label,
                          contract.status, contract.structure).alias("product_structure_tags"),
        contract, F.col("holding_cost"), F.col("institution_pct").alias("institution_holding_ratio_pct"),
        F.col("holder_report_date"), F.col("inception_date"), F.col("scale_100m_cny"),
        F.col("scale_report_date"), F.col("purchase_status"), F.col("purchase_status_text"),
        F.col("fund_page_url"), F.col("fund_page_url").alias("performance_source_url"),
        F.col("nav_history_start_date"), F.col("nav_history_end_date"), *windows,
        F.when(F.col("correlation").isNotNull(), fit).alias("benchmark_fit"),
        exposure.alias("us_equity_exposure"), F.col("quota_status"), F.col("quota_confidence"),
        F.col("direct_limit"), F.col("agency_limit"), F.col("share_class_rule"), F.col("channel_rule"),
        F.coalesce("quota_source_urls", F.array().cast("array<string>")).alias("quota_source_urls"),
        F.when(supplement, exact_round("annualized_pct", 2)).alias("three_year_annualized_return_pct"),
        F.when(supplement, exact_round("drawdown_ratio", 4)).alias("return_drawdown_ratio"),
    ]


def publish(results: dict[str, DataFrame], records: DataFrame, path: str) -> None:
    """DQ-01 then SNK-01: nothing is written to ``path`` when the gate fails.

    Issues and records are staged and counted on the way; the run is written from the staged
    records, so neither is computed twice.
    """
    from navloom.sources.sinks import write_run

    judged = staged_gate(results["issues"], records)
    judged.check()
    write_run(judged.ranked, path)
