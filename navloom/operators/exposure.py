"""Look-through exposure with a confirmed lower and a possible upper bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.numbers import exact_round
from navloom.functions.text import normalize_instrument
from navloom.operators.matching import alias_hits
from navloom.session import dealt


def report_key(df: DataFrame) -> list[str]:
    """A report is listed by a fund; tables of distinct documents have no ``code``."""
    return [c for c in ("code", "announcement_id") if c in df.columns]


# Weights are published with two decimals; exact sums do not depend on row order.
_EXACT = "decimal(28,10)"


def usable(category: Column, data_date: Column, source_url: Column, report_date: Column) -> Column:
    """JN-06. A structural class needs a source, a global one a recent allocation."""
    structural = category.isin(fixed.STRUCTURAL_CATEGORIES) & (F.coalesce(source_url, F.lit("")) != "")
    age = F.date_diff(report_date, data_date)
    recent = (category == "global_equity") & age.between(0, fixed.ALLOCATION_MAX_AGE_DAYS)
    return structural | F.coalesce(recent, F.lit(False))


def resolve_instruments(holdings: DataFrame, catalog: DataFrame) -> DataFrame:
    """JN-06. Holdings with category, exposure, data date and source, or nulls.

    ``holdings`` carries ``report_date``.  Each distinct name is matched once; the
    first usable entry in catalog order is joined back.
    """
    named = holdings.withColumn("normalized_name", normalize_instrument(F.col("fund_name")))
    names = named.select("normalized_name", "report_date").distinct()
    single = dealt(names.select("normalized_name"), "normalized_name").distinct()
    hits = alias_hits(single.withColumn("t", F.col("normalized_name")), "normalized_name", "t", catalog)
    options = names.join(hits, "normalized_name").join(
        catalog.select("position", "category", "us_equity_pct", "data_date", "source_url"), "position")
    good = options.where(usable(*[F.col(c) for c in ("category", "data_date", "source_url", "report_date")]))
    first = good.groupBy("normalized_name", "report_date").agg(
        F.min_by(F.struct("category", "us_equity_pct", "data_date", "source_url"), "position").alias("r"))
    joined = named.join(first, ["normalized_name", "report_date"], "left")
    return joined.select(*holdings.columns, "r.*")


def contributions(resolved: DataFrame) -> DataFrame:
    """AG-06, per holding. A reported commodity or bond adds nothing, an unknown one its upper bound."""
    reported = F.col("reported_category").isin("commodity", "fixed_income")
    pct = F.when(reported, 0.0).otherwise(F.col("us_equity_pct"))
    weight = F.col("weight_pct")
    return resolved.withColumns({
        "resolved_category": F.coalesce(
            F.when(reported, F.col("reported_category")), F.col("category"), F.lit("unresolved")),
        "resolved_pct": pct,
        "confirmed_contribution_pct": F.when(pct.isNull(), 0.0).otherwise(weight * pct / 100),
        "possible_contribution_pct": F.when(pct.isNull(), weight).otherwise(weight * pct / 100),
    })


def exposure_components(totals: DataFrame, contributed: DataFrame) -> DataFrame:
    """AG-06. Long table of components: every holding and the undisclosed remainder.

    ``totals`` carries ``source_url``, the report that a reported class is read from.
    """
    key = report_key(contributed)
    report = totals.select(*key, F.col("report_date").alias("own_date"), F.col("source_url").alias("own_url"))
    reported = F.col("reported_category").isin("commodity", "fixed_income")
    rows = contributed.join(report, key).select(
        *key, "rank", "fund_name", exact_round("weight_pct", 4).alias("weight_pct"),
        F.col("resolved_category").alias("category"), F.col("resolved_pct").alias("us_equity_pct"),
        exact_round("confirmed_contribution_pct", 4).alias("confirmed_contribution_pct"),
        exact_round("possible_contribution_pct", 4).alias("possible_contribution_pct"),
        F.coalesce("data_date", F.when(reported, F.col("own_date"))).alias("data_date"),
        F.coalesce("source_url", F.when(reported, F.col("own_url"))).alias("source_url"))
    rest = exposure_interval(totals, contributed).where(
        F.col("residual_pct") > fixed.RESIDUAL_FLOOR_PCT).join(report, key)
    remainder = rest.select(
        *key, F.lit(None).cast("int").alias("rank"),
        F.lit("前十大之外未披露基金仓位").alias("fund_name"),
        exact_round("residual_pct", 4).alias("weight_pct"),
        F.lit("unresolved_residual").alias("category"), F.lit(None).cast("double").alias("us_equity_pct"),
        F.lit(0.0).alias("confirmed_contribution_pct"),
        exact_round("residual_pct", 4).alias("possible_contribution_pct"),
        F.lit(None).cast("date").alias("data_date"), F.col("own_url").alias("source_url"))
    return rows.unionByName(remainder)


def exposure_interval(totals: DataFrame, contributed: DataFrame) -> DataFrame:
    """AG-06. Confirmed and possible exposure per fund and report.

    Funds that share a document hold it each in their own rows.  Holdings are summed before they meet ``totals``, so a report with very many
    rows is combined on the map side.
    """
    key = report_key(contributed)
    sums = contributed.groupBy(*key).agg(
        F.sum(F.col("weight_pct").cast(_EXACT)).alias("disclosed"),
        F.sum(F.col("confirmed_contribution_pct").cast(_EXACT)).alias("lookthrough"),
        F.sum(F.when(F.col("resolved_pct").isNull(), F.col("weight_pct")).cast(_EXACT)).alias("unknown"),
        F.count_if(F.col("resolved_pct").isNull()
                   & (F.col("weight_pct") >= fixed.UNRESOLVED_WARNING_PCT)).alias("unresolved_warnings"))
    joined = totals.join(sums, key, "left")
    filled = joined.select(
        *key, "report_date", "direct_us_pct", "fund_investment_pct", "unresolved_warnings",
        *[F.coalesce(name, F.lit(0)).cast("double").alias(name) for name in ("disclosed", "lookthrough", "unknown")])
    bounds = filled.withColumn(
        "residual_pct", F.greatest(F.lit(0.0), F.col("fund_investment_pct") - F.col("disclosed"))
    ).withColumns({
        "confirmed": F.least(F.lit(100.0), F.col("direct_us_pct") + F.col("lookthrough")),
        "unresolved": F.col("unknown") + F.when(
            F.col("residual_pct") > fixed.RESIDUAL_FLOOR_PCT, F.col("residual_pct")).otherwise(0.0),
    })
    return bounds.select(
        *key, "report_date",
        exact_round("confirmed", 2).alias("confirmed_pct"),
        exact_round("least(100D, confirmed + unresolved)", 2).alias("possible_pct"),
        exact_round("direct_us_pct", 2).alias("direct_us_pct"),
        exact_round("lookthrough", 2).alias("lookthrough_confirmed_pct"),
        exact_round("unresolved", 2).alias("unresolved_pct"),
        "residual_pct", F.coalesce("unresolved_warnings", F.lit(0)).alias("unresolved_warnings"))


def classify_exposure(confirmed: Column, possible: Column,
                      threshold: float = fixed.MIN_US_EQUITY_PCT) -> Column:
    """PRJ-02. On the rounded bounds; the threshold stays outside the stored result."""
    return (
        F.when(confirmed >= threshold, "qualified")
        .when(possible < threshold, "excluded")
        .otherwise("ambiguous")
    )


def exposure_warnings(interval: DataFrame, threshold: float = fixed.MIN_US_EQUITY_PCT) -> DataFrame:
    """AG-06, PRJ-02. Texts for an undisclosed remainder and an open interval."""
    residual = F.format_string("%s 前十大基金之外尚有 %.2f%% 基金仓位未披露，仅计入可能上限。",
                               "code", exact_round("residual_pct", 2))
    crossing = F.format_string("%s 美股占比区间 %.2f%%-%.2f%% 跨越阈值，按确认下限进入全球补充榜。",
                               "code", "confirmed_pct", "possible_pct")
    status = classify_exposure(F.col("confirmed_pct"), F.col("possible_pct"), threshold)
    texts = F.array_compact(F.array(
        F.when(F.col("residual_pct") > fixed.RESIDUAL_FLOOR_PCT, residual),
        F.when(status == "ambiguous", crossing)))
    return interval.select("code", F.explode(texts).alias("text"))


def holding_warnings(contributed: DataFrame) -> DataFrame:
    """AG-06. Texts for holdings that only count towards the upper bound, the fund in front."""
    text = F.format_string("%s：%s 无法按 %s 的可用数据穿透，其 %.2f%% 仓位仅计入可能上限。", "code", "fund_name",
                           F.col("report_date").cast("string"), exact_round("weight_pct", 2))
    unknown = contributed.where(F.col("resolved_pct").isNull()
                                & (F.col("weight_pct") >= fixed.UNRESOLVED_WARNING_PCT))
    return unknown.select("code", text.alias("text"))
