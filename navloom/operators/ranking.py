"""Ranked lists, exclusions and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.numbers import exact_round


def main_order() -> list[Column]:
    """SRT-01. On the rounded correlation and beta; a missing holding counts as 0."""
    return [
        F.col("correlation").desc(), F.abs(F.col("beta") - 1).asc(), F.col("confirmed_pct").desc(),
        F.coalesce("institution_pct", F.lit(0.0)).desc(), F.col("three_year_return_pct").desc(),
        F.col("code").asc(),
    ]


def supplement_order() -> list[Column]:
    """SRT-02. No drawdown at all comes first; the ratio counts at four decimals."""
    return [
        exact_round("drawdown_ratio", 4).desc_nulls_first(), F.col("three_year_return_pct").desc(),
        F.col("three_year_max_drawdown_pct").desc(), F.coalesce("institution_pct", F.lit(0.0)).desc(),
        F.col("scale_100m_cny").desc(), F.col("code").asc(),
    ]


def assign_rank(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """WIN-09. Ranks 1 to k of each list; ``k`` is the length of the report.

    The rank filter becomes a group limit, so every task keeps at most k rows
    per list before the shuffle and all candidates take part.
    """
    ranked = Window.partitionBy("ranking_list").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def rank_main(df: DataFrame, k: int = fixed.TOP) -> DataFrame:
    return assign_rank(df.where(F.col("ranking_list") == fixed.MAIN_LIST), main_order(), k)


def rank_supplement(df: DataFrame, k: int = fixed.TOP) -> DataFrame:
    return assign_rank(df.where(F.col("ranking_list") == fixed.SUPPLEMENT_LIST), supplement_order(), k)


def union_lists(main: DataFrame, supplement: DataFrame) -> DataFrame:
    """SET-01. Main list first."""
    both = main.withColumn("list_order", F.lit(0)).unionByName(supplement.withColumn("list_order", F.lit(1)))
    return both.orderBy("list_order", "rank").drop("list_order")


def duplicate_codes(main: DataFrame, supplement: DataFrame) -> DataFrame:
    """SET-02. Codes that occur more than once in or across the lists."""
    both = main.select("code").unionByName(supplement.select("code"))
    return both.groupBy("code").agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def except_codes(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-03. Codes of ``a`` that are not in ``b``."""
    return a.select("code").distinct().join(b.select("code"), "code", "left_anti")


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """SET-04. Codes in only one of two sets; empty when they are equal."""
    missing = except_codes(expected, actual).withColumn("side", F.lit("missing"))
    return missing.unionByName(except_codes(actual, expected).withColumn("side", F.lit("unexpected")))


def capped(qualified: DataFrame, ranked: DataFrame) -> DataFrame:
    """JN-10. Qualified funds behind the cut; ``ranked`` has at most k rows per list."""
    return qualified.join(ranked.select("code"), "code", "left_anti").select("code")


def exclusion_rows(df: DataFrame, reason: Column | str) -> DataFrame:
    """Rows with a reason as ``(reason, label, code)``."""
    from navloom.functions.display import label

    named = df.select((F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), "code")
    return named.where("reason is not null").select(
        "reason", label(F.col("reason"), fixed.EXCLUSION_LABELS).alias("label"), "code")


def exclusion_codes(exclusions: DataFrame) -> DataFrame:
    """AG-09. Each code once per reason, as rows: a reason may hold most funds."""
    return exclusions.select("reason", "label", "code").distinct()


def exclusion_summary(exclusions: DataFrame) -> DataFrame:
    """AG-09. Distinct codes per reason, counted in two combined steps."""
    return exclusion_codes(exclusions).groupBy("reason", "label").agg(
        F.count(F.lit(1)).alias("excluded_count"), F.min("code").alias("first_code"))


def funnel(evaluated: DataFrame) -> DataFrame:
    """AG-10. All stage counters in one pass; ``closed`` says that they add up.

    ``evaluated`` has one row per eligible fund with ``failures``,
    ``ranking_list`` (null until routed) and ``quota_reason``.
    """
    passed = F.size("failures") == 0
    main = passed & (F.col("ranking_list") == fixed.MAIN_LIST)
    supplement = passed & (F.col("ranking_list") == fixed.SUPPLEMENT_LIST)
    open_quota = F.col("quota_reason").isNull()
    counts = evaluated.agg(
        F.count(F.lit(1)).alias("base_candidates_total"),
        F.count_if(F.col("failures").isNotNull()).alias("performance_candidates_scanned"),
        F.count_if(passed).alias("performance_qualified_count"),
        F.count_if(passed & F.col("ranking_list").isNotNull()).alias("us_equity_candidates_scanned"),
        F.count_if(main).alias("us_routed_count"), F.count_if(supplement).alias("global_routed_count"),
        F.count_if(main & open_quota).alias("us_quota_qualified_count"),
        F.count_if(supplement & open_quota).alias("global_quota_qualified_count"))
    return counts.withColumn("full_scan_completed", funnel_closed())


def funnel_closed() -> Column:
    routed = F.col("us_routed_count") + F.col("global_routed_count")
    return (
        (F.col("performance_candidates_scanned") == F.col("base_candidates_total"))
        & (F.col("us_equity_candidates_scanned") == F.col("performance_qualified_count"))
        & (routed == F.col("us_equity_candidates_scanned")))


def observation_periods(records: DataFrame, prefix: str) -> DataFrame:
    """AG-11. Distinct start and end dates of one horizon, in order."""
    start, end = f"{prefix}_performance_start_date", f"{prefix}_performance_end_date"
    return records.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(
        F.col(start).alias("start_date"), F.col(end).alias("end_date")).distinct().orderBy("start_date", "end_date")


def short_list_warnings(main: DataFrame, supplement: DataFrame, k: int = fixed.TOP) -> DataFrame:
    """Texts for an empty or short list."""
    def one(df: DataFrame, name: str) -> DataFrame:
        n = df.agg(F.count(F.lit(1)).alias("n"))
        text = F.when(F.col("n") == 0, f"{name}当前没有符合全部条件的基金。").when(
            F.col("n") < k, F.format_string(f"{name}仅 %d 只基金符合全部条件，未放宽门槛。", "n"))
        return n.select(text.alias("text")).where("text is not null")

    return one(main, "美国主榜").unionByName(one(supplement, "全球补充榜"))
