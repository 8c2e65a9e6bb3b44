"""Premium of exchange-traded funds: quote checks, fallback and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date, utc_date_from_millis
from navloom.functions.numbers import exact_round, is_finite, premium_check

RECORD = ["market_price_cny", "iopv_cny", "source_discount_pct", "premium_pct", "change_pct",
          "turnover_cny", "quote_date", "updated_at", "quote_source_url"]
_NUMBERS = ["price", "iopv", "source_discount_pct", "change_pct", "turnover_cny"]


def _market_day(seconds: Column) -> Column:
    return utc_date_from_millis((seconds + 28800) * 1000)


def listed_quotes(quotes: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per listed code with the number of its response rows.

    Counting and keeping one row is a single combined aggregate; codes outside
    the catalog are ignored.
    """
    fields = [c for c in quotes.columns if c != "code"]
    once = quotes.groupBy("code").agg(
        F.count(F.lit(1)).alias("responses"), F.max(F.struct(*fields)).alias("q"))
    return once.join(catalog, "code").select(*catalog.columns, "responses", "q.*")


def duplicate_quotes(quotes: DataFrame, catalog: DataFrame) -> DataFrame:
    """AG-15. Codes answered twice: all their rows are rejected, yet they are not missing."""
    return listed_quotes(quotes, catalog).where("responses > 1").select("code", "responses")


def reject_reason(as_of) -> Column:
    """FLT-11. Why a quote row is not usable; null for a good one."""
    missing = F.lit(False)
    for name in _NUMBERS:
        missing = missing | ~is_finite(F.col(name))
    day = F.try_to_date("quote_date_raw", "yyyyMMdd")
    updated = _market_day(F.col("updated_seconds"))
    return (
        F.when(missing, "value_missing")
        .when((F.col("price") <= 0) | (F.col("iopv") <= 0) | (F.col("turnover_cny") < 0), "out_of_range")
        .when(day.isNull() | updated.isNull(), "date_invalid")
        .when((day > as_date(as_of)) | (updated > as_date(as_of)), "future_data")
        .when(~premium_check(F.col("price"), F.col("iopv"), F.col("source_discount_pct")), "premium_mismatch")
    )


def validate_quotes(quotes: DataFrame, catalog: DataFrame, *, as_of) -> DataFrame:
    """FLT-11, AG-15. Listed codes with ``reject_reason``; the good ones carry null."""
    listed = listed_quotes(quotes, catalog)
    reason = F.when(F.col("responses") > 1, "duplicate_response").otherwise(reject_reason(as_of))
    return listed.withColumn("reject_reason", reason)


def quote_records(validated: DataFrame, *keep: str) -> DataFrame:
    """Good quotes in record form, with the columns ``keep``; the premium is the negated source discount."""
    market = F.when(F.col("market_id") == 1, "sh").otherwise("sz")
    return validated.where("reject_reason is null").select(
        "code", *keep, F.coalesce(F.nullif("quote_name", F.lit("")), "name").alias("shown_name"),
        exact_round("price", 4).alias("market_price_cny"),
        exact_round("iopv", 4).alias("iopv_cny"),
        exact_round("source_discount_pct", 2).alias("source_discount_pct"),
        exact_round("-source_discount_pct", 2).alias("premium_pct"),
        exact_round("change_pct", 2).alias("change_pct"),
        exact_round("turnover_cny", 3).alias("turnover_cny"),
        F.try_to_date("quote_date_raw", "yyyyMMdd").alias("quote_date"),
        F.timestamp_seconds("updated_seconds").alias("updated_at"),
        F.format_string(fixed.QUOTE_PAGE_URL.replace("{}", "%s"), market, F.col("code")).alias("quote_source_url"))


def missing_codes(catalog: DataFrame, quotes: DataFrame) -> DataFrame:
    """JN-09. Catalog codes without any response row."""
    return catalog.select("code").join(quotes.select("code").distinct(), "code", "left_anti")


def valid_cache(cached: DataFrame, *, as_of) -> DataFrame:
    """JN-08. First usable stored record per code; ``seq`` is the stored order."""
    numbers = [F.col(c) for c in ("market_price_cny", "iopv_cny", "premium_pct", "change_pct", "turnover_cny")]
    good = F.lit(True)
    for number in numbers:
        good = good & is_finite(number)
    updated = _market_day(F.unix_seconds("updated_at"))
    rows = cached.where(
        good & (F.col("market_price_cny") > 0) & (F.col("iopv_cny") > 0) & (F.col("turnover_cny") >= 0)
        & (F.col("quote_date") <= as_date(as_of)) & (updated <= as_date(as_of)))
    first = rows.groupBy("code").agg(F.min_by(F.struct(*RECORD), "seq").alias("stored"))
    return first.select("code", "stored")


def premium_snapshot(catalog: DataFrame, quotes: DataFrame, cached: DataFrame, *, as_of) -> DataFrame:
    """JN-08. Each catalog row with its fresh, stored or no quote."""
    fresh = quote_records(validate_quotes(quotes, catalog, as_of=as_of)).select(
        "code", "shown_name", F.struct(*RECORD).alias("fresh"))
    joined = catalog.join(fresh, "code", "left").join(valid_cache(cached, as_of=as_of), "code", "left")
    status = (
        F.when(F.col("fresh").isNotNull(), "fresh")
        .when(F.col("stored").isNotNull(), "stale").otherwise("unavailable"))
    named = joined.withColumn("name", F.coalesce("shown_name", "name")).withColumn("quote_status", status)
    return named.withColumn("record", F.coalesce("fresh", "stored")).select(
        *catalog.columns, "record.*", "quote_status")


def sort_premium(snapshot: DataFrame) -> DataFrame:
    """SRT-03. Premium descending, missing last, code ascending."""
    return snapshot.orderBy(F.col("premium_pct").desc_nulls_last(), "code")


def snapshot_status(snapshot: DataFrame) -> DataFrame:
    """AG-14. One row: counts and the overall status."""
    counts = snapshot.agg(
        F.count(F.lit(1)).alias("expected_count"),
        F.count_if(F.col("quote_status") == "fresh").alias("fresh_count"),
        F.count_if(F.col("quote_status") == "stale").alias("cache_hit_count"))
    status = (
        F.when((F.col("fresh_count") > 0) & (F.col("fresh_count") == F.col("expected_count")), "fresh")
        .when(F.col("fresh_count") > 0, "partial")
        .when(F.col("cache_hit_count") > 0, "stale").otherwise("unavailable"))
    return counts.withColumn("status", status)


def premium_warnings(validated: DataFrame, missing: DataFrame) -> DataFrame:
    """One reportable text per rejected or missing code."""
    def text(reason: Column) -> Column:
        return F.concat(F.lit("场内溢价告警：部分行情未更新："), F.col("code"), F.lit(" "), reason)

    rejected = validated.where("reject_reason is not null").select("code", text(F.col("reject_reason")).alias("text"))
    return rejected.unionByName(missing.select("code", text(F.lit("missing")).alias("text")))
