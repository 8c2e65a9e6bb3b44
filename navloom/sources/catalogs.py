"""Catalogs of instruments, benchmarks and exchange funds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom import fixed_catalogs, schemas
from navloom import fixed_values as fixed
from navloom.functions.text import normalize_instrument, normalize_name
from navloom.operators.quality import DataError, Loaded, Rule, violations

_JSON_ENTRY = {
    "instruments": "aliases array<string>, category string, us_equity_pct double, "
                   "data_date string, source_name string, source_url string",
    "benchmarks": "id string, display_name string, aliases array<string>, market_scope string, "
                  "market_label string, asset_class string, style_label string, "
                  "structure string, excluded_target boolean",
    "exchange_funds": "code string, name string, exchange string, market_id int, "
                      "category string, benchmark_group string, source_url string",
}


SCHEMA_VERSION = 1


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Entries of a JSON catalog, in file order; another version is refused."""
    schema = f"schema_version int, entries array<struct<{_struct(_JSON_ENTRY[kind])}>>"
    entries = spark.read.schema(schema).json(path, multiLine=True)
    versions = {r.schema_version for r in entries.select("schema_version").distinct().collect()}
    if versions != {SCHEMA_VERSION}:
        raise DataError(f"catalog {path} has schema version {sorted(map(str, versions))}, not {SCHEMA_VERSION}")
    return entries.select(F.posexplode("entries").alias("position", "e")).select("position", "e.*")


def _struct(columns: str) -> str:
    return ", ".join(part.strip().replace(" ", ":", 1) for part in columns.split(","))


def _with_aliases(df: DataFrame, normalize) -> DataFrame:
    """Aliases normalized, without blanks and repeats, longest first."""
    clean = F.array_distinct(F.filter(F.transform("aliases", normalize), lambda a: a != ""))
    ordered = F.array_sort(clean, lambda a, b: F.length(b) - F.length(a))
    return df.withColumn("normalized_aliases", ordered)


def load_instruments(spark: SparkSession, path: str | None = None) -> DataFrame:
    """SRC-09. Look-through instruments; the position decides the first usable one."""
    if path:
        df = _read(spark, path, "instruments").withColumn("data_date", F.col("data_date").try_cast("date"))
    else:
        df = spark.createDataFrame(
            [(i, a, c, p, d and date.fromisoformat(d), n, u)
             for i, (a, c, p, d, n, u) in enumerate(fixed_catalogs.INSTRUMENTS)], schemas.INSTRUMENTS)
    return _with_aliases(df, normalize_instrument)


def load_benchmarks(spark: SparkSession, path: str | None = None) -> DataFrame:
    """SRC-09. Contract benchmarks with the fields the profile shows."""
    if path:
        df = _read(spark, path, "benchmarks")
    else:
        df = spark.createDataFrame(
            [(i, *entry) for i, entry in enumerate(fixed_catalogs.BENCHMARKS)], schemas.BENCHMARKS)
    return _with_aliases(df, normalize_name)


def check_benchmarks(catalog: DataFrame) -> DataFrame:
    """SRC-09. Violations: required fields and at least one usable alias."""
    required = ["id", "display_name", "market_scope", "market_label", "asset_class",
                "style_label", "structure", "excluded_target"]
    rules = [Rule(f"benchmark_{name}", F.col(name).isNull(), f"{name} is missing") for name in required]
    rules.append(Rule("benchmark_aliases", F.coalesce(F.size("normalized_aliases"), F.lit(0)) <= 0,
                      "no usable alias"))
    return violations(catalog, rules, F.col("position"))


def order_by_list(df: DataFrame, column: str, values: list[str], *then: str) -> DataFrame:
    """SRT-04. Sort by the place in a fixed list; values outside it come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return df.orderBy(F.when(place > 0, place).asc_nulls_last(), *then)


def load_exchange_funds(spark: SparkSession, path: str | None = None) -> Loaded:
    """SRC-10. Exchange funds with their integrity rules, in group and code order."""
    df = _read(spark, path, "exchange_funds").drop("position") if path else spark.createDataFrame(
        fixed_catalogs.EXCHANGE_FUNDS, schemas.EXCHANGE_FUNDS)
    return Loaded(order_by_list(df, "benchmark_group", fixed.PREMIUM_GROUPS, "code"),
                  check_exchange_funds(df))


def check_exchange_funds(df: DataFrame) -> DataFrame:
    """SRC-10. Violations of the exchange-fund rules."""
    repeated = df.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return violations(df, exchange_fund_rules(), F.col("code")).unionByName(
        violations(repeated, [Rule("etf_duplicate", F.col("n") > 1, "code appears twice")], F.col("code")))


def exchange_fund_rules() -> list[Rule]:
    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    return [
        Rule("etf_code", ~text("code").rlike(r"^\d{6}$"), "code is not six digits"),
        Rule("etf_name", F.trim(text("name")) == "", "name is missing"),
        Rule("etf_exchange", ~text("exchange").isin("SSE", "SZSE"), "exchange is unknown"),
        Rule("etf_market", ~((text("exchange") == "SSE") == (F.coalesce("market_id", F.lit(-1)) == 1))
             | ~F.coalesce("market_id", F.lit(-1)).isin(0, 1), "market id differs from exchange"),
        Rule("etf_category", ~text("category").isin("broad_market", "sector_theme"), "category is unknown"),
        Rule("etf_group", ~text("benchmark_group").isin(fixed.PREMIUM_GROUPS), "group is unknown"),
        Rule("etf_source", ~text("source_url").startswith("https://"), "source is not https"),
    ]


def fingerprint(catalog: DataFrame) -> DataFrame:
    """One row with a hash of the whole catalog; it changes with any entry.

    Row hashes are combined by sums that do not depend on their order, so no task
    holds them together.
    """
    text = F.to_json(F.struct(*sorted(catalog.columns)))
    parts = [F.sum(F.xxhash64(F.lit(seed), text).cast("decimal(38,0)")) for seed in range(4)]
    return catalog.agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)), *parts), 256).alias("fingerprint"))
