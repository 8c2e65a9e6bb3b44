"""All checks of a finished run in one violations table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.operators import validation as val
from navloom.operators.quality import Rule, union_all, violations
from navloom.operators.runs import triage


def validate_run(records: DataFrame, results: dict[str, DataFrame], *, as_of,
                 benchmark: DataFrame | None = None, limits: val.Limits = val.DEFAULTS) -> DataFrame:
    """DQ-02 to DQ-09, DQ-12 and SET-02 over nested records and run results."""
    main = records.where(F.col("ranking_list") == fixed.MAIN_LIST)
    supplement = records.where(F.col("ranking_list") == fixed.SUPPLEMENT_LIST)
    blocking = violations(triage(results["warnings"]).where("triage = 'blocking'"),
                          [Rule("warning_blocking", F.lit(True), "warning is not reportable")], F.col("text"))
    frames = [
        val.check_records(records, as_of=as_of, limits=limits), val.check_scores(records), val.check_order(records),
        val.check_limits(records, limits), val.check_fields(records, as_of=as_of, limits=limits), val.check_lists(main, supplement),
        val.check_closure(results["funnel"]),
        val.check_exclusions(results["exclusions"], results["exclusion_summary"]), blocking,
    ]
    if benchmark is not None:
        frames.append(val.check_benchmark(benchmark, as_of=as_of, limits=limits))
    return union_all(frames)


def benchmark_metadata(index: DataFrame, fx: DataFrame, index_url: str, fx_url: str,
                       limits: val.Limits = val.DEFAULTS) -> DataFrame:
    """DQ-05. The one-row description of the benchmark that a run publishes."""
    def ends(series: DataFrame, prefix: str) -> DataFrame:
        return series.agg(F.min("date").alias(f"{prefix}_start_date"),
                          F.max("date").alias(f"{prefix}_latest_date")).withColumn("one", F.lit(1))

    return ends(index, "index").join(ends(fx, "fx"), "one").select(
        F.lit("CNY").alias("currency"), F.lit(fixed.BENCHMARK_WINDOW_YEARS).alias("window_years"),
        F.lit(limits.min_observations).alias("min_observations"),
        F.lit(limits.min_span_days).alias("min_span_days"),
        "index_start_date", "index_latest_date", "fx_start_date", "fx_latest_date",
        F.lit(index_url).alias("index_source_url"), F.lit(fx_url).alias("fx_source_url"))
