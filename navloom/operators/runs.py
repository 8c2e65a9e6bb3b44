"""Comparison of runs and the digest of a published run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.numbers import exact_round, reduction_pct
from navloom.session import staged


# Ranges of about equal numbers of distinct values that a metric is cut into.
MEDIAN_RANGES = 256
# Cuts that are looked through for each cut of the coarse search.
CUTS_PER_STEP = 16
# Ranks that the sketch behind the cuts may be off by, as a share: one in so many.
SKETCH_ACCURACY = 10_000


def value_ranges(runs: DataFrame) -> DataFrame:
    """Distinct values of ``runs(metric, value)`` with their number ``n`` and the range they fall into.

    The cuts are sampled quantiles of the distinct values, so whatever the
    distribution, outliers included, no range holds more than its share.
    """
    # Staged: the values are counted once, and the few ends of metrics have their real size.
    counts = staged(runs.where("value is not null").groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n")))
    cuts = F.percentile_approx("value", [i / MEDIAN_RANGES for i in range(1, MEDIAN_RANGES)], SKETCH_ACCURACY)
    ends = counts.groupBy("metric").agg(
        F.min("value").alias("minimum"), F.max("value").alias("maximum"), F.sum("n").alias("total"), cuts.alias("cuts"))
    ends = staged(ends.withColumn("steps", F.filter("cuts", lambda c, i: (i + 1) % CUTS_PER_STEP == 0)))

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda c: c < F.col("value")))

    # The cuts ascend: whole steps below the value first, then the cuts of the step that it lies in.
    step = below(F.col("steps")) * CUTS_PER_STEP
    placed = counts.join(ends, "metric").withColumn("step", step)
    place = F.col("step") + below(F.slice("cuts", F.col("step") + 1, F.lit(CUTS_PER_STEP - 1)))
    return placed.withColumn("range", place).drop("cuts", "steps", "step")


def baseline_summary(runs: DataFrame) -> DataFrame:
    """AG-17. Median, minimum and maximum per metric of ``runs(metric, value)``.

    The exact median without a metric's values in one task: equal values are counted
    first, and only the range or two that hold the middle ranks are sorted.
    """
    ranged = staged(value_ranges(runs))
    # At most MEDIAN_RANGES rows a metric.
    before = Window.partitionBy("metric").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("metric", "range").agg(
        F.sum("n").alias("size"), F.max("total").alias("total"), F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum")).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    inside = sizes.where((F.col("before") <= high) & (F.col("before") + F.col("size") > low)).select("metric", "range", "before")
    within = Window.partitionBy("metric", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranged.join(inside, ["metric", "range"]).withColumn("end", F.col("before") + F.sum("n").over(within))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("end") - F.col("n") <= rank) & (rank < F.col("end")), F.col("value")))

    return ranked.groupBy("metric").agg(
        ((value_at(low) + value_at(high)) / 2).alias("median"), F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"))


def compare_runs(baseline: DataFrame, current: DataFrame, targets: DataFrame) -> DataFrame:
    """AG-17. Reduction against the median and the verdict per metric.

    ``targets(metric, kind, target)``: kind ``at_most`` bounds the new value,
    ``reduction`` the reduction in percent.  A miss only warns.
    """
    joined = baseline_summary(baseline).join(current, "metric").join(targets, "metric")
    joined = joined.withColumn("reduced", reduction_pct(F.col("median"), F.col("value")))
    reduced = F.col("reduced")
    passed = F.when(F.col("kind") == "at_most", F.col("value") <= F.col("target")).otherwise(
        reduced >= F.col("target"))
    return joined.select(
        "metric", "median", "minimum", "maximum", "value", exact_round("reduced", 4).alias("reduction_pct"),
        F.when(passed, "PASS").otherwise("WARN").alias("verdict"))


def _starts(text: Column, prefixes: list[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | text.startswith(prefix)
    return found


def is_reportable(text: Column) -> Column:
    """DQ-12. Known warnings may be published; every other text blocks."""
    found = _starts(text, fixed.REPORTABLE_PREFIXES) | text.isin(fixed.REPORTABLE_TEXTS)
    for first, second in fixed.REPORTABLE_PAIRS:
        found = found | (text.contains(first) & text.contains(second))
    return found


def triage(warnings: DataFrame) -> DataFrame:
    """DQ-12. Warnings with ``triage`` reportable or blocking; a blank text blocks."""
    text = F.coalesce("text", F.lit(""))
    good = (F.trim(text) != "") & is_reportable(text)
    return warnings.withColumn("triage", F.when(good, "reportable").otherwise("blocking"))


def material_notes(warnings: DataFrame, ranking: DataFrame) -> DataFrame:
    """DQ-13. Selected warnings, open intervals and geography overrides."""
    text = F.col("text")
    crossing = text.contains("美股占比区间") & text.contains("按确认下限进入全球补充榜")
    chosen = _starts(text, fixed.DIGEST_PREFIXES) | crossing | text.isin(fixed.REPORTABLE_TEXTS)
    interval = F.format_string("%s %s：美股占比保守区间 %.2f%%-%.2f%%。", "code", "name",
                               "confirmed_pct", "possible_pct")
    override = F.format_string("地域名称分流：%s %s 因名称命中美国主榜地域关键词进入全球补充榜。", "code", "name")
    return (
        warnings.where(chosen).select(F.lit("warning").alias("kind"), "text")
        .unionByName(ranking.where("possible_pct > confirmed_pct").select(
            F.lit("interval").alias("kind"), interval.alias("text")))
        .unionByName(ranking.where(F.col("routing_reason") == fixed.ROUTE_GEOGRAPHY).select(
            F.lit("override").alias("kind"), override.alias("text")))
    )


def exclusion_lines(summary: DataFrame) -> DataFrame:
    """DQ-13. One headline per reason; the codes stay rows of ``exclusion_codes``."""
    text = F.format_string("%s：%d 只", "label", "excluded_count")
    return summary.select(F.lit("exclusion").alias("kind"), text.alias("text"))


def digest(ranking: DataFrame, summary: DataFrame, warnings: DataFrame) -> DataFrame:
    """DQ-13. Everything a reader of the run is told, one line per row."""
    return material_notes(warnings, ranking).unionByName(exclusion_lines(summary))
