"""Sinks: committed runs with a latest one, the flat export and incremental recomputation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from navloom import fixed_values as fixed
from navloom.functions.display import format_limit


# --- runs ------------------------------------------------------------------
# A run goes to a folder of its own, runs/run_date=.../attempt=..., which no reader looks at
# until one row of the manifest names it.  That row is one file, so it is there or it is not:
# readers see the run before or the run after, never half of one, and a failed attempt never.

MANIFEST = "run_date date, attempt string, committed_at timestamp, records long"


def write_run(ranking: DataFrame, path: str) -> None:
    """SNK-01. Write and commit the runs in ``ranking``, one for each of its run dates.

    A date that is run again is replaced as a whole by its newest committed attempt.
    """
    attempt = uuid.uuid4().hex
    place = f"{path}/runs/attempt={attempt}"
    ranking.write.partitionBy("run_date").json(place)
    spark = ranking.sparkSession
    written = spark.read.schema(ranking.schema).json(place).groupBy("run_date").agg(F.count(F.lit(1)).alias("records"))
    commit_run(written, attempt, path)


def commit_run(written: DataFrame, attempt: str, path: str) -> None:
    """Name an attempt's dates, ``written(run_date, records)``, in the manifest: one row each, in one file."""
    row = written.select("run_date", F.lit(attempt).alias("attempt"), F.current_timestamp().alias("committed_at"), "records")
    row.coalesce(1).write.mode("append").json(f"{path}/manifest")


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """SNK-01. run_date, attempt, committed_at and records of the newest committed attempt of every date."""
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest")
    newest = rows.groupBy("run_date").agg(F.max(F.struct("committed_at", "attempt", "records")).alias("r"))
    return newest.select("run_date", "r.attempt", "r.committed_at", "r.records")


def _read_runs(spark: SparkSession, path: str, schema: StructType, wanted: DataFrame) -> DataFrame:
    names = [f.name for f in schema.fields]
    full = StructType([f for f in schema.fields if f.name != "run_date"] + [
        StructField("attempt", StringType()), StructField("run_date", DateType())])
    stored = spark.read.schema(full).json(f"{path}/runs")
    # One row for each date: partitions of other attempts are pruned when the join is run.
    return stored.join(F.broadcast(wanted.select("run_date", "attempt")), ["run_date", "attempt"], "left_semi").select(*names)


def read_history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SNK-01. The records of every run date, each from its newest committed attempt."""
    return _read_runs(spark, path, schema, committed_runs(spark, path))


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SNK-01. The records of the latest run date that is committed, beside the history."""
    return _read_runs(spark, path, schema, committed_runs(spark, path).orderBy(F.col("run_date").desc()).limit(1))


def read_run(spark: SparkSession, path: str, schema: StructType, run_date) -> DataFrame:
    """SNK-01. The records of one run date, none where it is not committed."""
    return _read_runs(spark, path, schema, committed_runs(spark, path).where(F.col("run_date") == F.lit(run_date)))


def write_flat_csv(flat: DataFrame, path: str) -> None:
    """SNK-02. Header and UTF-8; no byte-order mark."""
    flat.write.mode("overwrite").option("header", True).option("nullValue", "").option(
        "emptyValue", "").option("escape", '"').csv(path)


def _amount(channel: str) -> Column:
    return format_limit(F.col(f"{channel}.status"), F.col(f"{channel}.amount_cny"))


def _flat_column(name: str) -> Column:
    """The value of a flat column: a field of a nested record where its prefix names one, else the column itself."""
    special = {
        "direct_limit": _amount("direct_limit"), "agency_limit": _amount("agency_limit"),
        "product_structure_tags": F.concat_ws(" | ", "product_structure_tags"),
        "quota_source_urls": F.concat_ws(" | ", "quota_source_urls"),
        "contract_benchmark_name": F.col("contract_benchmark.benchmark_name"),
        "contract_benchmark_text": F.col("contract_benchmark.benchmark_text"),
        "contract_benchmark_weight_pct": F.col("contract_benchmark.benchmark_weight_pct"),
        "contract_benchmark_components": F.to_json("contract_benchmark.components"),
        "product_summary_status": F.col("contract_benchmark.product_summary_status"),
        "product_summary_source_url": F.col("contract_benchmark.product_summary_source_url"),
    }
    if name in special:
        return special[name]
    for prefix, record in (("contract_benchmark_", "contract_benchmark"), ("contract_", "contract_benchmark"),
                           ("holding_cost_", "holding_cost"), ("nasdaq100_", "benchmark_fit"), ("us_equity_", "us_equity_exposure")):
        if name.startswith(prefix):
            return F.col(f"{record}.{name.removeprefix(prefix)}")
    return F.col(name)


def flatten_ranking(ranking: DataFrame) -> DataFrame:
    """SNK-02. The flat columns of nested ranking records, arrays joined by a bar."""
    return ranking.select(*[_flat_column(name).alias(name) for name in fixed.FLAT_COLUMNS])


def pending_documents(docs: DataFrame, results: DataFrame, fingerprint: str, version: int) -> DataFrame:
    """SNK-03. Documents without a stored result of the same identity.

    ``docs(announcement_id, fund_identity)``; a stored failure counts as a result.
    """
    current = docs.withColumn("catalog_fingerprint", F.lit(fingerprint)).withColumn(
        "method_version", F.lit(version))
    keys = ["announcement_id", "fund_identity", "catalog_fingerprint", "method_version"]
    return current.join(results.select(*keys).distinct(), keys, "left_anti")
