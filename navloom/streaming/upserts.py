"""Streams of quotes and announcements into log-structured tables.

A table is a folder of three parts:

- ``log/batch_id=N``: what micro-batch N changed.  A replayed batch overwrites its own
  folder, so a lost driver leaves no duplicates.
- ``snapshot/version=V/bucket=B``: one row per key of hash bucket B.
- ``manifest``: one row per bucket and version with the last batch it holds.  Its rows
  are written last, in one file; a snapshot without them does not exist for readers.

The state of a key is its row of greatest arrival, later batches winning ties, so a late
row changes nothing.  Every ``COMPACT_BATCHES`` batches the sink folds the log into the
buckets whose keys changed and removes what no reader needs any more: covered batches
and versions older than the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from navloom.operators.premium import RECORD, quote_records, validate_quotes
from navloom.session import remove
from navloom.sources.raw import merge_announcements

COMPACT_BATCHES = 16
BUCKETS = 32
MANIFEST = "version long, bucket int, through long"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing written yet
        return None


def _manifest(spark: SparkSession, path: str) -> list:
    """(bucket, version, through) of the newest version of every bucket, at most ``BUCKETS`` rows."""
    rows = _stored(spark, f"{path}/manifest")
    if rows is None:
        return []
    return rows.groupBy("bucket").agg(F.max("version").alias("version"), F.max("through").alias("through")).collect()


def _newest(rows: DataFrame, key: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct("arrival", "batch_id")).alias("r"))
    return last.select(*key, "r.*")


def _pending(spark: SparkSession, path: str, through: int) -> DataFrame | None:
    log = _stored(spark, f"{path}/log")
    if log is None:
        return None
    return log.withColumn("batch_id", F.col("batch_id").cast("long")).where(F.col("batch_id") > through)


def _snapshot(spark: SparkSession, path: str, manifest: list) -> DataFrame | None:
    """The rows of the newest version of every bucket; other versions' folders are pruned by name."""
    stored = _stored(spark, f"{path}/snapshot") if manifest else None
    if stored is None:
        return None
    versions = {v: [r.bucket for r in manifest if r.version == v] for v in {r.version for r in manifest}}
    chosen = F.lit(False)
    for version, buckets in versions.items():
        chosen = chosen | ((F.col("version") == version) & F.col("bucket").isin(buckets))
    return stored.where(chosen).drop("version", "bucket")


def state(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The newest row per key, with its arrival and batch."""
    manifest = _manifest(spark, path)
    parts = [p for p in (_snapshot(spark, path, manifest),
                         _pending(spark, path, max((r.through for r in manifest), default=-1))) if p is not None]
    if not parts:
        raise ValueError(f"no batch was written to {path}")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _newest(rows, key)


def compact(spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS) -> None:
    """Fold the log into the snapshot; safe to repeat, and to lose at any point."""
    manifest = _manifest(spark, path)
    through = max((r.through for r in manifest), default=-1)
    log = _pending(spark, path, through)
    last = None if log is None else log.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    bucket = F.expr(f"cast(pmod(xxhash64({', '.join(f'`{k}`' for k in key)}), {buckets}) as int)")
    changed = sorted(r[0] for r in log.select(bucket).distinct().collect())
    version = max((r.version for r in manifest), default=0) + 1
    old = _snapshot(spark, path, [r for r in manifest if r.bucket in changed])
    rows = (log if old is None else old.unionByName(log)).withColumn("bucket", bucket)
    target = f"{path}/snapshot/version={version}"
    _newest(rows.drop("bucket"), key).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(target)
    marks = [(version, b, last) for b in changed]
    spark.createDataFrame(marks, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    _remove_covered(spark, path, last, version)


def _remove_covered(spark: SparkSession, path: str, through: int, version: int) -> None:
    """Drop batches up to ``through``, and buckets that both this version and the one before replaced."""
    log = _stored(spark, f"{path}/log")
    for r in log.where(F.col("batch_id") <= through).select("batch_id").distinct().collect():
        remove(spark, f"{path}/log/batch_id={r.batch_id}")
    marks = _stored(spark, f"{path}/manifest").where(F.col("version") < version).groupBy("bucket").agg(
        F.array_sort(F.collect_set("version")).alias("versions"))
    # A reader that listed the manifest before this version still needs each bucket's version before it.
    for r in marks.collect():
        for old in r.versions[:-1][-2:]:
            remove(spark, f"{path}/snapshot/version={old}/bucket={r.bucket}")


def _log_sink(transform: Callable[[DataFrame], DataFrame], path: str, key: list[str],
              compact_batches: int) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/log/batch_id={batch_id}")
        if (batch_id + 1) % compact_batches == 0:
            compact(batch.sparkSession, path, key)

    return write


def _start(stream: DataFrame, sink, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_quotes(stream: DataFrame, catalog: DataFrame, state_path: str, checkpoint: str, *,
                  as_of, once: bool = True, compact_batches: int = COMPACT_BATCHES) -> StreamingQuery:
    """STR-01. Valid quotes of each batch; repeated and invalid rows leave the old value."""
    def records(batch: DataFrame) -> DataFrame:
        return quote_records(validate_quotes(batch, catalog, as_of=as_of), "arrival")

    return _start(stream, _log_sink(records, state_path, ["code"], compact_batches), checkpoint, once)


def premium_state(spark: SparkSession, state_path: str) -> DataFrame:
    """Latest valid record per code."""
    return state(spark, state_path, ["code"]).select("code", *RECORD)


def stream_announcements(stream: DataFrame, table_path: str, checkpoint: str, *,
                         once: bool = True, compact_batches: int = COMPACT_BATCHES) -> StreamingQuery:
    """STR-02. Landed announcement rows; the newest arrival of an id wins, within a batch and over batches."""
    key = ["code", "announcement_id"]

    def newest(batch: DataFrame) -> DataFrame:
        rows = batch.groupBy(*key).agg(
            F.max_by(F.struct("title", "published_date", "on_latest_page", "arrival"), "arrival").alias("a"))
        return rows.select(*key, "a.*")

    return _start(stream, _log_sink(newest, table_path, key, compact_batches), checkpoint, once)


def announcement_state(spark: SparkSession, table_path: str, seeded: DataFrame, *, as_of) -> DataFrame:
    """Seeded history merged with the newest landed row of each id."""
    landed = state(spark, table_path, ["code", "announcement_id"])
    return merge_announcements(seeded, landed.drop("batch_id", "arrival"), as_of)
