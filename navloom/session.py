"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is worth one more exchange when an aggregate follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Call-site capture makes each column expression several times slower to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Rows of funds or documents that a task gets where their number is known; more rows mean more tasks.
TASK_ROWS = 50_000


def build_session(app: str = "navloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A session that names none gets a folder of its own, which only works on a
    local master, as in tests.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read on from there.

    The lineage is cut, lost executors lose nothing, and later plans see pruned
    columns and real sizes.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``staged``, and aggregates of the rows, taken while they are written and so without a scan."""
    seen = Observation()
    out = staged(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]))
    return out, seen.get


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` computed once for each row, whatever reads them later.

    For costly expressions: a filter or projection on a plain column is moved below it with
    a copy of its expression for each use; nothing is moved below a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))


def dealt(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """``df`` dealt by key to as many tasks as a shuffle of the session has, to more where ``rows`` ask for it.

    For texts, whose parsing costs far more than their bytes show, and for tables that
    compress far below what they hold in memory: the explicit number keeps adaptive
    execution from gathering them in a few tasks, and one file of a single row group no
    longer means one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, -(-rows // TASK_ROWS)), *keys)


def merged(left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """A join in which both sides grow with the funds, so that neither may be broadcast.

    The planner takes such a side for small because Parquet packs repeated titles, names
    and statements, while every executor would hold all of it unpacked.
    """
    return left.join(right.hint("merge"), keys, how)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies; one that is gone is no fault."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
