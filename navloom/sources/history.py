"""Price histories as tables dealt by fund."""

from __future__ import annotations

from pyspark.sql import DataFrame


def bucketed_history(nav: DataFrame, name: str, buckets: int) -> DataFrame:
    """SRC-04. ``nav`` written as the table ``name``: by fund into buckets, by fund and date inside.

    Every later run aggregates and windows it by fund without an exchange.  Take so many
    buckets that one holds some hundred megabytes, and no fewer than
    ``spark.sql.shuffle.partitions``, below which Spark may deal a joined table anew.
    A table of that name is replaced.
    """
    nav.repartition(buckets, "code").write.mode("overwrite").bucketBy(buckets, "code").sortBy("code", "date").saveAsTable(name)
    return nav.sparkSession.table(name)
