"""Compare the rows that share a key, without a quadratic output or a hot task.

Rows of a key with more than ``block`` rows are dealt into shards, and every pair
of shards meets in a group of its own, so that no group exceeds two blocks however
many rows share a key.  Groups stream through a task in sorted order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import staged


def meet(rows: DataFrame, ident: str, block: int, order: str, columns: list[str]) -> DataFrame:
    """Rows with ``key`` dealt to groups (key, lo, hi), each group in one partition and sorted by ``order``."""
    hot = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(
        F.col("key").alias("hot_key"), F.expr(f"cast(ceil(n / {block}) as int)").alias("shards")))
    dealt = rows.join(hot, F.col("key") == F.col("hot_key"), "left").withColumn(
        "shards", F.coalesce("shards", F.lit(1))).withColumn(
        "side", F.expr(f"cast(pmod(xxhash64({ident}), shards) as int)"))
    placed = dealt.select("key", "side", F.explode(F.expr("sequence(0, shards - 1)")).alias("other"), *columns).select(
        "key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", *columns)
    return placed.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", order)


def complete_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the group number of every row."""
    rest: pa.Table | None = None

    def ends(part: pa.Table) -> np.ndarray:
        keys = np.stack([part.column(c).to_numpy() for c in ("key", "lo", "hi")])
        return np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])

    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        part = pa.concat_tables([rest, part]).combine_chunks() if rest is not None else part
        starts = ends(part)
        last = int(np.flatnonzero(starts)[-1])
        rest = part.slice(last)
        if last:
            yield part.slice(0, last), np.cumsum(starts[:last]) - 1
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(rest.num_rows, np.int64)


def pairs_within(groups: np.ndarray, side: np.ndarray, one_shard: np.ndarray,
                 far: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j), i before j, of the same group by growing distance in the sorted order.

    In a group of two shards only rows of different shards meet.  ``far`` says, for
    rows in sorted order, which pairs and all later ones of the first row are out of reach.
    """
    size = len(groups)
    stop = np.searchsorted(groups, groups, side="right")
    active = np.arange(size)
    step = 1
    while True:
        active = active[active + step < stop[active]]
        if far is not None and len(active):
            active = active[~far(active, active + step)]
        if not len(active):
            return
        other = active + step
        meet_here = one_shard[active] | (side[active] != side[other])
        yield active[meet_here], other[meet_here]
        step += 1


class Linked:
    """Linked row pairs of a part, kept as a spanning forest once they are many."""

    LIMIT = 200_000

    def __init__(self, size: int):
        self.size, self.held, self.pairs = size, 0, []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.pairs.append((i, j))
            self.held += len(i)
            if self.held > self.LIMIT + self.size:
                self.pairs = [self.edges()]
                self.held = len(self.pairs[0][0])

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Edges that connect what the pairs connect, fewer than the rows."""
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return forest(self.size, *(np.concatenate(side) for side in zip(*self.pairs)))


def forest(size: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, least row of its component) that connect what the pairs connect."""
    label = np.arange(size)
    while len(i):
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    at = np.flatnonzero(label != np.arange(size))
    return at, label[at]
