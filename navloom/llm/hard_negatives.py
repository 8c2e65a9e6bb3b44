"""Hard negatives by summaries of vector segments.

Every vector keeps the mean and the deviation of its segments at several levels, each
level halving the segments of the one before.  In one segment of n components
the product of two vectors is n times the product of the means, give or take the
product of the deviations; so the sums over a level bound the whole product from both
sides.  A pair is dropped at the first level whose bounds miss what is wanted, and
the few that pass the finest level are scored exactly.

Anchors come in blocks of bounded size.  A block is broadcast, every task compares its
own rows with it and keeps the best of each anchor, and one window merges the tasks'
bests.  A first look at a bounded share of the rows gives each anchor a score that
its result will reach at least, so that most tasks send next to nothing.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navloom.llm.common import staged
from navloom.session import checkpoint_folder

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# Bounds of a negative's score in hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
ANCHOR_EVERY = 100
# Anchors and their components in one broadcast block, rows compared at a time, rows of the first look.
BLOCK_ANCHORS = 1 << 12
BLOCK_VALUES = 1 << 20
TILE_ROWS = 256
LOOK_ROWS = 1 << 14
# Coarsest to finest, each half as long as the one before; short vectors use what they have.
LEVELS = 5
EXACT = 2.0 ** 53
MOST = (1 << 63) - 1
LEAST = -MOST


def prepared(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, dim and scaled vec of the rows that take part; of rows that share an id one stays, the greatest.

    A component beyond the double range is cut to it.
    """
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    base = base.where("id is not null and label is not null and vec is not null"
                      " and forall(vec, x -> x is not null and not isnan(x) and abs(x) <> double('infinity'))")
    scaled = F.expr(f"transform(vec, x -> greatest(least({SCALE} * x, 1.7976931348623157E308D), -1.7976931348623157E308D))")
    base = base.select("id", F.expr("if(id % 7 = 0, (label + 1) % 10, label)").alias("label"), scaled.alias("vec"))
    one = base.groupBy("id").agg(F.max(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    return one.select("id", "label", F.size("vec").alias("dim"), "vec")


def segment_counts(dim: int, levels: int = LEVELS) -> list[int]:
    """Segments of a vector on each level, up to single components."""
    return [c for n, c in enumerate(min(1 << level, max(dim, 1)) for level in range(levels)) if n == 0 or c > 1 << (n - 1)]


def summaries(rows: np.ndarray) -> np.ndarray:
    """Per level the segments' means, times the root of their length, then their deviations, of integer rows."""
    dim, out = rows.shape[1], []
    for count in segment_counts(dim):
        edges = [dim * i // count for i in range(count + 1)]
        for a, b in zip(edges, edges[1:]):
            out.append(rows[:, a:b].mean(axis=1) * np.sqrt(b - a))
        for a, b in zip(edges, edges[1:]):
            out.append(np.sqrt(((rows[:, a:b] - rows[:, a:b].mean(axis=1, keepdims=True)) ** 2).sum(axis=1)))
    return np.stack(out, axis=1)


def levels_of(summary: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) of every level, coarsest first."""
    out, at = [], 0
    for count in segment_counts(dim):
        out.append((summary[:, at:at + count], summary[:, at + count:at + 2 * count]))
        at += 2 * count
    return out


def _summarized(batches):
    """Append ``summary`` to rows of id, label, dim and vec."""
    for batch in batches:
        dims = batch.column(2).to_numpy()
        out = [None] * batch.num_rows
        for dim in np.unique(dims).tolist():
            mine = np.flatnonzero(dims == dim)
            with np.errstate(over="ignore", invalid="ignore"):
                table = summaries(_floored(batch.column(3).take(pa.array(mine)), dim))
            for place, row in zip(mine.tolist(), table):
                out[place] = row
        yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(out, pa.list_(pa.float64()))],
                                         names=["id", "label", "dim", "vec", "summary"])


def _floored(vec: pa.ListArray, dim: int) -> np.ndarray:
    values = vec.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values).reshape(-1, dim) if dim else np.zeros((len(vec), 1))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_scores(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Integer products of the rows pair by pair, cut to the range of a long."""
    if not len(rows) or np.abs(rows).max() * np.abs(others).max() * rows.shape[1] < EXACT:
        return np.einsum("ij,ij->i", rows, others).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(a, b)) for a, b in zip(rows.tolist(), others.tolist())]
    return np.array([max(LEAST, min(MOST, v)) for v in whole], np.int64)


class Block:
    """Anchors of one block with their summaries; ``floor`` and ``ceiling`` say which scores are still wanted.

    Both have one column per list that an anchor fills: its positives, or the
    negatives of each positive.
    """

    def __init__(self, ids, labels, rows, summary, floor, ceiling, dim: int, size: int, same_label: bool):
        self.dim = dim
        self.ids, self.labels, self.rows = ids, labels, rows
        self.exact_floor, self.exact_ceiling, self.size, self.same = floor, ceiling, size, same_label
        self.ceiling = np.where(ceiling == MOST, np.inf, ceiling)
        self._lift()
        self.levels = levels_of(summary, dim)
        self.none = np.empty(0, np.int64)
        self.best = (self.none, self.none, self.none, self.none)  # anchor, list, score, id

    def _lift(self) -> None:
        """The floors as doubles; the least one stands for any score."""
        self.floor = np.where(self.exact_floor == LEAST, -np.inf, self.exact_floor)

    def pairs(self, ids, labels, summary) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) places whose bounds at every level leave a wanted score possible."""
        same = labels[:, None] == self.labels[None, :]
        alive = same & (ids[:, None] != self.ids[None, :]) if self.same else ~same
        low, high = self.floor.min(axis=1), self.ceiling.max(axis=1)
        alive &= (low <= high)[None, :]
        i, j = None, None
        with np.errstate(over="ignore", invalid="ignore"):
            for (mean, spread), (mean_a, spread_a) in zip(levels_of(summary, self.dim), self.levels):
                if i is None:
                    middle, reach = mean @ mean_a.T, spread @ spread_a.T
                    slack = 1e-9 * (np.abs(mean) @ np.abs(mean_a).T + reach) + 1e-3
                    # A bound that is not a number, after an overflow, drops nothing.
                    alive &= ~((middle + reach + slack < low[None, :]) | (middle - reach - slack > high[None, :]))
                    if alive.mean() < 0.2:
                        i, j = np.nonzero(alive)
                else:
                    middle = np.einsum("ij,ij->i", mean[i], mean_a[j])
                    reach = np.einsum("ij,ij->i", spread[i], spread_a[j])
                    slack = 1e-9 * (np.einsum("ij,ij->i", np.abs(mean[i]), np.abs(mean_a[j])) + reach) + 1e-3
                    near = ~((middle + reach + slack < low[j]) | (middle - reach - slack > high[j]))
                    i, j = i[near], j[near]
        return (i, j) if i is not None else np.nonzero(alive)

    def add(self, ids, labels, rows, summary) -> None:
        found_i, found_j = self.pairs(ids, labels, summary)
        kept = [self.best]
        for at in range(0, len(found_i), 1 << 16):
            i, j = found_i[at:at + (1 << 16)], found_j[at:at + (1 << 16)]
            score = exact_scores(rows[i], self.rows[j])
            for k in range(self.floor.shape[1]):
                fits = (score >= self.exact_floor[j, k]) & (score <= self.exact_ceiling[j, k])
                kept.append((j[fits], np.full(fits.sum(), k), score[fits], ids[i[fits]]))
        anchor, which, score, ident = (np.concatenate(c) for c in zip(*kept))
        order = np.lexsort((ident, -score, which, anchor))
        anchor, which, score, ident = anchor[order], which[order], score[order], ident[order]
        group = anchor * self.floor.shape[1] + which
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else self.none
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        last = np.flatnonzero(rank == self.size - 1)  # full lists want nothing below their last
        self.exact_floor[anchor[last], which[last]] = score[last]
        self._lift()
        top = rank < self.size
        self.best = (anchor[top], which[top], score[top], ident[top])


FOUND = "anchor_id long, list int, score long, id long"


def _search(shared, size: int, same_label: bool):
    """The best rows of each anchor and list among a task's rows."""

    def run(batches):
        ids, labels, rows, summary, dim, floor, ceiling = shared.value
        block = Block(ids, labels, rows, summary, floor.copy(), ceiling, dim, size, same_label)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                block.add(part.column(0).to_numpy(), part.column(1).to_numpy(), _floored(part.column(2), dim),
                          _matrix(part.column(3)))
        anchor, which, score, ident = block.best
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids[anchor]), pa.array(which.astype(np.int32)), pa.array(score), pa.array(ident)],
            names=["anchor_id", "list", "score", "id"])

    return run


def _best(rows: DataFrame, look: DataFrame, block: tuple, floor, ceiling, size: int, same_label: bool) -> DataFrame:
    """The ``size`` best rows, ranked, of every anchor and list in a block (ids, labels, rows, summaries, dim)."""
    spark, ids = rows.sparkSession, block[0]
    order = Window.partitionBy("anchor_id", "list").orderBy(F.col("score").desc(), "id")

    def merged(part: DataFrame, floor) -> DataFrame:
        shared = spark.sparkContext.broadcast((*block, floor, ceiling))
        found = part.select("id", "label", "vec", "summary").mapInArrow(_search(shared, size, same_label), FOUND)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)

    # A full list of the first look shows what the last place is worth at least.
    place = {v: n for n, v in enumerate(ids.tolist())}
    floor = floor.copy()
    for r in merged(look, floor).where(F.col("rank") == size).select("anchor_id", "list", "score").collect():
        floor[place[r["anchor_id"]], r["list"]] = r["score"]
    return merged(rows, floor)


def _blocks(anchors: DataFrame, values: int):
    """The anchors of one vector size at a time, in bounded blocks: ids, labels, rows, summaries and size."""
    for dim, count in sorted((r["dim"], r["n"]) for r in anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()):
        blocks = -(-count // min(BLOCK_ANCHORS, max(1, values // max(dim, 1))))
        for number in range(blocks):
            part = anchors.where(f"dim = {dim} and pmod(xxhash64(id), {blocks}) = {number}").select(
                "id", "label", "vec", "summary").toArrow().combine_chunks()
            if part.num_rows:
                vec, summary = (part.column(c).chunk(0) for c in ("vec", "summary"))
                yield part.column("id").to_numpy(), part.column("label").to_numpy(), _floored(vec, dim), _matrix(summary), dim


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lowest: int = LOWEST, highest: int = HIGHEST, block_values: int = BLOCK_VALUES, look_rows: int = LOOK_ROWS,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Hard negatives of every anchor, a row whose id is divisible by ``every``, and each of its positives.

    Rows with a null id, label or vector and those with a null or non-finite component
    take no part; of rows that share an id one does.  Vectors meet vectors of
    their own size only.  Ties go to the smaller id.  An anchor without positives, or a
    positive without a fitting negative, gives no row; an empty table gives none.
    """
    spark: SparkSession = vectors.sparkSession
    rows = prepared(vectors, id_col, vec_col, label_col)
    rows = staged(rows.mapInArrow(_summarized, "id long, label long, dim int, vec array<double>, summary array<double>"))
    bound = min(1.0, look_rows / max(rows.count(), 1))
    chosen = F.expr(f"(xxhash64(id) & 9223372036854775807L) <= {min(MOST, int(bound * MOST))}L")
    path, number = f"{checkpoint_folder(spark)}/staged-{uuid.uuid4().hex}", 0
    for block in _blocks(rows.where(f"id % {every} = 0"), block_values):
        ids, mates = block[0], rows.where(f"dim = {block[-1]}")
        look = mates.where(chosen)
        near = staged(_best(mates, look, block, np.full((len(ids), 1), LEAST), np.full((len(ids), 1), MOST), positives, True))
        floor, ceiling = np.full((len(ids), positives), MOST), np.full((len(ids), positives), LEAST)
        place = {v: n for n, v in enumerate(ids.tolist())}
        for r in near.collect():  # at most ``positives`` rows of each anchor of the block
            at = place[r["anchor_id"]], r["rank"] - 1
            # The whole n of lowest * p <= 100 n <= highest * p.
            floor[at] = max(LEAST, -(-lowest * r["score"] // 100))
            ceiling[at] = min(MOST, highest * r["score"] // 100)
        far = _best(mates, look, block, floor, ceiling, negatives, False)
        named = near.select(F.col("anchor_id").alias("of"), (F.col("rank") - 1).alias("at"),
                            F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        far.join(named, (F.col("anchor_id") == F.col("of")) & (F.col("list") == F.col("at"))).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.parquet(f"{path}/block={number}")
        number += 1
    if not number:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(f"{RESULT}, block int").parquet(path).drop("block")
