"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on random Gaussian directions, shifted and cut
into cells of a fixed width; ``k`` cells form a bucket of one table.  Vectors that
share a bucket of any table are compared by exact cosine in double precision.
``k`` and the number of tables follow from the row count: ``k`` keeps unrelated
vectors to about one in a bucket, the tables give the wanted recall at the
threshold.  A pair is counted in the first table in which it meets, so link
counts need no list of pairs.
"""

from __future__ import annotations

from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import staged
from navloom.llm.graph import components
from navloom.llm.grouping import Linked, complete_groups, meet, pairs_within

THRESHOLD = 0.95
RECALL = 0.995
WIDTH = 2.0
SEED = 17
BLOCK_ROWS = 512


def meeting_chance(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts two points at ``distance`` into the same cell."""
    t = width / distance
    below = 0.5 * (1 + erf(-t / sqrt(2)))
    return 1 - 2 * below - 2 / (sqrt(2 * pi) * t) * (1 - exp(-t * t / 2))


def settings(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and tables for ``rows`` vectors.

    Unrelated unit vectors lie about the square root of two apart.
    """
    near, far = meeting_chance(sqrt(2 - 2 * threshold)), meeting_chance(sqrt(2))
    k = max(4, ceil(log(max(rows, 2)) / log(1 / far)))
    return k, ceil(log(1 - recall) / log(1 - near ** k))


def cells(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Bucket codes, 32 bits each, of unit rows in every table."""
    dim = unit.shape[1]
    rng = np.random.default_rng(SEED + dim)
    directions, shifts = rng.standard_normal((dim, k * tables)), rng.uniform(0, WIDTH, k * tables)
    mix = rng.integers(1, 1 << 63, (tables, k), dtype=np.uint64) | np.uint64(1)
    cell = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), tables, k)
    with np.errstate(over="ignore"):
        code = (cell * mix[None]).sum(axis=2, dtype=np.uint64) + np.uint64(dim)
        code = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(32)).astype(np.uint32)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _coded(k: int, tables: int):
    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            codes = np.zeros((batch.num_rows, tables), np.uint32)
            for dim in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dim)
                rows = values[starts[mine][:, None] + np.arange(dim)[None, :]].astype(np.float64)
                codes[mine] = cells(units(rows), k, tables)
            flat = pa.array(codes.view(np.int32).reshape(-1))
            offsets = pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.ListArray.from_arrays(offsets, flat)],
                                             names=["rep", "copies", "vec", "codes"])

    return run


def _linked(threshold: float):
    def run(batches):
        for part, groups in complete_groups(batches):
            part = part.combine_chunks()
            rep, copies, side = (part.column(c).to_numpy() for c in ("rep", "copies", "side"))
            one = part.column("lo").to_numpy() == part.column("hi").to_numpy()
            number = (part.column("key").to_numpy() >> 32).astype(np.int64)
            vec, code = part.column("vec").combine_chunks(), part.column("codes").combine_chunks()
            sizes = np.diff(vec.offsets.to_numpy())
            codes = code.flatten().to_numpy().reshape(len(rep), -1)
            # Shorter vectors are padded; only equal sizes are compared.
            rows = np.zeros((len(rep), int(sizes.max())))
            rows[np.arange(rows.shape[1])[None, :] < sizes[:, None]] = vec.flatten().to_numpy(zero_copy_only=False)
            unit = units(rows)
            earlier = np.arange(codes.shape[1])
            links = np.zeros(len(rep), np.int64)
            found = Linked(len(rep))
            for i, j in pairs_within(groups, side, one):
                near = (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold) & (sizes[i] == sizes[j])
                i, j = i[near], j[near]
                if len(i):
                    met = ((codes[i] == codes[j]) & (earlier[None, :] < number[i][:, None])).any(axis=1)
                    i, j = i[~met], j[~met]
                if len(i):
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    found.add(i, j)
            a, b = found.edges()
            if len(a):
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([rep[a], rep[at]])),
                     pa.array(np.concatenate([rep[b], np.full(len(at), -1)]), pa.int64(),
                              mask=np.concatenate([np.zeros(len(a), bool), np.ones(len(at), bool)])),
                     pa.array(np.concatenate([np.zeros(len(a), np.int64), links[at]]))], names=["a", "b", "n"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                    id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links and component_id of every row.

    Null, empty and zero vectors and those with null or non-finite components link
    with nothing; so do rows with a null id, whose component is null.  Vectors of
    different sizes never link.  Equal vectors link with each other; they are
    compared with the rest once.  Rows that repeat an id count as so many vectors.
    """
    base = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").alias("vec"))
    base = base.withColumn("vec", F.expr(
        "case when vec_id is not null and exists(vec, x -> x <> 0)"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) <> double('infinity')) then vec end"))
    distinct = base.where("vec is not null").groupBy("vec").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).select("rep", "copies", "vec")
    nodes = staged(distinct)
    k, tables = settings(nodes.count(), threshold, recall)
    kind = nodes.schema["vec"].dataType.simpleString()
    coded = staged(nodes.mapInArrow(_coded(k, tables), f"rep long, copies long, vec {kind}, codes array<int>"))
    rows = coded.select("rep", "copies", "vec", "codes", F.posexplode("codes").alias("number", "code")).withColumn(
        "key", F.expr("shiftleft(cast(number as long), 32) | (cast(code as long) & 4294967295L)"))
    found = staged(meet(rows, "rep", block, "rep", ["rep", "copies", "vec", "codes"]).mapInArrow(
        _linked(threshold), "a long, b long, n long"))
    counts = found.where("b is null").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("n"))
    classes = components(found.where("b is not null"))
    per_node = staged(nodes.join(counts, F.col("rep") == F.col("linked"), "left").join(
        classes, F.col("rep") == F.col("node"), "left").select(
        F.col("vec").alias("v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")))
    return base.join(per_node, F.col("vec") == F.col("v"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
