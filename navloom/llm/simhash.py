"""SimHash near-duplicates with pivot distance tables.

Fingerprints of equal value are one node.  Two fingerprints at most ``bits``
apart agree on at least two of ``bits + 2`` bit blocks, so every pair of blocks is
a key under which such pairs meet.  In a group the distances of every fingerprint
to the reference fingerprints are tabled once; rows are sorted by the first
distance, pairs whose largest coordinate difference exceeds ``bits`` are discarded
(the triangle inequality), and the survivors are verified by exact Hamming
distance.  Groups emit spanning forests, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from navloom.llm.common import append_columns, as_bytes, bundled, id_text, staged, unbundled
from navloom.llm.graph import components
from navloom.llm.grouping import Linked, complete_groups, meet, pairs_within

WORDS = 4
SEED = 42
BITS = 4
PIVOTS = 16
BLOCK_ROWS = 512


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the first ``count`` values of a 64-bit mixing sequence."""
    with np.errstate(over="ignore"):
        z = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint(text: bytes, width: int = WORDS) -> int:
    """64-bit SimHash of the lower-cased words' shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", column: str = "fp") -> DataFrame:
    """Append the fingerprint, as a signed long, to every row; null and empty texts have zero."""

    def factory():
        def step(batch: pa.RecordBatch):
            values = np.array([fingerprint(t) for t in as_bytes(batch, text_col)], np.uint64)
            return [pa.array(values.view(np.int64))]

        return step

    return append_columns(docs, [T.StructField(column, T.LongType())], factory, text_col)


def _keys(bits: int) -> Column:
    """One key for every two of ``bits + 2`` blocks of the fingerprint."""
    blocks = bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [f"(shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L)" for a, b in zip(edges, edges[1:])]
    width = max(b - a for a, b in zip(edges, edges[1:]))
    return F.expr("array(" + ", ".join(
        f"shiftleft({number}L, {2 * width}) | shiftleft({parts[i]}, {width}) | {parts[j]}"
        for number, (i, j) in enumerate(combinations(range(blocks), 2))) + ")")


def _links(bits: int, references: np.ndarray):
    def run(batches):
        for part, groups in complete_groups(batches):
            fp = part.column("fp").to_numpy().view(np.uint64)
            rep, side = part.column("rep").to_numpy(), part.column("side").to_numpy()
            one = part.column("lo").to_numpy() == part.column("hi").to_numpy()
            table = np.bitwise_count(fp[:, None] ^ references[None, :]).astype(np.int8)
            first = table[:, 0].astype(np.int64)
            found = Linked(len(fp))
            for i, j in pairs_within(groups, side, one, lambda a, b: first[b] - first[a] > bits):
                for k in range(1, len(references)):
                    near = np.abs(table[i, k] - table[j, k]) <= bits
                    i, j = i[near], j[near]
                    if not len(i):
                        break
                near = np.bitwise_count(fp[i] ^ fp[j]) <= bits
                found.add(i[near], j[near])
            a, b = found.edges()
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["a", "b"])

    return run


def link(nodes: DataFrame, bits: int = BITS, block: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between the ``rep`` of fingerprints at most ``bits`` apart.

    ``nodes`` has one row per distinct ``fp``.  The edges connect the same nodes as
    all such pairs would.
    """
    references = pivots()
    first = np.array(references[:1]).view(np.int64)[0]
    rows = nodes.select("fp", "rep", F.explode(_keys(bits)).alias("key")).withColumn(
        "d0", F.expr(f"cast(bit_count(fp ^ {first}L) as int)"))
    grouped = meet(rows, "fp", block, "d0", ["fp", "rep", "d0"])
    return grouped.mapInArrow(_links(bits, references), "a long, b long")


def _classes(table: DataFrame, bits: int) -> DataFrame:
    """k, component_id and winner of every fingerprint in rows of doc_id, fp and h.

    Fingerprints are the nodes, so an id with several texts joins no groups.  The
    winner is the (doc_id, h, fp) of least id and text hash in the whole group.
    """
    nodes = staged(table.where("doc_id is not null").groupBy(F.col("fp").alias("k")).agg(
        F.min(F.struct("doc_id", "h", "fp")).alias("least")))
    found = components(link(nodes.select(F.col("k").alias("fp"), F.col("k").alias("rep")), bits))
    named = staged(nodes.join(found, F.col("k") == F.col("node"), "left").select(
        "k", "least", F.coalesce("component", "k").alias("c")))
    heads = named.groupBy(F.col("c").alias("head")).agg(F.min("least").alias("winner"))
    return staged(named.join(heads, F.col("c") == F.col("head")).select(
        "k", F.col("winner.doc_id").alias("component_id"), "winner"))


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, fp and component_id of every row with an id and a text column.

    Rows with a null id are fingerprinted and stay alone, with a null component.
    Repeated rows repeat.  Rows that share an id but not the text are judged by their
    texts, each in its own group.
    """
    table = staged(fingerprints(id_text(docs)).select("doc_id", "fp", F.lit(0).cast("long").alias("h")))
    return table.join(_classes(table, bits), F.col("fp") == F.col("k"), "left").select(
        "doc_id", "fp", F.expr("case when doc_id is not null then component_id end").alias("component_id"))


def keep_first(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates; columns unchanged.

    A group keeps its smallest id, of several texts under that id the one of least
    hash, of equal rows any one.  Rows with a null id stay.  Every text has a group,
    so of each text a near copy at least is kept, whatever ids repeat.
    """
    rows = staged(fingerprints(bundled(docs)).select(
        "row", "text", F.expr("cast(row.doc_id as long)").alias("doc_id"), "fp", F.xxhash64("text").alias("h")))
    table = rows.select("doc_id", "fp", "h")
    winners = _classes(table, bits).select("winner").distinct().select(
        F.col("winner.doc_id").alias("w_id"), F.col("winner.h").alias("w_h"), F.col("winner.fp").alias("w_fp"))
    kept = rows.join(winners.hint("merge"), (F.col("doc_id") == F.col("w_id")) & (F.col("h") == F.col("w_h"))
                     & (F.col("fp") == F.col("w_fp")), "left_semi")
    turn = F.row_number().over(Window.partitionBy("doc_id", "h", "fp").orderBy("doc_id"))
    one = kept.withColumn("turn", turn).where("turn = 1")
    return unbundled(one.select("row", "text").union(rows.where("doc_id is null").select("row", "text")), docs.columns)
