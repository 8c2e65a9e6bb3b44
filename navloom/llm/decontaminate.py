"""Benchmark decontamination: broadcast windows of test n-grams, scan, verify, remove.

The windows of the test set are broadcast as hashes.  Each training text is cut
into words once; rolling hashes of all its windows are looked up in a bit table,
and every survivor is verified word by word.  The broadcast has a checked bound
(``max_part_bytes`` of item text): a larger test set is split into parts that
scan one after the other over the same rows, so nothing is ever dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import append_columns, as_bytes, list_column, staged

WINDOW = 13
MAX_PART_BYTES = 16 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BITS = 22
_PRIME = np.uint64(0x9E3779B97F4A7C15)

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters a-z and characters outside ASCII."""
    return text.translate(_KEEP).split()


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values, by doubling."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    result, done, power, block, scale = None, 0, np.uint64(1), hashes, _PRIME
    size = 1
    rest = width
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                part = block[done:done + len(hashes) - width + 1]
                result = part * power if result is None else result + part * power
                done += size
                power = power * scale
            rest >>= 1
            if rest:
                block = block[:-size] + block[size:] * scale
                scale = scale * scale
                size *= 2
    return result


class WindowIndex:
    """Windows of some items: bit table and hash map by window width."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items = [(name, words_of(text)) for name, text in items]
        self.by_width: dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]] = {}
        for number, (_, words) in enumerate(self.items):
            if words:
                width = min(window, len(words))
                bits, places = self.by_width.setdefault(width, (np.zeros(1 << _BITS, bool), {}))
                found = rolling(np.array([hash(w) for w in words], np.int64).view(np.uint64), width)
                bits[found >> np.uint64(64 - _BITS)] = True
                for at, value in enumerate(found.tolist()):
                    places.setdefault(value, []).append((number, at))

    def hits(self, words: list[bytes], hashes: np.ndarray, starts: np.ndarray):
        """(document number, word position, width, item names) of each verified window.

        ``starts`` are the documents' first words in ``words``, with the end last.
        """
        for width, (bits, places) in self.by_width.items():
            found = rolling(hashes, width)
            at = np.flatnonzero(bits[found >> np.uint64(64 - _BITS)])
            docs = np.searchsorted(starts, at, side="right") - 1
            for i, doc, value in zip(at.tolist(), docs.tolist(), found[at].tolist()):
                if value not in places or i + width > starts[doc + 1]:
                    continue
                text = words[i:i + width]
                names = {self.items[n][0] for n, p in places[value] if self.items[n][1][p:p + width] == text}
                if names:
                    yield doc, i - int(starts[doc]), width, names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _scan(items, window: int, text_col: str, again: bool):
    index = WindowIndex(items, window)

    def step(batch: pa.RecordBatch) -> list[pa.Array]:
        words: list[bytes] = []
        starts = [0]
        for text in as_bytes(batch, text_col):
            words += words_of(text)
            starts.append(len(words))
        bounds = np.array(starts)
        hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        spans: dict[int, list[tuple[int, int]]] = {}
        names: dict[int, set[str]] = {}
        for doc, at, width, found in index.hits(words, hashes, bounds):
            spans.setdefault(doc, []).append((at, at + width))
            names.setdefault(doc, set()).update(found)
        if again:
            old_spans = batch.column(batch.schema.get_field_index("hit_words")).to_pylist()
            old_names = batch.column(batch.schema.get_field_index("items")).to_pylist()
            for doc, (a, b) in enumerate(zip(old_spans, old_names)):
                if a:
                    spans.setdefault(doc, []).extend((s["start"], s["end"]) for s in a)
                    names.setdefault(doc, set()).update(b)
        rows = [merged(spans.get(d, [])) for d in range(batch.num_rows)]
        flat = [s for r in rows for s in r]
        pairs = pa.StructArray.from_arrays(
            [pa.array([s[0] for s in flat], pa.int32()), pa.array([s[1] for s in flat], pa.int32())],
            ["start", "end"])
        named = [sorted(names.get(d, ())) for d in range(batch.num_rows)]
        return [pa.array(np.diff(bounds).astype(np.int64)), list_column([len(r) for r in rows], pairs),
                list_column([len(r) for r in named], pa.array([n for r in named for n in r], pa.string()))]

    return step


def item_parts(benchmark: DataFrame, max_part_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in parts of at most ``max_part_bytes`` of text, one row at least.

    The part count doubles until no part is larger, so the size of every
    broadcast is checked before its rows are read.  Rows are dealt by their id and
    text, so an item of many rows is split too, and each part is read when its turn
    comes.
    """
    sized = benchmark.where("text is not null").select("item_id", "text").distinct().select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text"), F.expr("octet_length(text)").alias("n"),
        F.expr("xxhash64(item_id, text) & 9223372036854775807").alias("h"))
    parts = 1
    while True:
        sizes = sized.groupBy(F.expr(f"h % {parts}").alias("part")).agg(
            F.sum("n").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
        if all(r["bytes"] <= max_part_bytes or r["rows"] == 1 for r in sizes):
            break
        parts *= 2
    for number in sorted(r["part"] for r in sizes):
        yield [(r["item_id"], r["text"].encode()) for r in
               sized.where(f"h % {parts} = {number}").select("item_id", "text").collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                  max_part_bytes: int = MAX_PART_BYTES) -> DataFrame:
    """Append ``n_words``, ``hit_words`` and ``items`` to every row of ``docs``.

    ``hit_words`` are the merged word ranges inside any test window, ``items``
    the ids, as strings, of the test items with a window there.  An item with
    fewer words than a window is one window; an item or text that is null or
    has no word matches nothing.  Repeated rows and ids are judged row by row;
    an empty test set marks nothing; further columns pass through untouched, but
    one of an appended name is replaced.
    """
    benchmark = benchmark.select("item_id", "text")
    marked, number = docs, -1
    for number, items in enumerate(item_parts(benchmark, max_part_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        # The driver lets go of a part before it reads the next one.
        del items

        def factory(shared=shared, again=number > 0):
            return _scan(shared.value, window, text_col, again)

        # Written between parts, so that a task never holds the windows of two.
        marked = _again(staged(marked), factory, text_col) if number else append_columns(docs, FIELDS, factory, text_col)
    if number < 0:
        return append_columns(docs, FIELDS, lambda: _scan([], window, text_col, False), text_col)
    return marked


def _again(df: DataFrame, factory, text_col: str) -> DataFrame:
    """One more part over rows that carry the hits of the parts before."""
    schema = df.schema
    keep = [f.name for f in schema.fields if f.name not in {x.name for x in FIELDS}]
    names = keep + [f.name for f in FIELDS]

    def run(batches):
        step = factory()
        for batch in batches:
            fresh = step(batch)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(k)) for k in keep] + fresh,
                                             names=names)

    return df.mapInArrow(run, T.StructType([schema[n] for n in names]))


def hit_count():
    """Words inside any test window."""
    return F.expr("aggregate(hit_words, 0L, (n, s) -> n + (s.end - s.start))")


def contaminated():
    """At least one hit, and hits for a twentieth of the words or more."""
    hits = hit_count()
    return (hits > 0) & (hits * 20 >= F.col("n_words"))


def remove_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Cut the hit word ranges, first to last character, out of the texts."""
    order = df.columns

    def run(batches):
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("hit_words")).to_pylist()
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            for row, ranges in enumerate(spans):
                if ranges:
                    raw = texts[row].encode()
                    places = [m.span() for m in WORD.finditer(raw.lower())]
                    out, last = [], 0
                    for s in ranges:
                        out.append(raw[last:places[s["start"]][0]])
                        last = places[s["end"] - 1][1]
                    texts[row] = b"".join(out + [raw[last:]]).decode()
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=order)

    return df.mapInArrow(run, df.schema)
