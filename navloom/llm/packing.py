"""Best-fit packing of token sequences, planned over the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  Only the counts per
length reach the driver (at most ``capacity`` rows): best fit decreasing runs over
counts, moving whole runs of equally filled sequences at once, and returns runs of
slots.  Pieces take the slots of their length by rank: a window within
``(length, salt)`` plus the counts of the salts before, so that a length that
holds most pieces is still ranked by many tasks.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import slices, staged

CAPACITY = 1024
END_ID = 2
# Segments that one task remembers.
CACHE_SIZE = 100_000
# Pieces of one salt; a salt is ranked by one task.
PIECES_PER_SALT = 20_000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType())])


class _Remembered(dict):
    """Ids of a segment as bytes; unknown segments are encoded when first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> bytes:
        ids = array("I", self.encode(segment)).tobytes()
        if len(self) < CACHE_SIZE:
            self[segment] = ids
        return ids


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: printable Latin-1 as itself, the rest from 256 on."""
    plain_bytes = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain_bytes)]
    return {chr(b): b for b in plain_bytes} | {chr(256 + i): b for i, b in enumerate(other)}


def _encoder(path: str) -> tuple[Callable[[str], list[int]], bool]:
    """A function from text to ids, and whether texts may be cut at single blanks and line feeds.

    A byte-level BPE vocabulary whose ids follow its merges gives the same ids as
    ranks, several times faster; any other file is run as it is.
    """
    file = json.load(open(path, encoding="utf-8"))
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    vocab = model.get("vocab", {})
    byte_level = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                  and not pre.get("add_prefix_space") and file.get("normalizer") is None and not model.get("dropout"))
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model.get("merges", [])]
    if byte_level and merged and merged == sorted(merged) and merged[0] >= 0:
        import tiktoken

        alphabet = _byte_alphabet()
        special = {t["content"] for t in file.get("added_tokens", [])}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary, True
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, False


class CachedEncoder:
    """Token ids of texts, remembered by segment.

    No token of the byte-level pattern reaches over a single blank or line feed
    between two other characters, so a text is cut there and each frequent segment
    is encoded once per task.
    """

    def __init__(self, path: str):
        encode, self.cuts = _encoder(path)
        self.known = _Remembered(encode)

    def ids(self, text: str) -> bytes:
        """Ids as native unsigned 32-bit integers."""
        if self.cuts and single_spaced(text):
            return b"".join(map(self.known.__getitem__, segments(text)))
        return array("I", self.known.encode(text)).tobytes() if text else b""


def segments(text: str) -> list[str]:
    """Pieces that encode alone as they do in the text, and join to it."""
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


# The white space of Unicode without blank and line feed, and the null character.
OTHER_SPACE = ("\0\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def single_spaced(text: str) -> bool:
    """Whether all white space is single blanks and line feeds between other characters."""
    return not (text[:1] in " \n" or text[-1:] in " \n" or "  " in text or "\n\n" in text or " \n" in text
                or "\n " in text or any(c in text for c in (OTHER_SPACE[:9] if text.isascii() else OTHER_SPACE)))


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than ``capacity``."""
    first = len(ids) % capacity or capacity
    places = [(0, min(first, len(ids)))]
    return places + [(at, capacity) for at in range(first, len(ids), capacity)]


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
             with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A null text is encoded as an empty one and so gives one piece of the end id.
    Repeated rows give repeated pieces; a null doc_id is kept.
    """
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches):
        encoder, end = CachedEncoder(tokenizer_path), np.uint32(end_id).tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                names = part.column(0).to_pylist()
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows, arrays = [], []
                for name, text in zip(names, texts):
                    ids = np.frombuffer(encoder.ids(text) + end, np.uint32).astype("<u4", copy=False)
                    for number, (start, length) in enumerate(cut(ids, capacity)):
                        piece = ids[start:start + length]
                        rows.append((name, number, start, length, zlib.crc32(piece.tobytes())))
                        if with_ids:
                            arrays.append(piece.astype(np.int32))
                columns = list(zip(*rows)) or [()] * 5
                out = [pa.array(c, t) for c, t in zip(
                    columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])]
                if with_ids:
                    out.append(pa.array(arrays, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts.

    Returns runs (length, first rank, pieces, first sequence, offset, per
    sequence): the pieces of those ranks go, ``per sequence`` at a time and one
    after the other from ``offset``, to consecutive sequences.  The number of runs
    depends on ``capacity`` alone, not on the counts.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs (first sequence, sequences)
    runs, opened = [], 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = min((r for r in free if r >= length), default=None)
            if room is None:
                room, each = capacity, capacity // length
                first, size = opened, -(-left // each)
                opened += size
            else:
                first, size = free[room].pop()
                if not free[room]:
                    del free[room]
                each = room // length
            full = min(size, left // each)
            if full:
                runs.append((length, rank, full * each, first, capacity - room, each))
                rank, left = rank + full * each, left - full * each
                if room > each * length:
                    free.setdefault(room - each * length, []).append((first, full))
            rest = size - full
            if rest and left and left < each:
                runs.append((length, rank, left, first + full, capacity - room, left))
                if room > left * length:
                    free.setdefault(room - left * length, []).append((first + full, 1))
                rank, left, rest, full = rank + left, 0, rest - 1, full + 1
            if rest:
                free.setdefault(room, []).append((first + full, rest))
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with columns doc_id, piece and length.

    Ties in doc_id and piece may take each other's slots.  An empty table gives an
    empty table; further columns pass through.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(histogram, capacity)
    salts = max(1, -(-sum(histogram.values()) // PIECES_PER_SALT))
    salted = pieces.withColumn("_salt", F.expr(f"pmod(xxhash64(doc_id, piece), {salts})"))
    # Counts per salt: at most capacity rows for every salt.
    sums = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("length").alias("_l"), F.col("_salt").alias("_s"),
        F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(
        before, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s"))).withColumn(
        "_rank", F.col("_rank") + F.col("_before")).drop("_l", "_s", "_before", "_salt")
    shared = spark.sparkContext.broadcast(_by_length(runs))
    schema = T.StructType(pieces.schema.fields + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names

    def run(batches):
        slots = shared.value
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                table = slots[length]
                at = table[np.searchsorted(table[:, 0], ranks[mine], side="right") - 1]
                steps = ranks[mine] - at[:, 0]
                sequence[mine] = at[:, 1] + steps // at[:, 3]
                offset[mine] = at[:, 2] + steps % at[:, 3] * length
            keep = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_rank"]
            yield pa.RecordBatch.from_arrays(keep + [pa.array(sequence), pa.array(offset)], names=names)

    return ranked.select(*[F.col(f"`{c}`") for c in pieces.columns], "_rank").mapInArrow(run, schema)


def _by_length(runs) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, offset, per sequence) by rank."""
    out: dict[int, list] = {}
    for length, rank, _, first, offset, each in runs:
        out.setdefault(length, []).append((rank, first, offset, each))
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack documents; one row per piece with its place.

    The pieces are staged once, because the histogram and the placement both read
    them and tokenizing is the dear part.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(staged(tokenize(docs, path, capacity, end_id, with_ids)), capacity)
