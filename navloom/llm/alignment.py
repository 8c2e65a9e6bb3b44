"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are grouped by their full text, so that a text of many copies is tokenized and
aligned once and its pairs count for all its documents; the measures go back to
the documents over the text's SHA-256.  Two tokens are linked where their byte
ranges overlap, and the offsets where tokens of both sides end cut them into groups.

Distinct texts are dealt into chunks of bounded size.  A chunk offers its distinct id
pairs with the documents that hold them, the pairs are counted over all chunks,
and every chunk gets back the counts of its own pairs to weigh its texts' links.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import staged
from navloom.llm.packing import CachedEncoder, single_spaced

CHUNK_BYTES = 4 << 20
# Segments that one task remembers.
CACHE_SIZE = 400_000
SPACE = "▁"  # stands for a blank in the pieces of the second tokenizer

ALIGNED = T.StructType([
    T.StructField("chunk", T.LongType()), T.StructField("digest", T.BinaryType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType()), T.StructField("times", T.BinaryType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("documents", T.ArrayType(T.LongType()))])
MEASURES = T.StructType([
    T.StructField("digest", T.BinaryType()), *ALIGNED.fields[2:6], T.StructField("n_best", T.LongType()),
    T.StructField("count_sum", T.LongType()), *ALIGNED.fields[6:8]])


def align(a: list[int], b: list[int], size_a, size_b) -> tuple[str, list[int]]:
    """Groups as ``a1,a2|b1;a3|b2`` and all linked pairs as a << 32 | b; both sides cover the same bytes."""
    groups, pairs = [], []
    i = j = first_a = first_b = 0
    end_a, end_b = size_a[a[0]], size_b[b[0]]
    while True:
        pairs.append(a[i] << 32 | b[j])
        if end_a == end_b:
            i, j = i + 1, j + 1
            groups.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
            if i == len(a):
                return ";".join(groups), pairs
            first_a, first_b = i, j
            end_a, end_b = end_a + size_a[a[i]], end_b + size_b[b[j]]
        elif end_a < end_b:
            i += 1
            end_a += size_a[a[i]]
        else:
            j += 1
            end_b += size_b[b[j]]


class Aligner:
    """Aligns single texts; segments between blanks are remembered.

    No token of either side reaches over a single blank or line feed between two
    other characters (the second vocabulary is checked for it), so both sides end
    there and a text's alignment is its segments' one after the other.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        first = CachedEncoder(path_a)
        self.encode_a = first.known.encode
        vocab = json.load(open(path_a, encoding="utf-8"))["model"]["vocab"]
        self.size_a = [0] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            self.size_a[number] = len(token)  # byte-level: one character for each byte
        self.second = SentencePieceProcessor(model_file=path_b)
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(names)]
        self.size_b = list(map(len, self.bytes_b))
        self.cuts = first.cuts and not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in names)
        self.known: dict[str, tuple | None] = {}

    def _whole(self, text: str, blank: bool) -> tuple | None:
        """Tokens and links of ``text``; with ``blank`` its first character is the blank that side B adds itself."""
        a = self.encode_a(text)
        # A segment that starts otherwise gets the added blank as a token of its own, which goes.
        b = self.second.encode(text[1:] if blank else text)[0 if blank else 1:]
        raw = text.encode()
        if not b or b"".join(map(self.bytes_b.__getitem__, b)) != raw or sum(map(self.size_a.__getitem__, a)) != len(raw):
            return None
        groups, pairs = align(a, b, self.size_a, self.size_b)
        return len(a), len(b), groups.count(";") + 1, groups, array("q", pairs).tobytes()

    def _segment(self, segment: str) -> tuple | None:
        if len(self.known) >= CACHE_SIZE:
            self.known.clear()
        found = self.known[segment] = self._whole(segment, segment[0] == " ")
        return found

    def text(self, text: str) -> tuple[int, int, int, str, np.ndarray] | None:
        """n_a, n_b, n_groups, groups and the linked pairs of blank + text; None if side B changes its bytes."""
        if not (self.cuts and single_spaced(text)):
            whole = self._whole(" " + text, True)
            return whole and (*whole[:4], np.frombuffer(whole[4], np.int64))
        known, parts = self.known, []
        for segment in (" " + text).replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]:
            part = known.get(segment) or self._segment(segment)
            if part is None:
                return None
            parts.append(part)
        n_a, n_b, n_groups, groups, pairs = zip(*parts)
        return sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), np.frombuffer(b"".join(pairs), np.int64)


def _align_chunk(path_a: str, path_b: str, with_groups: bool, aligners: dict = {}):
    def run(chunk: pa.Table) -> pa.Table:
        # One aligner for all chunks of a worker.
        if (path_a, path_b) not in aligners:
            aligners[path_a, path_b] = Aligner(path_a, path_b)
        aligner = aligners[path_a, path_b]
        name = chunk.column("chunk")[0].as_py()
        rows, held, weights = [], [], []
        for text, copies in zip(chunk.column("text").to_pylist(), chunk.column("copies").to_pylist()):
            found = aligner.text(text)
            if found:
                n_a, n_b, n_groups, groups, pairs = found
                links, times = np.unique(pairs, return_counts=True)
                rows.append((name, hashlib.sha256(text.encode()).digest(), n_a, n_b, n_groups, len(pairs),
                             hashlib.sha256(groups.encode()).hexdigest(), groups if with_groups else None,
                             links.tobytes(), times.astype(np.int32).tobytes(), None, None))
                held.append(links)
                weights.append(np.full(len(links), copies))
        if rows:
            pairs, place = np.unique(np.concatenate(held), return_inverse=True)
            documents = np.bincount(place, weights=np.concatenate(weights)).astype(np.int64)
            rows.append((name, *[None] * 9, pairs, documents))
        schema = pa.schema([(f.name, KINDS[f.dataType.simpleString()]) for f in ALIGNED.fields])
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(schema), schema.types)], schema=schema)

    return run


KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}


def _weigh_chunk(counted: pa.Table, texts: pa.Table) -> pa.Table:
    """Measures of a chunk's texts from the corpus-wide counts of its pairs."""
    counted = counted.sort_by("pair")
    pair, count = counted.column("pair").to_numpy(), counted.column("count").to_numpy()
    best = counted.column("best").to_numpy()
    n_best, count_sum = [], []
    for links, times in zip(texts.column("links").to_pylist(), texts.column("times").to_pylist()):
        at = np.searchsorted(pair, np.frombuffer(links, np.int64))
        times = np.frombuffer(times, np.int32).astype(np.int64)
        n_best.append(int(times[best[at]].sum()))
        count_sum.append(int((times * count[at]).sum()))
    keep = ["digest", "n_a", "n_b", "n_groups", "n_links"]
    schema = pa.schema([(f.name, KINDS[f.dataType.simpleString()]) for f in MEASURES.fields])
    return pa.table([*[texts.column(c) for c in keep], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                     texts.column("groups_sha256"), texts.column("groups")], names=schema.names).cast(schema)


def align_texts(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES, with_groups: bool = False) -> DataFrame:
    """The distinct texts' alignments and, with a null digest, each chunk's pairs and the documents that hold them; staged."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    dealt = distinct.withColumn("chunk", F.expr(f"pmod(xxhash64(text), {size // chunk_bytes + 1})"))
    return staged(dealt.groupBy("chunk").applyInArrow(_align_chunk(path_a, path_b, with_groups), ALIGNED))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair (a << 32 | b), count and best: the documents corpus-wide that hold a pair, and whether no pair of its a has more."""
    offered = aligned.where("digest is null").select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
    counts = offered.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("count"))
    # A window holds the pairs of one a, at most the second vocabulary's size.
    mine = Window.partitionBy(F.expr("shiftright(pair, 32)"))
    return staged(counts.withColumn("best", F.col("count") == F.max("count").over(mine)))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, chunk_bytes: int = CHUNK_BYTES,
                    with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row; ``groups`` on demand.

    A null or empty text, and one whose bytes the second tokenizer changes, has no
    tokens: zeros and an empty string.  Repeated rows repeat and each counts as a
    document; rows with a null id count as well.  Pairs of equal count are all best.
    Only doc_id and text are read; an empty table gives an empty one.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    aligned = align_texts(docs, path_a, path_b, chunk_bytes, with_groups)
    counts = pair_counts(aligned).select(F.col("pair").alias("counted"), "count", "best")
    offered = aligned.where("digest is null").select("chunk", F.explode("pairs").alias("pair"))
    returned = offered.join(counts, F.col("pair") == F.col("counted")).select("chunk", "pair", "count", "best")
    texts = aligned.where("digest is not null").select(F.col("chunk").alias("mine"), *[f.name for f in ALIGNED.fields[1:10]])
    measures = staged(returned.groupBy("chunk").cogroup(texts.groupBy("mine")).applyInArrow(_weigh_chunk, MEASURES))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.unhex(F.sha2(F.col("text").cast("string").cast("binary"), 256)).alias("own"))
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    strings = ["groups_sha256"] + ["groups"] * with_groups
    return named.join(measures, F.col("own") == F.col("digest"), "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        *[F.coalesce(c, F.lit("")).alias(c) for c in strings])
