"""Removal of repeated byte strings with sorted, front-coded suffix runs.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier.  Every
such string holds an anchor: the position of the least hash among its
``GRAM``-byte strings, leftmost on ties, so equal strings have it at the same place.
Only suffixes at anchors are sorted, one in some thirty bytes, and only those
whose gram occurs twice in the corpus:

1. each task emits the grams of its anchors; grams seen twice are kept.  A task tells the
   others once of a gram that it has met twice itself and deals the gram's rows by document;
2. documents meet their repeated grams, and each task sorts the suffixes at those
   anchors, settles what repeats inside the task and front-codes the rest as sorted
   runs (common prefix with the suffix before, remaining bytes);
3. runs of a bucket of grams meet in one task, where a loser tree merges them.
   It compares two suffixes only behind the prefix both are known to share, and gives
   the common prefix of neighbours, from which equal strings follow for every offset of
   a string around its anchor.  A gram of more than ``HOT`` rows is dealt by a longer window
   instead: each of its strings by the bytes that all strings of nearly the same
   distance share, so that one line between different neighbours does not meet in one bucket;
4. removed ranges are gathered by groups of documents and return to them.

A passage that fills a third of the corpus reaches its bucket once for each task and
variant, because tasks settle their own repeats first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import as_bytes, list_column, release, staged
from navloom.llm.decontaminate import rolling

LENGTH = 100
GRAM = 40
# Bytes hashed at a time, suffixes settled at a time, and text for each bucket of grams.
SEGMENT = 1 << 19
SUFFIXES = 40_000
BUCKET_BYTES = 16 << 20
# Rows from which a gram is dealt by longer windows, unless more than HOT_GRAMS grams have so many,
# and the distances from string to anchor that share a window of LENGTH - STEP + 1 bytes.
HOT = 8192
HOT_GRAMS = 1_000_000
STEP = 8
# Grams that a task remembers to have met twice.
REMEMBERED = 1 << 17
_MARK, _ROW, _KNOWN = 0, 1, 2
_POSITION = np.uint64((1 << 24) - 1)
_VALUES = np.random.default_rng(23).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, start, bytes) of texts long enough, together about ``SEGMENT`` bytes.

    Longer texts are cut so that every string of ``length`` bytes is in one piece.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), SEGMENT):
            piece = text[start:start + SEGMENT + length - 1]
            held.append((row, start, piece))
            size += len(piece)
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Anchors of all strings of ``length`` bytes inside the pieces.

    Returns arrays: piece number, anchor position in the piece, gram hash, and
    the least and largest distance from the string's start to the anchor.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    starts = ends - np.array([len(p) for p in pieces])
    hashes = _mixed(rolling(_VALUES[data], gram))
    keys = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    window = length - gram + 1
    width = 1
    least = keys
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        rest = window - width
        least = np.minimum(least[:len(least) - rest], least[rest:])
    at = (least & _POSITION).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), ends - starts)[:len(at)]
    inside = np.arange(len(at)) + length <= ends[piece]
    first = np.flatnonzero(inside)
    at, piece = at[first], piece[first]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])]) if len(at) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return (piece[head], at[head] - starts[piece[head]], hashes[at[head]].view(np.int64),
            at[tail] - first[tail], at[head] - first[head])


def _grams(length: int, gram: int):
    """(gram, document, kind) of anchors: known to occur twice, not known to, or a mark of a known gram."""

    def run(batches):
        marked = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for held in segments(as_bytes(batch, "text"), length):
                piece, _, grams, _, _ = anchors([p for _, _, p in held], length, gram)
                if not len(grams):
                    continue
                owner = ids[np.array([r for r, _, _ in held])][piece]
                order = np.lexsort([owner, grams])
                grams, owner = grams[order], owner[order]
                heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
                sizes = np.diff(np.append(heads, len(grams)))
                old = np.isin(grams[heads], marked)
                known = np.repeat(old | (sizes >= 2), sizes)
                again = np.concatenate([[False], (grams[1:] == grams[:-1]) & (owner[1:] == owner[:-1])])
                new = grams[heads[(sizes >= 2) & ~old]]
                marked = np.union1d(marked, new) if len(marked) + len(new) <= REMEMBERED else new
                grams, owner, known = grams[~again], owner[~again], known[~again]
                kind = np.where(known, _KNOWN, _ROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([grams, new])), pa.array(np.concatenate([owner, np.zeros(len(new), np.int64)])),
                     pa.array(np.concatenate([kind, np.full(len(new), _MARK)]).astype(np.int8))], names=["g", "ord", "kind"])

    return run


def _repeated(batches):
    """Rows of grams known to occur twice, and of the rest, sorted by gram and marks first, those that do.

    One row is held back at most.
    """
    before, pending = None, None
    for batch in batches:
        g, owner, kind = (batch.column(i).to_numpy() for i in range(3))
        known, rest = kind == _KNOWN, kind != _KNOWN
        out_g, out_owner = [g[known]], [owner[known]]
        g, owner, mark = g[rest], owner[rest], kind[rest] == _MARK
        if len(g):
            heads = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            sizes = np.diff(np.append(heads, len(g)))
            many = (sizes >= 2) | mark[heads]
            if before == g[0]:
                many[0] = True
                if pending is not None:
                    out_g.append([before])
                    out_owner.append([pending])
            keep = np.repeat(many, sizes) & ~mark
            out_g.append(g[keep])
            out_owner.append(owner[keep])
            before, pending = g[-1], None if many[-1] else owner[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out_owner), pa.int64()), pa.array(np.concatenate(out_g), pa.int64())], names=["ord", "g"])


class Suffixes:
    """Suffixes at anchors in sorted order, with what lies before each anchor."""

    def __init__(self, owner, position, low, high, right: list[bytes], left: list[bytes], common: np.ndarray):
        self.owner, self.position, self.low, self.high = owner, position, low, high
        self.right, self.left, self.common = right, left, common

    def earlier(self, length: int, gram: int) -> np.ndarray:
        """Per suffix and distance: whether the string that starts there has an earlier equal.

        The neighbours' common prefix bounds the equality behind the anchor; the bytes
        in front, read backwards and sorted likewise, bound the equality there.
        """
        size, reach = len(self.right), length - gram + 1
        rank = np.lexsort([self.position, self.owner])
        owner, position = self.owner[rank], self.position[rank]
        place = np.zeros(size, np.int64)
        place[rank] = np.concatenate([[0], np.cumsum((owner[1:] != owner[:-1]) | (position[1:] != position[:-1]))])
        front = [text[::-1] for text in self.left]
        backward = np.array(sorted(range(size), key=front.__getitem__), np.int64)
        fronts = common_prefixes([front[i] for i in backward.tolist()], reach)
        out = np.zeros((size, reach), bool)
        alike = np.zeros(size, np.int64)
        for distance in range(reach):
            mine = rank[(self.low[rank] <= distance) & (distance <= self.high[rank])]
            if len(mine) < 2:
                continue
            run = np.cumsum(self.common < length - distance)
            alike[backward] = np.cumsum(fronts < distance)
            key = run[mine] * (size + 1) + alike[mine]
            order = np.argsort(key, kind="stable")
            key, mine = key[order], mine[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = mine[np.maximum.accumulate(np.where(new, np.arange(len(mine)), 0))]
            out[mine, distance] = place[first] < place[mine]
        return out


def stretches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of every run of true values in the rows of ``marks``."""
    edges = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    return row, first, after - 1


def common_prefixes(texts: list[bytes], length: int) -> np.ndarray:
    """Common prefix of each text with the one before, zero for the first."""
    table = np.zeros((len(texts), length), np.uint8)
    sizes = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    table[np.arange(length)[None, :] < sizes[:, None]] = flat
    same = np.pad(table[1:] == table[:-1], ((0, 0), (0, 1)))
    out = np.zeros(len(texts), np.int64)
    out[1:] = np.minimum(same.argmin(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return out


def shared(a: bytes, b: bytes, known: int) -> int:
    """Common prefix of two texts that agree in their first ``known`` bytes."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    while True:
        middle = (known + end + 1) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        elif middle - known <= 1:
            return known
        else:
            end = middle


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """Merge sorted runs by a loser tree that knows common prefixes.

    A run yields (common prefix with its text before, text); the result (run,
    common prefix with the result before, text).  Every candidate carries its common prefix
    with the last result: the longer one comes first, and only on a tie are the texts compared,
    behind that prefix.
    """
    size = 1
    while size < len(runs):
        size *= 2
    text: list[bytes | None] = [None] * size
    known = [-1] * size
    for i, run in enumerate(runs):
        item = next(run, None)
        if item is not None:
            known[i], text[i] = 0, item[1]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows its common prefix with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        both = shared(text[a], text[b], known[a])
        if text[a][both:both + 1] <= text[b][both:both + 1]:
            known[b] = both
            return a, b
        known[a] = both
        return b, a

    losers = [0] * size
    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        winners = []
        for i in range(0, len(level), 2):
            winner, losers[node + i // 2] = play(level[i], level[i + 1])
            winners.append(winner)
        level = winners
    best = level[0]
    while known[best] >= 0:
        yield best, known[best], text[best]
        item = next(runs[best], None)
        if item is None:
            known[best], text[best] = -1, None
        else:
            known[best], text[best] = item
        node = (size + best) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


OUT = "bucket int, owners array<long>, starts array<int>, ends array<int>, docs array<long>, places array<int>, lows array<int>," \
      " highs array<int>, commons array<int>, sizes array<int>, tails binary, befores binary"
_NAMES = ["bucket", "owners", "starts", "ends", "docs", "places", "lows", "highs", "commons", "sizes", "tails", "befores"]


def _removed_rows(found: Suffixes, marks: np.ndarray, length: int, buckets: int) -> pa.RecordBatch:
    """Removed ranges, one row for each group of documents; its bucket is -1 - group."""
    row, near, far = stretches(marks)
    owner, start, end = found.owner[row], found.position[row] - far, found.position[row] - near + length
    group = (_mixed(owner.view(np.uint64).copy()) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort([start, owner, group])
    group, owner, start, end = group[order], owner[order], start[order], end[order]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, len(group))).tolist() if len(group) else []
    size = len(heads)
    empty = {"docs": pa.int64()}
    rest = [pa.nulls(size, pa.list_(empty.get(n, pa.int32()))) for n in _NAMES[4:10]] + [pa.nulls(size, pa.binary())] * 2
    return pa.RecordBatch.from_arrays(
        [pa.array((-1 - group[heads]).astype(np.int32)), list_column(counts, pa.array(owner)),
         list_column(counts, pa.array(start.astype(np.int32))), list_column(counts, pa.array(end.astype(np.int32))), *rest],
        names=_NAMES)


def _by_document(batches):
    """Step 4: ranges of a group of documents, as one row for each document."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        owner, start, end = (np.concatenate([b.column(i).flatten().to_numpy() for b in held]) for i in (1, 2, 3))
        order = np.lexsort([start, owner])
        owner, start, end = owner[order], start[order], end[order]
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.append(heads, len(owner))).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(owner[heads]), list_column(counts, pa.array(start)), list_column(counts, pa.array(end))],
            names=["k", "starts", "ends"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        group = batch.column(0).to_numpy()
        for part in np.split(np.arange(len(group)), np.flatnonzero(group[1:] != group[:-1]) + 1):
            if not len(part):
                continue
            if held and held[-1].column(0)[0].as_py() != group[part[0]]:
                yield rows(held)
                held = []
            held.append(batch.slice(int(part[0]), len(part)))
    if held:
        yield rows(held)


def cut_by_step(row: np.ndarray, near: np.ndarray, far: np.ndarray, hot: np.ndarray):
    """Stretches of distances, those of hot suffixes cut at every multiple of ``STEP``."""
    pieces = np.where(hot[row], far // STEP - near // STEP + 1, 1)
    at = np.repeat(np.arange(len(row)), pieces)
    step = near[at] // STEP + np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    row, near, far = row[at], near[at], far[at]
    cut = hot[row]
    return row, np.where(cut, np.maximum(near, step * STEP), near), np.where(cut, np.minimum(far, step * STEP + STEP - 1), far)


def shared_window(left: bytes, right: bytes, distance: int, length: int, gram: int) -> bytes:
    """The bytes around an anchor that all strings with it in the same step of distances hold."""
    least = distance - distance % STEP
    most = min(least + STEP - 1, length - gram)
    return left[len(left) - least:] + right[:length - most]


def _runs(buckets: int, length: int, gram: int):
    """Step 2: settle the repeats of a task, front-code the rest by bucket."""

    def flush(parts) -> Iterator[pa.RecordBatch]:
        owner, position, grams, low, high, hot = (np.concatenate([p[i] for p in parts]) for i in range(6))
        right = [t for p in parts for t in p[6]]
        left = [t for p in parts for t in p[7]]
        order = np.array(sorted(range(len(right)), key=right.__getitem__), np.int64)
        right, left = [right[i] for i in order], [left[i] for i in order]
        found = Suffixes(owner[order], position[order], low[order], high[order], right, left,
                         common_prefixes(right, length))
        marks = found.earlier(length, gram)
        yield _removed_rows(found, marks, length, buckets)
        distance = np.arange(marks.shape[1])
        own = (distance >= found.low[:, None]) & (distance <= found.high[:, None])
        hot = hot[order]
        row, near, far = cut_by_step(*stretches(own & ~marks), hot)
        dealt = grams[order].view(np.uint64)[row]
        for i in np.flatnonzero(hot[row]).tolist():
            at = row[i]
            dealt[i] = xxhash.xxh64_intdigest(shared_window(left[at], right[at], int(near[i]), length, gram))
        bucket = (dealt % np.uint64(buckets)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            mine = np.flatnonzero(bucket == b)
            at = row[mine]
            texts = [right[i][:length - n] for i, n in zip(at.tolist(), near[mine].tolist())]
            # A shortened suffix may leave the order; sort the run again.
            again = sorted(range(len(texts)), key=texts.__getitem__)
            texts, mine = [texts[i] for i in again], mine[again]
            at = row[mine]
            commons = common_prefixes(texts, length)
            tails = [t[c:] for t, c in zip(texts, commons.tolist())]
            befores = [left[i][len(left[i]) - f:] if f else b"" for i, f in zip(at.tolist(), far[mine].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int32())),
                 pa.nulls(1, pa.list_(pa.int32())), pa.array([found.owner[at]], pa.list_(pa.int64())),
                 *[pa.array([v], pa.list_(pa.int32())) for v in (
                     found.position[at], near[mine], far[mine], commons, [len(t) for t in tails])],
                 pa.array([b"".join(tails)], pa.binary()), pa.array([b"".join(befores)], pa.binary())], names=_NAMES)

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = as_bytes(batch, "text")
            wanted, hot = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for held in segments(texts, length):
                piece, at, grams, low, high = anchors([p for _, _, p in held], length, gram)
                rows = np.array([r for r, _, _ in held])[piece]
                keep, warm = np.zeros(len(piece), bool), np.zeros(len(piece), bool)
                for r in np.unique(rows).tolist():
                    mine = np.flatnonzero(rows == r)
                    keep[mine] = np.isin(grams[mine], np.array(wanted[r], np.int64))
                    if hot[r]:
                        warm[mine] = np.isin(grams[mine], np.array(hot[r], np.int64))
                piece, at, grams, low, high, warm, rows = (v[keep] for v in (piece, at, grams, low, high, warm, rows))
                right, left = [], []
                for p, a, n, f in zip(piece.tolist(), at.tolist(), low.tolist(), high.tolist()):
                    text = held[p][2]
                    right.append(text[a:a + length - n])
                    left.append(text[a - f:a])
                starts = np.array([s for _, s, _ in held])[piece] if len(piece) else np.zeros(0, np.int64)
                parts.append((ids[rows], at + starts, grams, low, high, warm, right, left))
                size += len(right)
                if size >= SUFFIXES:
                    yield from flush(parts)
                    parts, size = [], 0
        if size:
            yield from flush(parts)

    return run


def _front_coded(commons: list[int], sizes: list[int], tails: bytes) -> Iterator[tuple[int, bytes]]:
    at, text = 0, b""
    for common, size in zip(commons, sizes):
        text = text[:common] + tails[at:at + size]
        at += size
        yield common, text


def _merged(buckets: int, length: int, gram: int):
    """Step 3: merge the runs of each bucket; rows of removed ranges pass through."""

    def settle(rows: list[dict]) -> pa.RecordBatch:
        cursor = [0] * len(rows)
        order_run, order_at, commons, right = [], [], [], []
        for which, common, text in merge([_front_coded(r["commons"], r["sizes"], r["tails"]) for r in rows]):
            order_run.append(which)
            order_at.append(cursor[which])
            cursor[which] += 1
            commons.append(common)
            right.append(text)
        offsets = np.concatenate([[0], np.cumsum([len(r["docs"]) for r in rows])])
        at = offsets[np.array(order_run)] + np.array(order_at)

        def column(name):
            return np.concatenate([np.array(r[name], np.int64) for r in rows])[at]

        high = column("highs")
        befores = []
        for r in rows:
            ends = np.cumsum(r["highs"]).tolist()
            befores += [r["befores"][e - h:e] for e, h in zip(ends, r["highs"])]
        found = Suffixes(column("docs"), column("places"), column("lows"), high, right, [befores[i] for i in at.tolist()],
                         np.array(commons, np.int64))
        return _removed_rows(found, found.earlier(length, gram), length, buckets)

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            through = batch.filter(pa.array(numbers < 0))
            if through.num_rows:
                yield through.select(["bucket", "owners", "starts", "ends"])
            for row in batch.filter(pa.array(numbers >= 0)).select([0, *range(4, 12)]).to_pylist():
                if rows and rows[0]["bucket"] != row["bucket"]:
                    yield settle(rows).select(["bucket", "owners", "starts", "ends"])
                    rows = []
                rows.append(row)
        if rows:
            yield settle(rows).select(["bucket", "owners", "starts", "ends"])

    return run


def _kept(batches):
    for batch in batches:
        texts = as_bytes(batch, "text")
        starts, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        out = []
        for text, first, last in zip(texts, starts, ends):
            ranges: list[list[int]] = []
            for a, b in sorted(zip(first or [], last or [])):
                if ranges and a <= ranges[-1][1]:
                    ranges[-1][1] = max(ranges[-1][1], b)
                else:
                    ranges.append([a, b])
            kept, end = [], 0
            for a, b in ranges:
                kept.append(text[end:a])
                end = b
            kept = b"".join([*kept, text[end:]])
            out.append((len(text), len(text) - len(kept), ranges, kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             list_column([len(o[2]) for o in out], pa.StructArray.from_arrays(
                 [pa.array([r[0] for o in out for r in o[2]], pa.int32()), pa.array([r[1] for o in out for r in o[2]], pa.int32())],
                 ["start", "end"])),
             pa.array([o[3] for o in out], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed (byte ranges) and kept (bytes) of every row.

    ``docs`` has doc_id and text.  A null text is empty; texts shorter than
    ``length`` lose nothing.  Rows that repeat an id and text do not remove each
    other, since neither starts earlier; ranges of rows that share an id apply to
    all of them.  A null id counts as the smallest.
    """
    least = -(1 << 63)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    keyed = base.select(F.coalesce("doc_id", F.lit(least)).alias("ord"), "text")
    total = base.agg(F.sum(F.expr("octet_length(text)"))).first()[0] or 0
    buckets = max(1, int(total) // BUCKET_BYTES)
    tasks = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    known = F.col("kind") == _KNOWN
    grams = keyed.mapInArrow(_grams(length, gram), "g long, ord long, kind byte")
    repeated = staged(grams.repartition(tasks, F.when(known, F.col("ord")).otherwise(F.col("g"))).sortWithinPartitions(
        known, "g", "kind").mapInArrow(_repeated, "ord long, g long"))
    del grams
    release(docs.sparkSession)
    # At most HOT_GRAMS grams: no more of them can have their share of the rows.
    least_rows = max(HOT, repeated.count() // HOT_GRAMS)
    hot = repeated.groupBy(F.col("g").alias("h")).count().where(F.col("count") > least_rows).select("h")
    wanted = repeated.join(F.broadcast(hot), F.col("g") == F.col("h"), "left").groupBy(F.col("ord").alias("k")).agg(
        F.collect_list("g").alias("wanted"), F.collect_list("h").alias("hot"))
    runs = keyed.join(wanted, F.col("ord") == F.col("k")).select("ord", "text", "wanted", "hot").mapInArrow(
        _runs(buckets, length, gram), OUT)
    removed = runs.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _merged(buckets, length, gram), "bucket int, owners array<long>, starts array<int>, ends array<int>")
    ranges = staged(removed.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _by_document, "k long, starts array<int>, ends array<int>"))
    del wanted, runs, removed
    release(docs.sparkSession)
    return base.join(ranges, F.coalesce("doc_id", F.lit(least)) == F.col("k"), "left").select(
        "doc_id", "text", "starts", "ends").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept binary")
