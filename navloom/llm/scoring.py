"""Language-model scores by a weighted backoff automaton.

The states of the automaton are the training n-grams that can be contexts; an arc
reads one token at the log-probability of the longest n-gram it completes, and a
failure arc drops the oldest word of the context at the weight of backing off.  One
traversal from left to right carries the state and sums the weights.

    P(w | h) = (c(hw) + PRIOR * P(w | h')) / (c(h) + PRIOR)
    P(w)     = (c(w) + 1) / (N + V + 1)

The automaton grows with the corpus, so no task holds it whole.  Texts are dealt into
chunks of bounded size.  A chunk sends its distinct n-grams, sorted by key, to key
ranges; a range adds up the counts of all chunks and sends every chunk the totals of
its n-grams in the order they came.  From these the chunk builds the part of the
automaton that its own texts can reach.  Words are compared as text; longer n-grams
by 64-bit keys made of their words' hashes.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from navloom.llm.common import staged

# Longest n-gram, in tokens.
ORDER = 2
# Pseudo-count of the shorter context's distribution.
PRIOR = 4.0
# Text bytes of a chunk, and those whose n-grams make up one key range.
CHUNK_BYTES = 4 << 20
RANGE_BYTES = 8 << 20

END, BEGIN = b"\n", b" "  # no word holds white space


def held_out() -> Column:
    """Rows whose id the contract keeps out of training; null ids are learned from."""
    return F.expr("coalesce(crc32(cast(doc_id as string)) % 7 = 2, false)")


class _Numbers(dict):
    """Numbers the words in the order they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Grams:
    """The n-grams of some texts.

    ``words`` are sorted by key, the last number is the begin mark.  ``at`` holds the
    word and ``places[k]`` the gram of k words that ends at every place; ``keys[k]``, ``prefix[k]``, ``suffix[k]`` and ``last[k]``
    describe the distinct grams of k words by key: the gram before their last word,
    the gram without their first, and their last word.
    """

    def __init__(self, texts: list[bytes], learned: list[bool], order: int):
        numbers = _Numbers({END: 0})
        at, sizes = array("q"), []
        for text in texts:
            found = text.lower().split()
            sizes.append(len(found) + 2)
            at.append(-1)
            at.extend(map(numbers.__getitem__, found))
            at.append(0)
        words = list(numbers)
        hashes = np.array([xxh64_intdigest(w, 0) for w in words], np.uint64)
        ranks = np.argsort(hashes, kind="stable")
        if len(ranks) > 1 and (np.diff(hashes[ranks]) == 0).any():
            ranks = np.array(sorted(range(len(words)), key=lambda i: (hashes[i], words[i])))
        self.words = [words[i] for i in ranks]
        self.width = len(words) + 1
        place = np.empty(self.width, np.int64)
        place[ranks], place[-1] = np.arange(len(words)), len(words)
        self.at = place[np.frombuffer(at, np.int64)] if len(at) else np.empty(0, np.int64)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        step = np.arange(len(self.at)) - np.repeat(self.starts, self.sizes)
        taught = np.repeat(np.array(learned, bool), self.sizes)
        keys = np.append(hashes[ranks], np.uint64(xxh64_intdigest(BEGIN, 0)))
        self.keys, self.prefix, self.suffix, self.last = {1: keys[:-1]}, {}, {}, {}
        self.counts = {1: np.bincount(self.at[taught & (step > 0)], minlength=self.width - 1)}
        gram, key = self.at, keys
        self.places = {1: self.at}
        for k in range(2, order + 1):
            places = np.flatnonzero(step >= k - 1)
            code, inverse = np.unique(gram[places - 1] * self.width + self.at[places], return_inverse=True)
            prefix, last = code // self.width, code % self.width
            with np.errstate(over="ignore"):
                mixed = (key[prefix] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys[last] + np.uint64(k))
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
            by = np.argsort(mixed, kind="stable")
            back = np.empty(len(by), np.int64)
            back[by] = np.arange(len(by))
            self.keys[k], self.prefix[k], self.last[k] = mixed[by], prefix[by], last[by]
            here = back[inverse]
            # All places of a gram have the same suffix, so any of them may write it.
            self.suffix[k] = last[by] if k == 2 else np.empty(len(by), np.int64)
            if k > 2:
                self.suffix[k][here] = gram[places]
            self.counts[k] = np.bincount(here[taught[places]], minlength=len(by))
            fresh = np.full(len(self.at), -1, np.int64)
            fresh[places] = here
            gram, key = fresh, self.keys[k]
            self.places[k] = fresh

    def ranges(self, bits: int):
        """(range number, keys, counts) of every key range that holds a gram; numbers grow with length and key."""
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
        for k, keys in self.keys.items():
            cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
            for number in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[number], cuts[number + 1]
                sent = BEGIN.join(self.words[a:b]) if k == 1 else _packed(keys[a:b])
                yield (k << 40) + number, sent, self.counts[k][a:b].tobytes()


def _packed(keys: np.ndarray) -> bytes:
    """Steps between sorted keys, byte plane after byte plane: the high planes are all but zero and compress away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(sent: bytes) -> np.ndarray:
    steps = np.frombuffer(sent, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64)


class Automaton:
    """The arcs that the texts of some ``Grams`` can use, from their totals in the corpus.

    A state is a learned gram shorter than the order, state 0 words long the empty
    context.  Where a text is at a place in a state of n words, the arc that reads its
    next word is the gram of n + 1 words that ends there: ``arcs[n]`` holds its weight by
    place, not a number where the gram was not learned, and ``drops[n]`` the weight of
    the failure arc of the state of n words that ends at a place.
    """

    def __init__(self, grams: Grams, totals: dict[int, np.ndarray], tokens: int, known: int, prior: float):
        self.order = max(totals)
        self.chance = {1: (totals[1] + 1) / (tokens + known + 1)}
        begin = totals[1][grams.words.index(END)] if grams.words else 0
        # Totals by length; the begin mark is the last gram of length one.
        context = {1: np.append(totals[1], begin)} | {k: totals[k] for k in totals if k > 1}
        for k in range(2, self.order + 1):
            lower = self.chance[k - 1][grams.suffix[k]]
            self.chance[k] = (totals[k] + prior * lower) / (context[k - 1][grams.prefix[k]] + prior)
        self.learned = (context[1][grams.at] > 0).tolist()
        self.arcs, self.drops = [], [[]]
        for k in range(1, self.order + 1):
            # The begin mark is read by no arc, and neither is a gram that would reach over it.
            weight = np.log10(np.append(self.chance[k], [1.0] * (len(context[k]) - len(self.chance[k]))))
            place = grams.places[k]
            by_place = np.where(place >= 0, weight[place], np.nan) if len(weight) else np.full(len(place), np.nan)
            if k > 1 and len(weight):
                by_place[(place >= 0) & (totals[k][place] == 0)] = np.nan
            self.arcs.append(by_place.tolist())
            if k < self.order:
                drop = np.log10(prior / (context[k] + prior))
                self.drops.append((drop[place] if len(drop) else np.zeros(len(place))).tolist())

    def read(self, start: int, size: int) -> float:
        """Log-probability of the text that begins at ``start``: one way from left to right, state by state."""
        arcs, drops, learned, longest = self.arcs, self.drops, self.learned, self.order - 1
        total, state = 0.0, min(1, longest) if learned[start] else 0
        for place in range(start + 1, start + size):
            weight = arcs[state][place]
            while weight != weight:
                total += drops[state][place - 1]
                state -= 1
                weight = arcs[state][place]
            total += weight
            if state or learned[place]:
                if state < longest:
                    state += 1
        return total


SENT = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
TOTALS = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("totals", pa.binary()), ("known", pa.int64()), ("tokens", pa.int64())])
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _grams(chunk: pa.Table, order: int) -> Grams:
    texts = [t or b"" for t in chunk.column("text").to_pylist()]
    return Grams(texts, [not h for h in chunk.column("held_out").to_pylist()], order)


def _send(order: int, bits: int):
    def run(chunk: pa.Table) -> pa.Table:
        name = chunk.column("chunk")[0].as_py()
        rows = [(number, name, keys, counts) for number, keys, counts in _grams(chunk, order).ranges(bits)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), SENT.types)], schema=SENT)

    return run


def _add_up(part: pa.Table) -> pa.Table:
    """Totals of a key range over all chunks, for every chunk in its own order."""
    number = part.column("range")[0].as_py()
    sent, counts = part.column("keys").to_pylist(), [np.frombuffer(c, np.int64) for c in part.column("counts").to_pylist()]
    if number >> 40 == 1:
        names = pa.array([w for s in sent for w in s.split(BEGIN)], pa.binary()).dictionary_encode()
        place = names.indices.to_numpy()
    else:
        place = np.unique(np.concatenate([_unpacked(s) for s in sent]), return_inverse=True)[1]
    sums = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
    cuts = np.cumsum([len(c) for c in counts])[:-1]
    totals = [t.tobytes() for t in np.split(sums[place], cuts)]
    one = number >> 40 == 1
    return pa.table([
        pa.array(part.column("chunk").to_pylist() + [None], pa.int64()), pa.array([number] * (len(totals) + 1), pa.int64()),
        pa.array(totals + [None], pa.binary()),
        pa.array([None] * len(totals) + [int((sums > 0).sum()) if one else 0], pa.int64()),
        pa.array([None] * len(totals) + [int(sums.sum()) if one else 0], pa.int64())], schema=TOTALS)


def _score(order: int, prior: float, tokens: int, known: int):
    def run(sums: pa.Table, chunk: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return SCORES.empty_table()
        grams = _grams(chunk, order)
        totals = {k: [] for k in grams.keys}
        for row in sums.select(["range", "totals"]).sort_by("range").to_pylist():
            totals[row["range"] >> 40].append(np.frombuffer(row["totals"], np.int64))
        totals = {k: np.concatenate([np.empty(0, np.int64), *v]) for k, v in totals.items()}
        if any(len(totals[k]) != len(grams.keys[k]) for k in totals):
            raise ValueError("the texts changed between counting and scoring")
        model = Automaton(grams, totals, tokens, known, prior)
        plain, seen = np.log10(model.chance[1]), totals[1] > 0
        scores, base, found = [], [], []
        for start, size in zip(grams.starts.tolist(), grams.sizes.tolist()):
            words = grams.at[start + 1:start + size]
            scores.append(model.read(start, size))
            base.append(float(plain[words].sum()))
            found.append(int(seen[words].sum()))
        return pa.table([
            chunk.column("doc_id").combine_chunks(), chunk.column("held_out").combine_chunks(), pa.array(grams.sizes - 1),
            pa.array(found, pa.int64()), pa.array([tokens] * len(scores), pa.int64()), pa.array(base, pa.float64()),
            pa.array(scores, pa.float64())], schema=SCORES)

    return run


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def score_documents(docs: DataFrame, order: int = ORDER, prior: float = PRIOR, chunk_bytes: int = CHUNK_BYTES,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are the words and one end.  Null and empty texts have the end alone.  Rows
    are scored one by one, so repeated rows repeat and all of them are learned from;
    rows with a null id are learned from.  With nothing to learn from all
    probabilities are one.  Only doc_id and text are read, other columns do not come
    back; an empty table gives an empty one.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, bits = size // chunk_bytes + 1, int(size // range_bytes).bit_length()
    dealt = named.select("doc_id", "text", held_out().alias("held_out"), F.expr(f"pmod(xxhash64(doc_id, text), {chunks})").alias("chunk"))
    sent = dealt.groupBy("chunk").applyInArrow(_send(order, bits), _ddl(SENT))
    totals = staged(sent.groupBy("range").applyInArrow(_add_up, _ddl(TOTALS)))
    row = totals.where("chunk is null").agg(F.sum("known"), F.sum("tokens")).first()
    sums = totals.where("chunk is not null").select("chunk", "range", "totals")
    return sums.groupBy("chunk").cogroup(dealt.groupBy("chunk")).applyInArrow(
        _score(order, prior, row[1] or 0, row[0] or 0), _ddl(SCORES))
