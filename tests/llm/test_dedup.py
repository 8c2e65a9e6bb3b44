"""Duplicate operators against brute force, and their edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from navloom.llm import embeddings, grouping, simhash, suffixes
from navloom.llm.common import id_text
from navloom.llm.graph import components


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)]
    edges += [(5, 5), (500, 499), (500, 499)] + [(600, 600 + i) for i in range(1, 50)]
    frame = spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == classes(nodes, [e for e in edges if e[0] != e[1]])
    assert components(frame.where("false")).count() == 0


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {r[0]: fingerprint(r[1] or "") for r in rows if r[0] is not None and len(r[1] or "") < 10000}
    for r in got:
        if r.doc_id in prints:
            assert r.fp & (1 << 64) - 1 == prints[r.doc_id]
    known = {r.doc_id: r.fp & (1 << 64) - 1 for r in got if r.doc_id is not None}
    ids = sorted(known)
    linked = [(a, b) for a in ids for b in ids if a < b and (known[a] ^ known[b]).bit_count() <= 4]
    want = classes(ids, linked)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in left if i is not None) == sorted({c for c in want.values()}) and left.count(None) == 2


@pytest.mark.parametrize("block", [8, 512])
def test_links_reach_every_pair(spark, block):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(150)}
    for base in [centre, *list(values)[:30]]:
        for _ in range(12 if base != centre else 120):
            flips = rng.sample(range(64), rng.randint(1, 5))
            values.add(base ^ sum(1 << f for f in flips))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame(list(zip(signed, range(len(values)))), "fp long, rep long")
    edges = [(r.a, r.b) for r in simhash.link(nodes, block=block).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= 4 for a, b in edges) or classes(range(len(values)), edges)
    linked = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 4]
    assert classes(range(len(values)), edges) == classes(range(len(values)), linked)


def test_linked_pairs_stay_a_forest():
    found = grouping.Linked(50)
    found.LIMIT = 10
    rng, pairs = np.random.default_rng(1), []
    for _ in range(40):
        i, j = rng.integers(0, 50, 8), rng.integers(0, 50, 8)
        pairs += list(zip(i.tolist(), j.tolist()))
        found.add(i, j)
    a, b = found.edges()
    assert len(a) < 50 and classes(range(50), zip(a.tolist(), b.tolist())) == classes(range(50), pairs)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    for n in range(40):  # around the threshold, and scaled
        v = base[n] / np.linalg.norm(base[n])
        w = rng.standard_normal(24)
        w -= w @ v * v
        cosine = [0.94, 0.955, 0.97, 0.999][n % 4]
        u = cosine * v + np.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)
        rows.append((200 + n, [float(x) for x in u * 10 ** (n % 5)]))
    rows += [(300, rows[7][1]), (301, rows[7][1]), (302, [1e300] + [0.0] * 23), (303, [2e300] + [0.0] * 23), (304, [1.0, 0.0])]
    nothing = [(310, None), (311, []), (312, [0.0] * 24), (313, [float("nan")] + [1.0] * 23), (314, [None] + [1.0] * 23),
               (315, [float("inf")] + [1.0] * 23), (None, rows[7][1])]
    frame = spark.createDataFrame([(a, b, 1, 5) for a, b in rows + nothing], "vec_id long, embedding array<double>, label int, rep int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame, recall=0.9999).collect()}
    links = []
    for a, u in rows:
        for b, v in rows:
            if a < b and len(u) == len(v):
                x, y = np.array(u) / max(map(abs, u)), np.array(v) / max(map(abs, v))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links.append((a, b))
    component = classes([a for a, _ in rows], links)
    for a, _ in rows:
        assert got[a] == (sum(a in e for e in links), component[a]), a
    for a, _ in nothing[:-1]:
        assert got[a] == (0, a)
    assert got[None] == (0, None)
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


def test_embedding_blocks_and_recall(spark):
    """A hot bucket dealt into shards counts every pair once; recall at the threshold is high."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    hot = [(i, [float(x) for x in centre + 0.02 * rng.standard_normal(32)]) for i in range(90)]
    frame = spark.createDataFrame(hot, "vec_id long, embedding array<float>")
    got = embeddings.near_duplicates(frame, block=16).collect()
    assert {r.n_links for r in got} == {89} and {r.component_id for r in got} == {0}
    k, tables = embeddings.settings(100_000)
    near = embeddings.meeting_chance(np.sqrt(0.1))
    assert 1 - (1 - near ** k) ** tables >= 0.995


def test_embedding_recall_at_the_threshold(spark):
    """Production settings on 3,000 planted pairs just above 0.95: each lost link is one of the allowed few."""
    rng = np.random.default_rng(11)
    v = rng.standard_normal((3000, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    w = rng.standard_normal((3000, 64))
    w -= (w * v).sum(axis=1, keepdims=True) * v
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    cosine = rng.uniform(0.9501, 0.96, (3000, 1))
    u = cosine * v + np.sqrt(1 - cosine ** 2) * w
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(10_000 + i, x.tolist()) for i, x in enumerate(u)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    every = np.concatenate([v, u])
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(every @ every.T >= 0.95, 1))
    links = len(i)
    found = sum(n for n, _ in got.values()) / 2
    print(f"recall {found / links:.4f} of {links} links")
    assert links >= 3000 and found <= links and found / links >= 0.99
    alone = [k for k in range(3000) if got[10_000 + k] != (1, k)]
    assert len(alone) <= 0.01 * 3000


def removed(docs, length=100):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        marks = bytearray(len(text))
        for p in range(len(text) - length + 1):
            s = text[p:p + length]
            if s in seen:
                marks[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, m in zip(text, marks) if not m)
        spans = sum(1 for i, m in enumerate(marks) if m and (not i or not marks[i - 1]))
        out[doc_id] = (len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def compare_suffixes(frame, pairs, **options):
    got = suffixes.remove_repeats(frame, **options).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").alias("n_spans"), F.sha2("kept", 256).alias("h")).collect()
    want = removed(pairs, options.get("length", 100))
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.h) == want[r.doc_id], r.doc_id
    return got


def test_suffix_dedup(docs, rows):
    pairs = [(r[0], (r[1] or "").encode()) for r in rows[:-3]]
    got = compare_suffixes(id_text(docs).where("doc_id is not null"), pairs)
    assert len(got) == len(pairs) + 1 and sum(r.n_removed for r in got) > 1000


def test_suffix_dedup_small_strings(spark, monkeypatch):
    """Short strings over two letters: every tie, overlap and self-repeat; small pieces and runs."""
    monkeypatch.setattr(suffixes, "SEGMENT", 60)
    monkeypatch.setattr(suffixes, "SUFFIXES", 30)
    rng = random.Random(6)
    texts = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 90)))) for i in range(40)]
    texts += [(100, "a" * 150), (101, "ab" * 70), (102, texts[3][1] * 3), (103, "é" * 50)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    compare_suffixes(frame, [(i, t.encode()) for i, t in texts], length=16, gram=6)


def test_suffix_dedup_hot_line(spark, monkeypatch):
    """A line shorter than a string between different neighbours, hot, with and without equal surroundings."""
    monkeypatch.setattr(suffixes, "HOT", 10)
    monkeypatch.setattr(suffixes, "SUFFIXES", 40)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffixes, "REMEMBERED", 3)
    rng = random.Random(12)
    line = "".join(rng.choice("abcdefgh ") for _ in range(70))
    around = ["".join(rng.choice("xyz ") for _ in range(120)) for _ in range(60)]
    texts = [(i, around[i] + line + around[(i * 7) % 60 if i % 3 else 5]) for i in range(60)]
    texts += [(100 + i, around[i][-40 - i:] + line + around[9]) for i in range(20)] + [(200, line * 4), (201, line)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = compare_suffixes(frame, [(i, t.encode()) for i, t in texts])
    assert sum(r.n_removed > 0 for r in got) > 20


def test_hot_stretches_keep_their_distances():
    """Cut stretches cover the same distances, and strings alike at a distance share its window."""
    row, near, far = np.array([0, 1, 1]), np.array([3, 0, 30]), np.array([29, 7, 60])
    r, n, f = suffixes.cut_by_step(row, near, far, np.array([False, True]))
    assert [(a, b, c) for a, b, c in zip(r, n, f) if a == 0] == [(0, 3, 29)]
    assert sorted(d for a, b, c in zip(r, n, f) if a == 1 for d in range(b, c + 1)) == [*range(8), *range(30, 61)]
    assert all(b // suffixes.STEP == c // suffixes.STEP for a, b, c in zip(r, n, f) if a == 1)
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 123) for _ in range(100))
    for d in range(61):
        windows = {suffixes.shared_window(bytes(rng.randrange(256) for _ in range(60 - d)) + text[:d],
                                          text[d:] + bytes(rng.randrange(256) for _ in range(d)), d, 100, 40) for _ in range(5)}
        assert len(windows) == 1 and windows.pop() in text


def test_suffix_dedup_edges(spark, empty):
    assert suffixes.remove_repeats(id_text(empty)).count() == 0
    text = "x" * 40 + "".join(chr(65 + i % 26) for i in range(150))
    frame = spark.createDataFrame([(5, text), (5, text), (None, text), (6, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed) for r in suffixes.remove_repeats(frame).collect()}
    # The row without an id counts as the smallest; repeated ids do not remove each other, but their ranges are shared.
    first = dict((a, b) for a, b in got if a is None)[None]
    assert (6, 0) in got and (5, len(text)) in got and first < len(text)


def test_loser_tree():
    rng = random.Random(8)
    for _ in range(200):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 8)))
                for _ in range(rng.randint(1, 7))]

        def coded(run):
            before = b""
            for text in run:
                yield suffixes.shared(before, text, 0), text
                before = text

        out = list(suffixes.merge([coded(r) for r in runs]))
        assert [t for _, _, t in out] == sorted(t for r in runs for t in r)
        before = None
        for _, common, text in out:
            if before is not None:
                assert common == suffixes.shared(before, text, 0)
            before = text
