"""Tokenizer alignment against a plain retelling with the tokenizers' own libraries."""

import hashlib
from collections import Counter

import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from navloom.llm import alignment

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
ODD = ["a  b", " lead", "trail ", "tab\tbed", "one\ntwo\n\nthree\n", "line\n next", "w▁x", "<s> a</s> <|endoftext|> <0x41>",
       "① ½ é ﬁ", "　wide　", "a\0b", "naïve 😀 text​join", "x" * 3000, " ", "\n", "don't we'll 1234 12.50 !? --", " nbsp"]


def plain_bytes(token):
    """Byte-level characters back to bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    table = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return bytes(table[c] for c in token)


def by_hand(rows):
    first, second = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    found = []
    for _, text in rows:
        if not text:
            found.append(None)
            continue
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        raw_a = [plain_bytes(first.id_to_token(i)) for i in a]
        raw_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                 else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            found.append(None)
            continue
        spans = []
        for raw in (raw_a, raw_b):
            at, out = 0, []
            for piece in raw:
                out.append((at, at + len(piece)))
                at += len(piece)
            spans.append(out)
        links, low = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][low][1] <= s:
                low += 1
            j = low
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for s, e in zip([0, *cuts], cuts):
            groups.append(",".join(str(i) for i, p in zip(a, spans[0]) if s <= p[0] < e) + "|"
                          + ",".join(str(i) for i, p in zip(b, spans[1]) if s <= p[0] < e)) if len(a) < 4000 else groups.append("")
        found.append((len(a), len(b), len(cuts), links, ";".join(groups) if len(a) < 4000 else None))
    counts = Counter(p for f in found if f for p in set(f[3]))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for (i, _), f in zip(rows, found):
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[p] == top[p[0]] for p in f[3])
        digest = hashlib.sha256(f[4].encode()).hexdigest() if f[4] is not None else None
        out.append((i, f[0], f[1], f[2], len(f[3]), best, sum(counts[p] for p in f[3]), digest))
    return sorted(out, key=repr)


def shown(frame, want):
    long = {(w[0], w[1]) for w in want if w[7] is None}
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    None if (r.doc_id, r.n_a) in long else r.groups_sha256) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("chunk", [1 << 30, 3000])
def test_alignment(spark, rows, chunk):
    mine = [(r[0], r[1]) for r in rows] + [(900 + i, t) for i, t in enumerate(ODD)] + [(950, ODD[0]), (951, ODD[0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in mine], "doc_id long, text string, n_a int, digest string").repartition(5)
    want = by_hand(mine)
    assert shown(alignment.align_documents(frame, chunk_bytes=chunk), want) == want
    assert sum(w[1] == 0 for w in want) >= 4  # null, empty, and a text whose bytes change


def test_the_query_and_groups(spark, docs, rows, empty, tmp_path):
    from navloom.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = by_hand([(r[0], r[1]) for r in rows])
    got = QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path))
    assert shown(got, want) == want
    for r in alignment.align_documents(docs, with_groups=True).collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
    assert alignment.align_documents(empty).collect() == []
    nothing = alignment.align_documents(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect()
    assert sorted((r.n_a, r.groups_sha256) for r in nothing) == [(0, ""), (0, "")]


def test_segments_align_as_whole_texts(rows):
    aligner = alignment.Aligner(A, B)
    assert aligner.cuts
    for text in [r[1] for r in rows if r[1]] + ODD:
        cut = aligner.text(text)
        whole = aligner._whole(" " + text, True)
        assert (cut is None) == (whole is None)
        if cut:
            assert cut[:4] == whole[:4] and cut[4].tobytes() == whole[4], text[:50]
