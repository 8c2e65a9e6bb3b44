"""The backoff automaton against the recursion it stands for, and its awkward inputs."""

from collections import Counter
from math import log10
from zlib import crc32

import pytest

from navloom.llm import scoring


def tokens(text):
    return (text or "").encode().lower().split() + [scoring.END]


def by_hand(rows, order, prior):
    held = [i is not None and crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    contexts = Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            found = [scoring.BEGIN, *tokens(text)]
            for at in range(1, len(found)):
                for n in range(1, order + 1):
                    if at - n + 1 >= 0:
                        counts[tuple(found[at - n + 1:at + 1])] += 1
                        contexts[tuple(found[at - n + 1:at])] += 1
    total = contexts[()]
    known = sum(1 for g in counts if len(g) == 1)

    def chance(history, word):
        if not history:
            return (counts[word,] + 1) / (total + known + 1)
        lower = chance(history[1:], word)
        if not contexts[history]:
            return lower
        return (counts[*history, word] + prior * lower) / (contexts[history] + prior)

    out = []
    for (i, text), h in zip(rows, held):
        found = [scoring.BEGIN, *tokens(text)]
        score = base = 0.0
        for at in range(1, len(found)):
            score += log10(chance(tuple(found[max(0, at - order + 1):at]), found[at]))
            base += log10((counts[found[at],] + 1) / (total + 1 * (known + 1)))
        out.append((i, h, len(found) - 1, sum(1 for w in found[1:] if counts[w,]), total, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def rounded(frame):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in frame.collect()), key=repr)


@pytest.mark.parametrize("order,chunk,keys", [(1, 1 << 30, 1 << 30), (2, 20_000, 30_000), (3, 4_000, 9_000), (3, 1 << 30, 1 << 30)])
def test_scores(spark, docs, rows, order, chunk, keys):
    got = scoring.score_documents(docs, order, 1.5, chunk, keys)
    assert rounded(got) == by_hand([(r[0], r[1]) for r in rows], order, 1.5)


def test_the_query(spark, docs, rows, tmp_path):
    from navloom.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = rounded(QUERIES["op12_lm_scoring"](spark, str(tmp_path)))
    assert got == by_hand([(r[0], r[1]) for r in rows], scoring.ORDER, scoring.PRIOR)
    again = rounded(scoring.score_documents(docs.repartition(7, "source")))
    assert again == got  # dealt otherwise, scored alike


def test_probabilities_sum_to_one():
    taught = [b"a b a c", b"a b b", b"c a", b""]
    histories = [b"", b"a", b"a b", b"x"]
    words = [b"a", b"b", b"c", b"y"]
    # Each history alone and with each word behind it; the end is read last in all of them.
    asked = [b" ".join(filter(None, (h, w, last))) for h in histories for w in [b"", *words] for last in [b""]]
    grams = scoring.Grams(taught + asked, [True] * 4 + [False] * len(asked), 3)
    tokens_in = sum(len(t.split()) + 1 for t in taught)
    known = int((grams.counts[1] > 0).sum())
    model = scoring.Automaton(grams, grams.counts, tokens_in, known, 2.0)

    def mass(number, but_end):
        """Probability of a text's words, with or without its end."""
        start, size = int(grams.starts[number]), int(grams.sizes[number])
        return 10 ** model.read(start, size - but_end)

    for n, history in enumerate(histories):
        first = 4 + n * (1 + len(words))
        before = mass(first, 1)
        end = mass(first, 0) / before
        # An unseen word alone has the share of the unknown class.
        assert abs(end + sum(mass(first + 1 + i, 1) for i in range(len(words))) / before - 1) < 1e-9, history


def test_contexts_help_and_empty_tables(spark, empty):
    text = "one two three four five six seven"
    rows = [(i, text) for i in range(40)] + [(2, "seven six five four three two one"), (None, None), (None, "")]
    got = scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    ordered = [r.score for r in got if r.doc_id is not None and r.n_tokens == 8]
    assert max(ordered) - min(ordered) > 3  # the reversed words are far less likely
    assert all(r.score > r.base_score for r in got if r.doc_id == 5)
    assert scoring.score_documents(empty).collect() == []
    lone = scoring.score_documents(spark.createDataFrame([(3, "a b")], "doc_id long, text string")).first()
    assert crc32(b"3") % 7 == 2 or lone.train_tokens == 3
    unread = scoring.score_documents(spark.createDataFrame([(next(i for i in range(99) if crc32(str(i).encode()) % 7 == 2), "a b")],
                                                           "doc_id long, text string")).first()
    assert (unread.train_tokens, unread.n_known, unread.base_score, unread.score) == (0, 0, 0.0, 0.0)
