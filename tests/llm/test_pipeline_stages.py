"""The pipeline's stages and its run, by a plain retelling of each."""

import random
import re
import zlib

import corpus_pipeline
from navloom.llm import packing, pii, quality, simhash
from tests.llm.conftest import SCHEMA, words
from tests.llm.test_dedup import classes, fingerprint

# Names that the operators use for their own columns.
CLASHING = ("doc_id long, text string, spans string, items int, n_words int, hit_words string, score double, fp string, "
            "h int, turn int, row string, redacted_text string, _id int, _turn int, _c int, component_id int, label int, chunk int")


def corpus():
    """Good prose and junk with labels, near copies, repeated ids, test passages and personal data."""
    rng = random.Random(11)
    passage = words(rng, "en", 40)
    rows, labels = [], []
    for i in range(160):
        good = i % 4 != 3
        text = words(rng, "en", 60) + "." if good else " ".join("$%#@!~"[rng.randrange(6)] * 3 + str(rng.randrange(99)) for _ in range(50))
        if i % 10 == 1:
            text += " " + passage
        if i % 10 == 2:
            text += f" mail me at user{i}@ex-ample.org or +49 (30) 1234-567{i % 10}"
        rows.append((i, text))
        labels.append((i, int(good), 0))
    rows += [(200 + i, rows[i][1]) for i in range(0, 60, 5)]  # copies
    near = words(rng, "fr", 200)
    rows += [(300 + i, near + " " + "x" * i) for i in range(4)]  # near copies
    rows += [(7, "another text under an id that is there " + words(rng, "en", 50)), rows[5], (None, words(rng, "en", 30)), (400, None), (401, "")]
    return rows, labels, passage


def kept_by_hand(rows, weights, passage):
    """Ids and texts after quality, near-dedup, decontamination and redaction."""
    def score(text):
        index, value = quality.features((text or "").encode())
        return 1 / (1 + 2.718281828459045 ** -(sum(weights[index].astype("float32").tolist()) * value + float(weights[-1])))

    left = [r for r in rows if score(r[1]) >= 0.5]
    prints = [fingerprint(t or "") for _, t in left]
    named = [n for n, r in enumerate(left) if r[0] is not None]
    groups = classes(sorted(set(prints[n] for n in named)), [
        (prints[a], prints[b]) for a in named for b in named if prints[a] < prints[b] and (prints[a] ^ prints[b]).bit_count() <= 4])
    best = {}
    for n in named:
        group = groups[prints[n]]
        # Ids that repeat with texts of one group do not occur here, so the id decides.
        if group not in best or left[n][0] < left[best[group]][0]:
            best[group] = n
    left = [left[n] for n in sorted(best.values())] + [r for r in left if r[0] is None]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    test = split(passage)
    windows = {tuple(test[i:i + 13]) for i in range(len(test) - 12)}

    def contaminated(text):
        found = split(text)
        hit = {j for i in range(len(found) - 12) if tuple(found[i:i + 13]) in windows for j in range(i, i + 13)}
        return bool(hit) and 20 * len(hit) >= len(found)

    anchors = pii.automaton()
    clean = [r for r in left if not contaminated(r[1])]
    return [(i, pii.redacted(t, pii.find(t, anchors)) if t else t) for i, t in clean], left


def test_run_against_brute_force(spark, tmp_path):
    rows, labels, passage = corpus()
    sf = str(tmp_path)
    wide = [(i, t, "own", 1, 2, "h", 0.25, "f", 3, 4, "r", "q", 5, 6, 7, 8, 9, 10) for i, t in rows]
    docs = spark.createDataFrame(wide, CLASHING).repartition(3)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    weights = quality.train(spark.createDataFrame(rows, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    want, before = kept_by_hand(rows, weights, passage)
    # Every stage has something to do.
    assert len(before) < len(rows) and len(want) < len(before) and any("[email]" in (t or "") for _, t in want)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == [f.split()[0] for f in CLASHING.split(", ")], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = docs.collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, want))
    assert all(tuple(r)[2:] == wide[0][2:] for r in got)  # the rows' own columns, untouched
    packed = corpus_pipeline.run(spark, sf).collect()
    encoder = packing.CachedEncoder(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    crcs = sorted(zlib.crc32(encoder.ids(t or "") + b"\2\0\0\0") for _, t in want)
    assert sorted(r.ids_crc32 for r in packed) == crcs  # no text is longer than a sequence
    for number in {r.sequence_id for r in packed}:
        places = sorted((r.offset, r.length) for r in packed if r.sequence_id == number)
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 1024


def test_a_repeated_id_loses_no_text(spark):
    x, y = "one two three four five six", "alpha beta gamma delta epsilon"
    rows = [(3, x), (5, x), (5, y), (9, y), (9, y), (None, x)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(3, x), (5, y), (None, x)], key=repr)


def test_the_model_does_not_depend_on_the_partitions(spark):
    rows, labels, _ = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    first = quality.train(docs.repartition(2), marks)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        second = quality.train(docs.repartition(9), marks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert (first == second).all() and (first != 0).any()
    some = quality.train(docs, marks, max_rows=20)
    assert (some != first).any()


def test_stages_on_an_empty_table(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    empty = spark.read.parquet(f"{sf}/documents.parquet")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0
    assert quality.score(empty, quality.train(empty, spark.read.parquet(f"{sf}/labels.parquet"))).count() == 0
