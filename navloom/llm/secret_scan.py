"""Secret scan: fixed rules and character Markov models, in DataFrame functions only.

The rules find assigned values, access keys and long hexadecimal strings.  Their
values are the labelled samples of random strings; the ordinary tokens of all
documents are the labelled samples of identifiers.  Two first-order character models
are counted from them in one aggregate, and tokens whose log-likelihood ratio favours the
random model are further spans.
"""

from __future__ import annotations

import json
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.text import match_spans

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "random"]
# The patterns of the rules.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Tokens of the models.
TOKEN_CHARS = r"[A-Za-z0-9+/_=-]"
SAMPLE_TOKEN = TOKEN_CHARS + "{8,}"
MIN_LENGTH = 20
# Log-likelihood ratio, in nats, from which a token counts as random.
MIN_RATIO = 12.0
# Weight of a character's own frequency beside the counts of its pair.
BACKOFF = 10.0
# Codes of the model alphabet: plus to z.
LOW, SIZE = 43, 80


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(
        s.start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
        s.stop.alias("end"), s.found.alias("found")))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,found:string>>")


def base_spans(text: Column) -> Column:
    """Spans of the rules by start, then kind; ``text`` is not null.

    A cheap look at the text comes before each pattern.  The quantifiers of access
    and hex carry the least length, which changes no match: a shorter run of the
    same characters has no longer match inside.
    """
    lower = F.lower(text)
    keyed = F.lit(False)
    for word in KEYWORDS:
        keyed = keyed | lower.contains(word)
    assign = F.filter(match_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s.found, ASSIGN, 2)) >= 8)
    return F.array_sort(F.concat(
        F.when(keyed, _spans("assign", assign)).otherwise(_none()),
        F.when(text.contains("AKIA"), _spans("access", match_spans(text, ACCESS))).otherwise(_none()),
        F.when(text.rlike(HEX), _spans("hex", match_spans(text, HEX))).otherwise(_none())))


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c) - LOW)


def _pairs(token: Column) -> Column:
    """Numbers of the character pairs of a token over the model alphabet."""
    codes = _codes(token)
    valid = F.filter(codes, lambda c: (c >= 0) & (c < SIZE))
    return F.element_at(F.transform(F.array(valid), lambda v: F.zip_with(
        F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))),
        lambda a, b: a * SIZE + b)), 1)


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of all character pairs.

    Every document gives the values of its rule spans and all its ordinary tokens,
    rule spans excepted.  An empty table, or one
    without secrets, gives a flat model.  At most two counts for every pair of the
    alphabet reach the driver.
    """
    found = docs.where("text is not null").select("text", base_spans(F.col("text")).alias("base"))
    tokens = F.filter(F.regexp_extract_all("text", F.lit(SAMPLE_TOKEN), F.lit(0)),
                      lambda t: ~F.exists("base", lambda s: F.contains(s.found, t)))
    secrets = F.transform("base", lambda s: F.struct(
        F.lit(1).alias("random"),
        F.when(s.kind == "assign", F.regexp_extract(s.found, ASSIGN, 2)).otherwise(s.found).alias("token")))
    ordinary = F.transform(tokens, lambda t: F.struct(F.lit(0).alias("random"), t.alias("token")))
    samples = found.select(F.explode(F.concat(secrets, ordinary)).alias("s")).select("s.random", "s.token")
    # All characters of both kinds of samples lie in the model alphabet.
    places = samples.select("random", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"))
    rows = places.groupBy("random", F.expr("substring(token, i, 2)").alias("pair")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = [[0] * (SIZE * SIZE), [0] * (SIZE * SIZE)]
    for r in rows:
        first, second = r["pair"]
        counts[r["random"]][(ord(first) - LOW) * SIZE + ord(second) - LOW] += r["n"]
    # The scored tokens are themselves among the ordinary samples; none vouches for itself.
    ordinary, random = _log_model(counts[0], own=1), _log_model(counts[1])
    return [round(b - a, 4) for a, b in zip(ordinary, random)]


def _log_model(counts: list[int], own: int = 0) -> list[float]:
    """Log probability of each second character given the first, without ``own`` of the pair's counts.

    A first character seen seldom falls back on how frequent the second one is, so
    that characters strange to a model count against it anywhere.
    """
    second = [sum(counts[b::SIZE]) for b in range(SIZE)]
    total = sum(second)
    first = [sum(counts[a * SIZE:(a + 1) * SIZE]) for a in range(SIZE)]
    out = []
    for p, n in enumerate(counts):
        less = min(own, n)
        share = (second[p % SIZE] - less + 0.5) / (total - less + 0.5 * SIZE)
        out.append(log((n - less + BACKOFF * share) / (first[p // SIZE] - less + BACKOFF)))
    return out


def find_secrets(docs: DataFrame, ratios: list[float] | None = None, min_length: int = MIN_LENGTH,
                 min_ratio: float = MIN_RATIO) -> DataFrame:
    """doc_id and ``spans`` (start, rank, kind, end, found) by start, then kind.

    Null and empty texts have no spans.  Rows are judged one by one: repeated rows
    and null ids change nothing, an empty table gives an empty table.  Model spans
    never overlap a rule span.
    """
    ratios = train(docs) if ratios is None else ratios
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))
    token = f"{TOKEN_CHARS}{{{min_length},}}"

    def ratio(value: Column) -> Column:
        return F.aggregate(_pairs(value), F.lit(0.0), lambda total, pair: total + table[pair])

    def is_random(value: Column) -> Column:
        return ratio(value) >= min_ratio

    tokens = F.regexp_extract_all(text, F.lit(token), F.lit(0))
    extra = F.filter(match_spans(text, token), lambda s: is_random(s.found))
    found = docs.select("doc_id", base_spans(text).alias("base"), F.when(
        F.exists(tokens, is_random), _spans("random", extra)).otherwise(_none()).alias("extra"))
    free = F.filter("extra", lambda s: ~F.exists("base", lambda b: (b.start < s.end) & (s.start < b.end)))
    return found.select("doc_id", F.array_sort(F.concat("base", free)).alias("spans"))


def joined(kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined in order."""
    return F.array_join(F.transform(F.filter("spans", lambda s: s.kind.isin(*kinds)), lambda s: F.concat_ws(
        ":", s.kind, s.start, s.end)), ",")
