"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of every kind in one pass over a
text: at-signs, a plus before a digit, a digit before a dot or before another
digit, web schemes and identifier cues.  A deterministic parser of the kind then
walks left and right from the anchor, finds the boundaries and validates them.
Anchors inside a value that was parsed already are skipped, so the work is linear
in the text.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.common import SPANS, append_columns, span_column

BASE_KINDS = ["email", "ip", "card", "phone"]
EXTRA_KINDS = ["userinfo", "account"]
KINDS = BASE_KINDS + EXTRA_KINDS
SCHEMES = ["http://", "https://", "ftp://", "ssh://", "sftp://"]
CUES = ["iban", "IBAN", "account no", "Account no", "account number", "Account number", "passport no", "Passport no"]

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\"'<>")
_GAP = frozenset(" :.#=")


def automaton() -> ahocorasick.Automaton:
    """Every anchor with the kind of its parser."""
    found = ahocorasick.Automaton()
    digits = sorted(_DIGITS)
    anchors = {"@": "email"} | {"+" + d: "phone" for d in digits}
    for a in digits:
        for b in digits:
            anchors |= {f"{a}.{b}": "ip", a + b: "card", f"{a} {b}": "card", f"{a}-{b}": "card"}
    anchors |= dict.fromkeys(SCHEMES, "userinfo") | dict.fromkeys(CUES, "account")
    for text, kind in anchors.items():
        found.add_word(text, (kind, len(text)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of ``allowed`` characters from ``at``."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, low: int):
    """The address around the at-sign at ``at``, not before ``low``."""
    start = at
    while start > low and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        after = _run(text, end + 1, _LABEL)
        if after == end + 1:
            break
        labels, end = labels + 1, after
    return (start, end) if labels else None


def _quads(text: str, at: int, low: int):
    """Quadruples of the dotted number chain around ``at``, and the chain's end."""
    start = at
    while start > low and text[start - 1] in _DIGITS:
        start -= 1
    groups, end = [], start
    while True:
        after = _run(text, end, _DIGITS)
        groups.append((end, after))
        if after + 1 < len(text) and text[after] == "." and text[after + 1] in _DIGITS:
            end = after + 1
        else:
            break
    spans = []
    for i in range(0, len(groups) - 3, 4):
        parts = [text[a:b].lstrip("0") for a, b in groups[i:i + 4]]
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            spans.append((groups[i][0], groups[i + 3][1]))
    return spans, after


def _card(text: str, at: int):
    """The chain of digits, singly separated by blank or hyphen, from ``at``."""
    end, digits = at + 1, [text[at]]
    while end < len(text):
        step = 1 if text[end] in " -" else 0
        if end + step < len(text) and text[end + step] in _DIGITS:
            digits.append(text[end + step])
            end += step + 1
        else:
            break
    if not 13 <= len(digits) <= 19:
        return False, end
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0, end


def _phone(text: str, at: int):
    """End of the number whose plus is at ``at`` (0 if none), and whether it is valid."""
    last = _run(text, at + 2, _PHONE) - 1
    while last > at + 2 and text[last] not in _DIGITS:
        last -= 1
    if last < at + 3:
        return 0, False
    digits = sum(c in _DIGITS for c in text[at:last + 1])
    return last + 1, 9 <= digits <= 15


def _userinfo(text: str, at: int):
    """``user:password`` between a scheme that ends at ``at`` and its at-sign."""
    end = at
    while end < len(text) and text[end] not in _URL_END and text[end] not in "/@":
        end += 1
    if end < len(text) and text[end] == "@" and ":" in text[at:end]:
        return at, end
    return None


def _account(text: str, at: int):
    """A grouped identifier of 8 to 34 letters and digits after a cue that ends at ``at``."""
    start = _run(text, at, _GAP)
    if start == at or start - at > 4:
        return None
    end, size, numbers = start, 0, 0
    while end < len(text):
        step = 1 if size and text[end] in " -" else 0
        if end + step >= len(text) or text[end + step] not in _ALNUM or text[end + step].islower():
            break
        end += step
        numbers += text[end] in _DIGITS
        size, end = size + 1, end + 1
    return (start, end) if 8 <= size <= 34 and numbers * 2 >= size else None


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans of one text in code points, by kind as listed, then start."""
    done = dict.fromkeys(KINDS, 0)
    out: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    for last, (kind, size) in anchors.iter(text):
        at = last - size + 1
        if at < done[kind]:
            continue
        if kind == "email":
            span = _email(text, at, done[kind])
            if span:
                done[kind] = span[1]
                out[kind].append((kind, *span))
        elif kind == "ip":
            spans, done[kind] = _quads(text, at, done[kind])
            out[kind] += [(kind, *s) for s in spans]
        elif kind == "card":
            valid, done[kind] = _card(text, at)
            if valid:
                out[kind].append((kind, at, done[kind]))
        elif kind == "phone":
            end, valid = _phone(text, at)
            done[kind] = max(done[kind], end)
            if valid:
                out[kind].append((kind, at, end))
        else:
            span = (_userinfo if kind == "userinfo" else _account)(text, last + 1)
            if span and span[0] >= done[kind]:
                done[kind] = span[1]
                out[kind].append((kind, *span))
    return [s for k in KINDS for s in out[k]]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; where spans overlap, the first name stands for all."""
    out, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= end:
            out += [text[end:start], f"[{kind}]"]
        end = max(end, stop)
    return "".join(out) + text[end:]


def find_pii(docs: DataFrame, text_col: str = "text", redact: bool = False) -> DataFrame:
    """Append ``spans``, in code points, to every row; with ``redact`` replace them in the text.

    Null and empty texts have no spans and stay as they are.  Rows are judged one
    by one, so ties, repeated rows and null ids change nothing; an empty table
    gives an empty table; further columns pass through, but one named ``spans`` is
    replaced.
    """
    fields = [T.StructField("spans", SPANS)]
    if redact:
        fields.append(T.StructField("redacted_text", T.StringType()))

    def factory():
        anchors = automaton()

        def step(batch: pa.RecordBatch):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            rows = [find(t, anchors) if t else [] for t in texts]
            out = [span_column(rows)]
            if redact:
                out.append(pa.array([redacted(t, r) if r else t for t, r in zip(texts, rows)], pa.string()))
            return out

        return step

    found = append_columns(docs, fields, factory, text_col)
    if not redact:
        return found
    order = [c for c in docs.columns if c != "spans"]
    return found.select(*[F.col("redacted_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in order], "spans")


def joined_spans(kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined in stored order."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(
        f"array_join(transform(filter(spans, s -> s.kind in ({names})),"
        " s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
