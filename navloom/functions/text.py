"""Text column helpers, all as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navloom import fixed_values as fixed

_HAN = r"一-鿿"
# Matches whose offsets are summed in one array; more are summed in chunks.
FEW_MATCHES = 32


def strip_tags(html: Column) -> Column:
    """Plain text of markup: tags out, entities decoded, spaces collapsed."""
    text = F.regexp_replace(html, r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse(text)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def compact(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", "")


def normalize_notice(text: Column) -> Column:
    """Rejoin Han characters and digit punctuation that extraction split."""
    joined = F.regexp_replace(collapse(text), rf"(?U)(?<=[{_HAN}])\s+(?=[{_HAN}])", "")
    return F.regexp_replace(joined, r"(?U)(?<=\d)\s*([,.])\s*(?=\d)", "$1")


def normalize_name(text: Column) -> Column:
    """Upper case, keeping only A-Z, 0-9 and Han characters."""
    return F.regexp_replace(F.upper(text), rf"[^A-Z0-9{_HAN}]+", "")


def normalize_instrument(text: Column) -> Column:
    repaired = F.replace(F.upper(text), F.lit("V AN"), F.lit("VAN"))
    return F.regexp_replace(repaired, rf"[^{_HAN}A-Z0-9]+", "")


def has_any(text: Column, words) -> Column:
    """True when ``text`` contains one of ``words``; empty words are ignored."""
    found = F.lit(False)
    for word in words:
        if word:
            found = found | text.contains(word)
    return found


def product_structure(text: Column, default: Column) -> Column:
    """Inverse before leveraged before volatility, else the catalog value."""
    return bound(compact(text), lambda squeezed: (
        F.when(squeezed.rlike(fixed.STRUCTURE_INVERSE), "inverse")
        .when(squeezed.rlike(fixed.STRUCTURE_LEVERAGED), "leveraged")
        .when(squeezed.rlike(fixed.STRUCTURE_VOLATILITY), "volatility")
        .otherwise(default)
    ))


def share_aggregation(text: Column) -> Column:
    squeezed = compact(text)
    return F.when(squeezed.rlike(fixed.SHARES_COMBINED), "A/C combined").when(
        squeezed.rlike(fixed.SHARES_SEPARATE), "A/C separate"
    )


def fund_identity(code: Column, name: Column, fund_type: Column) -> Column:
    """Hash that changes when a fund is renamed or retyped."""
    return F.sha2(F.concat_ws("\u0000", code, name, fund_type), 256)


def match_spans(text: Column, pattern: str) -> Column:
    """All matches as ``array<struct<start, stop, found>>``, 0-based offsets.

    ``split`` gives the pieces between the matches, so the offsets are running
    sums of lengths and no Python is needed.  Appending to one array costs its length
    each time, so beyond ``FEW_MATCHES`` sums run over chunks of the matches and
    then within each chunk; a text with very many matches stays affordable.
    """
    empty = F.array().cast("array<struct<start:int,stop:int,found:string>>")

    def spans_from(chunk: Column, at: Column) -> Column:
        return F.aggregate(
            chunk, F.struct(at.alias("at"), empty.alias("spans")),
            lambda acc, item: F.struct(
                (acc.at + item.gap + F.length(item.hit)).alias("at"),
                F.array_append(acc.spans, F.struct(
                    (acc.at + item.gap).alias("start"), (acc.at + item.gap + F.length(item.hit)).alias("stop"),
                    item.hit.alias("found"))).alias("spans")),
            lambda acc: acc.spans)

    def total(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda n, item: n + item.gap + F.length(item.hit))

    def chunks(all_items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_items))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(all_items), F.lit(1)), F.greatest(width, F.lit(1))), lambda i: F.slice(all_items, i, width))

    def chunk_starts(parts: Column) -> Column:
        return F.aggregate(
            parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda acc, chunk: F.struct((acc.at + total(chunk)).alias("at"),
                                        F.array_append(acc.starts, acc.at).alias("starts")),
            lambda acc: acc.starts)

    def chunked(all_items: Column) -> Column:
        return bound(chunks(all_items), lambda parts: F.flatten(F.zip_with(parts, chunk_starts(parts), spans_from)))

    def located(hits: Column) -> Column:
        # The last gap has no match behind it.
        items = F.filter(
            F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit"))),
            lambda item: item.hit.isNotNull())
        few = F.size(hits) <= FEW_MATCHES
        return F.when(F.size(hits) == 0, empty).when(few, spans_from(items, F.lit(0))).otherwise(bound(items, chunked))

    # The pattern runs once for the matches and, where there are any, once more for the gaps.
    spans = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return F.when(text.isNotNull(), F.coalesce(spans, empty))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for all its uses, as the one element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def cut(text: Column, start: Column, stop: Column) -> Column:
    """``text[start:stop]`` with 0-based offsets."""
    begin = F.greatest(start, F.lit(0))
    return F.substring(text, begin + 1, F.greatest(stop - begin, F.lit(0)))


def first_piece(text: Column, pattern: str) -> Column:
    """The part of ``text`` before the first match."""
    return F.element_at(F.split(text, pattern, 2), 1)
