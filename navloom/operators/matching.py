"""Substring matches between texts and the aliases of a curated catalog.

The first characters of all aliases, the grams, are a small set that is read once and
tested inside the row: of all positions of a text only those that start with a gram
leave it, each distinct window once.  The windows join the aliases on their gram and
are verified there.  A catalog with more than ``MOST_GRAMS`` grams offers all
positions to the same join.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First characters of an alias that windows are joined on; shorter aliases use what they have.
GRAM_CHARS = 3
# Grams that are tested inside the row, each of at most GRAM_CHARS characters.
MOST_GRAMS = 20_000
# Grams that one pattern seeks; more are looked up in a set, position by position.
PATTERN_GRAMS = 256
# Characters of a piece: a position in a piece costs as many steps as lie before it.
PIECE_CHARS = 128


def alias_table(catalog: DataFrame) -> DataFrame:
    """``(position, alias, gram)`` of all non-empty normalized aliases."""
    aliases = catalog.select("position", F.explode("normalized_aliases").alias("alias")).where("alias <> ''")
    return aliases.distinct().withColumn("gram", F.substring("alias", 1, GRAM_CHARS))


def _grams(aliases: DataFrame) -> tuple[int, list[int], list[str] | None]:
    """Length of the longest alias, the lengths that grams have, and the grams themselves if they are few."""
    found = aliases.groupBy("gram").agg(F.max(F.length("alias")).alias("longest")).limit(MOST_GRAMS + 1).collect()
    if len(found) <= MOST_GRAMS:
        return max((r.longest for r in found), default=0), sorted({len(r.gram) for r in found}), [r.gram for r in found]
    sizes = aliases.agg(F.max(F.length("alias")).alias("longest"),
                        F.array_sort(F.collect_set(F.length("gram"))).alias("lengths")).first()
    return sizes.longest, sizes.lengths, None


def _pattern(longest: int, grams: list[str]) -> str:
    """Finds every position that starts with a gram, overlaps included; group 1 is its window.

    Grams are gathered by their first character, which a class tests before any of them.
    """
    heads = [(head, [re.escape(g[1:]) for g in own]) for head, own in groupby(sorted(grams), lambda g: g[0])]
    firsts = "".join(re.escape(head) for head, _ in heads)
    tree = "|".join(f"{re.escape(head)}(?:{'|'.join(rest)})" for head, rest in heads)
    return f"(?s)(?=[{firsts}])(?=(?:{tree}))(?=(.{{1,{longest}}}))"


def candidate_windows(text: Column, longest: int, lengths: list[int], grams: list[str] | None) -> Column:
    """Distinct windows of ``longest`` characters that start with a gram; with no ``grams`` those of all positions.

    Few grams are sought by one pattern.  Else windows are cut from pieces of bounded
    length, each with the start of the next piece behind it.
    """
    if grams is not None and len(grams) <= PATTERN_GRAMS:
        return F.array_distinct(F.regexp_extract_all(text, F.lit(_pattern(longest, grams)), F.lit(1)))
    size = max(PIECE_CHARS, longest)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def starts(body: Column, i: Column) -> Column:
        hits = [F.substr(body, i, F.lit(n)).isin([g for g in grams if len(g) == n]) for n in lengths]
        return reduce(lambda a, b: a | b, hits)

    def of_piece(own: Column, after: Column) -> Column:
        body = F.concat(own, F.substring(F.coalesce(after, F.lit("")), 1, longest - 1))
        places = F.sequence(F.lit(1), F.length(own))
        # A one-element array binds the body once for all positions.
        return F.flatten(F.transform(F.array(body), lambda bound: F.transform(
            places if grams is None else F.filter(places, lambda i: starts(bound, i)),
            lambda i: F.substr(bound, i, F.lit(longest)))))

    bound = F.flatten(F.transform(F.array(pieces), lambda found: F.zip_with(
        found, F.slice(found, 2, F.greatest(F.size(found), F.lit(1))), of_piece)))
    return F.array_distinct(F.flatten(bound))


def alias_hits(df: DataFrame, key: str, text: str, catalog: DataFrame) -> DataFrame:
    """JN-05. Distinct ``(key, position)`` pairs of texts and the catalog entries they contain."""
    aliases = alias_table(catalog)
    longest, lengths, grams = _grams(aliases)
    if not longest:
        return df.select(key, F.lit(None).cast("int").alias("position")).where("false")
    windows = df.select(key, F.explode(candidate_windows(F.col(text), longest, lengths, grams)).alias("window"))
    # One row for each window and each of its grams, whatever their number of characters.
    offered = windows.select(key, "window", F.explode(F.array(
        *[F.substring("window", 1, n) for n in lengths])).alias("gram"))
    hits = offered.join(aliases, "gram").where(F.expr("startswith(window, alias)"))
    return hits.select(key, "position").distinct()
