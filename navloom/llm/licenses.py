"""Licence scan by canonical digest, in DataFrame functions only.

Whole documents, their blocks between empty lines, runs of such blocks and their
lines are brought to one canonical form: lower case, no copyright statements, one
spelling of equivalent words, no punctuation, single blanks.  The digest of the form
is hash-joined with the digests of known licence texts and notices.  Nothing is
searched inside a unit, so a match is a licence text in full, however it is wrapped
and whatever blocks surround it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm.license_texts import bodies, further, known

# Equivalent spellings, as (spelling, canonical spelling).
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("copyright-holder", "copyright holder"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisation", "capitalization"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil ", "fulfill "),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("modelling", "modeling"), ("non-commercial", "noncommercial"), ("non commercial", "noncommercial"), ("offence", "offense"),
    ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("share-alike", "sharealike"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("https:", "http:"), ("&", " and "),
]
# Lines that the SQL takes out: all that begin with the word.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|\x{A9})[^\n]*$"
# Lines that state a copyright: by sign, year, a place for the year or reserved rights.
_STATES = r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])|[<\[{]\x20?(?:year|yyyy)|all rights reserved"
COPYRIGHT_STATEMENT = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright(?![\p{L}\p{N}])(?!\x20+(?:notice|holder|owner|law|statement|license|licence))"
    rf"(?=[^\n]*(?:\(c\)|\x{{A9}}|{_STATES}))|\(c\)(?=[^\n]*(?:copyright|{_STATES}))|\x{{A9}}"
    r"|all rights reserved[^\p{L}\p{N}\n]*$)[^\n]*$")
# A statement without any of these ("Copyright The Authors") is told from a wrapped line by its place at the start of a block.
COPYRIGHT_HEAD = (r"(\A|\n[^\p{L}\p{N}\n]*\n)(?:[^\p{L}\p{N}\n]*copyright(?![\p{L}\p{N}])"
                  r"(?!\x20+(?:notice|holder|owner|law|license|licence))[^\n]*(?:\n|\z))+")
# In canonical form: a block that holds a statement behind other words.
ALTERED_STATEMENT = r"[\p{L}\p{N}] copyright (?:c )?(?:19|20)[0-9]{2}(?![0-9])"
TITLE = r"^[\p{L}\p{N} ]{1,40} license(?: [\p{L}\p{N}]{1,10})?$"
# Setting that names a table of further texts.
GIVEN_LICENSES = "spark.navloom.licenses"
# Runs of every number of blocks up to this one, and of the exact numbers of longer known texts.
RUN_BLOCKS = 8
MARKS = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """The canonical form with line feeds kept; null as empty."""
    text = F.lower(F.coalesce(text, F.lit("")))
    text = F.regexp_replace(text, COPYRIGHT_STATEMENT, "")
    text = F.regexp_replace(text, COPYRIGHT_HEAD, "$1")
    for spelling, one in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(one))
    return F.trim(F.regexp_replace(F.regexp_replace(text, MARKS, " "), r" ?\n ?", "\n"))


def flat_blocks(form: Column) -> Column:
    """The blocks that are not empty, each on one line."""
    return F.filter(F.transform(F.split(form, r"\n\n+"), lambda b: F.trim(F.regexp_replace(b, r"[\n ]+", " "))), lambda b: b != "")


def run_sizes(licenses: DataFrame) -> list[int]:
    """Numbers of blocks in which a known text of several can lie in a document.

    List items and titles are set apart by empty lines or not, so all numbers up to the
    largest count, at most ``RUN_BLOCKS``; longer texts are looked for in their own layout.
    """
    sizes = {r["n"] for r in licenses.select(F.size(flat_blocks(canonical(F.col("text")))).alias("n")).distinct().collect()}
    return sorted({*range(2, min(max(sizes, default=0), RUN_BLOCKS) + 1), *(n for n in sizes if n > RUN_BLOCKS)})


def run_starts(flat: Column) -> Column:
    """Places of the blocks at which a run may start.

    A text right behind an altered copyright statement is no licence in full, so no run
    starts there, nor behind a title that follows such a statement.
    """
    def altered(i: Column) -> Column:
        return F.coalesce(F.get(flat, i).rlike(ALTERED_STATEMENT), F.lit(False))

    places = F.filter(F.sequence(F.lit(0), F.size(flat)), lambda i: i > 0)
    return F.filter(places, lambda i: (i == 1) | ~(altered(i - 2) | (F.get(flat, i - 2).rlike(TITLE) & altered(i - 3))))


def units(form: Column, flat: Column, starts: Column, sizes: list[int]) -> Column:
    """Lines, blocks of several lines, the whole text if it has several blocks, and shorter runs of ``flat`` blocks."""
    lines = F.split(form, "\n")
    blocks = F.filter(F.split(form, r"\n\n+"), lambda b: F.instr(b, "\n") > 0)
    whole = F.when(F.instr(form, "\n\n") > 0, F.array(form)).otherwise(F.array().cast("array<string>"))
    single = F.transform(F.concat(blocks, whole), lambda u: F.trim(F.regexp_replace(u, r"[\n ]+", " ")))

    def runs(n: int) -> Column:
        held = F.filter(starts, lambda i: (i + n - 1 <= F.size(flat)) & (F.size(flat) > n))
        return F.transform(held, lambda i: F.array_join(F.slice(flat, i, n), " "))

    return F.filter(F.concat(lines, single, *[runs(n) for n in sizes]), lambda u: u != "")


def digests(form: Column, flat: Column, starts: Column, sizes: list[int]) -> Column:
    return F.transform(units(form, flat, starts, sizes), lambda u: F.md5(u))


def known_licenses(spark: SparkSession) -> DataFrame:
    """license, family and text of the built-in texts and notices, and of the given table.

    ``spark.navloom.licenses`` names a Parquet table of further whole texts with these
    columns; a text may stand in several layouts.
    """
    rows = json.dumps([dict(zip(("license", "family", "text"), row)) for row in known() + bodies() + further()])
    built_in = spark.range(1).select(F.inline(F.from_json(
        F.lit(rows), "array<struct<license:string,family:string,text:string>>")))
    given = spark.conf.get(GIVEN_LICENSES, None)
    return built_in.unionByName(spark.read.parquet(given).select("license", "family", "text")) if given else built_in


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """doc_id, license, family and n (units) for every licence found in a document.

    ``docs`` has doc_id and text.  Null and empty texts and empty tables match
    nothing; rows that share an id, null included, count together.  A text known
    under two identifiers matches both.
    """
    flat = F.trim(F.regexp_replace(canonical(F.col("text")), r"[\n ]+", " "))
    book = licenses.select("license", "family", F.md5(flat).alias("digest")).distinct()
    # The form and its blocks are columns of their own, so that each is computed once for all its uses.
    forms = docs.select("doc_id", canonical(F.col("text")).alias("form"))
    forms = forms.select("doc_id", "form", flat_blocks(F.col("form")).alias("flat"))
    forms = forms.select("*", run_starts(F.col("flat")).alias("starts"))
    sizes = run_sizes(licenses)
    found = forms.select("doc_id", F.explode(digests(F.col("form"), F.col("flat"), F.col("starts"), sizes)).alias("d"))
    return found.join(book, found.d == book.digest).groupBy("doc_id", "license", "family").agg(F.count(F.lit(1)).alias("n"))


def per_document(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """One row per input row: n_units, licenses and families found, sorted and comma-joined."""
    found = scan(docs, licenses).groupBy(F.col("doc_id").alias("_id")).agg(
        F.sum("n").alias("n_units"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"))
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", F.coalesce("n_units", F.lit(0)).alias("n_units"), F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("families", F.lit("")).alias("families"))


def oracle_sql() -> str:
    """The scan for DuckDB, by COPYRIGHT_LINE, without runs of blocks and further texts."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def form(text: str) -> str:
        out = f"lower(coalesce({text}, ''))"
        out = f"regexp_replace({out}, '{COPYRIGHT_LINE}', '', 'g')"
        for spelling, one in SPELLINGS:
            out = f"replace({out}, {quoted(spelling)}, {quoted(one)})"
        return f"trim(regexp_replace(regexp_replace({out}, '{MARKS}', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), ' ')"

    def flat(text: str) -> str:
        return f"trim(regexp_replace({text}, '[\\n ]+', ' ', 'g'))"

    values = ", ".join(f"({quoted(a)}, {quoted(b)}, {quoted(c)})" for a, b, c in known())
    return f"""
with known as (select * from (values {values}) t(license, family, text)),
book as (select distinct license, family, md5({flat('f')}) digest from (select license, family, {form('text')} f from known)),
forms as (select doc_id, {form('text')} f from documents),
unit as (select doc_id, unnest(string_split(f, chr(10))) u from forms
         union all select doc_id, {flat('b')} from (select doc_id, unnest(regexp_split_to_array(f, '\\n\\n+')) b from forms)
                   where contains(b, chr(10))
         union all select doc_id, {flat('f')} from forms where contains(f, chr(10) || chr(10))),
found as (select doc_id, license, family from unit join book on md5(u) = digest where u <> '')
select d.doc_id, coalesce(n_units, 0) n_units, coalesce(licenses, '') licenses, coalesce(families, '') families
from documents d left join (
  select doc_id, count(*) n_units, string_agg(distinct license, ',' order by license) licenses,
         string_agg(distinct family, ',' order by family) families from found group by 1) using (doc_id)
"""
