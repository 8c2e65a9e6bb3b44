"""Document texts to facts, as Spark expressions over ``documents_text``.

``docs(code, announcement_id, published_date, source_url, text, error)``: a null
text is an unreadable document and flows on as data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date, chinese_date, report_period_end
from navloom.functions.numbers import (
    cny_amount, exact_round, finite_number, group_or_null, plain_digits,
)
from navloom.functions.text import (
    bound, collapse, compact, cut, first_piece, match_spans, normalize_instrument, normalize_name,
    normalize_notice, product_structure, share_aggregation,
)
from navloom.operators.eligibility import management_style
from navloom.operators.matching import alias_hits
from navloom.operators.quality import issues_of, union_all
from navloom.session import computed, dealt, merged, staged


def _u(pattern: str) -> str:
    return pattern if pattern.startswith("(?U") else "(?U)" + pattern


def _group(text: Column, pattern: str, group: int = 1) -> Column:
    return group_or_null(F.regexp_extract(text, _u(pattern), group))


# --- which documents -------------------------------------------------------

def classify_documents(announcements: DataFrame) -> DataFrame:
    """FLT-10. ``document_class``: prospectus, product_summary or periodic_report; others dropped."""
    title = F.col("title")
    prospectus = title.contains("招募说明书") & ~title.contains("提示性公告") & ~title.contains("摘要")
    foreign = title.contains("美元") | title.contains("港币") | title.rlike(fixed.SUMMARY_FOREIGN_SHARE)
    summary = title.contains("基金产品资料概要") & ~title.contains("提示性公告") & ~foreign
    period_end = report_period_end(title)
    classes = F.array_compact(F.array(
        F.when(prospectus, "prospectus"), F.when(summary, "product_summary"),
        F.when(period_end.isNotNull(), "periodic_report")))
    return announcements.withColumn("report_date", period_end).withColumn(
        "document_class", F.explode(classes))


def latest_documents(classified: DataFrame, *, as_of) -> DataFrame:
    """AG-07. Newest document per fund and class by publication date, then id."""
    visible = classified.where(F.col("published_date") <= as_date(as_of))
    newest = visible.groupBy("code", "document_class").agg(
        F.max_by(F.struct("announcement_id", "title", "published_date"),
                 F.struct("published_date", "announcement_id")).alias("d"))
    return newest.select("code", "document_class", "d.*")


def latest_report(announcements: DataFrame, *, as_of) -> DataFrame:
    """AG-08. Newest periodic report by period end, then publication, then the larger id."""
    reports = announcements.withColumn("report_date", report_period_end(F.col("title"))).where(
        (F.col("report_date") <= as_date(as_of)) & (F.col("published_date") <= as_date(as_of)))
    newest = reports.groupBy("code").agg(
        F.max_by(F.struct("announcement_id", "title", "report_date", "published_date"),
                 F.struct("report_date", "published_date", "announcement_id")).alias("r"))
    return newest.select("code", "r.*")


def missing_reports(codes: DataFrame, reports: DataFrame) -> DataFrame:
    """AG-08. A fund without a readable periodic report is fatal."""
    without = codes.join(reports.select("code"), "code", "left_anti")
    return issues_of(without, F.col("code"), F.lit("periodic_report_missing"))


# --- quota notices ---------------------------------------------------------

def global_amount(text: Column) -> Column:
    """TXT-01. ``(value, unit)`` texts of the first wording that hits; two name no unit."""
    options = []
    for i, pattern in enumerate(fixed.GLOBAL_AMOUNTS):
        value = _group(text, pattern)
        unit = F.lit("元") if i < 2 else _group(text, pattern, 2)
        options.append(F.when(value.isNotNull(), F.struct(value.alias("value"), unit.alias("unit"))))
    return F.coalesce(*options)


def channel_amount_text(text: Column, channel: str) -> Column:
    """TXT-02. Text that ends in the amount of a channel, or null.

    An explicit amount in the clause of a channel word comes first, else the
    nearest one: within -80/+220 characters of the word and with a limit word
    within 55 characters; the first of equally near ones wins.
    """
    stated = _group(text, rf"(?:{channel})[^。；]*?{fixed.CHANNEL_EXPLICIT}", 0)
    words = match_spans(text, _u(channel))

    def near(word: Column) -> Column:
        left = F.greatest(word.start - fixed.CHANNEL_BEFORE, F.lit(0))
        window = cut(text, left, word.stop + fixed.CHANNEL_AFTER)
        amounts = match_spans(window, _u(fixed.AMOUNT))
        limited = F.filter(amounts, lambda a: cut(
            window, a.start - fixed.LIMIT_CONTEXT, a.start + fixed.LIMIT_CONTEXT).rlike(fixed.LIMIT_WORD))
        return F.transform(limited, lambda a: F.struct(
            F.abs(left + a.start - word.stop).alias("distance"), a.found.alias("found")))

    ranked = F.flatten(F.transform(words, near))
    nearest = F.array_min(F.transform(ranked, lambda c, i: F.struct(
        c.distance.alias("distance"), i.alias("turn"), c.found.alias("found"))))
    # Windows are searched only where no clause states an amount; a case runs its branches one after the other.
    return F.when(stated.isNotNull(), stated).when(text.rlike(_u(channel)), nearest.found)


def closing_amount(text: Column) -> Column:
    """The amount a text ends in, in CNY."""
    return cny_amount(_group(text, fixed.CLOSING_AMOUNT), _group(text, fixed.CLOSING_AMOUNT, 2))


def effective_date(text: Column, published: Column) -> Column:
    """TXT-03. Stated start date, else the publication date."""
    return F.coalesce(*[chinese_date(text, _u(p)) for p in fixed.EFFECTIVE_DATES], published)


def _future_clauses(text: Column, spans: Column) -> Column:
    """Sentences that open with a start date and speak of a change.

    ``spans`` is a column of its own: an expression would run per element.
    """
    clauses = F.transform(spans, lambda s, i: F.struct(
        (i + 1).alias("transition_seq"),
        chinese_date(s.found, _u(fixed.FUTURE_DATE)).alias("clause_date"),
        first_piece(cut(text, s.start, F.coalesce(
            F.get(spans, i + 1).start, s.stop + fixed.FUTURE_CLAUSE_CHARS)), "[。；]").alias("segment")))
    return F.filter(clauses, lambda c: c.segment.rlike(fixed.CHANGE_VERB))


def parse_notices(docs: DataFrame) -> DataFrame:
    """TXT-04. Notices to transitions: the base state and later dated changes.

    ``docs`` also carries ``notice_seq``, the place of a notice in its fund's log.
    """
    base = dealt(docs.where("text is not null"), "announcement_id").withColumn("body", normalize_notice(F.col("text")))
    base = base.withColumn("base_date", effective_date(F.col("body"), F.col("published_date"))).withColumn(
        "spans", match_spans(F.col("body"), _u(fixed.FUTURE_DATE)))
    whole = F.array(F.struct(F.lit(0).alias("transition_seq"), F.col("base_date").alias("clause_date"),
                             F.col("body").alias("segment")))
    rows = base.select("code", "announcement_id", "notice_seq", "published_date", "source_url", "base_date",
                       F.explode(F.concat(whole, _future_clauses(F.col("body"), F.col("spans")))).alias("c"))
    rows = rows.select("code", "announcement_id", "notice_seq", "published_date", "source_url", "base_date",
                       "c.*").where("transition_seq = 0 or clause_date != base_date")
    segment, squeezed = F.col("segment"), F.col("squeezed")
    # Each search runs once per segment; the filter below would repeat it for each of its uses.
    found = computed(rows, {
        "squeezed": compact(segment), "hit": global_amount(segment),
        "direct_text": channel_amount_text(segment, fixed.DIRECT_CHANNEL),
        "agency_text": channel_amount_text(segment, fixed.AGENCY_CHANNEL),
    }).withColumns({
        "direct_amount_cny": closing_amount(F.col("direct_text")),
        "agency_amount_cny": closing_amount(F.col("agency_text")),
        "global_amount_cny": cny_amount(F.col("hit.value"), F.col("hit.unit")),
    })
    none = F.col("direct_amount_cny").isNull() & F.col("agency_amount_cny").isNull() \
        & F.col("global_amount_cny").isNull()
    restored = squeezed.rlike(fixed.RESTORE) & ~squeezed.rlike(fixed.STILL_CAPPED) \
        & ~squeezed.rlike(fixed.RESTORE_PENDING)
    is_base = F.col("transition_seq") == 0
    kept = found.where((is_base & (~none | restored)) | (~is_base & F.col("global_amount_cny").isNotNull()))
    both = F.col("direct_amount_cny").isNotNull() & F.col("agency_amount_cny").isNotNull()
    combined = squeezed.contains(fixed.ALL_CHANNELS) | (is_base & squeezed.rlike(fixed.MANY_CHANNELS))
    return kept.select(
        "code", "announcement_id", "notice_seq", "transition_seq",
        F.col("clause_date").alias("effective_date"), "published_date",
        "direct_amount_cny", "agency_amount_cny", "global_amount_cny",
        F.when(none, "unlimited").otherwise("limited").alias("global_status"),
        share_aggregation(segment).alias("share_aggregation"),
        combined.alias("all_channels_combined"),
        F.when(F.col("global_amount_cny").isNotNull() | both, "high").otherwise("medium").alias("confidence"),
        "source_url")


def failed_notices(docs: DataFrame, transitions: DataFrame) -> DataFrame:
    """TXT-04. Selected notices that gave no transition, unreadable ones included."""
    parsed = transitions.select("code", "announcement_id").distinct()
    return docs.select("code", "announcement_id", "published_date").join(
        parsed, ["code", "announcement_id"], "left_anti")


# --- benchmark statements --------------------------------------------------

def benchmark_body(text: Column) -> Column:
    """The text that statements are sought in: blanks between Han characters out, others collapsed."""
    return collapse(F.regexp_replace(F.translate(text, "　", " "), "(?U)(?<=[一-鿿])\\s+(?=[一-鿿])", ""))


def benchmark_statement(body: Column) -> Column:
    """TXT-05. Best sentence after a benchmark heading: weighted first, then the shortest.

    ``body`` is a column of its own: an expression would run for each heading.
    """
    starts = F.concat(*[match_spans(body, _u(p)) for p in fixed.BENCHMARK_STARTS])

    def statement(span: Column) -> Column:
        tail = cut(body, span.stop, span.stop + fixed.BENCHMARK_TAIL_CHARS)
        stopped = F.when(tail.rlike(fixed.BENCHMARK_STOP), first_piece(tail, fixed.BENCHMARK_STOP)) \
            .otherwise(F.substring(tail, 1, fixed.BENCHMARK_STATEMENT_CHARS))
        trimmed = F.btrim(stopped, F.lit(" ：:。；;"))
        return F.trim(first_piece(trimmed, "[。；;]"))

    candidates = F.filter(F.transform(starts, statement), lambda s: (s != "") & normalize_name(s).rlike(
        fixed.BENCHMARK_TOKENS))
    best = F.array_min(F.transform(candidates, lambda s, i: F.struct(
        F.when(s.contains("%"), 0).otherwise(1).alias("plain"), F.length(s).alias("size"),
        i.alias("turn"), s.alias("statement"))))
    return best.statement


def weight_pattern(alias: Column) -> Column:
    """``w%×alias`` or ``alias×w%`` with free spacing inside the alias."""
    plain = F.regexp_replace(F.trim(alias), r"([\\^$.|?*+()\[\]{}&-])", r"\\$1")
    body = F.regexp_replace(plain, r"(?U)\s+", r"\\s*")
    number = r"(\d+(?:\.\d+)?)\s*%"
    return F.concat(F.lit(rf"(?iU)(?:{number}\s*[×*xX]\s*"), body, F.lit("|"), body,
                    F.lit(rf"[^+＋，,。；;]{{0,{fixed.WEIGHT_GAP_CHARS}}}?[×*xX]\s*{number})"))


def component_weights(named: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """TXT-06. ``named(key, position, statement)`` with the weight of each entry.

    The weight stands beside the longest alias that has one, else it is the
    largest percentage, else 100.  Rows are sorted by pattern within their
    partition, so that each pattern is compiled once there and not for each row.
    """
    aliases = catalog.select("position", F.posexplode(F.array_sort(
        F.filter("aliases", lambda a: F.trim(a) != ""), lambda a, b: F.length(b) - F.length(a))).alias("turn", "alias"))
    patterns = aliases.select("position", "turn", weight_pattern(F.col("alias")).alias("pattern"))
    tried = named.join(patterns, "position").sortWithinPartitions("pattern")

    def beside(group: int) -> Column:
        return group_or_null(F.call_function("regexp_extract", F.col("statement"), F.col("pattern"), F.lit(group)))

    found = computed(tried, {"beside": F.coalesce(beside(1), beside(2))}).select(key, "position", "turn", "beside")
    first = found.where("beside is not null").groupBy(key, "position").agg(F.min_by("beside", "turn").alias("beside"))
    every = F.regexp_extract_all("statement", F.lit(r"(?U)(\d+(?:\.\d+)?)\s*%"), F.lit(1))
    largest = F.array_max(F.transform(every, lambda w: plain_digits(w).try_cast("double")))
    return named.join(first, [key, "position"], "left").withColumn("weight_pct", F.coalesce(
        plain_digits(F.col("beside")).try_cast("double"), largest, F.lit(100.0))).drop("beside")


def match_catalog(texts: DataFrame, key: str, text: str, catalog: DataFrame) -> DataFrame:
    """JN-05. All catalog entries a text names, once each."""
    named = dealt(texts.select(key, text), key).select(key, normalize_name(F.col(text)).alias("normalized"))
    return alias_hits(named, key, "normalized", catalog).join(catalog, "position")


def parse_benchmarks(docs: DataFrame, catalog: DataFrame, rows: int = 0) -> tuple[DataFrame, DataFrame]:
    """TXT-05, TXT-06. ``(statements, components)`` of readable documents, by code and announcement id.

    ``docs`` carries ``fund_name``.  Several funds may list one document: its text
    is parsed once, under its id.  A statement that only names a target index is
    matched on the fund name, which is the fund's own, and the opening of the text.
    ``rows`` is the number of ``docs`` where it is known.
    """
    key, own_key = "announcement_id", ["code", "announcement_id"]
    # One copy of each text leaves a task, however many funds list it.
    texts = dealt(docs.where("text is not null").select(key, "text").distinct(), key)
    texts = texts.groupBy(key).agg(F.first("text").alias("text"))
    texts = computed(texts, {"body": benchmark_body(F.col("text"))})
    texts = computed(texts, {"statement": benchmark_statement(F.col("body"))}).where("statement is not null")
    # Statements are read several times and short beside the texts: staged, each text is parsed once.
    targeted = F.col("statement").contains("标的指数")
    texts = staged(texts.select(
        key, "statement", F.when(targeted, F.substring("text", 1, fixed.BENCHMARK_FALLBACK_CHARS)).alias("opening")))
    listed = dealt(docs.select("code", key, "fund_name"), key, rows=rows).dropDuplicates(own_key)
    statements = staged(merged(listed, texts, key))
    # Documents repeat each other's statements: entries and weights follow from the statement, found once for each.
    spoken = texts.select("statement").distinct().withColumn("spoken", F.col("statement"))
    shared = staged(match_catalog(spoken, "statement", "spoken", catalog).select("statement", "position"))
    unnamed = statements.where(targeted).join(shared.select("statement").distinct(), "statement", "left_anti").select(
        F.struct(*own_key, "statement").alias("own"), F.concat_ws(" ", "fund_name", "opening").alias("opening"))
    fallback = staged(match_catalog(unnamed, "own", "opening", catalog).select("own.*", "position"))
    named = shared.unionByName(fallback.select("statement", "position").distinct())
    weights = staged(component_weights(named, catalog, "statement"))
    statements = statements.drop("opening")
    matched = statements.select(*own_key, "statement").join(shared, "statement").unionByName(
        fallback.select(*own_key, "statement", "position"))
    weighted = matched.join(weights, ["statement", "position"]).join(catalog, "position")
    components = weighted.select(
        "code", key, F.col("id").alias("benchmark_id"), F.col("display_name").alias("benchmark_name"), "weight_pct",
        "market_scope", "market_label", "asset_class", "style_label", "structure", "excluded_target")
    components = components.withColumn("weight_pct", exact_round("weight_pct", 2))
    return statements, components


def benchmark_profiles(statements: DataFrame, components: DataFrame, rows: int = 0) -> DataFrame:
    """TXT-06. One profile per fund and document; components by weight descending, then id.

    A document names each catalog entry once, so the array is bounded by the catalog.
    ``rows`` is the number of listed documents where it is known.
    """
    keys = ["code", "announcement_id"]
    fields = ["benchmark_id", "benchmark_name", "weight_pct", "market_scope", "market_label",
              "asset_class", "style_label", "structure", "excluded_target"]
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("weight_pct")).alias("order"), *fields)))
    nested = dealt(components, *keys, rows=rows).groupBy(*keys).agg(ordered.alias("sorted")).withColumn(
        "components", F.transform("sorted", lambda c: c.dropFields("order"))).drop("sorted")
    joined = merged(statements, nested, keys, "left").withColumn(
        "components", F.coalesce("components", F.array().cast(nested.schema["components"].dataType)))
    count = F.size("components")
    only = F.get("components", F.lit(0))

    def pick(field: str, many: str | None, none: str | None) -> Column:
        return F.when(count == 1, only[field]).when(count > 1, F.lit(many)).otherwise(F.lit(none))

    names = F.array_join(F.transform("components", lambda c: c.benchmark_name), " + ")
    return joined.select(
        "code", "announcement_id",
        F.when(count == 1, "recognized").when(count > 1, "composite").otherwise("unrecognized").alias("status"),
        F.col("statement").alias("benchmark_text"),
        F.when(count == 1, only.benchmark_id).alias("benchmark_id"),
        F.when(count >= 1, names).otherwise(fixed.UNRECOGNIZED).alias("benchmark_name"),
        F.when(count == 1, only.weight_pct).alias("benchmark_weight_pct"),
        pick("market_scope", "composite", "unknown").alias("market_scope"),
        pick("market_label", fixed.COMPOSITE_MARKET, fixed.UNRECOGNIZED).alias("market_label"),
        pick("asset_class", "mixed", "unknown").alias("asset_class"),
        pick("style_label", fixed.COMPOSITE_STYLE, fixed.UNRECOGNIZED).alias("style_label"),
        product_structure(F.concat_ws(" ", "fund_name", "statement"),
                          F.when(count == 1, only.structure).otherwise("standard")).alias("structure"),
        ((count > 0) & F.forall("components", lambda c: c.excluded_target)).alias("excluded_target"),
        "components")


def summary_match(summary_id: Column, status: Column, components: Column, summary_components: Column) -> Column:
    """JN-12. matched, conflict, unreadable or missing; ``status`` and the components are null when unread."""
    def ids(found: Column) -> Column:
        return F.array_sort(F.transform(found, lambda c: c.benchmark_id))

    unread = summary_components.isNull() | status.isNull() | status.isin("unreadable", "unrecognized")
    return (
        F.when(summary_id.isNull(), "missing").when(unread, "unreadable")
        .when(~ids(components).eqNullSafe(ids(summary_components)), "conflict").otherwise("matched"))


def compare_components(left: DataFrame, right: DataFrame) -> DataFrame:
    """JN-12. Whether two documents of a fund name the same benchmarks.

    Inputs are profiles; an unusable left side is ``unreadable``, an absent
    right side ``missing``.
    """
    other = right.select("code", F.col("announcement_id").alias("summary_id"), F.when(
        F.col("status") != "unreadable", F.col("components")).alias("summary_components"))
    joined = left.select("code", "status", "components").join(other, "code", "left")
    return joined.select("code", summary_match(
        F.col("summary_id"), F.col("status"), F.col("components"), F.col("summary_components")).alias("product_summary_status"))


# --- operating expense -----------------------------------------------------

def parse_costs(docs: DataFrame, *, as_of) -> DataFrame:
    """TXT-10. Annual expense per summary; ``cost_issue`` says why there is none."""
    body = collapse(F.translate("text", "　", " "))
    read = docs.withColumn("body", body)
    rate = finite_number(plain_digits(_group(F.col("body"), fixed.EXPENSE_RATE)))
    measured = chinese_date(F.col("body"), _u(fixed.EXPENSE_DATE))
    parsed = read.withColumn("rate", rate).withColumn("measured", measured)
    issue = (
        F.when(F.col("text").isNull(), "unreadable")
        .when(F.col("rate").isNull(), "expense_missing")
        .when(~F.col("rate").between(0, 100), "expense_invalid")
        .when(F.col("measured") > as_date(as_of), "measurement_in_future"))
    good = F.col("cost_issue").isNull()
    return parsed.withColumn("cost_issue", issue).select(
        "code", "announcement_id", F.when(good, "parsed").otherwise("unavailable").alias("status"),
        F.when(good, exact_round("rate", 2)).alias("annualized_pct"),
        F.when(good, F.col("measured")).alias("measurement_date"), "cost_issue")


def costs_as_of(costs: DataFrame, as_of) -> DataFrame:
    """TXT-10. Parsed costs as they stand on a day: a later measurement is no cost yet."""
    late = F.coalesce(F.col("measurement_date") > as_date(as_of), F.lit(False))
    return costs.select(
        "code", "announcement_id", F.when(late, "unavailable").otherwise(F.col("status")).alias("status"),
        F.when(~late, F.col("annualized_pct")).alias("annualized_pct"),
        F.when(~late, F.col("measurement_date")).alias("measurement_date"),
        F.when(late, "measurement_in_future").otherwise(F.col("cost_issue")).alias("cost_issue"))


# --- periodic reports ------------------------------------------------------

def repair_text(text: Column) -> Column:
    """TXT-09. Page headers out, numbers split over lines rejoined."""
    # A header needs a year in its line or behind the blanks that follow it; lines without one are passed over at once.
    header = fixed.REPORT_PAGE_HEADER.replace("^", r"^(?=[^\n年]*+\s*+年)", 1)
    out = F.regexp_replace(text, header, "")
    for pattern, replacement in fixed.SPLIT_NUMBERS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def report_sections(docs: DataFrame) -> DataFrame:
    """The parts of a report that its parsers read, cut out of the repaired text in one pass.

    ``readable``, ``country_part``, ``asset_part``, ``net_part`` and ``holdings_part``,
    null where a heading is missing; a report is one row, with or without text.
    Each part is short whatever the length of the report.
    """
    body = F.col("body")

    # The value of a search is bound, or it would run once for its test and once more for its result.
    def found(pattern: str) -> Column:
        return bound(F.regexp_extract(body, pattern, 1), group_or_null)

    def after(heading: str, chars: int) -> Column:
        return found(rf"(?Us)(?:{heading})(.{{1,{chars}}})")

    fixed_text = dealt(docs, "announcement_id").withColumn("body", repair_text(F.col("text")))
    return fixed_text.select(
        "code", "announcement_id", F.col("text").isNotNull().alias("readable"),
        first_piece(after(fixed.COUNTRY_HEADING, fixed.COUNTRY_CHARS), _u(fixed.NEXT_HEADING)).alias("country_part"),
        after(fixed.ASSET_HEADING, fixed.ASSET_CHARS).alias("asset_part"),
        found(_u(fixed.NET_ASSETS)).alias("net_part"),
        found(rf"(?Us)(?:{fixed.HOLDINGS_START})(.*?){fixed.HOLDINGS_END}").alias("holdings_part"))


def parse_report_totals(docs: DataFrame) -> DataFrame:
    """TXT-08, AG-16. Direct US share and fund investment share per listed report."""
    return section_totals(report_sections(docs))


def section_totals(sections: DataFrame) -> DataFrame:
    """TXT-08, AG-16, from the sections of reports."""
    country, net_block, asset = F.col("country_part"), F.col("net_part"), F.col("asset")
    sections = computed(sections, {"asset": collapse_keep_ends(F.col("asset_part")), "countries": collapse_keep_ends(country)})
    direct = plain_digits(_group(F.col("countries"), fixed.COUNTRY_US, 2)).try_cast("double")
    amount = plain_digits(_group(asset, fixed.FUND_AMOUNT)).try_cast("double")
    net_values = F.transform(
        F.regexp_extract_all(net_block, F.lit(_u(fixed.NET_ASSET_VALUE)), F.lit(1)),
        lambda v: plain_digits(v).try_cast("double"))
    net_total = F.aggregate(net_values, F.lit(0.0), lambda acc, v: acc + v)
    parts = sections.select(
        "code", "announcement_id", "readable",
        country.isNotNull().alias("has_country"), asset.isNotNull().alias("has_asset"),
        F.coalesce(direct, F.lit(0.0)).alias("direct"), amount.alias("amount"),
        F.coalesce(asset.rlike(_u(fixed.FUND_DASH)), F.lit(False)).alias("dash"),
        net_total.alias("net_total"))
    invested = F.coalesce(F.col("amount"), F.lit(0.0)) > 0
    issue = (
        F.when(~F.col("readable"), "unreadable")
        .when(~F.col("has_country"), "country_table_missing")
        .when(~F.col("has_asset"), "asset_table_missing")
        .when(F.col("amount").isNull() & ~F.col("dash"), "fund_amount_missing")
        .when(invested & (F.coalesce("net_total", F.lit(0.0)) <= 0), "net_assets_missing"))
    share = F.when(invested, fund_investment_pct(F.col("amount"), F.col("net_total"))).otherwise(0.0)
    return parts.withColumn("share", share).withColumn("report_issue", issue).select(
        "code", "announcement_id",
        F.when(F.col("report_issue").isNull(), exact_round("direct", 4)).alias("direct_us_pct"),
        F.when(F.col("report_issue").isNull(), exact_round("share", 4)).alias("fund_investment_pct"),
        "report_issue")


def fund_investment_pct(amount: Column, net_assets: Column) -> Column:
    """AG-16. Fund positions in percent of the net assets of all share classes."""
    return amount / F.nullif(net_assets, F.lit(0.0)) * 100


def collapse_keep_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def parse_holdings(docs: DataFrame) -> DataFrame:
    """TXT-07, WIN-10. Rows of the top-ten fund table; ``row_issue`` marks unreadable rows."""
    return section_holdings(report_sections(docs))


def section_holdings(sections: DataFrame) -> DataFrame:
    """TXT-07, WIN-10, from the sections of reports.

    A row runs from its number to the start of the next row.
    """
    found = sections.withColumn("table", F.col("holdings_part")).withColumn(
        "spans", match_spans(F.col("table"), fixed.HOLDING_ROW))
    spans = F.col("spans")
    rows = F.transform(spans, lambda s, i: F.struct(
        F.regexp_extract(s.found, r"(10|[1-9])", 1).cast("int").alias("rank"),
        i.alias("row_seq"),
        collapse(cut(F.col("table"), s.stop, F.coalesce(
            F.get(spans, i + 1).start, F.length("table")))).alias("body")))
    exploded = found.select("code", "announcement_id", F.explode(rows).alias("r")).select(
        "code", "announcement_id", "r.*")  # a report without the table has null spans and no rows
    name = F.coalesce(*[_group(F.col("body"), p) for p in fixed.HOLDING_NAMES])
    percents = F.filter(
        F.transform(F.regexp_extract_all("body", F.lit(_u(fixed.HOLDING_PERCENT)), F.lit(1)),
                    lambda v: plain_digits(v).try_cast("double")), lambda v: v <= 100)
    named = exploded.withColumn("name", name).withColumn("weight_pct", F.get(percents, F.lit(0)))
    named = named.where(F.col("name").isNotNull() | F.col("body").contains("基金"))
    continuation = _group(F.col("body"), fixed.HOLDING_CONTINUATION)
    short = F.length(normalize_instrument(F.col("name"))) < fixed.HOLDING_SHORT_NAME
    full_name = F.when(short & continuation.isNotNull(), F.concat_ws(" ", "name", continuation)) \
        .otherwise(F.col("name"))
    category = F.when(F.col("body").rlike(_u(fixed.HOLDING_COMMODITY)), "commodity").when(
        F.col("body").rlike(_u(fixed.HOLDING_BOND)), "fixed_income")
    issue = F.when(F.col("name").isNull() | F.col("weight_pct").isNull(), "holding_row_unreadable")
    return named.select("code", "announcement_id", "rank", "row_seq", full_name.alias("fund_name"),
                        "weight_pct", category.alias("reported_category"), issue.alias("row_issue"))


def report_issues(totals: DataFrame, holdings: DataFrame) -> DataFrame:
    """TXT-07, TXT-08. Fatal issues, an invested fund without any holding row included."""
    listed = holdings.select("code", "announcement_id").distinct()
    unlisted = totals.where("fund_investment_pct > 0").join(listed, ["code", "announcement_id"], "left_anti")
    return union_all([
        issues_of(totals, F.col("code"), F.col("report_issue"), F.col("announcement_id")),
        issues_of(holdings, F.col("code"), F.col("row_issue"), F.col("announcement_id")),
        issues_of(unlisted, F.col("code"), F.lit("holdings_missing"), F.col("announcement_id"))])


# --- profile assembly ------------------------------------------------------

def document_profiles(funds: DataFrame, legal: DataFrame, profiles: DataFrame, costs: DataFrame, rows: int = 0) -> DataFrame:
    """TXT-11. Contract profile and cost of every fund; nothing unreadable ever blocks.

    ``legal`` is ``latest_documents`` joined with texts, ``profiles`` and
    ``costs`` the parsed results keyed by ``code`` and ``announcement_id``.
    ``rows`` is the number of documents where it is known.
    """
    def newest(kind: str, prefix: str) -> DataFrame:
        found = legal.where(F.col("document_class") == kind)
        return dealt(found.select("code", *[F.col(c).alias(f"{prefix}_{c}") for c in (
            "announcement_id", "title", "published_date", "source_url")]), "code", f"{prefix}_announcement_id", rows=rows)

    # A document meets what was read from it first, then its fund; only the ids of a summary's components are compared.
    own = profiles.withColumnRenamed("announcement_id", "prospectus_announcement_id")
    prospectuses = merged(newest("prospectus", "prospectus"), own, ["code", "prospectus_announcement_id"], "left")
    priced = costs.select("code", F.col("announcement_id").alias("summary_announcement_id"),
                          F.col("status").alias("cost_status"), "annualized_pct", "measurement_date", "cost_issue")
    other = profiles.select("code", F.col("announcement_id").alias("summary_announcement_id"), F.transform(
        "components", lambda c: F.struct(c.benchmark_id.alias("benchmark_id"))).alias("summary_components"))
    summaries = newest("product_summary", "summary")
    for found in (priced, other):
        summaries = merged(summaries, found, ["code", "summary_announcement_id"], "left")
    base = dealt(funds.select("code", "name", "fund_type"), "code", rows=rows)
    for found in (prospectuses, summaries):
        base = merged(base, found, "code", "left")
    summary_status = summary_match(
        F.col("summary_announcement_id"), F.col("status"), F.col("components"), F.col("summary_components"))

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    contract = F.struct(
        text("status", "unreadable"), text("benchmark_text", fixed.UNRECOGNIZED), F.col("benchmark_id"),
        text("benchmark_name", fixed.UNRECOGNIZED), F.col("benchmark_weight_pct"),
        text("market_scope", "unknown"), text("market_label", fixed.UNRECOGNIZED),
        text("asset_class", "unknown"), text("style_label", fixed.UNRECOGNIZED),
        F.coalesce("structure", product_structure(F.col("name"), F.lit("standard"))).alias("structure"),
        F.coalesce("excluded_target", F.lit(False)).alias("excluded_target"),
        F.coalesce("components", F.array().cast(profiles.schema["components"].dataType)).alias("components"),
        management_style(F.col("name"), F.col("fund_type")).alias("management_style"),
        F.col("prospectus_title"), F.col("prospectus_published_date"),
        F.col("prospectus_source_url").alias("source_url"),
        summary_status.alias("product_summary_status"),
        F.col("summary_published_date").alias("product_summary_published_date"),
        F.col("summary_source_url").alias("product_summary_source_url"))
    cost = F.struct(
        F.coalesce("cost_status", F.lit("unavailable")).alias("status"), F.col("annualized_pct"),
        F.col("measurement_date"), F.col("summary_title").alias("source_title"),
        F.col("summary_published_date").alias("source_published_date"),
        F.col("summary_source_url").alias("source_url"))
    return base.select("code", contract.alias("contract_benchmark"), cost.alias("holding_cost"), "cost_issue")


def profile_warnings(profiles: DataFrame) -> DataFrame:
    """TXT-11. Texts that tell what could not be read; all of them reportable."""
    contract = F.col("contract_benchmark")

    def text(prefix: str, message: str) -> Column:
        return F.concat(F.lit(prefix), "code", F.lit("：" + message))

    summary = contract.product_summary_status
    texts = F.array_compact(F.array(
        F.when(contract.status == "unreadable", text("合同基准告警 ", "没有可用的招募说明书。")),
        F.when(summary == "conflict", text("产品概要告警 ", "招募说明书与人民币产品概要的合同基准不一致。")),
        F.when(summary == "unreadable", text("产品概要告警 ", "产品概要无法读取。")),
        F.when(F.col("holding_cost.status") != "parsed", text("持有费率告警 ", "没有可用的综合费率。"))))
    return profiles.select("code", F.explode(texts).alias("text"))


def notice_order(docs: DataFrame) -> DataFrame:
    """Selected notices with ``notice_seq``; at most twelve per fund by then."""
    order = Window.partitionBy("code").orderBy("published_date", F.col("announcement_id").desc())
    return docs.withColumn("notice_seq", F.row_number().over(order).cast("long"))
