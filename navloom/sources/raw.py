"""Raw landing payloads to domain tables.

Payloads land as rows of text, one per page or per fund, so that Spark splits
them over tasks.  Each loader returns the good rows and the issues beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import (
    as_date, market_date_from_millis, period_key, utc_date_from_millis,
)
from navloom.functions.numbers import (
    cny_amount, exact_round, finite_number, group_or_null, is_finite, plain_digits, scale_100m,
)
from navloom.functions.text import strip_tags
from navloom.operators.quality import Loaded, issues_of, union_all
from navloom.session import computed


def iso_date(text: Column) -> Column:
    """First ten characters as a date; null when they are none."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def _whole(text: Column) -> Column:
    """A text that ends where its array ends; what follows an array is no JSON."""
    return F.when(F.rtrim(text).endswith("]"), text)


def unreadable(df: DataFrame, parsed: Column, code: Column, reason: str, detail: Column | None = None) -> DataFrame:
    """A fatal issue for each payload that gives nothing; its rows would vanish in silence."""
    return issues_of(df, code, F.when(parsed.isNull(), reason), detail)


def load_funds(raw: DataFrame) -> Loaded:
    """SRC-01. ``raw(seq, payload)``: JSON arrays of arrays; the last duplicate wins.

    A payload that does not parse is a fatal issue under its ``seq``.
    """
    body = F.regexp_replace(F.col("payload"), fixed.RAW_FUND_LIST_HEAD, "")
    body = F.regexp_replace(body, r";[\s]*$", "")
    parsed = raw.select("seq", F.from_json(_whole(body), "array<array<string>>").alias("list"))
    rows = parsed.select("seq", F.posexplode("list").alias("pos", "r"))
    fields = F.struct(F.col("r")[2].alias("name"), F.col("r")[3].alias("fund_type"))
    good = (
        rows.where(F.size("r") >= 4)
        .groupBy(F.col("r")[0].alias("code"))
        .agg(F.max_by(fields, F.struct("seq", "pos")).alias("last"))
        .select("code", "last.name", "last.fund_type")
    )
    return Loaded(good, unreadable(parsed, F.col("list"), F.col("seq"), "fund_list_unreadable"))


def _with_data(raw: DataFrame) -> DataFrame:
    """``raw`` with ``data``, the rows of the payload's data array, null when it has none that parses.

    Computed once for each payload: what explodes it asks for its size first.
    """
    found = computed(raw, {"found": F.regexp_extract("payload", fixed.RAW_DATA_ARRAY, 1)})
    return computed(found, {"data": F.from_json(_whole(F.col("found")), "array<array<string>>")}).drop("found")


def load_holder_periods(raw: DataFrame) -> Loaded:
    """SRC-02. ``raw(page, payload)``: report dates with a fund count; other months and bad rows are skipped.

    A payload whose data array is missing or does not parse is a fatal issue under
    its page.
    """
    parsed = _with_data(raw.select("page", "payload")).select("page", "data")
    rows = parsed.select(F.explode("data").alias("r")).where(F.size("r") >= 2)
    day = iso_date(F.col("r")[0])
    good = rows.select(
        day.alias("report_date"), F.col("r")[1].try_cast("long").alias("fund_count"),
        period_key(day).alias("period_key"),
    ).where("fund_count is not null and period_key is not null")
    return Loaded(good, unreadable(parsed, F.col("data"), F.lit("holder_periods"), "holder_periods_unreadable", F.col("page")))


def load_holders(raw: DataFrame) -> Loaded:
    """SRC-03. ``raw(period_key, page, payload)``; all announced pages must be there and parse."""
    parsed = _with_data(raw.select("period_key", "page", "payload")).select(
        "period_key", "page", "data", F.regexp_extract("payload", fixed.RAW_PAGE_COUNT, 1).try_cast("int").alias("announced"))
    rows = parsed.select("period_key", "page", F.posexplode("data").alias("pos", "r"))
    rows = rows.where(F.size("r") >= 6)

    def cell(i: int) -> Column:
        return F.replace(F.col("r")[i], F.lit(","), F.lit("")) if i == 5 else F.col("r")[i]

    def optional(i: int) -> Column:
        return F.coalesce(cell(i), F.lit("")) == ""

    good = rows.select(
        "period_key", "page", "pos", F.col("r")[0].alias("code"),
        cell(2).try_cast("double").alias("institution_pct"),
        cell(3).try_cast("double").alias("personal_pct"),
        cell(5).try_cast("double").alias("total_shares_100m"),
        (optional(3) | cell(3).try_cast("double").isNotNull()).alias("personal_ok"),
        (optional(5) | cell(5).try_cast("double").isNotNull()).alias("shares_ok"),
    ).where("institution_pct is not null and personal_ok and shares_ok")
    pages = parsed.groupBy("period_key").agg(
        F.count_distinct(F.when(F.col("data").isNotNull(), F.col("page"))).alias("seen"),
        F.max(F.when(F.col("page") == 1, F.col("announced"))).alias("announced"),
    )
    incomplete = F.when(~F.col("seen").eqNullSafe(F.col("announced")), "holder_pages_incomplete")
    detail = F.concat_ws("/", "seen", "announced")
    return Loaded(good.drop("personal_ok", "shares_ok"), union_all([
        issues_of(pages, F.col("period_key"), incomplete, detail),
        unreadable(parsed, F.col("data"), F.col("period_key"), "holder_page_unreadable", F.col("page"))]))


def load_nav(raw: DataFrame) -> Loaded:
    """SRC-04. ``raw(code, payload)`` with one NAV history each; last row of a day wins."""
    kind = "array<struct<x:string,y:string,equityReturn:string,unitMoney:string>>"
    points = F.from_json(F.regexp_extract("payload", fixed.RAW_NAV, 1), kind)
    parsed = computed(raw.select("code", "payload"), {"points": points}).select("code", "points")
    rows = parsed.select("code", F.posexplode("points").alias("pos", "p"))
    millis = F.col("p.x").try_cast("double")
    blank = F.coalesce(F.col("p.equityReturn"), F.lit("")) == ""
    checked = rows.select(
        "code", "pos",
        market_date_from_millis(F.floor(millis)).alias("date"),
        F.col("p.y").try_cast("double").alias("nav"),
        F.when(~blank, F.col("p.equityReturn").try_cast("double")).alias("equity_return_pct"),
        F.coalesce("p.unitMoney", F.lit("")).alias("unit_money"),
        (~blank & F.col("p.equityReturn").try_cast("double").isNull()).alias("bad_return"),
    )
    reason = (
        F.when(F.col("date").isNull(), "nav_point_invalid")
        .when(~is_finite(F.col("nav")) | (F.col("nav") <= 0), "nav_value_invalid")
        .when(F.col("bad_return"), "daily_return_invalid")
    )
    flagged = checked.withColumn("reason", reason)
    good = (
        flagged.where("reason is null")
        .groupBy("code", "date")
        .agg(F.max_by(F.struct("nav", "equity_return_pct", "unit_money"), "pos").alias("p"))
        .select("code", "date", "p.*")
    )
    missing = F.when(F.coalesce(F.size("points"), F.lit(-1)) <= 0, "nav_history_missing")
    return Loaded(good, union_all([
        issues_of(flagged, F.col("code"), F.col("reason"), F.col("date")),
        issues_of(parsed, F.col("code"), missing),
    ]))


def series_conflicts(points: DataFrame) -> DataFrame:
    """AG-12. Dates on which a keyed series holds different values."""
    spread = points.groupBy("date").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return spread.where(F.col("high") - F.col("low") > fixed.SERIES_TOLERANCE)


def _checked_series(points: DataFrame, as_of, label: str) -> Loaded:
    """Shared rules of dated positive series: cut, validity, conflicts, not empty."""
    bad_shape = points.where("date is null or value is null")
    visible = points.where(F.col("date") <= as_date(as_of))
    invalid = F.when(~is_finite(F.col("value")) | (F.col("value") <= 0), f"{label}_value_invalid")
    good = visible.where(is_finite(F.col("value")) & (F.col("value") > 0))
    empty = good.agg(F.count(F.lit(1)).alias("n"))
    return Loaded(
        good.groupBy("date").agg(F.max("value").alias("value")),
        union_all([
            issues_of(bad_shape, F.lit(label), F.lit(f"{label}_row_invalid")),
            issues_of(visible.where("value is not null"), F.lit(label), invalid, F.col("date")),
            issues_of(series_conflicts(good), F.lit(label), F.lit(f"{label}_conflict"), F.col("date")),
            issues_of(empty, F.lit(label), F.when(F.col("n") == 0, f"{label}_empty")),
        ]),
    )


def load_index_levels(raw: DataFrame, as_of) -> Loaded:
    """SRC-05. ``raw(payload)``: JSON points with epoch milliseconds in UTC."""
    kind = "array<struct<x:string,y:string>>"
    parsed = raw.select(F.from_json(_whole(F.col("payload")), kind).alias("list"))
    rows = parsed.select(F.explode("list").alias("p"))
    millis = F.col("p.x").try_cast("double")
    points = rows.select(
        utc_date_from_millis(millis).alias("date"), F.col("p.y").try_cast("double").alias("value")
    )
    checked = _checked_series(points, as_of, "index")
    return Loaded(checked.rows, checked.issues.unionByName(
        unreadable(parsed, F.col("list"), F.lit("index"), "index_payload_unreadable")))


def load_fx_html(raw: DataFrame, as_of) -> Loaded:
    """SRC-06. ``raw(payload)``: HTML tables quoting CNY per 100 units."""
    rows = raw.select(F.explode(html_cells(F.col("payload"), "tr", "td")).alias("cells"))
    dated = rows.where((F.size("cells") >= 2) & F.col("cells")[0].rlike(r"^\d{4}-\d{2}-\d{2}$"))
    points = dated.select(
        iso_date(F.col("cells")[0]).alias("date"),
        (plain_digits(F.col("cells")[1]).try_cast("double") / 100).alias("value"),
    )
    return _checked_series(points, as_of, "fx")


def html_cells(html: Column, row_tag: str, cell_tag: str) -> Column:
    """Texts of the cells of every row, as an array of arrays."""
    def inner(text: Column, tag: str) -> Column:
        return F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))

    return F.transform(
        inner(html, row_tag), lambda row: F.transform(inner(row, cell_tag), strip_tags)
    )


def purchase_status(state: Column, buy_status: Column, is_sale: Column) -> Column:
    """PRJ-03. Suspended beats limited, limited beats open."""
    return (
        F.when(state.contains("暂停申购") | (F.coalesce(buy_status, F.lit("")) == "4")
               | (F.coalesce(is_sale, F.lit(True)) == F.lit(False)), "suspended")
        .when(state.contains("限大额"), "limited")
        .when(state.contains("开放申购")
              | ((F.coalesce(buy_status, F.lit("")) == "1") & F.coalesce(is_sale, F.lit(False))), "open")
        .otherwise("unknown")
    )


def extract_fund_pages(pages: DataFrame) -> Loaded:
    """SRC-07. ``pages(code, html)`` to the fund profile table."""
    def part(pattern: str, group: int = 1, source: str = "html") -> Column:
        return group_or_null(F.regexp_extract(source, "(?U)" + pattern, group))

    base = pages.withColumn("state", strip_tags(F.regexp_extract("html", fixed.PAGE_STATE, 1)))
    # The groups become columns first, so that each pattern runs once per page.
    parts = base.select(
        "code", "state", part(fixed.PAGE_INCEPTION).alias("inception"),
        *[part(fixed.PAGE_SCALE, i).alias(f"scale_{i}") for i in (1, 2, 3)],
        part(fixed.PAGE_BUY_STATUS).alias("buy_status"), part(fixed.PAGE_IS_SALE).alias("is_sale"),
        *[part(fixed.PAGE_LIMIT, i, "state").alias(f"limit_{i}") for i in (1, 2)],
        *[part(fixed.PAGE_LATEST_NAV, i).alias(f"nav_{i}") for i in (1, 2)])
    out = parts.select(
        "code", iso_date(F.col("inception")).alias("inception_date"),
        scale_100m(F.col("scale_1"), F.col("scale_2")).alias("scale_100m_cny"),
        iso_date(F.col("scale_3")).alias("scale_report_date"),
        purchase_status(F.col("state"), F.col("buy_status"), F.col("is_sale") == "true").alias("purchase_status"),
        F.col("state").alias("purchase_status_text"),
        cny_amount(F.col("limit_1"), F.col("limit_2")).alias("page_agency_limit_cny"),
        iso_date(F.col("nav_1")).alias("latest_nav_date"), finite_number(F.col("nav_2")).alias("latest_nav_value"),
        F.format_string(fixed.FUND_PAGE_URL.replace("{}", "%s"), "code").alias("fund_page_url"),
    )
    reason = F.when(F.col("scale_100m_cny").isNull(), "scale_missing").when(
        F.col("inception_date").isNull(), "inception_missing"
    )
    flagged = out.withColumn("scale_100m_cny", exact_round("scale_100m_cny", 4)).withColumn("reason", reason)
    return Loaded(flagged.where("reason is null").drop("reason"),
                  issues_of(flagged, F.col("code"), F.col("reason")))


# Where from_json keeps a payload that does not fit the schema.
_CORRUPT = {"columnNameOfCorruptRecord": "_corrupt_record"}


def load_announcements(raw: DataFrame) -> Loaded:
    """SRC-08, first half. ``raw(code, page, payload)``; rows with blanks are dropped.

    A page that does not parse is a fatal issue of its fund, and so is a row whose
    date is none; an index without rows is none.
    """
    kind = "struct<Data:array<struct<ID:string,TITLE:string,PUBLISHDATEDesc:string>>,_corrupt_record:string>"
    parsed = raw.select("code", "page", F.from_json("payload", kind, _CORRUPT).alias("j"))
    rows = parsed.select("code", "page", F.explode("j.Data").alias("a"))
    out = rows.select(
        "code", F.trim("a.ID").alias("announcement_id"), F.trim("a.TITLE").alias("title"),
        F.trim("a.PUBLISHDATEDesc").alias("stated"), iso_date(F.trim("a.PUBLISHDATEDesc")).alias("published_date"),
        (F.col("page") == 1).alias("on_latest_page"),
    ).where("announcement_id != '' and title != '' and stated != ''")
    whole = F.when(F.col("j").isNotNull() & F.col("j._corrupt_record").isNull(), True)
    return Loaded(out.where("published_date is not null").drop("stated"), union_all([
        unreadable(parsed, whole, F.col("code"), "announcement_page_unreadable", F.col("page")),
        unreadable(out, F.col("published_date"), F.col("code"), "announcement_date_invalid", F.col("announcement_id"))]))


def merge_announcements(old: DataFrame, new: DataFrame, as_of) -> DataFrame:
    """SRC-08. Upsert by id, the newly landed row wins; only rows published by ``as_of``."""
    both = old.select("code", "announcement_id", "title", "published_date",
                      F.lit(False).alias("on_latest_page"), F.lit(0).alias("turn")).unionByName(
        new.select("code", "announcement_id", "title", "published_date", "on_latest_page",
                   F.lit(1).alias("turn")))
    rows = both.groupBy("code", "announcement_id").agg(
        F.max_by(F.struct("title", "published_date"), "turn").alias("a"),
        F.bool_or("on_latest_page").alias("on_latest_page"),
    )
    return rows.select("code", "announcement_id", "a.*", "on_latest_page").where(
        F.col("published_date") <= as_date(as_of))


def invisible_announcements(codes: DataFrame, announcements: DataFrame, as_of) -> DataFrame:
    """SRC-08. A fund without any announcement published by ``as_of`` is fatal."""
    seen = announcements.where(F.col("published_date") <= as_date(as_of)).select("code").distinct()
    return issues_of(codes.join(seen, "code", "left_anti"), F.col("code"), F.lit("announcements_missing"))


def document_url(announcement_id: Column) -> Column:
    return F.format_string(fixed.DOCUMENT_URL.replace("{}", "%s"), announcement_id)


def load_quotes(raw: DataFrame) -> Loaded:
    """SRC-11. ``raw(arrival, payload)``: positional quote fields renamed.

    A payload without a list of quotes is a fatal issue under its arrival.
    """
    kind = ("struct<data:struct<diff:array<struct<f2:string,f3:string,f6:string,f12:string,"
            "f14:string,f124:string,f297:string,f402:string,f441:string>>>>")
    parsed = raw.select("arrival", F.from_json("payload", kind).data.diff.alias("diff"))
    rows = parsed.select("arrival", F.explode("diff").alias("q"))
    good = rows.select(
        F.col("q.f12").alias("code"), F.col("arrival").cast("long").alias("arrival"),
        finite_number(F.col("q.f2")).alias("price"), finite_number(F.col("q.f441")).alias("iopv"),
        finite_number(F.col("q.f402")).alias("source_discount_pct"),
        finite_number(F.col("q.f3")).alias("change_pct"),
        finite_number(F.col("q.f6")).alias("turnover_cny"),
        F.col("q.f297").alias("quote_date_raw"),
        F.col("q.f124").try_cast("long").alias("updated_seconds"),
        F.trim("q.f14").alias("quote_name"),
    )
    return Loaded(good, unreadable(parsed, F.col("diff"), F.col("arrival"), "quote_page_unreadable"))


def merge_series(old: DataFrame, new: DataFrame, as_of, years: int = fixed.BENCHMARK_WINDOW_YEARS) -> DataFrame:
    """SRC-12. Stored and newly landed points of one series; the new value wins."""
    from navloom.operators.timeseries import required_start

    both = old.select("date", "value", F.lit(0).alias("turn")).unionByName(
        new.select("date", "value", F.lit(1).alias("turn")))
    first = F.date_sub(required_start(as_of, years), fixed.MAX_STALENESS_DAYS)
    kept = both.where(F.col("date").between(first, as_date(as_of)))
    return kept.groupBy("date").agg(F.max_by("value", "turn").alias("value"))


def refresh_series(stored: DataFrame, landed: Loaded, as_of, label: str,
                   years: int = fixed.BENCHMARK_WINDOW_YEARS) -> tuple[Loaded, DataFrame]:
    """SRC-12. A stored series with what landed, and the warnings.

    What landed with a fatal issue is left out as a whole.  While the stored series has
    points, that is a warning with its latest date; without any the issues stay.
    """
    failed = not landed.issues.where("severity = 'fatal'").isEmpty()
    kept = merge_series(stored, landed.rows.where("false") if failed else landed.rows, as_of, years)
    latest = kept.agg(F.max("date").alias("latest"))
    text = F.format_string(f"纳指100基准更新失败，使用完整缓存：{label} 最新数据 %s。", F.col("latest").cast("string"))
    warnings = latest.where(F.lit(failed) & F.col("latest").isNotNull()).select(
        F.lit(0).cast("long").alias("seq"), text.alias("text"))
    fallen_back = failed and not kept.isEmpty()
    return Loaded(kept, landed.issues.where("severity <> 'fatal'") if fallen_back else landed.issues), warnings
