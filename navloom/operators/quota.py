"""Subscription-limit state from a log of notices.

Each transition overwrites a channel without looking at its old value, so the
state is the last transition that touches the channel: an aggregate, no loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.dates import as_date

_LIMIT = "struct<status:string,amount_cny:bigint,effective_date:date,source_url:string,confidence:string>"


def select_notices(announcements: DataFrame, *, as_of) -> DataFrame:
    """FLT-09. Titles about limits, 550 days back, the last 12 of each fund.

    Equal dates are listed by id descending, so the smaller id counts as later.
    The rank filter is a group limit: each task keeps at most 12 rows per fund
    before the shuffle.
    """
    chosen = announcements.where(
        F.col("title").rlike(fixed.QUOTA_TITLE)
        & F.col("published_date").between(
            F.date_sub(as_date(as_of), fixed.NOTICE_LOOKBACK_DAYS), as_date(as_of)))
    newest = Window.partitionBy("code").orderBy(
        F.col("published_date").desc(), F.col("announcement_id"))
    return chosen.withColumn("recency", F.row_number().over(newest)).where(
        F.col("recency") <= fixed.NOTICE_LIMIT)


def on_latest_page(announcements: DataFrame) -> DataFrame:
    """JN-07. Rows of the latest page; a fund without any keeps all its rows.

    Funds with a latest page are few columns wide, so the anti join ships keys only,
    but they are as many as the funds: it is merged.
    """
    listed = announcements.where("on_latest_page").select("code").distinct()
    whole = announcements.where("not on_latest_page").join(listed.hint("merge"), "code", "left_anti")
    return announcements.where("on_latest_page").unionByName(whole)


def _limit(status, amount, effective, source, confidence) -> Column:
    return F.struct(
        F.lit(status) if isinstance(status, str) else status,
        amount, effective, source, confidence,
    ).cast(_LIMIT)


def _touch(own: Column, other: Column) -> Column:
    """What one transition does to a channel, or null when it leaves it alone."""
    restored = own.isNull() & other.isNull() & (F.coalesce("global_status", F.lit("limited")) == "unlimited")
    amount = F.coalesce(own, F.col("global_amount_cny"))
    common = (F.col("effective_date"), F.col("source_url"), F.coalesce("confidence", F.lit("medium")))
    return (
        F.when(restored, _limit("unlimited", F.lit(None).cast("long"), *common))
        .when(amount.isNotNull(), _limit("limited", amount, *common))
    )


def _events(transitions: DataFrame, as_of) -> DataFrame:
    """Effective transitions with what they touch and their place in the log."""
    direct = _touch(F.col("direct_amount_cny"), F.col("agency_amount_cny"))
    agency = _touch(F.col("agency_amount_cny"), F.col("direct_amount_cny"))
    place = F.struct("effective_date", "published_date", "notice_seq", "transition_seq")
    return transitions.where(F.col("effective_date") <= as_date(as_of)).select(
        "code", "published_date", place.alias("place"), direct.alias("direct"), agency.alias("agency"),
        "share_aggregation", "all_channels_combined", "source_url")


def _survivors(transitions: DataFrame, failed: DataFrame, as_of) -> DataFrame:
    """Events later than the last unreadable notice of their fund."""
    last_failed = failed.groupBy("code").agg(F.max("published_date").alias("failed_date"))
    events = _events(transitions, as_of).join(last_failed, "code", "left")
    return events.where("failed_date is null or published_date > failed_date")


def quota_state(pages: DataFrame, transitions: DataFrame, failed: DataFrame, *, as_of) -> DataFrame:
    """WIN-07. Limit state of every fund in ``pages``.

    ``failed(code, published_date)`` are selected notices without a result; they
    void the page state and all transitions published up to them.  Events are
    first combined per fund and publication day, which bounds what a single
    fund brings to the second step.
    """
    last = {name: F.max_by(F.struct(name, "place"), F.when(F.col(name).isNotNull(), F.col("place")))
            for name in ("direct", "agency", "share_aggregation")}
    daily = _events(transitions, as_of).groupBy("code", "published_date").agg(
        *[value.alias(name) for name, value in last.items()],
        F.bool_or("all_channels_combined").alias("combined"))
    failures = failed.groupBy("code", "published_date").agg(F.lit(True).alias("failed"))
    both = daily.join(failures, ["code", "published_date"], "full_outer")
    failed_date = F.max(F.when(F.col("failed"), F.col("published_date"))).over(Window.partitionBy("code"))
    both = both.withColumn("failed_date", failed_date)
    alive = F.col("failed_date").isNull() | (F.col("published_date") > F.col("failed_date"))

    def latest(name: str) -> Column:
        known = alive & F.col(f"{name}.{name}").isNotNull()
        return F.max_by(F.col(f"{name}.{name}"), F.when(known, F.col(f"{name}.place")))

    folded = both.groupBy("code").agg(
        latest("direct").alias("direct_event"), latest("agency").alias("agency_event"),
        latest("share_aggregation").alias("share_rule"),
        F.bool_or(alive & F.col("combined")).alias("combined"),
        F.max("failed_date").alias("failed_date"))
    return _finish(pages.join(folded, "code", "left"))


def _finish(df: DataFrame) -> DataFrame:
    """Initial page state under the folded events, then the overall verdict."""
    none = F.lit(None)
    unknown = _limit("unknown", none, none, none, F.lit("low"))
    unlimited = _limit("unlimited", none, none, none, F.lit("medium"))
    page_limit = F.col("page_agency_limit_cny")
    is_open = (F.col("purchase_status") == "open") & page_limit.isNull()
    void = F.col("failed_date").isNotNull()
    first_direct = F.when(~void & is_open, unlimited).otherwise(unknown)
    first_agency = (
        F.when(void, unknown).when(is_open, unlimited)
        .when(page_limit != 0, _limit("limited", page_limit, none, F.col("fund_page_url"), F.lit("medium")))
        .otherwise(unknown))
    state = df.withColumns({
        "direct_limit": F.coalesce("direct_event", first_direct),
        "agency_limit": F.coalesce("agency_event", first_agency),
    })
    direct, agency = F.col("direct_limit.status"), F.col("agency_limit.status")
    is_unknown = (direct == "unknown") | (agency == "unknown")
    is_limited = (direct == "limited") | (agency == "limited")
    both_high = (F.col("direct_limit.confidence") == "high") & (F.col("agency_limit.confidence") == "high")
    differ = ~F.col("direct_limit.amount_cny").eqNullSafe(F.col("agency_limit.amount_cny"))
    return state.select(
        "code", "direct_limit", "agency_limit",
        F.when(is_unknown, "unknown").when(is_limited, "limited").otherwise("unlimited").alias("quota_status"),
        F.when(is_unknown, "low").when(is_limited & both_high, "high").otherwise("medium")
        .alias("quota_confidence"),
        F.coalesce("share_rule", F.lit("not applicable")).alias("share_class_rule"),
        F.when(F.coalesce("combined", F.lit(False)), "all sales channels combined")
        .when(differ, "direct and agency limits differ").otherwise("same fund-level limit")
        .alias("channel_rule"),
        void.alias("has_unparsed_notice"))


def quota_sources(transitions: DataFrame, failed: DataFrame, *, as_of) -> DataFrame:
    """WIN-07. Distinct ``(code, source_url)`` of surviving events that touch a channel."""
    events = _survivors(transitions, failed, as_of)
    touching = events.where("direct is not null or agency is not null")
    return touching.select("code", "source_url").distinct()


def direct_limit_ok(status: Column, amount: Column, threshold: int = fixed.MIN_DIRECT_LIMIT_CNY) -> Column:
    """FLT-07. Unlimited, or limited to at least the threshold."""
    return (status == "unlimited") | (
        (status == "limited") & F.coalesce(amount >= threshold, F.lit(False)))


def quota_gate(threshold: int = fixed.MIN_DIRECT_LIMIT_CNY) -> Column:
    """FLT-12. Exclusion reason of a routed fund; null passes."""
    status, amount = F.col("direct_limit.status"), F.col("direct_limit.amount_cny")
    unresolved = status.isNull() | F.coalesce("has_unparsed_notice", F.lit(False)) | (status == "unknown")
    return (
        F.when(unresolved, "quota_unresolved")
        .when(~direct_limit_ok(status, amount, threshold), "direct_limit_below_threshold")
    )


def quota_warnings(gated: DataFrame) -> DataFrame:
    """WIN-07, FLT-12. Texts for unknown limits and for the funds they exclude."""
    unknown = F.col("quota_status") == "unknown"
    status = F.col("direct_limit.status")
    detail = (
        F.when(status.isNull(), "额度结果缺失")
        .when(F.col("has_unparsed_notice"), "存在无法解析的有效期内额度公告。")
        .when(status == "unknown", "直销额度无法可靠解析。"))
    texts = F.array_compact(F.array(
        F.when(unknown, F.concat("code", F.lit(" 的申购额度无法确定；引用前请核对关联公告。"))),
        F.when(detail.isNotNull(), F.concat(F.lit("额度剔除 "), "code", F.lit("："), detail))))
    return gated.select("code", F.explode(texts).alias("text"))
