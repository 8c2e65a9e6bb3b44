"""Display texts of the flat export."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navloom import fixed_values as fixed
from navloom.functions.numbers import exact_round


def label(column: Column, labels: dict[str, str], default: Column | None = None) -> Column:
    chosen = None
    for key, text in labels.items():
        chosen = F.when(column == key, text) if chosen is None else chosen.when(column == key, text)
    return chosen.otherwise(column if default is None else default)


def format_limit(status: Column, amount: Column) -> Column:
    whole = F.when(
        (amount >= 10000) & (amount % 10000 == 0),
        F.concat(F.format_number((amount / 10000).cast("long"), 0), F.lit("万元")),
    ).otherwise(F.concat(F.format_number(amount, 0), F.lit("元")))
    return (
        F.when(status == "unlimited", "正常开放")
        .when(status == "suspended", "暂停申购")
        .when((status == "unknown") | amount.isNull(), "待核实")
        .otherwise(whole)
    )


def format_rule(share_rule: Column, channel_rule: Column) -> Column:
    share = label(share_rule, fixed.SHARE_RULE_LABELS)
    channel = label(channel_rule, fixed.CHANNEL_RULE_LABELS)
    plain = (share_rule == "not applicable") & (channel_rule == "same fund-level limit")
    return F.when(plain, "不适用").otherwise(F.concat(share, F.lit("；"), channel))


def _fixed_decimals(value: str, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", exact_round(value, digits))


def format_percentage(value: str, missing: str = "待核实", sign: bool = False) -> Column:
    """``value`` here and below is a column name or SQL text."""
    shown = F.concat(_fixed_decimals(value, 2), F.lit("%"))
    if sign:
        shown = F.when(F.expr(value) >= 0, F.concat(F.lit("+"), shown)).otherwise(shown)
    return F.when(F.expr(value).isNull(), missing).otherwise(shown)


def format_correlation(value: str) -> Column:
    return F.concat(_fixed_decimals(f"({value}) * 100", 1), F.lit("%"))


def format_beta(value: str) -> Column:
    return _fixed_decimals(value, 2)


def format_cost(value: str) -> Column:
    return F.when(F.expr(value).isNull(), "--").otherwise(F.concat(_fixed_decimals(value, 2), F.lit("%/年")))


def format_turnover(value: str) -> Column:
    number = F.expr(value)
    return (
        F.when(number.isNull(), "--")
        .when(number >= 100000000, F.concat(_fixed_decimals(f"({value}) / 100000000", 2), F.lit("亿元")))
        .when(number >= 10000, F.concat(_fixed_decimals(f"({value}) / 10000", 0), F.lit("万元")))
        .otherwise(F.concat(_fixed_decimals(value, 0), F.lit("元")))
    )
