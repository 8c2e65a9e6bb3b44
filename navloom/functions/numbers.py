"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1 halves a 53-bit mantissa
_WHOLE = 4503599627370496.0  # 2**52: doubles from here on are whole numbers


def is_finite(x: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    # NaN sorts above every number, so it is not below infinity either.
    return F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))


def finite_number(text: Column) -> Column:
    """Text to double; anything that is not a finite number becomes null."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def exact_round(x: str, digits: int = 0) -> Column:
    """Round the binary value of ``x`` half to even, as IEEE decimal output does.

    ``x`` is a column name or SQL text.  ``round`` works on the shortest decimal
    text, so 2.675 would become 2.68 although its binary value lies below the
    tie.  The product ``x * 10**digits`` is therefore taken with its rounding
    error, which only an exact tie needs.  Adding 0.0 drops a negative zero.
    """
    return F.expr(exact_round_sql(x, digits))


def exact_round_sql(x: str, digits: int) -> str:
    scale = f"{float(10**digits)}D"
    product = f"(({x}) * {scale})"
    high = f"(({x}) * {_SPLIT}D - (({x}) * {_SPLIT}D - ({x})))"
    error = f"(({high} * {scale} - {product}) + (({x}) - {high}) * {scale})"
    return (
        f"CASE WHEN abs({product}) >= {_WHOLE}D THEN ({x})"
        f" WHEN abs({product} - floor({product}) - 0.5D) <> 0D OR {error} = 0D"
        f" THEN rint({product}) / {scale} + 0.0D"
        f" WHEN {error} > 0D THEN (floor({product}) + 1) / {scale} + 0.0D"
        f" ELSE floor({product}) / {scale} + 0.0D END"
    )


def plain_digits(text: Column) -> Column:
    """Drop thousands commas and map full-width digits to ASCII."""
    return F.translate(text, "０１２３４５６７８９,", "0123456789")


def group_or_null(extracted: Column) -> Column:
    """A regular-expression group, with "no match" as null."""
    return F.when(extracted != "", extracted)


def cny_amount(value: Column, unit: Column) -> Column:
    """Amount text with 万元 or 元 to whole CNY."""
    number = finite_number(plain_digits(value))
    return F.rint(number * F.when(unit == "万元", 10000.0).otherwise(1.0)).cast("long")


def scale_100m(value: Column, unit: Column) -> Column:
    """Amount text with 亿元, 万元 or 元 to units of 10**8 CNY."""
    number = finite_number(plain_digits(value))
    return number / F.when(unit == "亿元", 1.0).when(unit == "万元", 10000.0).otherwise(100000000.0)


def annualized(total_return_pct: Column, days: Column) -> Column:
    """Yearly growth in percent; null for a span or return that cannot be."""
    total = total_return_pct / 100
    grown = F.pow(1 + total, F.lit(365.0) / F.nullif(days.cast("double"), F.lit(0.0)))
    return F.when((days > 0) & (total > -1), (grown - 1) * 100)


def return_drawdown_ratio(annualized_pct: Column, drawdown_pct: Column) -> Column:
    """Yearly growth over the absolute drawdown; null without a drawdown."""
    return annualized_pct / F.nullif(F.abs(drawdown_pct), F.lit(0.0))


def premium_pct(price: Column, iopv: Column) -> Column:
    return (price / F.nullif(iopv, F.lit(0.0)) - 1) * 100


def premium_tolerance(iopv: Column) -> Column:
    """Price-tick tolerance in percentage points."""
    return F.greatest(F.lit(0.05), 0.0005 / F.nullif(iopv, F.lit(0.0)) * 100 + 0.01)


def premium_check(price: Column, iopv: Column, discount: Column) -> Column:
    """True when the quoted discount agrees with price over IOPV."""
    return F.abs(-discount - premium_pct(price, iopv)) <= premium_tolerance(iopv)


def premium_band(premium: Column) -> Column:
    return (
        F.when(premium.isNull(), "unavailable")
        .when(premium < 0, "discount")
        .when(premium <= 2, "normal")
        .when(premium <= 5, "elevated")
        .otherwise("high")
    )


def reduction_pct(before: Column, after: Column) -> Column:
    """How much smaller ``after`` is, in percent of ``before``."""
    return F.when(before <= 0, 0.0).otherwise(
        (before - after) / F.nullif(before.cast("double"), F.lit(0.0)) * 100
    )
