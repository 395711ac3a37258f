"""Money = (currency_code, units, nanos); both numbers carry the same sign."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000_000
AMOUNT = "decimal(28,9)"
TOTAL = "decimal(38,9)"
# Widest type whose sums and products below keep all nine decimals.
FACTOR = "decimal(27,9)"
ADDEND = "decimal(37,9)"

ERR_INVALID = "one of the specified money values is invalid"
ERR_CURRENCY = "mismatching currency codes"

# Symbol shown before an amount; every other code shows "$".
SYMBOLS = {
    "USD": "$",
    "CAD": "$",
    "JPY": "¥",
    "EUR": "€",
    "TRY": "₺",
    "GBP": "£",
}

# Currencies the shop offers for display.
SHOP_CURRENCIES = ("USD", "EUR", "CAD", "JPY", "GBP", "TRY")


def amount(units: Column, nanos: Column) -> Column:
    """units + nanos / 10^9, exactly."""
    return (
        units.cast("decimal(19,0)") + nanos.cast("decimal(10,0)") * F.expr("0.000000001BD")
    ).cast(AMOUNT)


def units_of(total: Column) -> Column:
    """Whole units, cut toward zero."""
    return total.cast("bigint")


def nanos_of(total: Column) -> Column:
    """The fraction in nanos, with the sign of the amount."""
    return ((total % 1).cast("decimal(10,9)") * NANOS).cast("bigint")


def line_total(price: Column, quantity: Column) -> Column:
    """price x quantity without losing a digit: 27 + 10 digits and a carry fit 38."""
    return (price.cast(FACTOR) * quantity.cast("decimal(10,0)")).cast(TOTAL)


def is_valid(units: Column, nanos: Column) -> Column:
    same_sign = (units == 0) | (nanos == 0) | (F.signum(units) == F.signum(nanos))
    return same_sign & (F.abs(nanos) < NANOS)


def is_zero(units: Column, nanos: Column) -> Column:
    return (units == 0) & (nanos == 0)


def is_positive(units: Column, nanos: Column) -> Column:
    return (is_valid(units, nanos) & (units > 0)) | ((units == 0) & (nanos > 0))


def is_negative(units: Column, nanos: Column) -> Column:
    return (is_valid(units, nanos) & (units < 0)) | ((units == 0) & (nanos < 0))


def same_currency(left: Column, right: Column) -> Column:
    return (left == right) & (left != "")


def equals(left: Column, right: Column) -> Column:
    """Both are money structs."""
    return (
        (left["currency_code"] == right["currency_code"])
        & (left["units"] == right["units"])
        & (left["nanos"] == right["nanos"])
    )


def negate(money: Column) -> Column:
    return F.struct(
        money["currency_code"].alias("currency_code"),
        (-money["units"]).alias("units"),
        (-money["nanos"]).alias("nanos"),
    )


def sum_error(left: Column, right: Column) -> Column:
    """Why two money structs cannot be added; NULL when they can."""
    both_valid = is_valid(left["units"], left["nanos"]) & is_valid(right["units"], right["nanos"])
    return (
        F.when(~both_valid, F.lit(ERR_INVALID))
        .when(left["currency_code"] != right["currency_code"], F.lit(ERR_CURRENCY))
    )


def money_sum(left: Column, right: Column) -> Column:
    """Sum of two money structs, NULL where :func:`sum_error` is set.

    Added as one decimal and split again, so carry and borrow need no cases.
    """
    total = (
        amount(left["units"], left["nanos"]) + amount(right["units"], right["nanos"])
    ).cast(TOTAL)
    return F.when(sum_error(left, right).isNull(), to_money(total, left["currency_code"]))


def to_money(total: Column, currency: Column) -> Column:
    return F.struct(
        currency.alias("currency_code"),
        units_of(total).alias("units"),
        nanos_of(total).alias("nanos"),
    )


def times(price: Column, quantity: Column) -> Column:
    """price x quantity; a quantity of 0 counts once, as repeated addition does."""
    return line_total(price, F.greatest(quantity, F.lit(1)))


def render(currency: Column, units: Column, nanos: Column) -> Column:
    """``<symbol><units>.<two digits>``"""
    pairs = [F.lit(part) for pair in SYMBOLS.items() for part in pair]
    symbol = F.coalesce(F.try_element_at(F.create_map(*pairs), currency), F.lit("$"))
    cents = (nanos / F.lit(10_000_000)).cast("bigint")
    return F.format_string("%s%d.%02d", symbol, units, cents)


def from_price_text(text: Column) -> tuple[Column, Column]:
    """(units, nanos) of a feed's price text; text that is no number counts as 0."""
    value = text.try_cast("double")
    # Not a number, or more than whole units can hold: no price either.
    value = F.when(~F.isnan(value) & (F.abs(value) < 2.0**63), value).otherwise(F.lit(0.0))
    units = value.cast("bigint")
    # Half-even, the rounding the feed loader applies to the nano part.
    nanos = F.bround((value - units) * F.lit(1e9)).cast("bigint")
    return units, nanos
