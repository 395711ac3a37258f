"""Screening of cart, checkout and card rows: the first broken rule, or NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Currency codes of ISO 4217.
ISO_4217 = (
    "AED AFN ALL AMD ANG AOA ARS AUD AWG AZN BAM BBD BDT BGN BHD BIF BMD BND BOB BOV BRL BSD BTN "
    "BWP BYN BZD CAD CDF CHE CHF CHW CLF CLP CNY COP COU CRC CUC CUP CVE CZK DJF DKK DOP DZD EGP "
    "ERN ETB EUR FJD FKP GBP GEL GHS GIP GMD GNF GTQ GYD HKD HNL HRK HTG HUF IDR ILS INR IQD IRR "
    "ISK JMD JOD JPY KES KGS KHR KMF KPW KRW KWD KYD KZT LAK LBP LKR LRD LSL LYD MAD MDL MGA MKD "
    "MMK MNT MOP MRU MUR MVR MWK MXN MXV MYR MZN NAD NGN NIO NOK NPR NZD OMR PAB PEN PGK PHP PKR "
    "PLN PYG QAR RON RSD RUB RWF SAR SBD SCR SDG SEK SGD SHP SLL SOS SRD SSP STN SVC SYP SZL THB "
    "TJS TMT TND TOP TRY TTD TWD TZS UAH UGX USD USN UYI UYU UYW UZS VES VND VUV WST XAF XAG XAU "
    "XBA XBB XBC XBD XCD XDR XOF XPD XPF XPT XSU XTS XUA XXX YER ZAR ZMW ZWL"
).split()

EMAIL = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]([A-Za-z0-9-]*[A-Za-z0-9])?$"

VISA = r"^4\d{12}(\d{3})?(\d{3})?$"
MASTERCARD = r"^(5[1-5]\d{2}|222[1-9]|22[3-9]\d|2[3-6]\d{2}|27[01]\d|2720)\d{12}$"


def digits(number: Column) -> Column:
    return F.regexp_replace(number, "[ -]", "")


def valid_card(number: Column) -> Column:
    """12 to 19 digits in blocks of at least three, with a good check digit."""
    blocks = number.rlike(r"^\d{3,}( \d{3,})*$")
    plain = F.regexp_replace(number, " ", "")
    return blocks & F.length(plain).between(12, 19) & F.call_function("luhn_check", plain)


def brand(number: Column) -> Column:
    plain = digits(number)
    return F.when(plain.rlike(VISA), "visa").when(plain.rlike(MASTERCARD), "mastercard").otherwise("other")


def last_four(number: Column) -> Column:
    return F.right(number, F.lit(4))


def _first(rules: list[tuple[Column, str]]) -> Column:
    """Name of the first rule that does not hold; NULL input breaks a rule."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in rules]
    return F.coalesce(*broken)


def _text(column: str, longest: int | None = None) -> Column:
    c = F.col(column)
    ok = c != ""
    return ok if longest is None else ok & (F.length(c) <= longest)


def cart_error() -> Column:
    return _first([(F.col("quantity").between(1, 10), "quantity"), (_text("product_id"), "product_id")])


def checkout_error() -> Column:
    number = lambda c: F.col(c) != 0
    return _first(
        [
            (_text("email") & F.col("email").rlike(EMAIL), "email"),
            (_text("street_address", 512), "street_address"),
            (number("zip_code"), "zip_code"),
            (_text("city", 128), "city"),
            (_text("state", 128), "state"),
            (_text("country", 128), "country"),
            (_text("cc_number") & valid_card(F.col("cc_number")), "cc_number"),
            (F.col("cc_month").between(1, 12), "cc_month"),
            (number("cc_year"), "cc_year"),
            (number("cc_cvv"), "cc_cvv"),
        ]
    )


def currency_error() -> Column:
    return _first([(F.col("currency").isin(*ISO_4217), "currency")])


def card_error(year: int | Column, month: int | Column) -> Column:
    """Invalid number, then a brand that is not taken, then an expired card."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    now = as_col(year) * 12 + as_col(month)
    plain = digits(F.col("cc_number"))
    good = plain.rlike(r"^\d{12,19}$") & F.call_function("luhn_check", plain)
    return _first(
        [
            (good, "invalid"),
            (brand(F.col("cc_number")).isin("visa", "mastercard"), "unaccepted"),
            (F.col("cc_year") * 12 + F.col("cc_month") >= now, "expired"),
        ]
    )


def screen(rows: DataFrame, error: Column) -> DataFrame:
    return rows.withColumn("first_error", error)


def split(screened: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)"""
    return (
        screened.where(F.col("first_error").isNull()).drop("first_error"),
        screened.where(F.col("first_error").isNotNull()),
    )

