"""Currency conversion over the fixed euro rate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.steps import computed_once

# Units of each currency per euro, as published in the rate file.
RATES = {
    "EUR": "1.0",
    "USD": "1.1305",
    "JPY": "126.40",
    "BGN": "1.9558",
    "CZK": "25.592",
    "DKK": "7.4609",
    "GBP": "0.85970",
    "HUF": "315.51",
    "PLN": "4.2996",
    "RON": "4.7463",
    "SEK": "10.5375",
    "CHF": "1.1360",
    "ISK": "136.80",
    "NOK": "9.8040",
    "HRK": "7.4210",
    "RUB": "74.4208",
    "TRY": "6.1247",
    "AUD": "1.6072",
    "BRL": "4.2682",
    "CAD": "1.5128",
    "CNY": "7.5857",
    "HKD": "8.8743",
    "IDR": "15999.40",
    "ILS": "4.0875",
    "INR": "79.4320",
    "KRW": "1275.05",
    "MXN": "21.7999",
    "MYR": "4.6289",
    "NZD": "1.6679",
    "PHP": "59.083",
    "SGD": "1.5349",
    "THB": "36.012",
    "ZAR": "16.0583",
}


def rate_map(rates: dict[str, str] | None = None) -> Column:
    """The rates as one literal map: a lookup needs neither join nor broadcast.

    A currency table holds at most the ISO codes, so its size is bounded.
    """
    rates = RATES if rates is None else rates
    parts = [F.lit(v) for code, rate in rates.items() for v in (code, float(rate))]
    return F.create_map(*parts)


def rate_of(currency: Column, rates: dict[str, str] | None = None) -> Column:
    return F.try_element_at(rate_map(rates), currency)


def supported_currencies(spark: SparkSession, rates: dict[str, str] | None = None) -> DataFrame:
    return spark.range(1).select(F.explode(F.map_keys(rate_map(rates))).alias("currency_code"))


def _whole(x: Column) -> Column:
    return F.floor(x).cast("double")


def with_converted(rows: DataFrame, money: Column, to_code: Column, name: str,
                   rates: dict[str, str] | None = None) -> DataFrame:
    """Adds ``name``: the money struct in another currency, NULL without a rate.

    Works in doubles and in a fixed order of steps (to euro, carry, round the
    nanos, to the target, carry, floor), because the last nano depends on it.
    Every step is computed once, whatever refers to it later. An amount
    already in the target currency is returned unchanged.
    """
    billion = F.lit(1e9)

    def carry(units: Column, nanos: Column) -> dict[str, Column]:
        spilled = nanos + (units % F.lit(1.0)) * billion
        return {"u": _whole(units) + _whole(spilled / billion), "n": spilled % billion}

    def step(frame: DataFrame, stage: str, columns: dict[str, Column]) -> DataFrame:
        return computed_once(frame, {f"_fx_{stage}_{k}": c for k, c in columns.items()})

    source = step(
        rows,
        "in",
        {
            "code": money["currency_code"],
            "units": money["units"].cast("bigint"),
            "nanos": money["nanos"].cast("bigint"),
            "to": to_code,
            "src": rate_of(money["currency_code"], rates),
            "dst": rate_of(to_code, rates),
        },
    )
    given = lambda part: F.col(f"_fx_in_{part}")
    euros = step(
        source,
        "eur",
        carry(given("units").cast("double") / given("src"), given("nanos").cast("double") / given("src")),
    )
    result = step(
        euros,
        "out",
        carry(
            F.col("_fx_eur_u") * given("dst"),
            _whole(F.col("_fx_eur_n") + F.lit(0.5)) * given("dst"),
        ),
    )

    def as_money(units: Column, nanos: Column) -> Column:
        return F.struct(
            given("to").alias("currency_code"), units.alias("units"), nanos.alias("nanos")
        )

    converted = F.when(
        given("code") == given("to"), as_money(given("units"), given("nanos"))
    ).when(
        given("src").isNotNull() & given("dst").isNotNull(),
        as_money(
            F.floor("_fx_out_u").cast("bigint"), F.floor("_fx_out_n").cast("bigint")
        ),
    )
    return result.withColumn(name, converted).drop(
        *(c for c in result.columns if c.startswith("_fx_"))
    )
