"""Box-office text to money amounts in euro."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.text import as_column
from reelsift.lookups import UNITS_PER_EURO
from reelsift.sources.readers import inline_table

# The field and money patterns of the box-office text.
BOX_OFFICE_FIELDS = {
    "budget": r"Budget=([^\d]+[0-9,]+) \(estimated\)",
    "opening_weekend": r"Opening Weekend [A-Za-z ]*=([^\d]+[0-9,]+), [0-9]{2} [A-Za-z]{3} [0-9]{4}",
    "cumulative_worldwide_gross": r"Cumulative Worldwide Gross=([^\d]+[0-9,]+)",
}
MONEY_TOKENS = {
    "budget": (r"([A-Z$]+[0-9,]+)", 1),
    "opening_weekend": (r"([A-Z]{2,3}\$?\d{1,3}(?:,\d{3})*|\$\d{1,3}(?:,\d{3})*)", 0),
    "cumulative_worldwide_gross": (r"([A-Za-z]*\$?[0-9,]+)", 1),
}
LEADING_CURRENCY = r"^(\D+)"
LEADING_AMOUNT = r"^(\D+)(\d+)"


def strip_braces(column: str | Column) -> Column:
    return F.regexp_replace(as_column(column), r"^\{|\}$", "")


def found_or_null(column: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(column, pattern, group), F.lit(""))


def extract_box_office_data(df: DataFrame, column: str = "box_office") -> DataFrame:
    """Add one text column per labelled amount found in the box-office text."""
    return df.withColumns({name: found_or_null(F.col(column), p) for name, p in BOX_OFFICE_FIELDS.items()})


def money_token(column: str | Column, field: str) -> Column:
    """Currency and number of a labelled amount, without thousands separators."""
    pattern, group = MONEY_TOKENS[field]
    return F.replace(F.regexp_extract(as_column(column), pattern, group), F.lit(","), F.lit(""))


def extract_currency_and_amount(column: str | Column) -> tuple[Column, Column]:
    """Leading non-digits, and the digits that follow them as a double."""
    value = as_column(column)
    currency = F.regexp_extract(value, LEADING_CURRENCY, 1)
    amount = F.regexp_extract(value, LEADING_AMOUNT, 2).try_cast("double")
    return currency, amount


def rates_table(spark, rates: dict[str, float] | None = None) -> DataFrame:
    """The exchange rates as a table (currency, per_eur)."""
    rows = [(code, None if rate is None else float(rate)) for code, rate in (rates or UNITS_PER_EURO).items()]
    return inline_table(spark, rows, ["currency", "per_eur"])


def convert_to_eur(df: DataFrame, currency: str, amount: str, new_column: str, rates: DataFrame) -> DataFrame:
    """Add the euro value of an amount; currencies without a rate give null.

    ``rates`` has one row per currency. No broadcast hint: a table of rates is small enough for
    the planner to broadcast by its known size, and a large one is joined by shuffle.
    """
    keyed = rates.select(F.col("currency").alias("__currency"), F.col("per_eur").alias("__per_eur"))
    return (
        df.join(keyed, F.col(currency) == F.col("__currency"), "left")
        .withColumn(new_column, F.try_divide(F.col(amount), F.col("__per_eur")))
        .drop("__currency", "__per_eur")
    )


def box_office_to_eur(df: DataFrame, column: str = "box_office", rates: DataFrame | None = None) -> DataFrame:
    """Replace the box-office text by budget, opening weekend and worldwide gross in whole euro.

    Tokens are looked for behind the label only. Labels cannot hold one, and trying their letters is slow.
    """
    rates = rates_table(df.sparkSession) if rates is None else rates
    stripped = df.withColumn(column, strip_braces(column))
    out = stripped.withColumns(
        {field: F.regexp_extract(column, pattern, 1) for field, pattern in BOX_OFFICE_FIELDS.items()}
    ).drop(column)
    for field in BOX_OFFICE_FIELDS:
        currency, amount = extract_currency_and_amount(money_token(field, field))
        out = out.withColumns({"__unit": currency, "__amount": amount})
        out = convert_to_eur(out, "__unit", "__amount", f"{field}_eur", rates)
        out = out.withColumn(f"{field}_eur", F.round(f"{field}_eur", 0)).drop("__unit", "__amount", field)
    return out
