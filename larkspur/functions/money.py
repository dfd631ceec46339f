"""Prices, salaries and currencies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources.literal import literal_rows

# Currency symbol as it appears in carts, and its rate to US dollars.
EXCHANGE_RATES = [
    ("CHF", "CHF", "Swiss Franc", 1.13, "CH"),
    ("€", "EUR", "Euro", 1.09, "EU"),
    ("kr", "SEK", "Swedish Krona", 0.1, "SE"),
    ("₺", "TRY", "Turkish lira", 0.027, "TR"),
    ("￥", "JPY", "Japanese Yen", 0.0067, "JP"),
    ("AU $", "AUD", "Australian Dollar", 0.62856, "AU"),
    ("SGD $", "SGD", "Singapore Dollar", 0.75, "SG"),
    ("CAD $", "CAD", "Canadian Dollar", 0.69, "CA"),
    ("$", "USD", "United States Dollar", 1.0, "US"),
    ("USD $", "USD", "United States Dollar", 1.0, "US"),
    ("Kč", "CZK", "Czech Koruna", 0.044, "CZ"),
    ("Ft", "HUF", "Hungarian Forint", 0.0027, "HU"),
    ("HKD $", "HKD", "Hong Kong Dollar", 0.13, "HK"),
    ("zł", "PLN", "Polish Zloty", 0.25, "PL"),
    ("COP $", "COP", "Colombian Peso", 0.00024, "CO"),
    ("din.", "RSD", "Serbian Dinar", 0.0093, "RS"),
    ("kn", "HRK", "Kuna Croatia", 0.14244, "HR"),
    ("NZD $", "NZD", "New Zealand Dollar", 0.57, "NZ"),
    ("MXN $", "MXN", "Mexican Peso", 0.049, "MX"),
    ("лв.", "BGN", "Bulgarian Lev", 0.56, "BG"),
    ("CRC ₡", "CRC", "Costa Rican Colón", 0.002, "CR"),
    ("£", "GBP", "Pound Sterling", 1.29, "GB"),
    ("PEN S/.", "PEN", "Sol", 0.27, "PE"),
    ("CLP", "CLP", "Chilean Peso", 0.0011, "CL"),
    ("₱", "PHP", "Philippine Peso", 0.017, "PH"),
    ("Lei", "RON", "Romanian Leu", 0.22, "RO"),
    ("BOB Bs", "BOB", "Bolivian Boliviano", 0.14477, "BO"),
    ("UYU", "UYU", "Uruguayan Peso", 0.024, "UY"),
    ("₫", "VND", "Vietnamese Dong", 0.000039, "VN"),
    ("GTQ Q", "GTQ", "Guatemalan Quetzal", 0.13, "GT"),
    ("د.ك.", "KWD", "Kuwaiti Dinar", 3.25, "KW"),
    ("₹", "INR", "Indian Rupee", 0.011, "IN"),
    ("R$", "BRL", "Brazilian Real", 0.172086, "BR"),
    ("DOP $", "DOP", "Dominican Peso", 0.016, "DO"),
    ("₲", "PYG", "Paraguayan Guarani", 0.01261, "PY"),
]


def exchange_rates(spark: SparkSession) -> DataFrame:
    """The rate table, a constant list."""
    return literal_rows(
        spark,
        EXCHANGE_RATES,
        "symbol string, code string, currency_name string, exchange_rate double, country_code string",
    )


def locale_price(text: Column) -> Column:
    """A price written in one of several local styles, as double; unreadable text gives NULL.

    The styles are tried in this order: eastern Arabic digits (only the zero and the
    decimal sign are mapped), apostrophe groups, dot groups with a decimal comma,
    comma groups with a decimal dot, a plain decimal comma; else commas are dropped.
    """

    def drop(part: Column, *signs: str) -> Column:
        for sign in signs:
            part = F.replace(part, F.lit(sign), F.lit(""))
        return part

    def swap(part: Column, old: str, new: str) -> Column:
        return F.replace(part, F.lit(old), F.lit(new))

    plain = (
        F.when(text.rlike("[٠-٩٫]"), swap(swap(text, "٫", "."), "٠", "0"))
        .when(text.rlike(r"^\d{1,3}('\d{3})*\.\d{2}$"), drop(text, "'"))
        .when(text.rlike(r"^\d{1,3}(\.\d{3})*,\d{2}$"), swap(drop(text, "."), ",", "."))
        .when(text.rlike(r"^\d{1,3}(,\d{3})*\.\d{2}$"), drop(text, ","))
        .when(text.rlike(r"^\d+,\d{2}$"), swap(text, ",", "."))
        .otherwise(drop(text, ","))
    )
    # Java reads Infinity, NaN, exponents and float suffixes as numbers; a price has no letters
    return F.when(~plain.rlike("[A-Za-z]"), plain.try_cast("double"))


def loose_number(text: Column) -> Column:
    """Keep digits and dots; with several dots the last one is the decimal point."""
    western = F.translate(text, "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")
    kept = F.regexp_replace(western, r"[^\d.]", "")
    return F.regexp_replace(kept, r"\.(?=.*\.)", "").try_cast("double")


def prefixed_amount(text: Column, rates: dict[str, float]) -> Column:
    """'INR 100' or '$ 100' in one currency, as decimal(18,2); other prefixes give NULL.

    Like a money type, the amount keeps two decimals and the product is rounded to two.
    """
    prefix, number = F.split_part(text, F.lit(" "), F.lit(1)), F.split_part(text, F.lit(" "), F.lit(2))
    amount = number.try_cast("decimal(18,2)")
    out = F.lit(None).cast("decimal(18,2)")
    for name, rate in rates.items():
        value = F.round(amount * F.lit(str(rate)).cast("decimal(9,6)"), 2).cast("decimal(18,2)")
        out = F.when(prefix == name, value).otherwise(out)
    return out


# Fixed value: movie incomes in rupees become dollars at this rate.
INCOME_RATES = {"$": 1, "INR": 0.012}


def salary_columns(salary: Column) -> dict[str, Column]:
    """negotiable, salary_min, salary_max and salary_unit from a salary text."""
    text = F.replace(F.lower(salary), F.lit(","), F.lit(""))
    pair = r"(\d+)\s*-\s*(\d+)"

    def number(part: Column) -> Column:
        return F.nullif(part, F.lit("")).try_cast("double")

    first = number(F.regexp_extract(text, r"(\d+)", 1))
    low, high = (number(F.regexp_extract(text, pair, i)) for i in (1, 2))
    return {
        "negotiable": text.contains("thoả thuận"),
        "salary_min": F.when(text.contains("trên"), first).otherwise(low),
        "salary_max": F.when(text.contains("tới"), first).otherwise(high),
        "salary_unit": F.when(text.contains("usd"), "USD").otherwise("M VND"),
    }


# Dollar rate and unit scale of the salary repair.
VND_PER_USD = 25554
MILLION = 1e-6


def repair_salaries(df: DataFrame) -> DataFrame:
    """Zero to NULL, mislabelled dollar amounts rescaled, dollars turned into million VND.

    A dollar amount above 100,000 is really in VND: it is scaled and the row's unit
    changes, first by the lower and then by the upper bound. What is still in dollars
    is converted, and the unit becomes M VND throughout.
    """
    money = ("salary_min", "salary_max")
    df = df.withColumns({m: F.when(F.col(m) != 0, F.col(m)) for m in money})
    fixed_price = ~F.col("negotiable")
    for m in money:
        too_high = fixed_price & (F.col("salary_unit") == "USD") & (F.col(m) > 1e5)
        too_high = F.coalesce(too_high, F.lit(False))
        df = df.withColumns(
            {
                m: F.when(too_high, F.col(m) * MILLION).otherwise(F.col(m)),
                "salary_unit": F.when(too_high, "M VND").otherwise(F.col("salary_unit")),
            }
        )
    dollars = fixed_price & (F.col("salary_unit") == "USD")
    df = df.withColumns(
        {m: F.when(dollars, F.col(m) * VND_PER_USD * MILLION).otherwise(F.col(m)) for m in money}
    )
    return df.withColumn(
        "salary_unit", F.when(F.col("salary_unit") == "USD", "M VND").otherwise(F.col("salary_unit"))
    )
