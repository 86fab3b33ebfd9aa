"""Scalar semantics as Spark expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake.functions import values as V

MONEY = "decimal(12,2)"


def strip(c: Column) -> Column:
    """All white space at both ends, not spaces alone."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def lookup(c: Column, table: dict, default: Column | None = None) -> Column:
    """The value of a small literal map."""
    return reduce(lambda out, kv: F.when(c == kv[0], F.lit(kv[1])).otherwise(out), reversed(list(table.items())), F.lit(None) if default is None else default)


def round_half_even(c: Column, digits: int = 2) -> Column:
    return F.rint(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


def transaction_hash(date: Column, amount: Column, category: Column, description: Column, null_token: str = "") -> Column:
    """SHA-256 of date|amount|category|description. null_token stands for a missing description."""
    parts = [F.date_format(date, "yyyy-MM-dd"), F.format_string("%.2f", amount.cast("double")), F.lower(strip(category)), F.lower(strip(F.substring(F.coalesce(description, F.lit(null_token)), 1, 100)))]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def parse_date(c: Column) -> Column:
    """The first format that fits; a time part after T is cut.

    What fits none is read as free text: month names in any case, weekdays, ordinal endings, zones and fractions of seconds left out.
    """
    bare = strip(c)
    day = F.split_part(bare, F.lit("T"), F.lit(1))
    # a failed try costs far more than a good one: of the formats only those of the text's shape are tried, in their order
    shape, year_first = F.regexp_replace(day, r"\d+", "9"), day.rlike(r"^\d{4}(\D|$)")
    tries = lambda formats: F.coalesce(*[F.try_to_timestamp(day, F.lit(f)) for f in formats], F.lit(None))
    out = None
    for s in dict.fromkeys(_shape(f) for f in V.DATE_FORMATS if "MMMM" not in f):
        own = [f for f in V.DATE_FORMATS if "MMMM" not in f and _shape(f) == s]
        first = [f for f in own if f.startswith("yyyy")]
        rest = [f for f in own if f not in first]
        found = tries(own) if s == "9" else F.when(year_first, tries(first)).otherwise(tries(rest))
        out = F.when(shape == s, found) if out is None else out.when(shape == s, found)
    # the lambda keeps what few rows reach out of the generated code, and binds the text once
    free = F.transform(F.array(F.when(bare.rlike(r"\d"), bare)), lambda x: _free_date(x))[0]
    return F.coalesce(out, free).cast("date")


def _shape(date_format: str) -> str:
    """The format with its numbers as 9."""
    return re.sub(r"[A-Za-z]+", "9", date_format)


def _free_date(text: Column) -> Column:
    for pattern, by in (
        (r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,?\s+", ""),
        (r"(?i)(\d)(?:st|nd|rd|th)\b", "$1"),
        (r"(?i)(:\d\d)(?:\.\d+)?\s*(?:z|utc|gmt|[+-]\d\d:?\d\d)?$", "$1"),
        (r"(?i)\bsept\b", "Sep"),
        (r"([A-Za-z]{3})\.", "$1"),
        (r"(?i)(\d) ?([ap])\.?m\.?$", "$1 $2M"),
        (r"\s+", " "),
    ):
        text = F.regexp_replace(text, pattern, by)
    # names of months with a capital, AM and PM in capitals
    shown = F.transform(F.array(F.regexp_replace(F.initcap(text), r"(?i) ([ap])m$", " $1M")), lambda y: F.coalesce(*[F.try_to_timestamp(y, F.lit(f)) for f in (*V.DATE_FORMATS, *V.FREE_DATES)]))
    return shown[0]


def parse_amount(c: Column) -> Column:
    x = strip(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def standard_type(c: Column) -> Column:
    """Lower-cased, not stripped; all else is NULL."""
    return lookup(F.lower(c), V.TYPES)


def renamed_subcategory(subcategory: Column, kind: Column) -> Column:
    return reduce(lambda out, kv: F.when((subcategory == kv[0][0]) & (kind == kv[0][1]), kv[1]).otherwise(out), V.SUBCATEGORY_RENAMES.items(), subcategory)


def calendar(date: Column) -> dict[str, Column]:
    dow = F.weekday(date) + 1
    return {
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year_month": F.date_format(date, "yyyy-MM"),
        "day_of_week": dow,
        "week_of_year": F.weekofyear(date),
        "is_weekend": dow.isin(6, 7),
    }


def conversion(amount: Column, currency: Column, base_amount: Column | None = None, base_currency: Column | None = None) -> dict[str, Column]:
    """Amounts in EUR and BGN; BGN rows keep their amount, EUR rows take a given BGN base amount."""
    cur = F.upper(strip(currency))
    rate = lookup(cur, V.EUR_RATES, F.lit(1.0))
    eur = round_half_even(amount * rate)
    bgn = F.when(cur == "BGN", round_half_even(amount))
    if base_amount is not None:
        bgn = bgn.when((cur == "EUR") & (F.upper(strip(base_currency)) == "BGN") & base_amount.isNotNull(), round_half_even(base_amount))
    bgn = bgn.otherwise(round_half_even(eur / F.lit(V.EUR_RATES["BGN"])))
    return {"currency": cur, "eur_conversion_rate": rate, "amount_eur": eur, "amount_abs_eur": F.abs(eur), "amount_bgn": bgn, "amount_abs_bgn": F.abs(bgn)}


def signed(amount: Column, record_type: Column) -> Column:
    """Expenses negative, income positive, others as they are; a missing type is an expense."""
    kind = F.lower(F.coalesce(record_type, F.lit("expense")))
    return F.when((kind == "expense") & (amount > 0), -amount).when((kind == "income") & (amount < 0), F.abs(amount)).otherwise(amount)


def record_type(c: Column) -> Column:
    return lookup(F.lower(F.coalesce(c, F.lit("expense"))), V.RECORD_TYPES, F.lit("Expenses"))


def payment_type(c: Column) -> Column:
    """Known and unknown types in capitals, missing ones empty."""
    return F.upper(F.coalesce(c, F.lit("")))


def counterparty(payee: Column, payer: Column) -> Column:
    return F.coalesce(F.nullif(payee, F.lit("")), payer, F.lit(""))


def scaled_euros(text: Column, scale: float = V.SCALE) -> Column:
    """Every euro figure in a text times scale, without decimals, ties to even."""
    pattern = r"€(\d+(?:\.\d+)?)"
    figures, rest = F.regexp_extract_all(text, F.lit(pattern), 1), F.split(text, pattern, -1)
    shown = F.transform(figures, lambda x: F.format_string("€%.0f", F.rint(x.cast("double") * scale)))
    return F.array_join(F.zip_with(rest, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def date_shape(c: Column) -> Column:
    return reduce(lambda out, p: F.when(c.rlike(p[0]), p[1]).otherwise(out), reversed(V.DATE_SHAPES), F.when(c.isNotNull(), V.UNKNOWN_SHAPE))
