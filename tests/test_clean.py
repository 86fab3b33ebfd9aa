import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnlake.functions import scalars as S
from txnlake.operators import clean

COLUMNS = ["Date", " Note", "type", "payee", "amount", "labels", "account", "category", "currency", "payment"]


def raw(spark, **change):
    row = dict(zip([c.strip().lower() for c in COLUMNS], ("2024-01-15", "test note", "Expenses", "Test Payee", "-10.00", "", "Cash in Euro", "Groceries", "EUR", "card"))) | change
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` string" for c in row))


def one(spark, **change):
    rows = clean.clean(raw(spark, **change)).collect()
    return rows[0] if rows else None


def values(spark, f, items, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_names(spark):
    r = clean.named(spark.createDataFrame([("a",) * 10], ", ".join(f"`{c.upper()}` string" for c in COLUMNS)))
    assert {"description", "subcategory", "payment_method", "date"} <= set(r.columns)


def test_dates(spark):
    got = values(spark, S.parse_date, ["2024-03-29", "7/27/2025", "7/27/2025 3:00:35", "27/7/2025", "03.04.2024", "2024.03.05", "3/4/24", "20240329", "2024-03-29T10:00:00Z", "2025-20-02", "2025.20.02", "2025 20 02", "not-a-date", "", "2024-02-30", None])
    d = dt.date
    assert got == [d(2024, 3, 29), d(2025, 7, 27), d(2025, 7, 27), d(2025, 7, 27), d(2024, 3, 4), d(2024, 3, 5), d(2024, 3, 4), d(2024, 3, 29), d(2024, 3, 29), d(2025, 2, 20), d(2025, 2, 20), d(2025, 2, 20), None, None, None, None]


def test_amounts(spark):
    assert values(spark, S.parse_amount, ["-45.50", "not-a-number", "1,234.50", "\t12 ", "1e3", "NaN", None]) == [-45.5, None, None, 12.0, 1000.0, None, None]


def test_types(spark):
    assert values(spark, S.standard_type, ["Expenses", "Income", "EXPENSES", "Transfer", "expense", None]) == ["EXPENSE", "INCOME", "EXPENSE", None, None, None]


@pytest.mark.parametrize(("amount", "currency", "eur", "bgn", "rate"), [("-100", "EUR", -100, -195.58, 1.0), ("-195.583", "BGN", -100, -195.58, 0.5113), ("-10", "XYZ", -10, -19.56, 1.0), ("-50", " bgn ", -25.56, -50, 0.5113)])
def test_currencies(spark, amount, currency, eur, bgn, rate):
    r = one(spark, amount=amount, currency=currency)
    assert (r.amount_eur, r.amount_bgn, r.eur_conversion_rate) == (eur, bgn, rate)


def test_base_amount(spark):
    df = raw(spark, amount="-100").withColumns({"base_amount_value": F.lit(-195.58), "base_amount_currency": F.lit("BGN")})
    assert clean.clean(df).first().amount_bgn == -195.58


def test_rounding_is_half_even(spark):
    assert values(spark, S.round_half_even, [0.125, 0.375, -0.125], "double") == [0.12, 0.38, -0.12]


def test_calendar(spark):
    r = one(spark, date="2024-07-15")
    assert (r.year, r.month, r.quarter, r.year_month, r.day_of_week, r.is_weekend, r.week_of_year) == (2024, 7, 3, "2024-07", 1, False, 29)
    assert one(spark, date="2024-01-13").is_weekend


def test_hash(spark):
    a = one(spark)
    assert len(a.transaction_hash) == 64 and a.classification is None
    assert a.transaction_hash == one(spark).transaction_hash
    assert a.transaction_hash != one(spark, amount="-10.01").transaction_hash
    assert a.transaction_hash != one(spark, category="Taxi").transaction_hash
    assert one(spark, note=None).transaction_hash == one(spark, note="").transaction_hash
    nan = clean.clean(raw(spark, note=None), null_token="nan").first().transaction_hash
    assert nan == one(spark, note="nan").transaction_hash


@pytest.mark.parametrize("change", [{"date": "not-a-date"}, {"amount": "x"}, {"type": "Transfer"}, {"category": None}])
def test_incomplete_rows_go(spark, change):
    assert one(spark, **change) is None


def test_rename_by_type(spark):
    assert one(spark, category="Aliments (Financial expenses)").subcategory == "Child Support"


def test_validation(spark):
    df = clean.clean(raw(spark))
    assert clean.validate(df, 1) == [] and clean.validate(df, 2)
    with pytest.raises(ValueError, match="missing required columns"):
        clean.validate(df.drop("transaction_hash"))
    with pytest.raises(ValueError, match="null values"):
        clean.validate(df.withColumn("date", F.lit(None).cast("date")))


def test_euros_in_text(spark):
    assert values(spark, S.scaled_euros, ["avg €420 and €10.5", "none", "€", None]) == ["avg €307 and €8", "none", "€", None]


def test_free_dates(spark):
    from txnlake.functions import scalars as S

    texts = ["29 March 2024", "MARCH 29, 2024", "Mar 29 2024", "29-Mar-2024", "Friday, March 29th, 2024", "2024-03-29 10:11:12+02:00", "2024-03-29 10:11:12.345", "3/29/2024 5:06 PM", "2024-03-29T10:11:12Z", "29 Sept. 2024", "soon", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: str(r.d) for r in df.select("i", S.parse_date(F.col("t")).alias("d")).collect()}
    assert got == {**{i: "2024-03-29" for i in range(9)}, 9: "2024-09-29", 10: "None", 11: "None", 12: "None"}
