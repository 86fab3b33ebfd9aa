import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txnlake.operators import merge, scores
from txnlake.operators.rolling import rolling_stats

D = dt.date


def frame(spark, rows, kind="EXPENSE"):
    return spark.createDataFrame([(h, d, kind, float(a), s) for h, d, a, s in rows], "transaction_hash string, transaction_date date, transaction_type string, amount_abs_eur double, subcategory string")


def notable(spark, rows, **k):
    return {r.transaction_hash: r for r in scores.notability(frame(spark, rows, **k)).collect()}


def test_only_expenses(spark):
    df = scores.notability(frame(spark, [("h", D(2025, 1, 1), 5, "x")], "INCOME"))
    assert df.count() == 0 and df.columns == scores.NOTABILITY_COLUMNS
    assert notable(spark, [("h", D(2025, 1, 1), 5, "x")], kind="expense")["h"].hist_n_txns == 0


def test_new_category(spark):
    r = notable(spark, [("h1", D(2025, 3, 1), 50, "Brand")])["h1"]
    assert (r.hist_n_txns, r.is_new_subcategory, r.is_new_subcategory_max, r.notability_label, r.amount_z_score, r.notability_score) == (0, True, True, "New Category", None, 4.0)
    assert r.notability_reason == "First time spending in Brand"


def test_window_edges(spark):
    base = D(2025, 3, 15)
    ago = lambda n: base - dt.timedelta(days=n)
    r = notable(spark, [("old", ago(366), 10, "g"), ("mid", ago(180), 20, "g"), ("new", base, 50, "g")])["new"]
    assert (r.hist_n_txns, r.hist_avg_amount_eur, r.hist_std_amount_eur, r.notability_label) == (1, 20.0, None, "Insufficient History")
    r = notable(spark, [("old", ago(365), 10, "g"), ("new", base, 50, "g")])["new"]
    assert r.hist_n_txns == 1
    r = notable(spark, [("h1", ago(364), 10, "f"), ("h2", ago(1), 30, "f"), ("h3", base, 100, "f")])["h3"]
    assert (r.hist_n_txns, r.hist_avg_amount_eur, r.hist_std_amount_eur, r.amount_z_score, r.notability_label) == (2, 20.0, 10.0, 8.0, "Extreme Outlier")


def test_same_day_by_hash(spark):
    r = notable(spark, [("h_a", D(2025, 3, 10), 40, "x"), ("h_b", D(2025, 3, 10), 60, "x")])
    assert (r["h_a"].hist_n_txns, r["h_b"].hist_n_txns, r["h_b"].hist_avg_amount_eur, r["h_b"].amount_z_score) == (0, 1, 40.0, None)


def test_equal_amounts_have_no_spread(spark):
    rows = [(f"h{i}", D(2025, 1, 1 + i), 29.9, "x") for i in range(4)]
    assert notable(spark, rows)["h3"].notability_label == "Insufficient History"


def test_missing_group_has_no_history(spark):
    r = notable(spark, [("a", D(2025, 1, 1), 1, None), ("b", D(2025, 1, 2), 1, None), ("c", D(2025, 1, 3), 1, "")])
    assert {x.notability_label for x in r.values()} == {"New Category"}


def test_rolling_against_definition(spark):
    rnd = random.Random(5)
    rows = [(f"{rnd.getrandbits(40):010x}", D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(900)), rnd.randrange(1, 9999) / 100, rnd.choice("ab")) for _ in range(400)]
    got = {r.transaction_hash: r for r in rolling_stats(frame(spark, rows)).collect()}
    for h, d, _, s in rows:
        prior = [x[2] for x in rows if x[3] == s and d - dt.timedelta(days=365) <= x[1] and (x[1], x[0]) < (d, h)]
        r = got[h]
        assert r.hist_n_txns == len(prior)
        if prior:
            mean = sum(prior) / len(prior)
            assert r.hist_avg_amount_eur == pytest.approx(mean) and float(r.hist_max_amount_eur) == max(prior)
            var = sum((x - mean) ** 2 for x in prior) / len(prior)
            assert (r.hist_std_amount_eur or 0.0) ** 2 == pytest.approx(var, abs=1e-6)


GOLDEN = [
    ("s-a", D(2024, 9, 5), 30, "Groceries", "NEED", 2, None, None, 0, 0, 0.4, 1.2, "Low"), ("s-b", D(2024, 9, 12), 25, "Groceries", "NEED", 2, None, None, 0, 0, 0.4, 1.2, "Low"),
    ("s-c", D(2024, 9, 15), 50, "Restaurants", "WANT", 1, None, None, 0, 0, 1, 3.0, "Medium"), ("s-d", D(2024, 10, 3), 28, "Groceries", "NEED", 3, 2, 1.5, 0.5, 0.2, 0.4, 2.4, "Low"),
    ("s-e", D(2024, 10, 10), 35, "Groceries", "NEED", 3, 2, 1.5, 0.5, 3.568871, 0.4, 5.768871, "High"), ("s-f", D(2024, 10, 20), 80, "Groceries", "NEED", 3, 2, 1.5, 0.5, 5, 0.4, 7.2, "High"),
    ("s-g", D(2024, 10, 8), 60, "Restaurants", "WANT", 2, 1, 2, 1, 0, 1, 5.0, "High"), ("s-h", D(2024, 10, 22), 200, "Restaurants", "WANT", 2, 1, 2, 1, 5, 1, 10.0, "High"),
    ("s-i", D(2024, 11, 1), 15, "Subscriptions", "MUST", 1, None, None, 0, 0, 0.05, 0.15, "Minimal"),
]


def silver(spark, rows):
    df = spark.createDataFrame([(h, d, k, float(a), s, c) for h, d, k, a, s, c in rows], "transaction_hash string, transaction_date date, transaction_type string, amount_abs_eur double, subcategory string, classification string")
    return df.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))


def test_golden_save_potential(spark):
    rows = [(h, d, "EXPENSE", a, s, c) for h, d, a, s, c, *_ in GOLDEN] + [("s-j", D(2024, 11, 15), "INCOME", 1000, "Salary", "WANT")]
    got = {r.transaction_hash: r for r in scores.save_potential(silver(spark, rows)).collect()}
    assert set(got) == {g[0] for g in GOLDEN}
    for h, _, _, _, _, n, avg, ratio, fe, ae, av, score, label in GOLDEN:
        r = got[h]
        assert (r.month_txn_count, r.hist_avg_monthly_count, r.freq_ratio) == (n, avg, ratio)
        assert (r.freq_excess, r.amt_excess, r.avoidability, r.save_potential_score) == pytest.approx((fe, ae, av, score), rel=1e-4)
        assert r.save_potential_label == (label if label == "Minimal" else f"{label} Save Potential")
    assert got["s-h"].save_potential_reason.startswith("Discretionary (WANT) + 2.0x usual Restaurants frequency this month + ")


@pytest.mark.parametrize(("kind", "score"), [("WANT", 3.0), ("NEED", 1.2), ("MUST", 0.15), (None, 1.2), ("", 1.2), (" want ", 3.0), ("odd", 1.2)])
def test_avoidability(spark, kind, score):
    assert scores.save_potential(silver(spark, [("h", D(2025, 1, 1), "EXPENSE", 5, "x", kind)])).first().save_potential_score == pytest.approx(score)


def test_leap_year_month_window(spark):
    """With 29 February between them, the month twelve back starts 366 days earlier and is out."""
    rows = [("a", D(2023, 3, 1), "EXPENSE", 5, "x", "WANT"), ("b", D(2024, 3, 1), "EXPENSE", 5, "x", "WANT"), ("c", D(2025, 3, 1), "EXPENSE", 5, "x", "WANT")]
    got = {r.transaction_hash: r.hist_avg_monthly_count for r in scores.save_potential(silver(spark, rows)).collect()}
    assert got == {"a": None, "b": None, "c": 1.0}


def test_incremental_equals_full(spark):
    rnd = random.Random(9)
    rows = [(f"{rnd.getrandbits(40):010x}", D(2023, 1, 1) + dt.timedelta(days=rnd.randrange(800)), "EXPENSE", rnd.randrange(1, 9999) / 100, rnd.choice("abc"), "WANT") for _ in range(300)]
    s = silver(spark, rows).persist()
    hashes = s.where(F.col("transaction_date").between("2024-10-05", "2024-11-20")).select("transaction_hash")
    for m in merge.METRICS.values():
        full = {r.transaction_hash: r for r in m.compute(s, 365).collect()}
        part = merge.refreshed(s, m, hashes).collect()
        assert len(part) == hashes.count() and all(r == full[r.transaction_hash] for r in part)
    assert merge.refreshed(s, merge.METRICS["notability"], hashes.limit(0)).count() == 0
