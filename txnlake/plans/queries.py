"""One query for each operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions import scalars as S
from txnlake.functions import values as V
from txnlake.functions.store import new_folder, written
from txnlake.operators import anonymise, audit, clean, enrich, layers, merge, recon, rolling, scores
from txnlake.operators.paging import Pages
from txnlake.plans import tables as T
from txnlake.plans.warehouse import Warehouse, month_of
from txnlake.sources import records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _money(c: str):
    return F.col(c).cast("decimal(12,2)").alias(c)


def _orders(spark, sf_dir):
    """(key, s): order keys with amounts and dates written in several ways."""
    return T.table(spark, sf_dir, "orders")


@query
def scan_filter_project(spark, sf_dir):
    """The scan of an export: three columns, one filter, both reach the reader."""
    o = _orders(spark, sf_dir)
    return o.where(F.col("o_totalprice") > 200000).select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))


@query
def staging_projection(spark, sf_dir):
    return layers.staging(clean.named(T.raw(spark, sf_dir)), "export.csv", "batch-1")


@query
def bronze_projection(spark, sf_dir):
    return layers.bronze(T.cleaned(spark, sf_dir), "export.csv", "batch-1")


@query
def silver_projection(spark, sf_dir):
    keep = ["transaction_hash", "transaction_date", "transaction_type", "amount", "amount_abs", "currency", "amount_eur", "eur_conversion_rate", "amount_bgn", "subcategory", "account_name", "year_month", "classification"]
    return layers.silver(T.cleaned(spark, sf_dir), "loader").select(*keep)


@query
def api_field_map(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    kinds = F.element_at(F.array(*map(F.lit, ("income", "expense", "transfer", "expenses", None, "INCOME"))), (F.col("id") % 6 + 1).cast("int"))
    pays = F.element_at(F.array(*map(F.lit, ("cash", "debit_card", None, "voucher", "barter"))), (F.col("id") % 5 + 1).cast("int"))
    flat = t.select(
        F.col("id").cast("string").alias("id"), F.concat(F.col("date").cast("string"), F.lit("T10:00:00Z")).alias("recordDate"), kinds.alias("recordType"), pays.alias("paymentType"),
        F.abs(F.col("amount")).cast("double").alias("amount_value"), F.col("currency").alias("amount_currency"), F.when(F.col("id") % 3 == 0, "").otherwise(F.col("payee")).alias("payee"),
        F.lit("payer").alias("payer"), F.col("subcategory").alias("category_name"), F.lit("parent").alias("category_parent_name"),
    )
    return records.mapped(flat).select("source_record_id", "date", "type", "payee", "amount", "category", "currency", "payment")


@query
def row_number_lineage(spark, sf_dir):
    t = T.txn(spark, sf_dir).select("id", "date")
    return layers.numbered(t, ["date", "id"]).select("id", F.col("source_row_number").cast("long").alias("source_row_number"))


@query
def json_flatten(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    nested = e.select(
        F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("recordDate"), F.col("event_type").alias("recordType"),
        F.struct(F.round("value", 2).alias("value"), F.when(F.col("user_id") % 2 == 0, "EUR").otherwise("BGN").alias("currencyCode")).alias("amount"),
        F.when(F.col("user_id") % 3 == 0, F.struct(F.round("value", 2).alias("value"), F.lit("BGN").alias("currencyCode"))).alias("baseAmount"),
        F.struct(F.concat(F.lit("c"), F.col("user_id") % 10).alias("id"), F.lit("name").alias("name")).alias("category"),
        F.col("user_id").cast("string").alias("accountId"),
        F.when(F.col("user_id") % 4 != 0, F.array(F.struct(F.col("event_type").alias("name")), F.struct(F.lit(None).cast("string").alias("name")), F.struct(F.lit("z").alias("name")))).alias("labels"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    flat = records.flattened(nested)
    return flat.select("id", "recordDate", "amount_value", "amount_currency", "category_id", "accountId", "labels", "base_amount_value", "base_amount_currency", "k")


@query
def final_cleanup(spark, sf_dir):
    """The rows that the last clean-up leaves: those with a date, an amount and a known type."""
    t = T.raw(spark, sf_dir)
    bad = F.col("note").substr(-1, 1)
    spoilt = t.withColumns({"date": F.when(bad == "3", "soon").otherwise(F.col("date")), "amount": F.when(bad == "4", "n/a").otherwise(F.col("amount"))})
    return clean.clean(spoilt).select("transaction_hash", "date", "transaction_type", F.col("amount").cast("decimal(12,2)").alias("amount"))


@query
def account_filter(spark, sf_dir):
    return enrich.preset_filter(T.txn(spark, sf_dir), T.PRESET).select("id", "account", "date")


@query
def unrecognized_accounts(spark, sf_dir):
    return enrich.unrecognised(T.txn(spark, sf_dir), T.PRESET)


@query
def gold_slice_scan(spark, sf_dir):
    import datetime as dt

    cols = ("transaction_hash", "transaction_date", "amount_abs_eur", "subcategory")
    return merge.silver_slice(T.silver(spark, sf_dir), cols, ["Groceries", "Taxi", "Fuel"], dt.date(1999, 1, 10), dt.date(1999, 6, 20))


@query
def silver_watermark(spark, sf_dir):
    return T.stored(T.silver(spark, sf_dir)).agg(F.max("transaction_date").alias("watermark"), F.date_add(F.max("transaction_date"), 1).alias("next_from"))


@query
def category_parent_self_join(spark, sf_dir):
    n = T.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parentId"))
    r = T.table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parentId"))
    return records.parent_categories(n.unionByName(r))


@query
def lookup_default_join(spark, sf_dir):
    s = T.table(spark, sf_dir, "supplier")
    accounts = T.table(spark, sf_dir, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    categories = spark.createDataFrame([], "id string, name string, parentId string")
    ids = s.select("s_suppkey", F.when(F.col("s_suppkey") % 7 != 0, F.col("s_nationkey").cast("string")).alias("accountId"), F.lit(None).cast("string").alias("category_id"))
    return records.with_names(ids, accounts, categories).select("s_suppkey", F.col("account_name").alias("name"))


@query
def incremental_anti_join(spark, sf_dir):
    s = T.silver(spark, sf_dir)
    return merge.new_rows(T.incoming(s), T.stored(s)).select("transaction_hash", "transaction_date", "transaction_type")


@query
def late_data_overlap(spark, sf_dir):
    """Rows of the last 30 days before the watermark are read again and those known left out."""
    s = T.silver(spark, sf_dir)
    mark = T.stored(s).agg(F.max("transaction_date")).first()[0]
    again = s.where(F.col("transaction_date") >= F.date_sub(F.lit(mark), 30))
    return merge.new_rows(again, T.stored(s)).groupBy("transaction_type").agg(F.count("*").alias("n"), F.min("transaction_date").alias("first"))


@query
def bronze_union_batches(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    half = lambda n, cols: e.where(F.col("event_id") % 2 == n).select("event_id", *cols, F.lit(f"batch-{n}").alias("batch"))
    both = half(0, ["event_type", "user_id"]).unionByName(half(1, ["event_type"]), allowMissingColumns=True)
    return both.groupBy("batch", "event_type").agg(F.count("*").alias("n"), F.count("user_id").alias("n_users"))


@query
def seed_insert_if_absent(spark, sf_dir):
    m = enrich.mapping(spark).drop("mapping_no")
    extra = T.table(spark, sf_dir, "part").select(F.col("p_type").alias("subcategory"), F.lit("Shopping").alias("category"), F.lit("WANT").alias("classification")).distinct()
    known = T.table(spark, sf_dir, "part").where("p_size < 5").select(F.col("p_type").alias("subcategory"), F.lit("Other").alias("category"), F.lit("NEED").alias("classification")).distinct()
    return enrich.inserted_if_absent(m.unionByName(known), extra, "subcategory")


@query
def duplicate_hash_report(spark, sf_dir):
    line = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber"), 256).alias("transaction_hash"))
    return merge.duplicate_rows(line).select("transaction_hash", "l_orderkey", "l_linenumber", "l_partkey", "n")


@query
def category_enrichment(spark, sf_dir):
    return T.silver(spark, sf_dir).select("transaction_hash", "subcategory", "category", "classification", "transaction_type", "income_type")


@query
def dq_flags(spark, sf_dir):
    df = enrich.flagged(layers.silver(T.cleaned(spark, sf_dir), "loader"), enrich.mapping(spark))
    return df.where("flags <> ''").select("transaction_hash", "subcategory", "transaction_type", "flags", "is_error")


@query
def monthly_subcategory_counts(spark, sf_dir):
    sub = F.when(F.col("id") % 11 != 0, F.col("subcategory"))
    rows = T.txn(spark, sf_dir).select(F.date_format("date", "yyyy-MM").alias("year_month"), sub.alias("subcategory"))
    return scores.monthly_counts(rows).select("year_month", "subcategory", F.col("month_txn_count").alias("n"))


@query
def monthly_frequency_baseline(spark, sf_dir):
    df = T.silver(spark, sf_dir).where("transaction_type = 'EXPENSE'")
    return scores.monthly_counts(df).withColumn("hist_avg_monthly_count", F.round("hist_avg_monthly_count", 6))


@query
def rolling_stats(spark, sf_dir):
    df = rolling.rolling_stats(T.silver(spark, sf_dir).where("transaction_type = 'EXPENSE'"))
    six = lambda c: F.round(c, 6).alias(c)
    return df.select("transaction_hash", "hist_n_txns", six("hist_avg_amount_eur"), six("hist_std_amount_eur"), "hist_max_amount_eur")


@query
def notability(spark, sf_dir):
    df = scores.notability(T.silver(spark, sf_dir))
    return df.select("transaction_hash", "hist_n_txns", F.round("amount_z_score", 6).alias("z"), "is_new_subcategory", "is_new_subcategory_max", F.round("notability_score", 6).alias("score"), "notability_label", "notability_reason")


@query
def save_potential(spark, sf_dir):
    df = scores.save_potential(T.silver(spark, sf_dir))
    six = lambda c: F.round(c, 6).alias(c)
    return df.select("transaction_hash", "avoidability", "month_txn_count", *map(six, ("hist_avg_monthly_count", "freq_ratio", "freq_excess", "amt_excess", "save_potential_score")), "save_potential_label", "save_potential_reason")


@query
def gold_target_info(spark, sf_dir):
    s = T.silver(spark, sf_dir)
    info = merge.target_info(s, merge.new_rows(T.incoming(s), T.stored(s)))
    return info.select(F.size("subcategories").alias("n_subcategories"), "date_from", "date_to")


@query
def gold_upsert_merge(spark, sf_dir):
    s = T.silver(spark, sf_dir).select("transaction_hash", "transaction_date", "amount_abs_eur", "subcategory")
    target = T.stored(s).withColumn("extra_stats", F.lit(None).cast("string"))
    source = T.incoming(s).select("transaction_hash", "transaction_date", (F.col("amount_abs_eur") * 2).cast("decimal(12,2)").alias("amount_abs_eur"), F.expr("map('v', subcategory)").alias("extra_stats"))
    return merge.upserted(target, source, json_columns=("extra_stats",))


@query
def gold_incremental_refresh(spark, sf_dir):
    metric = merge.METRICS["save-potential"]
    # silver as a load finds it: a stored table, of which the refresh reads a slice
    s = written(T.silver(spark, sf_dir).select(*metric.columns), "silver")
    hashes = written(merge.new_rows(T.incoming(s), T.stored(s)).where("transaction_type = 'EXPENSE'").select("transaction_hash"), "hashes")
    out = merge.refreshed(s, merge.METRICS["save-potential"], hashes)
    return out.select("transaction_hash", "month_txn_count", F.round("hist_avg_monthly_count", 6).alias("hist_avg_monthly_count"), F.round("save_potential_score", 6).alias("score"), "save_potential_label")


@query
def audit_diff(spark, sf_dir):
    before = T.silver(spark, sf_dir).select("transaction_hash", "subcategory", "account_name", "amount", "payee")
    digit = F.substring("payee", -1, 1)
    after = before.where(digit != "0").withColumns({
        "subcategory": F.when(digit.isin("1", "2"), "Rent").otherwise(F.col("subcategory")), "account_name": F.when(digit == "2", F.lit(None).cast("string")).otherwise(F.col("account_name")),
    })
    d = audit.audit_diff(before, after, actor="tester", reason="check")
    return d.select("transaction_hash", "operation", F.array_join("changed_fields", ",").alias("changed_fields"), F.element_at("old_values", F.lit("subcategory")).alias("old_subcategory"), F.element_at("new_values", F.lit("subcategory")).alias("new_subcategory"), "actor", "reason")


@query
def anonymized_export(spark, sf_dir):
    s = T.silver(spark, sf_dir).drop("created_by", "source_raw_id", "labels")
    s = written(s, "silver")
    wide = anonymise.wide(s, scores.notability(s), scores.save_potential(s))
    out = anonymise.anonymised(wide)
    return out.select("transaction_hash", "transaction_date", "merchant", "city", "description", "payee", "account_name", "account_group", "amount", "amount_eur", "notability_label", "save_potential_label")


@query
def frequency_rank_alias(spark, sf_dir):
    df = T.txn(spark, sf_dir).select("id", F.when(F.col("id") % 13 == 0, "  ").otherwise(F.col("subcategory")).alias("name"))
    return anonymise.rank_alias(df, "name", "Label", 20)


@query
def scale_euros_in_text(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    text = F.concat(F.lit("paid €"), F.abs("amount").cast("string"), F.lit(" of €"), (F.col("id") % 1000).cast("string"), F.lit(" (€x)"))
    return t.select("id", S.scaled_euros(text).alias("text"))


@query
def transaction_hash(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    description = F.when(F.col("id") % 9 != 0, F.concat(F.lit("  Ordér "), F.col("id").cast("string"), F.lit("\t")))
    return t.select("id", S.transaction_hash(F.col("date"), F.col("amount"), F.col("subcategory"), description).alias("transaction_hash"))


@query
def date_parse_multi_format(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    shapes = ["yyyy-MM-dd", "M/d/yyyy", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd", "M/d/yyyy H:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy M d", "M-d-yyyy", "M.d.yyyy"]
    shapes += ["MMMM d yyyy", "d MMM yyyy", "MMMM d, yyyy", "EEEE, d MMMM yyyy", "d-MMM-yyyy"]
    ways = [F.date_format("date", f) for f in shapes] + [F.lit("not-a-date")]
    shown = F.element_at(F.array(*ways), (F.col("id") % len(ways) + 1).cast("int"))
    return t.select("id", S.parse_date(shown).alias("date"))


@query
def date_format_sniff(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    ways = [F.date_format("date", f) for f in ("yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy", "M/d/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "yyyyMMdd", "d MMM yyyy")]
    shown = F.element_at(F.array(*ways), (F.col("id") % len(ways) + 1).cast("int"))
    return t.groupBy(S.date_shape(shown).alias("format")).agg(F.count("*").alias("n"))


@query
def calendar_fields(spark, sf_dir):
    return T.txn(spark, sf_dir).select("id", *[c.alias(k) for k, c in S.calendar(F.col("date")).items()])


@query
def amount_parse(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    ways = [F.col("amount").cast("string"), F.concat(F.lit(" \t"), F.col("amount").cast("string"), F.lit(" ")), F.lit("1,234.50"), F.lit("1e3"), F.lit("n/a"), F.lit("NaN")]
    shown = F.element_at(F.array(*ways), (F.col("id") % len(ways) + 1).cast("int"))
    return t.select("id", S.parse_amount(shown).alias("amount"))


@query
def type_standardize(spark, sf_dir):
    ways = F.array(*map(F.lit, ("Expenses", "EXPENSES", "income", "Transfer", "expense", " Income")))
    return T.txn(spark, sf_dir).select("id", S.standard_type(F.element_at(ways, (F.col("id") % 6 + 1).cast("int"))).alias("transaction_type"))


@query
def type_distribution(spark, sf_dir):
    return T.txn(spark, sf_dir).groupBy("type").agg(F.count("*").alias("n"))


@query
def subcategory_rename(spark, sf_dir):
    t = T.txn(spark, sf_dir).withColumn("kind", S.standard_type(F.col("type")))
    return t.select("id", S.renamed_subcategory(F.col("subcategory"), F.col("kind")).alias("subcategory"))


@query
def currency_conversion(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    base = F.when(F.col("id") % 8 == 0, F.col("amount").cast("double") * 1.95583)
    c = S.conversion(F.col("amount").cast("double"), F.concat(F.lit(" "), F.lower("currency")), base, F.lit("BGN"))
    return t.select("id", *[v.alias(k) for k, v in c.items()])


@query
def sign_normalize(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ("expense", "income", "transfer", "Expense", None, "expenses"))), (F.col("id") % 6 + 1).cast("int"))
    value = F.when(F.col("id") % 2 == 0, F.col("amount")).otherwise(-F.col("amount")).cast("double")
    return t.select("id", S.signed(value, kind).alias("amount"))


@query
def coalesce_payee(spark, sf_dir):
    t = T.txn(spark, sf_dir)
    payee = F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, F.col("payee"))
    return t.select("id", S.counterparty(payee, F.when(F.col("id") % 2 == 0, F.col("account"))).alias("payee"))


@query
def retention_check(spark, sf_dir):
    kept = T.cleaned(spark, sf_dir).agg(F.count("*").alias("n_out"))
    row = T.raw(spark, sf_dir).agg(F.count("*").alias("n_in")).crossJoin(kept)  # one row each
    return row.select("n_in", "n_out", (F.col("n_out") < 0.8 * F.col("n_in")).alias("low_retention"))


@query
def batch_profile(spark, sf_dir):
    return recon.batch_profile(T.cleaned(spark, sf_dir))


def _book(spark, sf_dir):
    return T.txn(spark, sf_dir).withColumnRenamed("subcategory", "category")


def _recon(spark, sf_dir):
    """Two sides of one book: the right one lacks some rows, has others with another amount and starts later."""
    t = _book(spark, sf_dir)
    left = t.where("date < DATE'2000-01-01'")
    amount = F.when(F.col("id") % 37 == 0, F.col("amount") + F.lit(1)).otherwise(F.col("amount")).cast("decimal(12,2)")
    return left, t.where("date >= DATE'1996-01-01' AND id % 41 <> 0").withColumn("amount", amount)


@query
def recon_expense_filter(spark, sf_dir):
    return recon.expense_rows(_book(spark, sf_dir)).select("id", "type", "category")


@query
def recon_missing_keys(spark, sf_dir):
    return recon.missing_both_ways(*_recon(spark, sf_dir)).select("side", "id", "txn_key")


@query
def recon_monthly_outer_join(spark, sf_dir):
    return recon.monthly_comparison(*_recon(spark, sf_dir))


@query
def recon_summary(spark, sf_dir):
    return recon.summary(*_recon(spark, sf_dir))


@query
def category_topk(spark, sf_dir):
    return recon.category_top(_book(spark, sf_dir))


@query
def amount_stats(spark, sf_dir):
    return recon.amount_stats(_book(spark, sf_dir), "type")


@query
def income_expense_breakdown(spark, sf_dir):
    return recon.breakdown(_book(spark, sf_dir), "currency")


@query
def null_profile(spark, sf_dir):
    t = T.txn(spark, sf_dir).select("id", F.when(F.col("id") % 5 != 0, F.col("payee")).alias("payee"), F.when(F.col("id") % 7 == 0, F.col("account")).alias("account"))
    md5 = lambda c: F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")
    return recon.null_profile(t, by=md5).select("column", "n_null", "pct_null", F.array_join("samples", "|").alias("samples"))


@query
def paged_scan(spark, sf_dir):
    """The third page of 200, in the API's order."""
    return Pages(T.txn(spark, sf_dir).select("id", "date"), ["date", "id"]).page(2, 200)


@query
def paged_scan_far(spark, sf_dir):
    """The last whole page of 70, found without passing over those before it."""
    pages = Pages(T.txn(spark, sf_dir).select("id", "date"), ["date", "id"])
    return pages.page(pages.total // 70 - 1, 70)


@query
def pruned_incremental_load(spark, sf_dir):
    """The rows to add to a silver of month folders, which is asked by its ranges of dates and Bloom filters."""
    s = T.silver(spark, sf_dir).select("transaction_hash", "transaction_date", "transaction_type")
    w = Warehouse(spark, new_folder(spark, "warehouse"))
    w.create()
    by = month_of("transaction_date")
    w.commit({"silver.transactions": w.stage("silver.transactions", T.stored(s).repartition(by), by, "transaction_date", "transaction_hash")})
    return w.absent("silver.transactions", T.incoming(s), "transaction_hash", "transaction_date", filter_above=0)


@query
def ordered_export(spark, sf_dir):
    """The anonymised export's order, dates before ids, and the place of every row in it."""
    return layers.numbered(T.txn(spark, sf_dir).select("date", "id"), ["date", "id"], "place").select(F.col("place").cast("long").alias("place"), "date", "id")


@query
def corrected_gold(spark, sf_dir):
    """Notability of a subcategory's expenses after a correction, scored from daily sums where the changed rows reach."""
    s = written(T.silver(spark, sf_dir).select("transaction_hash", "transaction_date", "transaction_type", "amount_abs_eur", "subcategory", "payee"), "silver")
    moved = (F.substring("payee", -1, 1) == "7") & (F.col("subcategory") == "Taxi")
    after = written(s.withColumn("subcategory", F.when(moved, "Fuel").otherwise(F.col("subcategory"))), "corrected")
    changed = s.where(moved & (F.col("transaction_type") == "EXPENSE"))
    changed = changed.unionByName(changed.withColumn("subcategory", F.lit("Fuel")))
    reached = written(merge.reach(changed), "reach")
    daily = rolling.daily_sums(scores.expenses(after))
    out = merge.rescored(after, daily, merge.METRICS["notability"], reached)
    return out.where("subcategory = 'Fuel'").select("transaction_hash", "hist_n_txns", F.round("notability_score", 6).alias("score"), "notability_label")
