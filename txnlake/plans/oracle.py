"""DuckDB SQL for the queries: the same results by another engine."""

from __future__ import annotations

from txnlake.functions import values as V
from txnlake.plans.tables import INCOMING_FROM, PRESET, STORED_UNTIL


def _s(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


_MAPPING = ", ".join(f"({i}, {_s(a)}, {_s(b)}, {_s(c)})" for i, (a, b, c) in enumerate(V.MAPPING))
MAP = f"m(no, subcategory, category, classification) AS (VALUES {_MAPPING})"
TXN = f"""{MAP}, txn AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date,
    CASE WHEN o_orderkey % 50 = 7 THEN 'Transfer' WHEN o_orderstatus = 'P' THEN 'Income' ELSE 'Expenses' END AS type,
    CAST(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE -CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS amount,
    CASE WHEN o_orderkey % 97 = 3 THEN 'Aliments (Financial expenses)' WHEN o_orderkey % 89 = 5 THEN 'Mystery shop' ELSE m.subcategory END AS subcategory,
    CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'BGN' WHEN 2 THEN 'USD' ELSE 'XYZ' END AS currency,
    c_mktsegment AS account, c_name AS payee, o_orderpriority AS payment, 'order ' || CAST(o_orderkey AS VARCHAR) AS description
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey JOIN m ON o_custkey % {len(V.MAPPING)} = m.no)"""


def _hash(date: str, amount: str, sub: str, desc: str) -> str:
    clean = lambda x: f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    return f"sha256(strftime({date}, '%Y-%m-%d') || '|' || printf('%.2f', CAST({amount} AS DOUBLE)) || '|' || {clean(sub)} || '|' || {clean(f'substr({desc}, 1, 100)')})"


def _even(x: str, digits: int = 2) -> str:
    return f"round_even(({x}) * {10.0**digits}, 0) / {10.0**digits}"


RATE = "CASE {c} " + " ".join(f"WHEN '{k}' THEN CAST({v!r} AS DOUBLE)" for k, v in V.EUR_RATES.items()) + " ELSE CAST(1.0 AS DOUBLE) END"
CLEAN = f"""{TXN}, typed AS (
  SELECT id, date, description, payee, account, payment, currency, CAST(amount AS DOUBLE) AS amount,
    CASE lower(type) WHEN 'expenses' THEN 'EXPENSE' WHEN 'income' THEN 'INCOME' END AS transaction_type,
    CASE WHEN subcategory = 'Aliments (Financial expenses)' AND type IN ('Expenses', 'Income') THEN 'Child Support' ELSE subcategory END AS subcategory
  FROM txn), eur AS (
  SELECT *, {RATE.format(c="currency")} AS rate, {_even(f"amount * ({RATE.format(c='currency')})")} AS amount_eur FROM typed WHERE transaction_type IS NOT NULL),
clean AS (
  SELECT *, CASE WHEN currency = 'BGN' THEN {_even("amount")} ELSE {_even("amount_eur / CAST(0.5113 AS DOUBLE)")} END AS amount_bgn,
    {_hash("date", "amount", "subcategory", "description")} AS transaction_hash FROM eur)"""
SILVER = f"""{CLEAN}, silver AS (
  SELECT c.id, c.transaction_hash, c.date AS transaction_date, c.transaction_type, CAST(c.amount AS DECIMAL(12,2)) AS amount, CAST(abs(c.amount) AS DECIMAL(12,2)) AS amount_abs,
    c.currency, CAST(c.amount_eur AS DECIMAL(12,2)) AS amount_eur, CAST(abs(c.amount_eur) AS DECIMAL(12,2)) AS amount_abs_eur,
    CAST(c.rate AS DECIMAL(10,6)) AS eur_conversion_rate, CAST(c.amount_bgn AS DECIMAL(12,2)) AS amount_bgn, c.subcategory, c.account AS account_name, c.payee,
    strftime(c.date, '%Y-%m') AS year_month, m.category,
    CASE WHEN c.transaction_type <> 'INCOME' THEN m.classification END AS classification,
    CASE WHEN c.transaction_type = 'INCOME' THEN CASE WHEN m.category <> 'Income' THEN 'REFUND' ELSE 'REAL' END END AS income_type
  FROM clean c LEFT JOIN m ON c.subcategory = m.subcategory),
  expense AS (SELECT *, date_diff('day', DATE '1970-01-01', transaction_date) AS day, CAST(amount_abs_eur * 100 AS HUGEINT) AS cents FROM silver WHERE transaction_type = 'EXPENSE')"""
ROLL = f"""{SILVER}, frames AS (
  SELECT *, count(*) OVER w1 AS n1, sum(cents) OVER w1 AS s1, sum(cents * cents) OVER w1 AS q1, max(amount_abs_eur) OVER w1 AS m1,
    count(*) OVER w2 AS n2, sum(cents) OVER w2 AS s2, sum(cents * cents) OVER w2 AS q2, max(amount_abs_eur) OVER w2 AS m2
  FROM expense WINDOW w1 AS (PARTITION BY subcategory ORDER BY day RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING),
    w2 AS (PARTITION BY subcategory, day ORDER BY transaction_hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  sums AS (SELECT *, n1 + n2 AS n, coalesce(s1, 0) + coalesce(s2, 0) AS s, coalesce(q1, 0) + coalesce(q2, 0) AS q, greatest(m1, m2) AS mx FROM frames),
  roll AS (SELECT *, CASE WHEN n > 0 THEN CAST(CAST(s AS DOUBLE) / 100 AS DOUBLE) / n END AS av,
    CASE WHEN n >= 2 AND n * q - s * s > 0 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / 10000) / n END AS sd FROM sums),
  scored AS (SELECT *, CASE WHEN sd > 0 THEN (CAST(amount_abs_eur AS DOUBLE) - av) / sd END AS z, n = 0 AS is_new, coalesce(amount_abs_eur > mx, true) AS is_top FROM roll)"""
NOTABLE = f"""{ROLL}, notable AS (SELECT *, greatest(coalesce(z, 0.0), 0.0) + CASE WHEN is_new THEN 4.0 ELSE 0.0 END + CASE WHEN is_top AND NOT is_new THEN 2.0 ELSE 0.0 END AS nscore,
  CASE WHEN is_new THEN 'New Category' WHEN z IS NULL THEN 'Insufficient History' WHEN z >= 3 THEN 'Extreme Outlier' WHEN z >= 2 THEN 'High Outlier'
    WHEN z >= 1 THEN 'Above Average' WHEN is_top THEN 'New Record' ELSE 'Normal' END AS nlabel FROM scored)"""
MONTHS = """mc AS (SELECT year_month, subcategory, count(*) AS month_txn_count, date_diff('day', DATE '1970-01-01', CAST(year_month || '-01' AS DATE)) AS mday FROM expense GROUP BY 1, 2),
  months AS (SELECT *, avg(month_txn_count) OVER (PARTITION BY subcategory ORDER BY mday RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING) AS hist_avg_monthly_count FROM mc)"""
SAVE = f"""{NOTABLE}, {MONTHS}, fr AS (SELECT x.*, k.month_txn_count, k.hist_avg_monthly_count, CASE WHEN k.hist_avg_monthly_count > 0 THEN k.month_txn_count / k.hist_avg_monthly_count END AS ratio,
    CASE classification WHEN 'WANT' THEN 1.0 WHEN 'NEED' THEN 0.4 WHEN 'MUST' THEN 0.05 ELSE 0.4 END::DOUBLE AS avoid
    FROM notable x JOIN months k ON x.year_month = k.year_month AND x.subcategory = k.subcategory),
  ex AS (SELECT *, least(greatest(coalesce(ratio - 1.0, 0.0), 0.0), 3.0) AS fe, least(greatest(coalesce(z, 0.0), 0.0), 5.0) AS ae FROM fr),
  saved AS (SELECT *, avoid * 3.0 + fe * 2.0 + ae * 1.0 AS sscore FROM ex),
  save AS (SELECT *, CASE WHEN sscore >= 5 THEN 'High Save Potential' WHEN sscore >= 3 THEN 'Medium Save Potential' WHEN sscore >= 1 THEN 'Low Save Potential' ELSE 'Minimal' END AS slabel FROM saved)"""
STORED, INCOMING = f"transaction_date < DATE '{STORED_UNTIL}'", f"transaction_date >= DATE '{INCOMING_FROM}'"
NEW = f"{INCOMING} AND transaction_hash NOT IN (SELECT transaction_hash FROM silver WHERE {STORED})"
SIDES = f"""{TXN}, book AS (SELECT * RENAME (subcategory AS category) FROM txn), lft AS (SELECT * RENAME (subcategory AS category) FROM txn WHERE date < DATE '2000-01-01'),
  rgt AS (SELECT id, date, type, CAST(CASE WHEN id % 37 = 0 THEN amount + 1 ELSE amount END AS DECIMAL(12,2)) AS amount, subcategory AS category FROM txn WHERE date >= DATE '1996-01-01' AND id % 41 <> 0),
  lk AS (SELECT *, strftime(date, '%Y-%m-%d') || '_' || CAST(amount AS VARCHAR) || '_' || category AS txn_key FROM lft),
  rk AS (SELECT *, strftime(date, '%Y-%m-%d') || '_' || CAST(amount AS VARCHAR) || '_' || category AS txn_key FROM rgt)"""


def _pick(names: list[str], seed: str) -> str:
    return f"list_extract([{', '.join(map(_s, names))}], CAST({seed} % {len(names)} AS BIGINT) + 1)"


def _seed(first: int) -> str:
    return f"CAST('0x' || substr(transaction_hash, {first}, 8) AS BIGINT)"


def _has(keys: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(subcategory), {_s(k)})" for k in keys) + ")"


MERCHANT = "CASE " + " ".join(f"WHEN contains(lower(subcategory), {_s(k)}) THEN {_pick(v, _seed(1))}" for k, v in V.MERCHANTS.items()) + " ELSE subcategory END"
CITY = (
    f"CASE WHEN {_has(V.TRAVEL_KEYS)} THEN {_pick(V.TRAVEL_CITIES, _seed(9))} WHEN {_has(V.SUBSCRIPTION_KEYS)} THEN {_pick(V.SUBSCRIPTION_CITIES, _seed(9))} "
    f"WHEN month(transaction_date) IN (6, 7, 8, 9) AND {_has(V.OUTDOOR_KEYS)} AND {_seed(9)} % 6 = 0 THEN 'Burgas' ELSE 'Sofia' END"
)
_RANK = "row_number() OVER (ORDER BY count(*) DESC, {c}) AS r"
ALLOWED = ", ".join(map(_s, PRESET["allowed_accounts"]))
_FMT = {"yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y", "dd.MM.yyyy": "%d.%m.%Y", "M/d/yyyy": "%-m/%-d/%Y", "yyyy/MM/dd": "%Y/%m/%d", "dd-MM-yyyy": "%d-%m-%Y", "yyyyMMdd": "%Y%m%d", "d MMM yyyy": "%-d %b %Y"}
_SHOWN = "CASE id % 8 " + " ".join(f"WHEN {i} THEN strftime(date, '{f}')" for i, f in enumerate(_FMT.values())) + " END"
_SHAPE = "CASE " + " ".join(f"WHEN regexp_matches(s, {_s(p)}) THEN {_s(n)}" for p, n in V.DATE_SHAPES) + f" ELSE {_s(V.UNKNOWN_SHAPE)} END"
_REASON = """CASE WHEN is_new THEN 'First time spending in ' || subcategory WHEN is_top THEN 'Largest ever ' || subcategory || ' transaction'
  WHEN z >= 2 THEN printf('%.1f', round_even(z * 10, 0) / 10) || 'σ above your usual ' || subcategory || ' spend (avg €' || printf('%.0f', round_even(av, 0)) || ')' END"""
_SREASON = """CASE classification WHEN 'WANT' THEN 'Discretionary (WANT)' WHEN 'NEED' THEN 'Necessary (NEED)' WHEN 'MUST' THEN 'Obligation (MUST)' ELSE 'Necessary (NEED, default)' END
  || CASE WHEN ratio > 1.01 THEN ' + ' || printf('%.1f', round_even(ratio * 10, 0) / 10) || 'x usual ' || subcategory || ' frequency this month' ELSE '' END
  || CASE WHEN z >= 1 THEN ' + ' || printf('%.1f', round_even(z * 10, 0) / 10) || 'σ above avg ' || subcategory || ' spend' ELSE '' END"""

ORACLE: dict[str, str] = {
    "scan_filter_project": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders WHERE o_totalprice > 200000",
    "staging_projection": f"WITH {TXN} SELECT strftime(date, '%Y-%m-%d') AS date, description AS note, type, payee, CAST(amount AS VARCHAR) AS amount, '' AS labels, account, subcategory AS category, currency, payment, 'export.csv' AS source_file, 'batch-1' AS batch_id FROM txn",
    "bronze_projection": f"WITH {CLEAN} SELECT date AS transaction_date, description, transaction_type, payee, CAST(amount AS DECIMAL(12,2)) AS amount, '' AS labels, account AS account_name, subcategory, currency, payment AS payment_method, 'export.csv' AS source_file, 'batch-1' AS ingestion_batch_id FROM clean",
    "silver_projection": f"WITH {SILVER} SELECT transaction_hash, transaction_date, transaction_type, amount, amount_abs, currency, amount_eur, eur_conversion_rate, amount_bgn, subcategory, account_name, year_month, CAST(NULL AS VARCHAR) AS classification FROM silver",
    "api_field_map": f"""WITH {TXN}, f AS (SELECT *, CASE id % 6 WHEN 0 THEN 'income' WHEN 1 THEN 'expense' WHEN 2 THEN 'transfer' WHEN 3 THEN 'expenses' WHEN 5 THEN 'INCOME' END AS k,
      CASE id % 5 WHEN 0 THEN 'CASH' WHEN 1 THEN 'DEBIT_CARD' WHEN 2 THEN '' WHEN 3 THEN 'VOUCHER' ELSE 'BARTER' END AS p, CAST(abs(amount) AS DOUBLE) AS a FROM txn)
      SELECT CAST(id AS VARCHAR) AS source_record_id, strftime(date, '%Y-%m-%d') AS date, CASE lower(k) WHEN 'income' THEN 'Income' WHEN 'transfer' THEN 'Transfer' ELSE 'Expenses' END AS type,
      CASE WHEN id % 3 = 0 THEN 'payer' ELSE payee END AS payee, CASE WHEN coalesce(k, 'expense') = 'expense' THEN -a ELSE a END AS amount, subcategory AS category, currency, p AS payment FROM f""",
    "row_number_lineage": f"WITH {TXN} SELECT id, row_number() OVER (ORDER BY date, id) AS source_row_number FROM txn",
    "json_flatten": """SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "recordDate", round(value, 2) AS amount_value, CASE WHEN user_id % 2 = 0 THEN 'EUR' ELSE 'BGN' END AS amount_currency,
      'c' || CAST(user_id % 10 AS VARCHAR) AS category_id, CAST(user_id AS VARCHAR) AS "accountId", CASE WHEN user_id % 4 <> 0 THEN event_type || ', , z' ELSE '' END AS labels,
      CASE WHEN user_id % 3 = 0 THEN round(value, 2) END AS base_amount_value, CASE WHEN user_id % 3 = 0 THEN 'BGN' ELSE 'EUR' END AS base_amount_currency, json_extract_string(props, '$.k') AS k FROM events""",
    "final_cleanup": f"WITH {CLEAN} SELECT transaction_hash, date, transaction_type, CAST(amount AS DECIMAL(12,2)) AS amount FROM clean WHERE id % 10 NOT IN (3, 4)",
    "account_filter": f"WITH {TXN} SELECT id, account, date FROM txn WHERE account IN ({ALLOWED}) AND NOT (account = 'BUILDING' AND date > DATE '1998-06-30')",
    "unrecognized_accounts": f"WITH {TXN} SELECT account, count(*) AS n FROM txn WHERE account NOT IN ({ALLOWED}) GROUP BY 1",
    "gold_slice_scan": f"WITH {SILVER} SELECT transaction_hash, transaction_date, amount_abs_eur, subcategory FROM expense WHERE subcategory IN ('Groceries', 'Taxi', 'Fuel') AND transaction_date BETWEEN DATE '1999-01-10' - 365 AND DATE '1999-06-20'",
    "silver_watermark": f"WITH {SILVER} SELECT max(transaction_date) AS watermark, max(transaction_date) + 1 AS next_from FROM silver WHERE {STORED}",
    "category_parent_self_join": """WITH c AS (SELECT 'n' || n_nationkey AS id, n_name AS name, 'r' || n_regionkey AS "parentId" FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name, NULL FROM region)
      SELECT a.id, a.name, a."parentId", b.name AS parent_name FROM c a LEFT JOIN c b ON a."parentId" = b.id""",
    "lookup_default_join": "SELECT s_suppkey, coalesce(n_name, nid, '') AS name FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS nid FROM supplier) LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name FROM nation WHERE n_nationkey < 15) ON nid = k",
    "incremental_anti_join": f"WITH {SILVER} SELECT transaction_hash, transaction_date, transaction_type FROM silver WHERE {NEW}",
    "late_data_overlap": f"WITH {SILVER} SELECT transaction_type, count(*) AS n, min(transaction_date) AS first FROM silver WHERE transaction_date >= (SELECT max(transaction_date) - 30 FROM silver WHERE {STORED}) AND transaction_hash NOT IN (SELECT transaction_hash FROM silver WHERE {STORED}) GROUP BY 1",
    "bronze_union_batches": "SELECT 'batch-' || CAST(event_id % 2 AS VARCHAR) AS batch, event_type, count(*) AS n, count(CASE WHEN event_id % 2 = 0 THEN user_id END) AS n_users FROM events GROUP BY 1, 2",
    "seed_insert_if_absent": f"""WITH {MAP}, known AS (SELECT DISTINCT p_type FROM part WHERE p_size < 5), seed AS (SELECT DISTINCT p_type FROM part)
      SELECT subcategory, category, classification FROM m UNION ALL SELECT p_type, 'Other', 'NEED' FROM known UNION ALL SELECT p_type, 'Shopping', 'WANT' FROM seed WHERE p_type NOT IN (SELECT p_type FROM known)""",
    "duplicate_hash_report": """WITH l AS (SELECT sha256(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)) AS transaction_hash, l_orderkey, l_linenumber, l_partkey FROM lineitem)
      SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY transaction_hash) AS n FROM l) WHERE n > 1""",
    "category_enrichment": f"WITH {SILVER} SELECT transaction_hash, subcategory, category, classification, transaction_type, income_type FROM silver",
    "dq_flags": f"""WITH {SILVER}, f AS (SELECT s.transaction_hash, s.subcategory, s.transaction_type, concat_ws(',', CASE WHEN s.category IS NULL THEN 'UNMAPPED_SUBCAT' END,
      CASE WHEN s.subcategory IN ('Transfer', 'Transfer, withdraw') THEN 'TRANSFER' END, CASE WHEN s.transaction_type = 'INCOME' AND s.subcategory = 'Aliments' THEN 'ALIMENTS_INCOME' END,
      CASE WHEN s.transaction_type = 'INCOME' AND s.category IS NULL THEN 'INCOME_UNMAPPED_REAL' END, CASE WHEN s.transaction_type = 'INCOME' AND s.category <> 'Income' THEN 'INCOME_NON_INCOME_REFUND' END) AS flags FROM silver s)
      SELECT *, contains(flags, 'UNMAPPED') AS is_error FROM f WHERE flags <> ''""",
    "monthly_subcategory_counts": f"WITH {TXN} SELECT strftime(date, '%Y-%m') AS year_month, CASE WHEN id % 11 <> 0 THEN subcategory END AS subcategory, count(*) AS n FROM txn GROUP BY 1, 2",
    "monthly_frequency_baseline": f"WITH {SILVER}, {MONTHS} SELECT year_month, subcategory, month_txn_count, round(hist_avg_monthly_count, 6) AS hist_avg_monthly_count FROM months",
    "rolling_stats": f"WITH {ROLL} SELECT transaction_hash, n AS hist_n_txns, round(av, 6) AS hist_avg_amount_eur, round(sd, 6) AS hist_std_amount_eur, mx AS hist_max_amount_eur FROM roll",
    "notability": f"WITH {NOTABLE} SELECT transaction_hash, n AS hist_n_txns, round(z, 6) AS z, is_new AS is_new_subcategory, is_top AS is_new_subcategory_max, round(nscore, 6) AS score, nlabel AS notability_label, {_REASON} AS notability_reason FROM notable",
    "save_potential": f"WITH {SAVE} SELECT transaction_hash, avoid AS avoidability, month_txn_count, round(hist_avg_monthly_count, 6) AS hist_avg_monthly_count, round(ratio, 6) AS freq_ratio, round(fe, 6) AS freq_excess, round(ae, 6) AS amt_excess, round(sscore, 6) AS save_potential_score, slabel AS save_potential_label, {_SREASON} AS save_potential_reason FROM save",
    "gold_target_info": f"WITH {SILVER} SELECT CAST(count(DISTINCT subcategory) AS INTEGER) AS n_subcategories, min(transaction_date) AS date_from, max(transaction_date) AS date_to FROM silver WHERE transaction_type = 'EXPENSE' AND {NEW}",
    "gold_upsert_merge": f"""WITH {SILVER} SELECT transaction_hash, transaction_date, amount_abs_eur, subcategory, CAST(NULL AS VARCHAR) AS extra_stats FROM silver WHERE {STORED} AND NOT ({INCOMING})
      UNION ALL SELECT transaction_hash, transaction_date, CAST(amount_abs_eur * 2 AS DECIMAL(12,2)), CAST(NULL AS VARCHAR), '{{"v":"' || subcategory || '"}}' FROM silver WHERE {INCOMING}""",
    "gold_incremental_refresh": f"WITH {SAVE} SELECT transaction_hash, month_txn_count, round(hist_avg_monthly_count, 6) AS hist_avg_monthly_count, round(sscore, 6) AS score, slabel AS save_potential_label FROM save WHERE {NEW}",
    "audit_diff": f"""WITH {SILVER}, d AS (SELECT *, right(payee, 1) AS x FROM silver), c AS (SELECT *, x IN ('1', '2') AND subcategory <> 'Rent' AS cs, x = '2' AND account_name IS NOT NULL AS ca FROM d)
      SELECT transaction_hash, CASE WHEN x = '0' THEN 'DELETE' ELSE 'UPDATE' END AS operation, CASE WHEN x <> '0' THEN concat_ws(',', CASE WHEN cs THEN 'subcategory' END, CASE WHEN ca THEN 'account_name' END) END AS changed_fields,
      CASE WHEN x = '0' OR cs THEN subcategory END AS old_subcategory, CASE WHEN x <> '0' AND cs THEN 'Rent' END AS new_subcategory, 'tester' AS actor, 'check' AS reason FROM c WHERE x = '0' OR cs OR ca""",
    "anonymized_export": f"""WITH {SAVE}, pr AS (SELECT payee AS v, {_RANK.format(c="payee")} FROM silver GROUP BY payee), ar AS (SELECT account_name AS v, {_RANK.format(c="account_name")} FROM silver GROUP BY account_name),
      al AS (SELECT s.*, 'Account #' || CAST(ar.r AS VARCHAR) AS alias FROM silver s LEFT JOIN ar ON s.account_name = ar.v), gr AS (SELECT alias AS v, {_RANK.format(c="alias")} FROM al GROUP BY alias),
      names AS (SELECT transaction_hash, {MERCHANT} AS merchant, {CITY} AS city FROM silver)
      SELECT al.transaction_hash, al.transaction_date, merchant, city, merchant || ' – ' || city AS description, 'Merchant #' || CAST(pr.r AS VARCHAR) AS payee, al.alias AS account_name,
      CASE WHEN gr.r > 3 THEN 'Account Group #other' ELSE 'Account Group #' || CAST(gr.r AS VARCHAR) END AS account_group, {_even("CAST(al.amount AS DOUBLE) * CAST(0.73 AS DOUBLE)")} AS amount, {_even("CAST(al.amount_eur AS DOUBLE) * CAST(0.73 AS DOUBLE)")} AS amount_eur,
      save.nlabel AS notability_label, save.slabel AS save_potential_label
      FROM al JOIN names USING (transaction_hash) LEFT JOIN pr ON al.payee = pr.v LEFT JOIN gr ON al.alias = gr.v LEFT JOIN save ON al.transaction_hash = save.transaction_hash""",
    "frequency_rank_alias": f"""WITH {TXN}, v AS (SELECT id, CASE WHEN id % 13 = 0 THEN NULL ELSE subcategory END AS name FROM txn), k AS (SELECT name AS v, {_RANK.format(c="name")} FROM v WHERE name IS NOT NULL GROUP BY name)
      SELECT id, CASE WHEN r > 20 THEN 'Label #other' ELSE 'Label #' || CAST(r AS VARCHAR) END AS name FROM v LEFT JOIN k ON v.name = k.v""",
    "scale_euros_in_text": f"""WITH {TXN} SELECT id, 'paid €' || printf('%.0f', round_even(CAST(abs(amount) AS DOUBLE) * CAST(0.73 AS DOUBLE), 0)) || ' of €' || printf('%.0f', round_even(CAST(id % 1000 AS DOUBLE) * CAST(0.73 AS DOUBLE), 0)) || ' (€x)' AS text FROM txn""",
    "transaction_hash": f"WITH {TXN} SELECT id, {_hash('date', 'amount', 'subcategory', '''CASE WHEN id % 9 <> 0 THEN '  Ordér ' || CAST(id AS VARCHAR) || chr(9) ELSE '' END''')} AS transaction_hash FROM txn",
    "date_parse_multi_format": f"WITH {TXN} SELECT id, CASE WHEN id % 16 < 15 THEN date END AS date FROM txn",
    "date_format_sniff": f"WITH {TXN}, x AS (SELECT {_SHOWN} AS s FROM txn) SELECT {_SHAPE} AS format, count(*) AS n FROM x GROUP BY 1",
    "calendar_fields": f"""WITH {TXN} SELECT id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month,
      CAST(isodow(date) AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_of_year, isodow(date) IN (6, 7) AS is_weekend FROM txn""",
    "amount_parse": f"WITH {TXN} SELECT id, CASE id % 6 WHEN 0 THEN CAST(amount AS DOUBLE) WHEN 1 THEN CAST(amount AS DOUBLE) WHEN 3 THEN CAST(1000 AS DOUBLE) END AS amount FROM txn",
    "type_standardize": f"WITH {TXN} SELECT id, CASE id % 6 WHEN 0 THEN 'EXPENSE' WHEN 1 THEN 'EXPENSE' WHEN 2 THEN 'INCOME' END AS transaction_type FROM txn",
    "type_distribution": f"WITH {TXN} SELECT type, count(*) AS n FROM txn GROUP BY 1",
    "subcategory_rename": f"WITH {TXN} SELECT id, CASE WHEN subcategory = 'Aliments (Financial expenses)' AND type <> 'Transfer' THEN 'Child Support' ELSE subcategory END AS subcategory FROM txn",
    "currency_conversion": f"""WITH {TXN}, x AS (SELECT id, currency, CAST(amount AS DOUBLE) AS a, {RATE.format(c="currency")} AS r FROM txn), e AS (SELECT *, {_even("a * r")} AS eur FROM x),
      b AS (SELECT *, CASE WHEN currency = 'BGN' THEN {_even("a")} WHEN currency = 'EUR' AND id % 8 = 0 THEN {_even("a * CAST(1.95583 AS DOUBLE)")} ELSE {_even("eur / CAST(0.5113 AS DOUBLE)")} END AS bgn FROM e)
      SELECT id, currency, r AS eur_conversion_rate, eur AS amount_eur, abs(eur) AS amount_abs_eur, bgn AS amount_bgn, abs(bgn) AS amount_abs_bgn FROM b""",
    "sign_normalize": f"""WITH {TXN}, x AS (SELECT id, CAST(CASE WHEN id % 2 = 0 THEN amount ELSE -amount END AS DOUBLE) AS v, CASE id % 6 WHEN 1 THEN 'i' WHEN 2 THEN 't' WHEN 5 THEN 't' ELSE 'e' END AS k FROM txn)
      SELECT id, CASE WHEN k = 'e' AND v > 0 THEN -v WHEN k = 'i' AND v < 0 THEN -v ELSE v END AS amount FROM x""",
    "coalesce_payee": f"WITH {TXN} SELECT id, CASE WHEN id % 3 = 1 THEN payee WHEN id % 2 = 0 THEN account ELSE '' END AS payee FROM txn",
    "retention_check": f"WITH {TXN} SELECT count(*) AS n_in, count(*) FILTER (type <> 'Transfer') AS n_out, count(*) FILTER (type <> 'Transfer') < 0.8 * count(*) AS low_retention FROM txn",
    "batch_profile": f"WITH {CLEAN} SELECT count(*) AS n, count(*) - count(DISTINCT transaction_hash) AS n_duplicates, min(date) AS first, max(date) AS last, CAST(min(amount) AS DECIMAL(18,2)) AS least, CAST(max(amount) AS DECIMAL(18,2)) AS most, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM clean",
    "recon_expense_filter": f"WITH {SIDES} SELECT id, type, category FROM book WHERE contains(lower(type), 'expense') AND NOT regexp_matches(lower(category), 'transfer|withdraw')",
    "recon_missing_keys": f"WITH {SIDES} SELECT 'left' AS side, id, txn_key FROM lk WHERE txn_key NOT IN (SELECT txn_key FROM rk) UNION ALL SELECT 'right', id, txn_key FROM rk WHERE txn_key NOT IN (SELECT txn_key FROM lk)",
    "recon_monthly_outer_join": f"""WITH {SIDES}, span AS (SELECT greatest((SELECT min(date) FROM lft), (SELECT min(date) FROM rgt)) AS a, least((SELECT max(date) FROM lft), (SELECT max(date) FROM rgt)) AS b),
      lm AS (SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS t FROM lft, span WHERE date BETWEEN a AND b GROUP BY 1),
      rm AS (SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS t FROM rgt, span WHERE date BETWEEN a AND b GROUP BY 1)
      SELECT month, coalesce(lm.n, 0) AS n_left, coalesce(lm.t, 0) AS total_left, coalesce(rm.n, 0) AS n_right, coalesce(rm.t, 0) AS total_right, coalesce(lm.n, 0) - coalesce(rm.n, 0) AS n_diff, CAST(coalesce(lm.t, 0) - coalesce(rm.t, 0) AS DECIMAL(18,2)) AS total_diff FROM lm FULL JOIN rm USING (month)""",
    "recon_summary": f"""WITH {SIDES}, l AS (SELECT count(*) AS n_left, count(DISTINCT txn_key) AS keys_left, CAST(sum(amount) AS DECIMAL(18,2)) AS total_left FROM lk), r AS (SELECT count(*) AS n_right, count(DISTINCT txn_key) AS keys_right, CAST(sum(amount) AS DECIMAL(18,2)) AS total_right FROM rk),
      x AS (SELECT *, CAST(abs(total_left - total_right) AS DOUBLE) / CAST(abs(total_left) AS DOUBLE) AS share FROM l, r)
      SELECT n_left, keys_left, total_left, n_right, keys_right, total_right, round(share * 100, 4) AS diff_pct, CASE WHEN share < 0.05 THEN 'similar' WHEN share < 0.15 THEN 'moderate' ELSE 'significant' END AS verdict FROM x""",
    "category_topk": f"WITH {SIDES} SELECT category, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS total FROM book GROUP BY 1 ORDER BY n DESC, category LIMIT 15",
    "amount_stats": f"WITH {SIDES} SELECT type, round(avg(CAST(amount AS DOUBLE)), 4) AS mean, round(median(CAST(amount AS DOUBLE)), 4) AS median, min(CAST(amount AS DOUBLE)) AS least, max(CAST(amount AS DOUBLE)) AS most FROM book GROUP BY 1",
    "income_expense_breakdown": f"""WITH {SIDES} SELECT currency, CAST(coalesce(sum(amount) FILTER (amount < 0), 0) AS DECIMAL(18,2)) AS expenses, CAST(coalesce(sum(amount) FILTER (amount > 0), 0) AS DECIMAL(18,2)) AS income, CAST(sum(amount) AS DECIMAL(18,2)) AS net,
      count(*) FILTER (amount < 0) AS n_expenses, count(*) FILTER (amount > 0) AS n_income, count(*) FILTER (amount = 0) AS n_zero FROM book GROUP BY 1""",
    "null_profile": f"""WITH {TXN}, v AS (SELECT 'id' AS c, CAST(id AS VARCHAR) AS v FROM txn UNION ALL SELECT 'payee', CASE WHEN id % 5 <> 0 THEN payee END FROM txn UNION ALL SELECT 'account', CASE WHEN id % 7 = 0 THEN account END FROM txn),
      h AS (SELECT *, CAST('0x' || substr(md5(v), 1, 8) AS BIGINT) AS h FROM v)
      SELECT c AS "column", count(*) FILTER (v IS NULL) AS n_null, round(count(*) FILTER (v IS NULL) * 100.0::DOUBLE / count(*), 4) AS pct_null,
      concat_ws('|', {", ".join(f"arg_min(v, h) FILTER (v IS NOT NULL AND h % 3 = {i})" for i in range(3))}) AS samples FROM h GROUP BY c""",
    "paged_scan": f"WITH {TXN} SELECT id, date FROM txn ORDER BY date, id LIMIT 200 OFFSET 400",
    "paged_scan_far": f"WITH {TXN}, o AS (SELECT id, date, row_number() OVER (ORDER BY date, id) AS r, count(*) OVER () AS n FROM txn) SELECT id, date FROM o WHERE r > (n // 70 - 1) * 70 AND r <= n // 70 * 70",
    "pruned_incremental_load": f"WITH {SILVER} SELECT transaction_hash, transaction_date, transaction_type FROM silver WHERE {NEW}",
    "ordered_export": f"WITH {TXN} SELECT row_number() OVER (ORDER BY date, id) AS place, date, id FROM txn",
    "corrected_gold": f"""WITH {NOTABLE.replace("expense AS (SELECT *,", "expense AS (SELECT * REPLACE (CASE WHEN right(payee, 1) = '7' AND subcategory = 'Taxi' THEN 'Fuel' ELSE subcategory END AS subcategory),")},
      moved AS (SELECT DISTINCT year_month AS first, strftime(transaction_date + 365, '%Y-%m') AS last FROM silver WHERE right(payee, 1) = '7' AND subcategory = 'Taxi' AND transaction_type = 'EXPENSE')
      SELECT transaction_hash, n AS hist_n_txns, round(nscore, 6) AS score, nlabel AS notability_label FROM notable x WHERE subcategory = 'Fuel' AND EXISTS (SELECT 1 FROM moved WHERE x.year_month BETWEEN first AND last)""",
}
