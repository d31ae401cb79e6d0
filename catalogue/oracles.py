"""SQL that another engine runs on the same tables to check every query.

Written from the definitions, not from the Spark plans: UNION ALL instead of
generators, joins and subqueries instead of key marking.
"""

from __future__ import annotations

_SLOTS = range(1, 7)
_CARD_STATUS = ("PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6")


def _each(pattern: str) -> str:
    return ", ".join(pattern.format(n=n) for n in _SLOTS)


# The outer slots are open, so that every order has one.
_BASE = f"""
slotted AS (
  SELECT *, CASE WHEN year(o_orderdate) >= 2000 THEN 1 WHEN year(o_orderdate) > 1995 THEN 2001 - year(o_orderdate)
    ELSE 6 END AS order_slot, CAST(order_slot AS INTEGER) AS slot FROM orders),
yearly AS (
  SELECT o_custkey, {_each(
      "count(*) FILTER (WHERE slot = {n}) AS n_{n}, "
      "sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CAST(round(o_totalprice * 100) AS BIGINT))"
      " FILTER (WHERE slot = {n}) AS b_{n}, "
      "sum(CAST(round(o_totalprice * 100) AS BIGINT))"
      " FILTER (WHERE slot = {n} AND o_orderstatus = 'P') AS p_{n}")}
  FROM slotted GROUP BY o_custkey),
base AS (
  SELECT c_custkey + 1 AS idn, CAST(round(c_acctbal * 100) AS BIGINT) AS balance, c_mktsegment,
    {_each(
      "CAST(CASE WHEN coalesce(n_{n}, 0) = 0 THEN -2 WHEN n_{n} = 1 THEN 0 ELSE least(n_{n}, 9) END AS VARCHAR) AS s_{n}, "
      "CAST(CAST(coalesce(b_{n}, 0) AS BIGINT) AS VARCHAR) AS bill_{n}, "
      "CAST(CAST(coalesce(p_{n}, 0) AS BIGINT) AS VARCHAR) AS pay_{n}")}
  FROM customer LEFT JOIN yearly ON o_custkey = c_custkey)"""

_INTEGER = "CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS BIGINT) END"

# --- the account snapshot -------------------------------------------------

_ACCT_COLUMNS = (
    ["id", "limit_bal", "segment"]
    + [f"status_{n}" for n in _SLOTS] + [f"bill_{n}" for n in _SLOTS] + [f"pay_{n}" for n in _SLOTS]
)
_ACCT_INTEGERS = [c for c in _ACCT_COLUMNS if c != "segment"]


def _typing(columns: list[str], integers: list[str]) -> str:
    return ", ".join(
        f"{_INTEGER.format(c=c)} AS t_{c}" if c in integers else f"{c} AS t_{c}" for c in columns
    )


def _pipeline(name: str, columns, integers, id_column: str, rules: list[tuple[str, str]]) -> str:
    codes = ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in rules)
    return f"""
{name}_unique AS (SELECT {', '.join(columns)}, count(*) AS copies FROM {name}_raw GROUP BY ALL),
{name}_typed AS (SELECT *, {_typing(columns, integers)} FROM {name}_unique),
{name}_conflicts AS (
  SELECT t_{id_column} AS k FROM {name}_typed WHERE t_{id_column} IS NOT NULL
  GROUP BY 1 HAVING count(*) > 1),
{name}_checked AS (
  SELECT *, concat_ws('|', {codes}) AS rejection_reason
  FROM {name}_typed LEFT JOIN {name}_conflicts ON k = t_{id_column})"""


_ACCT = f"""
WITH {_BASE},
acct_base AS (
  SELECT idn, CAST(idn AS VARCHAR) AS id,
    CASE WHEN idn % 31 = 0 THEN '-1' ELSE CAST(balance AS VARCHAR) END AS limit_bal,
    c_mktsegment AS segment, {_each("s_{n} AS status_{n}")},
    CASE WHEN idn % 37 = 0 THEN 'oops' ELSE bill_1 END AS bill_1, bill_2, bill_3, bill_4, bill_5, bill_6,
    pay_1, pay_2, CASE WHEN idn % 41 = 0 THEN '-5' ELSE pay_3 END AS pay_3, pay_4, pay_5, pay_6
  FROM base),
acct_raw AS (
  SELECT * EXCLUDE (idn) FROM acct_base
  UNION ALL SELECT * EXCLUDE (idn) FROM acct_base WHERE idn % 50 = 0
  UNION ALL SELECT * EXCLUDE (idn) REPLACE (limit_bal || '1' AS limit_bal) FROM acct_base WHERE idn % 97 = 0
  UNION ALL SELECT * EXCLUDE (idn) REPLACE ('0' || id AS id) FROM acct_base WHERE idn % 89 = 0),
{_pipeline("acct", _ACCT_COLUMNS, _ACCT_INTEGERS, "id", [
    ("missing_or_noninteger", " OR ".join(f"t_{c} IS NULL" for c in _ACCT_INTEGERS)),
    ("invalid_account_id", "t_id <= 0"),
    ("nonpositive_limit", "t_limit_bal <= 0"),
    ("conflicting_account_id", "k IS NOT NULL"),
    *[(f"invalid_status_{n}", f"t_status_{n} < -2 OR t_status_{n} > 9") for n in _SLOTS],
    *[(f"negative_pay_{n}", f"t_pay_{n} < 0") for n in _SLOTS],
])},
acct_ok AS (SELECT * FROM acct_checked WHERE rejection_reason = ''),
acct_dim AS (
  SELECT t_id AS account_id, t_limit_bal AS credit_limit_cents,
    CASE WHEN t_limit_bal < 200000 THEN 'low' WHEN t_limit_bal < 600000 THEN 'mid' ELSE 'high' END AS limit_band
  FROM acct_ok),
acct_fact AS ({" UNION ALL ".join(
    f"SELECT t_id AS account_id, DATE '{2001 - n}-01-01' AS month, t_status_{n} AS repayment_status, "
    f"t_bill_{n} AS bill_cents, t_pay_{n} AS payment_cents, greatest(t_bill_{n}, 0) AS positive_bill_cents, "
    f"t_status_{n} >= 2 AS delayed_2plus, t_status_{n} IN (-2, 0) AS status_not_documented FROM acct_ok"
    for n in _SLOTS)})"""


def _monthly(fact: str, unit: str) -> str:
    late = f"CAST(coalesce(sum(positive_bill_{unit}) FILTER (WHERE delayed_2plus), 0) AS BIGINT)"
    total = f"CAST(sum(positive_bill_{unit}) AS BIGINT)"
    return f"""
  SELECT month, count(*) AS accounts, count(*) FILTER (WHERE delayed_2plus) AS delayed_accounts,
    CAST(count(*) FILTER (WHERE delayed_2plus) AS DOUBLE) / count(*) AS delayed_account_rate,
    {total} AS positive_bill_{unit}, {late} AS delayed_bill_{unit},
    CASE WHEN {total} > 0 THEN CAST({late} AS DOUBLE) / CAST({total} AS DOUBLE) END AS delayed_bill_share,
    CAST(sum(payment_{unit}) AS BIGINT) AS payments_{unit},
    count(*) FILTER (WHERE status_not_documented) AS undocumented_status_accounts
  FROM {fact} GROUP BY month"""


def _segments(fact: str, dim: str, unit: str) -> str:
    return f"""
  SELECT month, limit_band, count(*) AS accounts,
    CAST(sum(positive_bill_{unit}) AS BIGINT) AS positive_bill_{unit},
    count(*) FILTER (WHERE delayed_2plus) AS delayed_accounts,
    CAST(count(*) FILTER (WHERE delayed_2plus) AS DOUBLE) / count(*) AS delayed_account_rate
  FROM {fact} JOIN {dim} USING (account_id) GROUP BY month, limit_band"""


def _alerts(rates: str, per: str = "", threshold: float = 1.0) -> str:
    entity = f"{per}, " if per else ""
    scope = f"PARTITION BY {per} " if per else ""
    change = "CAST(100.0 AS DOUBLE) * (delayed_account_rate - previous_rate)"
    return f"""
  SELECT {entity}month, delayed_account_rate, previous_rate, {change} AS change_percentage_points,
    CAST({threshold} AS DOUBLE) AS threshold_percentage_points,
    CASE WHEN previous_rate IS NULL THEN 'BASELINE' WHEN {change} >= {threshold} THEN 'REVIEW'
      ELSE 'WITHIN_THRESHOLD' END AS alert_status
  FROM (SELECT *, lag(delayed_account_rate) OVER ({scope}ORDER BY month) AS previous_rate FROM {rates})"""


_ACCT_GOLD = f"""{_ACCT},
monthly AS ({_monthly("acct_fact", "cents")}),
segments AS ({_segments("acct_fact", "acct_dim", "cents")}),
alerts AS ({_alerts("monthly")})"""

_COUNTS = """
counts AS (
  SELECT CAST(sum(copies) AS BIGINT) AS raw_rows, count(*) AS unique_rows,
    CAST(sum(copies) - count(*) AS BIGINT) AS exact_duplicates,
    count(*) FILTER (WHERE rejection_reason <> '') AS rejected_rows,
    count(*) FILTER (WHERE rejection_reason = '') AS accepted_accounts,
    6 * count(*) FILTER (WHERE rejection_reason = '') AS monthly_rows
  FROM acct_checked)"""

# All rows of the spoiled batch have one status of the first slot; copies by everything else collapse.
_SPOILED = f"""
spoiled AS (SELECT DISTINCT * EXCLUDE (status_1) FROM acct_raw),
failed AS (SELECT (SELECT count(*) FROM acct_raw) AS raw_rows, (SELECT count(*) FROM spoiled) AS unique_rows)"""

# --- the card snapshot ----------------------------------------------------

_CARD_BILLS = [f"BILL_AMT{n}" for n in _SLOTS]
_CARD_PAYMENTS = [f"PAY_AMT{n}" for n in _SLOTS]
_CARD_COLUMNS = [
    "ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
    *_CARD_STATUS, *_CARD_BILLS, *_CARD_PAYMENTS, "default_next_month",
]
_CARD = f"""
WITH {_BASE},
card_base AS (
  SELECT idn, CAST(idn AS VARCHAR) AS ID,
    CASE WHEN idn % 47 = 0 THEN 'oops' ELSE CAST(balance AS VARCHAR) END AS LIMIT_BAL,
    CASE WHEN idn % 53 = 0 THEN '3' ELSE CAST(1 + idn % 2 AS VARCHAR) END AS SEX,
    CASE WHEN idn % 59 = 0 THEN '7' ELSE CAST(idn % 7 AS VARCHAR) END AS EDUCATION,
    CASE WHEN idn % 61 = 0 THEN '4' ELSE CAST(idn % 4 AS VARCHAR) END AS MARRIAGE,
    CASE WHEN idn % 43 = 0 THEN NULL WHEN idn % 67 = 0 THEN '17' WHEN idn % 71 = 0 THEN '121'
      ELSE CAST(18 + idn % 103 AS VARCHAR) END AS AGE,
    CASE WHEN idn % 79 = 0 THEN '10' ELSE s_1 END AS PAY_0,
    s_2 AS PAY_2, s_3 AS PAY_3, s_4 AS PAY_4, s_5 AS PAY_5, s_6 AS PAY_6,
    bill_1 AS BILL_AMT1, bill_2 AS BILL_AMT2, bill_3 AS BILL_AMT3, bill_4 AS BILL_AMT4, bill_5 AS BILL_AMT5,
    CASE WHEN idn % 101 = 0 THEN '1.5' ELSE bill_6 END AS BILL_AMT6,
    pay_1 AS PAY_AMT1, pay_2 AS PAY_AMT2, CASE WHEN idn % 83 = 0 THEN '-5' ELSE pay_3 END AS PAY_AMT3,
    pay_4 AS PAY_AMT4, pay_5 AS PAY_AMT5, pay_6 AS PAY_AMT6,
    CASE WHEN idn % 73 = 0 THEN '2' ELSE CAST(idn % 2 AS VARCHAR) END AS default_next_month
  FROM base),
card_raw AS (
  SELECT * EXCLUDE (idn) FROM card_base
  UNION ALL SELECT * EXCLUDE (idn) FROM card_base WHERE idn % 50 = 0
  UNION ALL SELECT * EXCLUDE (idn) REPLACE (LIMIT_BAL || '1' AS LIMIT_BAL) FROM card_base WHERE idn % 97 = 0
  UNION ALL SELECT * EXCLUDE (idn) REPLACE ('0' || ID AS ID) FROM card_base WHERE idn % 89 = 0
  UNION ALL SELECT * EXCLUDE (idn) REPLACE ('0' AS ID) FROM card_base WHERE idn % 103 = 0),
{_pipeline("card", _CARD_COLUMNS, _CARD_COLUMNS, "ID", [
    ("missing_or_noninteger", " OR ".join(f"t_{c} IS NULL" for c in _CARD_COLUMNS)),
    ("invalid_account_id", "t_ID <= 0"),
    ("nonpositive_credit_limit", "t_LIMIT_BAL <= 0"),
    ("age_out_of_range", "t_AGE < 18 OR t_AGE > 120"),
    ("invalid_sex_code", "t_SEX <> 1 AND t_SEX <> 2"),
    ("education_code_out_of_range", "t_EDUCATION < 0 OR t_EDUCATION > 6"),
    ("marriage_code_out_of_range", "t_MARRIAGE < 0 OR t_MARRIAGE > 3"),
    ("invalid_outcome", "t_default_next_month <> 0 AND t_default_next_month <> 1"),
    ("conflicting_account_id", "k IS NOT NULL"),
    *[(f"invalid_{c}", f"t_{c} < -2 OR t_{c} > 9") for c in _CARD_STATUS],
    *[(f"negative_{c}", f"t_{c} < 0") for c in _CARD_PAYMENTS],
])},
card_ok AS (SELECT * FROM card_checked WHERE rejection_reason = ''),
card_dim AS (
  SELECT t_ID AS account_id, t_LIMIT_BAL AS credit_limit_ntd,
    CASE WHEN t_LIMIT_BAL < 100000 THEN 'below_100k' WHEN t_LIMIT_BAL < 300000 THEN '100k_to_299k'
      ELSE '300k_plus' END AS limit_band
  FROM card_ok),
card_fact AS ({" UNION ALL ".join(
    f"SELECT t_ID AS account_id, DATE '2005-{10 - n:02d}-01' AS month, t_{s} AS repayment_status, "
    f"t_BILL_AMT{n} AS bill_ntd, t_PAY_AMT{n} AS payment_ntd, greatest(t_BILL_AMT{n}, 0) AS positive_bill_ntd, "
    f"t_{s} >= 2 AS delayed_2plus, t_{s} IN (-2, 0) AS status_not_documented FROM card_ok"
    for n, s in enumerate(_CARD_STATUS, start=1))}),
monthly AS ({_monthly("card_fact", "ntd")}),
segments AS ({_segments("card_fact", "card_dim", "ntd")}),
alerts AS ({_alerts("monthly")})"""

_JSON = " || ',' || ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in _ACCT_COLUMNS)
_ACCT_LIST = ", ".join(_ACCT_COLUMNS)
_MONTHLY_COLUMNS = (
    "month, accounts, delayed_accounts, delayed_account_rate, positive_bill_cents, "
    "delayed_bill_cents, delayed_bill_share, payments_cents, undocumented_status_accounts"
)
_TREND_COLUMNS = _MONTHLY_COLUMNS.replace("payments_cents, ", "")

# Every integer row of the source, whatever the other rules say about it.
_UNGATED = f"""{_ACCT_GOLD},
ungated AS ({" UNION ALL ".join(
    f"SELECT DATE '{2001 - n}-01-01' AS month, t_pay_{n} AS payment_cents, "
    f"greatest(t_bill_{n}, 0) AS positive_bill_cents, t_status_{n} >= 2 AS delayed_2plus, "
    f"t_status_{n} IN (-2, 0) AS status_not_documented FROM acct_typed "
    f"WHERE {' AND '.join(f't_{c} IS NOT NULL' for c in _ACCT_INTEGERS)}" for n in _SLOTS)}),
drift AS ({_monthly("ungated", "cents")})"""



def _digest(hashes: str, copies: str, rest: str) -> str:
    """The order-free digest of SHA-256 hashes, each counted so many times."""
    words = ", ".join(
        f"CAST(coalesce(sum(coalesce(CAST('0x' || substr({hashes}, {8 * n + 1}, 8) AS BIGINT), 0) * CAST({copies} AS HUGEINT)), 0) AS VARCHAR)"
        for n in range(8)
    )
    return f"sha256(concat_ws('|', CAST(sum({copies}) AS VARCHAR), {words})) AS digest {rest}"


def _json(columns: list[str]) -> str:
    """The row as JSON without its NULL fields."""
    fields = ", ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in columns)
    return f"'{{' || concat_ws(',', {fields}) || '}}'"


# Rows of the derived accounts as CSV with the columns turned round: some long, some short.
_DAMAGED = f"""{_ACCT},
lined AS (SELECT *, TRY_CAST(id AS BIGINT) % 11 = 0 AS is_long,
    TRY_CAST(id AS BIGINT) % 11 <> 0 AND TRY_CAST(id AS BIGINT) % 13 = 0 AS is_short FROM acct_raw),
broken_raw AS (
  SELECT is_long, {', '.join(
    c if c in list(reversed(_ACCT_COLUMNS))[:3] else f"CASE WHEN NOT is_short THEN {c} END AS {c}" for c in _ACCT_COLUMNS)}
  FROM lined),
broken_unique AS (SELECT *, count(*) AS copies FROM broken_raw GROUP BY ALL),
broken_typed AS (SELECT *, {_typing(_ACCT_COLUMNS, _ACCT_INTEGERS)} FROM broken_unique),
broken_conflicts AS (SELECT t_id AS k FROM broken_typed WHERE t_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
broken_checked AS (
  SELECT *, concat_ws('|', {', '.join(f"CASE WHEN {t} THEN '{c}' END" for c, t in [
    ("missing_or_noninteger", " OR ".join(f"t_{c} IS NULL" for c in _ACCT_INTEGERS)),
    ("malformed_row", "is_long AND " + " AND ".join(f"t_{c} IS NOT NULL" for c in _ACCT_INTEGERS)),
    ("invalid_account_id", "t_id <= 0"),
    ("nonpositive_limit", "t_limit_bal <= 0"),
    ("conflicting_account_id", "k IS NOT NULL"),
    *[(f"invalid_status_{n}", f"t_status_{n} < -2 OR t_status_{n} > 9") for n in _SLOTS],
    *[(f"negative_pay_{n}", f"t_pay_{n} < 0") for n in _SLOTS],
  ])}) AS rejection_reason
  FROM broken_typed LEFT JOIN broken_conflicts ON k = t_id)"""

# Lines of the accounts as files: a file for each segment and last digit of the id.
_LINES = f"""{_ACCT},
lines AS (SELECT segment, right(id, 1) AS digit, concat_ws(',', {', '.join(f"coalesce({c}, '')" for c in _ACCT_COLUMNS)}) AS line FROM acct_raw)"""

# Facts of the published accounts, and of every integer row of the source.
_FACT_COLUMNS = (
    "account_id, month, repayment_status, bill_cents, payment_cents, positive_bill_cents, delayed_2plus, status_not_documented"
)
_FACT_SIDES = f"""{_ACCT},
source_fact AS ({" UNION ALL ".join(
    f"SELECT t_id AS account_id, DATE '{2001 - n}-01-01' AS month, t_status_{n} AS repayment_status, "
    f"t_bill_{n} AS bill_cents, t_pay_{n} AS payment_cents, greatest(t_bill_{n}, 0) AS positive_bill_cents, "
    f"t_status_{n} >= 2 AS delayed_2plus, t_status_{n} IN (-2, 0) AS status_not_documented FROM acct_typed "
    f"WHERE {' AND '.join(f't_{c} IS NOT NULL' for c in _ACCT_INTEGERS)}" for n in _SLOTS)})"""

_LINE_KEYS = """
WITH keys AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "slot_coverage": f"""WITH {_BASE}
        SELECT slot, count(*) AS orders_in_table, count(c_custkey) AS orders_read
        FROM slotted LEFT JOIN customer ON c_custkey = o_custkey GROUP BY slot""",
    "acct_raw_rows": f"{_ACCT} SELECT {_ACCT_LIST} FROM acct_raw",
    "bronze_hash": f"{_ACCT} SELECT id, sha256('{{' || {_JSON} || '}}') AS record_hash FROM acct_unique",
    "exact_dedup": f"{_ACCT} SELECT {_ACCT_LIST}, copies FROM acct_unique",
    "conflict_keys": f"{_LINE_KEYS} SELECT l_orderkey, l_linenumber, n FROM keys WHERE n > 1",
    "conflict_flag": f"""{_LINE_KEYS}
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, coalesce(n > 1, false) AS in_conflict
        FROM lineitem l LEFT JOIN keys USING (l_orderkey, l_linenumber)""",
    "reject_missing": f"""{_ACCT} SELECT segment, count(*) AS rejected_rows FROM acct_checked
        WHERE rejection_reason LIKE 'missing_or_noninteger%' GROUP BY segment""",
    "rule_domains": """
        SELECT concat_ws('|',
            CASE WHEN c_nationkey < 0 OR c_nationkey > 22 THEN 'nation_out_of_range' END,
            CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
              THEN 'unknown_segment' END,
            CASE WHEN c_acctbal <= 0 THEN 'nonpositive_balance' END) AS rejection_reason,
          count(*) AS customers
        FROM customer GROUP BY 1""",
    "rejection_reasons": f"""{_ACCT} SELECT rejection_reason, count(*) AS rows_found
        FROM acct_checked GROUP BY 1""",
    "quarantine_rows": f"""{_ACCT} SELECT {_ACCT_LIST}, rejection_reason FROM acct_checked
        WHERE rejection_reason <> ''""",
    "accepted_typed": f"""{_ACCT} SELECT {', '.join(f't_{c} AS {c}' for c in _ACCT_COLUMNS)}
        FROM acct_ok""",
    "run_counts": f"{_ACCT}, {_COUNTS} SELECT * FROM counts",
    "gate_decision": f"""{_ACCT}, {_COUNTS},
        limits AS (SELECT unnest([CAST(0.0 AS DOUBLE), 0.01, 0.25, 1.0]) AS max_reject_rate)
        SELECT max_reject_rate, raw_rows, unique_rows, rejected_rows, accepted_accounts,
          CASE WHEN raw_rows = 0 OR accepted_accounts = 0 THEN 'No usable input rows; publication blocked'
            WHEN accepted_accounts + rejected_rows <> unique_rows THEN 'Input reconciliation failed'
            WHEN CAST(rejected_rows AS DOUBLE) / unique_rows > max_reject_rate
              THEN 'Quarantine rate exceeds threshold; publication blocked' ELSE 'PASS' END AS outcome
        FROM counts, limits""",
    "silver_accounts": f"{_ACCT} SELECT *, 'run-1' AS run_id FROM acct_dim",
    "limit_bands": f"{_ACCT} SELECT limit_band, count(*) AS accounts FROM acct_dim GROUP BY 1",
    "silver_repayments": f"{_ACCT} SELECT *, 'run-1' AS run_id FROM acct_fact",
    "gold_monthly": f"{_ACCT_GOLD} SELECT * FROM monthly",
    "gold_segments": f"{_ACCT_GOLD} SELECT * FROM segments",
    "gold_segments_joined": f"{_ACCT_GOLD} SELECT * FROM segments",
    "gold_alerts": f"{_ACCT_GOLD} SELECT * FROM alerts",
    "segment_alerts": f"""
        WITH rates AS (
          SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS month, o_orderpriority,
            CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS delayed_account_rate
          FROM orders GROUP BY ALL)
        {_alerts("rates", "o_orderpriority", 0.5)}""",
    "monthly_ship_trend": """
        WITH months AS (
          SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS line_items,
            CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents
          FROM lineitem GROUP BY 1)
        SELECT *, lag(price_cents) OVER (ORDER BY month) AS previous_cents,
          price_cents - lag(price_cents) OVER (ORDER BY month) AS change_cents FROM months""",
    "user_event_gaps": """
        WITH days AS (SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS events FROM events GROUP BY ALL)
        SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous_day,
          lag(events) OVER (PARTITION BY user_id ORDER BY day) AS previous_events FROM days""",
    "run_record": f"""{_ACCT}, {_COUNTS}
        SELECT CAST(unnest([1, 2]) AS INTEGER) AS run, CAST(1 AS BIGINT) AS audit_rows, 'SUCCESS' AS status, raw_rows, exact_duplicates,
          rejected_rows, accepted_accounts, monthly_rows FROM counts""",
    "publish_resumed": f"""{_ACCT}, {_COUNTS}
        SELECT 'lost:unique' AS lost_runs, CAST(0 AS INTEGER) AS left_over, 'SUCCESS' AS status, raw_rows, exact_duplicates, rejected_rows,
          accepted_accounts, monthly_rows FROM counts""",
    "refused_headers": f"""{_ACCT}
        SELECT tried, outcome, CASE WHEN outcome = 'accepted' THEN (SELECT count(*) FROM acct_raw) ELSE 0 END AS rows_read
        FROM (VALUES ('same', 'accepted'), ('other_order', 'accepted'), ('column_missing', 'refused'), ('column_more', 'refused'),
          ('other_case', 'refused'), ('other_name', 'refused')) t(tried, outcome)""",
    "guard_outcomes": """
        WITH plans AS (
          SELECT c_custkey, lower(c_mktsegment) AS name, sha256(c_name) AS hash,
            CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN name || '.' || name
              WHEN c_custkey % 35 = 2 THEN CAST(c_custkey AS VARCHAR) || name ELSE name END AS namespace,
            CASE WHEN c_custkey % 3 = 0 THEN hash WHEN c_custkey % 21 = 1 THEN upper(hash) WHEN c_custkey % 33 = 2 THEN left(hash, 63) END AS source,
            CAST(c_acctbal AS DOUBLE) / 100 AS threshold, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS DOUBLE) / 5000 ELSE 0.01 END AS rate
          FROM customer)
        SELECT c_custkey, CASE
            WHEN NOT regexp_full_match(namespace, '[A-Za-z_][A-Za-z0-9_]*([.][A-Za-z_][A-Za-z0-9_]*)?')
              THEN 'The namespace must be a simple schema or catalog.schema name'
            WHEN source IS NOT NULL AND NOT regexp_full_match(source, '[0-9a-f]{64}') THEN 'The source identity must be 64 lower-case hex digits'
            WHEN threshold < 0 THEN 'The alert threshold must be finite and nonnegative'
            WHEN rate < 0 OR rate > 1 THEN 'max_reject_rate must lie between 0 and 1' ELSE 'PASS' END AS outcome
        FROM plans""",
    "rejected_sample": f"""{_ACCT}, hashed AS (
          SELECT id, rejection_reason, sha256('{{' || {_JSON} || '}}') AS record_hash FROM acct_checked WHERE rejection_reason <> ''),
        ranked AS (SELECT rejection_reason, CAST(row_number() OVER (PARTITION BY rejection_reason ORDER BY record_hash) AS INTEGER) AS rank, id, record_hash FROM hashed)
        SELECT * FROM ranked WHERE rank <= 3""",
    "published_segments_joined": f"{_ACCT_GOLD} SELECT * FROM segments",
    "ratio_null_guard": """
        SELECT o_orderstatus,
          CAST(sum(owed) AS BIGINT) AS owed_cents, CAST(sum(urgent) AS BIGINT) AS urgent_cents,
          CASE WHEN sum(owed) > 0 THEN CAST(CAST(sum(urgent) AS BIGINT) AS DOUBLE)
            / CAST(CAST(sum(owed) AS BIGINT) AS DOUBLE) END AS urgent_share
        FROM (SELECT o_orderstatus, owed, CASE WHEN o_orderpriority = '1-URGENT' THEN owed ELSE 0 END AS urgent
          FROM (SELECT o_orderstatus, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 0
            ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS owed FROM orders))
        GROUP BY 1""",
    "bronze_replay": f"""{_ACCT} SELECT replays, (SELECT count(*) FROM acct_unique) AS bronze_rows
        FROM (SELECT unnest([1, 2]) AS replays)""",
    "latest_success": """
        SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id,
          CAST(o_orderdate AS DATE) AS completed_on
        FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, run_id DESC LIMIT 1""",
    "recent_runs": """
        SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id,
          CAST(o_orderdate AS DATE) AS completed_on,
          CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM orders ORDER BY o_orderdate DESC, run_id DESC LIMIT 20""",
    "publish_replay": f"""{_ACCT}, {_COUNTS}
        SELECT unique_rows AS bronze_rows, accepted_accounts AS current_accounts,
          monthly_rows AS current_facts, 2 * accepted_accounts AS stored_accounts,
          2 * rejected_rows AS quarantined, CAST(2 AS BIGINT) AS success_runs FROM counts""",
    "publish_failure": f"""{_ACCT}, {_COUNTS}, {_SPOILED}
        SELECT c.unique_rows + f.unique_rows AS bronze_rows, accepted_accounts AS current_accounts,
          monthly_rows AS current_facts, c.rejected_rows + f.unique_rows AS quarantined,
          CAST(1 AS BIGINT) AS success_runs, CAST(1 AS BIGINT) AS failed_runs
        FROM counts c, failed f""",
    "run_audit_counts": f"""{_ACCT}, {_COUNTS}, {_SPOILED}
        SELECT 'SUCCESS' AS status, raw_rows, exact_duplicates, rejected_rows, accepted_accounts,
          monthly_rows, 'Full snapshot published' AS message FROM counts
        UNION ALL SELECT 'FAILED', raw_rows, raw_rows - unique_rows, unique_rows, 0, 0,
          'No usable input rows; publication blocked' FROM failed""",
    "segments_latest_month": f"""{_ACCT_GOLD}
        SELECT limit_band, accounts, delayed_accounts, delayed_account_rate, positive_bill_cents
        FROM segments WHERE month = (SELECT max(month) FROM monthly)""",
    "report_monthly": f"{_ACCT_GOLD} SELECT {_TREND_COLUMNS} FROM monthly ORDER BY month",
    "review_alerts": f"{_ACCT_GOLD} SELECT * FROM alerts WHERE alert_status = 'REVIEW'",
    "rejection_triage": f"""{_ACCT} SELECT rejection_reason, count(*) AS rejected_rows
        FROM acct_checked WHERE rejection_reason <> '' GROUP BY 1""",
    "published_bronze": f"""{_ACCT} SELECT {_ACCT_LIST}, copies,
        sha256('{{' || {_JSON} || '}}') AS record_hash FROM acct_unique""",
    "published_accounts": f"{_ACCT} SELECT * FROM acct_dim",
    "published_repayments": f"{_ACCT} SELECT * FROM acct_fact",
    "published_segments": f"{_ACCT_GOLD} SELECT * FROM segments",
    "published_alerts": f"{_ACCT_GOLD} SELECT * FROM alerts",
    "grain_violations": f"""{_ACCT} SELECT account_id, month, count(*) AS copies
        FROM acct_fact GROUP BY ALL HAVING count(*) > 1""",
    "grain_violations_events": """
        SELECT user_id, event_type, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS copies
        FROM events GROUP BY ALL HAVING count(*) > 1""",
    "ri_orphans": """
        SELECT doc_id, source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "ri_orphan_count": """
        SELECT count(*) AS orphans FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "monthly_from_wide": f"{_ACCT_GOLD} SELECT * FROM monthly",
    "reconcile_monthly": f"""{_ACCT_GOLD} SELECT {_MONTHLY_COLUMNS}, 'published' AS only_in
        FROM monthly WHERE false""",
    "reconcile_drift": f"""{_UNGATED}
        SELECT {_MONTHLY_COLUMNS}, 'published' AS only_in
        FROM (SELECT {_MONTHLY_COLUMNS} FROM monthly EXCEPT SELECT {_MONTHLY_COLUMNS} FROM drift)
        UNION ALL SELECT {_MONTHLY_COLUMNS}, 'recomputed'
        FROM (SELECT {_MONTHLY_COLUMNS} FROM drift EXCEPT SELECT {_MONTHLY_COLUMNS} FROM monthly)""",
    "integrity_report": f"""{_ACCT}, {_COUNTS}
        SELECT check_name, observed, observed AS expected, true AS passed FROM (
          SELECT 'current_accounts' AS check_name, accepted_accounts AS observed FROM counts
          UNION ALL SELECT 'current_account_months', monthly_rows FROM counts
          UNION ALL SELECT 'bronze_rows_of_source', unique_rows FROM counts
          UNION ALL SELECT 'rejected_rows_of_run', rejected_rows FROM counts
          UNION ALL SELECT 'repeated_account_months', 0
          UNION ALL SELECT 'facts_without_account', 0)""",
    "integrity_damaged": f"""{_ACCT}, {_COUNTS}
        SELECT check_name, observed, expected, observed = expected AS passed FROM (
          SELECT 'current_accounts' AS check_name, accepted_accounts AS observed, accepted_accounts AS expected FROM counts
          UNION ALL SELECT 'current_account_months', monthly_rows + 7, monthly_rows FROM counts
          UNION ALL SELECT 'bronze_rows_of_source', unique_rows, unique_rows FROM counts
          UNION ALL SELECT 'rejected_rows_of_run', rejected_rows, rejected_rows FROM counts
          UNION ALL SELECT 'repeated_account_months', 6, 0
          UNION ALL SELECT 'facts_without_account', 1, 0)""",
    "run_status": f"""{_ACCT}, {_COUNTS}, {_SPOILED}
        SELECT true AS is_dated, CAST(32 AS INTEGER) AS id_length, 'SUCCESS' AS status, raw_rows, exact_duplicates,
          rejected_rows, accepted_accounts, monthly_rows, 'Full snapshot published' AS message FROM counts
        UNION ALL SELECT true, 32, 'FAILED', raw_rows, raw_rows - unique_rows, unique_rows, 0, 0,
          'No usable input rows; publication blocked' FROM failed""",
    "snapshot_csv": f"{_ACCT} SELECT {_ACCT_LIST} FROM acct_raw",
    "malformed_rows": f"""{_DAMAGED} SELECT rejection_reason, count(*) AS rows_found FROM broken_checked GROUP BY 1""",
    "export_round_trip": f"""{_ACCT_GOLD} SELECT *, unnest(['csv', 'json']) AS kind FROM monthly""",
    "snapshot_digests": f"""{_ACCT}, card_rows AS (
          {_CARD.lstrip()} SELECT {', '.join(_CARD_COLUMNS)} FROM card_raw)
        SELECT 'account' AS snapshot, {_digest("h", "1", f"FROM (SELECT sha256({_json(_ACCT_COLUMNS)}) AS h FROM acct_raw)")}
        UNION ALL
        SELECT 'card', {_digest("h", "1", f"FROM (SELECT sha256({_json(_CARD_COLUMNS)}) AS h FROM card_rows)")}""",
    "text_digests": f"""SELECT lang, {_digest("sha256(text)", "1", "FROM documents GROUP BY lang")}""",
    "pinned_snapshot": """
        SELECT * FROM (VALUES ('same', 'accepted'), ('other_order', 'accepted'), ('one_repeated', 'refused')) t(tried, outcome)""",
    "file_hashes": f"""{_LINES}
        SELECT segment, digit, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS length,
          sha256(string_agg(line, chr(10) ORDER BY line) || chr(10)) AS sha256 FROM lines GROUP BY ALL""",
    "pinned_bytes": f"""{_LINES}, least AS (SELECT segment, digit, line FROM lines ORDER BY ALL LIMIT 1),
        cut AS (SELECT * FROM lines WHERE (segment, digit, line) NOT IN (SELECT (segment, digit, line) FROM least))
        SELECT 'same' AS tried, 'accepted' AS outcome, (SELECT count(*) FROM (SELECT DISTINCT segment, digit FROM lines)) AS files,
          CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS bytes FROM lines
        UNION ALL SELECT 'line_missing', 'refused', (SELECT count(*) FROM (SELECT DISTINCT segment, digit FROM cut)),
          CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) FROM cut""",
    "reconcile_accounts": f"""{_FACT_SIDES}
        SELECT {_FACT_COLUMNS}, only_in, count(*) AS copies FROM (
          SELECT *, 'published' AS only_in FROM (SELECT {_FACT_COLUMNS} FROM acct_fact EXCEPT ALL SELECT {_FACT_COLUMNS} FROM source_fact)
          UNION ALL SELECT *, 'recomputed' FROM (SELECT {_FACT_COLUMNS} FROM source_fact EXCEPT ALL SELECT {_FACT_COLUMNS} FROM acct_fact))
        GROUP BY ALL""",
    "reconcile_accounts_clean": f"""{_FACT_SIDES}
        SELECT {_FACT_COLUMNS}, 'published' AS only_in, CAST(1 AS BIGINT) AS copies FROM acct_fact WHERE false""",
    "card_rejection_reasons": f"""{_CARD} SELECT rejection_reason, count(*) AS rows_found
        FROM card_checked GROUP BY 1""",
    "card_quarantine_rows": f"""{_CARD} SELECT {', '.join(_CARD_COLUMNS)}, rejection_reason
        FROM card_checked WHERE rejection_reason <> ''""",
    "card_accounts": f"{_CARD} SELECT *, 'run-1' AS run_id FROM card_dim",
    "card_repayments": f"{_CARD} SELECT *, 'run-1' AS run_id FROM card_fact",
    "card_monthly": f"{_CARD} SELECT * FROM monthly",
    "card_segments": f"{_CARD} SELECT * FROM segments",
    "card_segments_joined": f"{_CARD} SELECT * FROM segments",
    "card_alerts": f"{_CARD} SELECT * FROM alerts",
    "card_published_trend": f"{_CARD} SELECT {_TREND_COLUMNS.replace('cents', 'ntd')} FROM monthly",
}
