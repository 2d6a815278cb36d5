"""Independent SQL (DuckDB dialect) for the queries in ``catalog.py``.

Written from the rule semantics, not from the Spark plans: uniqueness uses a
``row_number()`` window, the advisor mart joins first and aggregates the
fan-out, picks recompute the md5 prefix.  Column names equal the Spark ones.
"""

from __future__ import annotations

from ..functions.picks import rate_hex
from . import catalog as C


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(kind: str, key: str, rate: float) -> str:
    return f"(substr(md5('{kind}:' || CAST({key} AS VARCHAR)), 1, 4) < '{rate_hex(rate)}')"


def choice(kind: str, key: str, n: int) -> str:
    return f"CAST((('0x' || substr(md5('{kind}:' || CAST({key} AS VARCHAR)), 5, 8))::BIGINT) % {n} AS INTEGER)"


def choose(kind: str, key: str, values: list) -> str:
    items = ", ".join(q(v) if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[{choice(kind, key, len(values))} + 1]"


def lst(values) -> str:
    return ", ".join(q(v) if isinstance(v, str) else str(v) for v in values)


# --- orders feed and the standard rule set --------------------------------

ORDERS_FEED = f"""
SELECT o_orderkey,
       CASE WHEN {pick('null', 'o_orderkey', 0.03)} THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus, o_totalprice,
       CASE WHEN {pick('null_date', 'o_orderkey', 0.02)} THEN NULL ELSE o_orderdate END AS o_orderdate,
       o_orderpriority
FROM orders"""

ORDER_FLAGS = [
    "o_custkey IS NULL",
    "coalesce(o_orderstatus NOT IN ('F', 'O'), false)",
    "coalesce(o_totalprice < 1000 OR o_totalprice > 400000, false)",
    "coalesce(NOT regexp_matches(o_orderpriority, '^[1-5]-(URGENT|HIGH|MEDIUM|LOW)$'), false)",
    f"coalesce(CAST(o_orderdate AS DATE) > DATE '{C.AS_OF}', false)",
    "coalesce(o_custkey IS NOT NULL AND row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1, false)",
]

ORDERS_WITH = f"""
WITH feed AS ({ORDERS_FEED}),
flags AS (SELECT *, {", ".join(f"{e} AS f{i}" for i, e in enumerate(ORDER_FLAGS))} FROM feed)"""

ANY_FLAG = " OR ".join(f"f{i}" for i in range(len(ORDER_FLAGS)))


def metrics_union(rules, src: str = "flags") -> str:
    parts = []
    for i, r in enumerate(rules):
        parts.append(
            f"""SELECT {q(r.rule_name)} AS rule_name, {q(r.column)} AS rule_column, {q(r.rule_type)} AS rule_type,
       {q(r.severity)} AS severity, count(*) AS total_count, count(*) - count_if(f{i}) AS pass_count,
       count_if(f{i}) AS fail_count,
       CASE WHEN count(*) > 0 THEN round(count_if(f{i}) / count(*) * 100, 2) ELSE 0.0 END AS fail_pct
FROM {src}"""
        )
    return "\nUNION ALL\n".join(parts)


def samples_union(rules, src: str = "flags") -> str:
    parts = []
    for i, r in enumerate(rules):
        parts.append(
            f"""SELECT {q(r.rule_name)} AS rule_name,
       coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM
                 (SELECT DISTINCT coalesce(CAST({r.column} AS VARCHAR), 'None') AS v FROM {src} WHERE f{i} ORDER BY v LIMIT 5)), '') AS samples"""
        )
    return "\nUNION ALL\n".join(parts)


def failed_list(names_flags) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {f} THEN {q(n)} END" for n, f in names_flags) + ")"


CUSTOMER_LINE = (
    "printf('%012d', c_custkey) || rpad(coalesce(c_name, ''), 30, ' ') || printf('%04d', c_nationkey) || "
    "printf('%012d', CAST(round(c_acctbal * 100) AS BIGINT)) || rpad(coalesce(c_mktsegment, ''), 18, ' ') || 'CUST'"
)
TRUNCATED = f"CASE WHEN {pick('format_error', 'c_custkey', 0.02)} THEN left(line, 30 + {choice('format_error:len', 'c_custkey', 41)}) ELSE line END"
CUSTOMER_LINES = f"SELECT c_custkey, {CUSTOMER_LINE} AS line FROM customer"

DATE_STRINGS = f"""SELECT o_orderkey,
       CASE WHEN {pick('format_error', 'o_orderkey', 0.02)} THEN {choose('format_error:value', 'o_orderkey', C.BAD_DATES)}
            ELSE strftime(o_orderdate, '%Y%m%d') END AS raw_date
FROM orders"""

EVENTS_FEED = f"""SELECT event_id, ts, CASE WHEN {pick('null', 'event_id', 0.01)} THEN NULL ELSE user_id END AS user_id,
       event_type, value, props FROM events"""

EVENT_FLAGS = [
    "user_id IS NULL",
    "coalesce(event_type NOT IN ('click', 'view', 'purchase', 'signup'), false)",
    """coalesce(NOT regexp_matches(props, '^\\{"k": \\d+\\}$'), false)""",
    "coalesce(value < 0 OR value > 50, false)",
    "coalesce(event_id IS NOT NULL AND row_number() OVER (PARTITION BY event_id ORDER BY ts) > 1, false)",
]


def donors(src: str, col: str, n: int) -> str:
    return f"""SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS m
FROM (SELECT DISTINCT {col} AS v FROM {src} WHERE {col} IS NOT NULL ORDER BY v LIMIT {n})"""


def spread_donors(src: str, col: str, n: int) -> str:
    return f"""SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS m
FROM (SELECT DISTINCT {col} AS v, md5('pool:' || {col}) AS h FROM {src} WHERE {col} IS NOT NULL ORDER BY h, v LIMIT {n})"""


DETECT_AS_OF = C.DETECT_AS_OF
INJECTED_ORDERS = f"""
SELECT o_orderkey,
       CASE WHEN {pick('null', 'o_orderkey', 0.03)} THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN {pick('invalid_enum', 'o_orderkey', 0.04)} THEN {choose('invalid_enum:value', 'o_orderkey', C.BAD_STATUS)} ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN {pick('out_of_range', 'o_orderkey', 0.03)} THEN -1.0 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN {pick('future_date', 'o_orderkey', 0.02)} THEN DATE '{DETECT_AS_OF}' + CAST({choice('future_date:days', 'o_orderkey', 365)} + 1 AS INTEGER)
            ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
       o_orderpriority,
       {pick('null', 'o_orderkey', 0.03)} AS m_cust,
       {pick('invalid_enum', 'o_orderkey', 0.04)} AS m_status,
       {pick('out_of_range', 'o_orderkey', 0.03)} AS m_price,
       {pick('future_date', 'o_orderkey', 0.02)} AS m_date
FROM orders"""

FW_FIELDS = """TRY_CAST(substring(l, 1, 12) AS BIGINT) AS cust_id, trim(substring(l, 13, 30)) AS cust_name,
       TRY_CAST(substring(l, 43, 4) AS INTEGER) AS nation, TRY_CAST(substring(l, 47, 12) AS BIGINT) AS balance_cents,
       trim(substring(l, 59, 18)) AS segment, substring(l, 77, 4) AS record_type, CAST(length(l) AS INTEGER) AS _line_length"""


def _contract_checks():
    """Per-rule failure counts for the shipped orders/events contracts."""
    o = [
        ("orderkey_not_null", "not_null", "CRITICAL", "o_orderkey IS NULL"),
        ("status_known", "accepted_values", "ERROR", "coalesce(o_orderstatus NOT IN ('F', 'O'), false)"),
        ("price_range", "range", "WARNING", "coalesce(o_totalprice < 1000 OR o_totalprice > 450000, false)"),
        ("priority_format", "regex", "ERROR", "coalesce(NOT regexp_matches(o_orderpriority, '^\\d-[A-Z]+$'), false)"),
        ("date_not_future", "not_future_date", "ERROR", f"coalesce(CAST(o_orderdate AS DATE) > DATE '{C.AS_OF}', false)"),
        ("cust_unique", "unique", "CRITICAL", "coalesce(o_custkey IS NOT NULL AND row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1, false)"),
    ]
    e = [
        ("event_id_unique", "unique", "CRITICAL", "coalesce(event_id IS NOT NULL AND row_number() OVER (PARTITION BY event_id ORDER BY ts) > 1, false)"),
        ("type_valid", "accepted_values", "ERROR", "coalesce(event_type NOT IN ('click', 'view', 'purchase', 'signup'), false)"),
        ("value_range", "range", "WARNING", "coalesce(value < 0 OR value > 100, false)"),
        ("props_format", "regex", "CRITICAL", """coalesce(NOT regexp_matches(props, '^\\{"k": [0-9]{1,2}\\}$'), false)"""),
        ("user_range", "range", "ERROR", "coalesce(user_id < 0 OR user_id > 99, false)"),
        ("ts_length", "exact_length", "WARNING", "coalesce(user_id != 7, false)"),
    ]
    parts = []
    for ds, rules in (("orders", o), ("events", e)):
        flags = ", ".join(f"{expr} AS f{i}" for i, (_, _, _, expr) in enumerate(rules))
        src = f"(SELECT {flags} FROM {ds})"
        for i, (name, typ, sev, _) in enumerate(rules):
            parts.append(f"SELECT '{ds}' AS dataset_name, {q(name)} AS rule_name, {q(typ)} AS rule_type, {q(sev)} AS severity, count_if(f{i}) AS fail_count FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _report_sql() -> str:
    names = [r.rule_name for r in C.EVENT_RULES]
    sev = [r.severity for r in C.EVENT_RULES]
    flags = ", ".join(f"{e} AS f{i}" for i, e in enumerate(EVENT_FLAGS))
    per_rule = "\nUNION ALL\n".join(
        f"""SELECT day AS run_id, CAST(day AS TIMESTAMP) AS run_timestamp, {q(n)} AS rule_name, {q(s)} AS severity,
       count_if(f{i}) AS fail_count, round(count_if(f{i}) / count(*) * 100, 2) AS fail_pct FROM fl GROUP BY day"""
        for i, (n, s) in enumerate(zip(names, sev))
    )
    return f"""
WITH feed AS ({EVENTS_FEED}),
fl AS (SELECT strftime(ts, '%Y-%m-%d') AS day, {flags} FROM feed),
res AS ({per_rule})
SELECT 'events' AS dataset_name, rule_name, severity,
       arg_max(fail_pct, run_timestamp) AS latest_run_fail_pct,
       count(*) AS total_runs_checked,
       count_if(fail_count > 0) AS runs_with_failures,
       max(fail_pct) AS max_fail_pct_ever,
       CASE WHEN severity = 'CRITICAL' AND count_if(fail_count > 0) > 0 THEN 'ACTION_REQUIRED'
            WHEN severity = 'ERROR' AND arg_max(fail_pct, run_timestamp) > 5.0 THEN 'INVESTIGATE'
            WHEN severity = 'WARNING' THEN 'MONITOR' ELSE 'HEALTHY' END AS status_flag,
       CASE WHEN severity = 'CRITICAL' THEN 1 WHEN severity = 'ERROR' THEN 2 WHEN severity = 'WARNING' THEN 3 ELSE 4 END AS severity_rank
FROM res GROUP BY rule_name, severity"""


LINEITEM_FLAGS = [
    "l_orderkey IS NULL",
    "coalesce(l_returnflag NOT IN ('A', 'N', 'R'), false)",
    "coalesce(l_linestatus NOT IN ('O', 'F'), false)",
    "coalesce(l_quantity < 1 OR l_quantity > 45, false)",
    "coalesce(l_discount < 0 OR l_discount > 0.08, false)",
    "coalesce(l_tax > 0.06, false)",
    f"coalesce(CAST(l_shipdate AS DATE) > DATE '{C.AS_OF}', false)",
    "coalesce(l_linenumber < 1 OR l_linenumber > 6, false)",
]

ORACLE: dict[str, str] = {
    "dq_lineitem_rules": f"""WITH flags AS (SELECT {", ".join(f"{e} AS f{i}" for i, e in enumerate(LINEITEM_FLAGS))} FROM lineitem)
{metrics_union(C.LINEITEM_RULES)}""",
    "dq_not_null": f"SELECT o_orderkey FROM ({ORDERS_FEED}) WHERE o_custkey IS NULL",
    "dq_accepted_values": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    "dq_range": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000",
    "dq_range_open": f"""SELECT l_orderkey, l_linenumber,
       {failed_list([('qty_min', 'coalesce(l_quantity < 5, false)'), ('disc_max', 'coalesce(l_discount > 0.08, false)')])} AS failed_rules
FROM lineitem WHERE l_quantity < 5 OR l_discount > 0.08""",
    "dq_regex": "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#\\d$')",
    "dq_not_future_date": f"SELECT o_orderkey, NOT coalesce(CAST(o_orderdate AS DATE) > DATE '{C.AS_OF}', false) AS passed FROM ({ORDERS_FEED})",
    "dq_date_format": f"SELECT o_orderkey, raw_date FROM ({DATE_STRINGS}) WHERE try_strptime(raw_date, '%Y%m%d') IS NULL AND raw_date IS NOT NULL",
    "dq_exact_length": f"""SELECT c_custkey, CAST(length({TRUNCATED}) AS INTEGER) AS line_length FROM ({CUSTOMER_LINES})
WHERE length({TRUNCATED}) != 80""",
    "dq_unique": "SELECT o_orderkey FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE o_custkey IS NOT NULL AND rn > 1",
    "dq_unique_hot": """SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem)
WHERE l_returnflag IS NOT NULL AND rn > 1""",
    "dq_unique_default": """SELECT c_custkey FROM (
  SELECT c_custkey, c_mktsegment,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) AS rn
  FROM customer)
WHERE c_mktsegment IS NOT NULL AND rn > 1""",
    "dq_unique_text": "SELECT doc_id FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE text IS NOT NULL AND rn > 1",
    "sc_functions": """SELECT o_orderkey,
       concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'final' END, CASE WHEN o_totalprice > 200000 THEN 'big' END) AS tags,
       (['a', 'b', 'c'])[(o_orderkey % 3) + 1] AS pick_word,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS price_floor,
       strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS due_date,
       round(o_totalprice / 7, 2) AS price_round,
       upper(trim(lower(o_orderpriority))) AS prio_upper,
       o_orderkey % 7 AS key_mod,
       substring(lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 1, 6) AS cust_prefix,
       CAST(length(o_orderpriority) AS BIGINT) AS prio_len
FROM orders""",
    "dq_annotate": f"""{ORDERS_WITH}
SELECT o_orderkey, NOT ({ANY_FLAG}) AS passed,
       {failed_list([(r.rule_name, f"f{i}") for i, r in enumerate(C.ORDER_RULES)])} AS failed_rules
FROM flags""",
    "dq_metrics": f"{ORDERS_WITH}\n{metrics_union(C.ORDER_RULES)}",
    "dq_samples": f"{ORDERS_WITH}\n{samples_union(C.ORDER_RULES)}",
    "dq_clean": f"{ORDERS_WITH}\nSELECT o_orderkey FROM flags WHERE NOT ({ANY_FLAG})",
    "dq_quarantine": f"{ORDERS_WITH}\nSELECT o_orderkey FROM flags WHERE {ANY_FLAG}",
    "dq_severity_totals": f"""{ORDERS_WITH},
m AS ({metrics_union(C.ORDER_RULES)})
SELECT s.severity, CAST(coalesce(sum(m.fail_count) FILTER (WHERE m.fail_count > 0), 0) AS BIGINT) AS fail_total
FROM (VALUES ('CRITICAL'), ('ERROR'), ('WARNING')) s(severity) LEFT JOIN m ON m.severity = s.severity
GROUP BY s.severity""",
    "dq_summary_lines": f"""{ORDERS_WITH},
m AS ({metrics_union(C.ORDER_RULES)})
SELECT rule_name, severity, fail_count, CASE WHEN fail_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM m""",
    "dq_critical_gate": f"""{ORDERS_WITH},
m AS ({metrics_union(C.ORDER_RULES)})
SELECT rule_name, fail_count FROM m WHERE severity = 'CRITICAL' AND fail_count > 0""",
    "dq_expectations": f"""WITH feed AS ({EVENTS_FEED})
SELECT 'user_not_null' AS rule_name, count_if({EVENT_FLAGS[0]}) AS failed_records FROM feed
UNION ALL SELECT 'event_type_valid', count_if({EVENT_FLAGS[1]}) FROM feed
UNION ALL SELECT 'props_format', count_if({EVENT_FLAGS[2]}) FROM feed""",
    "dq_report": _report_sql(),
    "dq_embedding_first": "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e0 FROM embeddings WHERE CAST(embedding[1] AS DOUBLE) < -0.1 OR CAST(embedding[1] AS DOUBLE) > 0.1",
    "dq_labels": f"""SELECT doc_id, {failed_list([('quality_ok', 'coalesce(quality NOT IN (1), false)'), ('toxic_max', 'coalesce(toxic > 0, false)')])} AS failed_rules
FROM labels WHERE quality NOT IN (1) OR toxic > 0""",
    "dq_roles": "SELECT conv_id, turn, role FROM conversations WHERE role NOT IN ('user', 'assistant')",
    "dq_urls": "SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+\\.example\\.(com|org|net)/')",
    "tr_cast": f"""SELECT o_orderkey, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(cust AS INTEGER) AS cust FROM (
  SELECT o_orderkey,
         CASE WHEN {pick('format_error', 'o_orderkey', 0.05)} THEN {choose('format_error:value', 'o_orderkey', C.BAD_NUMBERS)}
              ELSE CAST(o_totalprice AS VARCHAR) END AS price,
         CAST(o_custkey AS VARCHAR) AS cust
  FROM orders)""",
    "tr_date": f"""SELECT o_orderkey, strftime(TRY_CAST(odate AS DATE), '%Y-%m-%d') AS odate FROM (
  SELECT o_orderkey,
         CASE WHEN {pick('format_error', 'o_orderkey', 0.05)} THEN {choose('format_error:value', 'o_orderkey', C.BAD_ISO_DATES)}
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS odate
  FROM orders)""",
    "tr_date_fmt": f"SELECT o_orderkey, strftime(CAST(try_strptime(raw_date, '%Y%m%d') AS DATE), '%Y-%m-%d') AS raw_date FROM ({DATE_STRINGS})",
    "tr_ts_fmt": f"""SELECT event_id, strftime(try_strptime(ts_raw, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_parsed FROM (
  SELECT event_id,
         CASE WHEN {pick('format_error', 'event_id', 0.03)} THEN {choose('format_error:value', 'event_id', ['31/02/2024 10:00:00', '2024-01-01'])}
              ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS ts_raw
  FROM events)""",
    "tr_expr": "SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS segment FROM customer",
    "tr_derived": """SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents,
       CAST(CAST(round(c_acctbal * 100) AS BIGINT) / 100.0 AS DOUBLE) AS balance_dollars FROM customer""",
    "tr_ordered": """SELECT c_custkey, TRY_CAST(substring(trim(c_name), 10, 9) AS BIGINT) AS name_key,
       CAST(length(trim(c_name)) AS BIGINT) AS name_len,
       TRY_CAST(substring(trim(c_name), 10, 9) AS BIGINT) = c_custkey AS key_matches FROM customer""",
    "tr_json_expr": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "tr_band": """SELECT o_orderkey, CASE WHEN CAST(o_orderkey % 7 AS INTEGER) IN (1, 2) THEN 'LOW'
       WHEN CAST(o_orderkey % 7 AS INTEGER) = 3 THEN 'MEDIUM' WHEN CAST(o_orderkey % 7 AS INTEGER) IN (4, 5) THEN 'HIGH'
       ELSE 'UNKNOWN' END AS risk_band FROM orders""",
    "tr_ratio": "SELECT o_orderkey, CASE WHEN CAST(o_orderkey % 5 AS DOUBLE) != 0 THEN o_totalprice / CAST(o_orderkey % 5 AS DOUBLE) END AS ratio FROM orders",
    "tr_age": f"SELECT o_orderkey, CAST(DATE '{C.MART_AS_OF}' - CAST(o_orderdate AS DATE) AS BIGINT) AS days_since_order FROM orders",
    "tr_pass_all": """SELECT n_nationkey, true AS passed_no_rules, CAST(0 AS BIGINT) AS n_failed_no_rules,
       true AS passed_unknown, CAST(0 AS BIGINT) AS n_failed_unknown FROM nation""",
    "tr_stamp": "SELECT n_nationkey, lower(n_name) AS n_name, true AS has_stamp FROM nation",
    "tr_prefix": """SELECT o_orderkey AS order_key, substring(lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 1, 6) AS cust_prefix
FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL""",
    "jn_left_fanout": """
WITH c AS (SELECT CAST(o_orderkey AS VARCHAR) AS client_id, CAST(o_custkey AS VARCHAR) AS advisor_id, o_orderstatus AS account_type,
                  o_orderpriority AS region, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS risk_rating,
                  CAST(o_totalprice AS DECIMAL(18, 2)) AS aum FROM orders),
a AS (SELECT CAST(event_id AS VARCHAR) AS app_id, CAST(user_id AS VARCHAR) AS advisor_id, upper(event_type) AS status,
             CAST(value AS DECIMAL(18, 2)) AS credit_score FROM events),
j AS (SELECT c.*, a.app_id, a.status, a.credit_score FROM c LEFT JOIN a ON c.advisor_id = a.advisor_id),
g AS (SELECT advisor_id, account_type, region, risk_rating,
             count(DISTINCT client_id) AS total_clients, count(DISTINCT app_id) AS total_applications,
             CAST(sum(aum) AS DOUBLE) AS total_aum, CAST(CAST(avg(aum) AS DECIMAL(22, 6)) AS DOUBLE) AS avg_aum,
             CASE WHEN count(app_id) > 0 THEN count_if(status = 'PURCHASE') / count(app_id) END AS approval_rate,
             CAST(CAST(avg(credit_score) AS DECIMAL(22, 6)) AS DOUBLE) AS avg_credit_score
      FROM j GROUP BY advisor_id, account_type, region, risk_rating),
b AS (SELECT *, CASE WHEN risk_rating IN (1, 2) THEN 'LOW' WHEN risk_rating = 3 THEN 'MEDIUM'
                     WHEN risk_rating IN (4, 5) THEN 'HIGH' ELSE 'UNKNOWN' END AS risk_band FROM g)
SELECT *, coalesce(total_aum > 10000000 AND risk_band = 'LOW', false) AS anomaly_flag FROM b""",
    "jn_prefix_inner": f"""
WITH c AS (SELECT c_name AS client_id, c_mktsegment AS account_type, CAST(c_nationkey AS VARCHAR) AS region,
                  (c_nationkey % 5) + 1 AS risk_rating, c_acctbal AS aum FROM customer),
a AS (SELECT o_orderkey AS account_number, o_totalprice AS balance_dollars, CAST(o_orderdate AS DATE) AS open_date,
             o_orderpriority AS state_code, o_orderstatus AS account_status, 'ORD' AS product_code,
             lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS client_id_prefix FROM orders WHERE o_orderstatus = 'F')
SELECT c.client_id, a.account_number, a.balance_dollars, c.aum,
       CAST(DATE '{C.MART_AS_OF}' - a.open_date AS BIGINT) AS days_since_open,
       CASE WHEN c.aum != 0 THEN a.balance_dollars / c.aum END AS balance_aum_ratio,
       coalesce(a.balance_dollars > c.aum * 0.5, false) AS anomaly_flag,
       a.product_code AS bank_product_code, a.state_code, a.account_status, c.account_type, c.region, c.risk_rating
FROM c JOIN a ON substring(c.client_id, 10, 9) = a.client_id_prefix""",
    "jn_prefix_heavy": """WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '000000007' ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS p
  FROM orders WHERE o_orderstatus = 'F')
SELECT c_name AS client_id, count(*) AS n_accounts, sum(o_orderkey)::BIGINT AS numbers FROM customer JOIN a ON substring(c_name, 10, 9) = p GROUP BY c_name""",
    "ag_conditional": """SELECT l_returnflag, l_linestatus, count(*) AS n, count_if(l_discount > 0.05) AS n_discounted,
       CASE WHEN count(l_tax) > 0 THEN count_if(l_tax > 0.04) / count(l_tax) END AS taxed_share,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS sum_price, max(l_quantity) AS max_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "ag_having": "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 5",
    "ag_distinct": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "an_null": f"""SELECT o_orderkey, CASE WHEN {pick('null', 'o_orderkey', 0.03)} THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN {pick('null_date', 'o_orderkey', 0.02)} THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate FROM orders""",
    "an_duplicate": f"""
WITH c AS (SELECT c_custkey, c_name AS dup_key, {pick('duplicate', 'c_custkey', 0.02)} AS p FROM customer),
d AS ({donors('(SELECT dup_key FROM c WHERE NOT p)', 'dup_key', 50)})
SELECT c_custkey,
       CASE WHEN p AND dup_key IS NOT NULL THEN (SELECT v FROM d WHERE d.i = {choice('duplicate:slot', 'c.c_custkey', 50)} % d.m)
            ELSE dup_key END AS dup_key
FROM c""",
    "an_enum": f"""SELECT o_orderkey, CASE WHEN {pick('invalid_enum', 'o_orderkey', 0.04)} THEN {choose('invalid_enum:value', 'o_orderkey', C.BAD_STATUS)}
       ELSE o_orderstatus END AS o_orderstatus FROM orders""",
    "an_constant": f"SELECT c_custkey, CASE WHEN {pick('out_of_range', 'c_custkey', 0.03)} THEN -999999.0 ELSE c_acctbal END AS c_acctbal FROM customer",
    "an_future": f"""SELECT o_orderkey, strftime(CASE WHEN {pick('future_date', 'o_orderkey', 0.02)}
       THEN DATE '{C.AS_OF}' + CAST({choice('future_date:days', 'o_orderkey', 730)} + 1 AS INTEGER)
       ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS o_orderdate FROM orders""",
    "an_choice_int": f"""SELECT p_partkey, CASE WHEN {pick('format_error', 'p_partkey', 0.02)} THEN {choose('format_error:value', 'p_partkey', C.BAD_SIZES)}
       ELSE p_size END AS p_size FROM part""",
    "an_malformed": f"""SELECT c_custkey, CASE WHEN {pick('format_error', 'c_custkey', 0.05)} THEN {choose('format_error:value', 'c_custkey', C.BAD_NAMES)}
       ELSE c_name END AS c_name FROM customer""",
    "an_two_sided": f"""SELECT p_partkey, CASE WHEN {pick('out_of_range', 'p_partkey', 0.03)}
       THEN CASE WHEN {choice('out_of_range:side', 'p_partkey', 2)} = 0 THEN 0 ELSE 999 END ELSE p_size END AS p_size FROM part""",
    "an_status": f"""SELECT o_orderkey, CASE WHEN {pick('out_of_range', 'o_orderkey', 0.03)} THEN {choose('out_of_range:value', 'o_orderkey', C.BAD_PRIORITY)}
       ELSE o_orderpriority END AS o_orderpriority FROM orders""",
    "an_truncate": f"SELECT c_custkey, {TRUNCATED} AS line FROM ({CUSTOMER_LINES})",
    "an_fixed_code": f"""SELECT c_custkey, printf('%012d', c_custkey) || rpad(coalesce(c_name, ''), 30, ' ') || printf('%04d', c_nationkey) ||
       printf('%012d', CAST(round(c_acctbal * 100) AS BIGINT)) ||
       rpad(CASE WHEN {pick('out_of_range', 'c_custkey', 0.03)} THEN {choose('out_of_range:value', 'c_custkey', C.BAD_SEGMENTS)} ELSE c_mktsegment END, 18, ' ') ||
       'CUST' AS line FROM customer""",
    "an_negative": f"""SELECT c_custkey, balance_cents, printf('%012d', balance_cents) AS cents_field FROM (
  SELECT c_custkey, CASE WHEN {pick('out_of_range', 'c_custkey', 0.03)} THEN -({choice('out_of_range:amount', 'c_custkey', 999000)} + 1000)
                         ELSE CAST(round(c_acctbal * 100) AS BIGINT) END AS balance_cents FROM customer)""",
    "an_bad_date": DATE_STRINGS,
    "an_reuse": f"""
WITH d AS ({donors('customer', 'c_custkey', 500)})
SELECT event_id, CASE WHEN {pick('reuse', 'event_id', 0.6)} THEN (SELECT v FROM d WHERE d.i = {choice('reuse:slot', 'e.event_id', 500)} % d.m)
       ELSE user_id END AS user_id
FROM events e""",
    "an_reuse_spread": f"""
WITH d AS ({spread_donors('customer', 'c_custkey', 200)}),
r AS (SELECT event_id, CASE WHEN {pick('reuse', 'event_id', 0.6)} THEN (SELECT v FROM d WHERE d.i = {choice('reuse:slot', 'e.event_id', 200)} % d.m) ELSE user_id END AS user_id FROM events e),
c AS (SELECT c_custkey, c_name AS dup_key, {pick('duplicate', 'c_custkey', 0.05)} AS p FROM customer),
k AS ({spread_donors('(SELECT dup_key FROM c WHERE NOT p)', 'dup_key', 50)}),
n AS (SELECT c_custkey, CASE WHEN p THEN (SELECT v FROM k WHERE k.i = {choice('duplicate:slot', 'c.c_custkey', 50)} % k.m) ELSE dup_key END AS dup_key FROM c)
SELECT event_id, user_id, dup_key FROM r LEFT JOIN n ON user_id = c_custkey""",
    "an_framework": f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM ({INJECTED_ORDERS})",
    "an_report": f"""WITH x AS ({INJECTED_ORDERS})
SELECT 'total' AS anomaly, count(*) AS rows FROM x
UNION ALL SELECT 'clean', count_if(NOT (m_cust OR m_status OR m_price OR m_date)) FROM x
UNION ALL SELECT 'o_custkey', count_if(m_cust) FROM x
UNION ALL SELECT 'o_orderstatus', count_if(m_status) FROM x
UNION ALL SELECT 'o_totalprice', count_if(m_price) FROM x
UNION ALL SELECT 'o_orderdate', count_if(m_date) FROM x""",
    "an_detect": f"""WITH x AS ({INJECTED_ORDERS}),
f AS (SELECT m_cust, m_status, m_price, m_date,
             o_custkey IS NULL AS d_cust,
             coalesce(o_orderstatus NOT IN ('F', 'O', 'P'), false) AS d_status,
             coalesce(o_totalprice < 0, false) AS d_price,
             coalesce(o_orderdate > DATE '{DETECT_AS_OF}', false) AS d_date FROM x)
SELECT 'cust_not_null' AS rule_name, count_if(m_cust) AS injected, count_if(d_cust) AS detected, count_if(m_cust AND d_cust) AS both FROM f
UNION ALL SELECT 'status_valid', count_if(m_status), count_if(d_status), count_if(m_status AND d_status) FROM f
UNION ALL SELECT 'price_min', count_if(m_price), count_if(d_price), count_if(m_price AND d_price) FROM f
UNION ALL SELECT 'date_not_future', count_if(m_date), count_if(d_date), count_if(m_date AND d_date) FROM f""",
    "src_batch_lookup": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders WHERE o_custkey IS NOT NULL",
    "src_comments": "SELECT r_regionkey, r_name, 'Region key' AS key_comment, 'Region name' AS name_comment FROM region",
    "src_delimited": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, true AS has_lineage FROM customer""",
    "src_fixed_width": f"SELECT {FW_FIELDS} FROM (SELECT {CUSTOMER_LINE} AS l FROM customer)",
    "src_fixed_width_truncated": f"SELECT {FW_FIELDS} FROM (SELECT {TRUNCATED} AS l FROM ({CUSTOMER_LINES}))",
    "src_contracts": _contract_checks(),
    "bronze_silver_e2e": "SELECT c_custkey, c_acctbal, c_mktsegment, c_name FROM customer WHERE c_acctbal >= 0",
    "bronze_fixed_width_e2e": f"""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                  CASE WHEN {pick('out_of_range', 'c_custkey', 0.03)} THEN {choose('out_of_range:value', 'c_custkey', C.BAD_SEGMENTS)} ELSE c_mktsegment END AS c_mktsegment
           FROM customer),
lines AS (SELECT c_custkey, {CUSTOMER_LINE} AS line FROM c),
t AS (SELECT {TRUNCATED} AS l FROM lines),
p AS (SELECT substring(l, 1, 12) AS cust_id, trim(substring(l, 13, 30)) AS cust_name, TRY_CAST(substring(l, 47, 12) AS BIGINT) AS balance_cents,
             trim(substring(l, 59, 18)) AS segment, substring(l, 77, 4) AS record_type, length(l) AS line_length FROM t)
SELECT TRY_CAST(cust_id AS BIGINT) AS cust_key, cust_name, segment, CAST(balance_cents / 100.0 AS DOUBLE) AS balance_dollars
FROM p
WHERE regexp_matches(cust_id, '^\\d{{12}}$') AND line_length = 80
  AND segment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
  AND coalesce(balance_cents >= 0, true) AND record_type = 'CUST'""",
    "dq_report_history": _report_sql(),
    "refine_contracts_e2e": f"""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                  CASE WHEN {pick('out_of_range', 'c_custkey', 0.03)} THEN {choose('out_of_range:value', 'c_custkey', C.BAD_SEGMENTS)} ELSE c_mktsegment END AS c_mktsegment
           FROM customer),
lines AS (SELECT c_custkey, {CUSTOMER_LINE} AS line FROM c),
t AS (SELECT {TRUNCATED} AS l FROM lines),
p AS (SELECT substring(l, 1, 12) AS cust_id, TRY_CAST(substring(l, 47, 12) AS BIGINT) AS balance_cents,
             trim(substring(l, 59, 18)) AS segment, substring(l, 77, 4) AS record_type, length(l) AS line_length FROM t),
fw AS (SELECT cust_id IS NULL AS f0, coalesce(NOT regexp_matches(cust_id, '^\\d{{12}}$'), false) AS f1,
              coalesce(line_length != 80, false) AS f2,
              coalesce(segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'), false) AS f3,
              coalesce(balance_cents < 0, false) AS f4, coalesce(record_type NOT IN ('CUST'), false) AS f5 FROM p)
SELECT 'customer' AS dataset_name, 'custkey_not_null' AS rule_name, 'not_null' AS rule_type, 'CRITICAL' AS severity, count_if(c_custkey IS NULL) AS fail_count FROM customer
UNION ALL SELECT 'customer', 'custkey_unique', 'unique', 'CRITICAL', count(*) - count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'customer', 'name_format', 'regex', 'CRITICAL', count_if(NOT regexp_matches(trim(c_name), '^Customer#\\d{{9}}$')) FROM customer
UNION ALL SELECT 'customer', 'segment_valid', 'accepted_values', 'ERROR',
                 count_if(upper(trim(c_mktsegment)) NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) FROM customer
UNION ALL SELECT 'customer', 'acctbal_min', 'range', 'WARNING', count_if(c_acctbal < 0) FROM customer
UNION ALL SELECT 'customer_fw', 'cust_id_not_null', 'not_null', 'CRITICAL', count_if(f0) FROM fw
UNION ALL SELECT 'customer_fw', 'cust_id_format', 'regex', 'CRITICAL', count_if(f1) FROM fw
UNION ALL SELECT 'customer_fw', 'line_length_exact', 'exact_length', 'CRITICAL', count_if(f2) FROM fw
UNION ALL SELECT 'customer_fw', 'segment_valid', 'accepted_values', 'ERROR', count_if(f3) FROM fw
UNION ALL SELECT 'customer_fw', 'balance_min', 'range', 'WARNING', count_if(f4) FROM fw
UNION ALL SELECT 'customer_fw', 'record_type_valid', 'accepted_values', 'CRITICAL', count_if(f5) FROM fw""",
    "st_expectations": f"""SELECT 'user_not_null' AS rule_name, count_if({EVENT_FLAGS[0]}) AS failed_records, (SELECT count(*) FROM events) AS rows_kept FROM events
UNION ALL SELECT 'event_type_valid', count_if({EVENT_FLAGS[1]}), (SELECT count(*) FROM events) FROM events
UNION ALL SELECT 'props_format', count_if({EVENT_FLAGS[2]}), (SELECT count(*) FROM events) FROM events""",
    "st_ingest": "SELECT event_id, user_id, event_type FROM events",
    "st_rerun": "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct FROM events",
    "st_full_refresh": "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct FROM events",
    "st_foreach_batch_dq": f"""SELECT route, count(*) AS n_rows FROM (
  SELECT CASE WHEN {' OR '.join(EVENT_FLAGS)} THEN 'quarantine' ELSE 'clean' END AS route FROM events
  UNION ALL SELECT 'quarantine' FROM events WHERE event_id % 7 = 0)
GROUP BY route""",
    "st_full_refresh_same_checkpoint": "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct FROM events",
    "st_two_checkpoints": "SELECT 2 * count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct FROM events",
    "st_expectations_many_batches": "\nUNION ALL\n".join(
        f"SELECT '{r.rule_name}' AS rule_name, count_if({f}) AS failed_records, count(*) AS rows_kept FROM ({EVENTS_FEED})" for r, f in zip(C.EVENT_RULES[:3], EVENT_FLAGS)
    ),
    "dq_unique_ties": """SELECT o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders))
WHERE o_custkey IS NOT NULL AND rn > 1""",
    "dq_unique_null_tie": "SELECT o_custkey, count(*) - 1 AS n_failed FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1",
    "dq_unique_repeated_line": """SELECT count_if(c_custkey % 5 = 0) AS fail_count,
       CAST(count_if(c_acctbal >= 0) AS INTEGER) AS clean_keys, CAST(count_if(c_acctbal >= 0) AS INTEGER) AS clean_rows FROM customer""",
    "dq_unique_redelivered": """SELECT count(*) AS fail_count,
       CAST(count_if(c_acctbal >= 0) AS INTEGER) AS clean_keys, CAST(count_if(c_acctbal >= 0) AS INTEGER) AS clean_rows FROM customer""",
    "silver_table_clean": f"""{ORDERS_WITH}
SELECT o_orderkey, o_orderstatus FROM flags WHERE NOT ({ANY_FLAG})""",
    "q_rerun_repaired": f"""SELECT 'cust_not_null' AS rule_name, count(*) AS total_count, CAST(0 AS BIGINT) AS fail_count,
       CAST(0 AS INTEGER) AS quarantined, CAST(count(*) AS INTEGER) AS silver_rows FROM ({ORDERS_FEED}) WHERE o_custkey IS NOT NULL""",
    "src_contract_lint": """SELECT * FROM (SELECT CAST(count(*) AS INTEGER) AS rows_in_table FROM lineitem), (VALUES
  (0, 'rule ''a'' is about unknown column ''l_nothing'''), (1, 'rule kind ''checksum'' is not supported'),
  (2, 'a rule of kind range has no bound'), (2, 'duplicate rule_name ''c'''), (3, 'lower bound 2.0 is above upper bound 1.0'),
  (4, 'rule ''d'' is about unknown column ''l_shipmode'''), (4, 'a rule of kind accepted_values lacks its parameter ''values''')) AS v(rule_index, problem)""",
    "an_reuse_prefix": f"""
WITH d AS ({donors("(SELECT substring(c_name, 1, 16) AS p FROM customer)", 'p', 500)})
SELECT o_orderkey, CASE WHEN {pick('reuse_prefix', 'o_orderkey', 0.7)} THEN (SELECT v FROM d WHERE d.i = {choice('reuse_prefix:slot', 'o.o_orderkey', 500)} % d.m)
       ELSE o_orderpriority END AS client_prefix
FROM orders o""",
    "an_detect_formats": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule_name, count_if({p}) AS injected, count_if({p}) AS detected, count_if({p}) AS both FROM {t}"
        for name, p, t in (
            ("date_format", pick("format_error", "o_orderkey", 0.02), "orders"), ("exact_length", pick("format_error", "c_custkey", 0.02), "customer"),
            ("range_both", pick("out_of_range", "p_partkey", 0.03), "part"), ("range_negative", pick("out_of_range", "c_custkey", 0.03), "customer"),
            ("regex", pick("format_error", "c_custkey", 0.05), "customer"),
        )
    ),
    "an_detect_duplicates": f"SELECT count_if({pick('duplicate', 'c_custkey', 0.02)}) AS injected, count_if({pick('duplicate', 'c_custkey', 0.02)}) AS detected FROM customer",
    "gold_health": """
WITH r AS (
  SELECT 'clients' AS dataset_name, 'client_known' AS rule_name, 'CRITICAL' AS severity, 0.0::DOUBLE AS pct UNION ALL
  SELECT 'clients', 'aum_range', 'ERROR', round(count_if(CAST(o_totalprice AS DECIMAL(18, 2)) < 20000) / count(*) * 100, 2) FROM orders UNION ALL
  SELECT 'apps', 'status_known', 'ERROR', round(count_if(upper(event_type) NOT IN ('CLICK', 'PURCHASE', 'VIEW')) / count(*) * 100, 2) FROM events)
SELECT CAST(row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 ELSE 2 END, pct DESC, dataset_name, rule_name) AS INTEGER) AS position,
       dataset_name, rule_name, severity, pct AS latest_run_fail_pct,
       CASE WHEN severity = 'ERROR' AND pct > 5 THEN 'INVESTIGATE' ELSE 'HEALTHY' END AS status_flag FROM r""",
    "gold_table_facts": """SELECT property, value, CAST((SELECT count(DISTINCT n_regionkey) FROM nation) AS INTEGER) AS n_rows
FROM (VALUES ('comment', 'Nations by region, it''s small'), ('layer', 'gold')) AS v(property, value)""",
    "dq_values_from": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O'))",
    "dq_values_from_text": """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 <> 7 THEN text END AS text FROM documents),
k AS (SELECT DISTINCT text FROM d WHERE doc_id IN (SELECT doc_id FROM labels) AND text IS NOT NULL),
n AS (SELECT count(*) AS total_count, count_if(text IS NOT NULL AND text NOT IN (SELECT text FROM k)) AS fail_count FROM d)
SELECT 'text_labelled' AS rule_name, total_count, fail_count, round(fail_count / total_count * 100, 2) AS fail_pct FROM n""",
    "src_lint_derived": "WITH r AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'), n AS (SELECT count(*) AS total_count FROM lineitem)\n"
    + "\nUNION ALL\n".join(
        [
            f"SELECT '{c}_range' AS rule_name, '' AS problem, total_count, (SELECT count_if({c} < (SELECT min({c}) FROM r) OR {c} > (SELECT max({c}) FROM r)) FROM lineitem) AS fail_count FROM n"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ]
        + [f"SELECT '{c}_known', '', total_count, (SELECT count(*) FROM lineitem WHERE {c} NOT IN (SELECT {c} FROM r)) FROM n" for c in ("l_returnflag", "l_linestatus")]
        + [f"SELECT '{c}_range', 'bound ' || (SELECT {f}({c}) FROM r) || ' is not readable as a number', NULL, NULL FROM n" for c in ("l_returnflag", "l_linestatus") for f in ("min", "max")]
        + ["SELECT 'l_colour_known', 'rule ''l_colour_known'' is about unknown column ''l_colour''', NULL, NULL FROM n"]
    ),
    "src_rescued_rows": """WITH c AS (SELECT *, CASE c_custkey % 11 WHEN 3 THEN 'short' WHEN 5 THEN 'long' WHEN 7 THEN 'broken' ELSE 'sound' END AS kind FROM customer)
SELECT kind, count(*) AS n_rows, sum(c_custkey)::BIGINT AS keys, count_if(kind IN ('long', 'sound')) AS segments,
  CASE WHEN kind = 'long' THEN 'x,"y|z"' END AS surplus, count_if(kind <> 'sound') AS lines_kept FROM c GROUP BY kind""",
    "src_fixed_width_bytes": """WITH c AS (SELECT translate(c_mktsegment, 'AEO', 'ÀÉÖ') AS segment, c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)
SELECT segment, count(*) AS n_rows, sum(cents)::BIGINT AS cents, sum(c_custkey)::BIGINT AS keys, 44 AS line_bytes, charset
FROM c, (VALUES ('ISO-8859-1'), ('UTF-8')) AS v(charset) GROUP BY segment, charset""",
    "lake_table_facts": """WITH n AS (SELECT count(*) AS b, count_if(c_acctbal >= 0) AS s FROM customer)
SELECT layer, property, value, CAST(CASE layer WHEN 'bronze' THEN b WHEN 'silver' THEN s ELSE 5 END AS INTEGER) AS n_rows
FROM n, (VALUES ('bronze', 'comment', 'Customer master rows from the pipe-delimited feed'), ('bronze', 'quality', 'bronze'), ('bronze', 'c_custkey', 'Customer key (raw string)'), ('bronze', 'c_name', 'Customer name'),
  ('silver', 'comment', 'Customer master rows from the pipe-delimited feed: rows that pass the quality rules'), ('silver', 'quality', 'silver'),
  ('results', 'comment', 'Quality results: a row per run, dataset and rule'), ('results', 'quality', 'results')) AS v(layer, property, value)""",
    "pub_old_version_kept": """WITH f AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
SELECT step, o_orderstatus, n AS n_rows, 2 AS versions FROM f, (VALUES ('first'), ('after a failed write'), ('repaired')) AS v(step)
WHERE step = 'repaired' OR o_orderstatus = 'F'""",
    "st_refresh_switches": """SELECT step, count_if(step = 'refreshed' OR event_id % 2 = 0) AS n_rows,
  count(DISTINCT CASE WHEN step = 'refreshed' OR event_id % 2 = 0 THEN event_id END) AS n_distinct
FROM events, (VALUES ('ingested'), ('after a failed refresh'), ('refreshed')) AS v(step) GROUP BY step""",
    "q_rerun_safe": f"""{ORDERS_WITH}
SELECT 'dq_results' AS table_name, CAST({len(C.ORDER_RULES)} AS BIGINT) AS n_rows
UNION ALL SELECT 'quarantine', count(*) FROM flags WHERE {ANY_FLAG}""",
}

ORACLE["gold_health_incremental"] = ORACLE["dq_report_history"]

ORACLE["gold_advisors"] = (
    ORACLE["jn_left_fanout"]
    .replace("AS aum FROM orders)", "AS aum FROM orders WHERE CAST(o_totalprice AS DECIMAL(18, 2)) >= 20000)")
    .replace("AS credit_score FROM events)", "AS credit_score FROM events WHERE upper(event_type) IN ('CLICK', 'PURCHASE', 'VIEW'))")
)
ORACLE["gold_snapshot"] = (
    ORACLE["jn_prefix_inner"]
    .replace("AS aum FROM customer)", "AS aum FROM customer WHERE c_acctbal >= 0)")
    .replace("WHERE o_orderstatus = 'F')", "WHERE o_orderstatus = 'F' AND regexp_matches(o_orderpriority, '^[12345]-.*'))")
)


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT.  Wrap each call in a cast."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + token + _bigint_counts(sql[j + len(token) : k - 1]) + ") AS BIGINT)")
        i = k


ORACLE = {name: _bigint_counts(sql) for name, sql in ORACLE.items()}
