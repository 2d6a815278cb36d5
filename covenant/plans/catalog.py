"""Named queries over the driver's test tables, one per operator group.

Every query reads whole tables (or what Spark derives from them) and returns
a lazy DataFrame; queries that exercise files, streams or sinks first write
to a fresh folder below the session's shared checkpoint root.  The matching
SQL for an independent engine lives in ``oracle.py``; computed columns carry
the same names on both sides.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import Rule, fail_condition
from ..functions.scalars import guarded_ratio, days_since, key_prefix, risk_band
from ..functions.transforms import apply_transforms
from ..operators import anomalies as an
from ..operators.checks import FAILED_RULES, PASSED, check, pass_all
from ..operators.metrics import critical_failures, measure, measure_rules, severity_totals, summary_lines
from ..operators.publish import publish, publish_table, read_published, versions
from ..operators.routing import clean, expectation_counts, expectations, quarantine
from ..operators.sinks import column_comments, fixed_width_line, save_table, table_facts, with_comments, write_delimited, write_results, write_table
from ..session import scratch_path
from ..sources import contracts as ct
from ..sources import shipped
from ..sources.files import RESCUED_FIELDS, RESCUED_KIND, RESCUED_LINE, read_delimited, read_fixed_width, read_results_history
from ..streaming.batches import run_checked
from ..streaming.ingest import counted, read_versioned, run_available_now, run_versioned, stream_id, write_batch
from . import marts
from .bronze import read_bronze, run_bronze
from .health import health_report, read_health, update_health
from .refine import refine_all
from .silver import run_silver

AS_OF = "2000-01-01"
MART_AS_OF = "2002-01-01"
DETECT_AS_OF = "2001-12-31"  # after the newest order date, so only injected dates are "future"
RUN_TS = "2024-02-01 00:00:00"

# Corrupt values for the domains of the test tables.
BAD_DATES = ["19970230", "19971301", "not-date", "99999999"]
BAD_PRIORITY = ["9-NEVER", "0-NONE", "URGENT"]
BAD_NAMES = ["Customer 12", "#000000001", "Customer#1", "?"]
BAD_SEGMENTS = ["AIRCRAFT", "??", "0"]
BAD_STATUS = ["X", "Y", "Z"]
BAD_SIZES = [0, 51, 99]
BAD_NUMBERS = ["n/a", "12,5", ""]
BAD_ISO_DATES = ["2024-02-30", "not a date"]

Query = Callable[[SparkSession, str], DataFrame]


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The given table; the lazy scan is reused within a session (the inputs are read-only)."""
    path = f"{sf}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


# ---------------------------------------------------------------------------
# Orders feed with injected NULLs and the standard rule set
# ---------------------------------------------------------------------------

ORDER_RULES = [
    Rule("cust_not_null", "o_custkey", "not_null", "critical"),
    Rule("status_valid", "o_orderstatus", "accepted_values", "error", {"values": ["F", "O"]}),
    Rule("price_range", "o_totalprice", "range", "warning", {"min": 1000, "max": 400000}),
    Rule("priority_format", "o_orderpriority", "regex", "error", {"pattern": r"^[1-5]-(URGENT|HIGH|MEDIUM|LOW)$"}),
    Rule("date_not_future", "o_orderdate", "not_future_date", "error"),
    Rule("cust_unique", "o_custkey", "unique", "critical", order_by=("o_orderkey",)),
]


def orders_feed(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    o = an.inject_null(o, "o_custkey", 0.03, "o_orderkey", kind="null")
    return an.inject_null(o, "o_orderdate", 0.02, "o_orderkey", kind="null_date")


def orders_checked(spark: SparkSession, sf: str) -> DataFrame:
    return check(orders_feed(spark, sf), ORDER_RULES, as_of=AS_OF)


def orders_results(spark: SparkSession, sf: str) -> DataFrame:
    return measure_rules(orders_feed(spark, sf), ORDER_RULES, dataset="orders", run_id="r1", run_ts=RUN_TS, as_of=AS_OF)


def orders_counts(spark: SparkSession, sf: str) -> DataFrame:
    return measure_rules(orders_feed(spark, sf), ORDER_RULES, dataset="orders", run_id="r1", run_ts=RUN_TS, as_of=AS_OF, samples=False)


def _failing(df: DataFrame, rules, *cols, as_of=AS_OF) -> DataFrame:
    a = check(df, rules, as_of=as_of)
    return a.where(~F.col(PASSED)).select(*cols)


# ---------------------------------------------------------------------------
# One rule kind each
# ---------------------------------------------------------------------------


def dq_not_null(spark, sf):
    return _failing(orders_feed(spark, sf), [ORDER_RULES[0]], "o_orderkey")


def dq_accepted_values(spark, sf):
    return _failing(table(spark, sf, "orders"), [ORDER_RULES[1]], "o_orderkey", "o_orderstatus")


def dq_range(spark, sf):
    rules = [Rule("acctbal_range", "c_acctbal", "range", "warning", {"min": 0, "max": 9000})]
    return _failing(table(spark, sf, "customer"), rules, "c_custkey", "c_acctbal")


def dq_range_open(spark, sf):
    rules = [
        Rule("qty_min", "l_quantity", "range", "warning", {"min": 5}),
        Rule("disc_max", "l_discount", "range", "warning", {"max": 0.08}),
    ]
    a = check(table(spark, sf, "lineitem"), rules)
    return a.where(~F.col(PASSED)).select("l_orderkey", "l_linenumber", F.array_join(FAILED_RULES, ",").alias("failed_rules"))


def dq_regex(spark, sf):
    rules = [Rule("brand_format", "p_brand", "regex", "error", {"pattern": r"^Brand#\d$"})]
    return _failing(table(spark, sf, "part"), rules, "p_partkey", "p_brand")


def dq_not_future_date(spark, sf):
    a = check(orders_feed(spark, sf), [ORDER_RULES[4]], as_of=AS_OF)
    return a.select("o_orderkey", F.col(PASSED).alias("passed"))


def date_strings(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("raw_date"))
    return an.inject_choice(o, "raw_date", 0.02, "o_orderkey", BAD_DATES, kind="format_error")


def dq_date_format(spark, sf):
    rules = [Rule("raw_date_format", "raw_date", "date_format", "error", {"format": "yyyyMMdd"})]
    return _failing(date_strings(spark, sf), rules, "o_orderkey", "raw_date")


# Fixed-width layout for customer rows (80 characters).
CUSTOMER_LAYOUT = [
    {"column": "c_custkey", "length": 12, "kind": "number"},
    {"column": "c_name", "length": 30, "kind": "text"},
    {"column": "c_nationkey", "length": 4, "kind": "number"},
    {"column": "balance_cents", "length": 12, "kind": "number"},
    {"column": "c_mktsegment", "length": 18, "kind": "text"},
    {"column": "record_type", "length": 4, "kind": "raw"},
]
CUSTOMER_FIELDS = [
    {"name": "cust_id", "start": 1, "length": 12, "cast": "long"},
    {"name": "cust_name", "start": 13, "length": 30, "trim": True},
    {"name": "nation", "start": 43, "length": 4, "cast": "int"},
    {"name": "balance_cents", "start": 47, "length": 12, "cast": "long"},
    {"name": "segment", "start": 59, "length": 18, "trim": True},
    {"name": "record_type", "start": 77, "length": 4},
]


def customer_cents(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").withColumn("balance_cents", F.round(F.col("c_acctbal") * 100).cast("long")).withColumn("record_type", F.lit("CUST"))


def customer_lines(spark, sf, truncate: bool = False) -> DataFrame:
    lines = customer_cents(spark, sf).select("c_custkey", fixed_width_line(CUSTOMER_LAYOUT).alias("value"))
    if truncate:
        lines = an.inject_truncate(lines, "value", 0.02, "c_custkey", 30, 70, kind="format_error")
    return lines


def dq_exact_length(spark, sf):
    parsed = customer_lines(spark, sf, truncate=True).select("c_custkey", F.length("value").alias("line_length"))
    rules = [Rule("line_length_exact", "line_length", "exact_length", "critical", {"length": 80})]
    return _failing(parsed, rules, "c_custkey", "line_length")


def dq_unique(spark, sf):
    return _failing(table(spark, sf, "orders"), [ORDER_RULES[5]], "o_orderkey")


def dq_unique_hot(spark, sf):
    """unique on a key where each value holds about a third of all rows (three return flags)."""
    rules = [Rule("returnflag_unique", "l_returnflag", "unique", "warning", order_by=("l_orderkey", "l_linenumber"))]
    return _failing(table(spark, sf, "lineitem"), rules, "l_orderkey", "l_linenumber")


def dq_unique_default(spark, sf):
    """unique without order_by: every column, in schema order, breaks ties (struct path)."""
    rules = [Rule("segment_unique", "c_mktsegment", "unique", "warning")]
    return _failing(table(spark, sf, "customer"), rules, "c_custkey")


def dq_unique_text(spark, sf):
    rules = [Rule("text_unique", "text", "unique", "error", order_by=("doc_id",))]
    return _failing(table(spark, sf, "documents"), rules, "doc_id")


def dq_unique_ties(spark, sf):
    """Every order stands twice, equal in every column: one copy of the first order of a customer passes."""
    o = table(spark, sf, "orders")
    return _failing(o.unionAll(o), [Rule("cust_unique", "o_custkey", "unique", "error")], "o_orderkey")


def dq_unique_null_tie(spark, sf):
    """The tie-break is NULL for every row of a key: still one row of a key passes."""
    o = table(spark, sf, "orders").withColumn("tie", F.lit(None).cast("string"))
    bad = _failing(o, [Rule("cust_unique", "o_custkey", "unique", "error", order_by=("tie",))], "o_custkey")
    return bad.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_failed"))


def dq_values_from(spark, sf):
    """accepted_values against a table: lines whose order is not among the finished and open orders."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    rule = Rule("order_known", "l_orderkey", "accepted_values", "error", {"values_from": "orders", "values_column": "o_orderkey"})
    bad = check(l, [rule], references={"orders": o.where("o_orderstatus IN ('F', 'O')")}).where(~F.col(PASSED))
    return bad.select("l_orderkey", "l_linenumber")


def dq_values_from_text(spark, sf):
    """The same over whole texts, measured: documents whose text is not that of any labelled document; NULL passes."""
    d = table(spark, sf, "documents").withColumn("text", F.when(F.col("doc_id") % 50 != 7, F.col("text")))
    labelled = d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    rule = Rule("text_labelled", "text", "accepted_values", "warning", {"values_from": "labelled"})
    out = measure_rules(d, [rule], dataset="documents", run_id="v", run_ts=RUN_TS, samples=False, references={"labelled": labelled})
    return out.select("rule_name", "total_count", "fail_count", "fail_pct")


def sc_functions(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.array_join(
            F.array_compact(F.array(F.when(F.col("o_orderstatus") == "F", F.lit("final")), F.when(F.col("o_totalprice") > 200000, F.lit("big")))), ","
        ).alias("tags"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.pmod(F.col("o_orderkey"), F.lit(3)) + 1).cast("int")).alias("pick_word"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("price_floor"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd").alias("due_date"),
        F.round(F.col("o_totalprice") / 7, 2).alias("price_round"),
        F.upper(F.trim(F.lower("o_orderpriority"))).alias("prio_upper"),
        (F.col("o_orderkey") % 7).alias("key_mod"),
        F.substring(F.lpad(F.col("o_custkey").cast("string"), 9, "0"), 1, 6).alias("cust_prefix"),
        F.length("o_orderpriority").cast("long").alias("prio_len"),
    )


def dq_annotate(spark, sf):
    return orders_checked(spark, sf).select("o_orderkey", F.col(PASSED).alias("passed"), F.array_join(FAILED_RULES, ",").alias("failed_rules"))


def _metric_cols(df):
    return df.select(
        "rule_name", F.col("column").alias("rule_column"), "rule_type", "severity", "total_count", "pass_count", "fail_count", "fail_pct"
    )


def dq_metrics(spark, sf):
    return _metric_cols(orders_counts(spark, sf))


def dq_samples(spark, sf):
    return orders_results(spark, sf).select("rule_name", F.array_join("sample_failures", ",").alias("samples"))


def dq_clean(spark, sf):
    return clean(orders_checked(spark, sf)).select("o_orderkey")


def dq_quarantine(spark, sf):
    return quarantine(orders_checked(spark, sf)).select("o_orderkey")


def dq_severity_totals(spark, sf):
    return severity_totals(orders_counts(spark, sf))


def dq_summary_lines(spark, sf):
    return summary_lines(orders_counts(spark, sf)).select("rule_name", "severity", "fail_count", "status")


def dq_critical_gate(spark, sf):
    return critical_failures(orders_counts(spark, sf)).select("rule_name", "fail_count")


LINEITEM_RULES = [
    Rule("orderkey_not_null", "l_orderkey", "not_null", "critical"),
    Rule("returnflag_valid", "l_returnflag", "accepted_values", "error", {"values": ["A", "N", "R"]}),
    Rule("linestatus_valid", "l_linestatus", "accepted_values", "error", {"values": ["O", "F"]}),
    Rule("quantity_range", "l_quantity", "range", "warning", {"min": 1, "max": 45}),
    Rule("discount_range", "l_discount", "range", "warning", {"min": 0, "max": 0.08}),
    Rule("tax_max", "l_tax", "range", "warning", {"max": 0.06}),
    Rule("shipdate_not_future", "l_shipdate", "not_future_date", "error"),
    Rule("linenumber_range", "l_linenumber", "range", "error", {"min": 1, "max": 6}),
]


def dq_lineitem_rules(spark, sf):
    """Eight rules over the whole lineitem table, all counted in one aggregation."""
    li = table(spark, sf, "lineitem")
    return _metric_cols(measure_rules(li, LINEITEM_RULES, dataset="lineitem", run_id="r1", run_ts=RUN_TS, as_of=AS_OF, samples=False))


EVENT_RULES = [
    Rule("user_not_null", "user_id", "not_null", "critical"),
    Rule("event_type_valid", "event_type", "accepted_values", "critical", {"values": ["click", "view", "purchase", "signup"]}),
    Rule("props_format", "props", "regex", "critical", {"pattern": r'^\{"k": \d+\}$'}),
    Rule("value_range", "value", "range", "warning", {"min": 0, "max": 50}),
    Rule("event_unique", "event_id", "unique", "critical", order_by=("ts",)),
]


def events_feed(spark, sf) -> DataFrame:
    return an.inject_null(table(spark, sf, "events"), "user_id", 0.01, "event_id", kind="null")


def dq_expectations(spark, sf):
    return expectation_counts(events_feed(spark, sf), EVENT_RULES)


def events_results_by_day(spark, sf) -> DataFrame:
    """Quality results for the events feed with one "run" per day of ``ts`` (one aggregation)."""
    a = check(events_feed(spark, sf), EVENT_RULES).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    r = measure(a, EVENT_RULES, dataset="events", run_id="", samples=False, group_cols=["day"])
    return r.select(
        F.col("day").alias("run_id"), F.to_timestamp("day").alias("run_timestamp"), "dataset_name", "rule_name", "column",
        "rule_type", "severity", "total_count", "pass_count", "fail_count", "fail_pct",
    )


def dq_report(spark, sf):
    return marts.rule_health(events_results_by_day(spark, sf), ordered=False).select(
        "dataset_name", "rule_name", "severity", "latest_run_fail_pct", "total_runs_checked", "runs_with_failures", "max_fail_pct_ever", "status_flag", "severity_rank"
    )


def dq_embedding_first(spark, sf):
    e = apply_transforms(table(spark, sf, "embeddings"), [{"column": "e0", "expr": "CAST(embedding[0] AS DOUBLE)"}])
    rules = [Rule("e0_range", "e0", "range", "warning", {"min": -0.1, "max": 0.1})]
    return _failing(e, rules, "vec_id", "e0")


def dq_labels(spark, sf):
    rules = [
        Rule("quality_ok", "quality", "accepted_values", "error", {"values": [1]}),
        Rule("toxic_max", "toxic", "range", "error", {"max": 0}),
    ]
    a = check(table(spark, sf, "labels"), rules)
    return a.where(~F.col(PASSED)).select("doc_id", F.array_join(FAILED_RULES, ",").alias("failed_rules"))


def dq_roles(spark, sf):
    rules = [Rule("role_valid", "role", "accepted_values", "error", {"values": ["user", "assistant"]})]
    return _failing(table(spark, sf, "conversations"), rules, "conv_id", "turn", "role")


def dq_urls(spark, sf):
    rules = [Rule("url_https", "url", "regex", "warning", {"pattern": r"^https://[a-z.]+\.example\.(com|org|net)/"})]
    return _failing(table(spark, sf, "pages"), rules, "page_id", "url")


# ---------------------------------------------------------------------------
# Transforms
# ---------------------------------------------------------------------------


def tr_cast(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.col("o_custkey").cast("string").alias("cust")
    )
    o = an.inject_choice(o, "price", 0.05, "o_orderkey", BAD_NUMBERS, kind="format_error")
    return apply_transforms(o, [{"column": "price", "type": "double"}, {"column": "cust", "type": "integer"}])


def tr_date(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("odate"))
    o = an.inject_choice(o, "odate", 0.05, "o_orderkey", BAD_ISO_DATES, kind="format_error")
    out = apply_transforms(o, [{"column": "odate", "type": "date"}])
    return out.select("o_orderkey", F.date_format("odate", "yyyy-MM-dd").alias("odate"))


def tr_date_fmt(spark, sf):
    out = apply_transforms(date_strings(spark, sf), [{"column": "raw_date", "type": "date", "format": "yyyyMMdd"}])
    return out.select("o_orderkey", F.date_format("raw_date", "yyyy-MM-dd").alias("raw_date"))


def tr_ts_fmt(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("ts_raw"))
    e = an.inject_choice(e, "ts_raw", 0.03, "event_id", ["31/02/2024 10:00:00", "2024-01-01"], kind="format_error")
    out = apply_transforms(e, [{"column": "ts_raw", "type": "timestamp", "format": "dd/MM/yyyy HH:mm:ss"}])
    return out.select("event_id", F.date_format("ts_raw", "yyyy-MM-dd HH:mm:ss").alias("ts_parsed"))


def tr_expr(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment"))
    return apply_transforms(c, [{"column": "segment", "expr": "UPPER(TRIM(segment))"}])


def tr_derived(spark, sf):
    c = customer_cents(spark, sf).select("c_custkey", "balance_cents")
    out = apply_transforms(c, [{"column": "balance_dollars", "expr": "CAST(balance_cents / 100.0 AS DOUBLE)"}])
    return out


def tr_ordered(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    steps = [
        {"column": "name_trim", "expr": "TRIM(c_name)"},
        {"column": "name_key", "expr": "substring(name_trim, 10, 9)"},
        {"column": "name_key", "type": "long"},
        {"column": "name_len", "expr": "length(name_trim)", "type": "string"},  # expr wins over type
        {"column": "c_name"},  # neither: no-op
    ]
    out = apply_transforms(c, steps)
    return out.select("c_custkey", "name_key", F.col("name_len").cast("long").alias("name_len"), (F.col("name_key") == F.col("c_custkey")).alias("key_matches"))


def tr_json_expr(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    return apply_transforms(e, [{"column": "k", "expr": "CAST(get_json_object(props, '$.k') AS INT)"}]).select("event_id", "k")


def tr_band(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).cast("int").alias("risk_rating"))
    return o.select("o_orderkey", risk_band(F.col("risk_rating")).alias("risk_band"))


def tr_ratio(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", guarded_ratio(F.col("o_totalprice"), (F.col("o_orderkey") % 5).cast("double")).alias("ratio"))


def tr_age(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", days_since(F.col("o_orderdate"), MART_AS_OF).cast("long").alias("days_since_order"))


def tr_pass_all(spark, sf):
    n = table(spark, sf, "nation")
    none = pass_all(n).select("n_nationkey", F.col(PASSED).alias("passed_no_rules"), F.size(FAILED_RULES).cast("long").alias("n_failed_no_rules"))
    unknown = check(n, [Rule("mystery", "n_name", "checksum", "error")]).select(
        "n_nationkey", F.col(PASSED).alias("passed_unknown"), F.size(FAILED_RULES).cast("long").alias("n_failed_unknown")
    )
    return none.join(unknown, "n_nationkey")


def tr_stamp(spark, sf):
    n = apply_transforms(table(spark, sf, "nation"), [{"column": "n_name", "expr": "lower(n_name)"}], stamp=True)
    n = n.withColumn("has_stamp", F.col("_silver_processed_ts").isNotNull()).drop("_silver_processed_ts")
    return n.select("n_nationkey", "n_name", "has_stamp")


def tr_prefix(spark, sf):
    o = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & F.col("o_custkey").isNotNull()).alias("o")
    return o.select(F.col("o.o_orderkey").alias("order_key"), key_prefix(F.lpad(F.col("o.o_custkey").cast("string"), 9, "0"), 6).alias("cust_prefix"))


# ---------------------------------------------------------------------------
# Joins and marts
# ---------------------------------------------------------------------------


def mart_clients(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("client_id"),
        F.col("o_custkey").cast("string").alias("advisor_id"),
        F.col("o_orderstatus").alias("account_type"),
        F.col("o_orderpriority").alias("region"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("risk_rating"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("aum"),
    )


def mart_apps(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("app_id"),
        F.col("user_id").cast("string").alias("advisor_id"),
        F.upper("event_type").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("credit_score"),
    )


def jn_left_fanout(spark, sf):
    return _advisor_columns(marts.advisor_portfolio(mart_clients(spark, sf), mart_apps(spark, sf), approved="PURCHASE"))


def _advisor_columns(g: DataFrame) -> DataFrame:
    return g.select(
        "advisor_id", "account_type", "region", "risk_rating", "total_clients",
        F.col("total_applications").cast("long").alias("total_applications"),
        F.col("total_aum").cast("double").alias("total_aum"),
        F.col("avg_aum").cast("double").alias("avg_aum"),
        "approval_rate",
        F.col("avg_credit_score").cast("double").alias("avg_credit_score"),
        "risk_band", "anomaly_flag",
    )


def snapshot_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    clients = table(spark, sf, "customer").select(
        F.col("c_name").alias("client_id"),
        F.col("c_name").alias("client_name"),
        F.col("c_mktsegment").alias("account_type"),
        F.col("c_nationkey").cast("string").alias("region"),
        ((F.col("c_nationkey") % 5) + 1).alias("risk_rating"),
        F.col("c_acctbal").alias("aum"),
    )
    accounts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("account_number"),
        F.col("o_totalprice").alias("balance_dollars"),
        F.to_date("o_orderdate").alias("open_date"),
        F.col("o_orderpriority").alias("state_code"),
        F.col("o_orderstatus").alias("account_status"),
        F.lit("ORD").alias("product_code"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("client_id_prefix"),
    )
    return clients, accounts


def jn_prefix_inner(spark, sf):
    return _snapshot_columns(marts.balance_snapshot(*snapshot_sides(spark, sf), as_of=MART_AS_OF, active_status="F", prefix_start=10, prefix_len=9))


def jn_prefix_heavy(spark, sf):
    """The balance snapshot with a third of the accounts under one client's prefix, dealt over many tasks."""
    clients, accounts = snapshot_sides(spark, sf)
    hot = F.when(F.col("account_number") % 3 == 0, F.lit("000000007")).otherwise(F.col("client_id_prefix"))
    snap = marts.balance_snapshot(
        clients, accounts.withColumn("client_id_prefix", hot), as_of=MART_AS_OF, active_status="F", prefix_start=10, prefix_len=9, heavy_rows=500
    )
    return _snapshot_columns(snap).groupBy("client_id").agg(F.count(F.lit(1)).alias("n_accounts"), F.sum(F.col("account_number").cast("long")).alias("numbers"))


def _snapshot_columns(snap: DataFrame) -> DataFrame:
    return snap.select(
        "client_id", "account_number", "balance_dollars", "aum", F.col("days_since_open").cast("long").alias("days_since_open"),
        "balance_aum_ratio", "anomaly_flag", "bank_product_code", "state_code", "account_status", "account_type", "region", "risk_rating",
    )


def ag_conditional(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_discount") > 0.05).alias("n_discounted"),
        F.when(F.count("l_tax") > 0, F.count_if(F.col("l_tax") > 0.04) / F.count("l_tax")).alias("taxed_share"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"),
        F.max("l_quantity").alias("max_qty"),
    )


def ag_having(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.where(F.col("l_orderkey").isNotNull()).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 5)


def ag_distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").distinct()


# ---------------------------------------------------------------------------
# Anomaly injectors
# ---------------------------------------------------------------------------


def an_null(spark, sf):
    return orders_feed(spark, sf).select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


def an_duplicate(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("dup_key"))
    return an.inject_duplicates(c, "dup_key", 0.02, "c_custkey", donors=50)


def an_enum(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return an.inject_choice(o, "o_orderstatus", 0.04, "o_orderkey", BAD_STATUS, kind="invalid_enum")


def an_constant(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return an.inject_constant(c, "c_acctbal", 0.03, "c_custkey", -999999.0, kind="out_of_range")


def an_future(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    o = an.inject_future_date(o, "o_orderdate", 0.02, "o_orderkey", AS_OF, 730)
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


def an_choice_int(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return an.inject_choice(p, "p_size", 0.02, "p_partkey", BAD_SIZES, kind="format_error")


def an_malformed(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return an.inject_choice(c, "c_name", 0.05, "c_custkey", BAD_NAMES, kind="format_error")


def an_two_sided(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return an.inject_two_sided(p, "p_size", 0.03, "p_partkey", 0, 999)


def an_status(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return an.inject_choice(o, "o_orderpriority", 0.03, "o_orderkey", BAD_PRIORITY, kind="out_of_range")


def an_truncate(spark, sf):
    return customer_lines(spark, sf, truncate=True).select("c_custkey", F.col("value").alias("line"))


def an_fixed_code(spark, sf):
    c = an.inject_choice(customer_cents(spark, sf), "c_mktsegment", 0.03, "c_custkey", BAD_SEGMENTS, kind="out_of_range")
    return c.select("c_custkey", fixed_width_line(CUSTOMER_LAYOUT).alias("line"))


def an_negative(spark, sf):
    c = an.inject_negative(customer_cents(spark, sf), "balance_cents", 0.03, "c_custkey")
    return c.select("c_custkey", "balance_cents", F.format_string("%012d", F.col("balance_cents")).alias("cents_field"))


def an_bad_date(spark, sf):
    return date_strings(spark, sf)


def an_reuse(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return an.reuse_keys(e, "user_id", 0.6, "event_id", table(spark, sf, "customer"), "c_custkey", sample=500)


def an_reuse_spread(spark, sf):
    """As ``an_reuse``, from a hash sample of the customers' keys; and names from one of their unpicked own."""
    e, c = table(spark, sf, "events").select("event_id", "user_id"), table(spark, sf, "customer")
    reused = an.reuse_keys(e, "user_id", 0.6, "event_id", c, "c_custkey", sample=200, spread=True)
    named = an.inject_duplicates(c.select("c_custkey", F.col("c_name").alias("dup_key")), "dup_key", 0.05, "c_custkey", donors=50, spread=True)
    return reused.join(named, F.col("user_id") == F.col("c_custkey"), "left").select("event_id", "user_id", "dup_key")


def an_reuse_prefix(spark, sf):
    """70 % of the orders carry the first nine characters of a customer name."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("client_prefix"))
    return an.reuse_prefixes(o, "client_prefix", 0.7, "o_orderkey", table(spark, sf, "customer"), "c_name", 16, sample=500)


def injected_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    steps = [
        ("null", an.inject_null, {"column": "o_custkey", "key": "o_orderkey", "track": True}),
        ("invalid_enum", an.inject_choice, {"column": "o_orderstatus", "key": "o_orderkey", "values": BAD_STATUS, "track": True}),
        ("out_of_range", an.inject_constant, {"column": "o_totalprice", "key": "o_orderkey", "value": -1.0, "track": True}),
        ("future_date", an.inject_future_date, {"column": "o_orderdate", "key": "o_orderkey", "as_of": DETECT_AS_OF, "max_days": 365, "track": True}),
        ("no_such_kind", an.inject_null, {"column": "o_orderpriority", "key": "o_orderkey", "track": True}),
    ]
    return an.inject_anomalies(o, steps)


def an_framework(spark, sf):
    return an.drop_marks(injected_orders(spark, sf)).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


def an_report(spark, sf):
    return an.injection_report(injected_orders(spark, sf))


DETECT_RULES = [
    Rule("cust_not_null", "o_custkey", "not_null", "critical"),
    Rule("status_valid", "o_orderstatus", "accepted_values", "error", {"values": ["F", "O", "P"]}),
    Rule("price_min", "o_totalprice", "range", "warning", {"min": 0}),
    Rule("date_not_future", "o_orderdate", "not_future_date", "error"),
]
DETECT_MARKS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def _detection(df: DataFrame, pairs, as_of=None) -> DataFrame:
    """(rule_name, injected, detected, both) for (rule, mark) pairs on a tracked frame, in one aggregation."""
    kinds, aggs = dict(df.dtypes), []
    for i, (r, m) in enumerate(pairs):
        inj, det = F.col(an.MARK_PREFIX + m), fail_condition(r, as_of, kinds[r.column])
        aggs += [F.count_if(inj).alias(f"i{i}"), F.count_if(det).alias(f"d{i}"), F.count_if(inj & det).alias(f"b{i}")]
    rows = F.array(*[F.struct(F.lit(r.rule_name).alias("rule_name"), F.col(f"i{i}").alias("injected"), F.col(f"d{i}").alias("detected"), F.col(f"b{i}").alias("both")) for i, (r, _) in enumerate(pairs)])
    return df.agg(*aggs).select(F.inline(rows))


def an_detect(spark, sf):
    return _detection(injected_orders(spark, sf), list(zip(DETECT_RULES, DETECT_MARKS)), DETECT_AS_OF)


def an_detect_formats(spark, sf):
    """Bad dates, truncated lines, sizes out of range on both sides, negative amounts and malformed names, each met by its rule."""
    dates = an.inject_choice(
        table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("raw_date")), "raw_date", 0.02, "o_orderkey", BAD_DATES, kind="format_error", track=True
    )
    lines = an.inject_truncate(customer_lines(spark, sf), "value", 0.02, "c_custkey", 30, 70, track=True).withColumn("line_length", F.length("value"))
    sizes = an.inject_two_sided(table(spark, sf, "part"), "p_size", 0.03, "p_partkey", 0, 999, track=True)
    cents = customer_cents(spark, sf).withColumn("balance_cents", F.abs("balance_cents"))
    cents = an.inject_negative(cents, "balance_cents", 0.03, "c_custkey", track=True)
    names = an.inject_choice(table(spark, sf, "customer"), "c_name", 0.05, "c_custkey", BAD_NAMES, kind="format_error", track=True)
    found = [
        _detection(dates, [(Rule("date_format", "raw_date", "date_format", params={"format": "yyyyMMdd"}), "raw_date")]),
        _detection(lines, [(Rule("exact_length", "line_length", "exact_length", params={"length": 80}), "value")]),
        _detection(sizes, [(Rule("range_both", "p_size", "range", params={"min": 1, "max": 50}), "p_size")]),
        _detection(cents, [(Rule("range_negative", "balance_cents", "range", params={"min": 0}), "balance_cents")]),
        _detection(names, [(Rule("regex", "c_name", "regex", params={"pattern": "^Customer#[0-9]{9}$"}), "c_name")]),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def an_detect_duplicates(spark, sf):
    """Customers that took another's name: as many rows fail ``unique`` as names were taken."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("dup_key"))
    d = an.inject_duplicates(c, "dup_key", 0.02, "c_custkey", donors=50, track=True)
    a = check(d, [Rule("name_unique", "dup_key", "unique", order_by=("c_custkey",))])
    return a.agg(F.count_if(F.col(an.MARK_PREFIX + "dup_key")).alias("injected"), F.count_if(~F.col(PASSED)).alias("detected"))


# ---------------------------------------------------------------------------
# Sources, sinks and streams (write to the shared scratch folder first)
# ---------------------------------------------------------------------------


def src_batch_lookup(spark, sf):
    path = scratch_path(spark, "orders_csv")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"))
    write_delimited(o, path, delimiter="|")
    back = read_delimited(spark, path, [{"name": "o_orderkey"}, {"name": "o_custkey"}], {"header": "true", "delimiter": "|"}, lineage=False)
    return back.where(F.col("o_custkey").isNotNull()).select("o_custkey").distinct()


def src_comments(spark, sf):
    path = scratch_path(spark, "region_commented")
    r = with_comments(table(spark, sf, "region"), {"r_regionkey": "Region key", "r_name": "Region name"})
    write_table(r, path)
    back = spark.read.parquet(path)
    comments = {f.name: f.metadata.get("comment", "") for f in back.schema.fields}
    return back.select("r_regionkey", "r_name", F.lit(comments["r_regionkey"]).alias("key_comment"), F.lit(comments["r_name"]).alias("name_comment"))


CUSTOMER_CSV_COLUMNS = [{"name": n, "type": "string"} for n in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]


def land_customer_csv(spark, sf, path: str) -> str:
    c = table(spark, sf, "customer").select(*[F.col(x["name"]).cast("string").alias(x["name"]) for x in CUSTOMER_CSV_COLUMNS])
    return write_delimited(c, path, delimiter="|")


def src_delimited(spark, sf):
    land = land_customer_csv(spark, sf, scratch_path(spark, "customer_csv"))
    target, ckpt = scratch_path(spark, "bronze_customer"), scratch_path(spark, "ckpt")
    stream = read_delimited(spark, land, CUSTOMER_CSV_COLUMNS, {"header": "true", "delimiter": "|"}, stream=True)
    run_available_now(stream, target, ckpt)
    back = spark.read.parquet(target)
    return back.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", F.col("_source_file").isNotNull().alias("has_lineage"))


def src_fixed_width(spark, sf, truncate: bool = False):
    land = scratch_path(spark, "customer_fw")
    customer_lines(spark, sf, truncate).select("value").write.mode("overwrite").text(land)
    target, ckpt = scratch_path(spark, "bronze_fw"), scratch_path(spark, "ckpt")
    run_available_now(read_fixed_width(spark, land, CUSTOMER_FIELDS, stream=True), target, ckpt)
    back = spark.read.parquet(target)
    return back.select("cust_id", "cust_name", "nation", "balance_cents", "segment", "record_type", "_line_length")


def src_fixed_width_truncated(spark, sf):
    return src_fixed_width(spark, sf, truncate=True)


def damaged_customer_lines(spark, sf) -> DataFrame:
    """The customer feed as pipe-delimited lines, some with a missing field, some with two more, some with an open quote."""
    line = "concat_ws('|', c_custkey, {}, c_nationkey, c_acctbal, {})"
    k = F.col("c_custkey")
    hit = F.when(k % 11 == 3, F.expr("concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal)"))
    hit = hit.when(k % 11 == 5, F.expr(line.format("c_name", "concat(c_mktsegment, '|x|\"y|z\"')")))
    hit = hit.when(k % 11 == 7, F.expr(line.format("concat('\"', c_name)", "c_mktsegment"))).otherwise(F.expr(line.format("c_name", "c_mktsegment")))
    return table(spark, sf, "customer").select(hit.alias("value"))


def src_rescued_rows(spark, sf):
    """A damaged customer feed through bronze: every line is kept, and malformed ones are told apart with their surplus fields."""
    contract, land, base = shipped.load("customer"), scratch_path(spark, "customer_landing"), scratch_path(spark, "lake")
    damaged_customer_lines(spark, sf).write.text(land)
    contract = contract | {"source": contract["source"] | {"rescue": True, "options": {"delimiter": "|", "header": "false"}}}
    run_bronze(spark, contract, f"{base}/bronze", f"{base}/_ckpt", path=land)
    rows = read_bronze(spark, contract, f"{base}/bronze", land).withColumn("kind", F.coalesce(RESCUED_KIND, F.lit("sound")))
    return rows.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("c_custkey").try_cast("long")).alias("keys"), F.count("c_mktsegment").alias("segments"),
        F.min(F.array_join(RESCUED_FIELDS, ",")).alias("surplus"), F.count(RESCUED_LINE).alias("lines_kept"),
    )


def src_fixed_width_bytes(spark, sf):
    """Lines laid out in bytes of ISO-8859-1 and of UTF-8, with accents before the other fields: both parse alike."""
    c = table(spark, sf, "customer").select("c_custkey", F.translate("c_mktsegment", "AEO", "ÀÉÖ").alias("segment"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    out = None
    for charset in ("ISO-8859-1", "UTF-8"):
        encoded = F.encode("segment", charset)
        padded = F.substring(F.concat(encoded, F.encode(F.lit(" " * 20), charset)), 1, 20)
        line = F.concat(padded, F.encode(F.format_string("%012d", "c_custkey"), charset), F.encode(F.format_string("%012d", "cents"), charset))
        land = scratch_path(spark, "bytes_landing")
        c.select(line.cast("string").alias("value")).write.text(land)
        fields = [{"name": "segment", "start": 1, "length": 20, "trim": True}, {"name": "c_custkey", "start": 21, "length": 12, "cast": "bigint"}, {"name": "cents", "start": 33, "length": 12, "cast": "bigint"}]
        got = read_fixed_width(spark, land, fields, lineage=False, charset=charset)
        got = got.groupBy("segment").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents"), F.sum("c_custkey").alias("keys"), F.max("_line_length").alias("line_bytes"))
        got = got.withColumn("charset", F.lit(charset))
        out = got if out is None else out.unionByName(got)
    return out


def _contract_docs() -> dict:
    return {"orders": shipped.load("orders"), "events": shipped.load("events")}


def src_contracts(spark, sf):
    """Rules read from contract files drive the checks on the tables."""
    path = scratch_path(spark, "contracts")
    ct.write_contracts(spark, _contract_docs(), path)
    docs = ct.read_contracts(spark, path, ct.WRITTEN_GLOB, recursive=True)
    rules_df = ct.rules_table(docs)
    outs = []
    for name in ("orders", "events"):
        rules = ct.collect_rules(rules_df, name)
        r = measure_rules(table(spark, sf, name), rules, dataset=name, run_id="c1", run_ts=RUN_TS, as_of=AS_OF, samples=False)
        outs.append(r.select("dataset_name", "rule_name", "rule_type", "severity", "fail_count"))
    return outs[0].unionByName(outs[1])


def bronze_silver_e2e(spark, sf):
    CUSTOMER_CONTRACT = shipped.load("customer")
    land = land_customer_csv(spark, sf, scratch_path(spark, "customer_landing"))
    base = scratch_path(spark, "lake")
    run_bronze(spark, CUSTOMER_CONTRACT, f"{base}/bronze_customer", f"{base}/_ckpt_bronze", path=land)
    bronze = read_bronze(spark, CUSTOMER_CONTRACT, f"{base}/bronze_customer", land)
    out = run_silver(spark, bronze, CUSTOMER_CONTRACT, base, run_id="e2e", run_ts=RUN_TS, as_of=AS_OF)
    return out.clean.select("c_custkey", "c_acctbal", "c_mktsegment", "c_name")


def bronze_fixed_width_e2e(spark, sf):
    """Fixed-width contract end to end: coded + truncated lines -> text stream -> bronze -> silver clean rows."""
    contract = shipped.load("customer_fw")
    c = an.inject_choice(customer_cents(spark, sf), "c_mktsegment", 0.03, "c_custkey", BAD_SEGMENTS, kind="out_of_range")
    lines = an.inject_truncate(c.select("c_custkey", fixed_width_line(CUSTOMER_LAYOUT).alias("value")), "value", 0.02, "c_custkey", 30, 70)
    land, base = scratch_path(spark, "customer_fw_landing"), scratch_path(spark, "lake_fw")
    lines.select("value").write.mode("overwrite").text(land)
    run_bronze(spark, contract, f"{base}/bronze", f"{base}/_ckpt_bronze", path=land)
    bronze = read_bronze(spark, contract, f"{base}/bronze", land)
    out = run_silver(spark, bronze, contract, base, run_id="fw", run_ts=RUN_TS, as_of=AS_OF)
    return out.clean.select("cust_key", "cust_name", "segment", "balance_dollars")


def refine_contracts_e2e(spark, sf):
    """A folder of contracts (delimited + fixed-width) refined under one run id; per-rule results."""
    root, base, cpath = scratch_path(spark, "landing"), scratch_path(spark, "lake_all"), scratch_path(spark, "contracts")
    land_customer_csv(spark, sf, f"{root}/customer")
    c = an.inject_choice(customer_cents(spark, sf), "c_mktsegment", 0.03, "c_custkey", BAD_SEGMENTS, kind="out_of_range")
    lines = an.inject_truncate(c.select("c_custkey", fixed_width_line(CUSTOMER_LAYOUT).alias("value")), "value", 0.02, "c_custkey", 30, 70)
    lines.select("value").write.mode("overwrite").text(f"{root}/customer_fw")
    ct.write_contracts(spark, {"customer": shipped.load("customer"), "customer_fw": shipped.load("customer_fw")}, cpath)
    res = refine_all(spark, cpath, root, base, run_id="all-1", run_ts=RUN_TS, as_of=AS_OF, glob=ct.WRITTEN_GLOB, recursive=True)
    return res.select("dataset_name", "rule_name", "rule_type", "severity", "fail_count")


def dq_report_history(spark, sf):
    """Results written as run partitions, read back through the history scan, rolled up."""
    path = scratch_path(spark, "dq_results_history")
    write_results(events_results_by_day(spark, sf).withColumn("sample_failures", F.array().cast("array<string>")), path)
    return marts.rule_health(read_results_history(spark, path), ordered=False).select(
        "dataset_name", "rule_name", "severity", "latest_run_fail_pct", "total_runs_checked", "runs_with_failures", "max_fail_pct_ever", "status_flag", "severity_rank"
    )


def _expectation_rows(spark, target: str, ckpt: str) -> DataFrame:
    counts, kept = counted(spark, target, ckpt), spark.read.parquet(target).count()
    rows = [(name, counts.get(name, 0), kept) for name in expectations(EVENT_RULES)]
    return spark.createDataFrame(rows, "rule_name string, failed_records long, rows_kept long")


def st_expectations(spark, sf):
    """Monitor-mode expectations on a stream: counted per batch, no row dropped."""
    target, ckpt = scratch_path(spark, "st_exp"), scratch_path(spark, "ckpt")
    run_available_now(st_events_stream(spark, sf), target, ckpt, counters=expectations(EVENT_RULES))
    return _expectation_rows(spark, target, ckpt)


def st_expectations_many_batches(spark, sf):
    """The same over more batches than a query keeps progress reports for: the counts stay exact."""
    land, target, ckpt = (scratch_path(spark, n) for n in ("st_many", "st_exp", "ckpt"))
    events_feed(spark, sf).repartition(12, "event_id").write.parquet(land)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream = spark.readStream.schema(table(spark, sf, "events").schema).option("maxFilesPerTrigger", 1).parquet(land)
        run_available_now(stream, target, ckpt, counters=expectations(EVENT_RULES))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    return _expectation_rows(spark, target, ckpt)


def st_events_stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def st_ingest(spark, sf):
    target, ckpt = scratch_path(spark, "st_events"), scratch_path(spark, "ckpt")
    run_available_now(st_events_stream(spark, sf), target, ckpt)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type")


def _counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_distinct"))


def st_rerun(spark, sf):
    target, ckpt = scratch_path(spark, "st_events"), scratch_path(spark, "ckpt")
    run_available_now(st_events_stream(spark, sf), target, ckpt)
    run_available_now(st_events_stream(spark, sf), target, ckpt)  # same checkpoint: no new files, no new rows
    return _counts(spark.read.parquet(target))


def st_full_refresh(spark, sf):
    target = scratch_path(spark, "st_events")
    run_available_now(st_events_stream(spark, sf), target, scratch_path(spark, "ckpt"))
    run_available_now(st_events_stream(spark, sf), target, scratch_path(spark, "ckpt"), full_refresh=True)
    return _counts(spark.read.parquet(target))


def st_full_refresh_same_checkpoint(spark, sf):
    target, ckpt = scratch_path(spark, "st_events"), scratch_path(spark, "ckpt")
    for refresh in (False, True):
        run_available_now(st_events_stream(spark, sf), target, ckpt, full_refresh=refresh)
    return _counts(spark.read.parquet(target))


def st_two_checkpoints(spark, sf):
    """Two feeds with checkpoints of their own fill one table; neither replaces the other's batches."""
    target = scratch_path(spark, "st_events")
    for _ in range(2):
        run_available_now(st_events_stream(spark, sf), target, scratch_path(spark, "ckpt"))
    return _counts(spark.read.parquet(target))


def st_foreach_batch_dq(spark, sf):
    """All rules per micro-batch, ``unique`` against earlier batches too: a second delivery repeats every seventh event."""
    land, good, bad, ckpt = (scratch_path(spark, n) for n in ("st_land", "st_clean", "st_quarantine", "ckpt"))
    events = table(spark, sf, "events")

    def route(annotated: DataFrame, batch_id: int) -> None:
        stream = stream_id(annotated.sparkSession, ckpt)
        for part, path in ((clean(annotated), good), (quarantine(annotated), bad)):
            write_batch(part, path, stream, batch_id)

    for delivery in (events, events.where("event_id % 7 = 0")):
        delivery.write.mode("append").parquet(land)
        run_checked(spark.readStream.schema(events.schema).parquet(land), EVENT_RULES, route, ckpt)
    g = spark.read.parquet(good).select(F.lit("clean").alias("route"), "event_id")
    b = spark.read.parquet(bad).select(F.lit("quarantine").alias("route"), "event_id")
    return g.unionByName(b).groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"))


def _customer_run(spark, *feeds: DataFrame) -> DataFrame:
    """Feeds landed one after the other, through the shipped contract: rows that pass and rows that fail ``unique``."""
    contract, land, base = shipped.load("customer"), scratch_path(spark, "customer_landing"), scratch_path(spark, "lake")
    for feed in feeds:
        write_delimited(feed, land, delimiter="|", mode="append")
    run_bronze(spark, contract, f"{base}/bronze", f"{base}/_ckpt", path=land)
    out = run_silver(spark, read_bronze(spark, contract, f"{base}/bronze", land), contract, base, run_id="u", run_ts=RUN_TS, as_of=AS_OF)
    failed_rows = out.results.where("rule_name = 'custkey_unique'").select("fail_count")
    return failed_rows.withColumn("clean_keys", F.lit(out.clean.select("c_custkey").distinct().count())).withColumn("clean_rows", F.lit(out.clean.count()))


def _customer_strings(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(*[F.col(x["name"]).cast("string").alias(x["name"]) for x in CUSTOMER_CSV_COLUMNS])


def dq_unique_repeated_line(spark, sf):
    """Every fifth customer stands twice in one landed feed."""
    c = _customer_strings(spark, sf)
    return _customer_run(spark, c.unionAll(c.where("c_custkey % 5 = 0")))


def dq_unique_redelivered(spark, sf):
    """The customer feed is delivered twice."""
    c = _customer_strings(spark, sf)
    return _customer_run(spark, c, c)


def silver_table_clean(spark, sf):
    """The silver table on disk holds the rows that pass, and nothing else."""
    base = scratch_path(spark, "lake")
    contract = {"dataset": {"name": "orders"}, "silver": {"table_name": "silver_orders"}}
    run_silver(spark, orders_feed(spark, sf), contract, base, rules=ORDER_RULES, run_id="c", run_ts=RUN_TS, as_of=AS_OF)
    return read_published(spark, f"{base}/silver_orders").select("o_orderkey", "o_orderstatus")


def q_rerun_repaired(spark, sf):
    """A run on bad rows, then the same run on repaired ones: nothing of the first attempt is left."""
    base = scratch_path(spark, "rerun")
    contract = {"dataset": {"name": "orders"}, "silver": {"table_name": "silver_orders"}}
    repaired = orders_feed(spark, sf).where("o_custkey IS NOT NULL")
    for feed in (orders_feed(spark, sf), repaired):
        run_silver(spark, feed, contract, base, rules=ORDER_RULES[:1], run_id="same-run", run_ts=RUN_TS, as_of=AS_OF)
    left = spark.read.schema("o_orderkey long, run_id string").parquet(f"{base}/orders_quarantine").where("run_id = 'same-run'")
    res = read_results_history(spark, f"{base}/dq_results")
    silver = read_published(spark, f"{base}/silver_orders").count()
    return res.select("rule_name", "total_count", "fail_count", F.lit(left.count()).alias("quarantined"), F.lit(silver).alias("silver_rows"))


def src_contract_lint(spark, sf):
    """Problems of contracts about the given tables, with the tables' own columns; and the rows of each table."""
    path = scratch_path(spark, "contracts")
    bad = shipped.load("orders") | {"dataset": {"name": "lineitem", "columns": []}}
    rule = lambda name, column, kind, **params: {"rule_name": name, "column": column, "rule_type": kind, "severity": "error", "params": params}
    bad["quality"] = [
        rule("a", "l_nothing", "not_null"), rule("b", "l_tax", "checksum"), rule("c", "l_tax", "range"), rule("c", "l_tax", "range", min=2, max=1),
        rule("d", "l_shipmode", "accepted_values"), rule("e", "l_quantity", "range", min=0),
    ]
    ct.write_contracts(spark, _contract_docs() | {"lineitem": bad}, path)
    names = ("orders", "events", "lineitem")
    columns = spark.createDataFrame([(t, c) for t in names for c in table(spark, sf, t).columns], "dataset_name string, column string")
    found = ct.lint(ct.read_contracts(spark, path, ct.WRITTEN_GLOB, recursive=True), columns)
    return found.select("rule_index", "problem", F.lit(table(spark, sf, "lineitem").count()).alias("rows_in_table"))


def src_lint_derived(spark, sf):
    """A contract whose rules are profiled from the returned lines is linted; the rules without problems are measured over all lines."""
    lines = table(spark, sf, "lineitem")
    numbers, codes = ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), ("l_returnflag", "l_linestatus")
    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in (*numbers, *codes) for f in (F.min, F.max)]
    p = lines.where("l_returnflag = 'R'").agg(*bounds, *[F.sort_array(F.collect_set(c)).alias(f"set_{c}") for c in codes]).first()
    rule = lambda name, column, kind, **params: {"rule_name": name, "column": column, "rule_type": kind, "severity": "error", "params": params}
    quality = [rule(f"{c}_range", c, "range", min=p[f"min_{c}"], max=p[f"max_{c}"]) for c in (*numbers, *codes)]
    quality += [rule(f"{c}_known", c, "accepted_values", values=p[f"set_{c}"]) for c in codes] + [rule("l_colour_known", "l_colour", "not_null")]
    path = scratch_path(spark, "contracts")
    ct.write_contracts(spark, {"lineitem": shipped.load("orders") | {"dataset": {"name": "lineitem", "columns": []}, "quality": quality}}, path)
    docs = ct.read_contracts(spark, path, ct.WRITTEN_GLOB, recursive=True)
    columns = spark.createDataFrame([("lineitem", c) for c in lines.columns], "dataset_name string, column string")
    named = ct.rules_table(docs).select("rule_index", "rule_name")
    problems = ct.lint(docs, columns).where("rule_index IS NOT NULL").join(named, "rule_index").select("rule_name", "problem")
    sound = [r.rule_name for r in named.join(problems, "rule_name", "left_anti").collect()]  # rules of one contract
    rules = [r for r in ct.collect_rules(ct.rules_table(docs)) if r.rule_name in sound]
    results = measure_rules(lines, rules, dataset="lineitem", run_id="lint", run_ts=RUN_TS, samples=False)
    measured = results.select("rule_name", F.lit("").alias("problem"), "total_count", "fail_count")
    none = F.lit(None).cast("long")
    return measured.unionByName(problems.withColumns({"total_count": none, "fail_count": none}))


# ---------------------------------------------------------------------------
# Gold from silver: contract -> landed files -> bronze -> silver -> mart table
# ---------------------------------------------------------------------------


def _contract(name: str, columns, transforms, quality) -> dict:
    return {
        "apiVersion": "v3.0.0", "kind": "DataContract", "id": f"urn:datacontract:{name}",
        "dataset": {"name": name, "columns": [{"name": c, "type": "string", "description": c.replace("_", " ")} for c in columns]},
        "source": {"path": name, "format": "csv", "options": {"header": "true"}},
        "silver": {"table_name": f"silver_{name}", "transforms": [{"column": c, "expr": e} for c, e in transforms.items()]},
        "quality": [dict(zip(("rule_name", "column", "rule_type", "severity", "params"), q)) for q in quality],
    }


def _to_silver(spark, feeds: dict[str, tuple[dict, DataFrame]]) -> str:
    """Land the feeds, refine their contracts in one run; returns the lake's base path."""
    root, base, cpath = scratch_path(spark, "landing"), scratch_path(spark, "lake"), scratch_path(spark, "contracts")
    for name, (contract, feed) in feeds.items():
        write_delimited(feed.select(*[F.col(c["name"]).cast("string").alias(c["name"]) for c in contract["dataset"]["columns"]]), f"{root}/{name}")
    ct.write_contracts(spark, {name: contract for name, (contract, _) in feeds.items()}, cpath)
    refine_all(spark, cpath, root, base, run_id="gold", run_ts=RUN_TS, as_of=MART_AS_OF, glob=ct.WRITTEN_GLOB, recursive=True)
    return base


def _publish(spark, df: DataFrame, name: str, comment: str) -> DataFrame:
    """Save a mart as a catalog table with comment and properties, and read it back."""
    path = scratch_path(spark, name)
    return spark.read.table(publish_table(df, f"{name}_{path[-12:]}", path, comment, {"layer": "gold", "quality": "checked"}))


MONEY = "CAST({} AS DECIMAL(18, 2))"


def _advisor_lake(spark, sf) -> str:
    clients = _contract(
        "clients", ("client_id", "advisor_id", "account_type", "region", "risk_rating", "aum"),
        {"risk_rating": "CAST(risk_rating AS INT)", "aum": MONEY.format("aum")},
        [("client_known", "client_id", "not_null", "critical", {}), ("aum_range", "aum", "range", "error", {"min": 20000})],
    )
    apps = _contract(
        "apps", ("app_id", "advisor_id", "status", "credit_score"), {"credit_score": MONEY.format("credit_score")},
        [("status_known", "status", "accepted_values", "error", {"values": ["CLICK", "PURCHASE", "VIEW"]})],
    )
    return _to_silver(spark, {"clients": (clients, mart_clients(spark, sf)), "apps": (apps, mart_apps(spark, sf))})


def gold_advisors(spark, sf):
    base = _advisor_lake(spark, sf)
    mart = marts.advisor_portfolio(read_published(spark, f"{base}/silver_clients"), read_published(spark, f"{base}/silver_apps"), approved="PURCHASE")
    return _advisor_columns(_publish(spark, mart, "advisors", "Clients and applications by advisor"))


def gold_snapshot(spark, sf):
    clients, accounts = snapshot_sides(spark, sf)
    c = _contract(
        "clients", clients.columns, {"risk_rating": "CAST(risk_rating AS INT)", "aum": "CAST(aum AS DOUBLE)"},
        [("aum_positive", "aum", "range", "error", {"min": 0})],
    )
    a = _contract(
        "accounts", accounts.columns, {"account_number": "CAST(account_number AS BIGINT)", "balance_dollars": "CAST(balance_dollars AS DOUBLE)", "open_date": "CAST(open_date AS DATE)"},
        [("state_format", "state_code", "regex", "error", {"pattern": "^[12345]-.*"})],
    )
    base = _to_silver(spark, {"clients": (c, clients), "accounts": (a, accounts)})
    sides = [read_published(spark, f"{base}/silver_{n}") for n in ("clients", "accounts")]
    snap = marts.balance_snapshot(*sides, as_of=MART_AS_OF, active_status="F", prefix_start=10, prefix_len=9)
    return _snapshot_columns(_publish(spark, snap, "snapshot", "Active accounts of clients"))


def gold_health(spark, sf):
    """The rule-health mart over the results that refining wrote, in report order (shown as a position)."""
    results = read_results_history(spark, f"{_advisor_lake(spark, sf)}/dq_results")
    ranked = marts.rule_health(results, ordered=False).withColumn("position", marts.report_position())
    out = _publish(spark, ranked, "health", "Rule health over all runs")
    return out.select("position", "dataset_name", "rule_name", "severity", "latest_run_fail_pct", "status_flag")


def gold_health_incremental(spark, sf):
    """Rule health from a state that takes in the runs batch by batch, the last one twice; no batch reads another's results."""
    path, stored = scratch_path(spark, "health"), scratch_path(spark, "dq_results")
    write_results(events_results_by_day(spark, sf).withColumn("sample_failures", F.array().cast("array<string>")), stored)
    results = read_results_history(spark, stored)
    first, last = results.agg(F.min("run_timestamp"), F.max("run_timestamp")).first()
    cuts = [first + (last - first) * k / 3 for k in (1, 2)]
    t = F.col("run_timestamp")
    for batch in (t < cuts[0], (t >= cuts[0]) & (t < cuts[1]), t >= cuts[1], t >= cuts[1]):
        update_health(spark, path, results.where(batch))
    return health_report(read_health(spark, path))


def gold_table_facts(spark, sf):
    """Comment and properties of a mart's catalog table, and its rows."""
    path = scratch_path(spark, "regions")
    per = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))
    name = save_table(per, f"regions_{path[-12:]}", path, "Nations by region, it's small", {"layer": "gold"})
    return table_facts(spark, name).where("property IN ('comment', 'layer')").withColumn("n_rows", F.lit(spark.read.table(name).count()))


def lake_table_facts(spark, sf):
    """Comment, properties and rows of the catalog tables of bronze, silver and results, and the column comments of bronze."""
    contract, land, base = shipped.load("customer"), land_customer_csv(spark, sf, scratch_path(spark, "customer_landing")), scratch_path(spark, "lake")
    names = {layer: f"{layer}_{base[-12:]}" for layer in ("bronze", "silver", "results")}
    for _ in range(2):  # the second run moves the silver table to its new version
        run_bronze(spark, contract, f"{base}/bronze", f"{base}/_ckpt", path=land, table=names["bronze"])
        run_silver(spark, read_bronze(spark, contract, f"{base}/bronze", land), contract, base, run_id="facts", run_ts=RUN_TS, as_of=AS_OF, tables=names)
    facts = None
    for layer, name in names.items():
        said = table_facts(spark, name).where("property IN ('comment', 'quality')")
        if layer == "bronze":
            said = said.unionByName(spark.createDataFrame(column_comments(spark.table(name).select("c_custkey", "c_name")), "property string, value string"))
        said = said.select(F.lit(layer).alias("layer"), "property", "value", F.lit(spark.table(name).count()).alias("n_rows"))
        facts = said if facts is None else facts.unionByName(said)
    return facts


def pub_old_version_kept(spark, sf):
    """Orders by status are published; a publish whose last row breaks leaves them; a repaired one replaces them."""
    path, o = scratch_path(spark, "published"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    steps = []

    def note(step: str) -> None:
        steps.append(read_published(spark, path).select(F.lit(step).alias("step"), "o_orderstatus"))

    publish(o.where("o_orderstatus = 'F'"), path)
    note("first")
    last = o.agg(F.max("o_orderkey")).first()[0]
    broken = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("broken row"))).otherwise(F.col("o_orderstatus")))
    try:
        publish(broken, path)
    except SparkRuntimeException:
        note("after a failed write")
    publish(o, path)
    note("repaired")
    kept = len(versions(spark, path))  # the current one and the one before
    return reduce(DataFrame.unionByName, steps).groupBy("step", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("versions", F.lit(kept))


def st_refresh_switches(spark, sf):
    """A full refresh that fails leaves the ingested table; the next one replaces it by the refreshed rows."""
    path, schema = scratch_path(spark, "st_versions"), table(spark, sf, "events").schema
    stream = st_events_stream(spark, sf)
    run_versioned(stream.where("event_id % 2 = 0"), path)
    run_versioned(stream.where("event_id % 2 = 0"), path)  # nothing new
    out = [_counts(read_versioned(spark, path, schema)).withColumn("step", F.lit("ingested"))]
    try:
        run_versioned(stream.where(F.when(F.col("event_id") > 0, F.raise_error(F.lit("broken file"))).otherwise(F.lit(True))), path, full_refresh=True)
    except StreamingQueryException:
        out.append(_counts(read_versioned(spark, path, schema)).withColumn("step", F.lit("after a failed refresh")))
    run_versioned(stream, path, full_refresh=True)
    out.append(_counts(read_versioned(spark, path, schema)).withColumn("step", F.lit("refreshed")))
    return reduce(DataFrame.unionByName, out)


def q_rerun_safe(spark, sf):
    base = scratch_path(spark, "rerun")
    o = orders_feed(spark, sf)
    contract = {"dataset": {"name": "orders"}, "silver": {"table_name": "silver_orders", "transforms": []}}
    for _ in range(2):
        run_silver(spark, o, contract, base, rules=ORDER_RULES, run_id="same-run", run_ts=RUN_TS, as_of=AS_OF)
    res = spark.read.parquet(f"{base}/dq_results").where(F.col("run_id") == "same-run")
    qua = spark.read.parquet(f"{base}/orders_quarantine").where(F.col("run_id") == "same-run")
    return res.select(F.lit("dq_results").alias("table_name")).unionByName(qua.select(F.lit("quarantine").alias("table_name"))).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


NAMES = """
dq_not_null dq_accepted_values dq_range dq_range_open dq_regex dq_not_future_date dq_date_format
dq_exact_length dq_unique dq_unique_text sc_functions dq_annotate dq_metrics dq_samples dq_clean
dq_quarantine dq_severity_totals dq_critical_gate dq_expectations dq_report dq_embedding_first
dq_labels dq_roles dq_urls tr_cast tr_date tr_date_fmt tr_ts_fmt tr_expr tr_derived tr_ordered
tr_json_expr tr_band tr_ratio tr_age tr_pass_all tr_stamp tr_prefix jn_left_fanout jn_prefix_inner
ag_conditional ag_having ag_distinct an_null an_duplicate an_enum an_constant an_future an_choice_int
an_malformed an_two_sided an_status an_truncate an_fixed_code an_negative an_bad_date an_reuse
an_framework an_report an_detect src_batch_lookup src_comments src_delimited src_fixed_width
src_fixed_width_truncated src_contracts bronze_silver_e2e st_ingest st_rerun st_full_refresh
st_foreach_batch_dq q_rerun_safe dq_lineitem_rules dq_unique_hot bronze_fixed_width_e2e dq_report_history
st_expectations dq_summary_lines refine_contracts_e2e dq_unique_default dq_unique_ties dq_unique_null_tie
dq_unique_repeated_line dq_unique_redelivered st_two_checkpoints st_full_refresh_same_checkpoint
st_expectations_many_batches src_contract_lint q_rerun_repaired silver_table_clean gold_advisors
gold_snapshot gold_health gold_table_facts an_reuse_prefix an_detect_formats an_detect_duplicates
lake_table_facts pub_old_version_kept st_refresh_switches dq_values_from dq_values_from_text src_lint_derived
src_rescued_rows src_fixed_width_bytes gold_health_incremental jn_prefix_heavy an_reuse_spread
""".split()

QUERIES: dict[str, Query] = {name: globals()[name] for name in NAMES}
