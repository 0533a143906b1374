"""Data tests, contracts, freshness, audit, reconciliation, expectations,
activation, appends and the streamed medallion - registered queries.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY
from ledgerloom.operators.activation import render_message, sync
from ledgerloom.operators.contracts import contract_diff, enforce_contract
from ledgerloom.operators.expectations import (
    Expectation, apply_expectations, enforce, expectation_report,
)
from ledgerloom.operators.quality import (
    DataTest, FreshnessRule, diff_rows, facts_long, load_audit, reconcile, run_tests,
    source_freshness,
)
from ledgerloom.operators.sequence import append_batch, assign_ids
from ledgerloom.oracle import AS_OF, AS_OF_TS
from ledgerloom.plans.catalog import register
from ledgerloom.plans.contracts import CONTRACTS
from ledgerloom.plans.medallion import BRONZE, SILVER_EXPECTATIONS, SILVER_FNS
from ledgerloom.session import scratch_path
from ledgerloom.sources.datasets import Datasets, once, publish

H, D = _dt.timedelta(hours=1), _dt.timedelta(days=1)

# --- fixed values: schema tests ----------------------------------------------------
ORDER_STATUSES = ("placed", "shipped", "completed", "returned")
PAYMENT_STATUSES = ("success", "failed", "pending")
SEGMENTS = ("high_value", "mid_value", "low_value")
MARKETING_SEGMENTS = ("champion", "loyal", "at_risk", "lapsed", "never_purchased", "other")
ALERT_REASONS = ("high_value_open", "overdue_open")


def _nn_unique(model: str, col: str) -> list[DataTest]:
    return [DataTest(model, "not_null", col), DataTest(model, "unique", col)]


TESTS: list[DataTest] = [
    *_nn_unique("stg_customers", "customer_id"),
    DataTest("stg_customers", "not_null", "email"),
    DataTest("stg_customers", "not_null", "created_date"),
    *_nn_unique("stg_orders", "order_id"),
    DataTest("stg_orders", "not_null", "customer_id"),
    DataTest("stg_orders", "relationships", "customer_id", to="stg_customers",
             field="customer_id"),
    DataTest("stg_orders", "accepted_values", "status", ORDER_STATUSES),
    DataTest("stg_orders", "not_null", "amount"),
    *_nn_unique("stg_order_items", "order_item_id"),
    DataTest("stg_order_items", "not_null", "order_id"),
    DataTest("stg_order_items", "not_null", "quantity"),
    *_nn_unique("stg_products", "product_id"),
    DataTest("stg_products", "not_null", "unit_price"),
    *_nn_unique("stg_payments", "payment_id"),
    DataTest("stg_payments", "not_null", "order_id"),
    DataTest("stg_payments", "accepted_values", "payment_status", PAYMENT_STATUSES),
    *_nn_unique("stg_crm_accounts", "account_id"),
    *_nn_unique("stg_crm_contacts", "contact_id"),
    *_nn_unique("stg_crm_opportunities", "opportunity_id"),
    *_nn_unique("stg_crm_users", "user_id"),
    *_nn_unique("dim_customers", "customer_id"),
    DataTest("dim_customers", "not_null", "email"),
    DataTest("dim_customers", "accepted_values", "customer_segment", SEGMENTS),
    *_nn_unique("dim_products", "product_id"),
    DataTest("dim_products", "not_null", "product_name"),
    *_nn_unique("fct_orders", "order_id"),
    DataTest("fct_orders", "not_null", "customer_id"),
    DataTest("fct_orders", "relationships", "customer_id", to="dim_customers",
             field="customer_id"),
    DataTest("fct_orders", "not_null", "order_date"),
    DataTest("fct_orders", "accepted_values", "status", ORDER_STATUSES),
    DataTest("fct_orders", "not_null", "amount_paid"),
    *_nn_unique("dim_accounts", "account_id"),
    *_nn_unique("fct_opportunities", "opportunity_id"),
    DataTest("fct_opportunities", "relationships", "account_id", to="dim_accounts",
             field="account_id"),
    *_nn_unique("crm_opportunity_alerts", "opportunity_id"),
    DataTest("crm_opportunity_alerts", "accepted_values", "alert_reason", ALERT_REASONS),
    *_nn_unique("mart_customer_segments", "customer_id"),
    DataTest("mart_customer_segments", "accepted_values", "marketing_segment",
             MARKETING_SEGMENTS),
    *_nn_unique("mart_country_performance", "country"),
    *_nn_unique("fct_revenue", "order_id"),
    DataTest("fct_revenue", "not_null", "recognised_revenue"),
    *_nn_unique("fct_revenue_by_product", "product_id"),
    *_nn_unique("rfm_customer_features", "customer_id"),
    *_nn_unique("customer_churn_features", "customer_id"),
    DataTest("payment_method_affinity_pairs", "not_null", "method_a"),
    DataTest("payment_method_affinity_pairs", "not_null", "method_b"),
]

# models with about as many rows as a driver table
TEST_SIZES = {"stg_order_items": "lineitem",
              **dict.fromkeys(("stg_orders", "stg_payments", "stg_crm_opportunities", "fct_orders",
                               "fct_opportunities", "crm_opportunity_alerts", "fct_revenue"), "orders")}

# --- fixed values: source freshness (loaded-at field, warn after, error after) ------
FRESHNESS = [
    FreshnessRule("raw_customers", "_loaded_at", 1 * H, 6 * H),
    FreshnessRule("raw_orders", "_loaded_at", 1 * H, 6 * H),
    FreshnessRule("raw_order_items", "_loaded_at", 1 * H, 6 * H),
    FreshnessRule("raw_products", "_loaded_at", 3 * D, 7 * D),
    FreshnessRule("raw_payments", "_loaded_at", 1 * D, 2 * D),
    FreshnessRule("sf_account", "_fivetran_synced", 6 * H, 24 * H),
    FreshnessRule("sf_contact", "_fivetran_synced", 6 * H, 24 * H),
    FreshnessRule("sf_opportunity", "_fivetran_synced", 6 * H, 24 * H),
    FreshnessRule("sf_user", "_fivetran_synced", 1 * D, 3 * D),
]

# --- fixed values: column docs persisted with dim_customers -------------------------
DIM_CUSTOMERS_DOCS = {
    "customer_id": "Primary key. One row per customer.",
    "total_lifetime_value": "Sum of successful payments across all orders (USD).",
    "customer_segment": "high_value >= 500, mid_value >= 100, else low_value.",
}
ACTIVATION_SYNC_DAYS = 7
# ------------------------------------------------------------------------------------


def assert_positive_revenue(ds: Datasets) -> DataFrame:
    """Singular test (severity warn): completed orders with nothing paid."""
    _, model, condition = SINGULAR["assert_positive_revenue"]
    return ds[model].filter(condition).select("order_id", "status", "amount_paid")


SINGULAR = {"assert_positive_revenue": ("warn", "fct_orders",
                                        "status = 'completed' and amount_paid <= 0")}


# ------------------------------------------------------------------ oracle text ---

def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _test_sql(t: DataTest) -> str:
    head = (f"SELECT '{t.test_name}' AS test_name, '{t.model}' AS model, "
            f"'{t.column}' AS column_name, '{t.kind}' AS test_type, ")
    tail = f", '{t.severity}' AS severity"
    if t.kind == "not_null":
        return head + f"count(*) FILTER (WHERE {t.column} IS NULL) AS failures{tail} FROM {t.model}"
    if t.kind == "accepted_values":
        return head + (f"count(*) FILTER (WHERE {t.column} IS NOT NULL AND {t.column} NOT IN "
                       f"({_in(t.values)})) AS failures{tail} FROM {t.model}")
    if t.kind == "unique":
        return head + (f"(SELECT count(*) FROM (SELECT {t.column} FROM {t.model} "
                       f"WHERE {t.column} IS NOT NULL GROUP BY {t.column} "
                       f"HAVING count(*) > 1)) AS failures{tail}")
    if t.kind == "relationships":
        return head + (f"count(*) AS failures{tail} FROM {t.model} c WHERE c.{t.column} IS NOT NULL "
                       f"AND NOT EXISTS (SELECT 1 FROM {t.to} p WHERE p.{t.field} = c.{t.column})")
    raise ValueError(t.kind)


_RUN_TESTS_SQL = (
    "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
    "ELSE 'fail' END AS status FROM (\n"
    + "\nUNION ALL\n".join([_test_sql(t) for t in TESTS] + [
        "SELECT 'assert_positive_revenue', 'assert_positive_revenue', NULL, 'singular', "
        "count(*), 'warn' FROM fct_orders WHERE status = 'completed' AND amount_paid <= 0"])
    + ")")


@register("run_tests", _RUN_TESTS_SQL)
def run_tests_query(ds: Datasets) -> DataFrame:
    return run_tests(ds, TESTS, SINGULAR, TEST_SIZES)


@register("assert_positive_revenue", """
SELECT order_id, status, amount_paid FROM fct_orders
WHERE status = 'completed' AND amount_paid <= 0""")
def assert_positive_revenue_query(ds: Datasets) -> DataFrame:
    return assert_positive_revenue(ds)


@register("test_relationships", """
SELECT c.* FROM stg_order_items c
WHERE c.order_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_orders p WHERE p.order_id = c.order_id AND p.status <> 'placed')""")
def test_relationships(ds: Datasets) -> DataFrame:
    """Failing rows: items of orders that are not past 'placed' (no item lacks an order)."""
    from ledgerloom.operators.quality import relationships
    accepted = ds["stg_orders"].filter(F.col("status") != "placed")
    return relationships(ds["stg_order_items"], "order_id", accepted, "order_id")


@register("test_unique", """
SELECT order_id, count(*) AS n_records FROM stg_payments
WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1""")
def test_unique(ds: Datasets) -> DataFrame:
    """Failing rows of ``unique(stg_payments.order_id)``: orders with retries."""
    from ledgerloom.operators.quality import unique
    return unique(ds["stg_payments"], "order_id")


@register("test_accepted_values", """
SELECT * FROM stg_orders WHERE status IS NOT NULL AND status NOT IN ('placed', 'shipped', 'completed')""")
def test_accepted_values(ds: Datasets) -> DataFrame:
    """Failing rows of a deliberately narrow accepted set (returned is not allowed)."""
    from ledgerloom.operators.quality import accepted_values
    return accepted_values(ds["stg_orders"], "status", ("placed", "shipped", "completed"))


@register("test_not_null", """
SELECT * FROM dim_customers WHERE first_order_date IS NULL""")
def test_not_null(ds: Datasets) -> DataFrame:
    """Failing rows of ``not_null(dim_customers.first_order_date)``: no-order customers."""
    from ledgerloom.operators.quality import not_null
    return not_null(ds["dim_customers"], "first_order_date")


def _freshness_sql() -> str:
    parts = []
    for r in FRESHNESS:
        age = f"date_diff('second', max({r.loaded_at}), {AS_OF_TS})"
        w, e = int(r.warn_after.total_seconds()), int(r.error_after.total_seconds())
        parts.append(
            f"SELECT '{r.source}' AS source, max({r.loaded_at}) AS max_loaded_at, "
            f"{age} AS age_seconds, CASE WHEN max({r.loaded_at}) IS NULL THEN 'error' "
            f"WHEN {age} > {e} THEN 'error' WHEN {age} > {w} THEN 'warn' ELSE 'pass' END "
            f"AS status FROM {r.source}")
    return "\nUNION ALL\n".join(parts)


@register("source_freshness", _freshness_sql())
def source_freshness_query(ds: Datasets) -> DataFrame:
    now = _dt.datetime.combine(ds.as_of or _dt.date.today(), _dt.time())
    return source_freshness(ds, FRESHNESS, now)


_AUDITED = ("raw_customers", "raw_products", "raw_orders", "raw_order_items", "raw_payments",
            "raw_reviews")


@register("load_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, max(_loaded_at) AS last_loaded_at "
    f"FROM {t}" for t in _AUDITED))
def load_audit_query(ds: Datasets) -> DataFrame:
    return load_audit({t: ds[t] for t in _AUDITED})


_FACTS_SQL = """
WITH pay AS (SELECT order_id, sum(CASE WHEN lower(status) = 'success' THEN amount END) AS paid
             FROM raw_payments GROUP BY order_id),
raw AS (
  SELECT 'orders_total' AS fact, CAST(count(*) AS VARCHAR) AS value FROM raw_orders
  UNION ALL SELECT 'orders_' || s, CAST((SELECT count(*) FROM raw_orders
                                        WHERE lower(status) = s) AS VARCHAR)
            FROM (VALUES ('completed'), ('placed'), ('returned'), ('shipped')) v(s)
  UNION ALL SELECT 'recognised_revenue',
            CAST(CAST(coalesce(sum(p.paid), 0) AS DECIMAL(18,2)) AS VARCHAR)
            FROM raw_orders o JOIN pay p ON o.order_id = p.order_id
            WHERE lower(o.status) = 'completed'
  UNION ALL SELECT 'paid_all_statuses',
            CAST(CAST(coalesce(sum(p.paid), 0) AS DECIMAL(18,2)) AS VARCHAR)
            FROM raw_orders o JOIN pay p ON o.order_id = p.order_id
  UNION ALL SELECT 'customers_total', CAST(count(*) AS VARCHAR) FROM raw_customers),
mart AS (
  SELECT 'orders_total' AS fact, CAST(count(*) AS VARCHAR) AS value FROM fct_orders
  UNION ALL SELECT 'orders_' || s, CAST((SELECT count(*) FROM fct_orders WHERE status = s)
                                        AS VARCHAR)
            FROM (VALUES ('completed'), ('placed'), ('returned'), ('shipped')) v(s)
  UNION ALL SELECT 'recognised_revenue',
            CAST(CAST(coalesce(sum(amount_paid) FILTER (WHERE status = 'completed'), 0)
                 AS DECIMAL(18,2)) AS VARCHAR) FROM fct_orders
  UNION ALL SELECT 'paid_all_statuses',
            CAST(CAST(coalesce(sum(amount_paid), 0) AS DECIMAL(18,2)) AS VARCHAR) FROM fct_orders
  UNION ALL SELECT 'customers_total', CAST(count(*) AS VARCHAR) FROM dim_customers)
SELECT coalesce(m.fact, r.fact) AS fact, r.value AS expected, m.value AS actual,
       r.value IS NOT DISTINCT FROM m.value AS matches
FROM mart m FULL JOIN raw r ON m.fact = r.fact"""


@register("reconcile_facts", _FACTS_SQL)
def reconcile_facts(ds: Datasets) -> DataFrame:
    """Golden facts recomputed from the landing tables vs the same facts from the marts."""
    statuses = ("completed", "placed", "returned", "shipped")
    pay = ds["raw_payments"].groupBy("order_id").agg(
        F.sum(F.when(F.lower("status") == "success", F.col("amount"))).alias("paid"))
    ro = ds["raw_orders"].select("order_id", F.lower("status").alias("s"))
    raw_orders = ro.join(pay, "order_id", "left")
    raw = facts_long(raw_orders, {
        "orders_total": F.count(F.lit(1)),
        **{f"orders_{s}": F.count(F.when(F.col("s") == s, 1)) for s in statuses},
        "recognised_revenue": F.coalesce(F.sum(F.when(F.col("s") == "completed", F.col("paid"))),
                                         F.lit(0)).cast(MONEY),
        "paid_all_statuses": F.coalesce(F.sum("paid"), F.lit(0)).cast(MONEY),
    }).unionByName(facts_long(ds["raw_customers"], {"customers_total": F.count(F.lit(1))}))
    fo = ds["fct_orders"]
    mart = facts_long(fo, {
        "orders_total": F.count(F.lit(1)),
        **{f"orders_{s}": F.count(F.when(F.col("status") == s, 1)) for s in statuses},
        "recognised_revenue": F.coalesce(
            F.sum(F.when(F.col("status") == "completed", F.col("amount_paid"))),
            F.lit(0)).cast(MONEY),
        "paid_all_statuses": F.coalesce(F.sum("amount_paid"), F.lit(0)).cast(MONEY),
    }).unionByName(facts_long(ds["dim_customers"], {"customers_total": F.count(F.lit(1))}))
    return reconcile(mart, raw, ["fact"])


#: Names of the other engine for a declared type; its counts and sums may be wider.
_DUCK_TYPES = {"bigint": "'BIGINT', 'INTEGER', 'HUGEINT'", "string": "'VARCHAR'", "date": "'DATE'",
               "boolean": "'BOOLEAN'"}


def _contract_sql() -> str:
    parts = []
    for c in CONTRACTS:
        # declared names and types against those that the statement's model has
        names = f"(SELECT unnest(json_keys(to_json(m))) FROM (SELECT * FROM {c.model} LIMIT 1) m)"
        declared = ", ".join(f"('{col}')" for col in c.columns)
        miss = f"(SELECT count(*) FROM (VALUES {declared}) d(c) WHERE c NOT IN {names})"
        extra = f"(SELECT count(*) FROM {names} t(c) WHERE c NOT IN (VALUES {declared}))"
        wrong = [f"(any_value(typeof({col})) NOT IN ({_DUCK_TYPES.get(t.split('(')[0], repr(t))}))::INTEGER"
                 for col, t in c.columns.items() if not t.startswith("decimal")]
        wrong += [f"(any_value(typeof({col})) NOT LIKE 'DECIMAL(%,{t[:-1].split(',')[1]})')::INTEGER"
                  for col, t in c.columns.items() if t.startswith("decimal")]
        bad, wide = " + ".join(wrong), 0
        pk = c.primary_key
        nn = " + ".join(f"count(*) FILTER (WHERE {col} IS NULL)" for col in c.not_null)
        parts.append(
            f"SELECT '{c.model}' AS model, {len(c.columns)} AS declared_columns, "
            f"{miss} AS missing_columns, {extra} AS extra_columns, {bad} AS type_mismatches, "
            f"{wide} AS widened_columns, count(*) AS row_count, "
            f"{nn} AS not_null_violations, "
            f"count({pk}) - count(DISTINCT {pk}) AS duplicate_keys FROM {c.model}")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT *, CASE WHEN missing_columns + extra_columns + type_mismatches "
            f"+ not_null_violations + duplicate_keys = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM ({body})")


@register("reconcile_rows", """
SELECT coalesce(f.order_id, g.order_id) AS order_id,
       CASE WHEN g.order_id IS NULL THEN 'left_only' WHEN f.order_id IS NULL THEN 'right_only'
            ELSE 'differs' END AS found,
       CASE WHEN f.order_id IS NULL OR g.order_id IS NULL THEN '' ELSE concat_ws(',',
         CASE WHEN f.status IS DISTINCT FROM g.status THEN 'status' END,
         CASE WHEN f.amount_paid IS DISTINCT FROM g.amount THEN 'amount_paid' END) END AS columns
FROM (SELECT * FROM fct_orders WHERE status <> 'placed') f
FULL JOIN (SELECT * FROM gold_fct_orders WHERE order_id % 10 <> 7) g ON f.order_id = g.order_id
WHERE f.order_id IS NULL OR g.order_id IS NULL OR f.status IS DISTINCT FROM g.status
   OR f.amount_paid IS DISTINCT FROM g.amount""")
def reconcile_rows(ds: Datasets) -> DataFrame:
    """Orders that were paid otherwise than booked, or that one of two extracts lacks.

    The mart without placed orders against gold without some ids, with gold's booked
    amount beside the mart's paid one: missing rows on both sides and differing values.
    """
    mart = ds["fct_orders"].filter("status <> 'placed'").select("order_id", "status", "amount_paid")
    gold = ds["gold_fct_orders"].filter("order_id % 10 <> 7").select(
        "order_id", "status", F.col("amount").alias("amount_paid"))
    return diff_rows(mart, gold, ["order_id"], n_buckets=256)


@register("reconcile_builds", """
SELECT f.order_id, 'differs' AS found, '' AS columns FROM fct_orders f
JOIN gold_fct_orders g ON f.order_id = g.order_id
WHERE (f.customer_id, f.status, f.order_date, f.number_of_items, f.items_total, f.amount_paid, f.payment_method)
   IS DISTINCT FROM
      (g.customer_id, g.status, g.order_date, g.number_of_items, g.items_total, g.amount_paid, g.payment_method)
UNION ALL SELECT order_id, 'left_only', '' FROM fct_orders ANTI JOIN gold_fct_orders USING (order_id)
UNION ALL SELECT order_id, 'right_only', '' FROM gold_fct_orders ANTI JOIN fct_orders USING (order_id)""")
def reconcile_builds(ds: Datasets) -> DataFrame:
    """The same fact built by the platform and by the pipeline, on all common columns: no row."""
    return diff_rows(ds["fct_orders"], ds["gold_fct_orders"], ["order_id"])


@register("contract_check", _contract_sql())
def contract_check(ds: Datasets) -> DataFrame:
    """Per contracted mart: schema diff (analysis time, no job) + not-null and
    primary-key checks in one aggregation over the enforced (cast) output."""
    parts = []
    for c in CONTRACTS:
        df = ds[c.model]
        diff = contract_diff(df, c.columns)
        checked = enforce_contract(df, c.columns, c.model) if not (
            diff["missing"] or diff["extra"] or diff["mismatched"]) else df
        nn = None
        for col in c.not_null:
            e = F.count(F.when(F.col(col).isNull(), 1))
            nn = e if nn is None else nn + e
        parts.append(checked.agg(
            F.lit(c.model).alias("model"),
            F.lit(len(c.columns)).alias("declared_columns"),
            F.lit(len(diff["missing"])).alias("missing_columns"),
            F.lit(len(diff["extra"])).alias("extra_columns"),
            F.lit(len(diff["mismatched"])).alias("type_mismatches"),
            F.lit(len(diff["widened"])).alias("widened_columns"),
            F.count(F.lit(1)).alias("row_count"),
            nn.alias("not_null_violations"),
            (F.count(c.primary_key) - F.countDistinct(c.primary_key)).alias("duplicate_keys"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    bad = (F.col("missing_columns") + F.col("extra_columns") + F.col("type_mismatches")
           + F.col("not_null_violations") + F.col("duplicate_keys"))
    return out.withColumn("status", F.when(bad == 0, F.lit("pass")).otherwise(F.lit("fail")))


def _expect_sql() -> str:
    parts = []
    for t in BRONZE:
        for e in SILVER_EXPECTATIONS[t]:
            parts.append(
                f"SELECT 'silver_{t}' AS table_name, '{e.name}' AS expectation, "
                f"'{e.action}' AS action, count(*) AS rows, "
                f"count(*) FILTER (WHERE NOT coalesce(({e.sql}), FALSE)) AS violations "
                f"FROM silver_{t}_rows")
    return "\nUNION ALL\n".join(parts)


@register("expect_warn", _expect_sql())
def expect_warn(ds: Datasets) -> DataFrame:
    """Violation counts of every expectation over silver's output before its drop rules,
    one scan per table (warn rules keep rows; the counts are what the pipeline reports)."""
    out = None
    for t in BRONZE:
        r = expectation_report(SILVER_FNS[t](ds[f"bronze_{t}"]), SILVER_EXPECTATIONS[t],
                               f"silver_{t}")
        out = r if out is None else out.unionByName(r)
    return out


@register("expect_drop", """
SELECT * FROM bronze_order_items WHERE coalesce(quantity > 1, FALSE)""")
def expect_drop(ds: Datasets) -> DataFrame:
    """Drop rule applied to a table: items with quantity <= 1 (or NULL) are removed."""
    df, _ = apply_expectations(ds["bronze_order_items"],
                               [Expectation("multi_unit", "quantity > 1", "drop")])
    return df


@register("expect_fail", "SELECT * FROM silver_orders_rows")
def expect_fail(ds: Datasets) -> DataFrame:
    """Fail rule on silver's rows: the job raises if any order id is NULL (none are)."""
    return enforce(SILVER_FNS["orders"](ds["bronze_orders"]),
                   [Expectation("valid_order_id", "order_id IS NOT NULL", "fail")])


@register("persist_docs", "SELECT * FROM dim_customers")
def persist_docs(ds: Datasets) -> DataFrame:
    """dim_customers built into a named folder with its column comments, read back from there."""
    places = publish(ds, ["dim_customers"], path=scratch_path(ds.spark, "published"),
                     docs={"dim_customers": DIM_CUSTOMERS_DOCS})
    return ds.spark.read.parquet(places["dim_customers"])


@register("soft_delete_filter", """
SELECT * FROM sf_opportunity WHERE NOT coalesce(_fivetran_deleted, FALSE)""")
def soft_delete_filter_query(ds: Datasets) -> DataFrame:
    from ledgerloom.plans.staging import soft_delete_filter
    return soft_delete_filter(ds["sf_opportunity"])


# -------------------------------------------------------------------- activation ---

def _alerts_sql(as_of: str) -> str:
    return f"""
SELECT opportunity_id, account_id, account_name, opportunity_name, opportunity_owner,
       stage_name, amount, close_date,
       CASE WHEN amount >= CAST(100000 AS DECIMAL(18,2)) THEN 'high_value_open'
            ELSE 'overdue_open' END AS alert_reason
FROM fct_opportunities
WHERE NOT is_closed AND (amount >= CAST(100000 AS DECIMAL(18,2)) OR close_date < {as_of})"""


# The CRM as it stood at the first sync: opportunities whose id ends in 4 were a tenth
# smaller, those ending in 8 at another stage.
FIRST_SYNC = {"amount": ("4", 0.9), "stage_name": ("8", "N")}
_PREV = f"({AS_OF} - INTERVAL {ACTIVATION_SYNC_DAYS} DAY)"
_THEN = f"""
SELECT * REPLACE (
  CASE WHEN opportunity_id LIKE '%{FIRST_SYNC['amount'][0]}'
       THEN CAST(amount * CAST({FIRST_SYNC['amount'][1]} AS DECIMAL(2,1)) AS DECIMAL(18,2))
       ELSE amount END AS amount,
  CASE WHEN opportunity_id LIKE '%{FIRST_SYNC['stage_name'][0]}'
       THEN '{FIRST_SYNC['stage_name'][1]}' ELSE stage_name END AS stage_name)
FROM fct_opportunities"""
_DELTA_SQL = f"""
WITH cur AS ({_alerts_sql(AS_OF)}),
opportunities_then AS ({_THEN}),
prev AS ({_alerts_sql(_PREV).replace('FROM fct_opportunities', 'FROM opportunities_then')})
SELECT cur.*, CASE WHEN prev.opportunity_id IS NULL THEN 'new' ELSE 'updated' END AS change
FROM cur LEFT JOIN prev ON cur.opportunity_id = prev.opportunity_id
WHERE prev.opportunity_id IS NULL
   OR cur.account_id IS DISTINCT FROM prev.account_id
   OR cur.account_name IS DISTINCT FROM prev.account_name
   OR cur.opportunity_name IS DISTINCT FROM prev.opportunity_name
   OR cur.opportunity_owner IS DISTINCT FROM prev.opportunity_owner
   OR cur.stage_name IS DISTINCT FROM prev.stage_name
   OR cur.amount IS DISTINCT FROM prev.amount
   OR cur.close_date IS DISTINCT FROM prev.close_date
   OR cur.alert_reason IS DISTINCT FROM prev.alert_reason"""


def _previous_sync(ds: Datasets) -> Datasets:
    """The registry a week ago: other amounts and stages, other overdue opportunities."""
    prev = Datasets(ds.spark, ds.sf_dir, ds.as_of - _dt.timedelta(days=ACTIVATION_SYNC_DAYS))
    (amount_end, factor), (stage_end, stage) = FIRST_SYNC["amount"], FIRST_SYNC["stage_name"]
    then = ds["fct_opportunities"].withColumns({
        "amount": F.when(F.col("opportunity_id").endswith(amount_end),
                         (F.col("amount") * F.lit(str(factor)).cast("decimal(2,1)")).cast(MONEY))
        .otherwise(F.col("amount")),
        "stage_name": F.when(F.col("opportunity_id").endswith(stage_end), F.lit(stage))
        .otherwise(F.col("stage_name"))})
    return prev.put("fct_opportunities", then)


@register("activation_delta", _DELTA_SQL)
def activation_delta(ds: Datasets) -> DataFrame:
    """Two weekly syncs with stored state; what the second one sends."""
    state = scratch_path(ds.spark, "activation")
    sync(_previous_sync(ds)["crm_opportunity_alerts"], state, "opportunity_id", "week-1")
    return sync(ds["crm_opportunity_alerts"], state, "opportunity_id", "week-2")


_TITLE = ("array_to_string(list_transform(string_split(replace(alert_reason, '_', ' '), ' '), "
          "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


@register("activation_message", f"""
WITH d AS ({_DELTA_SQL})
SELECT opportunity_id, change,
       concat_ws(chr(10), {_TITLE} || ' - ' || opportunity_name,
                 concat_ws('  |  ', 'Account: ' || account_name,
                           'Amount: $' || CAST(amount AS VARCHAR),
                           'Close: ' || CAST(close_date AS VARCHAR)),
                 concat_ws('  |  ', 'Owner: ' || opportunity_owner, 'Stage: ' || stage_name))
           AS message
FROM d""")
def activation_message(ds: Datasets) -> DataFrame:
    d = activation_delta(ds)
    return render_message(d, "alert_reason", "opportunity_name", [
        [("Account: ", "account_name"), ("Amount: $", "amount"), ("Close: ", "close_date")],
        [("Owner: ", "opportunity_owner"), ("Stage: ", "stage_name")],
    ]).select("opportunity_id", "change", "message")


# ----------------------------------------------------------------- appends / ids ---

_SPLIT = f"CAST(date_trunc('month', {AS_OF} - INTERVAL 1 MONTH) AS DATE)"


def _split(ds: Datasets):
    start = F.trunc(F.add_months(ds.as_of_col(), -1), "month")
    o = ds["raw_orders"]
    return o.filter(F.col("order_date") < start), o.filter(F.col("order_date") >= start)


@register("assign_ids", f"""
SELECT order_id, order_date,
       (SELECT coalesce(max(order_id), 0) FROM raw_orders WHERE order_date < {_SPLIT})
       + row_number() OVER (ORDER BY order_date, order_id) AS new_order_id
FROM raw_orders WHERE order_date >= {_SPLIT}""")
def assign_ids_query(ds: Datasets) -> DataFrame:
    """Re-key the last month's orders as a new batch continuing the existing ids."""
    existing, incoming = _split(ds)
    return assign_ids(incoming.select("order_id", "order_date"), existing, "order_id",
                      ["order_date", "order_id"], output="new_order_id")


@register("append_batch", f"""
SELECT order_id, customer_id, order_date, status, amount, payment_method,
       CASE WHEN order_date >= {_SPLIT} THEN {AS_OF_TS} ELSE _loaded_at END AS _loaded_at
FROM raw_orders""")
def append_batch_query(ds: Datasets) -> DataFrame:
    """Existing orders are written, then the new batch is appended with a load stamp."""
    existing, incoming = _split(ds)
    path = scratch_path(ds.spark, "append_orders")
    existing.write.mode("overwrite").parquet(path)
    now = _dt.datetime.combine(ds.as_of or _dt.date.today(), _dt.time())
    append_batch(incoming, path, existing.schema, now)
    return ds.spark.read.parquet(path)


# --------------------------------------------------------------------- streaming ---

def _medallion(ds: Datasets):
    """The five tables streamed once per session and input, from their landed folders."""
    from ledgerloom.streaming.medallion import run_medallion

    def run():
        raw = {t: ds[f"raw_{t}"] for t in BRONZE}
        landing = {t: p for t in BRONZE if (p := ds.landed_path(f"raw_{t}"))}
        return run_medallion(ds.spark, raw, BRONZE, landing=landing)
    return once(ds.spark, ds.scope, "streamed medallion", run) if ds.land_sources else run()


@register("stream_silver_orders", "SELECT * FROM silver_orders")
def stream_silver_orders(ds: Datasets) -> DataFrame:
    """raw -> bronze -> silver through Structured Streaming (availableNow)."""
    return _medallion(ds).silver(ds.spark)["orders"]


@register("stream_gold_fct_orders", "SELECT * FROM gold_fct_orders")
def stream_gold_fct_orders(ds: Datasets) -> DataFrame:
    """Batch gold recomputed over streamed silver tables."""
    silver = _medallion(ds).silver(ds.spark)
    g = ds.with_tables(**{f"silver_{t}": df for t, df in silver.items()})
    return g["gold_fct_orders"]


@register("stream_bronze", "SELECT * FROM raw_payments")
def stream_bronze(ds: Datasets) -> DataFrame:
    """Landing files -> bronze streaming table, verbatim (availableNow, own checkpoint)."""
    return ds.spark.read.parquet(_medallion(ds).bronze_paths["payments"])


@register("stream_bronze_audit", "\nUNION ALL\n".join(
    f"SELECT 'bronze_{t}' AS table_name, count(*) AS row_count, max(_loaded_at) AS last_loaded_at "
    f"FROM raw_{t}" for t in BRONZE))
def stream_bronze_audit(ds: Datasets) -> DataFrame:
    """Rows and latest load stamp of all five streamed bronze tables."""
    paths = _medallion(ds).bronze_paths
    return load_audit({f"bronze_{t}": ds.spark.read.parquet(paths[t]) for t in BRONZE})


@register("stream_expectations", _expect_sql())
def stream_expectations(ds: Datasets) -> DataFrame:
    """Violation counts of the streamed silver tables, summed over all micro-batches."""
    run = _medallion(ds)
    rules = ds.spark.createDataFrame(
        [(f"silver_{t}", e.name, e.action) for t in BRONZE for e in SILVER_EXPECTATIONS[t]],
        "table_name string, expectation string, action string")
    counts = None
    for t in BRONZE:
        c = run.counts(ds.spark, t).withColumn("table_name", F.lit(f"silver_{t}"))
        counts = c if counts is None else counts.unionByName(c)
    total = counts.filter("expectation = '__rows'").select("table_name", F.col("violations").alias("rows"))
    return rules.join(counts, ["table_name", "expectation"]).join(total, "table_name").select(
        "table_name", "expectation", "action", "rows", "violations")


@register("stream_silver", "SELECT * FROM silver_payments")
def stream_silver(ds: Datasets) -> DataFrame:
    """Bronze table -> silver stream (stream from stream) with expectations."""
    return _medallion(ds).silver(ds.spark)["payments"]


@register("stream_gold_dim_customers", "SELECT * FROM gold_dim_customers")
def stream_gold_dim_customers(ds: Datasets) -> DataFrame:
    """Customers, orders and payments streamed to silver; gold customer dimension in batch."""
    silver = _medallion(ds).silver(ds.spark)
    g = ds.with_tables(**{f"silver_{t}": df for t, df in silver.items()})
    return g["gold_dim_customers"]


@register("stream_silver_products_items", """
SELECT i.*, p.category FROM silver_order_items i LEFT JOIN silver_products p
  ON i.product_id = p.product_id""")
def stream_silver_products_items(ds: Datasets) -> DataFrame:
    """The remaining two streamed silver tables, joined in batch (items -> product category)."""
    s = _medallion(ds).silver(ds.spark)
    cats = s["products"].groupBy("product_id").agg(F.max("category").alias("category"))
    return s["order_items"].join(cats, "product_id", "left").select(
        *[F.col(c) for c in s["order_items"].columns], "category")
