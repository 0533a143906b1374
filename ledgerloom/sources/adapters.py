"""Input adapter: driver TPC-H-style tables -> commerce and CRM landing tables.

Each raw table is a lazy projection/aggregation of the driver parquet files,
so its size (and the work of every model above it) grows with the input. The
mapping rules are fixed values of the test-data contract and are listed here
in one place.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import money_from_cents, ts_ntz
from ledgerloom.operators.sequence import dealt, number_within, running_total, written
from ledgerloom.sources.datasets import Datasets, model, once

# --- fixed values of the adapter mapping ---------------------------------------
PROSPECT_NAME = "PROSPECT"           # last name of suppliers listed as customers without orders
PAYMENT_MOD = 20                     # payment rules work on order_id % 20
PAYMENT_MISSING = 13                 #   no payment row
PAYMENT_PENDING = 3                  #   'Pending'
PAYMENT_FAILED = 7                   #   'Failed'
PAYMENT_RETRY = 11                   #   extra 'Failed' row (payment_id + 1)
ORDER_STATUS = {"F": "COMPLETED", "O": "SHIPPED", "P": "PLACED"}
RETURNED_STATUS = "RETURNED"         # more than half of the lines have l_returnflag 'R'
PAYMENT_METHOD_BY_PRIORITY = {"1": "Credit_Card", "2": "Credit_Card", "3": "Credit_Card",
                              "4": "PayPal", "5": "Bank_Transfer"}
PROBABILITY_BY_PRIORITY = {"1": 90, "2": 70, "3": 50, "4": 30, "5": 10}
EMAIL_DOMAIN = "@Example.COM"
CUSTOMER_CREATED = _dt.date(1994, 12, 31)
STATIC_LOADED_AT = _dt.datetime(2001, 8, 1, 0, 0, 0)   # customers, products
CRM_SYNCED_AT = _dt.datetime(2001, 8, 1, 18, 0, 0)
OWNER_MOD = 10                       # owner_id = 'USR' || (key % 10)
OPP_WON_MOD = 3                      # closed and key % 3 <> 0 -> won
OPP_DELETED_MOD = 50                 # % 50 = 0 deleted, = 1 NULL flag
PAYMENT_LAG_DAYS = 2                 # payments land two days after the order
# ------------------------------------------------------------------------------


def _map(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _priority(c: str = "o_orderpriority") -> Column:
    return F.substring(F.col(c), 1, 1)


def _ts(v: _dt.datetime) -> Column:
    return ts_ntz(v)


def _lookup(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """A lookup side that is unique on ``key`` (an aggregate by key).

    Catalyst knows an aggregate is distinct on its grouping key, so a LEFT
    JOIN to it whose columns are not used downstream is removed from the plan
    entirely (e.g. the load stamp lookup when a query only counts items).
    """
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


@model("raw_customers", "source")
def raw_customers(ds: Datasets) -> DataFrame:
    """Customers, and suppliers as prospects: customers of negative id that order nothing."""
    c = ds.driver("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    prospects = ds.driver("supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.lit(PROSPECT_NAME).alias("c_mktsegment"))
    c = c.unionByName(prospects)
    n = _lookup(ds.driver("nation"), "n_nationkey", "n_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.col("c_name"), F.lit(EMAIL_DOMAIN)).alias("email"),
            F.lit(CUSTOMER_CREATED).alias("created_at"),
            F.col("n_name").alias("country"),
            _ts(STATIC_LOADED_AT).alias("_loaded_at"),
        )
    )


@model("order_line_counts", "adapter", materialized="ephemeral")
def order_line_counts(ds: Datasets) -> DataFrame:
    """Per order: number of lines, number of 'R' lines, and the lines of all orders before it.

    Written once: the orders read the flags, the lines their first number.
    """
    def count() -> DataFrame:
        per = ds.driver("lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"))
        return written(running_total(per, ["l_orderkey"], "n_lines", "lines_before", ds.parts("orders")),
                       "order-lines")

    return once(ds.spark, ds.scope, "order_line_counts", count) if ds.sf_dir else count()


@model("raw_orders", "source")
def raw_orders(ds: Datasets) -> DataFrame:
    parts = ds.parts("orders")
    o = dealt(ds.driver("orders"), parts, "o_orderkey")
    flags = dealt(ds["order_line_counts"].select("l_orderkey", "n_lines", "n_returned"), parts, "l_orderkey")
    j = o.join(flags, o.o_orderkey == flags.l_orderkey, "left")
    status = F.when(F.col("n_returned") * 2 > F.col("n_lines"), F.lit(RETURNED_STATUS)) \
        .otherwise(_map(F.col("o_orderstatus"), ORDER_STATUS))
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        status.alias("status"),
        money_from_cents(F.col("o_totalprice") / 50).alias("amount"),
        _map(_priority(), PAYMENT_METHOD_BY_PRIORITY).alias("payment_method"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("_loaded_at"),
    )


HOT_LINES = 100_000         # lines of an order that one task numbers
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
              "l_quantity", "l_returnflag"]


@model("line_items_numbered", "adapter", materialized="ephemeral")
def line_items_numbered(ds: Datasets) -> DataFrame:
    """Line items with ``order_item_id``, their place, from 1, in the order of all lines, and
    their order's date and customer.

    ``(l_orderkey, l_linenumber)`` is not unique in the driver data, so the order
    runs over every column used. The place is that of the order's first line plus the
    place within the order, so the lines are shuffled once, by order, like the orders
    they are joined to, and written once. The number of partitions follows the rows, so
    no task sorts more than some hundred thousand lines. Orders of more than ``HOT_LINES`` lines (and
    lines without an order) are range-sorted instead, so a hot order spans many tasks.
    """
    def number() -> DataFrame:
        li = ds.driver("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag", "l_shipdate")
        counts = ds["order_line_counts"].select("l_orderkey", "n_lines", "lines_before")
        n = ds.parts("lineitem")
        o = _lookup(dealt(ds.driver("orders").select("o_orderkey", "o_orderdate", "o_custkey"), n, "o_orderkey"),
                    "o_orderkey", "o_orderdate", "o_custkey")
        rest = counts.filter(F.col("l_orderkey").isNull() | (F.col("n_lines") > HOT_LINES))
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
        plain = counts.filter(F.col("n_lines") <= HOT_LINES).drop("n_lines")
        parts = [dealt(li, n, "l_orderkey").join(dealt(plain, n, "l_orderkey"), "l_orderkey")
                 .withColumn("__place", place)]
        if rest.limit(1).count():
            hot = rest.select(F.col("l_orderkey").alias("__hot"), F.col("lines_before"))
            lines = number_within(li.join(hot.select("__hot"), F.col("l_orderkey").eqNullSafe(F.col("__hot")),
                                          "left_semi"), ["l_orderkey"], LINE_ORDER, "__place")
            parts.append(lines.join(hot, F.col("l_orderkey").eqNullSafe(F.col("__hot"))).drop("__hot"))
        parts = [p.join(o, p.l_orderkey == o.o_orderkey, "left").select(
            *li.columns, "o_orderdate", "o_custkey",
            (F.col("lines_before") + F.col("__place")).alias("order_item_id")) for p in parts]
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return written(out, "line-items")

    return once(ds.spark, ds.scope, "line_items_numbered", number) if ds.sf_dir else number()


@model("raw_order_items", "source")
def raw_order_items(ds: Datasets) -> DataFrame:
    return ds["line_items_numbered"].select(
        F.col("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.floor("l_quantity").cast("int").alias("quantity"),
        money_from_cents("l_extendedprice").alias("unit_price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("_loaded_at"),
    )


@model("raw_products", "source")
def raw_products(ds: Datasets) -> DataFrame:
    return ds.driver("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        money_from_cents(F.col("p_retailprice") * 100).alias("unit_price"),
        (F.col("p_size") % 10 != 0).alias("is_active"),
        _ts(STATIC_LOADED_AT).alias("_loaded_at"),
    )


@model("raw_payments", "source")
def raw_payments(ds: Datasets) -> DataFrame:
    """One payment per order (none for % 20 = 13), plus a failed retry for % 20 = 11.

    Built with a single ``explode`` over the orders, so the order plan is read
    once and no union re-scans it.
    """
    o = ds["raw_orders"]
    m = F.col("order_id") % PAYMENT_MOD
    attempts = F.when(m == PAYMENT_RETRY, F.array(F.lit(0), F.lit(1))) \
        .when(m == PAYMENT_MISSING, F.array().cast("array<int>")) \
        .otherwise(F.array(F.lit(0)))
    status = F.when(F.col("attempt") == 1, F.lit("Failed")) \
        .when(m == PAYMENT_PENDING, F.lit("Pending")) \
        .when(m == PAYMENT_FAILED, F.lit("Failed")) \
        .otherwise(F.lit("Success"))
    return (
        o.select("order_id", "payment_method", "amount", "order_date",
                 F.explode(attempts).alias("attempt"))
        .select(
            (F.col("order_id") * 10 + F.col("attempt")).alias("payment_id"),
            "order_id",
            "payment_method",
            "amount",
            status.alias("status"),
            F.col("order_date").alias("payment_date"),
            F.date_sub("order_date", PAYMENT_LAG_DAYS).cast("timestamp_ntz").alias("_loaded_at"),
        )
    )


@model("raw_reviews", "source")
def raw_reviews(ds: Datasets) -> DataFrame:
    return ds["line_items_numbered"].filter(F.col("l_returnflag") == "A").select(
        F.col("order_item_id").alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.lit(1) + F.floor("l_quantity").cast("int") % 5).alias("rating"),
        F.to_date("l_shipdate").alias("review_date"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("_loaded_at"),
    )


# --- CRM landing tables (soft-delete flagged) ----------------------------------

def _deleted_flag(key: Column) -> Column:
    m = key % OPP_DELETED_MOD
    return F.when(m == 0, F.lit(True)).when(m == 1, F.lit(None).cast("boolean")) \
        .otherwise(F.lit(False))


@model("sf_account", "source")
def sf_account(ds: Datasets) -> DataFrame:
    c = ds.driver("customer")
    n = _lookup(ds.driver("nation"), "n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("ACC"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.lit("Customer - Direct"))
        .otherwise(F.lit("Customer - Channel")).alias("type"),
        F.col("c_mktsegment").alias("industry"),
        money_from_cents(F.col("c_acctbal") * 100).alias("annual_revenue"),
        ((F.col("c_custkey") % 100) * 10 + 5).cast("int").alias("number_of_employees"),
        F.lower("n_name").alias("billing_country"),
        F.concat(F.lit("USR"), (F.col("c_custkey") % OWNER_MOD).cast("string")).alias("owner_id"),
        F.lit(CUSTOMER_CREATED).alias("created_date"),
        _ts(CRM_SYNCED_AT).alias("_fivetran_synced"),
        F.when(F.col("c_custkey") % OPP_DELETED_MOD == 1, F.lit(None).cast("boolean"))
        .otherwise(F.lit(False)).alias("_fivetran_deleted"),
    )


@model("sf_contact", "source")
def sf_contact(ds: Datasets) -> DataFrame:
    c = ds.driver("customer")
    return c.select(
        F.concat(F.lit("CON"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit("ACC"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.col("c_name"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.lit("Buyer").alias("title"),
        F.concat(F.lit("USR"), (F.col("c_custkey") % OWNER_MOD).cast("string")).alias("owner_id"),
        F.lit(CUSTOMER_CREATED).alias("created_date"),
        _ts(CRM_SYNCED_AT).alias("_fivetran_synced"),
        _deleted_flag(F.col("c_custkey")).alias("_fivetran_deleted"),
    )


@model("sf_opportunity", "source")
def sf_opportunity(ds: Datasets) -> DataFrame:
    o = ds.driver("orders")
    closed = F.col("o_orderstatus") == "F"
    return o.select(
        F.concat(F.lit("OPP"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("ACC"), F.col("o_custkey").cast("string")).alias("account_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderstatus").alias("stage_name"),
        F.floor("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.to_date("o_orderdate").alias("close_date"),
        _map(_priority(), PROBABILITY_BY_PRIORITY).cast("decimal(5,2)").alias("probability"),
        closed.alias("is_closed"),
        (closed & (F.col("o_orderkey") % OPP_WON_MOD != 0)).alias("is_won"),
        F.lit("New Business").alias("type"),
        F.col("o_orderpriority").alias("lead_source"),
        F.concat(F.lit("USR"), (F.col("o_orderkey") % OWNER_MOD).cast("string")).alias("owner_id"),
        F.date_sub(F.to_date("o_orderdate"), 30).alias("created_date"),
        _ts(CRM_SYNCED_AT).alias("_fivetran_synced"),
        _deleted_flag(F.col("o_orderkey")).alias("_fivetran_deleted"),
    )


@model("sf_user", "source")
def sf_user(ds: Datasets) -> DataFrame:
    s = ds.driver("supplier")
    return s.select(
        F.concat(F.lit("USR"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.col("s_name"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.when(F.col("s_suppkey") % 10 == 9, F.lit(None).cast("boolean"))
        .otherwise(F.col("s_acctbal") >= 0).alias("is_active"),
        _ts(CRM_SYNCED_AT).alias("_fivetran_synced"),
        F.lit(False).alias("_fivetran_deleted"),
    )
