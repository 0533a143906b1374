"""Platform intermediate models and public (contracted) marts.

Fan-out safety: every 1:N side is aggregated to the join key *before* the join
(partial + final hash aggregation, so a hot key is combined map-side), and the
joins that remain are 1:1 or N:1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, dec0, segment
from ledgerloom.operators.sequence import dealt
from ledgerloom.sources.datasets import Datasets, model

# --- fixed values: customer value segments (lower bound, label), high to low ---
VALUE_BANDS = [(500, "high_value"), (100, "mid_value")]
VALUE_DEFAULT = "low_value"
# ------------------------------------------------------------------------------


@model("order_payments", materialized="ephemeral")
def order_payments(ds: Datasets) -> DataFrame:
    """Successful payments per order (shared by ``fct_orders`` and LTV)."""
    p = dealt(ds["stg_payments"].select("order_id", "payment_status", "amount", "payment_date"),
              ds.parts("orders"), "order_id")
    return p.groupBy("order_id").agg(
        F.sum(F.when(F.col("payment_status") == "success", F.col("amount"))
              .otherwise(F.lit(0))).alias("amount_paid"),
        F.max("payment_date").alias("latest_payment_date"),
    )


@model("int_customer_orders", materialized="ephemeral")
def int_customer_orders(ds: Datasets) -> DataFrame:
    """Orders -> customer: order count, LTV (NULL when no order has a payment row)."""
    o = dealt(ds["stg_orders"].select("order_id", "customer_id", "order_date"), ds.parts("orders"), "order_id")
    op = ds["order_payments"].select("order_id", "amount_paid")
    return (
        o.join(op, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("number_of_orders"),
            F.sum("amount_paid").alias("total_lifetime_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("most_recent_order_date"),
        )
    )


@model("int_order_items_enriched", materialized="ephemeral")
def int_order_items_enriched(ds: Datasets) -> DataFrame:
    oi = ds["stg_order_items"]
    p = ds["stg_products"].select("product_id", "product_name", "category")
    if ds.parts("part"):        # too many to broadcast: a task holds its products, no line is sorted
        p = p.hint("shuffle_hash")
    return oi.join(p, "product_id", "left").select(
        "order_item_id", "order_id", "product_id", "product_name", "category",
        "quantity", "unit_price", "line_total",
    )


@model("dim_customers", materialized="table")
def dim_customers(ds: Datasets) -> DataFrame:
    c = ds["stg_customers"]
    co = ds["int_customer_orders"]
    return c.join(co, "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "email", "created_date", "country",
        F.coalesce(F.col("number_of_orders"), F.lit(0).cast("bigint")).alias("number_of_orders"),
        dec0(F.col("total_lifetime_value").cast(MONEY)).alias("total_lifetime_value"),
        "first_order_date", "most_recent_order_date",
        # segment tests the un-coalesced LTV: NULL falls through to low_value
        segment("total_lifetime_value", VALUE_BANDS, VALUE_DEFAULT).alias("customer_segment"),
    )


@model("dim_products", materialized="table")
def dim_products(ds: Datasets) -> DataFrame:
    return ds["stg_products"].select("product_id", "product_name", "category",
                                     F.col("unit_price").cast(MONEY).alias("unit_price"),
                                     "is_active")


@model("order_items_by_order", materialized="ephemeral")
def order_items_by_order(ds: Datasets) -> DataFrame:
    """Item count and total per order.

    Reads ``stg_order_items`` directly: the enriched model only adds product
    columns through an N:1 join on the unique ``product_id``, so count and sum
    are unchanged and the join is skipped.
    """
    # order_item_id is never NULL within a non-NULL order_id group, so the item
    # count is a row count; this lets Catalyst prune the line-numbering window
    # (and its full shuffle of the line items) from every plan that only needs
    # per-order totals.
    return ds["stg_order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("number_of_items"),
        F.sum("line_total").alias("items_total"),
    )


@model("fct_orders", materialized="table")
def fct_orders(ds: Datasets) -> DataFrame:
    parts = ds.parts("orders")
    o = dealt(ds["stg_orders"], parts, "order_id")
    oi = dealt(ds["order_items_by_order"], parts, "order_id")
    p = ds["order_payments"].select("order_id", "amount_paid")
    return (
        o.join(oi, "order_id", "left")
        .join(p, "order_id", "left")
        .select(
            "order_id", "customer_id", "order_date", "status", "payment_method",
            F.coalesce(F.col("number_of_items"), F.lit(0).cast("bigint")).alias("number_of_items"),
            dec0(F.col("items_total").cast(MONEY)).alias("items_total"),
            dec0(F.col("amount_paid").cast(MONEY)).alias("amount_paid"),
        )
    )
