"""Finance consumer models: revenue fact and product revenue attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, dec0
from ledgerloom.operators.sequence import dealt
from ledgerloom.plans.contracts import public
from ledgerloom.sources.datasets import Datasets, model


@model("fct_revenue", "finance", materialized="table")
def fct_revenue(ds: Datasets) -> DataFrame:
    o = public(ds, "fct_orders")
    zero = F.lit(0).cast(MONEY)
    return o.select(
        "order_id", "customer_id", "order_date",
        F.trunc("order_date", "month").alias("order_month"),
        F.trunc("order_date", "year").alias("order_year"),
        "status", "payment_method", "number_of_items", "items_total", "amount_paid",
        F.when(F.col("status") == "completed", F.col("amount_paid")).otherwise(zero)
        .alias("recognised_revenue"),
        F.when(F.col("status") == "returned", F.col("amount_paid")).otherwise(zero)
        .alias("returned_amount"),
    )


def order_totals(ds: Datasets) -> DataFrame:
    """All orders reduced to a single row (the side every product shares)."""
    o = public(ds, "fct_orders")
    return o.agg(
        F.count("order_id").alias("total_orders"),
        F.sum(F.when(F.col("status") == "completed", F.col("amount_paid"))).alias("recognised"),
        F.count(F.when(F.col("status") == "returned", F.col("order_id"))).alias("return_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
    )


@model("fct_revenue_by_product", "finance", materialized="table")
def fct_revenue_by_product(ds: Datasets) -> DataFrame:
    """Product spine x all orders, as in the demo model (every product gets the
    same order totals).

    The orders side does not depend on the product, so it is aggregated to one
    row first and broadcast (one row: a proven size bound); products x orders
    is never materialised. ``order_id`` is the key of ``fct_orders``, so the
    distinct counts are plain counts.
    """
    p = public(ds, "dim_products")
    t = order_totals(ds)
    return p.crossJoin(F.broadcast(t)).select(
        "product_id", "product_name", "category", "unit_price", "is_active",
        F.col("total_orders"),
        dec0(F.col("recognised").cast(MONEY)).alias("recognised_revenue"),
        F.col("return_count"),
        "first_order_date", "most_recent_order_date",
    )


def product_order_lines(ds: Datasets) -> DataFrame:
    """(product, order) grain: line revenue of each product within each order.

    Pre-aggregating to this grain first turns the per-product distinct order
    counts into plain counts and combines a hot product map-side. Join and totals share
    partitions by order, whose number follows the lines: a task holds its lines only.
    """
    parts = ds.parts("lineitem")
    oi = dealt(ds["stg_order_items"].select("order_id", "product_id", "line_total"), parts, "order_id")
    o = dealt(public(ds, "fct_orders").select("order_id", "status", "order_date"), parts, "order_id")
    return (
        oi.join(o, "order_id", "inner")
        .groupBy("product_id", "order_id", "status", "order_date")
        .agg(F.sum("line_total").alias("line_revenue"))
    )


@model("revenue_by_product_lines", "finance", materialized="table")
def revenue_by_product_lines(ds: Datasets) -> DataFrame:
    """Line-level attribution: each product earns only its own line totals."""
    pol = product_order_lines(ds)
    agg = pol.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum(F.when(F.col("status") == "completed", F.col("line_revenue"))).alias("rec"),
        F.count(F.when(F.col("status") == "returned", F.col("order_id"))).alias("return_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
    )
    p = public(ds, "dim_products")
    return p.join(agg, "product_id", "left").select(
        "product_id", "product_name", "category", "unit_price", "is_active",
        F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
        dec0(F.col("rec").cast(MONEY)).alias("recognised_revenue"),
        F.coalesce("return_count", F.lit(0).cast("bigint")).alias("return_count"),
        "first_order_date", "most_recent_order_date",
    )
