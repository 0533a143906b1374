"""Marketing consumer models: recency x value segments, country roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, avg_exact, ratio
from ledgerloom.plans.contracts import public
from ledgerloom.sources.datasets import Datasets, model

# --- fixed values: marketing segment rule set A (days since last order) ----------
CHAMPION_DAYS = 30
LOYAL_DAYS = 90
AT_RISK_DAYS = 180
# ------------------------------------------------------------------------------


def customer_order_rollup(ds: Datasets) -> DataFrame:
    """One row per customer from ``fct_orders`` in a single aggregation.

    ``order_id`` is the primary key of ``fct_orders``, so counts of orders are
    plain conditional counts (no distinct/Expand needed).
    """
    o = public(ds, "fct_orders")
    completed = F.col("status") == "completed"
    return o.groupBy("customer_id").agg(
        F.count("order_id").alias("n_orders"),
        F.count(F.when(completed, F.col("order_id"))).alias("completed_orders"),
        F.sum(F.when(completed, F.col("amount_paid")).otherwise(F.lit(0))).alias("recognised"),
        F.max("order_date").alias("last_order_date"),
    )


@model("mart_customer_segments", "marketing", materialized="table")
def mart_customer_segments(ds: Datasets) -> DataFrame:
    c = public(ds, "dim_customers")
    r = customer_order_rollup(ds).select(
        "customer_id", "last_order_date", "completed_orders",
        F.datediff(ds.as_of_col(), F.col("last_order_date")).alias("days_since_last_order"))
    days = F.col("days_since_last_order")
    seg = F.col("customer_segment")
    marketing_segment = (
        F.when((days <= CHAMPION_DAYS) & (seg == "high_value"), "champion")
        .when((days <= LOYAL_DAYS) & seg.isin("high_value", "mid_value"), "loyal")
        .when(days <= AT_RISK_DAYS, "at_risk")
        .when(days > AT_RISK_DAYS, "lapsed")
        .when(F.col("last_order_date").isNull(), "never_purchased")
        .otherwise("other")
    )
    return c.join(r, "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "email", "country", "customer_segment",
        "total_lifetime_value", "number_of_orders", "last_order_date", "completed_orders",
        "days_since_last_order", marketing_segment.alias("marketing_segment"),
    )


def _country_rollup(ds: Datasets) -> DataFrame:
    c = public(ds, "dim_customers").select("customer_id", "country", "customer_segment",
                                   "total_lifetime_value")
    r = customer_order_rollup(ds).select("customer_id", "n_orders", "recognised")
    return c.join(r, "customer_id", "left")


@model("mart_country_performance", "marketing", materialized="table")
def mart_country_performance(ds: Datasets) -> DataFrame:
    """Country roll-up of customers LEFT JOIN orders, computed without the fan-out.

    The literal model joins every order to its customer and then averages LTV
    over the joined rows (order-weighted). Here orders are first reduced to one
    row per customer; a customer with ``n`` orders carries weight ``max(n, 1)``
    so ``avg_ltv`` keeps the order-weighted meaning exactly.
    """
    j = _country_rollup(ds)
    w = F.greatest(F.coalesce(F.col("n_orders"), F.lit(0)), F.lit(1))
    n_cust = F.count("customer_id")
    rev = F.sum(F.coalesce(F.col("recognised"), F.lit(0))).cast(MONEY)
    return j.groupBy("country").agg(
        n_cust.alias("total_customers"),
        F.count(F.when(F.col("customer_segment") == "high_value", F.col("customer_id")))
        .alias("high_value_customers"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        rev.alias("recognised_revenue"),
        avg_exact(F.sum(F.col("total_lifetime_value") * w), F.sum(w)).alias("avg_ltv"),
        ratio(rev, n_cust).alias("revenue_per_customer"),
    )


@model("mart_country_performance_per_customer", "marketing", materialized="table")
def mart_country_performance_per_customer(ds: Datasets) -> DataFrame:
    """Fan-out-safe variant: ``avg_ltv`` averages each customer once."""
    j = _country_rollup(ds)
    n_cust = F.count("customer_id")
    rev = F.sum(F.coalesce(F.col("recognised"), F.lit(0))).cast(MONEY)
    return j.groupBy("country").agg(
        n_cust.alias("total_customers"),
        rev.alias("recognised_revenue"),
        avg_exact(F.sum("total_lifetime_value"), F.count("total_lifetime_value")).alias("avg_ltv"),
    )
