"""Data-science feature models: order history, RFM, churn, payment affinity.

All per-customer features come out of *one* ``groupBy(customer_id)`` over
``fct_orders`` with conditional aggregates, instead of one aggregation (and
one join) per feature family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, avg_exact, round_half_up_ratio
from ledgerloom.operators.affinity import affinity_pairs
from ledgerloom.operators.gaps import gap_stats, moments_stddev
from ledgerloom.operators.sequence import written
from ledgerloom.operators.quantiles import QUINTILES, ScoreSpec, quantile_scores
from ledgerloom.plans.contracts import public
from ledgerloom.sources.datasets import Datasets, model

# --- fixed values --------------------------------------------------------------
CHURN_DAYS = 90          # is_churned: more than 90 days since the last order
RFM_PROBS = QUINTILES    # cut points 0.2 / 0.4 / 0.6 / 0.8
# columns that are 0 for customers without (completed) orders
RFM_ZERO_FILLED = ["frequency", "monetary_value", "avg_order_value", "total_items_purchased"]
CHURN_ZERO_FILLED = [
    "total_orders", "completed_orders", "returned_orders", "total_spend", "avg_order_value",
    "stddev_order_value", "avg_items_per_order", "avg_days_between_orders",
    "stddev_days_between_orders", "max_gap_days", "distinct_payment_methods", "return_rate"]
# ------------------------------------------------------------------------------


@model("stg_customer_order_history", "data_science")
def stg_customer_order_history(ds: Datasets) -> DataFrame:
    c = public(ds, "dim_customers").select(
        "customer_id", "customer_segment", "country", "total_lifetime_value",
        "number_of_orders", "first_order_date", "most_recent_order_date")
    o = public(ds, "fct_orders").select(
        "order_id", "customer_id", "order_date", "status", "payment_method",
        "number_of_items", "items_total", "amount_paid")
    # orders on the streamed side: AQE can split a hot customer's partition
    return o.join(c, "customer_id", "inner").select(
        "customer_id", "customer_segment", "country", "total_lifetime_value",
        "number_of_orders", "first_order_date", "most_recent_order_date",
        "order_id", "order_date", "status", "payment_method", "number_of_items",
        "items_total", "amount_paid",
        F.datediff(ds.as_of_col(), F.col("most_recent_order_date")).alias("days_since_last_order"),
        F.datediff("most_recent_order_date", "first_order_date").alias("customer_tenure_days"),
    )


def rfm_features(customers: DataFrame, orders: DataFrame, as_of,
                 null_recency: str = "zero") -> DataFrame:
    """R/F/M features and quintile scores per customer.

    ``null_recency``: ``"zero"`` (as the reference model does) fills the
    recency of customers without orders with 0 before scoring, so they score as
    most recent (r = 5); ``"worst"`` keeps it NULL, leaves it out of the cut
    points and scores it r = 1.
    """
    if null_recency not in ("zero", "worst"):
        raise ValueError("null_recency must be 'zero' or 'worst'")
    completed = F.col("status") == "completed"
    per = orders.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count(F.when(completed, F.col("order_id"))).alias("frequency"),
        F.sum(F.when(completed, F.col("amount_paid"))).alias("__m"),
        F.count(F.when(completed, F.col("amount_paid"))).alias("__mc"),
        F.sum(F.when(completed, F.col("number_of_items"))).alias("total_items_purchased"),
    )
    rfm = (
        customers.select("customer_id", "customer_segment", "country")
        .join(per, "customer_id", "left")
        .select(
            "customer_id", "customer_segment", "country",
            F.datediff(as_of, F.col("last_order_date")).alias("recency_days"),
            F.col("frequency"),
            F.col("__m").cast(MONEY).alias("monetary_value"),
            avg_exact(F.col("__m"), F.col("__mc")).alias("avg_order_value"),
            F.col("total_items_purchased"),
        )
        # customers without (completed) orders: 0, including recency (scores as most recent)
        .fillna(0, subset=(["recency_days"] if null_recency == "zero" else []) + RFM_ZERO_FILLED)
    )
    rfm = written(rfm, "rfm")       # read for the cut points and for the scores
    scored = quantile_scores(rfm, [
        ScoreSpec("recency_days", "r_score", reverse=True),
        ScoreSpec("frequency", "f_score"),
        ScoreSpec("monetary_value", "m_score"),
    ], RFM_PROBS)
    return scored.select(
        "customer_id", "customer_segment", "country", "recency_days", "frequency",
        "monetary_value", "avg_order_value", "total_items_purchased",
        "r_score", "f_score", "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
    )


@model("rfm_customer_features", "data_science", materialized="table")
def rfm_customer_features(ds: Datasets) -> DataFrame:
    return rfm_features(public(ds, "dim_customers"), public(ds, "fct_orders"), ds.as_of_col())


def churn_features(customers: DataFrame, orders: DataFrame, as_of, parts: int | None = None) -> DataFrame:
    completed = F.col("status") == "completed"
    returned = F.col("status") == "returned"
    cents = (F.col("amount_paid") * 100).cast("decimal(38,0)")
    per = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count(F.when(completed, F.col("order_id"))).alias("completed_orders"),
        F.count(F.when(returned, F.col("order_id"))).alias("returned_orders"),
        F.sum("amount_paid").alias("__spend"),
        F.count("amount_paid").alias("__n"),
        F.sum(cents).alias("__s"),
        F.sum(cents * cents).alias("__q"),
        F.sum("number_of_items").alias("__items"),
        F.count("number_of_items").alias("__items_n"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.countDistinct("payment_method").alias("distinct_payment_methods"),
    )
    gaps = gap_stats(orders, "customer_id", "order_date", parts=parts)
    features = (
        customers.select("customer_id", "customer_segment", "country", "total_lifetime_value")
        .join(per, "customer_id", "left")
        .join(gaps, "customer_id", "left")
        .select(
            "customer_id", "customer_segment", "country", "total_lifetime_value",
            F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
            "total_orders", "completed_orders", "returned_orders",
            F.col("__spend").cast(MONEY).alias("total_spend"),
            avg_exact(F.col("__spend"), F.col("__n")).alias("avg_order_value"),
            moments_stddev("__n", "__s", "__q", scale=2).alias("stddev_order_value"),
            avg_exact(F.col("__items"), F.col("__items_n")).alias("avg_items_per_order"),
            F.datediff(as_of, F.col("last_order_date")).alias("days_since_last_order"),
            "avg_days_between_orders", "stddev_days_between_orders", "max_gap_days",
            "distinct_payment_methods",
            F.when(F.col("total_orders") > 0,
                   round_half_up_ratio(F.col("returned_orders"), F.col("total_orders"), 4)
                   .cast("double")).otherwise(F.lit(0.0)).alias("return_rate"),
        )
        .withColumn("is_churned", F.coalesce(F.col("days_since_last_order") > CHURN_DAYS,
                                             F.lit(False)))
        .fillna(0, subset=CHURN_ZERO_FILLED)
    )
    return features


@model("customer_churn_features", "data_science", materialized="table")
def customer_churn_features(ds: Datasets) -> DataFrame:
    return churn_features(public(ds, "dim_customers"), public(ds, "fct_orders"), ds.as_of_col(),
                          ds.parts("orders"))


@model("payment_method_affinity_pairs", "data_science", materialized="table")
def payment_method_affinity_pairs(ds: Datasets) -> DataFrame:
    completed = public(ds, "fct_orders").filter(F.col("status") == "completed") \
        .select("customer_id", "payment_method", "amount_paid")
    return affinity_pairs(completed, "customer_id", "payment_method", "amount_paid")
