"""Medallion pipeline variant: bronze -> silver (expectations) -> gold, plus the
per-team consumer tables built on gold.

Bronze tables are the landing tables verbatim. Silver tables are stateless
projections + row filters, so the same functions serve the batch registry and
the streaming runner (:mod:`ledgerloom.streaming.medallion`). Gold tables are
full recomputes (materialized views) over silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, dec0, round_half_up_ratio, segment
from ledgerloom.operators.expectations import Expectation, enforce
from ledgerloom.operators.sequence import dealt
from ledgerloom.plans.data_science import churn_features, rfm_features
from ledgerloom.plans.marts import VALUE_BANDS, VALUE_DEFAULT
from ledgerloom.sources.datasets import Datasets, model

# --- fixed values: silver expectations (name, predicate, action) -----------------
SILVER_EXPECTATIONS: dict[str, list[Expectation]] = {
    "customers": [Expectation("valid_customer_id", "customer_id IS NOT NULL", "drop"),
                  Expectation("valid_email", "email IS NOT NULL", "warn")],
    "orders": [Expectation("valid_order_id", "order_id IS NOT NULL", "drop"),
               Expectation("valid_status",
                           "status IN ('placed', 'shipped', 'completed', 'returned')", "warn")],
    "order_items": [Expectation("valid_item_id", "order_item_id IS NOT NULL", "drop"),
                    Expectation("positive_quantity", "quantity > 0", "warn")],
    "products": [Expectation("valid_product_id", "product_id IS NOT NULL", "drop")],
    "payments": [Expectation("valid_payment_id", "payment_id IS NOT NULL", "drop"),
                 Expectation("positive_amount", "amount > 0", "warn")],
}
# marketing rule set B
B_CHAMPION_DAYS, B_LOYAL_ORDERS, B_AT_RISK_DAYS, B_LAPSED_DAYS = 30, 3, 60, 90
B_HIGH_LTV, B_MID_LTV = 500, 100
NO_ORDER_DAYS_SENTINEL = 9999   # Python variant: customers without orders
# ------------------------------------------------------------------------------

BRONZE = ("customers", "orders", "order_items", "products", "payments")


def _bronze(name: str):
    # batch registry: bronze is the landed source table itself (the streaming
    # runner writes physical bronze/silver tables)
    @model(f"bronze_{name}", "pipeline")
    def build(ds: Datasets) -> DataFrame:
        return ds[f"raw_{name}"]
    return build


for _n in BRONZE:
    _bronze(_n)


# -- silver transforms (stateless, shared with the streaming runner) -------------

def silver_customers_fn(df: DataFrame) -> DataFrame:
    return df.select("customer_id", "first_name", "last_name",
                     F.lower("email").alias("email"),
                     F.to_date("created_at").alias("created_date"),
                     F.upper("country").alias("country"))


def silver_orders_fn(df: DataFrame) -> DataFrame:
    # payment_method is carried as an extra column: the data-science consumer
    # counts distinct payment methods on gold orders.
    return df.select("order_id", "customer_id", F.lower("status").alias("status"),
                     F.to_date("order_date").alias("order_date"), "amount",
                     F.lower("payment_method").alias("payment_method"))


def silver_order_items_fn(df: DataFrame) -> DataFrame:
    return df.select("order_item_id", "order_id", "product_id", "quantity", "unit_price",
                     (F.col("quantity") * F.col("unit_price")).alias("line_total"))


def silver_products_fn(df: DataFrame) -> DataFrame:
    return df.select("product_id", "product_name", F.lower("category").alias("category"),
                     "unit_price", "is_active")


def silver_payments_fn(df: DataFrame) -> DataFrame:
    return df.select("payment_id", "order_id",
                     F.lower("payment_method").alias("payment_method"), "amount",
                     F.to_date("payment_date").alias("payment_date"),
                     F.lower("status").alias("payment_status"))


SILVER_FNS = {
    "customers": silver_customers_fn, "orders": silver_orders_fn,
    "order_items": silver_order_items_fn, "products": silver_products_fn,
    "payments": silver_payments_fn,
}


def _silver(name: str):
    @model(f"silver_{name}", "pipeline")
    def build(ds: Datasets) -> DataFrame:
        return enforce(SILVER_FNS[name](ds[f"bronze_{name}"]), SILVER_EXPECTATIONS[name])
    return build


for _n in BRONZE:
    _silver(_n)


# -- gold ------------------------------------------------------------------------

def _success_by_order(ds: Datasets) -> DataFrame:
    p = dealt(ds["silver_payments"].filter(F.col("payment_status") == "success").select("order_id", "amount"),
              ds.parts("orders"), "order_id")
    return p.groupBy("order_id").agg(F.sum("amount").alias("amount_paid"))


@model("gold_dim_customers", "pipeline", materialized="table")
def gold_dim_customers(ds: Datasets) -> DataFrame:
    o = dealt(ds["silver_orders"].select("order_id", "customer_id", "order_date"), ds.parts("orders"), "order_id")
    pay = _success_by_order(ds)
    # payments -> order (1 row per order) -> customer; no N:M fan-out
    per = o.join(pay, "order_id", "left").groupBy("customer_id").agg(
        F.count("order_id").alias("number_of_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.sum("amount_paid").alias("__ltv"),
    )
    c = ds["silver_customers"]
    ltv = dec0(F.round(F.col("__ltv"), 2).cast(MONEY))
    return c.join(per, "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "email", "country", "created_date",
        F.coalesce("number_of_orders", F.lit(0).cast("bigint")).alias("number_of_orders"),
        "first_order_date", "most_recent_order_date",
        ltv.alias("total_lifetime_value"),
        segment(ltv, VALUE_BANDS, VALUE_DEFAULT).alias("customer_segment"),
    )


@model("gold_fct_orders", "pipeline", materialized="table")
def gold_fct_orders(ds: Datasets) -> DataFrame:
    parts = ds.parts("orders")
    o = dealt(ds["silver_orders"], parts, "order_id")
    items = dealt(ds["silver_order_items"].groupBy("order_id").agg(
        F.count("order_item_id").alias("number_of_items"),
        F.sum("line_total").alias("items_total")), parts, "order_id")
    pay = _success_by_order(ds)
    return o.join(items, "order_id", "left").join(pay, "order_id", "left").select(
        "order_id", "customer_id", "status", "order_date", "amount",
        F.coalesce("number_of_items", F.lit(0).cast("bigint")).alias("number_of_items"),
        dec0(F.col("items_total").cast(MONEY)).alias("items_total"),
        dec0(F.col("amount_paid").cast(MONEY)).alias("amount_paid"),
        "payment_method",
    )


@model("gold_fct_revenue", "pipeline", materialized="table")
def gold_fct_revenue(ds: Datasets) -> DataFrame:
    o = ds["gold_fct_orders"].filter(F.col("status") == "completed")
    return o.groupBy("order_date",
                     F.date_format("order_date", "yyyy-MM").alias("revenue_month")).agg(
        F.sum("amount_paid").cast(MONEY).alias("daily_revenue"),
        F.count("order_id").alias("number_of_orders"),
        round_half_up_ratio(F.sum("amount_paid"), F.count("amount_paid"), 2).cast(MONEY)
        .alias("avg_order_value"),
    )


# -- marketing consumer pipeline (rule set B) ------------------------------------

def _segments_b(ds: Datasets, sentinel: bool) -> DataFrame:
    c = ds["gold_dim_customers"]
    r = ds["gold_fct_orders"].groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("order_count"))
    days = F.datediff(ds.as_of_col(), F.col("last_order_date"))
    if sentinel:
        days = F.when(F.col("last_order_date").isNotNull(), days) \
            .otherwise(F.lit(NO_ORDER_DAYS_SENTINEL))
    j = c.join(r, "customer_id", "left").withColumn("days_since_last_order", days)
    d, ltv, n = F.col("days_since_last_order"), F.col("total_lifetime_value"), \
        F.col("number_of_orders")
    seg = (
        F.when((ltv >= B_HIGH_LTV) & (d <= B_CHAMPION_DAYS), "champion")
        .when(n >= B_LOYAL_ORDERS, "loyal")
        .when((ltv >= B_MID_LTV) & (d > B_AT_RISK_DAYS), "at_risk")
        .when(d > B_LAPSED_DAYS, "lapsed")
        .when(n == 0, "never_purchased")
        .otherwise("other")
    )
    return j.select("customer_id", "first_name", "last_name", "email", "country",
                    "customer_segment", "total_lifetime_value", "number_of_orders",
                    "last_order_date", "days_since_last_order",
                    seg.alias("marketing_segment"))


@model("marketing_customer_segments", "marketing_pipeline", materialized="table")
def marketing_customer_segments(ds: Datasets) -> DataFrame:
    """SQL variant: no-order customers keep NULL days -> ``never_purchased``."""
    return _segments_b(ds, sentinel=False)


@model("marketing_customer_segments_py", "marketing_pipeline", materialized="table")
def marketing_customer_segments_py(ds: Datasets) -> DataFrame:
    """Python variant: NULL days become 9999, so no-order customers are ``lapsed``."""
    return _segments_b(ds, sentinel=True)


def _completed_with_country(ds: Datasets) -> DataFrame:
    o = ds["gold_fct_orders"].filter(F.col("status") == "completed") \
        .select("order_id", "customer_id", "amount_paid")
    c = ds["gold_dim_customers"].select("customer_id", "country")
    # pre-aggregate completed orders per customer, then a 1:1 join
    per = o.groupBy("customer_id").agg(F.count("order_id").alias("n"),
                                       F.sum("amount_paid").alias("s"))
    return per.join(c, "customer_id", "inner")


@model("marketing_country_performance", "marketing_pipeline", materialized="table")
def marketing_country_performance(ds: Datasets) -> DataFrame:
    """SQL variant: ``active_customers`` counts distinct customers."""
    j = _completed_with_country(ds)
    total = F.sum("s")
    return j.groupBy("country").agg(
        F.sum("n").alias("total_orders"),
        F.round(total, 2).cast(MONEY).alias("total_revenue"),
        round_half_up_ratio(total, F.sum("n"), 2).cast(MONEY).alias("avg_order_value"),
        F.count("customer_id").alias("active_customers"),
        round_half_up_ratio(total, F.count("customer_id"), 2).cast(MONEY)
        .alias("revenue_per_customer"),
    )


@model("marketing_country_performance_py", "marketing_pipeline", materialized="table")
def marketing_country_performance_py(ds: Datasets) -> DataFrame:
    """Python variant: ``active_customers = count(customer_id)`` counts orders."""
    j = _completed_with_country(ds)
    total = F.sum("s")
    return j.groupBy("country").agg(
        F.sum("n").alias("total_orders"),
        F.round(total, 2).cast(MONEY).alias("total_revenue"),
        round_half_up_ratio(total, F.sum("n"), 2).cast(MONEY).alias("avg_order_value"),
        F.sum("n").alias("active_customers"),
        round_half_up_ratio(F.round(total, 2), F.sum("n"), 2).cast(MONEY)
        .alias("revenue_per_customer"),
    )


# -- finance consumer pipeline ----------------------------------------------------

@model("finance_fct_revenue", "finance_pipeline", materialized="table")
def finance_fct_revenue(ds: Datasets) -> DataFrame:
    o = ds["gold_fct_orders"]
    return o.select(
        "order_id", "order_date", "customer_id", "status", "amount_paid",
        F.when(F.col("status") == "completed", F.col("amount_paid"))
        .otherwise(F.lit(0).cast(MONEY)).alias("recognised_revenue"),
        F.round(F.col("amount_paid") - dec0("items_total"), 2).cast(MONEY)
        .alias("payment_vs_items_delta"),
        F.date_trunc("month", F.col("order_date")).cast("timestamp_ntz").alias("revenue_month"),
    )


@model("finance_fct_revenue_by_product", "finance_pipeline", materialized="table")
def finance_fct_revenue_by_product(ds: Datasets) -> DataFrame:
    """Completed orders x products, grouped by (category, product_name).

    Every product row sees the same completed orders, so the orders side is
    reduced to one row (broadcast, one-row bound) and a group holding ``k``
    products scales it by ``k``; the cross product is never built. Without a
    completed order the product is empty, so is the result.
    """
    o = ds["gold_fct_orders"].filter(F.col("status") == "completed")
    t = o.agg(F.count("order_id").alias("n"), F.sum("amount_paid").alias("s"),
              F.count("amount_paid").alias("c")).filter("n > 0")
    p = ds["silver_products"].groupBy("category", "product_name").agg(
        F.count(F.lit(1)).alias("k"))
    return p.crossJoin(F.broadcast(t)).select(
        "category", "product_name",
        (F.col("k") * F.col("n")).alias("total_orders"),
        F.round(F.col("s") * F.col("k"), 2).cast(MONEY).alias("total_revenue"),
        round_half_up_ratio(F.col("s"), F.col("c"), 2).cast(MONEY).alias("avg_order_value"),
    )


# -- data-science consumer pipeline (same feature logic on gold) -------------------

@model("ds_rfm_customer_features", "ds_pipeline", materialized="table")
def ds_rfm_customer_features(ds: Datasets) -> DataFrame:
    return rfm_features(ds["gold_dim_customers"], ds["gold_fct_orders"], ds.as_of_col())


@model("ds_customer_churn_features", "ds_pipeline", materialized="table")
def ds_customer_churn_features(ds: Datasets) -> DataFrame:
    return churn_features(ds["gold_dim_customers"], ds["gold_fct_orders"], ds.as_of_col(),
                          ds.parts("orders"))
