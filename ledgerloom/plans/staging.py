"""Staging models: rename, cast, normalise case. One projection each.

Projections stay narrow so column pruning reaches the parquet scan; the
``lower``/``upper`` normalisation is the only per-row work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.datasets import Datasets, model


@model("stg_customers")
def stg_customers(ds: Datasets) -> DataFrame:
    return ds["raw_customers"].select(
        "customer_id", "first_name", "last_name",
        F.lower("email").alias("email"),
        F.col("created_at").cast("date").alias("created_date"),
        F.upper("country").alias("country"),
    )


@model("stg_orders")
def stg_orders(ds: Datasets) -> DataFrame:
    return ds["raw_orders"].select(
        "order_id", "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.lower("status").alias("status"),
        "amount",
        F.lower("payment_method").alias("payment_method"),
    )


@model("stg_order_items")
def stg_order_items(ds: Datasets) -> DataFrame:
    return ds["raw_order_items"].select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
    )


@model("stg_products")
def stg_products(ds: Datasets) -> DataFrame:
    return ds["raw_products"].select(
        "product_id", "product_name",
        F.lower("category").alias("category"),
        "unit_price",
        F.col("is_active").cast("boolean").alias("is_active"),
    )


@model("stg_payments")
def stg_payments(ds: Datasets) -> DataFrame:
    return ds["raw_payments"].select(
        "payment_id", "order_id",
        F.lower("payment_method").alias("payment_method"),
        "amount",
        F.lower("status").alias("payment_status"),
        F.col("payment_date").cast("date").alias("payment_date"),
    )


def soft_delete_filter(df: DataFrame, flag: str = "_fivetran_deleted") -> DataFrame:
    """Keep rows whose soft-delete flag is false or NULL."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


@model("stg_crm_accounts")
def stg_crm_accounts(ds: Datasets) -> DataFrame:
    return soft_delete_filter(ds["sf_account"]).select(
        F.col("id").alias("account_id"),
        F.col("name").alias("account_name"),
        F.col("type").alias("account_type"),
        "industry",
        F.col("annual_revenue").cast("decimal(18,2)").alias("annual_revenue"),
        F.col("number_of_employees").cast("bigint").alias("number_of_employees"),
        F.upper("billing_country").alias("billing_country"),
        "owner_id",
        F.col("created_date").cast("date").alias("created_date"),
    )


@model("stg_crm_contacts")
def stg_crm_contacts(ds: Datasets) -> DataFrame:
    return soft_delete_filter(ds["sf_contact"]).select(
        F.col("id").alias("contact_id"),
        "account_id", "first_name", "last_name",
        F.lower("email").alias("email"),
        "title", "owner_id",
        F.col("created_date").cast("date").alias("created_date"),
    )


@model("stg_crm_opportunities")
def stg_crm_opportunities(ds: Datasets) -> DataFrame:
    return soft_delete_filter(ds["sf_opportunity"]).select(
        F.col("id").alias("opportunity_id"),
        "account_id",
        F.col("name").alias("opportunity_name"),
        "stage_name",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.col("close_date").cast("date").alias("close_date"),
        F.col("probability").cast("decimal(5,2)").alias("probability"),
        F.coalesce("is_closed", F.lit(False)).alias("is_closed"),
        F.coalesce("is_won", F.lit(False)).alias("is_won"),
        F.col("type").alias("opportunity_type"),
        "lead_source", "owner_id",
        F.col("created_date").cast("date").alias("created_date"),
    )


@model("stg_crm_users")
def stg_crm_users(ds: Datasets) -> DataFrame:
    return soft_delete_filter(ds["sf_user"]).select(
        F.col("id").alias("user_id"),
        F.col("name").alias("user_name"),
        F.lower("email").alias("email"),
        F.coalesce("is_active", F.lit(False)).alias("is_active"),
    )
