"""Contracts of the public platform marts and the cross-project ``ref``.

Consumer projects read platform marts only through :func:`public`, which
checks the declared columns and types on ``df.schema`` at analysis time (no
Spark job) and applies lossless widenings, so a breaking change in a mart
fails every consumer before anything runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.quality import Contract
from ledgerloom.sources.datasets import Datasets

# --- fixed values: contracted marts (ids widened to bigint: driver keys are bigint) --
CONTRACTS = [
    Contract("dim_customers", {
        "customer_id": "bigint", "first_name": "string", "last_name": "string",
        "email": "string", "created_date": "date", "country": "string",
        "number_of_orders": "bigint", "total_lifetime_value": "decimal(18,2)",
        "first_order_date": "date", "most_recent_order_date": "date",
        "customer_segment": "string"}, not_null=("customer_id", "email"),
        primary_key="customer_id"),
    Contract("dim_products", {
        "product_id": "bigint", "product_name": "string", "category": "string",
        "unit_price": "decimal(18,2)", "is_active": "boolean"},
        not_null=("product_id", "product_name"), primary_key="product_id"),
    Contract("fct_orders", {
        "order_id": "bigint", "customer_id": "bigint", "order_date": "date",
        "status": "string", "payment_method": "string", "number_of_items": "bigint",
        "items_total": "decimal(18,2)", "amount_paid": "decimal(18,2)"},
        not_null=("order_id", "customer_id", "order_date", "amount_paid"),
        primary_key="order_id"),
    Contract("dim_accounts", {
        "account_id": "string", "account_name": "string", "account_type": "string",
        "industry": "string", "annual_revenue": "decimal(18,2)",
        "number_of_employees": "bigint", "billing_country": "string", "owner_id": "string",
        "account_owner": "string", "created_date": "date"},
        not_null=("account_id",), primary_key="account_id"),
    Contract("fct_opportunities", {
        "opportunity_id": "string", "account_id": "string", "account_name": "string",
        "opportunity_name": "string", "stage_name": "string", "amount": "decimal(18,2)",
        "close_date": "date", "probability": "decimal(5,2)", "is_closed": "boolean",
        "is_won": "boolean", "opportunity_type": "string", "lead_source": "string",
        "owner_id": "string", "opportunity_owner": "string",
        "weighted_amount": "decimal(18,2)", "created_date": "date"},
        not_null=("opportunity_id",), primary_key="opportunity_id"),
    Contract("crm_opportunity_alerts", {
        "opportunity_id": "string", "account_id": "string", "account_name": "string",
        "opportunity_name": "string", "opportunity_owner": "string", "stage_name": "string",
        "amount": "decimal(18,2)", "close_date": "date", "alert_reason": "string"},
        not_null=("opportunity_id",), primary_key="opportunity_id"),
]


_BY_MODEL = {c.model: c for c in CONTRACTS}


def public(ds: Datasets, name: str, project: str = "platform") -> DataFrame:
    """``ref(project, name)`` of a contracted mart, schema-checked."""
    c = _BY_MODEL[name]
    return ds.ref(project, name, dict(c.columns))
