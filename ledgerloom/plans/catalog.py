"""Name -> query registry used by the driver entry point and the bench.

Models are looked up in the :class:`Datasets` registry; analytic queries,
metrics and data checks are functions of the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerloom import oracle
from ledgerloom.sources.datasets import Datasets

Query = Callable[[Datasets], DataFrame]

MODEL_QUERIES = [
    # staging
    "stg_customers", "stg_orders", "stg_order_items", "stg_products", "stg_payments",
    "stg_crm_accounts", "stg_crm_contacts", "stg_crm_opportunities", "stg_crm_users",
    # platform marts
    "int_customer_orders", "int_order_items_enriched", "dim_customers", "dim_products",
    "fct_orders", "dim_accounts", "fct_opportunities", "crm_opportunity_alerts",
    # consumers
    "mart_customer_segments", "mart_country_performance",
    "mart_country_performance_per_customer", "fct_revenue", "fct_revenue_by_product",
    "revenue_by_product_lines", "stg_customer_order_history", "rfm_customer_features",
    "customer_churn_features", "payment_method_affinity_pairs",
    # medallion pipeline
    "bronze_customers", "bronze_orders", "bronze_order_items", "bronze_products",
    "bronze_payments", "silver_customers", "silver_orders", "silver_order_items",
    "silver_products", "silver_payments", "gold_dim_customers", "gold_fct_orders",
    "gold_fct_revenue", "marketing_customer_segments", "marketing_customer_segments_py",
    "marketing_country_performance", "marketing_country_performance_py",
    "finance_fct_revenue", "finance_fct_revenue_by_product", "ds_rfm_customer_features",
    "ds_customer_churn_features",
]


def _model(name: str) -> Query:
    def run(ds: Datasets) -> DataFrame:
        return ds.build(name)
    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {name: _model(name) for name in MODEL_QUERIES}
ORACLE: dict[str, str] = {name: oracle.table(name) for name in MODEL_QUERIES}


def register(name: str, sql: str | None = None):
    """Decorator for analytic queries: ``fn(ds) -> DataFrame`` (+ oracle SQL)."""

    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle.sql(sql)
        return fn

    return deco


def oracle_statements() -> dict[str, str]:
    _load()
    return dict(ORACLE)


def _load() -> None:
    from ledgerloom.plans import analytics, checks, increments  # noqa: F401  (register queries)


# the query modules register into QUERIES/ORACLE on import (they import
# ``register`` from this module, which is defined above)
_load()
