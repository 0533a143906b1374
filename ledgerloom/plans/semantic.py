"""Governed metric definitions and metric views.

Definitions are data (names, aggregations, expressions, filters); evaluation
lives in :mod:`ledgerloom.operators.metrics`.
"""

from __future__ import annotations

from ledgerloom.operators.metrics import Metric, MetricRegistry, MetricView, SemanticModel

# --- fixed values: semantic models and their links ----------------------------
MODELS = [
    SemanticModel("dim_customers", "customer_id", time_dimension="created_date"),
    SemanticModel("dim_products", "product_id",
                  dimension_exprs={"is_active": "cast(is_active as string)"}),
    SemanticModel("fct_orders", "order_id", time_dimension="order_date",
                  links={"dim_customers": ("customer_id", "customer_id")}),
    SemanticModel("fct_opportunities", "opportunity_id", time_dimension="close_date",
                  links={"dim_accounts": ("account_id", "account_id")}),
    SemanticModel("opportunity_states", "opportunity_id", time_dimension="state_date",
                  links={"dim_accounts": ("account_id", "account_id")}),
]

COMPLETED = "status = 'completed'"

# --- fixed values: metric definitions ------------------------------------------
METRICS = [
    # customers
    Metric("total_customers", "dim_customers", agg="count_distinct", expr="customer_id",
           label="Total Customers"),
    Metric("avg_customer_lifetime_value", "dim_customers", agg="average",
           expr="total_lifetime_value", label="Average Customer Lifetime Value (USD)"),
    Metric("total_lifetime_value", "dim_customers", agg="sum", expr="total_lifetime_value",
           hidden=True),
    Metric("total_orders_per_customer", "dim_customers", agg="sum", expr="number_of_orders",
           hidden=True),
    # products
    Metric("total_products", "dim_products", agg="count_distinct", expr="product_id",
           label="Total Products"),
    Metric("avg_product_price", "dim_products", agg="average", expr="unit_price",
           label="Average Product Price (USD)"),
    # orders
    Metric("total_revenue", "fct_orders", agg="sum", expr="amount_paid",
           label="Total Revenue (USD)"),
    Metric("total_recognised_revenue", "fct_orders", agg="sum", expr="amount_paid",
           filter=COMPLETED, label="Total Recognised Revenue (USD)"),
    Metric("avg_order_value", "fct_orders", agg="average", expr="amount_paid",
           label="Average Order Value (USD)"),
    Metric("total_orders", "fct_orders", agg="count_distinct", expr="order_id",
           label="Total Orders"),
    Metric("completed_orders", "fct_orders", agg="count_distinct",
           expr="case when status = 'completed' then order_id end", label="Completed Orders"),
    Metric("total_items_sold", "fct_orders", agg="sum", expr="number_of_items",
           label="Total Items Sold"),
    Metric("return_flag", "fct_orders", agg="sum",
           expr="case when status = 'returned' then 1 else 0 end", hidden=True),
    # cross-model
    Metric("return_rate", "fct_orders", type="ratio",
           numerator=Metric("returned_orders", "fct_orders", agg="count_distinct",
                            expr="order_id", filter="status = 'returned'"),
           denominator="total_orders", label="Order Return Rate"),
    Metric("revenue_per_customer", "fct_orders", type="derived",
           inputs=("total_recognised_revenue", "total_customers"),
           derived="total_recognised_revenue / total_customers",
           label="Revenue per Customer (USD)"),
    # CRM
    Metric("open_pipeline_amount", "fct_opportunities", agg="sum", expr="amount",
           filter="is_closed = false", label="Open Pipeline (USD)"),
    Metric("weighted_pipeline_amount", "fct_opportunities", agg="sum", expr="weighted_amount",
           filter="is_closed = false", label="Weighted Pipeline (USD)"),
    Metric("won_amount", "fct_opportunities", agg="sum", expr="amount",
           filter="is_won = true", label="Won Amount (USD)"),
    Metric("opportunity_count", "fct_opportunities", agg="count_distinct",
           expr="opportunity_id", label="Opportunities"),
    Metric("won_count", "fct_opportunities", agg="count_distinct", expr="opportunity_id",
           filter="is_won = true", hidden=True),
    Metric("closed_count", "fct_opportunities", agg="count_distinct", expr="opportunity_id",
           filter="is_closed = true", hidden=True),
    Metric("avg_deal_size", "fct_opportunities", agg="average", expr="amount",
           filter="is_won = true", label="Average Won Deal Size (USD)"),
    Metric("win_rate", "fct_opportunities", type="ratio", numerator="won_count",
           denominator="closed_count", label="Win Rate"),
]
# ------------------------------------------------------------------------------

# metrics over time: windows, balances and conversions
TIMED_METRICS = [
    Metric("active_customers_90d", "fct_orders", type="cumulative", agg="count_distinct",
           expr="customer_id", window_days=90, label="Active Customers (90 days)"),
    Metric("customers_to_date", "fct_orders", type="cumulative", agg="count_distinct",
           expr="customer_id", label="Customers to Date"),
    Metric("cumulative_revenue", "fct_orders", type="cumulative", agg="sum", expr="amount_paid",
           filter=COMPLETED, label="Recognised Revenue to Date (USD)"),
    Metric("trailing_revenue_28d", "fct_orders", type="cumulative", agg="sum", expr="amount_paid",
           filter=COMPLETED, window_days=28, label="Recognised Revenue, 28 Days (USD)"),
    Metric("open_pipeline_balance", "opportunity_states", type="semi_additive", agg="sum",
           expr="open_amount", entity="opportunity_id", order=("state_order",),
           label="Open Pipeline at Period End (USD)"),
    Metric("repeat_purchase_30d", "fct_orders", type="conversion", entity="customer_id",
           window_days=30, label="Repeat Purchase Rate (30 days)"),
    Metric("return_after_purchase_60d", "fct_orders", type="conversion", entity="customer_id",
           window_days=60, filter=COMPLETED, conversion="status = 'returned'",
           label="Return after a Completed Purchase (60 days)"),
    Metric("recognised_revenue_before", "fct_orders", type="offset",
           inputs=("total_recognised_revenue",), label="Recognised Revenue, Period before (USD)"),
    Metric("recognised_revenue_growth", "fct_orders", type="derived",
           inputs=("total_recognised_revenue", "recognised_revenue_before"),
           derived="(total_recognised_revenue - recognised_revenue_before) / recognised_revenue_before",
           label="Recognised Revenue Growth"),
    Metric("active_customers_90d_year_before", "fct_orders", type="offset", periods=12,
           inputs=("active_customers_90d",), label="Active Customers (90 days), Year before"),
]

# --- fixed values: metric view definitions (formats and synonyms included) -------
ORDERS_METRIC_VIEW_YAML = """
version: 1.1
source: fct_orders
comment: E-commerce order metrics over the contracted order fact.
dimensions:
  - name: order_date
    expr: order_date
    display_name: Order Date
    format: {type: date, date_format: year_month_day, leading_zeros: true}
    synonyms: [date, when ordered, order day]
  - name: status
    expr: status
    display_name: Order Status
    comment: "Valid values: placed, shipped, completed, returned"
    synonyms: [order status, fulfillment status, state]
  - name: payment_method
    expr: payment_method
    display_name: Payment Method
    synonyms: [how paid, payment type, tender]
measures:
  - name: total_revenue
    expr: SUM(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END)
    display_name: Total Revenue
    comment: Sum of amount_paid for completed orders only.
    format: {type: currency, currency_code: USD, decimal_places: {type: exact, places: 2},
             hide_group_separator: false, abbreviation: compact}
    synonyms: [revenue, total sales, recognised revenue, sales]
  - name: avg_order_value
    expr: AVG(CASE WHEN status = 'completed' THEN amount_paid END)
    display_name: Average Order Value
    comment: Average payment amount for completed orders only.
    format: {type: currency, currency_code: USD, decimal_places: {type: exact, places: 2},
             hide_group_separator: false}
    synonyms: [aov, average revenue per order, average basket]
  - name: total_orders
    expr: COUNT(DISTINCT order_id)
    display_name: Total Orders
    comment: Count of all orders regardless of status.
    format: {type: number, decimal_places: {type: all}, hide_group_separator: false}
    synonyms: [order count, number of orders, orders]
  - name: return_rate
    expr: >
      COUNT(DISTINCT CASE WHEN status = 'returned' THEN order_id END)
      / CAST(COUNT(DISTINCT order_id) AS DOUBLE) * 100
    display_name: Return Rate (%)
    comment: Percentage of orders that were returned.
    format: {type: percentage, decimal_places: {type: exact, places: 1}, hide_group_separator: true}
    synonyms: [returns, refund rate, percentage returned, churn]
"""

CUSTOMERS_METRIC_VIEW_YAML = """
version: 1.1
source: dim_customers
comment: Customer metrics over the customer dimension.
dimensions:
  - name: country
    expr: country
    display_name: Country
    synonyms: [region, location, market]
  - name: customer_segment
    expr: customer_segment
    display_name: Customer Segment
    comment: "high_value: >= $500 LTV | mid_value: $100-$499 | low_value: < $100."
    synonyms: [segment, tier, value tier, customer tier]
  - name: created_date
    expr: created_date
    display_name: Customer Since
    format: {type: date, date_format: year_month_day, leading_zeros: true}
    synonyms: [signup date, acquisition date, join date]
measures:
  - name: customer_count
    expr: COUNT(DISTINCT customer_id)
    display_name: Total Customers
    comment: Count of distinct customers.
    format: {type: number, decimal_places: {type: all}, hide_group_separator: false}
    synonyms: [customers, number of customers, unique customers, user count]
  - name: avg_lifetime_value
    expr: AVG(total_lifetime_value)
    display_name: Average Lifetime Value
    comment: Average total_lifetime_value across all customers.
    format: {type: currency, currency_code: USD, decimal_places: {type: exact, places: 2},
             hide_group_separator: false}
    synonyms: [avg ltv, average clv, customer value, lifetime value]
  - name: high_value_customers
    expr: COUNT(DISTINCT CASE WHEN customer_segment = 'high_value' THEN customer_id END)
    display_name: High Value Customers
    comment: Count of customers with total_lifetime_value >= $500.
    format: {type: number, decimal_places: {type: all}}
    synonyms: [vip customers, top customers, premium customers]
"""
# ------------------------------------------------------------------------------

ORDERS_VIEW = MetricView.from_yaml(ORDERS_METRIC_VIEW_YAML, "order_id")
CUSTOMERS_VIEW = MetricView.from_yaml(CUSTOMERS_METRIC_VIEW_YAML, "customer_id")

# --- fixed values: dashboard metric explorer (5 metrics x 3 breakdowns) ----------------
# The dashboard's average order value and return rate are completed-only and percent,
# unlike the semantic-layer metrics of the same name; they are kept as separate metrics.
# The completed-only metrics are requested with a row filter (``where``), as the
# dashboard does, so periods without completed orders do not appear at all.
APP_METRICS = [
    Metric("app_recognised_revenue", "fct_orders", agg="sum", expr="amount_paid"),
    Metric("app_avg_order_value", "fct_orders", agg="average", expr="amount_paid"),
    Metric("app_returned_orders", "fct_orders", agg="count_distinct", expr="order_id",
           filter="status = 'returned'", hidden=True),
    Metric("app_return_rate_pct", "fct_orders", type="derived",
           inputs=("app_returned_orders", "total_orders"),
           derived="app_returned_orders / total_orders * 100"),
    Metric("app_total_customers", "dim_customers", agg="count_distinct", expr="customer_id"),
    Metric("app_avg_lifetime_value", "dim_customers", agg="average",
           expr="total_lifetime_value"),
]
APP_WHERE = {"app_recognised_revenue": COMPLETED, "app_avg_order_value": COMPLETED}
# metric -> breakdown -> dimension (or "month" for the model's time grain)
APP_BREAKDOWNS = {
    "app_recognised_revenue": {"by_month": "month", "by_segment": "customer_segment",
                               "by_payment_method": "payment_method"},
    "app_avg_order_value": {"by_month": "month", "by_segment": "customer_segment",
                            "by_payment_method": "payment_method"},
    "app_return_rate_pct": {"by_month": "month", "by_segment": "customer_segment",
                            "by_payment_method": "payment_method"},
    "app_total_customers": {"by_month": "month", "by_segment": "customer_segment",
                            "by_country": "country"},
    "app_avg_lifetime_value": {"by_month": "month", "by_segment": "customer_segment",
                               "by_country": "country"},
}
# ------------------------------------------------------------------------------------

REGISTRY = MetricRegistry(MODELS, METRICS + TIMED_METRICS + APP_METRICS)
