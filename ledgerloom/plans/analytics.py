"""Dashboard queries, canonical business questions and metric requests.

Each query is ``fn(ds) -> DataFrame`` registered with its DuckDB oracle
statement. Relative periods ("last month", "this quarter") are computed from
``ds.as_of``; the oracle pins the same as-of date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, avg_exact, ratio
from ledgerloom.operators.metrics import query_metrics
from ledgerloom.operators.periods import period_growth, windowed_totals
from ledgerloom.operators.topk import top_k
from ledgerloom.oracle import AS_OF, avg_x, rnd
from ledgerloom.plans.catalog import register
from ledgerloom.plans.marketing import customer_order_rollup
from ledgerloom.plans.semantic import CUSTOMERS_VIEW, ORDERS_VIEW, REGISTRY
from ledgerloom.sources.datasets import Datasets

# --- fixed values: business rules of the canonical questions ----------------------
AT_RISK_DAYS = 90
CHURNED_DAYS = 180
TOP_PRODUCTS = 10
TOP_LINE_PRODUCTS = 3
TOP_ACCOUNTS = 10
# ------------------------------------------------------------------------------

def _completed():
    return F.col("status") == "completed"


def _returned():
    return F.col("status") == "returned"


def _segment_rollup(ds: Datasets, dim: str) -> DataFrame:
    """dim_customers LEFT JOIN fct_orders grouped by a customer attribute,
    with orders first reduced to one row per customer (no fan-out, hot
    customers combined map-side)."""
    c = ds["dim_customers"].select("customer_id", dim)
    r = customer_order_rollup(ds).select("customer_id", "recognised")
    return c.join(r, "customer_id", "left").groupBy(dim).agg(
        F.coalesce(F.sum("recognised"), F.lit(0)).cast(MONEY).alias("revenue"))


# ------------------------------------------------------------ executive tab ---

@register("exec_kpis", """
WITH by_status AS (SELECT lower(status) AS st, count(*) AS n, sum(received) AS v
                   FROM raw_orders LEFT JOIN order_money USING (order_id) GROUP BY 1)
SELECT CAST(coalesce(sum(v) FILTER (WHERE st = 'completed'), 0) AS DECIMAL(18,2)) AS total_revenue,
       CAST(sum(n) AS BIGINT) AS total_orders,
       CAST(coalesce(sum(n) FILTER (WHERE st = 'completed'), 0) AS BIGINT) AS completed_orders,
       CAST(coalesce(sum(n) FILTER (WHERE st = 'returned'), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100
           AS return_rate
FROM by_status""")
def exec_kpis(ds: Datasets) -> DataFrame:
    # order_id is the key of fct_orders: distinct counts are plain counts
    o = ds["fct_orders"]
    return o.agg(
        F.sum(F.when(_completed(), F.col("amount_paid")).otherwise(F.lit(0))).cast(MONEY)
        .alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.count(F.when(_completed(), F.col("order_id"))).alias("completed_orders"),
        (F.count(F.when(_returned(), F.col("order_id"))).cast("double")
         / F.count("order_id").cast("double") * 100).alias("return_rate"),
    )


@register("revenue_by_segment", """
SELECT customer_segment, CAST(coalesce(sum(recognised), 0) AS DECIMAL(18,2)) AS revenue
FROM dim_customers LEFT JOIN customer_totals USING (customer_id) GROUP BY customer_segment""")
def revenue_by_segment(ds: Datasets) -> DataFrame:
    return _segment_rollup(ds, "customer_segment")


@register("revenue_by_country", """
SELECT country, CAST(coalesce(sum(recognised), 0) AS DECIMAL(18,2)) AS revenue
FROM dim_customers LEFT JOIN customer_totals USING (customer_id) GROUP BY country""")
def revenue_by_country(ds: Datasets) -> DataFrame:
    return _segment_rollup(ds, "country")


@register("customers_by_segment", """
SELECT customer_segment, count(*) AS customers FROM dim_customers GROUP BY customer_segment""")
def customers_by_segment(ds: Datasets) -> DataFrame:
    return ds["dim_customers"].groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"))


@register("top_products", f"""
WITH t AS (SELECT count(DISTINCT order_id) AS n,
                  sum(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END) AS s
           FROM fct_orders),
p AS (SELECT product_name, category, unit_price, count(*) AS k FROM dim_products GROUP BY ALL)
SELECT p.product_name, p.category, p.unit_price, t.n AS order_count,
       CAST(coalesce(t.s, 0) * p.k AS DECIMAL(18,2)) AS revenue
FROM p CROSS JOIN t
ORDER BY order_count DESC, revenue DESC, product_name, category, unit_price
LIMIT {TOP_PRODUCTS}""")
def top_products(ds: Datasets) -> DataFrame:
    """Dashboard top-10 over the products x orders cross join (every product sees
    every order). Orders collapse to one broadcast row; a (name, category, price)
    group of ``k`` products counts each order ``k`` times in the revenue sum."""
    t = ds["fct_orders"].agg(
        F.count("order_id").alias("order_count"),
        F.sum(F.when(_completed(), F.col("amount_paid")).otherwise(F.lit(0))).alias("s"))
    p = ds["dim_products"].groupBy("product_name", "category", "unit_price") \
        .agg(F.count(F.lit(1)).alias("k"))
    j = p.crossJoin(F.broadcast(t)).select(
        "product_name", "category", "unit_price", "order_count",
        (F.coalesce(F.col("s"), F.lit(0)) * F.col("k")).cast(MONEY).alias("revenue"))
    return top_k(j, ["order_count", "revenue"], TOP_PRODUCTS,
                 tiebreak=["product_name", "category", "unit_price"])


@register("top_products_by_line_revenue", f"""
SELECT product_id, product_name, category, recognised_revenue
FROM revenue_by_product_lines
ORDER BY recognised_revenue DESC, product_id LIMIT {TOP_LINE_PRODUCTS}""")
def top_products_by_line_revenue(ds: Datasets) -> DataFrame:
    r = ds["revenue_by_product_lines"].select("product_id", "product_name", "category",
                                              "recognised_revenue")
    return top_k(r, ["recognised_revenue"], TOP_LINE_PRODUCTS, tiebreak=["product_id"])


# ------------------------------------------------------- canonical questions ---

@register("revenue_last_month", f"""
SELECT CAST(date_trunc('month', {AS_OF} - INTERVAL 1 MONTH) AS DATE) AS period_start,
       CAST(sum(amount_paid) AS DECIMAL(18,2)) AS recognised_revenue,
       count(*) AS completed_orders
FROM fct_orders
WHERE status = 'completed'
  AND order_date >= CAST(date_trunc('month', {AS_OF} - INTERVAL 1 MONTH) AS DATE)
  AND order_date < CAST(date_trunc('month', {AS_OF}) AS DATE)""")
def revenue_last_month(ds: Datasets) -> DataFrame:
    start = F.trunc(F.add_months(ds.as_of_col(), -1), "month")
    end = F.trunc(ds.as_of_col(), "month")
    o = ds["fct_orders"].filter(_completed() & (F.col("order_date") >= start)
                                & (F.col("order_date") < end))
    return o.agg(F.sum("amount_paid").cast(MONEY).alias("recognised_revenue"),
                 F.count(F.lit(1)).alias("completed_orders")) \
        .select(start.alias("period_start"), "recognised_revenue", "completed_orders")


@register("return_rate", """
SELECT CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
       / CAST(count(DISTINCT order_id) AS DOUBLE) AS return_rate
FROM fct_orders""")
def return_rate(ds: Datasets) -> DataFrame:
    """Semantic ratio metric (a fraction; the metric view reports percent)."""
    return query_metrics(ds, REGISTRY, ["return_rate"])


_GROWTH_SQL = """
WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS period,
                  sum(amount_paid) AS recognised_revenue
           FROM fct_orders WHERE status = 'completed' GROUP BY 1)
SELECT a.period, a.recognised_revenue, b.recognised_revenue AS prev_recognised_revenue,
       a.recognised_revenue - b.recognised_revenue AS change,
       CAST(a.recognised_revenue - b.recognised_revenue AS DOUBLE)
           / CAST(nullif(b.recognised_revenue, 0) AS DOUBLE) * 100 AS growth_pct
FROM m a LEFT JOIN m b ON a.period = CAST(b.period + INTERVAL {n} MONTH AS DATE)"""


@register("revenue_mom_growth", _GROWTH_SQL.format(n=1))
def revenue_mom_growth(ds: Datasets) -> DataFrame:
    o = ds["fct_orders"].filter(_completed())
    return period_growth(o, "order_date", "amount_paid", "month", 1, name="recognised_revenue")


@register("revenue_yoy", _GROWTH_SQL.format(n=12))
def revenue_yoy(ds: Datasets) -> DataFrame:
    o = ds["fct_orders"].filter(_completed())
    return period_growth(o, "order_date", "amount_paid", "month", 12, name="recognised_revenue")


_WINDOWED_SQL = """
WITH m AS (
  SELECT lower(payment_method) AS payment_method, make_date(year(order_date), month(order_date), 1) AS period,
         sum(coalesce(received, 0)) AS recognised_revenue
  FROM raw_orders LEFT JOIN order_money USING (order_id) WHERE status = 'COMPLETED' GROUP BY 1, 2)
SELECT a.payment_method, a.period, any_value(a.recognised_revenue) AS recognised_revenue,
       sum(b.recognised_revenue) AS windowed
FROM m a JOIN m b ON a.payment_method = b.payment_method AND b.period <= a.period
  {condition}
GROUP BY a.payment_method, a.period"""


def _windowed_revenue(ds: Datasets, trailing: int | None) -> DataFrame:
    o = ds["fct_orders"].filter(_completed())
    return windowed_totals(o, "order_date", "amount_paid", "month", ["payment_method"], trailing,
                           name="recognised_revenue")


@register("metric_cumulative_revenue", _WINDOWED_SQL.format(condition=""))
def metric_cumulative_revenue(ds: Datasets) -> DataFrame:
    """Recognised revenue to date, by month and payment method."""
    return _windowed_revenue(ds, None)


@register("metric_trailing_quarter_revenue", _WINDOWED_SQL.format(
    condition="AND b.period > a.period - INTERVAL 3 MONTH"))
def metric_trailing_quarter_revenue(ds: Datasets) -> DataFrame:
    """Recognised revenue of the month and the two before it, by payment method."""
    return _windowed_revenue(ds, 3)


def _inactive(ds: Datasets, days: int) -> DataFrame:
    c = ds["dim_customers"]
    d = F.datediff(ds.as_of_col(), F.col("most_recent_order_date"))
    return c.filter(d > days).select(
        "customer_id", "first_name", "last_name", "country", "customer_segment",
        "total_lifetime_value", "most_recent_order_date", d.alias("days_since_last_order"))


_INACTIVE_SQL = f"""
SELECT customer_id, first_name, last_name, country, customer_segment, total_lifetime_value,
       most_recent_order_date,
       datediff('day', most_recent_order_date, {AS_OF}) AS days_since_last_order
FROM dim_customers WHERE datediff('day', most_recent_order_date, {AS_OF}) > {{n}}"""


@register("at_risk_customers", _INACTIVE_SQL.format(n=AT_RISK_DAYS))
def at_risk_customers(ds: Datasets) -> DataFrame:
    return _inactive(ds, AT_RISK_DAYS)


@register("churned_customers", _INACTIVE_SQL.format(n=CHURNED_DAYS))
def churned_customers(ds: Datasets) -> DataFrame:
    return _inactive(ds, CHURNED_DAYS)


@register("high_value_customers", """
SELECT customer_id, first_name, last_name, email, country, total_lifetime_value,
       number_of_orders
FROM dim_customers WHERE customer_segment = 'high_value'""")
def high_value_customers(ds: Datasets) -> DataFrame:
    return ds["dim_customers"].filter(F.col("customer_segment") == "high_value").select(
        "customer_id", "first_name", "last_name", "email", "country",
        "total_lifetime_value", "number_of_orders")


@register("returning_customers", """
SELECT customer_id, first_name, last_name, country, number_of_orders
FROM dim_customers WHERE number_of_orders > 1""")
def returning_customers(ds: Datasets) -> DataFrame:
    return ds["dim_customers"].filter(F.col("number_of_orders") > 1).select(
        "customer_id", "first_name", "last_name", "country", "number_of_orders")


@register("high_value_revenue_share", """
WITH r AS (
  SELECT c.customer_segment = 'high_value' AS hv, sum(o.amount_paid) AS rev
  FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
  WHERE o.status = 'completed' GROUP BY 1)
SELECT CAST(coalesce(sum(CASE WHEN hv THEN rev END), 0) AS DECIMAL(18,2))
           AS high_value_revenue,
       CAST(sum(rev) AS DECIMAL(18,2)) AS total_revenue,
       CAST(coalesce(sum(CASE WHEN hv THEN rev END), 0) AS DOUBLE)
           / CAST(sum(rev) AS DOUBLE) * 100 AS high_value_share_pct
FROM r""")
def high_value_revenue_share(ds: Datasets) -> DataFrame:
    """Two-level aggregation: per segment flag, then the share over the tiny result."""
    c = ds["dim_customers"].select("customer_id",
                                   (F.col("customer_segment") == "high_value").alias("hv"))
    r = customer_order_rollup(ds).select("customer_id", "recognised")
    per = r.join(c, "customer_id", "inner").groupBy("hv").agg(F.sum("recognised").alias("rev"))
    hv = F.coalesce(F.sum(F.when(F.col("hv"), F.col("rev"))), F.lit(0))
    return per.agg(
        hv.cast(MONEY).alias("high_value_revenue"),
        F.sum("rev").cast(MONEY).alias("total_revenue"),
        (hv.cast("double") / F.sum("rev").cast("double") * 100).alias("high_value_share_pct"),
    )


@register("product_review_ranking", f"""
SELECT product_id, {avg_x('sum(rating)', 'count(rating)')} AS avg_rating,
       count(*) AS review_count
FROM raw_reviews GROUP BY product_id""")
def product_review_ranking(ds: Datasets) -> DataFrame:
    r = ds["raw_reviews"]
    return r.groupBy("product_id").agg(
        avg_exact(F.sum("rating"), F.count("rating")).alias("avg_rating"),
        F.count(F.lit(1)).alias("review_count"))


@register("return_rate_by_category_high_value", """
WITH oc AS (
  SELECT DISTINCT p.category, o.order_id, o.status
  FROM fct_orders o
  JOIN dim_customers c ON o.customer_id = c.customer_id
  JOIN stg_order_items oi ON oi.order_id = o.order_id
  JOIN dim_products p ON oi.product_id = p.product_id
  WHERE c.customer_segment = 'high_value')
SELECT category, count(*) AS orders,
       count(CASE WHEN status = 'returned' THEN 1 END) AS returned_orders,
       CAST(count(CASE WHEN status = 'returned' THEN 1 END) AS DOUBLE)
           / CAST(count(*) AS DOUBLE) AS return_rate
FROM oc GROUP BY category""")
def return_rate_by_category_high_value(ds: Datasets) -> DataFrame:
    """Orders -> items is 1:N, so orders are counted *distinct* per category:
    the (category, order) pairs are deduplicated first, then counted."""
    hv = ds["dim_customers"].filter(F.col("customer_segment") == "high_value") \
        .select("customer_id")
    o = ds["fct_orders"].select("order_id", "customer_id", "status") \
        .join(hv, "customer_id", "left_semi")
    # items of high-value orders only go on to the products and the deduplication
    items = ds["stg_order_items"].select("order_id", "product_id") \
        .join(o.select("order_id", "status"), "order_id", "inner")
    p = ds["dim_products"].select("product_id", "category")
    oc = items.join(p, "product_id", "inner").select("order_id", "category", "status").distinct()
    returned = F.count(F.when(F.col("status") == "returned", F.lit(1)))
    return oc.groupBy("category").agg(
        F.count(F.lit(1)).alias("orders"),
        returned.alias("returned_orders"),
        (returned.cast("double") / F.count(F.lit(1)).cast("double")).alias("return_rate"))


# ------------------------------------------------------------------------ CRM ---

@register("open_pipeline_by_stage", """
SELECT stage_name, CAST(sum(amount) AS DECIMAL(18,2)) AS open_pipeline_amount,
       CAST(sum(weighted_amount) AS DECIMAL(18,2)) AS weighted_pipeline_amount,
       count(DISTINCT opportunity_id) AS opportunity_count
FROM fct_opportunities WHERE NOT is_closed GROUP BY stage_name""")
def open_pipeline_by_stage(ds: Datasets) -> DataFrame:
    o = ds["fct_opportunities"].filter(~F.col("is_closed"))
    return o.groupBy("stage_name").agg(
        F.sum("amount").cast(MONEY).alias("open_pipeline_amount"),
        F.sum("weighted_amount").cast(MONEY).alias("weighted_pipeline_amount"),
        F.count("opportunity_id").alias("opportunity_count"))


@register("win_rate_by_lead_source", f"""
SELECT lead_source,
       count(DISTINCT CASE WHEN is_won THEN opportunity_id END) AS won_count,
       count(DISTINCT CASE WHEN is_closed THEN opportunity_id END) AS closed_count,
       CAST(count(DISTINCT CASE WHEN is_won THEN opportunity_id END) AS DOUBLE)
           / CAST(nullif(count(DISTINCT CASE WHEN is_closed THEN opportunity_id END), 0)
                  AS DOUBLE) AS win_rate
FROM fct_opportunities
WHERE close_date >= CAST(date_trunc('quarter', {AS_OF}) AS DATE)
  AND close_date < CAST(date_trunc('quarter', {AS_OF}) + INTERVAL 3 MONTH AS DATE)
GROUP BY lead_source""")
def win_rate_by_lead_source(ds: Datasets) -> DataFrame:
    q = F.trunc(ds.as_of_col(), "quarter")
    where = (F.col("close_date") >= q) & (F.col("close_date") < F.add_months(q, 3))
    o = ds["fct_opportunities"].filter(where)
    won = F.count(F.when(F.col("is_won"), F.col("opportunity_id")))
    closed = F.count(F.when(F.col("is_closed"), F.col("opportunity_id")))
    return o.groupBy("lead_source").agg(won.alias("won_count"), closed.alias("closed_count"),
                                        ratio(won, closed).alias("win_rate"))


@register("top_accounts_weighted_pipeline", f"""
SELECT account_id, account_name,
       CAST(sum(weighted_amount) AS DECIMAL(18,2)) AS weighted_pipeline_amount,
       count(*) AS open_opportunities
FROM fct_opportunities WHERE NOT is_closed
GROUP BY account_id, account_name
ORDER BY weighted_pipeline_amount DESC, account_id LIMIT {TOP_ACCOUNTS}""")
def top_accounts_weighted_pipeline(ds: Datasets) -> DataFrame:
    o = ds["fct_opportunities"].filter(~F.col("is_closed"))
    per = o.groupBy("account_id", "account_name").agg(
        F.sum("weighted_amount").cast(MONEY).alias("weighted_pipeline_amount"),
        F.count(F.lit(1)).alias("open_opportunities"))
    return top_k(per, ["weighted_pipeline_amount"], TOP_ACCOUNTS, tiebreak=["account_id"])


@register("recognised_revenue_last_quarter_by_country", f"""
SELECT c.country, CAST(sum(o.amount_paid) AS DECIMAL(18,2)) AS recognised_revenue,
       count(*) AS completed_orders
FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE o.status = 'completed'
  AND o.order_date >= CAST(date_trunc('quarter', {AS_OF}) - INTERVAL 3 MONTH AS DATE)
  AND o.order_date < CAST(date_trunc('quarter', {AS_OF}) AS DATE)
GROUP BY c.country""")
def recognised_revenue_last_quarter_by_country(ds: Datasets) -> DataFrame:
    q = F.trunc(ds.as_of_col(), "quarter")
    o = ds["fct_orders"].filter(_completed() & (F.col("order_date") >= F.add_months(q, -3))
                                & (F.col("order_date") < q))
    per = o.groupBy("customer_id").agg(F.sum("amount_paid").alias("s"),
                                       F.count(F.lit(1)).alias("n"))
    c = ds["dim_customers"].select("customer_id", "country")
    return per.join(c, "customer_id", "inner").groupBy("country").agg(
        F.sum("s").cast(MONEY).alias("recognised_revenue"),
        F.sum("n").alias("completed_orders"))


# -------------------------------------------------------------- metric layer ---

_SIMPLE = ["total_customers", "avg_customer_lifetime_value", "total_lifetime_value",
           "total_orders_per_customer", "total_products", "avg_product_price",
           "total_revenue", "total_recognised_revenue", "avg_order_value", "total_orders",
           "completed_orders", "total_items_sold", "return_flag", "open_pipeline_amount",
           "weighted_pipeline_amount", "won_amount", "opportunity_count", "won_count",
           "closed_count", "avg_deal_size"]


@register("metric_simple", f"""
WITH c AS (SELECT count(DISTINCT customer_id) AS total_customers,
                  {avg_x('sum(total_lifetime_value)', 'count(total_lifetime_value)')}
                      AS avg_customer_lifetime_value,
                  sum(total_lifetime_value) AS total_lifetime_value,
                  sum(number_of_orders) AS total_orders_per_customer
           FROM dim_customers),
p AS (SELECT count(DISTINCT product_id) AS total_products,
             {avg_x('sum(unit_price)', 'count(unit_price)')} AS avg_product_price
      FROM dim_products),
o AS (SELECT sum(amount_paid) AS total_revenue,
             sum(CASE WHEN status = 'completed' THEN amount_paid END) AS total_recognised_revenue,
             {avg_x('sum(amount_paid)', 'count(amount_paid)')} AS avg_order_value,
             count(DISTINCT order_id) AS total_orders,
             count(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders,
             sum(number_of_items) AS total_items_sold,
             sum(CASE WHEN status = 'returned' THEN 1 ELSE 0 END) AS return_flag
      FROM fct_orders),
x AS (SELECT sum(CASE WHEN is_closed = false THEN amount END) AS open_pipeline_amount,
             sum(CASE WHEN is_closed = false THEN weighted_amount END) AS weighted_pipeline_amount,
             sum(CASE WHEN is_won = true THEN amount END) AS won_amount,
             count(DISTINCT opportunity_id) AS opportunity_count,
             count(DISTINCT CASE WHEN is_won = true THEN opportunity_id END) AS won_count,
             count(DISTINCT CASE WHEN is_closed = true THEN opportunity_id END) AS closed_count,
             {avg_x('sum(CASE WHEN is_won = true THEN amount END)',
                    'count(CASE WHEN is_won = true THEN amount END)')} AS avg_deal_size
      FROM fct_opportunities)
SELECT * FROM c CROSS JOIN p CROSS JOIN o CROSS JOIN x""")
def metric_simple(ds: Datasets) -> DataFrame:
    """All simple metrics of four models in one request: one scan per model."""
    return query_metrics(ds, REGISTRY, _SIMPLE)


@register("metric_filtered", """
SELECT payment_method,
       sum(CASE WHEN status = 'completed' THEN amount_paid END) AS total_recognised_revenue,
       count(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders
FROM fct_orders GROUP BY payment_method""")
def metric_filtered(ds: Datasets) -> DataFrame:
    return query_metrics(ds, REGISTRY, ["total_recognised_revenue", "completed_orders"],
                         by=["payment_method"])


@register("metric_by_month", """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS metric_time,
       sum(CASE WHEN status = 'completed' THEN amount_paid END) AS total_recognised_revenue,
       count(DISTINCT order_id) AS total_orders,
       CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
           / CAST(count(DISTINCT order_id) AS DOUBLE) AS return_rate
FROM fct_orders GROUP BY 1""")
def metric_by_month(ds: Datasets) -> DataFrame:
    return query_metrics(ds, REGISTRY, ["total_recognised_revenue", "total_orders",
                                        "return_rate"], grain="month")


@register("metric_by_joined_dim", f"""
SELECT c.customer_segment,
       sum(CASE WHEN o.status = 'completed' THEN o.amount_paid END) AS total_recognised_revenue,
       {avg_x('sum(o.amount_paid)', 'count(o.amount_paid)')} AS avg_order_value,
       CAST(count(DISTINCT CASE WHEN o.status = 'returned' THEN o.order_id END) AS DOUBLE)
           / CAST(count(DISTINCT o.order_id) AS DOUBLE) AS return_rate
FROM fct_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
GROUP BY c.customer_segment""")
def metric_by_joined_dim(ds: Datasets) -> DataFrame:
    """Order metrics sliced by a customer attribute through the N:1 entity link."""
    return query_metrics(ds, REGISTRY, ["total_recognised_revenue", "avg_order_value",
                                        "return_rate"], by=["customer_segment"])


@register("metric_win_rate", """
SELECT lead_source,
       CAST(count(DISTINCT CASE WHEN is_won = true THEN opportunity_id END) AS DOUBLE)
           / CAST(nullif(count(DISTINCT CASE WHEN is_closed = true THEN opportunity_id END), 0)
                  AS DOUBLE) AS win_rate,
       sum(CASE WHEN is_closed = false THEN amount END) AS open_pipeline_amount
FROM fct_opportunities GROUP BY lead_source""")
def metric_win_rate(ds: Datasets) -> DataFrame:
    return query_metrics(ds, REGISTRY, ["win_rate", "open_pipeline_amount"], by=["lead_source"])


@register("metric_revenue_per_customer", """
SELECT CAST((SELECT sum(CASE WHEN status = 'completed' THEN amount_paid END) FROM fct_orders)
            AS DOUBLE)
       / CAST((SELECT count(DISTINCT customer_id) FROM dim_customers) AS DOUBLE)
           AS revenue_per_customer""")
def metric_revenue_per_customer(ds: Datasets) -> DataFrame:
    """Derived metric over two models: each side aggregated on its own."""
    return query_metrics(ds, REGISTRY, ["revenue_per_customer"])


@register("metric_by_country_cross_model", f"""
WITH o AS (SELECT c.country,
                  sum(CASE WHEN o.status = 'completed' THEN o.amount_paid END) AS rev
           FROM fct_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
           GROUP BY c.country),
c AS (SELECT country, count(DISTINCT customer_id) AS total_customers,
             {avg_x('sum(total_lifetime_value)', 'count(total_lifetime_value)')}
                 AS avg_customer_lifetime_value
      FROM dim_customers GROUP BY country)
SELECT coalesce(c.country, o.country) AS country, c.total_customers,
       c.avg_customer_lifetime_value,
       CAST(o.rev AS DOUBLE) / CAST(nullif(c.total_customers, 0) AS DOUBLE)
           AS revenue_per_customer
FROM c FULL JOIN o ON c.country IS NOT DISTINCT FROM o.country""")
def metric_by_country_cross_model(ds: Datasets) -> DataFrame:
    return query_metrics(ds, REGISTRY, ["total_customers", "avg_customer_lifetime_value",
                                        "revenue_per_customer"], by=["country"])


@register("metric_products_by_active", f"""
SELECT CAST(is_active AS VARCHAR) AS is_active, count(DISTINCT product_id) AS total_products,
       {avg_x('sum(unit_price)', 'count(unit_price)')} AS avg_product_price
FROM dim_products GROUP BY 1""")
def metric_products_by_active(ds: Datasets) -> DataFrame:
    """Dimension expression override: ``cast(is_active as string)``."""
    return query_metrics(ds, REGISTRY, ["total_products", "avg_product_price"],
                         by=["is_active"])


@register("orders_metric_view", f"""
SELECT order_date, status, payment_method,
       sum(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END) AS total_revenue,
       {rnd("sum(CASE WHEN status = 'completed' THEN amount_paid END)",
            "count(CASE WHEN status = 'completed' THEN amount_paid END)", 6)} AS avg_order_value,
       count(DISTINCT order_id) AS total_orders,
       CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
           / CAST(count(DISTINCT order_id) AS DOUBLE) * 100 AS return_rate
FROM fct_orders GROUP BY order_date, status, payment_method""")
def orders_metric_view(ds: Datasets) -> DataFrame:
    return ORDERS_VIEW.query(ds["fct_orders"], ["order_date", "status", "payment_method"])


@register("orders_metric_view_filtered", """
SELECT lower(payment_method) AS payment_method, sum(coalesce(received, 0)) AS total_revenue,
       count(*) AS total_orders
FROM raw_orders LEFT JOIN order_money USING (order_id)
WHERE status = 'COMPLETED' AND order_date >= DATE '2000-01-01' GROUP BY 1""")
def orders_metric_view_filtered(ds: Datasets) -> DataFrame:
    """A metric view asked with a condition on its dimensions."""
    return ORDERS_VIEW.query(ds["fct_orders"], ["payment_method"], ["total_revenue", "total_orders"],
                             where="status = 'completed' and order_date >= date '2000-01-01'")


@register("customer_metric_view", f"""
SELECT country, customer_segment, count(DISTINCT customer_id) AS customer_count,
       {rnd('sum(total_lifetime_value)', 'count(total_lifetime_value)', 6)} AS avg_lifetime_value,
       count(DISTINCT CASE WHEN customer_segment = 'high_value' THEN customer_id END)
           AS high_value_customers
FROM dim_customers GROUP BY country, customer_segment""")
def customer_metric_view(ds: Datasets) -> DataFrame:
    return CUSTOMERS_VIEW.query(ds["dim_customers"], ["country", "customer_segment"])


@register("all_metrics", f"""
WITH o AS (
  SELECT sum(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END) AS total_revenue,
         count(DISTINCT order_id) AS total_orders,
         CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
             / CAST(count(DISTINCT order_id) AS DOUBLE) * 100 AS return_rate_pct,
         {rnd("sum(CASE WHEN status = 'completed' THEN amount_paid END)",
              "count(CASE WHEN status = 'completed' THEN amount_paid END)", 6)}
             AS avg_order_value
  FROM fct_orders),
c AS (SELECT count(DISTINCT customer_id) AS customer_count,
             {rnd('sum(total_lifetime_value)', 'count(total_lifetime_value)', 6)}
                 AS avg_lifetime_value
      FROM dim_customers)
SELECT o.total_revenue, o.total_orders, o.return_rate_pct, c.customer_count,
       c.avg_lifetime_value, o.avg_order_value
FROM o CROSS JOIN c""")
def all_metrics(ds: Datasets) -> DataFrame:
    """One-row metric board: two global metric-view aggregates, cross joined
    (both sides are single rows)."""
    o = ORDERS_VIEW.query(ds["fct_orders"], [],
                          ["total_revenue", "total_orders", "return_rate", "avg_order_value"])
    c = CUSTOMERS_VIEW.query(ds["dim_customers"], [], ["customer_count", "avg_lifetime_value"])
    return o.crossJoin(F.broadcast(c)).select(
        "total_revenue", "total_orders", F.col("return_rate").alias("return_rate_pct"),
        "customer_count", "avg_lifetime_value", "avg_order_value")


@register("mv_vs_marts", f"""
WITH mv AS (
  SELECT CAST(sum(CASE WHEN status = 'completed' THEN amount_paid ELSE 0 END) AS DOUBLE) AS rev,
         CAST(count(DISTINCT order_id) AS DOUBLE) AS n,
         CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
             / CAST(count(DISTINCT order_id) AS DOUBLE) * 100 AS rr,
         CAST({rnd("sum(CASE WHEN status = 'completed' THEN amount_paid END)",
                   "count(CASE WHEN status = 'completed' THEN amount_paid END)", 6)} AS DOUBLE) AS aov
  FROM fct_orders),
mc AS (SELECT CAST(count(DISTINCT customer_id) AS DOUBLE) AS cn,
              CAST({rnd('sum(total_lifetime_value)', 'count(total_lifetime_value)', 6)} AS DOUBLE) AS ltv
       FROM dim_customers),
sl AS (
  SELECT CAST(sum(CASE WHEN status = 'completed' THEN amount_paid END) AS DOUBLE) AS rev,
         CAST(count(DISTINCT order_id) AS DOUBLE) AS n,
         CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
             / CAST(count(DISTINCT order_id) AS DOUBLE) * 100 AS rr,
         {avg_x('sum(amount_paid)', 'count(amount_paid)')} AS aov
  FROM fct_orders),
sc AS (SELECT CAST(count(DISTINCT customer_id) AS DOUBLE) AS cn,
              {avg_x('sum(total_lifetime_value)', 'count(total_lifetime_value)')} AS ltv
       FROM dim_customers)
SELECT metric, metric_view_value, semantic_value,
       coalesce(abs(metric_view_value - semantic_value) < 0.005,
                metric_view_value IS NULL AND semantic_value IS NULL) AS matches
FROM (SELECT 'total_revenue' AS metric, mv.rev AS metric_view_value, sl.rev AS semantic_value
      FROM mv, sl
      UNION ALL SELECT 'total_orders', mv.n, sl.n FROM mv, sl
      UNION ALL SELECT 'return_rate_pct', mv.rr, sl.rr FROM mv, sl
      UNION ALL SELECT 'avg_order_value', mv.aov, sl.aov FROM mv, sl
      UNION ALL SELECT 'customer_count', mc.cn, sc.cn FROM mc, sc
      UNION ALL SELECT 'avg_lifetime_value', mc.ltv, sc.ltv FROM mc, sc)""")
def mv_vs_marts(ds: Datasets) -> DataFrame:
    """The six board metrics two ways (metric view, semantic layer), equal to half a cent.

    The average order value is meant to differ: the view averages completed orders,
    the semantic metric all of them.
    """
    pairs = {"total_revenue": ("total_revenue", "total_recognised_revenue", 1),
             "total_orders": ("total_orders", "total_orders", 1),
             "return_rate_pct": ("return_rate_pct", "return_rate", 100),
             "avg_order_value": ("avg_order_value", "avg_order_value", 1),
             "customer_count": ("customer_count", "total_customers", 1),
             "avg_lifetime_value": ("avg_lifetime_value", "avg_customer_lifetime_value", 1)}
    mv = all_metrics(ds)
    sl = query_metrics(ds, REGISTRY, [m for _, m, _ in pairs.values()])
    sl = sl.select(*[F.col(c).alias(f"s_{c}") for c in sl.columns])
    j = mv.crossJoin(F.broadcast(sl))           # one row each
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(view).cast("double").alias("metric_view_value"),
                 (F.col(f"s_{metric}").cast("double") * F.lit(float(scale))).alias("semantic_value"))
        for name, (view, metric, scale) in pairs.items()])
    a, b = F.col("metric_view_value"), F.col("semantic_value")
    return j.select(F.inline(rows)).withColumn(
        "matches", F.coalesce(F.abs(a - b) < 0.005, a.isNull() & b.isNull()))


@register("metric_high_value_orders_by_month", """
SELECT date_trunc('month', o.order_date)::DATE AS metric_time, count(DISTINCT o.order_id) AS total_orders,
       sum(CASE WHEN o.status = 'completed' THEN o.amount_paid END) AS total_recognised_revenue
FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE c.customer_segment = 'high_value' GROUP BY 1""")
def metric_high_value_orders_by_month(ds: Datasets) -> DataFrame:
    """A condition on a linked dimension: orders of high-value customers by month."""
    return query_metrics(ds, REGISTRY, ["total_orders", "total_recognised_revenue"], grain="month",
                         where="customer_segment = 'high_value'")


@register("metric_revenue_per_customer_shipped", """
SELECT CAST((SELECT sum(CASE WHEN status = 'completed' THEN amount_paid END) FROM fct_orders
             WHERE status IN ('completed', 'shipped')) AS DOUBLE)
       / CAST((SELECT nullif(count(*), 0) FROM dim_customers) AS DOUBLE) AS revenue_per_customer""")
def metric_revenue_per_customer_shipped(ds: Datasets) -> DataFrame:
    """A condition that only one of the two models owns filters that model; the other is named."""
    return query_metrics(ds, REGISTRY, ["revenue_per_customer"], unfiltered=["dim_customers"],
                         where="status in ('completed', 'shipped')")


@register("metric_win_rate_of_industry", """
SELECT lead_source,
       CAST(count(CASE WHEN is_won THEN 1 END) AS DOUBLE)
           / CAST(nullif(count(CASE WHEN is_closed THEN 1 END), 0) AS DOUBLE) AS win_rate
FROM fct_opportunities o JOIN dim_accounts a ON o.account_id = a.account_id
WHERE a.industry = 'BUILDING' GROUP BY 1""")
def metric_win_rate_of_industry(ds: Datasets) -> DataFrame:
    """Win rate by lead source, for accounts of one industry."""
    return query_metrics(ds, REGISTRY, ["win_rate"], by=["lead_source"],
                         where="industry = 'BUILDING'")


# ------------------------------------------------------------------ metrics over time ---

@register("metric_repeat_purchase_30d", """
WITH credited AS (
  SELECT c.order_id AS conversion, c.order_date AS day,
         max((b.order_date, b.order_id)) AS base
  FROM fct_orders c JOIN fct_orders b ON b.customer_id = c.customer_id
   AND (b.order_date, b.order_id) < (c.order_date, c.order_id)
  GROUP BY 1, 2),
hits AS (SELECT DISTINCT base[2] AS order_id FROM credited WHERE day - base[1] <= 30)
SELECT date_trunc('month', o.order_date)::DATE AS metric_time,
       CAST(count(h.order_id) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS repeat_purchase_30d
FROM fct_orders o LEFT JOIN hits h ON h.order_id = o.order_id GROUP BY 1""")
def metric_repeat_purchase_30d(ds: Datasets) -> DataFrame:
    """Share of orders that the customer's next order follows within 30 days, by month."""
    return query_metrics(ds, REGISTRY, ["repeat_purchase_30d"], grain="month")


@register("metric_return_after_purchase_by_segment", """
WITH credited AS (
  SELECT c.order_id AS conversion, c.order_date AS day,
         max((b.order_date, b.order_id)) AS base
  FROM fct_orders c JOIN fct_orders b ON b.customer_id = c.customer_id AND b.status = 'completed'
   AND b.order_date <= c.order_date AND c.status = 'returned'
  GROUP BY 1, 2),
hits AS (SELECT DISTINCT base[2] AS order_id FROM credited WHERE day - base[1] <= 60)
SELECT d.customer_segment, CAST(count(h.order_id) AS DOUBLE) / CAST(count(*) AS DOUBLE)
       AS return_after_purchase_60d
FROM fct_orders o JOIN dim_customers d ON d.customer_id = o.customer_id
LEFT JOIN hits h ON h.order_id = o.order_id
WHERE o.status = 'completed' GROUP BY 1""")
def metric_return_after_purchase_by_segment(ds: Datasets) -> DataFrame:
    """Two streams: completed orders that a returned one follows within 60 days, by segment."""
    return query_metrics(ds, REGISTRY, ["return_after_purchase_60d"], by=["customer_segment"])


@register("metric_open_pipeline_by_month_end", """
WITH spine AS (
  SELECT unnest(generate_series(date_trunc('month', (SELECT min(created_date) FROM fct_opportunities)),
                                date_trunc('month', (SELECT max(greatest(created_date,
                                    CASE WHEN is_closed THEN close_date END)) FROM fct_opportunities)),
                                INTERVAL 1 MONTH))::DATE AS metric_time)
SELECT metric_time, coalesce(sum(amount), 0)::DECIMAL(18,2) AS open_pipeline_balance
FROM spine LEFT JOIN fct_opportunities o
  ON created_date < metric_time + INTERVAL 1 MONTH
 AND NOT (is_closed AND greatest(created_date, close_date) < metric_time + INTERVAL 1 MONTH)
GROUP BY 1""")
def metric_open_pipeline_by_month_end(ds: Datasets) -> DataFrame:
    """Open pipeline at the end of every month, months without events included."""
    out = query_metrics(ds, REGISTRY, ["open_pipeline_balance"], grain="month")
    return out.withColumn("open_pipeline_balance", F.col("open_pipeline_balance").cast("decimal(18,2)"))


_ACTIVE_90D = """
WITH spine AS (
  SELECT unnest(generate_series(date_trunc('month', (SELECT min(order_date) FROM fct_orders)),
                                date_trunc('month', (SELECT max(order_date) FROM fct_orders)),
                                INTERVAL 1 MONTH))::DATE AS metric_time),
dims AS (SELECT DISTINCT {dim} AS dim FROM fct_orders o JOIN dim_customers d USING (customer_id)),
seen AS (SELECT {dim} AS dim, order_date, o.customer_id, amount_paid, status
         FROM fct_orders o JOIN dim_customers d USING (customer_id))
SELECT metric_time, {named}
       count(DISTINCT customer_id) AS active_customers_90d
FROM spine CROSS JOIN dims LEFT JOIN seen s ON s.dim IS NOT DISTINCT FROM dims.dim
 AND order_date < metric_time + INTERVAL 1 MONTH
 AND order_date >= metric_time + INTERVAL 1 MONTH - INTERVAL 90 DAY
GROUP BY ALL"""


@register("metric_active_customers_90d", _ACTIVE_90D.format(dim="1", named=""))
def metric_active_customers_90d(ds: Datasets) -> DataFrame:
    """Distinct customers with an order in the 90 days up to each month's end."""
    return query_metrics(ds, REGISTRY, ["active_customers_90d"], grain="month")


@register("metric_active_customers_90d_by_country",
          _ACTIVE_90D.format(dim="d.country", named="dims.dim AS country,"))
def metric_active_customers_90d_by_country(ds: Datasets) -> DataFrame:
    """The same by a dimension of the linked model."""
    return query_metrics(ds, REGISTRY, ["active_customers_90d"], by=["country"], grain="month")


@register("metric_cumulative_revenue", """
WITH spine AS (
  SELECT unnest(generate_series(date_trunc('month', (SELECT min(order_date) FROM fct_orders)),
                                date_trunc('month', (SELECT max(order_date) FROM fct_orders)),
                                INTERVAL 1 MONTH))::DATE AS metric_time)
SELECT metric_time,
       coalesce(sum(CASE WHEN status = 'completed' THEN amount_paid END), 0)::DECIMAL(18,2)
           AS cumulative_revenue,
       coalesce(sum(CASE WHEN status = 'completed'
                          AND order_date >= metric_time + INTERVAL 1 MONTH - INTERVAL 28 DAY
                         THEN amount_paid END), 0)::DECIMAL(18,2) AS trailing_revenue_28d,
       count(DISTINCT customer_id) AS customers_to_date,
       count(DISTINCT CASE WHEN order_date >= metric_time THEN order_id END) AS total_orders
FROM spine LEFT JOIN fct_orders ON order_date < metric_time + INTERVAL 1 MONTH GROUP BY 1""")
def metric_cumulative_revenue(ds: Datasets) -> DataFrame:
    """Metrics over time and a simple one, in one request."""
    out = query_metrics(ds, REGISTRY, ["cumulative_revenue", "trailing_revenue_28d", "customers_to_date",
                                       "total_orders"], grain="month")
    return out.withColumns({c: F.col(c).cast("decimal(18,2)")
                            for c in ("cumulative_revenue", "trailing_revenue_28d")})


@register("metric_growth_by_month", """
WITH m AS (
  SELECT date_trunc('month', order_date)::DATE AS metric_time,
         sum(CASE WHEN status = 'completed' THEN amount_paid END) AS v FROM fct_orders GROUP BY 1),
a AS (
  SELECT metric_time, count(DISTINCT customer_id) AS n
  FROM (SELECT unnest(generate_series((SELECT min(metric_time) FROM m), (SELECT max(metric_time) FROM m),
                                      INTERVAL 1 MONTH))::DATE AS metric_time)
  LEFT JOIN fct_orders ON order_date < metric_time + INTERVAL 1 MONTH
   AND order_date >= metric_time + INTERVAL 1 MONTH - INTERVAL 90 DAY GROUP BY 1)
SELECT a.metric_time, m.v AS total_recognised_revenue, p.v AS recognised_revenue_before,
       (m.v::DOUBLE - p.v::DOUBLE) / nullif(p.v::DOUBLE, 0) AS recognised_revenue_growth,
       y.n AS active_customers_90d_year_before
FROM a LEFT JOIN m USING (metric_time)
LEFT JOIN m p ON p.metric_time = a.metric_time - INTERVAL 1 MONTH
LEFT JOIN a y ON y.metric_time = a.metric_time - INTERVAL 12 MONTH""")
def metric_growth_by_month(ds: Datasets) -> DataFrame:
    """Metrics of earlier periods, of a simple metric and of one over time, beside the period's own."""
    out = query_metrics(ds, REGISTRY, ["total_recognised_revenue", "recognised_revenue_before",
                                       "recognised_revenue_growth", "active_customers_90d",
                                       "active_customers_90d_year_before"], grain="month")
    return out.drop("active_customers_90d")


# ----------------------------------------------------- metric explorer breakdowns ---

_ORDER_METRICS = {"app_recognised_revenue", "app_avg_order_value", "app_return_rate_pct"}
_COMPLETED_ONLY = {"app_recognised_revenue", "app_avg_order_value"}


def _breakdown_sql(metric: str, dim: str) -> str:
    """Per value of the dimension, from the orders' (or customers') own rows."""
    key = {"month": "make_date(year(day), month(day), 1)"}.get(dim, dim)
    if metric not in _ORDER_METRICS:
        rows = "SELECT created_date AS day, * FROM dim_customers"
        value = {"app_total_customers": "count(*)",
                 "app_avg_lifetime_value": avg_x("sum(total_lifetime_value)", "count(*)")}[metric]
        return f"SELECT {key} AS period, {value} AS value FROM ({rows}) GROUP BY period"
    rows = ("SELECT order_date AS day, lower(r.status) AS st, lower(r.payment_method) AS payment_method, "
            "customer_segment, coalesce(received, 0) AS v FROM raw_orders r "
            "LEFT JOIN order_money USING (order_id) JOIN dim_customers USING (customer_id)")
    done = "FILTER (WHERE st = 'completed')"
    value = {"app_recognised_revenue": f"sum(v) {done}",
             "app_avg_order_value": avg_x(f"sum(v) {done}", f"count(*) {done}"),
             "app_return_rate_pct": "CAST(count(*) FILTER (WHERE st = 'returned') AS DOUBLE) "
                                    "/ CAST(count(*) AS DOUBLE) * 100"}[metric]
    some = f"HAVING count(*) {done} > 0" if metric in _COMPLETED_ONLY else ""
    return f"SELECT {key} AS period, {value} AS value FROM ({rows}) GROUP BY period {some}"


def _breakdown(metric: str, dim: str):
    from ledgerloom.plans.semantic import APP_WHERE

    where = APP_WHERE.get(metric)

    def run(ds: Datasets) -> DataFrame:
        if dim == "month":
            out = query_metrics(ds, REGISTRY, [metric], grain="month", where=where)
            return out.select(F.col("metric_time").alias("period"), F.col(metric).alias("value"))
        out = query_metrics(ds, REGISTRY, [metric], by=[dim], where=where)
        return out.select(F.col(dim).alias("period"), F.col(metric).alias("value"))
    return run


def _register_breakdowns() -> None:
    from ledgerloom.plans.semantic import APP_BREAKDOWNS

    for metric, dims in APP_BREAKDOWNS.items():
        for label, dim in dims.items():
            name = f"metric_breakdown_{metric[4:]}_{label}"
            register(name, _breakdown_sql(metric, dim))(_breakdown(metric, dim))


_register_breakdowns()


# ------------------------------------------------------------- operator aliases ---

@register("scan_source", "SELECT * FROM raw_orders")
def scan_source(ds: Datasets) -> DataFrame:
    """Batch scan of a landing table (``source(schema, table)``)."""
    return ds["raw_orders"]


@register("segment_bucket", """
SELECT customer_id, CAST(coalesce(received, 0) AS DECIMAL(18,2)) AS total_lifetime_value,
       CASE WHEN received < 500 AND received >= 100 THEN 'mid_value'
            WHEN received >= 500 THEN 'high_value' ELSE 'low_value' END AS customer_segment
FROM raw_customers LEFT JOIN customer_totals USING (customer_id)""")
def segment_bucket(ds: Datasets) -> DataFrame:
    """Searched-CASE value bucketing (first match wins, NULL LTV falls to low_value)."""
    from ledgerloom.functions.columns import segment
    from ledgerloom.plans.marts import VALUE_BANDS, VALUE_DEFAULT

    return ds["dim_customers"].select(
        "customer_id", "total_lifetime_value",
        segment("total_lifetime_value", VALUE_BANDS, VALUE_DEFAULT).alias("customer_segment"))


@register("order_gaps", f"""
WITH lagged AS (
  SELECT customer_id,
         datediff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
                  order_date) AS d
  FROM fct_orders)
SELECT customer_id, {avg_x('sum(d)', 'count(d)')} AS avg_days_between_orders,
       CASE WHEN count(d) > 1 THEN sqrt(CAST(CAST(count(d) AS HUGEINT) * sum(CAST(d AS HUGEINT) * d)
            - CAST(sum(d) AS HUGEINT) * sum(d) AS DOUBLE)
            / CAST(CAST(count(d) AS HUGEINT) * (count(d) - 1) AS DOUBLE)) END
           AS stddev_days_between_orders,
       max(d) AS max_gap_days
FROM lagged WHERE d IS NOT NULL GROUP BY customer_id""")
def order_gaps(ds: Datasets) -> DataFrame:
    """lag(order_date) per customer -> avg / sample stddev / max gap in days."""
    from ledgerloom.operators.gaps import gap_stats
    return gap_stats(ds["fct_orders"], "customer_id", "order_date")


@register("metric_return_rate", """
SELECT status_filter.payment_method,
       CAST(count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS DOUBLE)
           / CAST(count(DISTINCT order_id) AS DOUBLE) AS return_rate
FROM fct_orders status_filter GROUP BY 1""")
def metric_return_rate(ds: Datasets) -> DataFrame:
    """Ratio metric with a numerator filter, by payment method."""
    return query_metrics(ds, REGISTRY, ["return_rate"], by=["payment_method"])


@register("metric_pipeline_by_month", """
SELECT CAST(date_trunc('month', close_date) AS DATE) AS metric_time,
       sum(CASE WHEN is_closed = false THEN amount END) AS open_pipeline_amount,
       sum(CASE WHEN is_won = true THEN amount END) AS won_amount,
       CAST(count(DISTINCT CASE WHEN is_won = true THEN opportunity_id END) AS DOUBLE)
           / CAST(nullif(count(DISTINCT CASE WHEN is_closed = true THEN opportunity_id END), 0)
                  AS DOUBLE) AS win_rate
FROM fct_opportunities GROUP BY 1""")
def metric_pipeline_by_month(ds: Datasets) -> DataFrame:
    """CRM metrics on their aggregation time dimension (``close_date``) by month."""
    return query_metrics(ds, REGISTRY, ["open_pipeline_amount", "won_amount", "win_rate"],
                         grain="month")
