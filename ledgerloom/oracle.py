"""DuckDB oracle SQL for the correctness gate.

Each registered query has an ANSI-SQL statement that DuckDB runs over the
driver tables (pre-registered views). Models are written here as named CTEs that
start from the landing tables and derive every figure from a few totals per
order and per customer, independently of how the Spark plans are built.
:func:`sql` stitches the needed CTEs, in
dependency order, in front of a final SELECT.

Exactness rules (so values hash identically across engines): money is
``decimal(18,2)``; averages are ``double(sum) / count``; rounded averages use
integer half-up division; standard deviations use exact integer moments.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-02'"
AS_OF_TS = "TIMESTAMP '2001-08-02 00:00:00'"


def money(x: str) -> str:
    return f"CAST(CAST(floor({x}) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


def rnd(num: str, den: str, digits: int = 2) -> str:
    """Exact half-away-from-zero ``round(num/den, digits)`` as DECIMAL(38,digits)."""
    unit = 10 ** digits
    a = f"(CAST(abs({num}) * {2 * unit} AS HUGEINT) + CAST({den} AS HUGEINT))"
    b = f"(CAST({den} AS HUGEINT) * 2)"
    q = f"({a} // {b})"
    step = f"CAST('{1 / unit:.{digits}f}' AS DECIMAL({digits + 1},{digits}))" if digits else "1"
    return (f"CASE WHEN {den} <> 0 THEN CAST(CAST(CASE WHEN {num} < 0 THEN -{q} ELSE {q} END "
            f"AS DECIMAL(38,0)) * {step} AS DECIMAL(38,{digits})) END")


def rnd_money(num: str, den: str) -> str:
    return f"CAST({rnd(num, den, 2)} AS DECIMAL(18,2))"


def avg_x(s: str, n: str) -> str:
    return f"(CAST({s} AS DOUBLE) / CAST(NULLIF({n}, 0) AS DOUBLE))"


def stddev_x(n: str, s: str, q: str, scale: int = 0) -> str:
    nn, ss, qq = (f"CAST({n} AS HUGEINT)", f"CAST({s} AS HUGEINT)", f"CAST({q} AS HUGEINT)")
    v = f"sqrt(CAST({nn} * {qq} - {ss} * {ss} AS DOUBLE) / CAST({nn} * ({nn} - 1) AS DOUBLE))"
    if scale:
        v = f"({v} / {float(10 ** scale)})"
    return f"CASE WHEN {n} > 1 THEN {v} END"


PRIO = "substr(o_orderpriority, 1, 1)"

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


# ---------------------------------------------------------------- adapters ---
cte("raw_customers", f"""
SELECT c.c_custkey AS customer_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
       c.c_name || '@Example.COM' AS email, DATE '1994-12-31' AS created_at,
       n.n_name AS country, TIMESTAMP '2001-08-01 00:00:00' AS _loaded_at
FROM (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
      UNION ALL SELECT -1 - s_suppkey, s_name, 'PROSPECT', s_nationkey FROM supplier) c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("line_flags", """
SELECT l_orderkey, count(*) AS n_lines,
       sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
FROM lineitem GROUP BY l_orderkey""")

cte("raw_orders", f"""
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CASE WHEN f.n_returned * 2 > f.n_lines THEN 'RETURNED'
            WHEN o.o_orderstatus = 'F' THEN 'COMPLETED'
            WHEN o.o_orderstatus = 'O' THEN 'SHIPPED'
            WHEN o.o_orderstatus = 'P' THEN 'PLACED' END AS status,
       {money('o.o_totalprice / 50')} AS amount,
       CASE {PRIO} WHEN '1' THEN 'Credit_Card' WHEN '2' THEN 'Credit_Card'
            WHEN '3' THEN 'Credit_Card' WHEN '4' THEN 'PayPal' WHEN '5' THEN 'Bank_Transfer'
       END AS payment_method,
       o.o_orderdate AS _loaded_at
FROM orders o LEFT JOIN line_flags f ON o.o_orderkey = f.l_orderkey""")

cte("numbered_lines", """
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_shipdate, l_extendedprice, l_quantity, l_returnflag) AS order_item_id
FROM lineitem""")

cte("raw_order_items", f"""
SELECT l.order_item_id, l.l_orderkey AS order_id, l.l_partkey AS product_id,
       CAST(floor(l.l_quantity) AS INTEGER) AS quantity,
       {money('l.l_extendedprice')} AS unit_price, o.o_orderdate AS _loaded_at
FROM numbered_lines l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("raw_products", f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       {money('p_retailprice * 100')} AS unit_price, p_size % 10 <> 0 AS is_active,
       TIMESTAMP '2001-08-01 00:00:00' AS _loaded_at
FROM part""")

cte("raw_payments", """
SELECT order_id * 10 AS payment_id, order_id, payment_method, amount,
       CASE WHEN order_id % 20 = 3 THEN 'Pending' WHEN order_id % 20 = 7 THEN 'Failed'
            ELSE 'Success' END AS status,
       order_date AS payment_date, CAST(order_date - INTERVAL 2 DAY AS TIMESTAMP) AS _loaded_at
FROM raw_orders WHERE order_id % 20 <> 13
UNION ALL
SELECT order_id * 10 + 1, order_id, payment_method, amount, 'Failed', order_date,
       CAST(order_date - INTERVAL 2 DAY AS TIMESTAMP)
FROM raw_orders WHERE order_id % 20 = 11""")

cte("raw_reviews", """
SELECT l.order_item_id AS review_id, l.l_orderkey AS order_id, l.l_partkey AS product_id,
       o.o_custkey AS customer_id, 1 + CAST(floor(l.l_quantity) AS INTEGER) % 5 AS rating,
       CAST(l.l_shipdate AS DATE) AS review_date, l.l_shipdate AS _loaded_at
FROM numbered_lines l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'A'""")

_DEL = "CASE WHEN {k} % 50 = 0 THEN TRUE WHEN {k} % 50 = 1 THEN NULL ELSE FALSE END"

cte("sf_account", f"""
SELECT 'ACC' || c.c_custkey AS id, c.c_name AS name,
       CASE WHEN c.c_acctbal >= 0 THEN 'Customer - Direct' ELSE 'Customer - Channel' END AS type,
       c.c_mktsegment AS industry, {money('c.c_acctbal * 100')} AS annual_revenue,
       CAST((c.c_custkey % 100) * 10 + 5 AS INTEGER) AS number_of_employees,
       lower(n.n_name) AS billing_country, 'USR' || (c.c_custkey % 10) AS owner_id,
       DATE '1994-12-31' AS created_date, TIMESTAMP '2001-08-01 18:00:00' AS _fivetran_synced,
       CASE WHEN c.c_custkey % 50 = 1 THEN NULL ELSE FALSE END AS _fivetran_deleted
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("sf_contact", f"""
SELECT 'CON' || c_custkey AS id, 'ACC' || c_custkey AS account_id, c_name AS first_name,
       c_mktsegment AS last_name, c_name || '@Example.COM' AS email, 'Buyer' AS title,
       'USR' || (c_custkey % 10) AS owner_id, DATE '1994-12-31' AS created_date,
       TIMESTAMP '2001-08-01 18:00:00' AS _fivetran_synced,
       {_DEL.format(k='c_custkey')} AS _fivetran_deleted
FROM customer""")

cte("sf_opportunity", f"""
SELECT 'OPP' || o_orderkey AS id, 'ACC' || o_custkey AS account_id,
       'Order ' || o_orderkey AS name, o_orderstatus AS stage_name,
       CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS amount,
       CAST(o_orderdate AS DATE) AS close_date,
       CAST(CASE {PRIO} WHEN '1' THEN 90 WHEN '2' THEN 70 WHEN '3' THEN 50 WHEN '4' THEN 30
            WHEN '5' THEN 10 END AS DECIMAL(5,2)) AS probability,
       o_orderstatus = 'F' AS is_closed,
       (o_orderstatus = 'F' AND o_orderkey % 3 <> 0) AS is_won,
       'New Business' AS type, o_orderpriority AS lead_source,
       'USR' || (o_orderkey % 10) AS owner_id,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY AS DATE) AS created_date,
       TIMESTAMP '2001-08-01 18:00:00' AS _fivetran_synced,
       {_DEL.format(k='o_orderkey')} AS _fivetran_deleted
FROM orders""")

cte("sf_user", """
SELECT 'USR' || s_suppkey AS id, s_name AS name, s_name || '@Example.COM' AS email,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_acctbal >= 0 END AS is_active,
       TIMESTAMP '2001-08-01 18:00:00' AS _fivetran_synced, FALSE AS _fivetran_deleted
FROM supplier""")

# ----------------------------------------------------------------- staging ---
cte("stg_customers", """
SELECT customer_id, first_name, last_name, lower(email) AS email,
       CAST(created_at AS DATE) AS created_date, upper(country) AS country
FROM raw_customers""")
cte("stg_orders", """
SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date, lower(status) AS status,
       amount, lower(payment_method) AS payment_method
FROM raw_orders""")
cte("stg_order_items", """
SELECT order_item_id, order_id, product_id, quantity, unit_price,
       quantity * unit_price AS line_total
FROM raw_order_items""")
cte("stg_products", """
SELECT product_id, product_name, lower(category) AS category, unit_price,
       CAST(is_active AS BOOLEAN) AS is_active
FROM raw_products""")
cte("stg_payments", """
SELECT payment_id, order_id, lower(payment_method) AS payment_method, amount,
       lower(status) AS payment_status, CAST(payment_date AS DATE) AS payment_date
FROM raw_payments""")
cte("stg_crm_accounts", """
SELECT id AS account_id, name AS account_name, type AS account_type, industry,
       CAST(annual_revenue AS DECIMAL(18,2)) AS annual_revenue,
       CAST(number_of_employees AS BIGINT) AS number_of_employees,
       upper(billing_country) AS billing_country, owner_id,
       CAST(created_date AS DATE) AS created_date
FROM sf_account WHERE NOT coalesce(_fivetran_deleted, FALSE)""")
cte("stg_crm_contacts", """
SELECT id AS contact_id, account_id, first_name, last_name, lower(email) AS email, title,
       owner_id, CAST(created_date AS DATE) AS created_date
FROM sf_contact WHERE NOT coalesce(_fivetran_deleted, FALSE)""")
cte("stg_crm_opportunities", """
SELECT id AS opportunity_id, account_id, name AS opportunity_name, stage_name,
       CAST(amount AS DECIMAL(18,2)) AS amount, CAST(close_date AS DATE) AS close_date,
       CAST(probability AS DECIMAL(5,2)) AS probability,
       coalesce(is_closed, FALSE) AS is_closed, coalesce(is_won, FALSE) AS is_won,
       type AS opportunity_type, lead_source, owner_id,
       CAST(created_date AS DATE) AS created_date
FROM sf_opportunity WHERE NOT coalesce(_fivetran_deleted, FALSE)""")
cte("stg_crm_users", """
SELECT id AS user_id, name AS user_name, lower(email) AS email,
       coalesce(is_active, FALSE) AS is_active
FROM sf_user WHERE NOT coalesce(_fivetran_deleted, FALSE)""")

# ------------------------------------------------------------------- marts ---
# Per order, straight from the landing tables: money received (NULL without a payment
# row), and the lines' number and value. Everything below derives from these two.
cte("order_money", """
SELECT order_id,
       coalesce(sum(amount) FILTER (WHERE lower(status) = 'success'), 0) AS received,
       max(payment_date) AS last_payment
FROM raw_payments GROUP BY order_id""")
cte("order_lines", """
SELECT order_id, count(*) AS pieces, sum(quantity * unit_price) AS goods
FROM raw_order_items GROUP BY order_id""")
cte("customer_totals", """
SELECT r.customer_id, count(*) AS n, sum(m.received) AS received,
       coalesce(sum(m.received) FILTER (WHERE r.status = 'COMPLETED'), 0) AS recognised,
       count(*) FILTER (WHERE r.status = 'COMPLETED') AS n_completed,
       min(r.order_date) AS first_day, max(r.order_date) AS last_day
FROM raw_orders r LEFT JOIN order_money m USING (order_id) GROUP BY r.customer_id""")
cte("int_customer_orders", """
SELECT customer_id, n AS number_of_orders, received AS total_lifetime_value,
       first_day AS first_order_date, last_day AS most_recent_order_date
FROM customer_totals""")
cte("int_order_items_enriched", """
SELECT oi.order_item_id, oi.order_id, oi.product_id, p.product_name, p.category,
       oi.quantity, oi.unit_price, oi.line_total
FROM stg_order_items oi LEFT JOIN stg_products p ON oi.product_id = p.product_id""")
cte("dim_customers", """
SELECT k.customer_id, k.first_name, k.last_name, lower(k.email) AS email,
       k.created_at AS created_date, upper(k.country) AS country,
       coalesce(t.n, 0) AS number_of_orders,
       CAST(coalesce(t.received, 0) AS DECIMAL(18,2)) AS total_lifetime_value,
       t.first_day AS first_order_date, t.last_day AS most_recent_order_date,
       ['low_value', 'mid_value', 'high_value'][
           1 + CAST(coalesce(t.received, 0) >= 100 AS INTEGER)
             + CAST(coalesce(t.received, 0) >= 500 AS INTEGER)] AS customer_segment
FROM raw_customers k LEFT JOIN customer_totals t USING (customer_id)""")
cte("dim_products", """
SELECT product_id, product_name, category, CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
       is_active FROM stg_products""")
cte("fct_orders", """
SELECT order_id, customer_id, order_date, lower(status) AS status,
       lower(payment_method) AS payment_method, coalesce(pieces, 0) AS number_of_items,
       CAST(coalesce(goods, 0) AS DECIMAL(18,2)) AS items_total,
       CAST(coalesce(received, 0) AS DECIMAL(18,2)) AS amount_paid
FROM raw_orders LEFT JOIN order_lines USING (order_id) LEFT JOIN order_money USING (order_id)""")
# --------------------------------------------------------------------- CRM ---
cte("dim_accounts", """
SELECT a.account_id, a.account_name, a.account_type, a.industry, a.annual_revenue,
       a.number_of_employees, a.billing_country, a.owner_id, u.user_name AS account_owner,
       a.created_date
FROM stg_crm_accounts a LEFT JOIN stg_crm_users u ON a.owner_id = u.user_id""")
cte("fct_opportunities", """
SELECT o.opportunity_id, o.account_id, a.account_name, o.opportunity_name, o.stage_name,
       o.amount, o.close_date, o.probability, o.is_closed, o.is_won, o.opportunity_type,
       o.lead_source, o.owner_id, u.user_name AS opportunity_owner,
       CAST(CAST(o.amount * o.probability AS DECIMAL(38,4)) * CAST(0.01 AS DECIMAL(3,2))
            AS DECIMAL(18,2)) AS weighted_amount,
       o.created_date
FROM stg_crm_opportunities o
LEFT JOIN stg_crm_accounts a ON o.account_id = a.account_id
LEFT JOIN stg_crm_users u ON o.owner_id = u.user_id""")
cte("crm_opportunity_alerts", f"""
SELECT opportunity_id, account_id, account_name, opportunity_name, opportunity_owner,
       stage_name, amount, close_date,
       CASE WHEN amount >= CAST(100000 AS DECIMAL(18,2)) THEN 'high_value_open'
            ELSE 'overdue_open' END AS alert_reason
FROM fct_opportunities
WHERE NOT is_closed AND (amount >= CAST(100000 AS DECIMAL(18,2)) OR close_date < {AS_OF})""")

# --------------------------------------------------------------- marketing ---
# the bands of days are disjoint, so their order does not matter here
cte("mart_customer_segments", f"""
SELECT customer_id, first_name, last_name, email, country, customer_segment, total_lifetime_value,
       number_of_orders, last_day AS last_order_date, n_completed AS completed_orders,
       {AS_OF} - last_day AS days_since_last_order,
       CASE WHEN last_day IS NULL THEN 'never_purchased'
            WHEN {AS_OF} - last_day > 180 THEN 'lapsed'
            WHEN {AS_OF} - last_day > 90 OR customer_segment = 'low_value' THEN 'at_risk'
            WHEN {AS_OF} - last_day > 30 OR customer_segment = 'mid_value' THEN 'loyal'
            ELSE 'champion' END AS marketing_segment
FROM dim_customers LEFT JOIN customer_totals USING (customer_id)""")
# the customers x orders rows of a country: a customer without orders counts as one row
cte("mart_country_performance", f"""
SELECT country, count(*) AS total_customers,
       count(*) FILTER (WHERE customer_segment = 'high_value') AS high_value_customers,
       CAST(sum(number_of_orders) AS BIGINT) AS total_orders,
       CAST(coalesce(sum(recognised), 0) AS DECIMAL(18,2)) AS recognised_revenue,
       {avg_x('sum(total_lifetime_value * greatest(number_of_orders, 1))',
              'sum(greatest(number_of_orders, 1))')} AS avg_ltv,
       CAST(coalesce(sum(recognised), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE)
           AS revenue_per_customer
FROM dim_customers LEFT JOIN customer_totals USING (customer_id) GROUP BY country""")
cte("mart_country_performance_per_customer", f"""
SELECT country, count(*) AS total_customers,
       CAST(coalesce(sum(recognised), 0) AS DECIMAL(18,2)) AS recognised_revenue,
       {avg_x('sum(total_lifetime_value)', 'count(*)')} AS avg_ltv
FROM dim_customers LEFT JOIN customer_totals USING (customer_id) GROUP BY country""")
# ----------------------------------------------------------------- finance ---
cte("fct_revenue", """
SELECT order_id, customer_id, order_date,
       make_date(year(order_date), month(order_date), 1) AS order_month,
       make_date(year(order_date), 1, 1) AS order_year,
       status, payment_method, number_of_items, items_total, amount_paid,
       CAST(amount_paid * CAST(status = 'completed' AS INTEGER) AS DECIMAL(18,2)) AS recognised_revenue,
       CAST(amount_paid * CAST(status = 'returned' AS INTEGER) AS DECIMAL(18,2)) AS returned_amount
FROM fct_orders""")
cte("fct_revenue_by_product", """
WITH t AS (
  SELECT count(DISTINCT order_id) AS total_orders,
         sum(CASE WHEN status = 'completed' THEN amount_paid ELSE CAST(0 AS DECIMAL(18,2)) END)
             AS recognised_revenue,
         count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS return_count,
         min(order_date) AS first_order_date, max(order_date) AS most_recent_order_date
  FROM fct_orders)
SELECT p.product_id, p.product_name, p.category, p.unit_price, p.is_active,
       t.total_orders, CAST(coalesce(t.recognised_revenue, 0) AS DECIMAL(18,2))
           AS recognised_revenue,
       t.return_count, t.first_order_date, t.most_recent_order_date
FROM dim_products p CROSS JOIN t""")
cte("revenue_by_product_lines", """
WITH l AS (
  SELECT oi.product_id, o.order_id, o.status, o.order_date, oi.line_total
  FROM stg_order_items oi JOIN fct_orders o ON oi.order_id = o.order_id),
a AS (
  SELECT product_id, count(DISTINCT order_id) AS total_orders,
         sum(CASE WHEN status = 'completed' THEN line_total END) AS rec,
         count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS return_count,
         min(order_date) AS first_order_date, max(order_date) AS most_recent_order_date
  FROM l GROUP BY product_id)
SELECT p.product_id, p.product_name, p.category, p.unit_price, p.is_active,
       coalesce(a.total_orders, 0) AS total_orders,
       CAST(coalesce(a.rec, 0) AS DECIMAL(18,2)) AS recognised_revenue,
       coalesce(a.return_count, 0) AS return_count, a.first_order_date,
       a.most_recent_order_date
FROM dim_products p LEFT JOIN a ON p.product_id = a.product_id""")

# ------------------------------------------------------------ data science ---
cte("stg_customer_order_history", f"""
SELECT c.customer_id, c.customer_segment, c.country, c.total_lifetime_value,
       c.number_of_orders, c.first_order_date, c.most_recent_order_date,
       o.order_id, o.order_date, o.status, o.payment_method, o.number_of_items,
       o.items_total, o.amount_paid,
       datediff('day', c.most_recent_order_date, {AS_OF}) AS days_since_last_order,
       datediff('day', c.first_order_date, c.most_recent_order_date) AS customer_tenure_days
FROM dim_customers c JOIN fct_orders o ON c.customer_id = o.customer_id""")


def _rfm(customers: str, orders: str) -> str:
    """Scores count the cut points (nearest ranks of the sorted values) below a value."""
    rank = lambda c: (f"[(list({c} ORDER BY {c}))[CAST(ceil(count(*) * k / 5) AS BIGINT)] "  # noqa: E731
                      "FOR k IN [1, 2, 3, 4]]")
    score = lambda cuts, v: f"len([c FOR c IN {cuts} IF c < {v}])"
    return f"""
WITH bought AS (
  SELECT customer_id, {AS_OF} - max(order_date) AS idle,
         count(*) FILTER (WHERE status = 'completed') AS n,
         sum(amount_paid) FILTER (WHERE status = 'completed') AS spent,
         sum(number_of_items) FILTER (WHERE status = 'completed') AS pieces
  FROM {orders} GROUP BY customer_id),
filled AS (
  SELECT c.customer_id, c.customer_segment, c.country, coalesce(idle, 0) AS recency_days,
         coalesce(n, 0) AS frequency, CAST(coalesce(spent, 0) AS DECIMAL(18,2)) AS monetary_value,
         coalesce({avg_x('spent', 'n')}, 0) AS avg_order_value,
         coalesce(pieces, 0) AS total_items_purchased
  FROM {customers} c LEFT JOIN bought USING (customer_id)),
ranks AS (
  SELECT {rank('recency_days')} AS rc, {rank('frequency')} AS fc, {rank('monetary_value')} AS mc
  FROM filled),
points AS (
  SELECT filled.*, 5 - {score('rc', 'recency_days')} AS r_score,
         1 + {score('fc', 'frequency')} AS f_score, 1 + {score('mc', 'monetary_value')} AS m_score
  FROM filled, ranks)
SELECT *, r_score + f_score + m_score AS rfm_score FROM points"""


def _churn(customers: str, orders: str) -> str:
    return f"""
WITH of AS (
  SELECT customer_id, count(order_id) AS total_orders,
         count(DISTINCT CASE WHEN status = 'completed' THEN order_id END) AS completed_orders,
         count(DISTINCT CASE WHEN status = 'returned' THEN order_id END) AS returned_orders,
         CAST(sum(amount_paid) AS DECIMAL(18,2)) AS total_spend,
         {avg_x('sum(amount_paid)', 'count(amount_paid)')} AS avg_order_value,
         {stddev_x('count(amount_paid)', 'sum(CAST(amount_paid * 100 AS HUGEINT))',
                   'sum(CAST(amount_paid * 100 AS HUGEINT) * CAST(amount_paid * 100 AS HUGEINT))',
                   scale=2)} AS stddev_order_value,
         {avg_x('sum(number_of_items)', 'count(number_of_items)')} AS avg_items_per_order,
         max(order_date) AS last_order_date, min(order_date) AS first_order_date,
         count(DISTINCT payment_method) AS distinct_payment_methods
  FROM {orders} GROUP BY customer_id),
lagged AS (
  SELECT customer_id,
         datediff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
                  order_date) AS d
  FROM {orders}),
gaps AS (
  SELECT customer_id, {avg_x('sum(d)', 'count(d)')} AS avg_days_between_orders,
         {stddev_x('count(d)', 'sum(d)', 'sum(CAST(d AS BIGINT) * d)')}
             AS stddev_days_between_orders,
         max(d) AS max_gap_days
  FROM lagged WHERE d IS NOT NULL GROUP BY customer_id)
SELECT c.customer_id, c.customer_segment, c.country, c.total_lifetime_value,
       datediff('day', f.first_order_date, f.last_order_date) AS customer_tenure_days,
       coalesce(f.total_orders, 0) AS total_orders,
       coalesce(f.completed_orders, 0) AS completed_orders,
       coalesce(f.returned_orders, 0) AS returned_orders,
       coalesce(f.total_spend, CAST(0 AS DECIMAL(18,2))) AS total_spend,
       coalesce(f.avg_order_value, 0) AS avg_order_value,
       coalesce(f.stddev_order_value, 0) AS stddev_order_value,
       coalesce(f.avg_items_per_order, 0) AS avg_items_per_order,
       datediff('day', f.last_order_date, {AS_OF}) AS days_since_last_order,
       coalesce(g.avg_days_between_orders, 0) AS avg_days_between_orders,
       coalesce(g.stddev_days_between_orders, 0) AS stddev_days_between_orders,
       coalesce(g.max_gap_days, 0) AS max_gap_days,
       coalesce(f.distinct_payment_methods, 0) AS distinct_payment_methods,
       CASE WHEN f.total_orders > 0
            THEN CAST({rnd('f.returned_orders', 'f.total_orders', 4)} AS DOUBLE)
            ELSE 0.0 END AS return_rate,
       coalesce(datediff('day', f.last_order_date, {AS_OF}) > 90, FALSE) AS is_churned
FROM {customers} c LEFT JOIN of f ON c.customer_id = f.customer_id
LEFT JOIN gaps g ON c.customer_id = g.customer_id"""


cte("rfm_customer_features", _rfm("dim_customers", "fct_orders"))
cte("customer_churn_features", _churn("dim_customers", "fct_orders"))
cte("payment_method_affinity_pairs", f"""
WITH cm AS (SELECT customer_id, payment_method, amount_paid FROM fct_orders
            WHERE status = 'completed'),
p AS (
  SELECT a.payment_method AS method_a, b.payment_method AS method_b,
         count(DISTINCT a.customer_id) AS shared_customers,
         sum(a.amount_paid) AS sa, sum(b.amount_paid) AS sb, count(*) AS n
  FROM cm a JOIN cm b ON a.customer_id = b.customer_id AND a.payment_method < b.payment_method
  GROUP BY 1, 2)
SELECT method_a, method_b, shared_customers,
       {rnd_money('sa', 'n')} AS avg_spend_method_a, {rnd_money('sb', 'n')} AS avg_spend_method_b
FROM p""")

# ---------------------------------------------------------------- pipeline ---
for _t in ("customers", "orders", "order_items", "products", "payments"):
    cte(f"bronze_{_t}", f"SELECT * FROM raw_{_t}")
cte("silver_customers_rows", """
SELECT customer_id, first_name, last_name, lower(email) AS email,
       CAST(created_at AS DATE) AS created_date, upper(country) AS country
FROM bronze_customers""")
cte("silver_orders_rows", """
SELECT order_id, customer_id, lower(status) AS status, CAST(order_date AS DATE) AS order_date,
       amount, lower(payment_method) AS payment_method
FROM bronze_orders""")
cte("silver_order_items_rows", """
SELECT order_item_id, order_id, product_id, quantity, unit_price,
       quantity * unit_price AS line_total
FROM bronze_order_items""")
cte("silver_products_rows", """
SELECT product_id, product_name, lower(category) AS category, unit_price, is_active
FROM bronze_products""")
cte("silver_payments_rows", """
SELECT payment_id, order_id, lower(payment_method) AS payment_method, amount,
       CAST(payment_date AS DATE) AS payment_date, lower(status) AS payment_status
FROM bronze_payments""")
for _t, _key in (("customers", "customer_id"), ("orders", "order_id"), ("products", "product_id"),
                 ("order_items", "order_item_id"), ("payments", "payment_id")):
    cte(f"silver_{_t}", f"SELECT * FROM silver_{_t}_rows WHERE {_key} IS NOT NULL")
cte("gold_order_money", """
SELECT order_id, sum(amount) AS received FROM silver_payments
WHERE payment_status = 'success' GROUP BY order_id""")
cte("gold_dim_customers", """
WITH t AS (
  SELECT customer_id, count(*) AS n, min(order_date) AS a, max(order_date) AS z,
         coalesce(sum(received), 0) AS v
  FROM silver_orders LEFT JOIN gold_order_money USING (order_id) GROUP BY customer_id)
SELECT customer_id, first_name, last_name, email, country, created_date,
       coalesce(n, 0) AS number_of_orders, a AS first_order_date, z AS most_recent_order_date,
       CAST(coalesce(v, 0) AS DECIMAL(18,2)) AS total_lifetime_value,
       CASE WHEN v IS NULL OR v < 100 THEN 'low_value' WHEN v < 500 THEN 'mid_value'
            ELSE 'high_value' END AS customer_segment
FROM silver_customers LEFT JOIN t USING (customer_id)""")
cte("gold_fct_orders", """
WITH l AS (SELECT order_id, count(*) AS pieces, sum(line_total) AS goods
           FROM silver_order_items GROUP BY order_id)
SELECT order_id, customer_id, status, order_date, amount, coalesce(pieces, 0) AS number_of_items,
       CAST(coalesce(goods, 0) AS DECIMAL(18,2)) AS items_total,
       CAST(coalesce(received, 0) AS DECIMAL(18,2)) AS amount_paid, payment_method
FROM silver_orders LEFT JOIN l USING (order_id) LEFT JOIN gold_order_money USING (order_id)""")
cte("gold_completed", """
SELECT * FROM gold_fct_orders WHERE status = 'completed'""")
cte("gold_fct_revenue", f"""
SELECT order_date, left(CAST(order_date AS VARCHAR), 7) AS revenue_month,
       CAST(sum(amount_paid) AS DECIMAL(18,2)) AS daily_revenue, count(*) AS number_of_orders,
       {rnd_money('sum(amount_paid)', 'count(*)')} AS avg_order_value
FROM gold_completed GROUP BY order_date""")


def _segments_b(no_order_days: str) -> str:
    """The first rule that holds names the segment; ``no_order_days`` stands for no order."""
    rules = [("champion", "total_lifetime_value >= 500 AND days <= 30"),
             ("loyal", "number_of_orders >= 3"),
             ("at_risk", "total_lifetime_value >= 100 AND days > 60"),
             ("lapsed", "days > 90"), ("never_purchased", "number_of_orders = 0")]
    found = ", ".join(f"CASE WHEN {rule} THEN '{label}' END" for label, rule in rules)
    return f"""
WITH d AS (
  SELECT g.*, coalesce({AS_OF} - most_recent_order_date, {no_order_days}) AS days
  FROM gold_dim_customers g)
SELECT customer_id, first_name, last_name, email, country, customer_segment, total_lifetime_value,
       number_of_orders, most_recent_order_date AS last_order_date, days AS days_since_last_order,
       coalesce({found}, 'other') AS marketing_segment
FROM d"""


cte("marketing_customer_segments", _segments_b("NULL"))
cte("marketing_customer_segments_py", _segments_b("9999"))
cte("marketing_country_performance", f"""
SELECT country, CAST(sum(n) AS BIGINT) AS total_orders, CAST(sum(v) AS DECIMAL(18,2)) AS total_revenue,
       {rnd_money('sum(v)', 'sum(n)')} AS avg_order_value, CAST(count(*) AS BIGINT) AS active_customers,
       {rnd_money('sum(v)', 'count(*)')} AS revenue_per_customer
FROM (SELECT customer_id, count(*) AS n, sum(amount_paid) AS v FROM gold_completed GROUP BY customer_id)
JOIN gold_dim_customers USING (customer_id) GROUP BY country""")
cte("marketing_country_performance_py", f"""
SELECT country, CAST(sum(n) AS BIGINT) AS total_orders, CAST(sum(v) AS DECIMAL(18,2)) AS total_revenue,
       {rnd_money('sum(v)', 'sum(n)')} AS avg_order_value, CAST(sum(n) AS BIGINT) AS active_customers,
       {rnd_money('sum(v)', 'sum(n)')} AS revenue_per_customer
FROM (SELECT customer_id, count(*) AS n, sum(amount_paid) AS v FROM gold_completed GROUP BY customer_id)
JOIN gold_dim_customers USING (customer_id) GROUP BY country""")
cte("finance_fct_revenue", """
SELECT order_id, order_date, customer_id, status, amount_paid,
       CAST(amount_paid * CAST(status = 'completed' AS INTEGER) AS DECIMAL(18,2)) AS recognised_revenue,
       CAST(amount_paid - items_total AS DECIMAL(18,2)) AS payment_vs_items_delta,
       CAST(make_date(year(order_date), month(order_date), 1) AS TIMESTAMP) AS revenue_month
FROM gold_fct_orders""")
# every product meets every completed order: totals times the products of a name
cte("finance_fct_revenue_by_product", f"""
SELECT category, product_name, count(*) * any_value(o.n) AS total_orders,
       CAST(any_value(o.v) * count(*) AS DECIMAL(18,2)) AS total_revenue,
       {rnd_money('any_value(o.v)', 'any_value(o.n)')} AS avg_order_value
FROM silver_products, (SELECT count(*) AS n, sum(amount_paid) AS v FROM gold_completed) o
WHERE o.n > 0 GROUP BY category, product_name""")
cte("ds_rfm_customer_features", _rfm("gold_dim_customers", "gold_fct_orders"))
cte("ds_customer_churn_features", _churn("gold_dim_customers", "gold_fct_orders"))


# ------------------------------------------------------------------ stitch ---

def _deps(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    return [n for n in CTES if n in words]


def sql(final: str) -> str:
    """``WITH <needed ctes in dependency order> <final>``."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d)
        order.append(name)

    for d in _deps(final):
        visit(d)
    if not order:
        return final
    parts = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    body = final.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{final}"


def table(name: str) -> str:
    return sql(f"SELECT * FROM {name}")
