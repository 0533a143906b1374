"""Registered queries of tables that batches and streams keep up to date.

The batches are cut from the landed tables: what a source would have sent, in three parts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY, round_half_up_ratio
from ledgerloom.operators.buckets import read_batches
from ledgerloom.operators.history import merge_history, read_history
from ledgerloom.operators.sequence import append_batch
from ledgerloom.oracle import AS_OF, AS_OF_TS
from ledgerloom.plans.catalog import register
from ledgerloom.session import scratch_path
from ledgerloom.sources.datasets import Datasets
from ledgerloom.streaming.increments import (
    ActivationFeed, RunningTotals, read_drift, run_batches, stream_drift,
)

_SPLIT = f"CAST(date_trunc('month', {AS_OF} - INTERVAL 1 MONTH) AS DATE)"


@register("append_batch_twice", f"""
SELECT order_id, customer_id, order_date, status, amount, payment_method, {AS_OF_TS} AS _loaded_at
FROM raw_orders""")
def append_batch_twice(ds: Datasets) -> DataFrame:
    """Two named batches, the second one run twice: every order is there once."""
    o = ds["raw_orders"]
    start = F.trunc(F.add_months(ds.as_of_col(), -1), "month")
    path = scratch_path(ds.spark, "append_once")
    now = _dt.datetime.combine(ds.as_of, _dt.time())
    late = o.filter(F.col("order_date") >= start)
    append_batch(o.filter(F.col("order_date") < start), path, o.schema, now, batch="history")
    append_batch(late, path, o.schema, now, batch="last-month")
    append_batch(late, path, o.schema, now, batch="last-month")
    return read_batches(ds.spark, path, o.schema)


_HISTORY_SQL = """
WITH events AS (
  SELECT order_id, 'PLACED' AS status, amount, order_date AS day, FALSE AS gone FROM raw_orders
  UNION ALL SELECT order_id, 'SHIPPED', amount, order_date + 2, FALSE FROM raw_orders WHERE order_id % 3 = 0
  UNION ALL SELECT order_id, status, amount, order_date + 5, FALSE FROM raw_orders WHERE order_id % 3 = 0
  UNION ALL SELECT order_id, 'PLACED', amount, order_date + 1, FALSE FROM raw_orders WHERE order_id % 7 = 1
  UNION ALL SELECT order_id, 'HELD', amount, order_date + 1, FALSE FROM raw_orders WHERE order_id % 6 = 0
  UNION ALL SELECT order_id, NULL, NULL, order_date + 10, TRUE FROM raw_orders WHERE order_id % 50 = 0),
latest AS (SELECT *, row_number() OVER (PARTITION BY order_id, day ORDER BY status = 'HELD' DESC) AS k
           FROM events),
marked AS (SELECT *, lag(day) OVER w IS NULL OR lag(status) OVER w IS DISTINCT FROM status
                     OR lag(gone) OVER w IS DISTINCT FROM gone AS opens
           FROM latest WHERE k = 1 WINDOW w AS (PARTITION BY order_id ORDER BY day))
SELECT order_id, status, amount, day::DATE AS valid_from, valid_to::DATE AS valid_to
FROM (SELECT *, lead(day) OVER (PARTITION BY order_id ORDER BY day) AS valid_to FROM marked WHERE opens)
WHERE NOT gone"""


@register("history_three_batches", _HISTORY_SQL)
def history_three_batches(ds: Datasets) -> DataFrame:
    """Order history: new orders; two versions in one batch and known rows again; late rows and deletions."""
    o = ds["raw_orders"]
    event = lambda rows, status, days, gone=False: rows.select(
        "order_id", (F.lit(None).cast("string") if gone else status).alias("status"),
        (F.lit(None).cast(o.schema["amount"].dataType) if gone else F.col("amount")).alias("amount"),
        F.date_add("order_date", days).alias("at"), F.lit(gone).alias("gone"))
    every = lambda n, rest: o.filter(F.col("order_id") % n == rest)
    batches = [
        event(o, F.lit("PLACED"), 0),
        event(every(3, 0), F.lit("SHIPPED"), 2).unionByName(event(every(3, 0), F.col("status"), 5))
        .unionByName(event(every(7, 1), F.lit("PLACED"), 1)),
        event(every(6, 0), F.lit("HELD"), 1).unionByName(event(every(50, 0), F.lit(None), 10, gone=True))]
    path = scratch_path(ds.spark, "history")
    for number, batch in enumerate(batches):
        table = merge_history(batch, path, ["order_id"], "at", number, deleted="gone", n_buckets=16,
                              parts=ds.parts("orders"))
    return read_history(table)


@register("stream_drift_landing", """
SELECT order_id, CAST(floor(amount * 100) AS BIGINT) AS cents,
       CASE WHEN order_id % 3 > 0 THEN payment_method END AS payment_method,
       CASE WHEN order_id % 3 = 2 THEN CAST(order_date AS VARCHAR) ELSE
            CAST(order_id % 10 AS VARCHAR) END AS note
FROM raw_orders""")
def stream_drift_landing(ds: Datasets) -> DataFrame:
    """Three deliveries: the second has one more column, the third wider and other types."""
    o = ds["raw_orders"].withColumn("cents", F.floor(F.col("amount") * 100))
    root = scratch_path(ds.spark, "drift")
    digit = (F.col("order_id") % 10).cast("int")
    parts = [o.filter("order_id % 3 = 0").select("order_id", F.col("cents").cast("int"), digit.alias("note")),
             o.filter("order_id % 3 = 1").select("order_id", F.col("cents").cast("int"), digit.alias("note"),
                                                 "payment_method"),
             o.filter("order_id % 3 = 2").select("payment_method", "order_id", F.col("cents").cast("bigint"),
                                                 F.col("order_date").cast("string").alias("note"))]
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/in/delivery-{i}")
        stream_drift(ds.spark, f"{root}/in", f"{root}/table", f"{root}/_chk").awaitTermination()
    return read_drift(ds.spark, f"{root}/table")


_ALERT_STATES = """
WITH a AS (SELECT opportunity_id, account_name, amount, stage_name, alert_reason FROM crm_opportunity_alerts)
SELECT opportunity_id, account_name,
       CASE WHEN opportunity_id LIKE '%4' THEN amount - 1 ELSE amount END AS amount, stage_name, alert_reason,
       'new' AS change, 0::BIGINT AS batch
FROM a WHERE opportunity_id NOT LIKE '%7'
UNION ALL
SELECT opportunity_id, account_name, amount, stage_name, alert_reason,
       CASE WHEN opportunity_id LIKE '%7' THEN 'new' ELSE 'updated' END, 1
FROM a WHERE opportunity_id LIKE '%7' OR opportunity_id LIKE '%4'"""


@register("stream_activation", _ALERT_STATES)
def stream_activation(ds: Datasets) -> DataFrame:
    """Alerts in three micro-batches: most of them, all of them (some changed), all of them again."""
    now = ds["crm_opportunity_alerts"].select("opportunity_id", "account_name", "amount", "stage_name",
                                              "alert_reason")
    ends = lambda digit: F.col("opportunity_id").endswith(digit)
    then = now.filter(~ends("7")).withColumn(
        "amount", F.when(ends("4"), F.col("amount") - 1).otherwise(F.col("amount")).cast(MONEY))
    root = scratch_path(ds.spark, "activation-stream")
    feed = ActivationFeed(ds.spark, f"{root}/state", f"{root}/out", ["opportunity_id"], now.schema, n_buckets=16)
    for i, part in enumerate((then, now, now)):
        part.write.parquet(f"{root}/in/sync={i}")
        run_batches(ds.spark, f"{root}/in/sync=*", now.schema, f"{root}/_chk", feed, 10_000).awaitTermination()
    feed(now, 2)            # a restart repeats the last batch
    return feed.messages()


def _order_changes(ds: Datasets):
    """Three deliveries of orders: as first booked, as they are, and some older versions late."""
    o = ds["gold_fct_orders"].select("order_id", "customer_id", "order_date", "status", "amount_paid")
    booked = o.withColumns({
        "status": F.when(F.col("order_id") % 4 == 1, F.lit("completed")).otherwise(F.lit("placed")),
        "order_date": F.when(F.col("order_id") % 5 == 2, F.date_sub("order_date", 40))
        .otherwise(F.col("order_date")),
        "customer_id": F.when(F.col("order_id") % 9 == 4, F.lit(1).cast("long"))
        .otherwise(F.col("customer_id")), "version": F.lit(1)})
    return [booked, o.withColumn("version", F.lit(2)), booked.filter("order_id % 11 = 3")]


def _running(ds: Datasets, **totals) -> DataFrame:
    parts = _order_changes(ds)
    root = scratch_path(ds.spark, "running-totals")
    keep = RunningTotals(ds.spark, f"{root}/state", parts[0].schema, ["order_id"], "version", n_buckets=16,
                         parts=ds.parts("orders"), **totals)
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/in/delivery={i}")
        run_batches(ds.spark, f"{root}/in/delivery=*", parts[0].schema, f"{root}/_chk", keep,
                    10_000).awaitTermination()
    return keep.result()


@register("stream_gold_fct_revenue", "SELECT * FROM gold_fct_revenue")
def stream_gold_fct_revenue(ds: Datasets) -> DataFrame:
    """Daily revenue kept by micro-batch; orders that change status or day move their amounts."""
    day = _running(ds, groups=["order_date"], sums={"paid": "amount_paid"}, where="status = 'completed'")
    return day.select(
        "order_date", F.date_format("order_date", "yyyy-MM").alias("revenue_month"),
        F.col("paid").cast(MONEY).alias("daily_revenue"), F.col("n").alias("number_of_orders"),
        round_half_up_ratio(F.col("paid"), F.col("n"), 2).cast(MONEY).alias("avg_order_value"))


@register("stream_gold_customer_totals", """
SELECT customer_id, count(*) AS number_of_orders, min(order_date) AS first_order_date,
       max(order_date) AS most_recent_order_date, CAST(sum(amount_paid) AS DECIMAL(18,2)) AS total_paid
FROM gold_fct_orders GROUP BY customer_id""")
def stream_gold_customer_totals(ds: Datasets) -> DataFrame:
    """Totals by customer, first and last day included, while orders change day and customer."""
    by = _running(ds, groups=["customer_id"], sums={"paid": "amount_paid"},
                  least={"first_order_date": "order_date"}, greatest={"most_recent_order_date": "order_date"})
    return by.select("customer_id", F.col("n").alias("number_of_orders"), "first_order_date",
                     "most_recent_order_date", F.col("paid").cast(MONEY).alias("total_paid"))
