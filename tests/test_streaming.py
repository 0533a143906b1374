"""Streaming bronze/silver equals the batch pipeline; reruns are idempotent."""
import datetime as dt

from ledgerloom.session import scratch_path
from ledgerloom.sources.datasets import Datasets
from ledgerloom.streaming.medallion import land, run_medallion, stream_table

SF = "/root/testdata/sf0.001"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_counts_violations(spark):
    ds = Datasets(spark, SF, dt.date(2001, 8, 2))
    customers = ds["raw_customers"]
    # two bad rows: NULL id (dropped) and NULL email (kept, counted)
    bad = spark.createDataFrame(
        [(None, "x", "y", "n@x.com", dt.date(2000, 1, 1), "Z", dt.datetime(2001, 8, 1)),
         (999999, "x", "y", None, dt.date(2000, 1, 1), "Z", dt.datetime(2001, 8, 1))],
        customers.schema)
    run = run_medallion(spark, {"customers": customers.unionByName(bad)}, ["customers"])
    silver = run.silver(spark)["customers"]
    counts = {r.expectation: r.violations for r in run.counts(spark, "customers").collect()}
    batch = ds.with_tables(raw_customers=customers.unionByName(bad))["silver_customers"]
    assert _sorted(silver) == _sorted(batch)
    assert counts == {"valid_customer_id": 1, "valid_email": 1, "__rows": customers.count() + 2}


# one violating row for every rule of the five silver tables
BAD = {"customers": {"customer_id": None, "email": None}, "orders": {"order_id": None, "status": "LOST"},
       "order_items": {"order_item_id": None, "quantity": 0}, "products": {"product_id": None},
       "payments": {"payment_id": None, "amount": 0}}


def test_stream_counts_equal_batch_counts(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators.expectations import expectation_report
    from ledgerloom.plans.medallion import SILVER_EXPECTATIONS, SILVER_FNS

    ds = Datasets(spark, SF, dt.date(2001, 8, 2))
    raw = {}
    for t, broken in BAD.items():
        df = raw[t] = ds[f"raw_{t}"].limit(20)
        for c, v in broken.items():
            raw[t] = raw[t].unionByName(df.limit(1).withColumn(c, F.lit(v).cast(df.schema[c].dataType)))
    run = run_medallion(spark, raw, list(raw))
    for t, df in raw.items():
        batch = {r.expectation: (r["rows"], r.violations) for r in expectation_report(
            SILVER_FNS[t](df), SILVER_EXPECTATIONS[t], t).collect()}
        stream = {r.expectation: r.violations for r in run.counts(spark, t).collect()}
        rows = stream.pop("__rows")
        assert batch == {k: (rows, n) for k, n in stream.items()}
        assert set(stream.values()) == {1}


def test_counters_are_complete_beyond_a_hundred_batches(spark):
    """152 one-file batches, each with a row that breaks the rule."""
    from ledgerloom.operators.expectations import Expectation
    from ledgerloom.streaming.medallion import BATCH, expectation_counts

    root = scratch_path(spark, "many")
    rows = spark.range(304).selectExpr("id", "id % 2 as amount")
    land(rows.repartitionByRange(152, "id"), f"{root}/landing")
    q = stream_table(spark, f"{root}/landing", f"{root}/out", rows.schema, f"{root}/chk",
                     expectations=[Expectation("positive_amount", "amount > 0", "drop")],
                     counters=f"{root}/counters", max_files=1)
    q.awaitTermination()
    counts = {r.expectation: r.violations for r in expectation_counts(spark, f"{root}/counters").collect()}
    assert counts == {"__rows": 304, "positive_amount": 152}
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 152 and out.select(BATCH).distinct().count() == 152


def test_rerun_adds_nothing(spark):
    ds = Datasets(spark, SF, dt.date(2001, 8, 2))
    src = ds["raw_products"]
    root = scratch_path(spark, "rerun")
    land(src, f"{root}/landing", 3)
    for _ in range(2):
        q = stream_table(spark, f"{root}/landing", f"{root}/bronze", src.schema, f"{root}/chk")
        q.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == src.count()
    # new files landing later are picked up incrementally
    land(src.limit(5), f"{root}/landing", 1)
    q = stream_table(spark, f"{root}/landing", f"{root}/bronze", src.schema, f"{root}/chk")
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == src.count() + 5


def test_a_source_without_a_file(spark, tmp_path):
    """Nothing has landed yet: empty silver tables with their columns, no counters."""
    ds = Datasets(spark, SF, dt.date(2001, 8, 2))
    raw = {t: ds[f"raw_{t}"] for t in ("orders", "payments")}
    for t in raw:
        (tmp_path / t).mkdir()
    run = run_medallion(spark, raw, list(raw), landing={t: str(tmp_path / t) for t in raw})
    silver = run.silver(spark)
    assert all(silver[t].count() == 0 and silver[t].columns == ds[f"silver_{t}"].columns for t in raw)
    assert run.counts(spark, "orders").count() == 0
