"""Large shuffles take as many partitions as their rows need, whatever the session's number."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.gaps import gap_stats
from ledgerloom.operators.history import merge_history, read_history
from ledgerloom.operators.quality import DataTest, run_tests
from ledgerloom.plans.finance import product_order_lines
from ledgerloom.sources import datasets
from ledgerloom.sources.datasets import Datasets
from ledgerloom.streaming.increments import RunningTotals

SRC = "/root/testdata/sf0.001"


def _ds(spark):
    return Datasets(spark, SRC, dt.date(2001, 8, 2))


@pytest.fixture
def small_tasks(monkeypatch):
    """Every task takes 100 rows, so tables of some thousand count as large."""
    monkeypatch.setattr(datasets, "ROWS_A_TASK", 100)
    monkeypatch.setattr(datasets, "FEW_ROWS", 10)
    return _ds


@pytest.fixture
def few_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def _largest(df):
    """Rows of the largest partition."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("name", ["raw_orders", "fct_orders", "gold_fct_orders"])
def test_orders_are_joined_in_partitions_by_rows(spark, small_tasks, few_shuffle_partitions, monkeypatch, name):
    wide = small_tasks(spark)[name]
    assert wide.rdd.getNumPartitions() >= 10 and _largest(wide) < 400
    monkeypatch.setattr(datasets, "FEW_ROWS", 10 ** 9)
    plain = _ds(spark)[name]
    assert wide.count() == plain.count() and wide.exceptAll(plain).count() == 0


def test_lines_are_numbered_in_partitions_by_rows(spark, small_tasks, few_shuffle_partitions, monkeypatch):
    from ledgerloom.sources import adapters

    # other tests of the session may have written these tables
    monkeypatch.setattr(adapters, "once", lambda spark, scope, name, build: build())
    ds = small_tasks(spark)
    lines = ds["line_items_numbered"]
    files = lines.groupBy(F.input_file_name()).count()
    assert files.count() >= 30 and files.agg(F.max("count")).first()[0] < 700
    got = [r[0] for r in lines.orderBy("l_orderkey", *adapters.LINE_ORDER).select("order_item_id").collect()]
    assert got == list(range(1, ds.driver("lineitem").count() + 1))


def test_product_lines_are_summed_in_partitions_by_rows(spark, small_tasks, few_shuffle_partitions, monkeypatch):
    wide = product_order_lines(small_tasks(spark))
    assert _largest(wide) < 700
    monkeypatch.setattr(datasets, "FEW_ROWS", 10 ** 9)
    plain = product_order_lines(_ds(spark))
    assert wide.count() == plain.count() and wide.exceptAll(plain).count() == 0


def test_large_products_are_hashed_not_sorted(spark, small_tasks):
    ds = small_tasks(spark)
    plan = ds["int_order_items_enriched"]._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # products are a few hundred: one row a line, as many as there are
    assert ds["int_order_items_enriched"].count() == ds["stg_order_items"].count()


def test_gaps_and_histories_take_the_number_given(spark, few_shuffle_partitions, tmp_path):
    rows = [(k, dt.date(2001, 1, 1) + dt.timedelta(days=d * (k % 3 + 1))) for k in range(40) for d in range(5)]
    rows += [(None, dt.date(2001, 1, 3)), (None, dt.date(2001, 2, 3)), (7, None)]
    df = spark.createDataFrame(rows, "k int, day date")
    wide = gap_stats(df, "k", "day", parts=9)
    assert wide.rdd.getNumPartitions() == 9
    assert sorted(map(str, wide.collect())) == sorted(map(str, gap_stats(df, "k", "day").collect()))
    events = df.filter("day is not null").distinct().withColumn("v", F.dayofmonth("day") % 2)
    held = [read_history(merge_history(events, f"{tmp_path}/{n}", ["k"], "day", 0, n_buckets=2, parts=n or None))
            for n in (0, 7)]
    assert sorted(map(str, held[0].collect())) == sorted(map(str, held[1].collect()))


def test_running_totals_take_the_number_given(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3, i * 2, 1) for i in range(50)] + [(1, 2, 9, 2), (None, 0, 5, 1)],
                               "id int, g int, v int, version int")
    found = []
    for n in (None, 7):
        keep = RunningTotals(spark, f"{tmp_path}/{n}", df.schema, ["id"], "version", ["g"], {"s": "v"},
                             least={"lo": "v"}, n_buckets=2, parts=n)
        keep(df.filter("version = 1"), 0)
        keep(df.filter("version = 2"), 1)
        found.append(sorted(map(tuple, keep.result().collect())))
    assert found[0] == found[1] and len(found[0]) == 3


def test_unique_tests_deal_keys_by_rows(spark, small_tasks, few_shuffle_partitions):
    ds = small_tasks(spark)
    tests = [DataTest("stg_orders", "not_null", "amount"), DataTest("stg_orders", "unique", "order_id")]
    dealt = run_tests(ds, tests, sizes={"stg_orders": "orders"})
    n = ds.parts("orders")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, dealt.collect())) == sorted(map(str, run_tests(ds, tests).collect()))
