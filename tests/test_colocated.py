"""Bucketed tables without exchanges, row-level reconciliation, ordered activation runs."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.activation import run_order, sync
from ledgerloom.operators.quality import DataTest, diff_rows, relationships, run_tests, unique
from ledgerloom.sources.datasets import Datasets, publish

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 8, 2)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def colocated(spark, tmp_path_factory):
    """Sources and the order fact as catalog tables, bucketed by order and customer."""
    names = {"raw_orders": "order_id", "raw_payments": "order_id", "raw_order_items": "order_id",
             "raw_customers": "customer_id"}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS colocated LOCATION '{tmp_path_factory.mktemp('wh')}'")
    plain = Datasets(spark, SF, AS_OF)
    publish(plain, list(names), schema="colocated", buckets={n: (8, [k]) for n, k in names.items()})
    sources = Datasets(spark, as_of=AS_OF, catalog={n: f"colocated.{n}" for n in names})
    publish(sources, ["fct_orders"], schema="colocated", buckets={"fct_orders": (8, ["order_id"])})
    yield plain, sources, Datasets(spark, as_of=AS_OF, catalog={
        **{n: f"colocated.{n}" for n in names}, "fct_orders": "colocated.fct_orders"})
    spark.sql("DROP DATABASE colocated CASCADE")


def test_fct_orders_is_built_without_an_exchange_on_the_order(spark, colocated):
    plain, sources, _ = colocated
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(sources.build("fct_orders"))
        assert "hashpartitioning(order_id" not in plan and "Exchange" not in plan, plan
        assert "Exchange" in _plan(plain.build("fct_orders"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = lambda ds: sorted(map(tuple, ds.build("fct_orders").collect()))
    assert rows(sources) == rows(plain)


def test_unique_and_relationships_read_buckets_as_they_are(spark, colocated):
    _, _, ds = colocated
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in _plan(unique(ds["fct_orders"], "order_id"))
        assert "Exchange" not in _plan(relationships(ds["raw_payments"], "order_id", ds["fct_orders"], "order_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert unique(ds["fct_orders"], "order_id").count() == 0


def test_buckets_need_a_schema(spark):
    with pytest.raises(ValueError):
        publish(Datasets(spark, SF, AS_OF), ["fct_orders"], path="/tmp/x", buckets={"fct_orders": (4, ["order_id"])})


def test_one_pass_finds_what_the_single_tests_find(spark):
    class Tables(dict):
        pass

    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice(["a", "b", "z", None]), rng.choice([None, 1, 2, 99]))
            for _ in range(300)]
    ds = Tables(t=spark.createDataFrame(rows, "id long, kind string, fk long"),
                p=spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk long"))
    ds.spark = spark
    tests = [DataTest("t", "unique", "id"), DataTest("t", "not_null", "id"), DataTest("t", "unique", "fk"),
             DataTest("t", "accepted_values", "kind", ("a", "b")), DataTest("p", "unique", "pk"),
             DataTest("t", "relationships", "fk", to="p", field="pk")]
    got = {r.test_name: r.failures for r in run_tests(ds, tests, {"odd": ("warn", "t", "fk = 99")}).collect()}
    count = lambda c, i: sum(1 for v in {r[i] for r in rows} - {None}
                             if sum(r[i] == v for r in rows) > 1)
    assert got == {"unique_t_id": count(0, 0), "not_null_t_id": sum(r[0] is None for r in rows),
                   "unique_t_fk": count(0, 2), "accepted_values_t_kind": sum(r[1] == "z" for r in rows),
                   "unique_p_pk": 1, "relationships_t_fk__p": sum(r[2] == 99 for r in rows),
                   "odd": sum(r[2] == 99 for r in rows)}
    ds["t"] = ds["t"].limit(0)
    assert {r.failures for r in run_tests(ds, tests[:-1]).collect()} == {0, 1}


# ---- row-level reconciliation ----------------------------------------------------------

SCHEMA = "k long, s string, a string, v long, d date, extra int"


def _rows(n):
    return [(i, f"s{i % 3}", f"a{i}", i, dt.date(2020, 1, 1 + i % 28), i) for i in range(n)]


def test_planted_differences_are_found(spark):
    left = _rows(2000)
    right = [list(r) for r in left if r[0] not in (5, 1500)]
    by = {r[0]: r for r in right}
    by[7][2], by[8][3], by[9][4], by[10][2], by[10][3] = "other", 99, None, None, -1
    by[11][5] = -5                                          # a column that is not compared
    right = [tuple(r) for r in right] + [(9999, "new", "x", 1, None, 0), (None, "n", "x", 1, None, 0)]
    a = spark.createDataFrame(left, SCHEMA).repartition(5)
    b = spark.createDataFrame(right, SCHEMA).repartition(3).drop("extra").withColumn("more", F.lit(1))
    got = {r.k: (r.found, r.columns) for r in diff_rows(a, b, ["k"], n_buckets=64).collect()}
    assert got == {5: ("left_only", ""), 1500: ("left_only", ""), 9999: ("right_only", ""),
                   None: ("right_only", ""), 7: ("differs", "a"), 8: ("differs", "v"), 9: ("differs", "d"),
                   10: ("differs", "a,v")}
    assert diff_rows(a, a.repartition(9), ["k"]).count() == 0
    swapped = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string"), \
        spark.createDataFrame([(1, "y"), (2, "x")], "k long, v string")
    assert diff_rows(*swapped, ["k"], n_buckets=1).count() == 2
    assert diff_rows(a.limit(0), b.limit(0), ["k"]).count() == 0
    assert diff_rows(a, b, ["k"], columns=["s"]).filter("found = 'differs'").count() == 0


def test_only_differing_buckets_are_joined(spark):
    a = spark.createDataFrame(_rows(500), SCHEMA)
    plan = diff_rows(a, a, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan or "LocalRelation <empty>" in plan     # nothing differs: nothing is read


# ---- activation runs -------------------------------------------------------------------

def test_runs_are_ordered_by_number(spark, tmp_path):
    state = str(tmp_path / "s")
    send = lambda rows, run: {r.id for r in sync(
        spark.createDataFrame(rows, "id long, v long"), state, "id", run).collect()}
    for week in range(1, 12):
        assert send([(1, 0), (2, week)], f"week-{week}") == ({1, 2} if week == 1 else {2})
    assert send([(1, 0), (2, 11)], "week-11") == {2}                  # a repeated run sends the same
    import os
    assert sorted(os.listdir(state), key=run_order) == ["run=week-9", "run=week-10", "run=week-11"]
    assert run_order("2024-2") < run_order("2024-10") < run_order("2025-1")
