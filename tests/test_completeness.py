"""Completeness and state: nothing cut, nothing stale, links in metric requests, named targets."""
import datetime as dt
import os
import shutil
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators.activation import sync
from ledgerloom.operators.metrics import Metric, MetricRegistry, SemanticModel, query_metrics
from ledgerloom.operators.quality import facts_long, reconcile
from ledgerloom.plans.checks import DIM_CUSTOMERS_DOCS, contract_check
from ledgerloom.sources.datasets import Datasets, publish

SF = "/root/testdata/sf0.001"
DAY = dt.date(2001, 8, 2)


# ------------------------------------------------------------------ whole input ---

@pytest.fixture(scope="module")
def long_order(tmp_path_factory):
    """A copy of the tables in which one order has 250 lines."""
    out = tmp_path_factory.mktemp("long")
    for f in os.listdir(SF):
        shutil.copyfile(f"{SF}/{f}", f"{out}/{f}")
    duckdb.sql(f"""COPY (SELECT * REPLACE (CASE WHEN rowid < 250 THEN 1 ELSE l_orderkey END AS l_orderkey)
                   FROM (SELECT *, row_number() OVER () - 1 AS rowid FROM '{SF}/lineitem.parquet'))
                   TO '{out}/lineitem.parquet' (FORMAT parquet)""")
    return str(out)


def test_line_ids_are_unique_in_long_orders(spark, long_order):
    items = Datasets(spark, long_order, DAY)["raw_order_items"]
    n = items.count()
    assert n == items.select("order_item_id").distinct().count()
    assert items.groupBy("order_id").count().agg(F.max("count")).first()[0] >= 250


def test_every_order_is_kept_and_prospects_have_none(spark):
    ds = Datasets(spark, SF, DAY)
    assert ds["raw_orders"].count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet").count()
    idle = ds["dim_customers"].filter("number_of_orders = 0")
    assert idle.filter("customer_id < 0").count() == suppliers
    ids = ds["raw_customers"].select("customer_id")
    assert ids.distinct().count() == ids.count()


def test_changed_input_and_day_are_seen(spark, tmp_path):
    for f in os.listdir(SF):
        shutil.copyfile(f"{SF}/{f}", f"{tmp_path}/{f}")
    make = lambda day: Datasets(spark, str(tmp_path), day, land_sources=True, materialize=True)
    before = make(DAY)["raw_customers"].count()
    again = make(DAY)
    assert again["raw_customers"].count() == before
    duckdb.sql(f"COPY (SELECT * FROM '{SF}/customer.parquet' LIMIT 10) TO '{tmp_path}/customer.parquet'")
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet").count()
    assert make(DAY)["raw_customers"].count() == 10 + suppliers
    assert Datasets(spark, SF).as_of == dt.date.today()
    a, b = (Datasets(spark, SF, d, land_sources=True, materialize=True)["mart_customer_segments"]
            .agg(F.sum("days_since_last_order")).first()[0] for d in (DAY, DAY + dt.timedelta(days=1)))
    assert a != b


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Session:
    def __init__(self, master):
        self.conf = _Conf(**{"spark.master": master})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,512]", ""])
def test_no_local_scratch_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session(master))


def test_local_scratch_in_local_mode():
    for master in ("local", "local[4]", "local[*]"):
        assert os.path.isdir(session.checkpoint_root(_Session(master)))


# ---------------------------------------------------------------- empty products ---

def test_cross_join_models_without_orders(spark):
    full = Datasets(spark, SF, DAY)
    orders = full["raw_orders"].filter("status != 'COMPLETED'")
    assert full.with_tables(raw_orders=orders)["finance_fct_revenue_by_product"].count() == 0
    none = full.with_tables(raw_orders=orders.limit(0), raw_payments=full["raw_payments"].limit(0))
    assert none["finance_fct_revenue_by_product"].count() == 0
    by_product = none["fct_revenue_by_product"]      # products LEFT JOIN orders: every product stays
    assert by_product.count() == full["dim_products"].count()
    assert by_product.agg(F.sum("total_orders"), F.sum("recognised_revenue")).first()[:] == (0, 0)


# ---------------------------------------------------------------------- metrics ---

REG = MetricRegistry(
    [SemanticModel("o", "order_id", "day", {"c": ("customer_id", "customer_id")}),
     SemanticModel("c", "customer_id")],
    [Metric("n", "o", agg="count_distinct", expr="order_id"),
     Metric("rev", "o", agg="sum", expr="amount"), Metric("avg", "o", agg="average", expr="amount"),
     Metric("least", "o", agg="min", expr="amount"), Metric("days", "o", agg="count_distinct", expr="day"),
     Metric("gold_rev", "o", agg="sum", expr="amount", filter="tier = 'gold'"),
     Metric("gold_done", "o", agg="count", expr="order_id", filter="tier = 'gold' and status = 'done'"),
     Metric("customers", "c", agg="count_distinct", expr="customer_id"),
     Metric("per", "o", type="derived", inputs=("rev", "customers"), derived="rev / customers")])


@pytest.fixture(scope="module")
def shop(spark):
    """One customer has a third of all orders; two orders have an unknown customer."""
    rows = [(i, 1 if i % 3 == 0 else i % 40, dt.date(2020, 1 + i % 5, 1), Decimal(i % 97),
             "done" if i % 4 else "open") for i in range(3000)]
    rows += [(9001, 999, dt.date(2020, 1, 1), Decimal(5), "done"), (9002, None, None, None, None)]
    o = spark.createDataFrame(rows, "order_id int, customer_id int, day date, amount decimal(10,2), status string")
    c = spark.createDataFrame([(i, "gold" if i % 7 == 1 else "basic", f"c{i % 3}") for i in range(40)],
                              "customer_id int, tier string, country string")
    flat = o.join(c, "customer_id", "left").toPandas()
    return {"o": o, "c": c}, flat


def test_where_on_a_linked_dimension(spark, shop):
    ds, flat = shop
    got = {r.metric_time: (r.n, r.rev, r.avg, r.least, r.days) for r in query_metrics(
        ds, REG, ["n", "rev", "avg", "least", "days"], grain="month", where="tier = 'gold'").collect()}
    gold = flat[flat.tier == "gold"]
    for day, part in gold.groupby("day"):
        n, rev, avg, least, days = got.pop(day)
        assert (n, rev, least, days) == (len(part), part.amount.sum(), part.amount.min(), 1)
        assert avg == pytest.approx(float(part.amount.sum()) / len(part))
    assert not got


def test_linked_dimension_conditions_and_groups(spark, shop):
    ds, flat = shop
    rows = query_metrics(ds, REG, ["n", "gold_rev", "gold_done"], by=["country", "status"]).collect()
    got = {(r.country, r.status): (r.n, r.gold_rev, r.gold_done) for r in rows}
    flat = flat.assign(country=flat.country.fillna("-"), status=flat.status.fillna("-"))
    for (c, s), part in flat.groupby(["country", "status"]):
        gold = part[part.tier == "gold"]
        want = (len(part), gold.amount.sum() if len(gold) else None, len(gold) if s == "done" else 0)
        assert got[None if c == "-" else c, None if s == "-" else s] == want
    # the fact is aggregated by key before the join
    plan = query_metrics(ds, REG, ["rev"], by=["country"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join") and plan.count("Aggregate") >= 2


def test_where_goes_to_the_models_that_reach_it(spark, shop):
    ds, flat = shop
    done = flat[flat.status == "done"]
    with pytest.raises(ValueError, match="unfiltered"):          # reaches one of two models
        query_metrics(ds, REG, ["per"], where="status = 'done'")
    got = query_metrics(ds, REG, ["per"], where="status = 'done'", unfiltered=["c"]).first()[0]
    assert got == pytest.approx(float(done.amount.sum()) / 40)
    gold = query_metrics(ds, REG, ["per"], where="tier = 'gold'").first()[0]     # both reach it
    part = flat[flat.tier == "gold"]
    assert gold == pytest.approx(float(part.amount.sum()) / sum(i % 7 == 1 for i in range(40)))
    mixed = query_metrics(ds, REG, ["rev"], where="tier = 'gold' or amount > 90").first()[0]
    assert mixed == flat[(flat.tier == "gold") | (flat.amount > 90)].amount.sum()
    with pytest.raises(ValueError, match="cannot be reached"):
        query_metrics(ds, REG, ["customers"], where="status = 'done'")
    with pytest.raises(ValueError, match="cannot be reached"):
        query_metrics(ds, REG, ["customers"], where="no_such_column = 1")


# ---------------------------------------------------------------- named targets ---

def test_publish_to_a_folder_and_a_catalog(spark, tmp_path):
    ds = Datasets(spark, SF, DAY)
    places = publish(ds, ["dim_customers", "stg_orders", "int_customer_orders"], path=str(tmp_path),
                     docs={"dim_customers": DIM_CUSTOMERS_DOCS})
    assert places == {"dim_customers": f"{tmp_path}/dim_customers", "stg_orders": "stg_orders"}
    back = spark.read.parquet(places["dim_customers"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ds["dim_customers"].collect()))
    assert {f.name: f.metadata["comment"] for f in back.schema if "comment" in f.metadata} == DIM_CUSTOMERS_DOCS
    assert spark.table("stg_orders").count() == ds["stg_orders"].count()

    spark.sql("CREATE DATABASE IF NOT EXISTS shop_marts")
    try:
        publish(ds, ["dim_products"], schema="shop_marts", docs={"dim_products": {"product_id": "Key."}},
                comments={"dim_products": "One row per product."},
                properties={"dim_products": {"quality": "gold", "team": "platform"}})
        assert ds.source("shop_marts", "dim_products").count() == ds["dim_products"].count()
        info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED shop_marts.dim_products").collect()}
        assert info["Comment"] == "One row per product."
        assert "quality=gold" in info["Table Properties"] and "team=platform" in info["Table Properties"]
        comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE shop_marts.dim_products").collect()}
        assert comments["product_id"] == "Key."
        other = Datasets(spark, catalog={"stg_products": "shop_marts.dim_products"})
        assert other["dim_products"].count() == ds["dim_products"].count()
    finally:
        spark.sql("DROP DATABASE shop_marts CASCADE")


def test_contract_check_sees_a_broken_model(spark):
    ds = Datasets(spark, SF, DAY)
    good = ds["dim_products"]
    broken = good.drop("is_active").withColumn("unit_price", F.col("unit_price").cast("string")) \
        .withColumn("colour", F.lit("x")).unionByName(
            good.drop("is_active").withColumn("unit_price", F.lit("1")).withColumn("colour", F.lit("x")).limit(1))
    row = {r.model: r for r in contract_check(ds.with_tables(dim_products=broken)).collect()}["dim_products"]
    assert (row.missing_columns, row.extra_columns, row.type_mismatches, row.duplicate_keys, row.status) == \
        (1, 1, 1, 1, "fail")


# ----------------------------------------------------------- activation and facts ---

def test_activation_state_over_runs(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "id string, amount int")
    state = str(tmp_path / "state")
    send = lambda rows, run: {r.id: r.change for r in sync(make(rows), state, "id", run).collect()}
    assert send([("a", 1), ("b", 2)], "2001-08-01") == {"a": "new", "b": "new"}
    assert send([("a", 1), ("b", 3), ("c", 4)], "2001-08-02") == {"b": "updated", "c": "new"}
    assert send([("a", 1), ("b", 3), ("c", 4)], "2001-08-02") == {"b": "updated", "c": "new"}    # repeated run
    assert send([("c", 4)], "2001-08-03") == {}
    assert send([("a", 1), ("c", None)], "2001-08-04") == {"a": "new", "c": "updated"}


# fixed values: golden facts of the reference's seed rows
GOLDEN_FACTS = {"orders_total": "71", "orders_completed": "52", "orders_returned": "10",
                "orders_shipped": "6", "orders_placed": "3", "recognised_revenue": "14364.45",
                "paid_all_statuses": "16087.93"}


def test_reconcile_with_committed_facts(spark):
    """Orders with the reference's totals agree with the committed facts; a lost order does not."""
    counts = {"completed": 52, "returned": 10, "shipped": 6, "placed": 3}
    rest = Decimal("16087.93") - Decimal("14364.45")
    paid = [(s, (Decimal("14364.45") if s == "completed" else rest if s == "returned" else Decimal(0))
             if i == 0 else Decimal(0)) for s, n in counts.items() for i in range(n)]
    orders = spark.createDataFrame([(i, s, p) for i, (s, p) in enumerate(paid)],
                                   "order_id int, status string, amount_paid decimal(18,2)")
    committed = spark.createDataFrame(list(GOLDEN_FACTS.items()), "fact string, value string")

    def facts(df):
        done = F.col("status") == "completed"
        return facts_long(df, {
            "orders_total": F.count(F.lit(1)),
            **{f"orders_{s}": F.count_if(F.col("status") == s) for s in counts},
            "recognised_revenue": F.sum(F.when(done, F.col("amount_paid"))).cast("decimal(18,2)"),
            "paid_all_statuses": F.sum("amount_paid").cast("decimal(18,2)")})

    assert all(r.matches for r in reconcile(facts(orders), committed, ["fact"]).collect())
    bad = {r.fact for r in reconcile(facts(orders.filter("order_id > 0")), committed, ["fact"]).collect()
           if not r.matches}
    assert bad == {"orders_total", "orders_completed", "recognised_revenue", "paid_all_statuses"}


def test_metric_views_keep_their_metadata():
    from ledgerloom.plans.semantic import CUSTOMERS_VIEW, ORDERS_VIEW

    revenue = {m.name: m for m in ORDERS_VIEW.measures}["total_revenue"]
    assert revenue.meta["format"]["currency_code"] == "USD"
    assert revenue.meta["format"]["decimal_places"] == {"type": "exact", "places": 2}
    assert "recognised revenue" in revenue.meta["synonyms"]
    assert all("synonyms" in f.meta for v in (ORDERS_VIEW, CUSTOMERS_VIEW) for f in v.dimensions + v.measures)


def test_metric_views_have_no_expand(spark):
    from ledgerloom.plans.semantic import CUSTOMERS_VIEW, ORDERS_VIEW

    ds = Datasets(spark, SF, DAY)
    for view, df in ((ORDERS_VIEW, ds["fct_orders"]), (CUSTOMERS_VIEW, ds["dim_customers"])):
        plan = view.query(df)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan


def test_end_of_a_run_clears_its_scratch(spark, monkeypatch):
    from ledgerloom.sources import datasets

    monkeypatch.setattr(session, "_SCRATCH", [])
    monkeypatch.setattr(datasets, "_LANDED", {})
    monkeypatch.setattr(datasets, "_PATHS", {})
    ds = Datasets(spark, SF, DAY, land_sources=True)
    n, path = ds["raw_products"].count(), ds.landed_path("raw_products")
    assert os.path.isdir(path)
    assert datasets.end_run(spark) >= 1 and not os.path.exists(path)
    assert Datasets(spark, SF, DAY, land_sources=True)["raw_products"].count() == n


def test_affinity_needs_few_items(spark):
    from ledgerloom.operators.affinity import affinity_pairs

    df = spark.range(200).selectExpr("id % 5 as k", "cast(id as string) as item", "cast(1 as decimal(18,2)) as v")
    with pytest.raises(ValueError, match="more than 64"):
        affinity_pairs(df, "k", "item", "v")
