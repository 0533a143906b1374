"""Hot keys: one customer holds a third of all orders, one product a third of all
line items. Skew-sensitive queries must still equal the oracle exactly."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from test_oracle import TABLES, _digest

SRC = "/root/testdata/sf0.001"
QUERIES = ["fct_orders", "dim_customers", "mart_country_performance", "customer_churn_features",
           "order_gaps", "payment_method_affinity_pairs", "rfm_customer_features",
           "stg_customer_order_history", "revenue_by_product_lines", "revenue_by_segment",
           "return_rate_by_category_high_value", "metric_by_joined_dim", "run_tests"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES:
        src = f"read_parquet('{SRC}/{t}.parquet')"
        if t == "orders":
            sel = (f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END "
                   f"AS o_custkey) FROM {src}")
        elif t == "lineitem":
            sel = (f"SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 5 ELSE l_partkey END "
                   f"AS l_partkey) FROM {src}")
        else:
            sel = f"SELECT * FROM {src}"
        con.execute(f"COPY ({sel}) TO '{out}/{t}.parquet' (FORMAT PARQUET)")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    return str(out), con


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys_match_oracle(spark, skewed, name):
    sf, con = skewed
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_lines_are_numbered_alike_beside_hot_orders_and_without(spark, tmp_path, monkeypatch):
    """One order with a third of the lines, lines without an order, equal lines; all numbers are dense."""
    import datetime as dt

    from ledgerloom.sources import adapters
    from ledgerloom.sources.datasets import Datasets

    src = "/root/testdata/sf0.001"
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    n = li.count()
    hot = li.limit(n // 2).withColumn("l_orderkey", F.lit(1).cast(li.schema["l_orderkey"].dataType))
    none = li.limit(7).withColumn("l_orderkey", F.lit(None).cast(li.schema["l_orderkey"].dataType))
    li.unionByName(hot).unionByName(none).repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{src}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")

    def numbered(limit):
        monkeypatch.setattr(adapters, "HOT_LINES", limit)
        ds = Datasets(spark, None, dt.date(2001, 8, 2))
        ds.driver = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
        cols = ["order_item_id", "l_orderkey", *adapters.LINE_ORDER]
        return sorted(map(tuple, ds["line_items_numbered"].select(*cols).collect()))

    split, whole = numbered(20), numbered(10 ** 9)
    assert split == whole and [r[0] for r in split] == list(range(1, n + n // 2 + 8))
    keys = [((r[1] is not None, r[1] or 0), r[2:]) for r in split]
    assert keys == sorted(keys)
