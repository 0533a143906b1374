"""Drifting landings, the activation feed and running totals, batch by batch, with repeats and failures."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.buckets import Ledger
from ledgerloom.streaming import increments as inc

DRIFT = [("a bigint, b int", [(1, 10), (2, None)]),
         ("a bigint, b int, c string", [(3, 30, "x")]),
         ("c string, a int, b bigint, d date", [("y", 4, 5_000_000_000, None)]),
         ("a bigint, b string", [(5, "text")])]


def _deliver(spark, root, i, files=None):
    schema, rows = DRIFT[i]
    spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/in/{i}")


def test_drift_lands_and_resumes(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        _deliver(spark, root, i)
        inc.stream_drift(spark, f"{root}/in", f"{root}/t", f"{root}/chk").awaitTermination()
        inc.stream_drift(spark, f"{root}/in", f"{root}/t", f"{root}/chk").awaitTermination()   # a restart
    out = inc.read_drift(spark, f"{root}/t")
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("c", "string"), ("d", "date")]
    assert sorted(map(tuple, out.collect()), key=str) == [
        (1, "10", None, None), (2, None, None, None), (3, "30", "x", None),
        (4, "5000000000", "y", None), (5, "text", None, None)]
    assert sorted(inc.SchemaLog(spark, f"{root}/t").versions()) == [1, 2, 3, 4]


def test_drift_of_several_schemas_in_one_batch_and_a_failed_run(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        _deliver(spark, root, i)
    # a run that died: rows of batch 0 written, the batch not entered
    inc.land_drifting(spark.createDataFrame([(9, 9)], "a bigint, zz int"), f"{root}/t", 0)
    inc.stream_drift(spark, f"{root}/in", f"{root}/t", f"{root}/chk").awaitTermination()
    out = inc.read_drift(spark, f"{root}/t")
    assert sorted(r.a for r in out.collect()) == [1, 2, 3, 4]
    assert Ledger(spark, f"{root}/t").batches() == ["0"]


@pytest.mark.parametrize("policy,columns,b4", [
    ("new_columns", ["a", "b", "c", "d"], None), ("block_all", ["a", "b"], None)])
def test_drift_policies(spark, tmp_path, policy, columns, b4):
    root = str(tmp_path)
    for i in range(4):
        _deliver(spark, root, i)
        inc.stream_drift(spark, f"{root}/in", f"{root}/t", f"{root}/chk", policy).awaitTermination()
    out = inc.read_drift(spark, f"{root}/t")
    assert out.columns == columns and dict(out.dtypes)["b"] == "int"
    assert {r.a: r.b for r in out.collect()} == {1: 10, 2: None, 3: 30, 4: b4, 5: None}


def test_drift_blocks_and_hashes_columns(spark, tmp_path):
    root = str(tmp_path)
    _deliver(spark, root, 1)
    inc.stream_drift(spark, f"{root}/in", f"{root}/t", f"{root}/chk", hashed=["c"],
                     blocked=["b"]).awaitTermination()
    row = inc.read_drift(spark, f"{root}/t").first()
    assert row.asDict().keys() == {"a", "c"} and len(row.c) == 64
    with pytest.raises(ValueError):
        inc.read_drift(spark, f"{root}/none")
    with pytest.raises(ValueError):
        inc.evolved(None, spark.range(1).schema, "maybe")


def test_activation_sends_a_change_once(spark, tmp_path):
    schema = "k string, name string, v double, at int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    kind = df([]).schema
    feed = inc.ActivationFeed(spark, f"{tmp_path}/s", f"{tmp_path}/o", ["k"], kind, compare=["v"], order="at",
                              n_buckets=4)
    assert feed.messages().count() == 0
    feed(df([("a", "A", 1.0, 1), ("a", "A", 2.0, 2), (None, "N", None, 1), ("b", "B", 1.0, 1)]), 0)
    second = df([("a", "renamed", 2.0, 3), ("b", "B", None, 3), (None, "N", None, 3), ("c", "C", 7.0, 3)])
    feed(second, 1)
    feed(second, 1)                     # the batch is repeated
    feed(second, 2)                     # and the rows come again
    feed(df([]), 3)
    got = sorted(((r.batch, r.k, r.v, r.change) for r in feed.messages().collect()), key=str)
    assert got == sorted([(0, "a", 2.0, "new"), (0, None, None, "new"), (0, "b", 1.0, "new"),
                          (1, "b", None, "updated"), (1, "c", 7.0, "new")], key=str)


def _expected(versions):
    latest = {}
    for k, version, g, v, ok in versions:
        if k not in latest or version >= latest[k][0]:
            latest[k] = (version, g, v, ok)
    out = {}
    for _, g, v, ok in latest.values():
        if ok:
            out.setdefault(g, []).append(v)
    seen = lambda vs, f: f([v for v in vs if v is not None], default=None)
    return {g: (len(vs), sum(v or 0 for v in vs), seen(vs, min), seen(vs, max)) for g, vs in out.items()}


def test_running_totals_with_retractions(spark, tmp_path):
    rng = random.Random(11)
    schema = spark.createDataFrame([], "k long, version int, g string, v long, ok boolean").schema
    totals = inc.RunningTotals(spark, str(tmp_path), schema, ["k"], "version", ["g"], sums={"s": "v"},
                               least={"lo": "v"}, greatest={"hi": "v"}, where="ok", n_buckets=3)
    seen, version = [], {}
    for batch in range(5):
        rows = []
        for _ in range(70):
            k = rng.randrange(40)
            late = rng.random() < .15 and version.get(k, 0) > 1
            version[k] = version.get(k, 0) + (not late)
            at = rng.randrange(1, version[k]) if late else version[k]
            if late and any(s[:2] == (k, at) for s in seen + rows):
                continue
            rows.append((k, at, rng.choice(["hot", "hot", "x", None]),
                         rng.choice([None, *range(-20, 20)]), rng.random() < .8))
        df = spark.createDataFrame(rows, schema)
        if batch == 2:      # died after the rows' state was written, before the totals
            held = totals.totals.put
            totals.totals.put = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
            with pytest.raises(RuntimeError):
                totals(df, batch)
            totals.totals.put = held
        totals(df, batch)
        if batch == 3:
            totals(df, batch)           # repeated
        seen += sorted(rows, key=lambda r: r[1])
        got = {r.g: (r.n, r.s, r.lo, r.hi) for r in totals.result().collect()}
        assert got == _expected(sorted(seen, key=lambda r: r[1]))


def test_a_stream_feeds_the_totals_in_many_micro_batches(spark, tmp_path):
    rows = spark.range(400).select("id", (F.col("id") % 7).alias("g"), F.lit(1).alias("version"))
    rows.repartition(9).write.parquet(f"{tmp_path}/in")
    totals = inc.RunningTotals(spark, f"{tmp_path}/s", rows.schema, ["id"], "version", ["g"], sums={"s": "id"},
                               n_buckets=2)
    query = inc.run_batches(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/chk", totals, max_files=4)
    query.awaitTermination()
    assert len(totals.rows.ledger.batches()) == 3
    want = {r.g: (r.n, r.s) for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()}
    assert {r.g: (r.n, r.s) for r in totals.result().collect()} == want
