"""Batches that change tables: appends once, history by event time, buckets that keep their files."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.buckets import KeyedTable, Ledger, append_once, read_batches
from ledgerloom.operators.contracts import ContractError
from ledgerloom.operators.history import merge_history, read_current, read_history
from ledgerloom.operators.sequence import append_batch

T0 = dt.datetime(2020, 1, 1)


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


# ---- appends -----------------------------------------------------------------------

def test_a_batch_repeated_after_a_failure_is_there_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda a, b: spark.range(a, b).select("id", (F.col("id") * 2).alias("v"))
    schema = rows(0, 1).schema
    assert read_batches(spark, path, schema).count() == 0
    assert append_once(rows(0, 10), path, "2020-01-01")
    # a run that died after it had written, before it was entered in the ledger
    rows(10, 17).write.parquet(f"{path}/batch=2020-01-02")
    assert read_batches(spark, path, schema).count() == 10
    assert append_once(rows(10, 20), path, "2020-01-02")
    assert not append_once(rows(10, 20), path, "2020-01-02")        # a scheduler that runs it twice
    found = read_batches(spark, path, schema)
    assert found.columns == ["id", "v"] and sorted(r.id for r in found.collect()) == list(range(20))
    for name in ("", "a/b", "x=1", "_hidden"):
        with pytest.raises(ValueError):
            append_once(rows(0, 1), path, name)


def test_append_batch_with_a_name(spark, tmp_path):
    path, now = str(tmp_path / "t"), dt.datetime(2020, 5, 1)
    rows = spark.range(5)
    assert append_batch(rows, path, rows.schema, now, batch="b1")
    assert not append_batch(rows, path, rows.schema, now, batch="b1")
    schema = rows.withColumn("_loaded_at", F.lit(now).cast("timestamp_ntz")).schema
    assert read_batches(spark, path, schema).count() == 5
    with pytest.raises(ContractError):
        append_batch(rows.select(F.col("id").cast("string")), path, rows.schema, now, batch="b2")
    assert Ledger(spark, path).batches() == ["b1"]


# ---- history -----------------------------------------------------------------------

def _plain(events):
    """[(arrival, key, time, value, deleted)] -> versions, from all events in order of time."""
    latest = {}
    for arrival, key, at, value, gone in events:
        latest[key, at] = max(latest.get((key, at), (-1,)), (arrival, value, gone), key=lambda x: x[0])
    out, by = [], {}
    for (key, at), (_, value, gone) in latest.items():
        by.setdefault(key, []).append((at, None if gone else value, gone, value))
    for key, seen in by.items():
        seen.sort(key=lambda s: s[0])
        changes = [s for i, s in enumerate(seen)
                   if i == 0 or (s[2], s[3]) != (seen[i - 1][2], seen[i - 1][3])]
        for s, after in zip(changes, [*changes[1:], None]):
            if not s[2]:
                out.append((key, s[3], s[0], after[0] if after else None))
    return sorted(out, key=str)


def _batch(spark, events):
    return spark.createDataFrame([e[1:] for e in events], "k string, at timestamp_ntz, v long, gone boolean")


def test_history_is_that_of_all_events_in_order(spark, tmp_path):
    rng = random.Random(6)
    events, n = [], 0
    for arrival in range(4):
        batch = {}
        for _ in range(60):
            key = "hot" if rng.random() < .35 else rng.choice(["a", "b", "c", None])
            at = T0 + dt.timedelta(hours=rng.randrange(200))
            batch[key, at] = (arrival, key, at, rng.randrange(3), rng.random() < .15)
        events.append(list(batch.values()))
    path = str(tmp_path / "h")
    for i, batch in enumerate(events):
        table = merge_history(_batch(spark, batch), path, ["k"], "at", i, deleted="gone", n_buckets=4)
        want = _plain([e for b in events[:i + 1] for e in b])
        assert sorted((tuple(r) for r in read_history(table).select("k", "v", "valid_from", "valid_to")
                       .collect()), key=str) == want
    open_ = sorted(((k, v) for k, v, _, until in want if until is None), key=str)
    assert sorted(map(tuple, read_current(table).select("k", "v").collect()), key=str) == open_
    again = merge_history(_batch(spark, events[-1]), path, ["k"], "at", 3, deleted="gone")    # repeated
    assert sorted(map(tuple, read_history(again).select("k", "v", "valid_from", "valid_to").collect()),
                  key=str) == want


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = [(0, f"k{i}", T0, i, False) for i in range(200)]
    table = merge_history(_batch(spark, rows), path, ["k"], "at", 0, deleted="gone", n_buckets=16)
    before = _files(path)
    one = _batch(spark, [(1, "k7", T0 + dt.timedelta(days=1), 99, False)])
    touched = table.touched(one)
    merge_history(one, path, ["k"], "at", 1, deleted="gone", n_buckets=999)      # the table has 16
    after = _files(path)
    kept = {f for f in before if f"/bucket={touched[0]}/" not in f}
    assert len(touched) == 1 and kept and all(after[f] == before[f] for f in kept)
    assert {f for f in after if f not in before} and all(
        f"/bucket={touched[0]}/batch=1/" in f for f in after if f not in before)
    assert read_history(table).count() == 201


def test_history_odd_batches(spark, tmp_path):
    path = str(tmp_path / "h")
    empty = spark.createDataFrame([], "k string, at timestamp_ntz, v long, gone boolean")
    table = merge_history(empty, path, ["k"], "at", 0, deleted="gone")
    assert read_history(table).count() == 0
    with pytest.raises(ContractError):
        merge_history(_batch(spark, [(0, "a", None, 1, False)]), path, ["k"], "at", 1, deleted="gone")
    # a deletion of an unknown row, and two events of one key and time
    rows = [(0, "a", T0, 1, True), (0, "b", T0, 1, False), (0, "b", T0, 5, True), (0, None, T0, 2, False)]
    table = merge_history(_batch(spark, rows), path, ["k"], "at", 1, deleted="gone")
    table = merge_history(_batch(spark, rows), path, ["k"], "at", 2, deleted="gone")
    assert [tuple(r)[:2] for r in read_history(table).select("k", "v").collect()] == [(None, 2)]


def test_keyed_table_before_a_batch(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    table = KeyedTable(spark, str(tmp_path / "s"), ["k"], schema, 4)
    for b in range(5):
        rows = spark.createDataFrame([(k, b) for k in range(20)], schema)
        table.put(rows, b, table.touched(rows))
        assert {r.v for r in table.read().collect()} == {b}
    assert {r.v for r in table.read(before=4).collect()} == {3}
    assert all(len(os.listdir(f"{table.root}/{d}")) == 2 for d in os.listdir(table.root) if "bucket=" in d)
