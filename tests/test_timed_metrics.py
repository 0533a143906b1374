"""Cumulative, semi-additive and conversion metrics against plain Python; hot entities; odd rows."""
import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import timed_metrics as timed
from ledgerloom.operators.metrics import Metric, MetricRegistry, SemanticModel, query_metrics
from ledgerloom.plans.semantic import REGISTRY
from ledgerloom.sources.datasets import Datasets

DAY = dt.date(2020, 1, 1)


class Tables(dict):
    """Stands in for the dataset registry."""


def _events(rng, n, hot):
    """A third of the rows belong to one entity; some have no entity, no day, or tie."""
    out = []
    for i in range(n):
        who = "hot" if i % 3 == 0 and hot else (f"c{rng.randrange(12)}" if rng.random() > .05 else None)
        day = None if rng.random() < .03 else DAY + dt.timedelta(days=rng.randrange(400))
        out.append((i, who, day, rng.choice(["a", "b"]), rng.randrange(1, 50) if rng.random() > .1 else None,
                    rng.choice(["x", "y", None])))
    return out


SCHEMA = "id long, who string, day date, kind string, v long, dim string"


@pytest.fixture(scope="module")
def world(spark):
    rows = _events(random.Random(3), 900, True)
    ds = Tables(ev=spark.createDataFrame(rows, SCHEMA).repartition(7).persist())
    reg = MetricRegistry([SemanticModel("ev", "id", time_dimension="day")], [
        Metric("repeat", "ev", type="conversion", entity="who", window_days=9),
        Metric("a_then_b", "ev", type="conversion", entity="who", window_days=5, filter="kind = 'a'",
               conversion="kind = 'b'"),
        Metric("active", "ev", type="cumulative", agg="count_distinct", expr="who", window_days=20),
        Metric("ever", "ev", type="cumulative", agg="count_distinct", expr="who"),
        Metric("sum20", "ev", type="cumulative", agg="sum", expr="v", window_days=20, filter="kind = 'a'"),
        Metric("n20", "ev", type="cumulative", agg="count", expr="v", window_days=20),
        Metric("balance", "ev", type="semi_additive", agg="sum", expr="v", entity="who", order=("id",)),
        Metric("events", "ev", agg="count", expr="id")])
    return ds, reg, rows


def _month(d):
    return d.replace(day=1)


def _ends(rows):
    days = sorted(r[2] for r in rows if r[2])
    m, out = _month(days[0]), []
    while m <= days[-1]:
        after = (m + dt.timedelta(days=32)).replace(day=1)
        out.append((m, after))
        m = after
    return out


def _converted(rows, days, base, later):
    """Literal: every conversion is credited to the latest base event before it."""
    done = set()
    known = [r for r in rows if r[1] is not None and r[2] is not None]
    for c in known:
        if not later(c):
            continue
        before = [b for b in known if base(b) and b[1] == c[1] and (
            (b[2], b[0]) < (c[2], c[0]) if base is later else b[2] <= c[2])]
        if before:
            b = max(before, key=lambda r: (r[2], r[0]))
            if (c[2] - b[2]).days <= days:
                done.add(b[0])
    return done


@pytest.mark.parametrize("by", [[], ["dim"]])
def test_conversions(world, by):
    ds, reg, rows = world
    every = lambda r: True
    for name, days, base, later in (("repeat", 9, every, every),
                                    ("a_then_b", 5, lambda r: r[3] == "a", lambda r: r[3] == "b")):
        done, groups = _converted(rows, days, base, later), defaultdict(list)
        for r in rows:
            if base(r):
                groups[(r[5],) if by else ()].append(r[0] in done)
        got = {tuple(r[:-1]): r[-1] for r in query_metrics(ds, reg, [name], by).collect()}
        assert got == {k: pytest.approx(sum(v) / len(v)) for k, v in groups.items()}


def test_following_crosses_partitions(spark):
    """One entity over all partitions; nothing is lost at their edges."""
    rows = [(i, "hot" if i % 3 else f"c{i}", DAY + dt.timedelta(days=i % 50)) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "id long, who string, day date")
        found = timed.following(df, ["who", "day", "id"], ["id", "who"])
        got = {r.id: r.next_id for r in found.collect()}
        spread = found.select(F.spark_partition_id().alias("p"), "who").filter("who = 'hot'")
        assert spread.select("p").distinct().count() >= 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    assert got == {a[0]: b[0] if b else None for a, b in zip(order, [*order[1:], None])}


@pytest.mark.parametrize("by", [[], ["dim"]])
def test_cumulative(world, by):
    ds, reg, rows = world
    got = {tuple(r[:len(by) + 1]): tuple(r[len(by) + 1:]) for r in query_metrics(
        ds, reg, ["active", "ever", "sum20", "n20"], by, grain="month").collect()}
    want = {}
    for dim in ({r[5] for r in rows} if by else [None]):
        mine = [r for r in rows if r[2] and (not by or r[5] == dim)]
        for m, after in _ends(rows):
            last = [r for r in mine if after - dt.timedelta(days=20) <= r[2] < after]
            want[((dim,) if by else ()) + (m,)] = (
                len({r[1] for r in last} - {None}), len({r[1] for r in mine if r[2] < after} - {None}),
                sum(r[4] or 0 for r in last if r[3] == "a"), sum(r[4] is not None for r in last))
    assert got == want


@pytest.mark.parametrize("by", [[], ["dim"]])
def test_semi_additive(world, by):
    ds, reg, rows = world
    got = {tuple(r[:-1]): r[-1] for r in query_metrics(ds, reg, ["balance"], by, grain="month").collect()}
    want = defaultdict(int)
    for m, after in _ends(rows):
        states = {}
        for r in sorted((r for r in rows if r[1] and r[2] and r[2] < after), key=lambda r: (r[2], r[0])):
            states[r[1]] = r
        for dim in ({r[5] for r in rows if r[1]} if by else [None]):
            want[((dim,) if by else ()) + (m,)] += sum(
                r[4] or 0 for r in states.values() if not by or r[5] == dim)
    assert got == dict(want)


def test_one_request_mixes_all_types(world):
    ds, reg, rows = world
    out = query_metrics(ds, reg, ["events", "active", "balance", "repeat"], grain="month").collect()
    assert len(out) == len(_ends(rows)) + 1             # and the events without a day
    whole = query_metrics(ds, reg, ["active", "balance", "events"]).collect()
    assert len(whole) == 1 and whole[0].events == len(rows)


def test_periods_without_rows_are_there(spark):
    rows = [(1, "c", DAY, "a", 5, None), (2, "c", DAY + dt.timedelta(days=150), "a", 7, None)]
    ds = Tables(ev=spark.createDataFrame(rows, SCHEMA))
    reg = MetricRegistry([SemanticModel("ev", "id", time_dimension="day")], [
        Metric("s", "ev", type="cumulative", agg="sum", expr="v", window_days=31),
        Metric("b", "ev", type="semi_additive", agg="sum", expr="v", entity="who")])
    got = [tuple(r) for r in query_metrics(ds, reg, ["s", "b"], grain="month").orderBy("metric_time").collect()]
    assert [g[1:] for g in got] == [(5, 5), (0, 5), (0, 5), (0, 5), (7, 7)]


def test_empty_model(world, spark):
    _, reg, rows = world
    ds = Tables(ev=spark.createDataFrame([], SCHEMA))
    names = ["active", "ever", "sum20", "balance", "repeat"]
    assert query_metrics(ds, reg, names, grain="month").count() == 0
    assert len(query_metrics(ds, reg, names).collect()) == 1


def test_wrong_definitions_are_refused(world):
    ds, _, _ = world
    with pytest.raises(ValueError):
        Metric("x", "ev", type="conversion", entity="who")
    with pytest.raises(ValueError):
        Metric("x", "ev", type="semi_additive", agg="sum", expr="v")
    reg = MetricRegistry([SemanticModel("ev", "id", time_dimension="day")], [
        Metric("x", "ev", type="cumulative", agg="max", expr="v", window_days=3)])
    with pytest.raises(ValueError):
        query_metrics(ds, reg, ["x"], grain="month")


def test_a_condition_for_half_of_a_ratio_is_refused(spark):
    """H5: revenue per customer, filtered by a column that only the orders have."""
    ds = Datasets(spark, "/root/testdata/sf0.001", dt.date(2001, 8, 2))
    with pytest.raises(ValueError, match="unfiltered"):
        query_metrics(ds, REGISTRY, ["revenue_per_customer"], where="status = 'completed'")
    query_metrics(ds, REGISTRY, ["revenue_per_customer"], where="status = 'completed'",
                  unfiltered=["dim_customers"]).collect()
    query_metrics(ds, REGISTRY, ["revenue_per_customer"], where="customer_segment = 'high_value'").collect()


def test_offsets(world):
    ds, reg, rows = world
    more = MetricRegistry(list(reg.models.values()), [
        *reg.metrics.values(), Metric("before", "ev", type="offset", inputs=("events",)),
        Metric("active3", "ev", type="offset", inputs=("active",), periods=3),
        Metric("growth", "ev", type="derived", inputs=("events", "before"), derived="events - before")])
    out = query_metrics(ds, more, ["events", "before", "growth", "active", "active3"], grain="month").collect()
    got = {r.metric_time: r for r in out if r.metric_time}
    months = sorted(got)
    for i, m in enumerate(months):
        assert got[m].before == (got[months[i - 1]].events if i else None)
        assert got[m].growth == (got[m].events - got[months[i - 1]].events if i else None)
        assert got[m].active3 == (got[months[i - 3]].active if i > 2 else None)
    alone = query_metrics(ds, more, ["before"], ["dim"], grain="week").collect()
    assert {r.metric_time for r in alone if r.metric_time} >= {
        r[2] - dt.timedelta(days=r[2].weekday()) for r in rows if r[2]}
    with pytest.raises(ValueError, match="grain"):
        query_metrics(ds, more, ["before"])
