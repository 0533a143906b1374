"""Metrics over time: conversions, balances (semi-additive) and trailing windows.

All three end as *changes*: rows (dimensions, day, change) whose running sum is the
metric. Changes are summed by period, periods without any are filled from a calendar
spine, and one running sum over a table bounded by the calendar gives the values, so
no row is multiplied by the length of a window or by the number of periods.

* :func:`trailing_changes` - sum, count or distinct count over the last N days, or
  over all time. A value enters on its day and leaves N days later. For a distinct
  count every entity's active days are merged into spans: +1 where a span begins, -1
  where it ends.
* :func:`balance_changes` - the last state of an entity in a period holds until its
  next state: the old value leaves (under its old dimensions), the new one enters.
* :func:`conversions` - every conversion event is credited to the latest base event of
  its entity at or before it; a base event converts if one credited to it lies within
  the window. So only the event that follows a base event matters, found by
  :func:`following` over the union of both streams, range-sorted by entity and time:
  an entity with a third of all events is split over many partitions, and each
  partition gets the first row of the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.sequence import dealt, positioned

_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH",
         "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}


def period_of(day: Column, grain: str) -> Column:
    return day if grain == "day" else F.trunc(day, grain)


def following(df: DataFrame, order: Sequence[str], columns: Sequence[str], prefix: str = "next_",
              back: bool = False, parts: int | None = None) -> DataFrame:
    """``df`` with ``columns`` of the row after it in ``order`` (``back``: before it), over the whole table.

    Rows are range-partitioned by ``order`` and written with their place; the row after
    the last one of a partition is the first of the next partition that has rows (one
    row a partition). ``parts``: how many partitions, else the session's number.
    """
    pos = positioned(df, order, "following", parts)
    step, edge = (F.lag, F.max_by) if back else (F.lead, F.min_by)
    near = F.struct(*columns)
    inside = Window.partitionBy("__pid").orderBy("__pos")
    edges = pos.groupBy("__pid").agg(edge(near, F.col("__pos")).alias("__edge"))
    edges = edges.select("__pid", step("__edge").over(Window.orderBy("__pid")).alias("__carried"))
    rows = dealt(pos, parts, "__pid").withColumn("__after", step(near).over(inside)).join(
        F.broadcast(edges), "__pid")                    # one row a partition
    after = F.coalesce("__after", "__carried")
    return rows.select(*df.columns, *(after[c].alias(f"{prefix}{c}") for c in columns))


def conversions(base: DataFrame, conversion: DataFrame | None, entity: str, time: str, event: str,
                window_days: int) -> DataFrame:
    """``base`` with ``converted``: whether a conversion within the window is credited to it.

    ``event`` identifies an event and orders those of one time. Without ``conversion``
    every base event is also a conversion for the one before it (a repeat); else
    ``conversion`` has ``entity`` and ``time``, and at equal times it counts as later.
    Events without entity or time do not convert and are not conversions.
    """
    known = lambda df: df.filter(F.col(entity).isNotNull() & F.col(time).isNotNull())
    stream = known(base).select("*", F.lit(0).alias("__kind"))
    if conversion is not None:
        stream = stream.unionByName(known(conversion).select(entity, time).withColumn(
            "__kind", F.lit(1)), allowMissingColumns=True)
    rows = following(stream, [entity, time, "__kind", event], [entity, time, "__kind"], "__next_")
    days = F.datediff(F.col(f"__next_{time}").cast("date"), F.col(time).cast("date"))
    hit = (F.col(f"__next_{entity}") == F.col(entity)) & (days <= window_days)
    if conversion is not None:
        hit = hit & (F.col("__next___kind") == 1)
    out = rows.filter("__kind = 0").select(*base.columns, F.coalesce(hit, F.lit(False)).alias("converted"))
    lost = base.filter(F.col(entity).isNull() | F.col(time).isNull())
    return out.unionByName(lost.withColumn("converted", F.lit(False)))


def trailing_changes(df: DataFrame, dims: Sequence[str], day: str, agg: str, value: Column,
                     window_days: int | None) -> DataFrame:
    """(dims, day, change) of a sum, count or distinct count of ``value`` over trailing days.

    Without ``window_days`` over all days so far.
    """
    rows = df.filter(F.col(day).isNotNull()).select(*dims, F.col(day).cast("date").alias("__day"),
                                                    value.alias("__value"))
    if agg in ("sum", "count"):
        total = rows.groupBy(*dims, "__day").agg(getattr(F, agg)("__value").alias("__change"))
        total = total.withColumn("__change", F.coalesce("__change", F.lit(0)))
        moves = [F.struct(F.col("__day").alias("day"), F.col("__change").alias("change"))]
        if window_days is not None:
            moves.append(F.struct(F.date_add("__day", window_days).alias("day"),
                                  (-F.col("__change")).alias("change")))
        return total.select(*dims, F.inline(F.array(*moves)))
    if agg != "count_distinct":
        raise ValueError(f"a trailing window takes sum, count or count_distinct, not {agg!r}")
    # an entity's days are at most the calendar's; combined map-side
    days = rows.filter("__value is not null").groupBy(*dims, "__value").agg(
        F.sort_array(F.collect_set("__day")).alias("days"))
    if window_days is None:
        spans = F.array(F.struct(F.col("days")[0].alias("day"), F.lit(1).alias("change")))
    else:
        leaves = lambda d, i: F.least(
            F.date_add(d, window_days), F.coalesce(F.get("days", i + 1), F.date_add(d, window_days)))
        spans = F.flatten(F.transform("days", lambda d, i: F.array(
            F.struct(d.alias("day"), F.lit(1).alias("change")),
            F.struct(leaves(d, i).alias("day"), F.lit(-1).alias("change")))))
    return days.select(*dims, F.inline(spans))


def balance_changes(df: DataFrame, dims: Sequence[str], entity: str, day: str, value: Column,
                    order: Sequence[str], grain: str) -> DataFrame:
    """(dims, day, change) of the sum over entities of their last ``value`` in or before a period.

    ``order`` tells which of an entity's states of one day is the last.
    """
    state = F.struct(*dims, F.coalesce(value, F.lit(0)).alias("__value"))
    last = (df.filter(F.col(entity).isNotNull() & F.col(day).isNotNull())
            .groupBy(entity, period_of(F.col(day).cast("date"), grain).alias("day"))
            .agg(F.max_by(state, F.struct(day, *order)).alias("__now")))
    # at most one row per entity and period
    before = F.lag("__now").over(Window.partitionBy(entity).orderBy("day"))
    moved = last.select("day", "__now", before.alias("__before"))
    enter = F.struct(*(F.col(f"__now.{d}").alias(d) for d in dims), F.col("day"),
                     F.col("__now.__value").alias("change"))
    leave = F.struct(*(F.col(f"__before.{d}").alias(d) for d in dims), F.col("day"),
                     (-F.col("__before.__value")).alias("change"))
    return moved.select(F.inline(F.when(F.col("__before").isNull(), F.array(enter))
                                 .otherwise(F.array(enter, leave))))


def spread(changes: DataFrame, dims: Sequence[str], bounds: DataFrame, grain: str | None, name: str
           ) -> DataFrame:
    """The running sum of ``changes`` at the end of every period: (dims, metric_time, name).

    ``bounds`` is one row (first, last) of days; all periods between them are there for
    every combination of the dimensions. Without a grain: the value at the end of the
    last day.
    """
    if grain is None:
        moved = changes.crossJoin(F.broadcast(bounds)).filter("day <= last")
        total = F.coalesce(F.sum("change"), F.lit(0)).alias(name)
        return moved.groupBy(*dims).agg(total) if dims else moved.agg(total)
    periods = F.explode(F.sequence(period_of(F.col("first"), grain), period_of(F.col("last"), grain),
                                   F.expr(_STEP[grain])))
    known = bounds.filter("first is not null")
    groups = changes.select(*dims).distinct().crossJoin(F.broadcast(known)) if dims else known
    spine = groups.select(*dims, periods.alias("metric_time")).withColumn("change", F.lit(0))
    moved = changes.select(*dims, period_of(F.col("day"), grain).alias("metric_time"), "change")
    totals = moved.unionByName(spine.select(*moved.columns)).groupBy(*dims, "metric_time").agg(
        F.sum("change").alias("change"))
    run = Window.partitionBy(*dims).orderBy("metric_time").rowsBetween(Window.unboundedPreceding, 0)
    summed = totals.withColumn(name, F.sum("change").over(run))
    return summed.crossJoin(F.broadcast(known)).filter(
        F.col("metric_time") <= F.col("last")).select(*dims, "metric_time", name)
