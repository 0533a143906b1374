"""Activation feed: emit new or changed rows since the previous sync.

``changed_rows`` joins the current snapshot to the previous one on the key
(one shuffle of each side by key) and compares every payload column with the
null-safe ``<=>``, so a NULL -> value change is detected and no hash collision
can hide an update. Rows that disappeared send nothing (the feed only pushes
new and updated rows).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import title_from_snake
from ledgerloom.operators.buckets import children, remove


def changed_rows(current: DataFrame, previous: DataFrame, key: str | Sequence[str],
                 compare: Sequence[str] | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(compare) if compare is not None else [c for c in current.columns
                                                      if c not in keys]
    prev = previous.select(*[F.col(k).alias(f"__p_{k}") for k in keys],
                           *[F.col(c).alias(f"__p_{c}") for c in cols],
                           F.lit(True).alias("__seen"))
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__p_{k}")
        cond = c if cond is None else cond & c
    j = current.join(prev, cond, "left")
    same = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
        same = e if same is None else same & e
    change = F.when(F.col("__seen").isNull(), F.lit("new")) \
        .when(~same if same is not None else F.lit(False), F.lit("updated"))
    return j.select(*current.columns, change.alias("change")).filter(F.col("change").isNotNull())


def run_order(run: str) -> tuple:
    """Order of run names: numbers in them count as numbers, so ``week-10`` is after ``week-9``."""
    return tuple((1, int(part), "") if part.isdigit() else (0, 0, part)
                 for part in re.split(r"(\d+)", run) if part)


def sync(current: DataFrame, state: str, key: str | Sequence[str], run: str,
         compare: Sequence[str] | None = None, keep: int = 2) -> DataFrame:
    """One run of the feed: the rows of ``current`` to send, compared with the last run's.

    ``state`` is a folder with one snapshot a run (``run=<name>``). The snapshot of
    this run is written first and the rows to send are read from the two
    snapshots, so what was compared is what was stored, and a run that is
    repeated after a failure overwrites its own snapshot and sends the same rows.
    Runs are ordered by :func:`run_order` of their names. The first run sends every row as
    new. Of the snapshots before this one the last ``keep`` stay.
    """
    spark = current.sparkSession
    current.write.mode("overwrite").parquet(f"{state}/run={run}")
    names = [c.split("=", 1)[1] for c in children(spark, state) if c.startswith("run=")]
    before = sorted((n for n in names if run_order(n) < run_order(run)), key=run_order)
    last = before[-1] if before else None
    for old in before[:-max(1, keep)]:
        remove(spark, f"{state}/run={old}")
    now = spark.read.schema(current.schema).parquet(f"{state}/run={run}")
    before = spark.read.schema(current.schema).parquet(f"{state}/run={last}") if last \
        else now.limit(0)
    return changed_rows(now, before, key, compare)


def render_message(df: DataFrame, title_col: str, name_col: str,
                   lines: Sequence[Sequence[tuple[str, str]]], sep: str = "  |  ",
                   output: str = "message") -> DataFrame:
    """Chat-message text: title-cased ``title_col`` and name, then lines of label and value.

    ``'high_value_open'`` renders as ``'High Value Open'``; NULL parts are skipped.
    """
    head = F.concat(title_from_snake(title_col), F.lit(" - "), F.col(name_col))
    body = [F.concat_ws(sep, *[F.concat(F.lit(label), F.col(c).cast("string"))
                               for label, c in parts]) for parts in lines]
    return df.withColumn(output, F.concat_ws("\n", head, *body))
