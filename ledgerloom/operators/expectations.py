"""Row expectations: warn (keep, count), drop (filter, count), fail (raise).

Violation counts are collected with :class:`pyspark.sql.Observation` metrics
attached *before* the drop filters, so they ride along with the job that
writes the table (batch) or with each micro-batch (streaming,
``StreamingQuery.recentProgress[*].observedMetrics``); no extra scan.

A check whose predicate evaluates to NULL is a violation (not TRUE = bad).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    sql: str                 # boolean SQL predicate over the row
    action: str = "warn"     # warn | drop | fail

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, got {self.action!r}")

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.sql), F.lit(False))


def expectation_metrics(expectations: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("__rows")] + [
        F.sum(F.when(e.violated(), 1).otherwise(0)).alias(e.name) for e in expectations
    ]


def apply_expectations(df: DataFrame, expectations: Sequence[Expectation],
                       observation: Observation | str | None = None,
                       ) -> tuple[DataFrame, Observation | str]:
    """Attach violation counters, fail on ``fail`` rules, drop on ``drop`` rules.

    Returns the cleaned DataFrame and the observation handle. For batch
    DataFrames ``observation.get`` returns ``{name: violations, '__rows': n}``
    after the first action; for streams pass a string name and read
    ``observedMetrics`` from the query progress.
    """
    if not expectations:
        return df, observation
    obs = observation if observation is not None else Observation("expectations")
    out = df.observe(obs, *expectation_metrics(expectations))
    for e in expectations:
        if e.action == "fail":
            # a filter predicate is never pruned, so the check runs on every row
            out = out.filter(F.coalesce(
                F.when(e.violated(), F.raise_error(F.lit(f"expectation {e.name} failed")))
                .cast("boolean"),
                F.lit(True)))
    drops = [e.violated() for e in expectations if e.action == "drop"]
    if drops:
        bad = drops[0]
        for d in drops[1:]:
            bad = bad | d
        out = out.filter(~bad)
    return out, obs


def expectation_report(df: DataFrame, expectations: Sequence[Expectation],
                       table: str) -> DataFrame:
    """One aggregate pass: ``[table, expectation, action, rows, violations]``."""
    agg = df.agg(*expectation_metrics(expectations))
    stack = ", ".join(
        f"'{e.name}', '{e.action}', cast(`{e.name}` as bigint)" for e in expectations)
    return agg.select(
        F.lit(table).alias("table_name"),
        F.col("__rows").alias("rows"),
        F.expr(f"stack({len(expectations)}, {stack}) as (expectation, action, violations)"),
    ).select("table_name", "expectation", "action", "rows",
             F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))


def enforce(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Apply drop/fail rules without metrics (for plans reused in many queries)."""
    out = df
    for e in expectations:
        if e.action == "fail":
            out = out.filter(F.coalesce(
                F.when(e.violated(), F.raise_error(F.lit(f"expectation {e.name} failed")))
                .cast("boolean"),
                F.lit(True)))
    for e in expectations:
        if e.action == "drop":
            out = out.filter(~e.violated())
    return out
