"""Period-over-period change (MoM, QoQ, YoY) on calendar periods.

The fact is first reduced to one row per period (partial aggregation; the
result is bounded by the calendar, not by the data), then each period is
joined to the period ``lag`` steps earlier. Joining on the calendar instead of
``lag()`` over rows keeps the comparison right when a period has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def period_totals(df: DataFrame, date_col: str, value: Column | str, grain: str = "month",
                  name: str = "value") -> DataFrame:
    if grain not in _MONTHS:
        raise ValueError(f"grain must be one of {sorted(_MONTHS)}")
    v = value if isinstance(value, Column) else F.col(value)
    return df.groupBy(F.trunc(F.col(date_col), grain).alias("period")).agg(F.sum(v).alias(name))


def period_growth(df: DataFrame, date_col: str, value: Column | str, grain: str = "month",
                  lag: int = 1, name: str = "value") -> DataFrame:
    """``[period, value, prev_value, change, growth_pct]``; ``lag`` counts periods."""
    cur = period_totals(df, date_col, value, grain, name)
    prev = cur.select(F.add_months("period", _MONTHS[grain] * lag).alias("period"),
                      F.col(name).alias(f"prev_{name}"))
    out = cur.join(prev, "period", "left")
    p = F.col(f"prev_{name}")
    return out.select(
        "period", name, p.alias(f"prev_{name}"),
        (F.col(name) - p).alias("change"),
        ((F.col(name) - p).cast("double") / F.when(p != 0, p.cast("double")) * 100)
        .alias("growth_pct"),
    )


def windowed_totals(df: DataFrame, date_col: str, value: Column | str, grain: str = "month",
                    by: Sequence[str] = (), trailing: int | None = None,
                    name: str = "value") -> DataFrame:
    """``[by..., period, value, windowed]``: running total, or that of the last ``trailing`` periods.

    The window slides over the periods of each group, a table bounded by the
    calendar; it counts calendar periods, so periods without rows add nothing to a
    window. They are no rows of the result (a cumulative metric has them, see
    :mod:`ledgerloom.operators.timed_metrics`).
    """
    if grain not in _MONTHS:
        raise ValueError(f"grain must be one of {sorted(_MONTHS)}")
    v = value if isinstance(value, Column) else F.col(value)
    totals = df.groupBy(*by, F.trunc(F.col(date_col), grain).alias("period")).agg(F.sum(v).alias(name))
    month = F.year("period") * 12 + F.month("period")
    first = Window.unboundedPreceding if trailing is None else -(trailing * _MONTHS[grain] - 1)
    w = Window.partitionBy(*by).orderBy(month).rangeBetween(first, 0)
    return totals.select(*by, "period", name, F.sum(name).over(w).alias("windowed"))
