"""Column-level helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"      # contracted mart money type
RAW_MONEY = "decimal(10,2)"  # landing money type


def money_from_cents(x: Column | str) -> Column:
    """``floor(x)`` read as whole cents, returned as ``decimal(10,2)``.

    Exact in every engine: double -> bigint -> decimal, never double -> decimal.
    """
    cents = F.floor(x if isinstance(x, Column) else F.col(x)).cast("bigint")
    return (cents * F.lit(Decimal("0.01")).cast("decimal(3,2)")).cast(RAW_MONEY)


def dec0(c: Column | str, t: str = MONEY) -> Column:
    """Typed zero-safe coalesce: ``coalesce(c, cast(0 as t))`` keeps decimals decimal."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.coalesce(col, F.lit(0).cast(t))


def segment(value: Column | str, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """Searched-CASE bucketing: first band whose lower bound is met wins.

    ``bands`` is ordered high to low, e.g. ``[(500, 'high_value'), (100, 'mid_value')]``.
    A NULL value fails every comparison and falls through to ``default``.
    """
    col = value if isinstance(value, Column) else F.col(value)
    expr = None
    for bound, label in bands:
        cond = col >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def ratio(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)`` in double precision (never overflows a decimal)."""
    return num.cast("double") / F.when(den != 0, den.cast("double"))


def avg_exact(sum_col: Column, count_col: Column) -> Column:
    """Average as ``double(sum) / count``: both engines round this identically."""
    return sum_col.cast("double") / F.when(count_col != 0, count_col.cast("double"))



def title_from_snake(c: Column | str) -> Column:
    """``'high_value_open'`` -> ``'High Value Open'``."""
    col = c if isinstance(c, Column) else F.col(c)
    return F.initcap(F.regexp_replace(col, "_", " "))



def round_half_up_ratio(num: Column, den: Column, digits: int) -> Column:
    """``round(num / den, digits)`` (half away from zero) computed exactly.

    ``num`` must be an integer or a decimal whose scale is at most ``digits``.
    The quotient is formed in integer decimal arithmetic, so no intermediate
    rounding can move a value across a tie; the result is
    ``decimal(38, digits)`` and NULL when ``den`` is 0 or NULL.
    """
    unit = 10 ** digits
    a = (F.abs(num) * F.lit(2 * unit)).cast("decimal(38,0)") + den.cast("decimal(38,0)")
    b = (den * F.lit(2)).cast("decimal(38,0)")
    q = ((a - a % b) / b).cast("decimal(38,0)")
    signed = F.when(num < 0, -q).otherwise(q)
    scale = F.lit(1).cast("decimal(38,0)") if digits == 0 else F.lit(f"{1 / unit:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return F.when(den != 0, (signed * scale).cast(f"decimal(38,{digits})"))


def ts_ntz(v: _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal from its wall-clock text.

    ``lit(datetime)`` goes through the Python process time zone and then the
    session time zone; the string cast does not depend on either.
    """
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
