"""Deterministic top-k.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows and only k rows per task reach the final merge, so the
cost does not grow with the input beyond one scan. A key tiebreak makes the
result unique when the ranking value ties (e.g. every product of a cross-join
model has the same order count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], k: int, tiebreak: Sequence[str] = (),
          ascending: bool = False) -> DataFrame:
    order = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in by]
    order += [F.col(c).asc_nulls_last() for c in tiebreak]
    return df.orderBy(*order).limit(k)
