"""Quantile scoring without driver round trips.

``DataFrame.approxQuantile`` runs one eager job per column and ships the cut
points back through the driver. Here the cut points are a one-row DataFrame
that is broadcast (size bound: one row) and the scores are plain ``CASE``
expressions. Two ways to get the cut points:

* ``exact`` (default): nearest-rank discrete quantiles, i.e. the value at
  1-based rank ``ceil(n * p)``. The column is first combined to
  ``(value, count)`` (map-side), the distinct values are range-partitioned and
  written once with their positions, cumulative counts come from
  per-partition sums (a table bounded by the partition count), and the value
  covering each target rank is picked. No task ever holds all values, and the
  result does not depend on data size.
* ``approx``: one ``percentile_approx`` aggregation (mergeable sketches); exact
  only while a column has fewer distinct values than ``accuracy``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUINTILES = (0.2, 0.4, 0.6, 0.8)


@dataclass(frozen=True)
class ScoreSpec:
    column: str
    output: str
    reverse: bool = False   # True: lowest values get the highest score


def score_from_cuts(value: Column, cuts: Column, n_cuts: int, reverse: bool) -> Column:
    """1-based bucket of ``value`` against ascending ``cuts`` (``<=`` closes a bucket)."""
    expr = None
    for i in range(n_cuts):
        score = (n_cuts + 1 - i) if reverse else (i + 1)
        # try_element_at: no cut points (empty or all-NULL column) compares as NULL
        cond = value <= F.try_element_at(cuts, F.lit(i + 1))
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    last = 1 if reverse else n_cuts + 1
    return expr.otherwise(F.lit(last))


def _common_type(df: DataFrame, cols: Sequence[str]) -> str:
    """A type every scored column converts to exactly and in order."""
    from pyspark.sql.types import DecimalType, DoubleType, FloatType

    types = [df.schema[c].dataType for c in cols]
    if any(isinstance(t, (DoubleType, FloatType)) for t in types):
        return "double"
    scale = max([t.scale for t in types if isinstance(t, DecimalType)], default=0)
    return f"decimal(38,{scale})"


def _cast_field(field: str, type_: str):
    # a one-argument lambda: ``transform`` passes the element index to a second one
    return lambda s_: s_[field].cast(type_)


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                          outputs: Sequence[str] | None = None) -> DataFrame:
    """One row, one ``array`` of nearest-rank quantiles per column (NULLs ignored).

    All columns are stacked as ``(column index, value)`` and combined to
    ``(column, value, count)`` in one pass over ``df``, then numbered in one
    positioned write; offsets are per ``(partition, column)``.
    """
    from ledgerloom.operators.sequence import positioned

    outputs = list(outputs) if outputs is not None else [f"{c}_cuts" for c in cols]
    common = _common_type(df, cols)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("__k"), F.col(c).cast(common).alias("__v"))
        for i, c in enumerate(cols)])).alias("__s")).select("__s.*")
    vals = stacked.where(F.col("__v").isNotNull()).groupBy("__k", "__v") \
        .agg(F.count(F.lit(1)).alias("__c"))
    pos = positioned(vals, ["__k", "__v"], "quantiles")
    before = F.coalesce(F.sum("__c").over(
        Window.partitionBy("__pid", "__k").orderBy("__pos")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = pos.groupBy("__pid", "__k").agg(F.sum("__c").alias("__pc"))
    # one row per (partition, column): bounded by partitions x columns
    offsets = part.select("__pid", "__k", F.coalesce(F.sum("__pc").over(
        Window.partitionBy("__k").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__off"))
    n = part.groupBy("__k").agg(F.sum("__pc").alias("__n"))
    targets = n.select("__k", F.explode(F.array(*[
        F.struct(F.lit(i).alias("__i"),
                 (F.greatest(F.ceil(F.col("__n") * F.lit(Decimal(str(p)))), F.lit(1)) - 1)
                 .alias("__idx"))
        for i, p in enumerate(probs)])).alias("__t")).select("__k", "__t.*") \
        .withColumnRenamed("__k", "__tk")
    spans = pos.select("__pid", "__k", "__c", "__v", before.alias("__before")) \
        .join(F.broadcast(offsets), ["__pid", "__k"]) \
        .withColumn("__lo", F.col("__off") + F.col("__before"))
    hits = spans.join(F.broadcast(targets),
                      (F.col("__k") == F.col("__tk")) & (F.col("__idx") >= F.col("__lo"))
                      & (F.col("__idx") < F.col("__lo") + F.col("__c")))
    aggs = []
    for i, (c, out) in enumerate(zip(cols, outputs)):
        t = df.schema[c].dataType.simpleString()
        picked = F.array_sort(F.collect_list(
            F.when(F.col("__k") == i, F.struct("__i", "__v"))))
        aggs.append(F.transform(picked, _cast_field("__v", t)).alias(out))
    return hits.agg(*aggs)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    output: str = "cuts") -> DataFrame:
    """One row: ``array`` of nearest-rank quantiles of ``col`` (NULLs ignored)."""
    return exact_quantiles_multi(df, [col], probs, [output])


def quantile_scores(df: DataFrame, specs: Sequence[ScoreSpec],
                    probs: Sequence[float] = QUINTILES, accuracy: int = 10000,
                    method: str = "exact") -> DataFrame:
    """Add one integer score column per spec (1..len(probs)+1)."""
    if method == "approx":
        cuts = df.agg(*[
            F.percentile_approx(s.column, list(probs), accuracy).alias(f"__cuts_{i}")
            for i, s in enumerate(specs)
        ])
    elif method == "exact":
        cuts = exact_quantiles_multi(df, [s.column for s in specs], probs,
                                     [f"__cuts_{i}" for i in range(len(specs))])
    else:
        raise ValueError("method must be 'exact' or 'approx'")
    out = df.crossJoin(F.broadcast(cuts))
    for i, s in enumerate(specs):
        out = out.withColumn(s.output, score_from_cuts(F.col(s.column), F.col(f"__cuts_{i}"),
                                                       len(probs), s.reverse))
    return out.drop(*[f"__cuts_{i}" for i in range(len(specs))])


def quintile_score(df: DataFrame, col: str, probs: Sequence[float] = QUINTILES,
                   reverse: bool = False, accuracy: int = 10000,
                   output: str | None = None, method: str = "exact") -> DataFrame:
    return quantile_scores(df, [ScoreSpec(col, output or f"{col}_score", reverse)],
                           probs, accuracy, method)
