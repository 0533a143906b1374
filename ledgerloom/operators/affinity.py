"""Pair co-usage affinity (self-join on a shared key) without the row explosion.

Literal form: join the (key, item, value) rows to themselves on ``key`` with
``a.item < b.item`` and average over the joined rows. A key with ``k`` rows
produces O(k^2) joined rows. Instead rows are first combined to one row per
``(key, item)`` with ``cnt`` and ``sum`` (partial aggregation), so the self
join sees at most one row per item per key. The pair-weighted averages of the
literal form are recovered exactly::

    avg_a = sum_k(sum_a * cnt_b) / sum_k(cnt_a * cnt_b)

Output bound: a key contributes at most d(d-1)/2 pair rows, where d is the
number of distinct items of that key (payment methods: d <= 3), however many
rows the key has; a key holding a third of all rows still yields d(d-1)/2 rows.
The pairs are quadratic in d, so the number of distinct items is a precondition:
more than ``max_items`` of them are an error, not a slow query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import round_half_up_ratio


def affinity_pairs(df: DataFrame, key: str, item: str, value: str,
                   names: tuple[str, str] = ("method_a", "method_b"),
                   outputs: tuple[str, str, str] = ("shared_customers", "avg_spend_method_a",
                                                    "avg_spend_method_b"),
                   digits: int = 2, max_items: int = 64) -> DataFrame:
    from ledgerloom.operators.sequence import written

    per = df.where(F.col(item).isNotNull()).groupBy(key, item).agg(
        F.count(F.col(value)).alias("cnt"), F.sum(value).alias("total"))
    per = written(per, "affinity")          # read for the check and by both sides of the join
    if per.select(item).distinct().limit(max_items + 1).count() > max_items:
        raise ValueError(f"{item} has more than {max_items} distinct values")
    a = per.select(F.col(key).alias("__k"), F.col(item).alias("a_item"),
                   F.col("cnt").alias("a_cnt"), F.col("total").alias("a_sum"))
    b = per.select(F.col(key).alias("__k"), F.col(item).alias("b_item"),
                   F.col("cnt").alias("b_cnt"), F.col("total").alias("b_sum"))
    pairs = a.join(b, (a["__k"] == b["__k"]) & (a["a_item"] < b["b_item"]))
    weight = F.col("a_cnt") * F.col("b_cnt")
    agg = pairs.groupBy("a_item", "b_item").agg(
        F.count(F.lit(1)).alias("__shared"),
        F.sum(F.col("a_sum") * F.col("b_cnt")).alias("__num_a"),
        F.sum(F.col("b_sum") * F.col("a_cnt")).alias("__num_b"),
        F.sum(weight).alias("__den"),
    )
    return agg.select(
        F.col("a_item").alias(names[0]), F.col("b_item").alias(names[1]),
        F.col("__shared").alias(outputs[0]),
        round_half_up_ratio(F.col("__num_a"), F.col("__den"), digits).cast("decimal(18,2)")
        .alias(outputs[1]),
        round_half_up_ratio(F.col("__num_b"), F.col("__den"), digits).cast("decimal(18,2)")
        .alias(outputs[2]),
    )
