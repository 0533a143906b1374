"""Inter-event gap statistics per key (avg / sample stddev / max of day gaps).

The literal form is ``lag(date) over (partition by key order by date)``, which
puts every event of a key into one task: a key holding a third of all rows
would stall the stage. Gaps between consecutive sorted dates only depend on
the *distinct* dates and their multiplicities: a date seen ``c`` times adds
``c - 1`` zero gaps plus one gap to the previous distinct date. So events are
first combined to ``(key, date, c)`` (partial aggregation splits a hot key
over all map tasks) and the window runs over distinct dates only, which is
bounded by the calendar span of the data, not by the row count.

Moments are exact integer sums, so avg and stddev are computed from
``n, sum, sum of squares`` without floating accumulation error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.sequence import dealt


def gap_stats(df: DataFrame, key: str, date_col: str, prefix: str = "",
              parts: int | None = None) -> DataFrame:
    """``DataFrame[key, avg_days_between, stddev_days_between, max_gap_days]``.

    Only keys with at least one gap (two events) appear, as in
    ``lag(...)`` followed by ``filter(gap is not null)`` and ``groupBy``.
    """
    daily = dealt(df.where(F.col(date_col).isNotNull()) \
        .groupBy(key, date_col).agg(F.count(F.lit(1)).alias("__c")), parts, key)
    w = Window.partitionBy(key).orderBy(date_col)
    gaps = daily.withColumn("__gap", F.datediff(F.col(date_col), F.lag(date_col).over(w)))
    per_key = gaps.groupBy(key).agg(
        (F.sum("__c") - 1).alias("__n"),
        F.coalesce(F.sum("__gap"), F.lit(0)).cast("bigint").alias("__s"),
        F.coalesce(F.sum(F.col("__gap").cast("bigint") * F.col("__gap")), F.lit(0))
        .cast("bigint").alias("__q"),
        F.max("__gap").alias("__max"),
    ).where(F.col("__n") > 0)
    n = F.col("__n").cast("decimal(38,0)")
    s = F.col("__s").cast("decimal(38,0)")
    q = F.col("__q").cast("decimal(38,0)")
    var_num = (n * q - s * s).cast("double")
    var_den = (n * (n - 1)).cast("double")
    return per_key.select(
        key,
        (F.col("__s").cast("double") / F.col("__n").cast("double"))
        .alias(f"{prefix}avg_days_between_orders"),
        F.when(F.col("__n") > 1, F.sqrt(var_num / var_den))
        .alias(f"{prefix}stddev_days_between_orders"),
        F.coalesce(F.col("__max"), F.lit(0)).alias(f"{prefix}max_gap_days"),
    )


def moments_stddev(n: str, s: str, q: str, scale: int = 0):
    """Sample stddev from exact integer moments (value = units / 10**scale)."""
    nn = F.col(n).cast("decimal(38,0)")
    ss = F.col(s).cast("decimal(38,0)")
    qq = F.col(q).cast("decimal(38,0)")
    var = (nn * qq - ss * ss).cast("double") / (nn * (nn - 1)).cast("double")
    out = F.sqrt(var)
    if scale:
        out = out / F.lit(float(10 ** scale))
    return F.when(F.col(n) > 1, out)
