"""Row numbering, surrogate keys and appends without single-task windows.

``global_rank`` numbers rows 0..n-1 and ``number_within`` numbers rows inside
groups. Both range-partition and sort the rows, record each row's partition
id and position inside the partition (``monotonically_increasing_id`` keeps
the row index in its lower 33 bits) in a written table under the shared
checkpoint folder, and derive offsets from per-partition counts - tables
bounded by the partition count (times the keys a partition holds). Nothing is
collected to the driver and no key is ever processed by a single task.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import ts_ntz
from pyspark.sql.types import StructType

_LOW_BITS = 33


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` hashed by ``keys`` to ``parts`` partitions, or as it is without a number.

    Joins, groups and windows on the keys then work in these partitions. The number comes
    from the rows (``Datasets.parts``), so what a task sorts stays the same however large
    the input is and whatever number of shuffle partitions the session has.
    """
    return df.repartition(parts, *keys) if parts else df


def positioned(df: DataFrame, order: Sequence[str], name: str = "positioned",
               parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once with its
    partition id (``__pid``) and position inside the partition (``__pos``).

    Range partitioning splits even a single hot key over many tasks. Writing the
    two columns to the shared checkpoint folder fixes them: later passes (counts,
    offsets, the final join) read the same numbers, whatever AQE does to the
    partitioning of each pass, and the lineage is cut.
    """
    from ledgerloom.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    mono = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order)
     .withColumn("__pid", F.spark_partition_id())
     .withColumn("__pos", mono - F.shiftleft(F.shiftright(mono, _LOW_BITS), _LOW_BITS))
     .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    from ledgerloom.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order: Sequence[str], output: str = "__rank") -> DataFrame:
    """Add a dense 0-based position in ``order`` (ties keep an arbitrary order)."""
    pos = positioned(df, order, "global-rank")
    counts = pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition: an unpartitioned running sum over it is tiny
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__cnt").over(Window.orderBy("__pid")
                                       .rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    return pos.join(F.broadcast(offsets), "__pid") \
        .withColumn(output, F.col("__off") + F.col("__pos")) \
        .drop("__pid", "__pos", "__off")


def running_total(df: DataFrame, order: Sequence[str], value: str, output: str,
                  parts: int | None = None) -> DataFrame:
    """Add the sum of ``value`` over all rows before each row in ``order``."""
    pos = positioned(df, order, "running-total", parts)
    inside = Window.partitionBy("__pid").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    sums = pos.groupBy("__pid").agg(F.sum(value).alias("__sum"))
    # one row per partition
    before = sums.select("__pid", F.coalesce(F.sum("__sum").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return dealt(pos, parts, "__pid").withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0))) \
        .join(F.broadcast(before), "__pid") \
        .withColumn(output, F.col("__before") + F.col("__inside")).drop("__pid", "__pos", "__inside", "__before")


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  output: str = "row_number") -> DataFrame:
    """``row_number() over (partition by keys order by order)``, skew-safe.

    The window form puts every row of a key into one task. Here rows are range
    partitioned on ``keys + order`` (a hot key spans many partitions); per
    ``(partition, key)`` a count and the first position are aggregated - at
    most one row per partition for any key - and a running sum of the counts
    over a key's partitions gives the offset. The final join is on
    ``(partition, key)``, so a hot key is spread over as many tasks as it has
    partitions.
    """
    pos = positioned(df, list(keys) + list(order), "number-within")
    stats = pos.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__n"),
                                            F.min("__pos").alias("__first"))
    w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        F.col("__pid").alias("__o_pid"), *[F.col(k).alias(f"__o_{k}") for k in keys],
        F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"), "__first")
    cond = pos["__pid"] == offsets["__o_pid"]
    for k in keys:
        cond = cond & pos[k].eqNullSafe(offsets[f"__o_{k}"])
    return pos.join(offsets, cond).withColumn(
        output, F.col("__off") + F.col("__pos") - F.col("__first") + 1
    ).drop("__pid", "__pos", "__o_pid", "__off", "__first", *[f"__o_{k}" for k in keys])


def assign_ids(incoming: DataFrame, existing: DataFrame, id_col: str,
               order: Sequence[str], output: str | None = None) -> DataFrame:
    """New surrogate keys continuing ``max(existing.id_col)``: ``max + 1 + rank``."""
    out = output or id_col
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("__max"))
    ranked = global_rank(incoming, order, "__rank")
    return ranked.crossJoin(F.broadcast(top)) \
        .withColumn(out, F.col("__max") + 1 + F.col("__rank")).drop("__max", "__rank")


def append_batch(df: DataFrame, path: str, schema: StructType | None = None,
                 now: _dt.datetime | None = None, loaded_at: str = "_loaded_at",
                 batch: str | None = None) -> bool:
    """Typed append with a load stamp: validate against ``schema``, stamp, append.

    With the name of a ``batch`` its rows are there once, however often it is run, and as
    a whole (read them with :func:`~ledgerloom.operators.buckets.read_batches`); False if
    they were there already. Without one a repeated run appends its rows again.
    """
    from ledgerloom.operators.buckets import append_once
    from ledgerloom.operators.contracts import enforce_contract

    out = df
    if schema is not None:
        out = enforce_contract(df.drop(loaded_at) if loaded_at in df.columns else df,
                               StructType([f for f in schema.fields if f.name != loaded_at]))
    stamp = ts_ntz(now) if now is not None else \
        F.current_timestamp().cast("timestamp_ntz")
    out = out.withColumn(loaded_at, stamp)
    if batch is not None:
        return append_once(out, path, batch)
    out.write.mode("append").parquet(path)
    return True
