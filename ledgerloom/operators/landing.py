"""Landing of source batches: schema drift, column policies, history mode.

* :func:`land_batch` merges a batch into a landed table whose columns may have
  drifted: columns new on either side are kept (NULL where they are missing), a
  type that changed becomes the wider of the two if nothing is lost, else text.
  Columns can be blocked (left out) or hashed (SHA-256 of their text).
* :func:`apply_history` keeps every version of a row with the time it was valid
  (``valid_from`` to ``valid_to``, open: NULL); :func:`apply_soft_delete` keeps the
  latest version and flags rows that the source deleted.

All three return the new table as a plan of joins and unions over the old table
and the batch, shuffled by the key. Null keys are keys: they are compared null-safe.
For histories that are kept on storage and merged batch by batch, with late rows and
several versions of a key, see :mod:`ledgerloom.operators.history`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType

from ledgerloom.operators.contracts import widens_losslessly


def wider(a: DataType, b: DataType) -> str:
    """The type both convert to without loss; text where there is no other."""
    if widens_losslessly(a, b):
        return b.simpleString()
    if widens_losslessly(b, a):
        return a.simpleString()
    if {type(a), type(b)} == {FloatType, DoubleType}:
        return "double"
    if isinstance(a, (DecimalType, IntegralType)) and isinstance(b, (DecimalType, IntegralType)):
        whole, scale = 0, 0
        for t in (a, b):
            d = t if isinstance(t, DecimalType) else DecimalType(19, 0)
            whole, scale = max(whole, d.precision - d.scale), max(scale, d.scale)
        if whole + scale <= 38:
            return f"decimal({whole + scale},{scale})"
    return "string"


def land_batch(landed: DataFrame, batch: DataFrame, hashed: Sequence[str] = (),
               blocked: Sequence[str] = ()) -> DataFrame:
    """Rows of both tables under one schema; ``hashed`` and ``blocked`` apply to the batch."""
    new = batch.drop(*blocked)
    for c in hashed:
        if c in new.columns:
            new = new.withColumn(c, F.sha2(F.col(c).cast("string"), 256))
    old_types = {f.name: f.dataType for f in landed.schema}
    new_types = {f.name: f.dataType for f in new.schema}
    both = {c: wider(old_types[c], t) for c, t in new_types.items() if c in old_types and old_types[c] != t}
    widen = lambda df: df.withColumns({c: F.col(c).cast(t) for c, t in both.items()})
    return widen(landed).unionByName(widen(new), allowMissingColumns=True)


def _differs(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(c).eqNullSafe(F.col(f"__new_{c}"))
    return out


def _beside(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``batch`` under other names, and the condition that its row has the key of another's."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__new_{k}"))
    return batch.select(*[F.col(c).alias(f"__new_{c}") for c in batch.columns],
                        F.lit(True).alias("__in_batch")), same


def apply_history(history: DataFrame, batch: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """``history`` (batch columns, valid_from, valid_to) after ``batch`` arrived at ``at``.

    A row that is new or changed opens a version, its former version is closed; rows
    that are equal or not in the batch stay as they are. The batch has one row a key.
    """
    columns = [c for c in batch.columns if c not in keys]
    open_, closed = history.filter("valid_to is null"), history.filter("valid_to is not null")
    joined = open_.join(*_beside(batch, keys), "left")
    changed = F.coalesce(F.col("__in_batch"), F.lit(False)) & _differs(columns)
    kept = joined.withColumn("valid_to", F.when(changed, at).otherwise(F.col("valid_to")))
    current = open_.select(*keys, *columns)
    fresh = batch.join(*_beside(current, keys), "left").filter(
        F.col("__in_batch").isNull() | _differs(columns)).select(
        *batch.columns, at.alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType)
        .alias("valid_to"))
    return closed.unionByName(kept.select(*history.columns)).unionByName(fresh.select(*history.columns))


def apply_soft_delete(landed: DataFrame, batch: DataFrame, keys: Sequence[str],
                      deleted: str = "_deleted") -> DataFrame:
    """Latest version of every row; rows of the batch with ``deleted`` true keep their last values.

    Of several rows of one key in the batch a deletion counts, else one of them by hash.
    """
    values = F.struct(*[c for c in batch.columns if c not in keys])
    flag = F.coalesce(F.col(deleted), F.lit(False))
    batch = batch.groupBy(*keys).agg(F.max_by(values, F.struct(flag, F.xxhash64(values))).alias("__v")) \
        .select(*keys, "__v.*").select(*batch.columns)
    gone = batch.filter(flag).select(*keys)
    live = batch.filter(~flag)
    stay = landed.join(*_beside(live.select(*keys), keys), "left_anti")
    stay = stay.join(*_beside(gone, keys), "left").withColumnRenamed("__in_batch", "__gone")
    stay = stay.withColumn(deleted, F.coalesce(F.col("__gone"), F.col(deleted))).select(*landed.columns)
    return stay.unionByName(live.select(*landed.columns))
