"""History of rows as a table that batches change: every version with its time.

A batch holds events (key, time, values, optionally a deletion). :func:`merge_history`
merges them into the buckets of their keys by event time: a batch may be late, may hold
several versions of a key, and may say again what is known; the result is that of all
events in order of time, whatever the order of arrival. A deletion closes the open
version. Events that change nothing are kept too (they matter once a late event comes
between), but open no version.

Neighbouring events are found by range-sorting (key, time), so a key with most of the
events is split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ledgerloom.operators.buckets import KeyedTable
from ledgerloom.operators.contracts import ContractError
from ledgerloom.operators.sequence import dealt, written
from ledgerloom.operators.timed_metrics import following

AT, DELETED, OPENS, UNTIL = "_event_at", "_deleted", "_opens", "valid_to"


def _table(spark: SparkSession, path: str, keys: Sequence[str], values: StructType, at_type,
           n_buckets: int) -> KeyedTable:
    schema = StructType([*values.fields, StructField(AT, at_type), StructField(DELETED, BooleanType()),
                         StructField(OPENS, BooleanType()), StructField(UNTIL, at_type)])
    return KeyedTable(spark, path, keys, schema, n_buckets)


def _all_equal(columns: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def merge_history(batch: DataFrame, path: str, keys: Sequence[str], event_time: str, number: int,
                  deleted: str | None = None, n_buckets: int = 64, parts: int | None = None) -> KeyedTable:
    """Merge a batch of events into the history at ``path``; only buckets of its keys are rewritten.

    ``number`` orders batches; a batch that is repeated under its number is merged once.
    Of several events of one key and time a deletion wins, then one of them by hash; a
    later batch corrects an earlier one. Null keys are a key. Events without a time are
    refused. ``parts``: partitions in which events are sorted, else the session's number.
    """
    spark, keys = batch.sparkSession, list(keys)
    values = [c for c in batch.columns if c not in (*keys, event_time, deleted)]
    payload = [*values, DELETED]
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    schema = batch.select(*keys, *values).schema
    table = _table(spark, path, keys, schema, batch.schema[event_time].dataType, n_buckets)

    events = batch.select(*keys, F.col(event_time).alias(AT), *values, gone.alias(DELETED))
    state = F.struct(*payload)
    new = written(dealt(events, parts, *keys, AT).groupBy(*keys, AT).agg(
        F.max_by(state, F.struct(F.col(DELETED), F.xxhash64(*values) if values else F.lit(0))).alias("__s"))
        .select(*keys, AT, "__s.*"), "history-batch")
    if new.filter(F.col(AT).isNull()).limit(1).count():
        raise ContractError(f"{event_time} is null on some events")
    buckets = table.touched(new)
    old = table.read(before=number, buckets=buckets).select(*keys, AT, *payload)
    theirs = new.select(*[F.col(c).alias(f"__n_{c}") for c in (*keys, AT)])
    stay = old.join(theirs, _all_equal([*keys, AT], "__n_"), "left_anti")
    all_events = stay.unionByName(new)

    order = [*keys, AT]
    seen = following(all_events.withColumn("__is", F.lit(True)), order, ["__is", *keys, *payload],
                     "__p_", back=True, parts=parts)
    opens = ~(F.coalesce(F.col("__p___is"), F.lit(False)) & _all_equal(keys, "__p_")
              & _all_equal(payload, "__p_"))
    marked = written(seen.select(*keys, AT, *payload, opens.alias(OPENS)), "history-marked")
    changes = following(marked.filter(OPENS).withColumn("__is", F.lit(True)), order, ["__is", *order], "__n_",
                        parts=parts)
    until = F.when(F.coalesce(F.col("__n___is"), F.lit(False)) & _all_equal(keys, "__n_"), F.col(f"__n_{AT}"))
    names = table.schema.names
    rows = changes.withColumn(UNTIL, until).select(*names).unionByName(
        marked.filter(~F.col(OPENS)).withColumn(UNTIL, F.lit(None).cast(table.schema[UNTIL].dataType))
        .select(*names))
    table.put(rows, number, buckets)
    return table


def read_history(table: KeyedTable) -> DataFrame:
    """Every version: keys, values, ``valid_from`` and ``valid_to`` (null: still so)."""
    hidden = (AT, DELETED, OPENS, UNTIL)
    return table.read().filter(F.col(OPENS) & ~F.col(DELETED)).select(
        *(c for c in table.schema.names if c not in hidden), F.col(AT).alias("valid_from"), UNTIL)


def read_current(table: KeyedTable) -> DataFrame:
    """The values that hold now, without deleted rows."""
    return read_history(table).filter(F.col(UNTIL).isNull()).drop("valid_from", UNTIL)
