"""Data tests (not_null, unique, accepted_values, relationships, singular),
source freshness, load audit and fact reconciliation.

Generic tests return the *failing rows* of a DataFrame (generic-test semantics: NULL
passes ``unique`` / ``accepted_values`` / ``relationships``). :func:`run_tests`
evaluates a whole test suite as one Spark job: per model all NULL, accepted-value
and row-condition tests are conditional counts of one aggregation (one scan, no
row is multiplied). Where a model has a ``unique`` test, that aggregation is by the
tested key in its own type, so the same scan also finds the values that occur twice.
``relationships`` counts the child rows by foreign key (a hot key is combined in every
map task) and anti joins the keys. Over tables that are bucketed by these keys neither
shuffles (:func:`~ledgerloom.sources.datasets.publish`).

:func:`diff_rows` compares two tables row by row, by digests of hash buckets first.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import ts_ntz
from ledgerloom.operators.sequence import dealt

SEVERITIES = ("error", "warn")


# ------------------------------------------------------------ generic tests ---

def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULLs ignored), with their counts."""
    return df.filter(F.col(column).isNotNull()).groupBy(column) \
        .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(df: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no parent ``field_``."""
    p = parent.select(F.col(field_).alias("__parent_key"))
    return df.filter(F.col(column).isNotNull()) \
        .join(p, F.col(column) == F.col("__parent_key"), "left_anti")


@dataclass(frozen=True)
class DataTest:
    model: str
    kind: str                      # not_null | unique | accepted_values | relationships | singular
    column: str | None = None
    values: tuple[str, ...] = ()
    to: str | None = None          # parent model for relationships
    field: str | None = None       # parent column for relationships
    severity: str = "error"
    name: str | None = None

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        suffix = f"__{self.to}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.model}_{self.column}{suffix}"


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")) \
        .when(severity == "warn", F.lit("warn")).otherwise(F.lit("fail"))


def run_tests(ds, tests: Sequence[DataTest],
              singular: Mapping[str, tuple[str, str, str]] | None = None,
              sizes: Mapping[str, str] | None = None) -> DataFrame:
    """``DataFrame[test_name, model, column_name, test_type, failures, severity, status]``.

    ``singular`` maps a test name to ``(severity, model, condition)``; rows of the
    model for which the condition holds are failures. ``sizes`` names the driver table that
    has about as many rows as a model: its number sets that of the partitions by key.
    """
    counts: dict[str, list[tuple[DataTest, Column]]] = {}
    rows = [(t.test_name, t.model, t.column, t.kind, t.severity) for t in tests]
    parts: list[DataFrame] = []

    def counted(t: DataTest, failing: DataFrame) -> DataFrame:
        return failing.agg(F.lit(t.test_name).alias("__test"), F.count(F.lit(1)).alias("__f"))

    keyed: dict[str, DataTest] = {}     # a model's unique test that its other tests join

    for t in tests:
        if t.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}")
        c = F.col(t.column)
        if t.kind == "not_null":
            counts.setdefault(t.model, []).append((t, c.isNull()))
        elif t.kind == "accepted_values":
            counts.setdefault(t.model, []).append((t, c.isNotNull() & ~c.isin(list(t.values))))
        elif t.kind == "unique" and t.model not in keyed:
            keyed[t.model] = t
        elif t.kind == "unique":
            parts.append(counted(t, unique(ds[t.model], t.column)))
        else:
            children = ds[t.model].groupBy(t.column).agg(F.count(F.lit(1)).alias("__n"))
            lost = relationships(children, t.column, ds[t.to], t.field)
            parts.append(lost.agg(F.lit(t.test_name).alias("__test"),
                                  F.coalesce(F.sum("__n"), F.lit(0)).alias("__f")))
    for name, (severity, model, condition) in (singular or {}).items():
        t = DataTest(model=model, kind="singular", severity=severity, name=name)
        counts.setdefault(model, []).append((t, F.coalesce(F.expr(condition), F.lit(False))))
        rows.append((name, name, None, "singular", severity))
    for model in dict.fromkeys([*counts, *keyed]):
        checks, key = counts.get(model, []), keyed.get(model)
        counted_bad = [F.count_if(bad).alias(f"__c{i}") for i, (_, bad) in enumerate(checks)]
        if key is None:
            one = ds[model].agg(*counted_bad)
        else:
            # only the key and flags are dealt
            flags = ds[model].select(key.column, *[bad.alias(f"__b{i}") for i, (_, bad) in enumerate(checks)])
            number = ds.parts(sizes[model]) if model in (sizes or {}) else None
            by_key = dealt(flags, number, key.column).groupBy(key.column).agg(
                F.count(F.lit(1)).alias("__n"),
                *[F.count_if(F.col(f"__b{i}")).alias(f"__c{i}") for i in range(len(checks))])
            one = by_key.agg(
                *[F.coalesce(F.sum(f"__c{i}"), F.lit(0)).alias(f"__c{i}") for i in range(len(checks))],
                F.count_if(F.col(key.column).isNotNull() & (F.col("__n") > 1)).alias(f"__c{len(checks)}"))
        names = [t.test_name for t, _ in checks] + ([key.test_name] if key else [])
        pairs = ", ".join(f"'{name}', __c{i}" for i, name in enumerate(names))
        parts.append(one.select(F.expr(f"stack({len(names)}, {pairs}) as (__test, __f)")))
    failures = parts[0]
    for p in parts[1:]:
        failures = failures.unionByName(p)
    spec = ds.spark.createDataFrame(
        rows, "test_name string, model string, column_name string, test_type string, severity string")
    # both sides have one row a test
    out = spec.join(F.broadcast(failures), spec.test_name == failures["__test"], "left").select(
        "test_name", "model", "column_name", "test_type",
        F.coalesce("__f", F.lit(0)).cast("bigint").alias("failures"), "severity")
    return out.withColumn("status", _status(F.col("failures"), F.col("severity")))


# ---------------------------------------------------------------- freshness ---

@dataclass(frozen=True)
class FreshnessRule:
    source: str
    loaded_at: str
    warn_after: _dt.timedelta
    error_after: _dt.timedelta


def source_freshness(ds, rules: Sequence[FreshnessRule], now: _dt.datetime) -> DataFrame:
    """``[source, max_loaded_at, age_seconds, status]``; an empty source is an error."""
    now_col = ts_ntz(now)
    parts = []
    for r in rules:
        m = ds[r.source].agg(F.max(F.col(r.loaded_at).cast("timestamp_ntz")).alias("mx"))
        age = F.timestamp_diff("SECOND", F.col("mx"), now_col)
        status = (F.when(F.col("mx").isNull(), F.lit("error"))
                  .when(age > int(r.error_after.total_seconds()), F.lit("error"))
                  .when(age > int(r.warn_after.total_seconds()), F.lit("warn"))
                  .otherwise(F.lit("pass")))
        parts.append(m.select(F.lit(r.source).alias("source"),
                              F.col("mx").alias("max_loaded_at"),
                              age.cast("bigint").alias("age_seconds"), status.alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -------------------------------------------------------------- audit/recon ---

def load_audit(tables: Mapping[str, DataFrame], loaded_at: str = "_loaded_at") -> DataFrame:
    """``UNION ALL`` of one-row aggregates: ``[table_name, row_count, last_loaded_at]``."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("last_loaded_at"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def facts_long(df: DataFrame, facts: Mapping[str, Column]) -> DataFrame:
    """One aggregation, then ``stack`` into ``[fact, value]`` rows (as strings)."""
    agg = df.agg(*[c.alias(f"__f{i}") for i, c in enumerate(facts.values())])
    pairs = ", ".join(f"'{name}', cast(`__f{i}` as string)" for i, name in enumerate(facts))
    return agg.select(F.expr(f"stack({len(facts)}, {pairs}) as (fact, value)"))


def reconcile(actual: DataFrame, expected: DataFrame, keys: Sequence[str],
              value: str = "value") -> DataFrame:
    """Null-safe full comparison: ``[keys..., expected, actual, matches]``."""
    a = actual.select(*keys, F.col(value).alias("actual"))
    e = expected.select(*[F.col(k).alias(f"__e_{k}") for k in keys],
                        F.col(value).alias("expected"))
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(e[f"__e_{k}"])
        cond = c if cond is None else cond & c
    j = a.join(e, cond, "full")
    return j.select(*[F.coalesce(F.col(k), F.col(f"__e_{k}")).alias(k) for k in keys],
                    "expected", "actual",
                    F.col("expected").eqNullSafe(F.col("actual")).alias("matches"))


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], n_buckets: int) -> DataFrame:
    """(bucket, rows, digest): per hash bucket of the key a digest of its rows, in any order."""
    row = F.xxhash64(*keys, *columns)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).alias("bucket")
    # two sums of independent hashes, exact in 38 digits: rows that differ cannot cancel out
    again = F.xxhash64(F.lit("again"), row, *columns, *keys)
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(row.cast("decimal(20,0)")).alias("first"),
                                  F.sum(again.cast("decimal(20,0)")).alias("second"))


def diff_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
              n_buckets: int = 4096) -> DataFrame:
    """Rows in which two tables differ: keys, ``found`` (left_only, right_only, differs), ``columns``.

    First a digest of every hash bucket of the key on both sides (one map-side combined
    aggregation each, ``n_buckets`` rows); only rows of buckets whose digests differ are
    joined. Both sides must have one row a key; null keys are keys. ``columns``: what is
    compared, all common ones by default; the result names those that differ.
    """
    common = list(columns) if columns is not None else [
        c for c in left.columns if c in right.columns and c not in keys]
    kinds = {c: (left.schema[c].dataType, right.schema[c].dataType) for c in (*keys, *common)}
    aligned = lambda df: df.select(*[F.col(c).cast(kinds[c][0]).alias(c)
                                     for c in (*keys, *common)])
    a, b = aligned(left), aligned(right)
    mine, theirs = (bucket_digests(df, keys, common, n_buckets) for df in (a, b))
    other = theirs.select(*[F.col(c).alias(f"__r_{c}") for c in theirs.columns])
    same = F.lit(True)
    for c in ("rows", "first", "second"):
        same = same & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    unequal = mine.join(other, F.col("bucket") == F.col("__r_bucket"), "full").filter(~same).select(
        F.coalesce("bucket", "__r_bucket").alias("bucket"))
    wanted = [r.bucket for r in unequal.collect()]              # at most n_buckets numbers
    some = lambda df: df.filter(F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).isin(wanted)
                                if wanted else F.lit(False))
    right_rows = some(b).select(*[F.col(c).alias(f"__r_{c}") for c in b.columns], F.lit(True).alias("__r"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    both = some(a).withColumn("__l", F.lit(True)).join(right_rows, on, "full")
    unlike = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__r_{c}")), F.lit(c))
                                       for c in common])) if common else F.array().cast("array<string>")
    found = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").when(
        F.size(unlike) > 0, "differs")
    return both.withColumn("found", found).filter("found is not null").select(
        *[F.when(F.col("__l").isNull(), F.col(f"__r_{k}")).otherwise(F.col(k)).alias(k) for k in keys], "found",
        F.when(F.col("found") == "differs", F.array_join(unlike, ",")).otherwise(F.lit("")).alias("columns"))


@dataclass(frozen=True)
class Contract:
    model: str
    columns: Mapping[str, str]                  # name -> declared Spark SQL type
    not_null: tuple[str, ...] = ()
    primary_key: str | None = None
    meta: Mapping[str, object] = field(default_factory=dict)
