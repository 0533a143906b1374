"""Tables kept up to date by micro-batches: drifting landings, activation feed, running totals.

Each is a ``foreachBatch`` function over a :class:`~ledgerloom.operators.buckets.Ledger`
or :class:`~ledgerloom.operators.buckets.KeyedTable`: a batch reads the state as it stood
before it and writes folders of its own, so a repeated batch gives the same result and a
failed one is invisible.

* :func:`stream_drift` - files whose columns and types change from batch to batch land
  under a numbered schema; a log beside the table holds every schema, and
  :func:`read_drift` reads all files as the latest one.
* :class:`ActivationFeed` - sends rows that are new or changed since they were last sent;
  the state is one digest a key.
* :class:`RunningTotals` - sums, counts, least and greatest values by group over the latest
  version of every row. A changed row is taken out of its old group and put into its new
  one; only where the least or greatest value itself is taken out, the group's rows are
  read again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerloom.operators.buckets import BATCH, KeyedTable, Ledger, _hadoop, children, remove
from ledgerloom.operators.landing import wider
from ledgerloom.operators.sequence import dealt, written
from ledgerloom.streaming.medallion import MAX_FILES_PER_TRIGGER

POLICIES = ("allow_all", "new_columns", "block_all")


def run_batches(spark: SparkSession, source: str, schema: StructType, checkpoint: str,
                fn: Callable[[DataFrame, int], None], max_files: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """Hand the files of ``source`` that are not in the checkpoint to ``fn``, in micro-batches."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
            .writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(fn).start())


# ------------------------------------------------------------------ schema drift ---

class SchemaLog:
    """The numbered schemas of the table at ``path``, one small file each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/_schemas"

    def versions(self) -> dict[int, StructType]:
        names = children(self.spark, self.path)
        text = lambda n: self.spark.read.text(f"{self.path}/{n}", wholetext=True).first()[0]
        return {int(n): StructType.fromJson(json.loads(text(n))) for n in names}

    def add(self, version: int, schema: StructType) -> None:
        place, fs = _hadoop(self.spark, f"{self.path}/{version}")
        out = fs.create(place, True)
        out.write(bytearray(schema.json(), "utf-8"))
        out.close()


def evolved(current: StructType | None, batch: StructType, policy: str) -> StructType:
    """The table's schema after a batch: ``allow_all`` adds columns and widens types,
    ``new_columns`` only adds columns, ``block_all`` changes nothing once there is a table."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if current is None:
        return StructType([StructField(f.name, f.dataType) for f in batch.fields])
    known = {f.name.lower(): f for f in current.fields}
    fields = []
    for f in current.fields:
        other = next((g for g in batch.fields if g.name.lower() == f.name.lower()), None)
        if policy == "allow_all" and other is not None and other.dataType != f.dataType:
            f = StructField(f.name, StructType.fromDDL(f"x {wider(f.dataType, other.dataType)}")["x"].dataType)
        fields.append(f)
    if policy != "block_all":
        fields += [StructField(f.name, f.dataType) for f in batch.fields if f.name.lower() not in known]
    return StructType(fields)


def _conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the schema's columns: missing ones null, others as far as they convert."""
    there = {c.lower(): c for c in df.columns}
    kind = lambda f: f.dataType.simpleString()
    return df.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name.lower() not in there
        else F.col(f"`{there[f.name.lower()]}`").alias(f.name)
        if df.schema[there[f.name.lower()]].dataType == f.dataType
        else F.expr(f"try_cast(`{there[f.name.lower()]}` as {kind(f)})").alias(f.name)
        for f in schema.fields])


def land_drifting(batch: DataFrame, table: str, batch_id: int, part: int = 0, policy: str = "allow_all",
                  hashed: Sequence[str] = (), blocked: Sequence[str] = ()) -> int:
    """Write a batch under the schema it and the table agree on; that schema's number.

    ``blocked`` columns are left out, ``hashed`` ones become the SHA-256 of their text.
    """
    spark, rows = batch.sparkSession, batch.drop(*blocked)
    rows = rows.withColumns({c: F.sha2(F.col(f"`{c}`").cast("string"), 256) for c in hashed if c in rows.columns})
    log = SchemaLog(spark, table)
    versions = log.versions()
    last = max(versions, default=0)
    schema = evolved(versions.get(last), rows.schema, policy)
    if schema != versions.get(last):
        last += 1
        log.add(last, schema)
    _conformed(rows, schema).write.mode("overwrite").parquet(
        f"{table.rstrip('/')}/rows/schema={last}/{BATCH}={batch_id}/part={part}")
    return last


def stream_drift(spark: SparkSession, source: str, table: str, checkpoint: str, policy: str = "allow_all",
                 hashed: Sequence[str] = (), blocked: Sequence[str] = (),
                 max_files: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """Land the parquet files of ``source``, whatever their columns, into ``table``.

    The stream is of file names (their content is not read here); each micro-batch
    reads its files, at most ``max_files``, by schema.
    """
    names = StructType.fromDDL("path string, modificationTime timestamp, length bigint, content binary")
    files = (spark.readStream.format("binaryFile").schema(names).option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
             .load(source).select("path"))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for old in children(spark, f"{table}/rows"):            # what a failed run left
            remove(spark, f"{table}/rows/{old}/{BATCH}={batch_id}")
        alike: dict[str, list[str]] = {}
        for row in sorted(batch.collect()):                     # at most max_files names
            alike.setdefault(spark.read.parquet(row.path).schema.json(), []).append(row.path)
        for part, paths in enumerate(alike.values()):
            land_drifting(spark.read.parquet(*paths), table, batch_id, part, policy, hashed, blocked)
        Ledger(spark, table).enter(batch_id)

    return (files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(land).start())


def read_drift(spark: SparkSession, table: str) -> DataFrame:
    """All rows of complete batches, old files read as the latest schema."""
    versions = SchemaLog(spark, table).versions()
    if not versions:
        raise ValueError(f"nothing has landed in {table}")
    last, done = versions[max(versions)], set(Ledger(spark, table).batches())
    out = spark.createDataFrame([], last)
    for v, schema in versions.items():
        folder = f"{table.rstrip('/')}/rows/schema={v}"
        held = [c for c in children(spark, folder) if c.split("=")[-1] in done]
        if held:
            rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(
                *(f"{folder}/{c}" for c in held))
            out = out.unionByName(_conformed(rows, last))
    return out


# --------------------------------------------------------------------- activation ---

def _same_key(keys: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out


def _beside(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns], F.lit(True).alias(f"{prefix}_is"))


class ActivationFeed:
    """Rows to send, by micro-batch, into ``out``; state at ``state``.

    ``compare``: columns whose change is sent (all but the keys by default). ``order``:
    the column that tells the latest of several rows of a key in one batch.
    """

    def __init__(self, spark: SparkSession, state: str, out: str, keys: Sequence[str], schema: StructType,
                 compare: Sequence[str] | None = None, order: str | None = None, n_buckets: int = 64):
        self.spark, self.out, self.keys, self.order = spark, out.rstrip("/"), list(keys), order
        self.columns = [c for c in schema.names if c != order]
        self.compare = list(compare) if compare else [c for c in self.columns if c not in keys]
        held = StructType([*(schema[k] for k in keys), StructField("digest", StringType())])
        self.state = KeyedTable(spark, state, keys, held, n_buckets)
        self.sent = StructType([*(schema[c] for c in self.columns), StructField("change", StringType())])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        values = F.struct(*[c for c in self.columns if c not in self.keys])
        latest = F.max_by(values, F.col(self.order)) if self.order else F.max_by(values, F.xxhash64(values))
        digest = F.sha2(F.to_json(F.struct(*self.compare), {"ignoreNullFields": "false"}), 256)
        rows = written(batch.groupBy(*self.keys).agg(latest.alias("__v")).select(*self.keys, "__v.*")
                       .withColumn("digest", digest), "activation-batch")
        buckets = self.state.touched(rows)
        before = self.state.read(before=batch_id, buckets=buckets)
        seen = rows.join(_beside(before, "__p_"), _same_key(self.keys, "__p_"), "left")
        change = F.when(F.col("__p__is").isNull(), F.lit("new")).when(
            F.col("digest") != F.col("__p_digest"), F.lit("updated"))
        (seen.withColumn("change", change).filter("change is not null").select(*self.sent.names)
         .write.mode("overwrite").parquet(f"{self.out}/{BATCH}={batch_id}"))
        stay = before.join(_beside(rows.select(*self.keys), "__n_"), _same_key(self.keys, "__n_"), "left_anti")
        self.state.put(stay.unionByName(rows.select(*self.keys, "digest")), batch_id, buckets)

    def messages(self) -> DataFrame:
        """All rows sent by complete batches, with ``batch``."""
        done = [b for b in self.state.ledger.batches() if f"{BATCH}={b}" in children(self.spark, self.out)]
        schema = StructType([*self.sent.fields, StructField(BATCH, LongType())])
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.out).parquet(
            *(f"{self.out}/{BATCH}={b}" for b in done))


# ------------------------------------------------------------------ running totals ---

class RunningTotals:
    """Totals by group over the latest version of every row, merged per micro-batch.

    ``key`` identifies a row, ``version`` orders its versions (a late older one is
    ignored), ``groups`` are its columns to group by. ``sums``: name -> column;
    ``least`` and ``greatest`` likewise. Rows for which ``where`` does not hold count
    nowhere. ``parts``: partitions in which a batch's rows are sorted by key, else the
    session's number.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], version: str,
                 groups: Sequence[str], sums: Mapping[str, str] = {}, least: Mapping[str, str] = {},
                 greatest: Mapping[str, str] = {}, where: str = "true", n_buckets: int = 64,
                 parts: int | None = None):
        self.spark, self.key, self.version, self.groups = spark, list(key), version, list(groups)
        self.sums, self.least, self.greatest, self.where = dict(sums), dict(least), dict(greatest), where
        self.parts = parts
        self.rows = KeyedTable(spark, f"{path}/rows", key, schema, n_buckets)
        probe = self._total(spark.createDataFrame([], schema).withColumn("__sign", F.lit(1)))
        self.totals = KeyedTable(spark, f"{path}/totals", groups, probe.schema, n_buckets)

    def _total(self, rows: DataFrame) -> DataFrame:
        """Totals of signed rows; least and greatest of the ones that enter."""
        enters = lambda c: F.when(F.col("__sign") > 0, F.col(c))
        signed = lambda c: F.coalesce(F.sum(F.col("__sign") * F.col(c)), F.lit(0))
        kinds = {n: self._sum_type(rows, c) for n, c in self.sums.items()}
        return rows.filter(F.expr(self.where)).groupBy(*self.groups).agg(
            F.sum("__sign").cast("long").alias("n"),
            *[signed(c).cast(kinds[n]).alias(n) for n, c in self.sums.items()],
            *[F.min(enters(c)).alias(n) for n, c in self.least.items()],
            *[F.max(enters(c)).alias(n) for n, c in self.greatest.items()])

    @staticmethod
    def _sum_type(rows: DataFrame, column: str) -> str:
        return rows.agg(F.sum(column).alias("s")).schema["s"].dataType.simpleString()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        names = self.rows.schema.names
        values = F.struct(*[c for c in names if c not in self.key])
        newest = written(dealt(batch.select(*names), self.parts, *self.key).groupBy(*self.key).agg(
            F.max_by(values, F.struct(self.version, F.xxhash64(values))).alias("__v"))
            .select(*self.key, "__v.*").select(*names), "totals-batch")
        buckets = self.rows.touched(newest)
        held = self.rows.read(before=batch_id, buckets=buckets)
        newer = F.col("__n__is") & (F.col(f"__n_{self.version}") >= F.col(self.version))
        both = held.withColumn("__o_is", F.lit(True)).join(
            _beside(newest, "__n_"), _same_key(self.key, "__n_"), "full")
        enters = F.coalesce(F.col("__n__is") & (F.col("__o_is").isNull() | newer), F.lit(False))
        both = written(both.withColumn("__enters", enters), "totals-changes")
        new = both.filter("__enters").select(*[F.col(f"__n_{c}").alias(c) for c in names])
        gone = both.filter("__enters and __o_is").select(*names)
        self.rows.put(both.filter("not __enters and __o_is").select(*names).unionByName(new), batch_id, buckets)

        change = written(self._total(new.withColumn("__sign", F.lit(1)).unionByName(
            gone.withColumn("__sign", F.lit(-1)))), "totals-delta")
        touched = self.totals.touched(change)
        base = self.totals.read(before=batch_id, buckets=touched)
        merged = base.withColumn("__o_is", F.lit(True)).join(
            _beside(change, "__d_"), _same_key(self.groups, "__d_"), "full")
        plus = lambda c: (F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"__d_{c}"), F.lit(0)))
        kind = {f.name: f.dataType for f in self.totals.schema.fields}
        merged = merged.select(
            *[F.when(F.col("__o_is").isNull(), F.col(f"__d_{g}")).otherwise(F.col(g)).alias(g) for g in self.groups],
            *[plus(c).cast(kind[c]).alias(c) for c in ("n", *self.sums)],
            *[F.least(c, f"__d_{c}").alias(c) for c in self.least],
            *[F.greatest(c, f"__d_{c}").alias(c) for c in self.greatest])
        self.totals.put(self._reread(merged, base, gone, batch_id), batch_id, touched)

    def _reread(self, merged: DataFrame, base: DataFrame, gone: DataFrame, batch_id: int) -> DataFrame:
        """``merged`` with least and greatest values found anew where one was taken out."""
        if not (self.least or self.greatest):
            return merged
        ends = {**self.least, **self.greatest}
        left = gone.filter(F.expr(self.where)).groupBy(*self.groups).agg(
            *[F.min(c).alias(n) for n, c in self.least.items()],
            *[F.max(c).alias(n) for n, c in self.greatest.items()])
        hit = F.lit(False)
        for n in ends:
            reaches = F.col(n) >= F.col(f"__g_{n}") if n in self.least else F.col(n) <= F.col(f"__g_{n}")
            hit = hit | F.coalesce(reaches, F.lit(False))
        stale = written(base.join(_beside(left, "__g_"), _same_key(self.groups, "__g_")).filter(hit)
                        .select(*self.groups), "totals-stale")
        again = _beside(stale, "__s_")
        kept = merged.join(again, _same_key(self.groups, "__s_"), "left_anti")
        rows = self.rows.read().join(again, _same_key(self.groups, "__s_"), "left_semi")
        found = rows.filter(F.expr(self.where)).groupBy(*self.groups).agg(
            *[F.min(c).alias(n) for n, c in self.least.items()],
            *[F.max(c).alias(n) for n, c in self.greatest.items()])
        fixed = merged.join(again, _same_key(self.groups, "__s_"), "left_semi").drop(*ends).join(
            _beside(found, "__f_"), _same_key(self.groups, "__f_"), "left").select(
            *self.groups, "n", *self.sums, *[F.col(f"__f_{n}").alias(n) for n in ends])
        return kept.unionByName(fixed)

    def result(self) -> DataFrame:
        """(groups, n, sums, least, greatest) of every group that has rows."""
        return self.totals.read().filter("n > 0")
