"""Structured Streaming bronze/silver tables with batch gold on top.

* bronze: ``readStream`` of a landing folder (explicit schema) -> verbatim
  append to a parquet table, own checkpoint.
* silver: ``readStream`` of the *bronze table folder* (stream-from-stream) ->
  the same stateless silver transform as the batch pipeline + expectations.
  Violation counters are attached with ``observe`` before the drop filter and are
  written with every micro-batch, so their sum is complete for any number of
  batches (a query's own progress keeps its last hundred only). A batch's rows
  and counters are folders named by the batch id that a repeated batch replaces.
* gold: batch recompute over the streamed silver tables (materialized views).

All queries use ``trigger(availableNow=True)``: they process what has landed,
in bounded micro-batches, and stop; a rerun with the same checkpoint adds
nothing. Checkpoints and tables live under the shared ``spark.checkpoint.dir``
so a lost executor (or driver restart) resumes from the committed offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.buckets import children
from ledgerloom.operators.expectations import Expectation, apply_expectations
from ledgerloom.plans.medallion import BRONZE, SILVER_EXPECTATIONS, SILVER_FNS
from ledgerloom.session import scratch_path

MAX_FILES_PER_TRIGGER = 64


BATCH = "__batch"       # partition column of tables written by batch


def stream_table(spark: SparkSession, src: str, dst: str, schema: StructType,
                 checkpoint: str, fn: Callable[[DataFrame], DataFrame] | None = None,
                 expectations: Sequence[Expectation] = (), name: str | None = None,
                 counters: str | None = None, max_files: int = MAX_FILES_PER_TRIGGER
                 ) -> StreamingQuery:
    """Incrementally append ``fn(new rows of src)`` to the parquet table ``dst``.

    ``max_files``: input files of a micro-batch. With ``expectations`` every batch
    also writes its violation counts to the folder ``counters``.
    """
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files).parquet(src))
    out = fn(stream) if fn is not None else stream
    writer = out.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    if not expectations:
        return writer.format("parquet").outputMode("append").start(dst)
    if counters is None:
        raise ValueError("expectations need a folder for their counters")

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{name or 'expectations'}-{batch_id}")
        kept, _ = apply_expectations(batch, expectations, seen)
        kept.write.mode("overwrite").parquet(f"{dst}/{BATCH}={batch_id}")
        counts = [(k, int(v or 0)) for k, v in seen.get.items()]
        batch.sparkSession.createDataFrame(counts, "expectation string, violations long") \
            .coalesce(1).write.mode("overwrite").parquet(f"{counters}/{BATCH}={batch_id}")

    return writer.foreachBatch(write).start()


def expectation_counts(spark: SparkSession, counters: str) -> DataFrame:
    """(expectation, violations) over all batches, none where none has run; ``__rows`` counts the rows."""
    if not children(spark, counters):
        return spark.createDataFrame([], "expectation string, violations bigint")
    return spark.read.parquet(counters).groupBy("expectation").agg(
        F.sum("violations").alias("violations"))


@dataclass
class MedallionRun:
    root: str
    silver_paths: dict[str, str]
    bronze_paths: dict[str, str]
    counter_paths: dict[str, str]
    schemas: dict[str, StructType]

    def silver(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The streamed silver tables; one whose source has no file yet is empty."""
        out = {}
        for t, path in self.silver_paths.items():
            if children(spark, path):
                out[t] = spark.read.parquet(path).drop(BATCH)
            else:
                none = SILVER_FNS[t](spark.createDataFrame([], self.schemas[t]))
                out[t], _ = apply_expectations(none, SILVER_EXPECTATIONS[t])
        return out

    def counts(self, spark: SparkSession, table: str) -> DataFrame:
        return expectation_counts(spark, self.counter_paths[table])


MAX_RECORDS_PER_FILE = 5_000_000


def land(df: DataFrame, path: str, files: int | None = None,
         max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Drop a batch of landing files (stands in for the source system's export).

    By default the input partitioning is kept and files hold ``max_records`` rows at
    most, so a large table lands as many bounded files that later micro-batches can
    pick up ``maxFilesPerTrigger`` at a time; ``files`` forces a file count
    (small fixtures).
    """
    out = df.repartition(files) if files else df
    out.write.mode("append").option("maxRecordsPerFile", max_records).parquet(path)


def run_medallion(spark: SparkSession, raw: dict[str, DataFrame], tables: Sequence[str] = BRONZE,
                  root: str | None = None, files: int | None = None,
                  landing: Mapping[str, str] | None = None, silver: bool = True,
                  max_files: int = MAX_FILES_PER_TRIGGER, threads: int = 5) -> MedallionRun:
    """Stream landed files to bronze, then bronze to silver; tables run side by side.

    ``landing``: folders that already hold a table's files; others are landed from
    ``raw``. ``silver=False`` stops at bronze.
    """
    root = root or scratch_path(spark, "medallion")

    def one(t: str) -> None:
        source = (landing or {}).get(t)
        if source is None:
            source = f"{root}/landing/{t}"
            land(raw[t], source, files)
        schema = raw[t].schema
        stream_table(spark, source, bronze[t], schema, f"{root}/_chk/bronze_{t}",
                     max_files=max_files).awaitTermination()
        if silver:
            stream_table(spark, bronze[t], silvers[t], schema, f"{root}/_chk/silver_{t}",
                         SILVER_FNS[t], SILVER_EXPECTATIONS[t], counters=counters[t],
                         max_files=max_files).awaitTermination()

    bronze, silvers, counters = ({t: f"{root}/{kind}/{t}" for t in tables}
                                 for kind in ("bronze", "silver", "counters"))
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        list(pool.map(one, tables))
    return MedallionRun(root, silvers if silver else {}, bronze, counters if silver else {},
                        {t: raw[t].schema for t in tables})
