"""Tables that batches change: a ledger of complete batches, rows in hash buckets.

* :class:`Ledger` - the batches of a folder that are complete. A batch writes its rows
  to a folder of its own name first and is entered then; readers look at entered
  batches only, so a batch that failed half-way is invisible, and one that is repeated
  replaces its own folder.
* :class:`KeyedTable` - rows by hash bucket of their key. A batch reads and writes the
  buckets it touches, as new versions beside the old ones (``bucket=3/batch=7``); other
  buckets keep their files. ``before(batch)`` is the table as it stood before a batch,
  also when that batch has been written already: a repeated batch computes the same
  again. Old versions go once two newer ones are complete.

Folders are listed through Spark's file systems; a table has a fixed number of buckets,
given when it is first written, so listings are bounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET, BATCH = "bucket", "batch"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    place, fs = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _hadoop(spark, path)
    fs.delete(place, True)


class Ledger:
    """Names of the complete batches of the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/_ledger"

    def enter(self, batch: object) -> None:
        place, fs = _hadoop(self.spark, f"{self.path}/{batch}")
        fs.create(place, True).close()

    def batches(self) -> list[str]:
        return children(self.spark, self.path)


def append_once(df: DataFrame, path: str, batch: str) -> bool:
    """Append ``df`` as batch ``batch`` of the table at ``path``; False if it is there already.

    The batch becomes visible as a whole. A batch that failed before it was entered is
    written again, in place of what it left.
    """
    if not batch or any(c in batch for c in "/=\\:") or batch[0] in "._":
        raise ValueError(f"batch {batch!r} is no name of a folder")
    ledger = Ledger(df.sparkSession, path)
    if batch in ledger.batches():
        return False
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch}")
    ledger.enter(batch)
    return True


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all complete batches of an appended table, without the batch's name."""
    done = set(Ledger(spark, path).batches())
    there = [c for c in children(spark, path) if c.startswith(f"{BATCH}=")]
    if not done:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields]).add(BATCH, "string")).parquet(path)
    torn = [c.split("=", 1)[1] for c in there if c.split("=", 1)[1] not in done]
    return (rows.filter(~F.col(BATCH).isin(torn)) if torn else rows).drop(BATCH)


class KeyedTable:
    """A table of rows by key at ``path``, changed by numbered batches.

    ``schema`` holds the table's columns. Null keys are keys.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType,
                 n_buckets: int = 64):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        known = [c for c in children(spark, self.path) if c.startswith("buckets=")]
        self.n_buckets = int(known[0].split("=")[1]) if known else n_buckets
        self.root = f"{self.path}/buckets={self.n_buckets}"
        self.ledger = Ledger(spark, self.path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys: at most ``n_buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def versions(self, before: int | None = None) -> dict[int, int]:
        """The latest version of each bucket: of complete batches, or of those before one."""
        done = {int(b) for b in self.ledger.batches()}
        out = {}
        for name in children(self.spark, self.root):
            if name.startswith(f"{BUCKET}="):
                held = [int(v.split("=")[1]) for v in children(self.spark, f"{self.root}/{name}")
                        if v.startswith(f"{BATCH}=")]
                held = [b for b in held if b in done and (before is None or b < before)]
                if held:
                    out[int(name.split("=")[1])] = max(held)
        return out

    def read(self, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows, optionally as before a batch and of some buckets only."""
        found = self.versions(before)
        wanted = [b for b in found if buckets is None or b in set(buckets)]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *(f"{self.root}/{BUCKET}={b}/{BATCH}={found[b]}" for b in wanted))

    def put(self, rows: DataFrame, batch: int, buckets: Iterable[int]) -> None:
        """Write all rows of the given buckets as batch ``batch`` and enter it.

        ``rows`` must not read the version that is written. Rows of a bucket keep their
        partitioning: a hot key's rows stay spread over the files they come in.
        """
        for b in buckets:       # what a failed run of this batch left
            remove(self.spark, f"{self.root}/{BUCKET}={b}/{BATCH}={batch}")
        (rows.select(*self.schema.names).withColumn(BUCKET, self.bucket())
         .withColumn(BATCH, F.lit(batch)).write.mode("append").partitionBy(BUCKET, BATCH).parquet(self.root))
        self.ledger.enter(batch)
        self._prune(buckets)

    def _prune(self, buckets: Iterable[int], keep: int = 2) -> None:
        done = {int(b) for b in self.ledger.batches()}
        for b in buckets:
            held = sorted((int(v.split("=")[1]) for v in children(self.spark, f"{self.root}/{BUCKET}={b}")
                           if v.startswith(f"{BATCH}=")), reverse=True)
            for old in [v for v in held if v in done][keep:]:
                remove(self.spark, f"{self.root}/{BUCKET}={b}/{BATCH}={old}")
