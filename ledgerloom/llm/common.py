"""Shared pieces of the corpus operators: words, written tables, small sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path

#: A word is a run of characters other than blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
_BLANK = " \t\n\x0b\x0c\r"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage: later jobs read the files, also after an executor was lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(_BLANK))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside a lambda a plain column expression would be evaluated again for each
    element; a lambda's own variable is not.
    """
    return F.transform(F.array(value), body)[0]


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a written table of at most ``max_rows`` rows, else none.

    Beyond the bound the join shuffles both sides and AQE splits hot keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def bounded_draw(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows of a written table whose ``keys`` are distinct, drawn by their hash.

    A key that stands on many rows must have been made one row before.
    """
    n = rows.count()
    if n <= most:
        return rows
    draw, cells = F.pmod(F.xxhash64(*keys, F.lit("draw")), F.lit(1 << 40)), 1 << 40
    near = rows.filter(draw < int(min(1.0, (1.1 * most + 100) / n) * cells))
    return near.orderBy(draw, *keys).limit(most)


def batch_rows(batch):
    """Rows of an Arrow batch as dicts, one at a time: wide rows are never all Python objects."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(columns, name: str) -> str:
    """``name``, or with underscores behind it, so that no column of ``columns`` has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(batches, column: int, n_bytes: int):
    """Arrow batches cut into rows of about ``n_bytes`` of text each (a longer text is whole)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // n_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
                pa.default_memory_pool().release_unused()
