"""Lazy dataset registry: ``source()`` / ``ref()`` / pipeline-local reads.

A :class:`Datasets` maps a model name to a lazily built DataFrame. Builders are
plain functions registered with :func:`model`; the first ``ds[name]`` call
builds the logical plan (no Spark job runs) and memoizes it, so every model
that refers to ``stg_orders`` shares one plan node and Catalyst can reuse the
exchange. Raw tables come from an input adapter or are injected directly
(fixtures, a streamed silver layer, tables read from storage).
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Builder = Callable[["Datasets"], DataFrame]

_REGISTRY: dict[str, Builder] = {}
_PROJECT: dict[str, str] = {}
_MATERIALIZED: dict[str, str] = {}
MATERIALIZATIONS = ("view", "ephemeral", "table")
ROWS_A_TASK = 250_000       # rows of a driver table that one task of a large shuffle takes
FEW_ROWS = 500_000          # shuffles of fewer rows are left to the session's settings


def model(name: str, project: str = "platform",
          materialized: str = "view") -> Callable[[Builder], Builder]:
    """Register ``fn(ds) -> DataFrame`` as the builder of ``name``.

    ``materialized``: ``view``/``ephemeral`` models stay lazy plans inlined into
    their consumers; ``table`` models are written once per run when the registry
    is built with ``materialize=True`` and read back by every consumer.
    """
    if materialized not in MATERIALIZATIONS:
        raise ValueError(f"materialized must be one of {MATERIALIZATIONS}")

    def deco(fn: Builder) -> Builder:
        _REGISTRY[name] = fn
        _PROJECT[name] = project
        _MATERIALIZED[name] = materialized
        return fn

    return deco


def materialization(name: str) -> str:
    _load_all()
    return "table" if _PROJECT.get(name) == "source" else _MATERIALIZED.get(name, "view")


def registered() -> Mapping[str, Builder]:
    _load_all()
    return dict(_REGISTRY)


def _load_all() -> None:
    # Importing the plan modules registers their models.
    from ledgerloom.plans import (  # noqa: F401
        crm, data_science, finance, marketing, marts, medallion, staging,
    )
    from ledgerloom.sources import adapters  # noqa: F401


class Datasets:
    """Registry of lazily built DataFrames for one run.

    ``as_of`` pins every "today"-relative computation (recency, overdue,
    freshness); without one it is the day on which the registry is made.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 as_of: _dt.date | None = None,
                 tables: Mapping[str, DataFrame] | None = None,
                 land_sources: bool = False, materialize: bool = False,
                 catalog: Mapping[str, str] | None = None):
        _load_all()
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of or _dt.date.today()      # one day for the whole run
        self._scope: tuple | None = None
        self.land_sources = land_sources
        # table materialization needs inputs that are fully determined by
        # (sf_dir, as_of); registries with injected tables never materialize
        self.materialize = materialize and not (tables or catalog)
        # dataset name -> catalog table ("schema.table"): read where it stands
        self.catalog = dict(catalog or {})
        self._cache: dict[str, DataFrame] = dict(tables or {})
        self._guard = threading.Lock()
        self._locks: dict[str, threading.RLock] = {}

    # -- access -------------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        with self._lock_for(name):
            return self._get(name)

    def _lock_for(self, name: str) -> threading.RLock:
        with self._guard:
            return self._locks.setdefault(name, threading.RLock())

    def _get(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in self.catalog:
                self._cache[name] = self.spark.table(self.catalog[name])
                return self._cache[name]
            if name not in _REGISTRY:
                raise KeyError(f"unknown dataset {name!r}")
            if self.land_sources and _PROJECT.get(name) == "source" and self.sf_dir:
                self._cache[name] = landed(self.spark, (*self.scope, None), name,
                                           lambda: _REGISTRY[name](self))
            elif (self.materialize and _MATERIALIZED.get(name) == "table" and self.sf_dir):
                self._cache[name] = landed(self.spark, (*self.scope, self.as_of), name,
                                           lambda: _REGISTRY[name](self))
            else:
                self._cache[name] = _REGISTRY[name](self)
        return self._cache[name]

    def build(self, name: str) -> DataFrame:
        """The plan of model ``name`` itself, over (possibly materialized) inputs.

        Unlike ``ds[name]`` this never reads a materialized copy of ``name``:
        it is what running one model does, with its refs resolved as tables.
        """
        if name not in _REGISTRY:
            raise KeyError(f"unknown dataset {name!r}")
        return _REGISTRY[name](self)

    def landed_path(self, name: str) -> str | None:
        """Folder of a written table of this run, if ``name`` is one."""
        key = (self.spark.sparkContext.applicationId, (*self.scope, None), name)
        return _PATHS.get(key) if self.land_sources else None

    @property
    def scope(self) -> tuple:
        """The input folder and what lies in it now: written tables of another state are stale."""
        if self._scope is None:
            self._scope = (self.sf_dir, input_listing(self.spark, self.sf_dir))
        return self._scope

    def __contains__(self, name: str) -> bool:
        return name in self._cache or name in self.catalog or name in _REGISTRY

    def source(self, schema: str, table: str) -> DataFrame:
        """A loaded table of the session's catalog."""
        return self.spark.table(f"{schema}.{table}")

    def put(self, name: str, df: DataFrame) -> "Datasets":
        """Inject or replace a dataset (fixtures, streamed tables)."""
        self._cache[name] = df
        self.materialize = False
        return self

    def with_tables(self, **tables: DataFrame) -> "Datasets":
        """A new registry sharing the inputs but overriding some tables."""
        new = Datasets(self.spark, self.sf_dir, self.as_of, land_sources=self.land_sources,
                       catalog=self.catalog)
        for k, v in self._cache.items():
            if k.startswith(("raw_", "sf_")):
                new._cache[k] = v
        new._cache.update(tables)
        return new

    def driver(self, name: str) -> DataFrame:
        """A driver-generated parquet table (``{sf_dir}/{name}.parquet``)."""
        if self.sf_dir is None:
            raise ValueError("no sf_dir given; inject raw tables instead")
        key = f"driver:{name}"
        if key not in self._cache:
            path = f"{self.sf_dir}/{name}.parquet"
            gkey = (self.spark.sparkContext.applicationId, "driver", path, self.scope[1])
            with _lock_for(gkey):
                if gkey not in _LANDED:
                    _LANDED[gkey] = self.spark.read.parquet(path)
            self._cache[key] = _LANDED[gkey]
        return self._cache[key]

    def parts(self, name: str) -> int | None:
        """Partitions for a shuffle of as many rows as driver table ``name`` has; None if few.

        Counted once per session and input; parquet footers hold the number.
        """
        if self.sf_dir is None:
            return None
        rows = once(self.spark, self.scope, f"rows of {name}", self.driver(name).count)
        return None if rows < FEW_ROWS else max(-(-rows // ROWS_A_TASK),
                                                self.spark.sparkContext.defaultParallelism)

    def as_of_col(self):
        from pyspark.sql import functions as F

        return F.lit(self.as_of)

    # -- cross-project ref with a contract check ------------------------------
    def ref(self, project: str, name: str,
            contract: StructType | Mapping[str, str] | None = None) -> DataFrame:
        """Cross-project reference; validates ``contract`` at analysis time.

        Raises :class:`~ledgerloom.operators.contracts.ContractError` before any
        job runs when a declared column is missing or has another type.
        """
        owner = _PROJECT.get(name)
        if owner is not None and owner != project:
            raise KeyError(f"{name!r} belongs to project {owner!r}, not {project!r}")
        df = self[name]
        if contract is not None:
            from ledgerloom.operators.contracts import enforce_contract

            df = enforce_contract(df, contract, name)
        return df


def input_listing(spark: SparkSession, folder: str) -> tuple:
    """(path, length, modification time) of the parquet files of an input folder.

    Through Spark's file systems, so any store that Spark reads will do.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for top in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")) or []:
        files = fs.listStatus(top.getPath()) if top.isDirectory() else [top]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(sorted(found))


# -- landing: write each mapped source table once, read it back -------------------

_LANDED: dict[tuple, DataFrame] = {}      # key -> DataFrame reading the written table
_PATHS: dict[tuple, str] = {}             # key -> its folder
_LOCKS: dict[tuple, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock_for(key: tuple) -> threading.Lock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(key, threading.Lock())


def landed(spark: SparkSession, scope: tuple, name: str, build: Callable[[], DataFrame]
           ) -> DataFrame:
    """Table ``name`` written once per scope as parquet under ``spark.checkpoint.dir``.

    Sources play the role of the loaded raw tables (the adapter plan runs once
    per session and input folder, an ingest); ``table`` models are the built
    marts. Every consumer reads the written table, which also cuts lineage and
    survives executor loss. ``scope`` holds what the table depends on (input
    folder, as-of date); the application id keeps sessions apart.
    """
    from ledgerloom.session import scratch_path

    key = (spark.sparkContext.applicationId, scope, name)
    # one writer per table: concurrent builders (threads) wait for the first one
    with _lock_for(key):
        df = _LANDED.get(key)
        if df is None:
            path = scratch_path(spark, f"landing-{name}")
            build().write.mode("overwrite").parquet(path)
            # the reader is kept too: listing files and reading the parquet footer
            # once per session, not once per query
            df = spark.read.parquet(path)
            _LANDED[key], _PATHS[key] = df, path
    return df


def end_run(spark: SparkSession) -> int:
    """Forget all written tables and delete the run's scratch folders."""
    from ledgerloom.session import clear_scratch

    with _LOCKS_GUARD:
        _LANDED.clear()
        _PATHS.clear()
    return clear_scratch(spark)


def once(spark: SparkSession, scope: tuple, name: str, build: Callable[[], object]):
    """``build()`` once per scope: what it wrote (a table, a streamed run) is not written again."""
    key = (spark.sparkContext.applicationId, scope, name)
    with _lock_for(key):
        if key not in _LANDED:
            _LANDED[key] = build()
        return _LANDED[key]


def publish(ds: "Datasets", names: Sequence[str], path: str | None = None,
            schema: str | None = None, docs: Mapping[str, Mapping[str, str]] | None = None,
            comments: Mapping[str, str] | None = None,
            properties: Mapping[str, Mapping[str, str]] | None = None,
            buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None) -> dict[str, str]:
    """Build models into a named place, where other jobs find them; name -> place.

    ``table`` models become parquet folders below ``path``, or catalog tables of
    ``schema`` (with table comment and properties); ``view`` models become temporary
    views of their name; ``ephemeral`` models are inlined and get no place. ``docs``
    holds column comments by model, kept in the written schema.

    ``buckets``: model -> (number, keys): its catalog table is bucketed and sorted by the
    keys. Tables with the same number of buckets of a key are joined, grouped and tested
    on it without a shuffle (read them with ``Datasets(catalog=...)``). A bucket is
    written by one task; choose the number so that one fits.
    """
    if (path is None) == (schema is None):
        raise ValueError("give either a path or a schema")
    if buckets and schema is None:
        raise ValueError("buckets need a catalog table, so a schema")
    places = {}
    for name in names:
        kind = materialization(name)
        df = commented(ds.build(name), (docs or {}).get(name, {}))
        if kind == "ephemeral":
            continue
        if kind == "view":
            df.createOrReplaceTempView(name)
            places[name] = name
        elif path is not None:
            places[name] = f"{path.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(places[name])
        else:
            places[name] = f"{schema}.{name}"
            writer = df.write.mode("overwrite")
            if name in (buckets or {}):
                number, keys = buckets[name]
                # one file a bucket: its rows are sorted as a whole
                writer = df.repartition(number, *keys).write.mode("overwrite") \
                    .bucketBy(number, *keys).sortBy(*keys)
            writer.saveAsTable(places[name])
            quoted = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
            if name in (comments or {}):
                ds.spark.sql(f"COMMENT ON TABLE {places[name]} IS {quoted(comments[name])}")
            if name in (properties or {}):
                pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties[name].items())
                ds.spark.sql(f"ALTER TABLE {places[name]} SET TBLPROPERTIES ({pairs})")
    return places


def commented(df: DataFrame, docs: Mapping[str, str]) -> DataFrame:
    """``df`` with column comments in its schema."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(c).alias(c, metadata={"comment": docs[c]}) if c in docs else F.col(c)
                       for c in df.columns])


def build_tables(ds: "Datasets", names: Sequence[str], threads: int = 4) -> dict[str, DataFrame]:
    """Materialize ``names`` with up to ``threads`` concurrent Spark jobs.

    Like a project build with several threads: independent tables are written
    at the same time; a table that several of them need is written once (the
    others wait on its lock) and dependencies resolve through ``ds[...]``.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {n: pool.submit(ds.__getitem__, n) for n in names}
        return {n: f.result() for n, f in futures.items()}
