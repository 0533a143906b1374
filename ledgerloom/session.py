"""Spark session helpers.

The library never creates its own cluster settings on a shared session; these
helpers exist for tests, the bench and the smoke entry point. The only setting
the library itself reads is ``spark.checkpoint.dir`` (see
:func:`checkpoint_root`).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerloom") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is. Only in local mode, where driver and executors are one
    process, a fresh scratch folder is created when it is unset and recorded in
    the session; on a cluster that folder would differ from machine to machine,
    so an unset name is an error there.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: with master {master!r} it must name "
                               "a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover - Connect sessions have no SparkContext
        pass
    return root


_SCRATCH: list[str] = []        # folders handed out by this process


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    _SCRATCH.append(f"{root}/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Delete this process's scratch folders, at the end of a run; the number deleted.

    What reads them (landed tables, streamed tables, plans over numbered rows) must
    be done with; ``ledgerloom.sources.datasets.end_run`` also forgets those tables.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done
