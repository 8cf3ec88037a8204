"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tunesmith") -> SparkSession:
    """Session used by tests and bench.py. On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when nothing is configured (local tests) is a folder of our own chosen.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tunesmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for jobs that write and read back."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tunesmith-out/{name}-{uuid.uuid4().hex[:12]}"


def stored_once(df, name: str):
    """``df`` written to the shared folder and read back: its lineage runs once, however often it is used."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Bound an Arrow batch of this session by its bytes: rows may hold long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def release_memory() -> None:
    """Give memory that this process has freed back to the system: workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(task: Callable) -> Callable:
    """``task`` (a generator over batches), with ``release_memory`` when it ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            release_memory()

    return run


def default_parallelism(spark: SparkSession) -> int:
    """The number of shuffle partitions; the cluster's cores if that isn't a number."""
    value = spark.conf.get("spark.sql.shuffle.partitions")
    return int(value) if value.isdigit() else spark.sparkContext.defaultParallelism


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tunesmith`` importable in Python workers (``addPyFile`` of a zip, once per app).

    Arrow UDFs and mapInPandas functions refer to helpers in this package; workers
    started from another directory (or on other machines) need the code shipped.
    The zip goes next to the checkpoints when that folder is a local path,
    otherwise to a driver-side temporary file that Spark serves to executors.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    base = ensure_checkpoint_dir(spark)
    local = base[5:] if base.startswith("file:") else (base if "://" not in base else None)
    folder = local if local and os.path.isdir(local) else tempfile.mkdtemp(prefix="tunesmith-code-")
    path = os.path.join(folder, f"tunesmith-{uuid.uuid4().hex[:12]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
