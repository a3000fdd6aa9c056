"""Session helpers: table access, the shared folder, lineage cuts, bounded broadcasts."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

#: Largest side, in rows, that an operator may broadcast after counting it.
BROADCAST_ROWS = 100_000


def local_session(app: str = "corpusloom", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests, a laptop) a temporary folder is set.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if current.isEmpty():
            sc.setCheckpointDir(named)
        return named
    if current.isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Paths that ``scratch`` deletes at its end.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``persisted`` writes within, but for what it keeps, is deleted at the end, and the shuffle files of it are let go."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            delete(spark, path)
        # Spark deletes shuffle files once the driver has collected what refers to them
        gc.collect()
        spark._jvm.System.gc()


def persisted(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (columnar, prunable).

    It is deleted when the application ends, or with the ``scratch`` it is written in unless it is to be kept.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not keep and _SCRATCH.get() is not None:
        _SCRATCH.get().append(path)
    # whoever reads it later reads it lazily, so it goes when the application ends
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def together(*steps: Callable) -> list:
    """The steps' results; the jobs of all steps run at the same time, so small ones don't leave cores idle."""
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, inheriting(step)) for step in steps]]


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a bounded count proves the side small; else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
