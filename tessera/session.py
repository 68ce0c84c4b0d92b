"""Sessions, the shared work folder, and written cuts of lineage."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("tessera_made", default=None)


def local_session(cores: str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where neither the session nor the context names one and the master is
    this machine (tests) a temporary folder is made and set for the context; on
    a cluster that is an error, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is cut inside is deleted at the end; results must have been written elsewhere by then."""
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get():
            _delete(spark, path)
        _made.reset(token)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = path or work_path(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._tessera_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a ``cut`` that nothing reads any more."""
    path = getattr(df, "_tessera_path", None)
    if path is not None:
        _delete(df.sparkSession, path)
