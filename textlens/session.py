"""Session and checkpoint settings shared by the iterative and two-pass operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "textlens", cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TEXTLENS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


# Bytes of an Arrow batch between the JVM and Python; each side holds some of them.
ARROW_BYTES = 4 << 20


def small_arrow_batches(spark: SparkSession) -> None:
    """Batches of some :data:`ARROW_BYTES` between the JVM and Python from now on, unless the session asks for smaller ones.

    The bound is by rows alone otherwise: ten thousand long texts, or packed batches of texts, are held as a whole on both sides.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now <= 0 or now > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def checkpoint_folder(spark: SparkSession) -> str:
    """Reliable checkpoint folder of the session.

    ``spark.checkpoint.dir`` is taken when the cluster names one. Only a local
    session may fall back to a temporary folder: executors on other machines
    could not read it, and a lost executor would lose the data with it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="textlens-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_recorders: list[list[str]] = []


@contextmanager
def scratch_paths() -> Iterator[list[str]]:
    """The scratch paths handed out inside the block, so that a caller can delete the tables once it is done with them."""
    made: list[str] = []
    _recorders.append(made)
    try:
        yield made
    finally:
        _recorders.remove(made)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _recorders:
        made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the checkpoint folder and go on from the stored rows."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def cut_counted(frame: DataFrame) -> tuple[DataFrame, int]:
    """:func:`cut`, and the number of stored rows."""
    stored = cut(frame)
    return stored, stored.count()


def store(frame: DataFrame, name: str = "table") -> DataFrame:
    """Like :func:`cut` for tables as large as the corpus: a compressed table with column pruning."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
