"""Tables, and intermediate results that outlive lost executors."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes up to which a side may be broadcast; every use measures the side first and has another way beyond.
BROADCAST_BYTES = 32 << 20

_local_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a temporary folder serves, and only for a local master: on a cluster
    other machines would not see it.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="folioscope-")
    return f"file://{_local_dirs[app]}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back.

    It cuts lineage: a lost executor costs the tasks it ran, not the stages before. Each call writes to a
    folder of its own, under one of the application, which ``clean`` removes; ``release`` removes one table.
    """
    spark = df.sparkSession
    folder = new_folder(spark)
    df.write.parquet(f"{folder}/{name}")
    landed = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    landed.landed_folder = folder
    return landed


def new_folder(spark: SparkSession) -> str:
    """The name of a folder in the shared one that nothing else uses; ``clean`` removes it."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}"


def release(*landed: DataFrame) -> None:
    """Removes tables that ``land`` has returned, once nothing lazy reads them any more; None is left out."""
    for df in landed:
        if df is not None:
            _remove(df.sparkSession, df.landed_folder)


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/folioscope/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Removes all tables that this application has landed; call it once their readers are done."""
    _remove(spark, _own_dir(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Lowers the bytes per Arrow batch to ``size``, so that Python holds few long texts at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > size:
        spark.conf.set(key, str(size))


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Wraps the work of a Python task so that its memory goes back to the system when it ends.

    Workers are kept for later tasks, and allocators keep what was freed; without this an idle worker weighs as much as at its busiest moment.
    """

    def frugally(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
                ctypes.CDLL(None).malloc_trim(0)

    return frugally
