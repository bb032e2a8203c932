"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

#: Fixed value: the word pattern of the contracts.
WORD = r"[^\x20\x09-\x0D]+"


_OWN_DIR: dict[str, str] = {}
_MADE: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (tests on one machine) a temporary folder takes its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIR:
            _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        named = _OWN_DIR[app]
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's Python ends."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _MADE.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _MADE:
        with contextlib.suppress(Exception):  # the session may have gone, and the folder may be cleaned by others
            _delete(spark, path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    What follows starts from the files, so lost executors cost one task's work
    and no earlier step runs twice.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*written: DataFrame | None) -> None:
    """Delete tables that ``cut`` has written and that nothing reads any more."""
    for df in written:
        if df is not None:
            _delete(df.sparkSession, df._written_at)


#: Bytes on disk up to which a written table may be broadcast; beyond it the join is shuffled.
BROADCAST_BYTES = 8 << 20


def sized(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcast if the bytes of its files are few enough."""
    few = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= BROADCAST_BYTES
    return broadcast(df) if few else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Bytes of text and rows that a Python worker handles at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 22, 2000


def text_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of bounded rows and bytes of the given text column, one row at least."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1
            n = max(1, min(upto - at, SLICE_ROWS))
            yield batch.slice(at, n)
            at += n
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only in glibc
        ctypes.CDLL(None).malloc_trim(0)


def handing_back(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a generator for a Python worker, followed by ``give_back`` once its own values have gone, even if it is not read to its end."""

    @functools.wraps(run)
    def wrapped(*args) -> Iterator:
        try:
            yield from run(*args)
        finally:
            give_back()

    return wrapped


def map_columns(df: DataFrame, columns: list[str], schema: pa.Schema, ddl: str, rows: Callable[..., list]) -> DataFrame:
    """Apply ``rows`` to the named columns (as lists, the last one of text), some rows at a time, and return its columns.

    ``rows`` gets one list for each input column and returns one list for each
    field of ``schema``, all of one length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, len(columns) - 1):
            out = rows(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, schema)], schema=schema)

    return df.select(*columns).mapInArrow(handing_back(run), ddl)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(top.rglob("*.py")):
            out.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
