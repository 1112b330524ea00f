"""Intermediate tables in the folder that all executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch, where the session keeps Spark's own 64 MB.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20
_open: list[list[Scratch]] = []
_kept: dict[str, dict] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is configured, a local one is set, but in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return base


@contextmanager
def released() -> Iterator[None]:
    """Deletes, at its end, all tables that were written within; what is returned must be stored elsewhere by then."""
    _open.append([])
    try:
        yield
    finally:
        for s in _open.pop():
            s.close()


def kept(name: str) -> dict:
    """What a worker process keeps for later tasks of the same kind."""
    return _kept.setdefault(name, {})


def _give_back(keep: str | None) -> None:
    for name in [n for n in _kept if n != keep]:
        _kept[name].clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], keep: str | None = None) -> Callable[[Iterator], Iterator]:
    """``run`` in a worker process that first drops what tasks of other kinds kept there, and gives back free memory before and
    after. Spark uses worker processes again, so an idle one's memory would count against all later tasks of its executor."""

    def held(batches: Iterator) -> Iterator:
        _give_back(keep)
        try:
            yield from run(batches)
        finally:
            _give_back(keep)

    return held


class Scratch:
    """Writes DataFrames as Parquet tables, which cuts their lineage and outlives executors. They go when the driver ends, or
    earlier with ``drop``, ``close`` and ``released``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark).rstrip('/')}/millrace/{uuid.uuid4().hex}"
        self.n = 0
        if spark.conf.get(BATCH, None) in (None, "67108864b"):  # Spark's own default
            spark.conf.set(BATCH, str(BATCH_BYTES))
        p = self._path(self.base)
        self._fs(p).deleteOnExit(p)
        if _open:
            _open[-1].append(self)

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._millrace_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for t in tables:
            path = getattr(t, "_millrace_path", None)
            if path:
                p = self._path(path)
                self._fs(p).delete(p, True)

    def close(self) -> None:
        p = self._path(self.base)
        self._fs(p).delete(p, True)

    def tidy(self) -> None:
        """Lets Spark remove the shuffle files of finished steps."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
