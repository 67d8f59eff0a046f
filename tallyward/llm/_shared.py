"""What the operators of this subpackage share: intermediate tables and row handling.

Executors can be lost at any time, so intermediate results are either plain
lineage or tables written to the folder that all machines share
(``spark.checkpoint.dir``).  Nothing is kept on one machine alone.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest table, in bytes of its rows as counted, that may be broadcast.
BROADCAST_BYTES = 48 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; our own only where none is named and there is one machine."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not (context.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tallyward-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder, and read again.

    Cuts lineage without a copy that only one executor holds.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a source for which a table made of a small part of it gets one file.
FEW_BYTES = 64 << 20


def few(df: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """:func:`written` for a table that is small beside ``source``, as few files.

    The number of files follows the source's size as the optimizer knows it, at most the number of shuffle
    partitions.  ``df`` must end in a shuffle, of which it only merges the reading tasks.
    """
    spark = df.sparkSession
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return written(df.coalesce(max(1, min(most, max(FEW_LEAST, -(-size // FEW_BYTES))))), name)


#: Files of such a table if its source is small, so that all cores have work.
FEW_LEAST = 12


def dropped(table: DataFrame) -> None:
    """Delete what :func:`written` made, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str, row_bytes: int,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``small``, broadcast if its counted size is within ``limit``, else shuffled.

    ``small`` must be cheap to count, so callers pass a written table.
    ``row_bytes`` is an upper estimate of one row's size.
    """
    if small.count() * row_bytes <= limit:
        small = F.broadcast(small)
    return big.join(small, on, how)


#: Rows of an Arrow batch, and bytes of their texts, that a task works on at a time; at least one row.
SLICE_ROWS, SLICE_BYTES = 1000, 8 << 20


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` over slices of bounded rows and bytes, giving memory back to the system at a task's end.

    Python workers outlive their tasks; what a task has freed must not count against the next stage.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(part for batch in batches for part in _slices(batch))
        finally:
            _release()

    return df.mapInArrow(tidy, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start, done = 0, 0
    while start < batch.num_rows:
        within = int(np.searchsorted(ends, done + SLICE_BYTES, side="right")) - start
        rows = max(1, min(SLICE_ROWS, within))
        yield batch.slice(start, rows)
        start += rows
        done = ends[start - 1]


def _release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def lacking(df: DataFrame, columns: Iterable[tuple[str, T.DataType]]) -> DataFrame:
    """``df`` reduced to the named columns, cast to their types."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns])


def own_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet, whatever extra columns came along."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id's text divisible by five (null id: not held out)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))
