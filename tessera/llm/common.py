"""Helpers shared by the training-data operators.

Everything here is deliberately small: a reader for the driver tables, the one
place that decides where intermediate tables live, and a helper for emitting
Arrow batches of bounded size.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space; the word rule of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes an emitted Arrow batch may reach before it is handed to Spark.
EMIT_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, by Spark's reader (the path may be a store only Spark opens)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, a temporary folder is made and set as this session's
    checkpoint folder, but only where all runs on one machine; a cluster must name one.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if not configured and current.isDefined():
        return current.get().rstrip("/")
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tessera-")
    if not current.isDefined():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


#: Folders of intermediate tables made in this process, in order.
_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    folder = f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    _made.append(folder)
    return f"{folder}/{label}"


def scratch_mark() -> int:
    """Where the list of intermediate tables stands, for drop_scratch."""
    return len(_made)


def drop_scratch(spark: SparkSession, mark: int, keep: str) -> None:
    """Delete the intermediate tables made since mark, but for the one that holds `keep`:
    what depends on them must have been written by then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _made[mark:]:
        if not keep.startswith(folder + "/"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
    _made[mark:] = [f for f in _made[mark:] if keep.startswith(f + "/")]


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df once into the shared folder and read it back.

    Used where a costly result is read more than once: unlike a cache, the files
    survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsigned_crc32(column) -> "F.Column":
    """crc32 of a column's text form, as Spark computes it (unsigned, in a long)."""
    return F.crc32(F.encode(column.cast("string"), "UTF-8"))


def rows_to_batches(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Gather row tuples into Arrow batches of about EMIT_BYTES, weighed by weigh(row)."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= EMIT_BYTES or len(held) >= 8192:
            yield to_batch(held, schema)
            held, size = [], 0
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, giving back memory at its end: Python workers are kept between tasks, and what
    they hold idle counts against the executor."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, one at a time in Python."""
    for at in range(batch.num_rows):
        yield {name: column[at].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
