"""Dumps inside archives: members of ZIP and TAR files as rows.

Archives aren't splittable, so one task opens each; its members leave as rows, which
are dealt out before they are parsed.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Members or lines that leave a task at once.
ROWS = 256
#: Bytes of an archive that travels as one row.
WHOLE_BYTES = 1 << 30


def _emit(pairs: Iterator[tuple], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for pair in pairs:
        held.append(pair)
        if len(held) == ROWS:
            yield _batch(held, kind)
            held = []
    if held:
        yield _batch(held, kind)


def _batch(pairs, kind: pa.DataType):
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], kind)], names=["member", "value"])


def _members(spark: SparkSession, path: str, opened, value: str = "string") -> DataFrame:
    """(member, value) of archives. Those up to WHOLE_BYTES come as Spark reads them, from any
    store it reaches; a larger one, which no row can hold, is opened where it lies."""
    files = spark.read.format("binaryFile").load(path)
    whole = files.where(F.col("length") <= WHOLE_BYTES).select("path", "content")
    large = files.where(F.col("length") > WHOLE_BYTES).select("path", F.lit(None).cast("binary").alias("content"))
    kind = pa.binary() if value == "binary" else pa.string()

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if content.is_valid:
                    yield from _emit(opened(io.BytesIO(content.as_py())), kind)
                else:
                    store, place = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", name))
                    with store.open_input_file(place) as stream:
                        yield from _emit(opened(stream), kind)

    return whole.unionByName(large).mapInArrow(run, f"member string, value {value}")


def _xml_members(stream) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(stream) as archive:
        for name in sorted(n for n in archive.namelist() if n.lower().endswith(".xml")):
            yield name, archive.read(name)


def _jsonl_members(stream) -> Iterator[tuple[str, str]]:
    with tarfile.open(fileobj=stream) as archive:
        for member in archive:
            if member.isfile() and member.name.endswith(".json.gz"):
                with gzip.open(archive.extractfile(member), "rt", encoding="utf-8") as lines:
                    for line in lines:
                        if line.strip():
                            yield member.name, line


def _array_member(stream) -> Iterator[tuple[str, str]]:
    with zipfile.ZipFile(stream) as archive:
        name = next(n for n in archive.namelist() if n.lower().endswith(".json"))
        with archive.open(name) as handle:
            for record in json.load(handle):
                yield name, json.dumps(record)


def read_zip_xml(spark: SparkSession, path: str) -> DataFrame:
    """(member, value binary) of the .xml members of ZIP files, by name. The bytes are left to
    the parser, which reads the encoding that each names."""
    return _members(spark, path, _xml_members, "binary")


def read_tar_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(member, value) of the lines of .json.gz members of TAR files."""
    return _members(spark, path, _jsonl_members)


def read_zip_json_array(spark: SparkSession, path: str) -> DataFrame:
    """(member, value) of the records of the first .json member of ZIP files."""
    return _members(spark, path, _array_member)


def dealt_out(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.xxhash64("value"))
