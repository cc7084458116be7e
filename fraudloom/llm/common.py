"""Helpers shared by the operators: written intermediate tables, files in the
shared folder, Arrow slices of bounded size."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom.session import work_dir

# Blanks, upper and lower letters of ASCII, as the contracts use them.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 4 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    computing ``df`` again, and several readers share one computation.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + (size or 0) > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


# A blank followed by a non-blank starts a chunk of its own: no match of the
# public pattern runs across it, and the look-ahead for blanks ends there too.
_UNSAFE = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?= \S)")


def words_after_space(text: str) -> list[str]:
    """Cut a text where a space precedes a non-blank; the space itself is left out.

    ``parts[0] + "".join(" " + p for p in parts[1:])`` is the text again, and the
    byte-level pattern splits the text exactly as it splits these chunks.
    """
    if not _UNSAFE.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(text)
    if not first and rest:
        return ["", *[p[1:] for p in rest]]
    return [first, *[p[1:] for p in rest]]


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder: file:, hdfs:, s3: or a plain path."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return pafs.LocalFileSystem(), path


class AtomicFile:
    """Writes next to the target and renames at the end, so that a task that is
    repeated or runs twice leaves one complete file."""

    def __init__(self, path: str):
        self.fs, self.path = open_fs(path)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary)

    def write(self, data) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_binary(df: DataFrame, name: str) -> T.StructType:
    """Schema of ``df`` with a binary column ``name`` at the end, in place of one of that name."""
    return T.StructType([*[f for f in df.schema.fields if f.name != name], T.StructField(name, T.BinaryType())])


def set_last(batch: pa.RecordBatch, schema: T.StructType, values: pa.Array) -> pa.RecordBatch:
    """``batch`` in the columns of ``schema``, of which ``values`` is the last."""
    return pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in schema.fields[:-1]], values], schema.names)


def binary_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data`` and end (in bytes) at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def take_runs(values: np.ndarray, ends: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (run i ends at ``ends[i]``) in the order of ``index``, and the ends of the runs taken."""
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    taken = pa.ListArray.from_arrays(offsets, pa.array(values)).take(pa.array(index))
    return taken.values.to_numpy(), taken.offsets.to_numpy()[1:]


def floored(lists: pa.ListArray, scale: int, limit: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Lengths and floor(scale * component) as 32-bit integers of vectors, and which of them are usable:
    not null, all components there, finite and below ``limit`` in size as integers."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components: nan
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore", invalid="ignore"):
        made = np.floor(flat * scale)
        good = np.abs(made) < limit
    wrong = np.concatenate([[0], np.cumsum(~good)])
    usable = (wrong[ends] == wrong[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False)
    return sizes, binary_array(np.where(good, made, 0).astype("<i4"), 4 * ends), usable
