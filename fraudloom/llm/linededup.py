"""Line deduplication with keep bitmaps.

Every line long enough gives a row (key hash of 128 bits, document, position).
The rows are partitioned by ranges of all of these, so one very frequent line
spreads over many partitions, and sorted inside. A pass over the sorted rows
then sees the first document of each key before all others; a key that runs
over a partition's edge takes its first document from a table with one row per
partition. What comes back is one bitmap per document with dropped lines, not
its text.

A line goes if its key occurs in a document with a smaller doc_id (null sorts
first). All occurrences in that smallest document stay. Null and empty texts are
one empty line. Rows that share a doc_id count as one document; rows that are
equal throughout get equal bitmaps. Extra columns pass through ``apply_bitmaps``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom.llm.common import BLANKS, shuffle_partitions, slices, stored, whole_text

_BLANKS = BLANKS.encode()
_NULL_DOC = -(1 << 63)


_ORDER = ["h1", "h2", "doc_id", "text_key", "pos"]
_DROPPED, _LEADING, _EDGE = 0, 1, 2


def row_keys() -> list[Column]:
    """``own_doc`` (null first) and ``text_key``, which tells apart rows of one doc_id."""
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_DOC))
    return [own.alias("own_doc"), F.xxhash64(whole_text()).alias("text_key")]


def line_rows(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``h1, h2`` (hash of the key), ``doc_id``, ``text_key``, ``pos`` of lines with long keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, rows, places = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for pos, line in enumerate((text or "").encode().lower().split(b"\n")):
                    line = line.strip(_BLANKS)
                    if len(line) < min_chars or (not line.isascii() and len(line.decode()) < min_chars):
                        continue
                    digests.append(xxhash.xxh3_128_digest(line))
                    rows.append(row)
                    places.append(pos)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column("own_doc").take(rows),
                 batch.column("text_key").take(rows), pa.array(places, pa.int32())], _ORDER)

    return docs.select(*row_keys(), "text").mapInArrow(
        run, "h1 bigint, h2 bigint, doc_id bigint, text_key bigint, pos int")


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition that are not in the first document of their key.

    Rows of the first document of the partition's first key are handed on as
    leading: an earlier partition may hold a smaller one. The last row out names
    the key at the end, its first document, and whether the partition has no other.
    """
    names = ["kind", "part", *_ORDER]
    part, opening, key, first, is_opening = None, None, None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ["part", *_ORDER]}
        h1, h2, doc = column["h1"], column["h2"], column["doc_id"]
        begins = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        firsts = doc[begins].copy()
        if part is None:
            part, opening = int(column["part"][0]), (h1[0], h2[0])
        elif key == (h1[0], h2[0]):
            firsts[0] = first
        dropped = doc > np.repeat(firsts, np.diff(np.r_[begins, len(doc)]))
        leading = (h1 == opening[0]) & (h2 == opening[1]) & ~dropped if is_opening else np.zeros(len(doc), bool)
        key, first = (h1[-1], h2[-1]), firsts[-1]
        is_opening = key == opening
        for kind, rows in ((_DROPPED, dropped), (_LEADING, leading)):
            if rows.any():
                kinds = pa.array(np.full(int(rows.sum()), kind, np.int32))
                yield pa.RecordBatch.from_arrays([kinds, *(pa.array(column[n][rows]) for n in names[1:])], names)
    if part is not None:
        one = [[_EDGE], [part], [key[0]], [key[1]], [first], [0], [int(is_opening)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one, kinds)], names)


def dropped_lines(rows: DataFrame) -> DataFrame:
    """``doc_id, text_key, pos`` of the rows that do not stand in the first document of their key."""
    spark = rows.sparkSession
    # Range partitioning reads its input twice, so that is written first.
    ranged = stored(rows, "lines").repartitionByRange(shuffle_partitions(spark), *_ORDER).sortWithinPartitions(*_ORDER)
    schema = "kind int, part int, h1 bigint, h2 bigint, doc_id bigint, text_key bigint, pos int"
    marks = stored(
        ranged.select(F.spark_partition_id().alias("part"), *_ORDER).mapInArrow(_mark, schema), "line-marks")

    # One row per partition: the key that runs into the next one, with its first document.
    carried, running = [], None
    for edge in marks.where(F.col("kind") == _EDGE).orderBy("part").collect():
        if running:
            carried.append((edge.part, *running))
        if not (running and edge.pos and running[:2] == (edge.h1, edge.h2)):
            running = (edge.h1, edge.h2, edge.doc_id)
    before = spark.createDataFrame(carried, "part int, h1 bigint, h2 bigint, first bigint")
    leading = (
        marks.where(F.col("kind") == _LEADING)
        .join(F.broadcast(before), ["part", "h1", "h2"])  # at most one row per shuffle partition
        .where("doc_id > first")
    )
    columns = ["doc_id", "text_key", "pos"]
    return marks.where(F.col("kind") == _DROPPED).select(columns).unionAll(leading.select(columns))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """One row per document with dropped lines: ``doc_id, text_key, bitmap``.

    The bitmap has one bit per line (1: keep) up to the byte of the last dropped
    one, deflated; lines beyond it stay.
    """
    def pack(places) -> bytes:
        bits = np.ones(int(max(places)) // 8 * 8 + 8, np.uint8)  # whole bytes of ones
        bits[places] = 0
        return zlib.compress(np.packbits(bits).tobytes(), 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(np.asarray(p)) for p in batch.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(packed, pa.binary())],
                ["doc_id", "text_key", "bitmap"])

    per_document = dropped.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("places"))
    return per_document.mapInArrow(run, "doc_id bigint, text_key bigint, bitmap binary")


def kept_flags(bitmap: bytes | None, lines: int) -> np.ndarray:
    """Whether each of ``lines`` lines stays."""
    flags = np.ones(lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:lines].astype(bool)
        flags[:len(bits)] = bits
    return flags


def line_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Keep bitmaps of all documents that lose a line."""
    return keep_bitmaps(dropped_lines(line_rows(docs, min_chars)))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` and ``n_dropped``.

    Columns of these two names in ``docs`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The keys stand beside the row: its own columns may have any names.
    flat = docs.select(F.struct(*kept).alias("row"), *row_keys())
    joined = flat.join(
        bitmaps.select(F.col("doc_id").alias("own_doc"), "text_key", "bitmap"), ["own_doc", "text_key"], "left")
    rest = [c for c in kept if c != "text"]
    plain = joined.select(
        *[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(rest)],
        F.col("row").getField("text").alias("text"), "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, lines, dropped = [], [], []
            for text, bitmap in zip(batch.column("text").to_pylist(), batch.column("bitmap").to_pylist()):
                cut = (text or "").split("\n")
                lines.append(len(cut))
                if bitmap is not None:
                    cut = list(compress(cut, kept_flags(bitmap, len(cut))))
                    text = "\n".join(cut)
                texts.append(text)
                dropped.append(lines[-1] - len(cut))
            names = batch.schema.names[:-2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string()),
                 pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                [*names, "text", "n_lines", "n_dropped"])

    schema = T.StructType([
        *plain.schema.fields[:-2], T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    made = plain.mapInArrow(run, schema)
    back = {c: F.col(f"c{i}") for i, c in enumerate(rest)}
    return made.select(*[(back[c] if c in back else F.col(c)).alias(c) for c in [*kept, "n_lines", "n_dropped"]])


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Find repeated lines and drop them: ``docs`` with shorter texts, ``n_lines``, ``n_dropped``."""
    return apply_bitmaps(docs, line_bitmaps(docs, min_chars))
