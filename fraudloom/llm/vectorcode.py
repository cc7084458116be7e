"""Vector compression by product codes, entries found by equal-average search.

Components become integers, vectors are cut into consecutive parts, and each part
position has a codebook of a few entries. The nearest entry of a part is found
without comparing with all: entries are sorted by the sum of their components,
and as (sum of part - sum of entry)^2 / dimension never exceeds the squared
distance, the search starts at the part's own sum, goes outward to both sides,
and ends once that bound strictly exceeds the best distance. All arithmetic is on
64-bit integers, so results do not depend on order or partitioning.

Training runs a fixed number of rounds. Each is one pass: tasks assign their
parts and add up components per entry, Spark adds up the tasks' sums, and the
driver divides them. What the driver holds, and sends out, are the codebooks:
``entries`` vectors per vector length.

Rows whose vector is null, or holds a null or non-finite component, or one whose
integer reaches 2^25, are left out. Vectors of different lengths are populations
of their own, each with its codebooks (columns say which); empty vectors code as
zeros. A length that ``parts`` does not divide gives parts that differ by one
component. First entries are the rows with the smallest vec_ids (null last, equal
ones by their components); fewer rows make smaller codebooks. Repeated rows count
each. Only ``vec_id``, ``embedding`` and ``label`` are read; a table without rows
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.common import binary_array, floored, stored

LARGEST = 1 << 25  # integers below it: squared distances of up to 1,024 components fit 64 bits
FEW_LABELS = 100_000  # label sums (16 bytes each) up to which they are broadcast

Codebooks = dict[int, list[np.ndarray]]  # by vector length: per part, entries as rows


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    edges = [dim * p // parts for p in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label``, ``dim`` and ``v``: floor(scale * component) as 32-bit integers, usable rows only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, binary, usable = floored(batch.column("embedding"), scale, LARGEST)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), binary],
                ["vec_id", "label", "dim", "v"]).filter(pa.array(usable))

    label = vectors.schema["label"].dataType.simpleString()
    columns = [F.col("vec_id").cast("bigint"), "label", F.col("embedding").cast("array<double>")]
    return vectors.select(*columns).mapInArrow(run, f"vec_id bigint, label {label}, dim int, v binary")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry (the lower one of equals) of every part, and its squared distance."""
    dim, last = parts.shape[1], len(entries) - 1
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, sorted_entries = sums[order], entries[order]
    own = parts.sum(axis=1)
    best, found = np.full(len(parts), np.iinfo(np.int64).max), np.zeros(len(parts), np.int64)
    rows = np.arange(len(parts))
    up = np.searchsorted(sums, own)
    down = up - 1
    while len(rows):
        gap_up = np.where(up <= last, sums[np.minimum(up, last)] - own[rows], LARGEST * 8192)
        gap_down = np.where(down >= 0, own[rows] - sums[np.maximum(down, 0)], LARGEST * 8192)
        upward = gap_up <= gap_down
        gap = np.where(upward, gap_up, gap_down).astype(np.float64)
        # Squares may leave 64 bits: float first, exact where it is near.
        reach = best[rows].astype(np.float64) * max(dim, 1)
        near = np.abs(gap * gap - reach) <= 1e-9 * reach
        beyond = gap * gap > reach
        for i in np.flatnonzero(near).tolist():
            beyond[i] = int(gap[i]) ** 2 > int(best[rows[i]]) * dim
        going = ~beyond & ((up <= last) | (down >= 0))
        rows, up, down, upward = rows[going], up[going], down[going], upward[going]
        at = np.where(upward, up, down)
        off = parts[rows] - sorted_entries[at]
        distance, number = np.einsum("ij,ij->i", off, off), order[at]
        closer = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
        best[rows[closer]], found[rows[closer]] = distance[closer], number[closer]
        up, down = up + upward, down - ~upward
    return found, best


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and integer vectors of a batch's rows."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        data = b"".join(batch.column("v").take(pa.array(rows)).to_pylist())
        yield dim, rows, np.frombuffer(data, "<i4").reshape(len(rows), dim).astype(np.int64)


def first_entries(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """Parts of the rows with the smallest vec_ids, for each vector length."""
    order = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    first = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= entries)
    made: dict[int, list[np.ndarray]] = {}
    for row in first.select("dim", "v").orderBy("dim", "at").collect():  # `entries` rows a length
        made.setdefault(row.dim, []).append(np.frombuffer(row.v, "<i4").astype(np.int64))
    return {dim: [np.stack(v)[:, a:b] for a, b in bounds(dim, parts)] for dim, v in made.items()}


def improved(rows: DataFrame, books: Codebooks, parts: int) -> Codebooks:
    """Codebooks after one round: every entry becomes the floor of the mean of its parts; unused ones stay."""
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {dim: [np.zeros(b.shape, np.int64) for b in book] for dim, book in held.value.items()}
        counts = {dim: [np.zeros(len(b), np.int64) for b in book] for dim, book in held.value.items()}
        for batch in batches:
            for dim, _, vectors in _by_length(batch):
                for p, (a, b) in enumerate(bounds(dim, parts)):
                    found, _ = nearest(vectors[:, a:b], held.value[dim][p])
                    np.add.at(sums[dim][p], found, vectors[:, a:b])
                    counts[dim][p] += np.bincount(found, minlength=len(counts[dim][p]))
        for dim in sums:
            for p in range(parts):
                used = np.flatnonzero(counts[dim][p])
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim] * len(used), pa.int32()), "part": pa.array([p] * len(used), pa.int32()),
                    "entry": pa.array(used, pa.int32()), "n": pa.array(counts[dim][p][used], pa.int64()),
                    "sums": pa.array(list(sums[dim][p][used]), pa.list_(pa.int64()))})

    made = rows.select("dim", "v").mapInArrow(run, "dim int, part int, entry int, n bigint, sums array<bigint>")
    # One row per part, entry and component: combined in the tasks before it is dealt.
    summed = (
        made.select("dim", "part", "entry", "n", F.posexplode("sums").alias("place", "value"))
        .groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    )
    new = {dim: [b.copy() for b in book] for dim, book in books.items()}
    for row in summed.collect():  # at most `entries` numbers per component
        new[row.dim][row.part][row.entry, row.place] = row.value // row.n
    held.unpersist()
    return new


def train(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks of ``integer_vectors``: a first choice and ``rounds`` improvements."""
    books = first_entries(rows, parts, entries)
    for _ in range(rounds):
        books = improved(rows, books, parts)
    return books


def encode(rows: DataFrame, books: Codebooks, parts: int = 8) -> DataFrame:
    """``vec_id``, ``label``, ``dim``, ``codes`` (a byte per part) and ``error`` (squared distances, summed)."""
    held = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for dim, at, vectors in _by_length(batch):
                for p, (a, b) in enumerate(bounds(dim, parts)):
                    codes[at, p], distance = nearest(vectors[:, a:b], held.value[dim][p])
                    error[at] += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("dim"),
                 binary_array(codes.ravel(), np.arange(1, len(codes) + 1) * parts), pa.array(error)],
                ["vec_id", "label", "dim", "codes", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id bigint, label {label}, dim int, codes binary, error bigint")


def restore(coded: DataFrame, books: Codebooks, parts: int = 8, scale: int = 4096) -> DataFrame:
    """Add ``restored``: the entries that ``codes`` name, as components again."""
    held = coded.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("array<double>")
    def vector(dims, codes):
        return dims.combine(codes, lambda dim, code: np.concatenate(
            [held.value[dim][p][code[p]] for p in range(parts)]) / scale)

    return coded.withColumn("restored", vector("dim", "codes"))


def digest(book: list[np.ndarray]) -> str:
    """Hash of the decimal components of one length's codebooks, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for part in book for x in part.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             few_labels: int = FEW_LABELS) -> tuple[DataFrame, Codebooks]:
    """Codes and errors of all usable rows, with ``label_error`` (errors of the label's rows, nulls together)
    and ``codebooks_sha256`` of the row's length; and the codebooks."""
    if entries > 256:
        raise ValueError("a code is one byte")
    rows = stored(integer_vectors(vectors, scale), "integer-vectors")
    books = train(rows, parts, entries, rounds)
    coded = stored(encode(rows, books, parts), "codes")
    sums = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= few_labels:
        sums = F.broadcast(sums)
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    named = F.lit(None).cast("string")
    for dim, book in books.items():
        named = F.when(F.col("dim") == dim, digest(book)).otherwise(named)
    return found.withColumn("codebooks_sha256", named), books
