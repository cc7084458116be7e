"""Token-id files with Elias-Fano document boundaries.

A segment file holds the ids of consecutive documents, one after the other, and
behind them two Elias-Fano sequences: the document boundaries (cumulative id
counts) and the document ids. A sequence of n numbers up to u takes about
2 + log2(u / n) bits a number; ``select`` finds entry i from a sampled position
of 32 bits and a scan of less than one sample step, so no table of 64-bit
offsets is stored, and none is made in reading: ``span`` selects one document's
offsets, ``documents``, which the query uses, goes through both sequences from
sample to sample, 256 entries at a time.

Layout (little endian): magic, ids (16 bits each if the vocabulary allows, else
32), boundaries, document ids, footer, footer length is fixed.

Documents are dealt to shards by ranges of doc_id, sorted there and written in
segments of about ``segment_ids`` ids, so neither a task nor a reader holds more
than one segment plus one document. A doc_id that fills several ranges is dealt
to them by hash, and so are null doc_ids to shards of their own: neither meets in
one task. Files appear by rename; a repeated task writes the same files again.

Null doc_ids come first, in segments without document ids. Null and empty texts
give the end id alone, texts of any length are encoded whole. Rows that repeat a
doc_id are all written, in any order. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyarrow import compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudloom.llm.common import AtomicFile, binary_array, open_fs, shuffle_partitions, slices, stored, take_runs
from fraudloom.session import work_dir

MAGIC = b"FLTOKEN1"
_FOOTER = struct.Struct("<QQQQqBB6x8s")
_SAMPLE = 256
MAX_SHARDS = 4096


class EliasFano:
    """A non-decreasing sequence of numbers >= 0 in near-minimal space."""

    _HEAD = struct.Struct("<QBxxxIII")

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples
        self._high = np.frombuffer(high, np.uint8)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = bytearray()
        if low_bits:
            weights = np.arange(low_bits, dtype=np.uint64)
            for at in range(0, n, 8_192):  # a multiple of 8 numbers fills whole bytes
                some = values[at:at + 8_192]
                low += np.packbits(((some[:, None] >> weights) & np.uint64(1)).astype(np.uint8)).tobytes()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, bytes(low), np.packbits(bits).tobytes(), ones[::_SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = self._HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, low, high, samples = cls._HEAD.unpack_from(data)
        at = cls._HEAD.size
        return cls(n, low_bits, data[at:at + low], data[at + low:at + low + high],
                   np.frombuffer(data, "<u4", samples, at + low + high))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        begin, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low[begin // 8:-(-end // 8)], np.uint8))
        bits = bits[begin % 8:begin % 8 + end - begin].reshape(-1, self.low_bits).astype(np.uint64)
        return (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def _ones(self, block: int) -> np.ndarray:
        """Positions of the ones from a sample on, up to the next sample."""
        start = int(self.samples[block])
        stop = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self._high) * 8
        bits = np.unpackbits(self._high[start // 8:-(-stop // 8)])
        return np.flatnonzero(bits[start % 8:start % 8 + stop - start]) + start

    def select(self, i: int) -> int:
        """Entry ``i``."""
        one = int(self._ones(i // _SAMPLE)[i % _SAMPLE])
        return (one - i) << self.low_bits | int(self._low(i, i + 1)[0])

    def runs(self) -> Iterator[np.ndarray]:
        """All entries in order, from one sample to the next at a time."""
        for block in range(len(self.samples)):
            first, last = block * _SAMPLE, min(self.n, (block + 1) * _SAMPLE)
            high = self._ones(block)[:last - first] - np.arange(first, last)
            yield (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(first, last)

    def __iter__(self) -> Iterator[int]:
        for run in self.runs():
            yield from run.tolist()


class SegmentWriter:
    """One file: ids are streamed, boundaries and document ids follow at the end."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width
        self.file = AtomicFile(path)
        self.file.write(MAGIC)
        self.ends, self.docs, self.n_ids = [0], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.file.write(ids)
        self.n_ids += len(ids) // self.width
        self.ends.append(self.n_ids)
        self.docs.append(doc_id)

    def close(self) -> dict:
        named = bool(self.docs) and self.docs[0] is not None
        base = self.docs[0] if named else 0
        ends = EliasFano.build(np.array(self.ends, np.uint64)).to_bytes()
        docs = EliasFano.build(np.array([d - base for d in self.docs] if named else [], np.uint64)).to_bytes()
        self.file.write(ends)
        self.file.write(docs)
        self.file.write(_FOOTER.pack(len(self.docs), self.n_ids, len(ends), len(docs), base, self.width, named, MAGIC))
        self.file.close()
        return {"path": self.path, "n_docs": len(self.docs), "n_ids": self.n_ids}


class SegmentReader:
    """Documents of one file; only the two sequences and what is asked for are read."""

    def __init__(self, path: str):
        fs, name = open_fs(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        self.n_docs, self.n_ids, ends, docs, self.base, self.width, self.named, magic = _FOOTER.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        at = len(MAGIC) + self.n_ids * self.width
        self.ends = EliasFano.from_bytes(self.file.read_at(ends, at))
        self.doc_ids = EliasFano.from_bytes(self.file.read_at(docs, at + ends))

    def span(self, i: int) -> tuple[int, int]:
        """First id of document ``i`` and the one behind its last, by select."""
        return self.ends.select(i), self.ends.select(i + 1)

    def ids(self, first: int, last: int) -> np.ndarray:
        data = self.file.read_at((last - first) * self.width, len(MAGIC) + first * self.width)
        return np.frombuffer(data, f"<u{self.width}")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, first id and ids of all documents in order."""
        ends = iter(self.ends)
        names = iter(self.doc_ids) if self.named else None
        first = next(ends, 0)
        held_from, held = 0, self.ids(0, 0)
        for last in ends:
            if last > held_from + len(held):
                held_from, held = first, self.ids(first, max(last, min(self.n_ids, first + (1 << 18))))
            name = None if names is None else next(names) + self.base
            yield name, first, held[first - held_from:last - held_from]
            first = last


class ChunkEncoder:
    """The library's ids of whole texts, by their distinct chunks.

    The pattern of the library drops white space and no token runs across it, so
    texts are cut at blanks and line ends. Chunks of ASCII and Latin letters are
    lower-cased and cut further into the pattern's matches; the library encodes
    each distinct piece, and any other chunk as it is. Ids of pieces are remembered
    up to a number of them and then all forgotten.
    """

    # Chunks of these characters only are lower-cased and cut the same by any version of the
    # library: no apostrophe (contractions), no angle brackets (special tokens), no blank,
    # no U+0130 (two characters in lower case).
    _PLAIN = "^[!-&(-;=?-~\u00a1-\u012f\u0131-\u024f]+$"
    _PIECES = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")

    def __init__(self, tokenizer: Tokenizer, width: int, remember: int = 600_000):
        self.tokenizer, self.remember = tokenizer, remember
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.ends_word = np.zeros(tokenizer.get_vocab_size(), bool)
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.ends_word[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, self.kind), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        made = [e.ids for at in range(0, len(texts), 4_096)
                for e in self.tokenizer.encode_batch_fast(texts[at:at + 4_096], add_special_tokens=False)]
        return [np.array(ids, self.kind) for ids in made], list(map(len, made))

    def _joined(self, pieces: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Plain pieces, many in one text: each ends with the one token that marks a word's end."""
        found, sizes = [], []
        for at in range(0, len(pieces), 512):
            some = pieces[at:at + 512]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, self.kind)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            more = ([ids], np.diff(ends, prepend=0).tolist()) if len(ends) == len(some) else self._library(some)
            found += more[0]
            sizes += more[1]
        return found, sizes

    def _numbers(self, names: list[str], plain: bool) -> np.ndarray:
        """Numbers of remembered ids of pieces (or of whole chunks, which are told apart from pieces by a blank)."""
        keys = names if plain else [" " + name for name in names]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if new:
            found, sizes = (self._joined if plain else self._library)([names[i] for i in new])
            for i in new:
                self.known[keys[i]] = len(self.known)
            self.ids = np.concatenate([self.ids, *found])
            self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
        return np.array(list(map(self.known.__getitem__, keys)), np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        chunks = split.flatten().dictionary_encode()
        names = chunks.dictionary
        if len(self.known) > self.remember:
            self._forget()
        plain = pc.match_substring_regex(names, self._PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        some = np.flatnonzero(plain)
        lower = "\n".join(names.filter(pa.array(plain)).to_pylist()).lower()
        pieces = pa.array(self._PIECES.findall(lower), pa.string())
        between = pc.equal(pieces, "\n").to_numpy(zero_copy_only=False).astype(bool)
        distinct = pieces.filter(pa.array(~between)).dictionary_encode()
        numbers = self._numbers(distinct.dictionary.to_pylist(), True)[distinct.indices.to_numpy()]
        owners = some[np.cumsum(between)[~between]] if len(some) else some
        others = np.flatnonzero(~plain)
        whole = self._numbers(names.take(pa.array(others)).to_pylist(), False)
        owners, numbers = np.concatenate([owners, others]), np.concatenate([numbers, whole])
        order = np.argsort(owners, kind="stable")
        ids, ends = take_runs(self.ids, np.cumsum(self.sizes), numbers[order].astype(np.int32))
        chunk_ends = np.concatenate([[0], ends])[np.cumsum(np.bincount(owners, minlength=len(names)))]
        ids, ends = take_runs(ids, chunk_ends, chunks.indices.to_numpy())
        return ids, np.concatenate([[0], ends])[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]


@lru_cache(maxsize=2)
def _chunk_encoder(path: str, width: int) -> ChunkEncoder:
    return ChunkEncoder(Tokenizer.from_file(path), width)


def _shard_bounds(docs: DataFrame, shards: int) -> list[int]:
    """Values of doc_id that cut the table into ``shards`` about equal parts; one that fills several is there again."""
    shares = [i / shards for i in range(1, shards)]
    row = docs.select(F.percentile_approx("doc_id", shares, 10 * MAX_SHARDS).alias("b")).first()
    return sorted(row.b or [])


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
    segment_ids: int = 1 << 22,
) -> DataFrame:
    """Encode ``docs``, write segment files in ascending doc_id order, return their manifest.

    Manifest: ``path``, ``shard``, ``segment``, ``n_docs``, ``n_ids`` and ``start``
    (ids in all files before it).
    """
    assert sys.byteorder == "little"
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "tokens")
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    partitions = shuffle_partitions(spark)
    bounds = np.array(_shard_bounds(docs, min(MAX_SHARDS, 4 * max(2, partitions))), np.int64)

    unnamed = partitions  # shards of null doc_ids, ahead of all others

    def shard_of(doc_id: int | None, ids: bytes) -> int:
        spread = xxhash.xxh3_64_intdigest(ids)
        if doc_id is None:
            return spread % unnamed
        least, most = (int(np.searchsorted(bounds, doc_id, side)) for side in ("left", "right"))
        # Shards between two bounds of this id hold nothing else.
        return unnamed + (most if most - least < 2 else least + spread % (most - least + 1))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        encoder = _chunk_encoder(tokenizer_path, width)
        for batch in slices(batches):
            names = batch.column("doc_id").to_pylist()
            ids, ends = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            made = binary_array(ids, ends * width)
            shards = [shard_of(name, data) for name, data in zip(names, made.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int32()), pa.array(names, pa.int64()), made], ["shard", "doc_id", "ids"])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard, segment, done = None, None, 0, []

        def close():
            done.append({**writer.close(), "shard": shard, "segment": segment})

        for batch in slices(batches, "ids"):
            for row in batch.to_pylist():
                if writer and (row["shard"] != shard or writer.n_ids >= segment_ids):
                    close()
                    segment = segment + 1 if row["shard"] == shard else 0
                    writer = None
                if writer is None:
                    shard = row["shard"]
                    writer = SegmentWriter(f"{folder}/{shard:06d}-{segment:06d}.tok", width)
                writer.add(row["doc_id"], row["ids"])
        if writer:
            close()
        yield pa.RecordBatch.from_pylist(done, pa.schema([
            ("path", pa.string()), ("shard", pa.int32()), ("segment", pa.int32()),
            ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    made = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(encoded, "shard int, doc_id bigint, ids binary")
        .repartition(partitions, "shard")
        .sortWithinPartitions("shard", "doc_id", "ids")
        .mapInArrow(written, "path string, shard int, segment int, n_docs bigint, n_ids bigint")
    )
    files = stored(made, "manifest")
    # One row per shard (at most MAX_SHARDS and those of null ids), then the segments within each shard.
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (
        files.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(shards, "shard")
        .select("path", "shard", "segment", "n_docs", "n_ids", (F.col("shard_start") + F.col("inside")).alias("start"))
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of all files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                rows = [
                    (name, start + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for name, first, ids in SegmentReader(path).documents()
                ]
                for at in range(0, len(rows), 10_000):
                    names, starts, counts, sums = zip(*rows[at:at + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int64()), pa.array(starts, pa.int64()),
                         pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = shuffle_partitions(manifest.sparkSession)
    return manifest.repartition(tasks).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
