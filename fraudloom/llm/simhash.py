"""SimHash near-duplicates with chains of segments as filter.

A fingerprint has four segments of 16 bits on a ring. If two fingerprints differ
in at most 3 bits, then from some segment on every chain of l = 1, 2, 3, 4
segments differs in at most l * 3 / 4 bits: 0, 1, 2 and 3. So candidates are
pairs that agree in one segment and differ in at most one bit of the next: the
32 bits of these two segments are the join key, and one side also asks with each
bit of the second segment flipped. Candidates then have to keep the budgets of
the longer chains before the whole fingerprints are compared.

Documents are grouped by fingerprint first, so exact copies are one entry. In
the groups of a key, blocks of bounded size are compared and only a spanning
forest of what links is returned, not all pairs. Keys with more than
``hot_entries`` fingerprints are dealt over up to ``most_parts`` tasks, each with a
part of the asking side. Beyond that their join key takes in a third segment, of
which a question asks all values that differ in at most two bits: rows stay linear
in the fingerprints, and as these are distinct, no group has more than 2^16 entries.

Fingerprints: lower-case ASCII letters, words between ASCII blanks, shingles of
``width`` words joined by a space (fewer words: all of them), XXH64 with seed
42; a bit is set if it is set in more than half of the hashes. Texts without
words (also null) have fingerprint zero and link like any other. Repeated rows
share fingerprint and component; a null doc_id is a component member that never
is its smallest id unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import slices, stored
from fraudloom.llm.components import components

SEED = 42
BUDGET = 3
_CELLS = 1 << 20


def fingerprint(data: bytes, width: int = 3, block: int = 1 << 15) -> int:
    """Fingerprint of UTF-8 bytes; at most ``block`` hashes are held at once."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    width = min(width, len(words))
    ends = ends[width - 1:].tolist()
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ends)
    for at in range(0, n, block):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + block], ends[at:at + block])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed number) and ``keys`` (bigint columns) of every row."""
    names = ["doc_id", "fp", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [_signed(fingerprint((t or "").encode(), width)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.int64()), *(batch.column(k) for k in keys)], names)

    return docs.select(F.col("doc_id").cast("bigint"), "text", *keys).mapInArrow(
        run, ", ".join(f"{name} bigint" for name in names))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (probe false) and questions (probe true) of each fingerprint.

    Each fingerprint asks with the exact key too: its entry is the other side's.
    """
    flips = np.r_[0, 1 << np.arange(16)].astype(np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            fps = batch.slice(at, 2_000).column("fp").to_numpy().view(np.uint64)
            for turn in range(4):
                turned = _turn(fps, turn)
                pair = turned >> np.uint64(32)
                own = np.uint64(turn) << np.uint64(32) | pair
                asked = (own[:, None] ^ flips).ravel()
                keys = np.concatenate([own, asked]).view(np.int64)
                holders = np.concatenate([fps, np.repeat(fps, len(flips))]).view(np.int64)
                probe = np.r_[np.zeros(len(fps), bool), np.ones(len(asked), bool)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(holders), pa.array(probe)], ["key", "fp", "probe"])


def _turn(fps: np.ndarray, turn: int) -> np.ndarray:
    """The ring turned so that segment ``turn`` comes first."""
    shift = 16 * turn
    if not shift:
        return fps
    return fps << np.uint64(shift) | fps >> np.uint64(64 - shift)


def viable(differences: np.ndarray, turn: int, budget: int = BUDGET) -> np.ndarray:
    """Whether all chains from segment ``turn`` keep their share of the budget."""
    turned = _turn(differences, turn)
    keeps = np.ones(differences.shape, bool)
    for length in (1, 2, 3):
        chain = np.bitwise_count(turned >> np.uint64(64 - 16 * length))
        keeps &= chain * 4 <= length * budget
    return keeps


class _Forest:
    """Union-find over the fingerprints of one group."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        parent.setdefault(node, node)
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _compare(turn: int, held: np.ndarray, asking: np.ndarray, budget: int, out: list) -> None:
    forest = _Forest()
    step = max(1, _CELLS // max(1, len(held)))
    for at in range(0, len(asking), step):
        some = asking[at:at + step]
        apart = some[:, None] ^ held
        near = viable(apart, turn, budget)
        rows, columns = np.nonzero(near)
        close = (np.bitwise_count(apart[rows, columns]) <= budget) & (some[rows] != held[columns])
        for a, b in zip(some[rows[close]].tolist(), held[columns[close]].tolist()):
            if forest.join(a, b):
                out.append((_signed(a), _signed(b)))


def _link_groups(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key, part and probe: a group's entries, then its questions."""
        out: list[tuple[int, int]] = []
        group, held, asking = None, [], []

        def finish():
            if held and asking:
                entries = np.concatenate(held)
                questions = np.concatenate(asking)
                if len(entries) > 1 or len(questions) > 1:
                    _compare(int(group[0]) >> 32, entries, questions, budget, out)

        def made():
            nonlocal out
            rows, out = out, []
            a, b = (list(x) for x in zip(*rows)) if rows else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, parts = batch.column("key").to_numpy(), batch.column("part").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            probes = batch.column("probe").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])])
            ends = np.r_[starts[1:], len(keys)]
            # Most groups are a single row or have no entry: nothing to compare.
            for first, last in zip(starts.tolist(), ends.tolist()):
                here = (keys[first], parts[first])
                if here != group:
                    finish()
                    group, held, asking = here, [], []
                    if last - first == 1 and last < len(keys):
                        continue
                asked = probes[first:last]
                if not asked[0]:
                    held.append(fps[first:last][~asked])
                if asked[-1]:
                    asking.append(fps[first:last][asked])
            if len(out) > 50_000:
                yield made()
        finish()
        yield made()

    return run


def _third_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of very hot keys dealt by their third segment, questions by all values within two bits of it."""
    bits = 1 << np.arange(16)
    flips = np.unique(np.r_[0, (bits[:, None] | bits).ravel()]).astype(np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 10_000):
            some = batch.slice(at, 10_000)
            keys, fps = some.column("key").to_numpy(), some.column("fp").to_numpy().view(np.uint64)
            probes = some.column("probe").to_numpy(zero_copy_only=False).astype(bool)
            third = np.zeros(len(fps), np.uint64)
            for turn in range(4):
                here = keys >> 32 == turn
                third[here] = _turn(fps[here], turn) >> np.uint64(16) & np.uint64(0xFFFF)
            rows = np.r_[np.flatnonzero(~probes), np.repeat(np.flatnonzero(probes), len(flips))]
            parts = np.r_[third[~probes], (third[probes][:, None] ^ flips).ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[rows]), pa.array(fps[rows].view(np.int64)), pa.array(probes[rows]),
                 pa.array(parts.astype(np.int32))], ["key", "fp", "probe", "part"])


def link_fingerprints(
    distinct: DataFrame, budget: int = BUDGET, hot_entries: int = 4_096, most_parts: int = 64,
) -> DataFrame:
    """Edges ``a, b`` that connect all of ``distinct.fp`` within ``budget`` (at most 3) differing bits."""
    if budget > 3:
        raise ValueError("two 16-bit segments as key hold for at most 3 differing bits")
    rows = distinct.select("fp").mapInArrow(_keys, "key bigint, fp bigint, probe boolean")
    # Keys with very many entries: each of their parts gets all entries and a part of the questions.
    hot = (
        rows.where("not probe").groupBy("key").agg(F.count(F.lit(1)).alias("entries"))
        .where(F.col("entries") > hot_entries)
        .select("key", F.ceil(F.col("entries") / hot_entries).cast("int").alias("parts"))
    )
    hot = stored(hot, "hot-keys")
    marked = rows.join(hot, "key", "left")
    number = F.coalesce("parts", F.lit(1))
    dealt = marked.where(number <= most_parts).select(
        "key", "fp", "probe",
        F.explode(
            F.when(F.col("probe"), F.array(F.pmod(F.xxhash64("fp"), number).cast("int")))
            .otherwise(F.sequence(F.lit(0), number - 1))).alias("part"))
    if not hot.where(F.col("parts") > most_parts).isEmpty():
        deep = marked.where(number > most_parts).select("key", "fp", "probe")
        dealt = dealt.unionByName(deep.mapInArrow(_third_segments, "key bigint, fp bigint, probe boolean, part int"))
    grouped = dealt.repartition("key", "part").sortWithinPartitions("key", "part", "probe")
    return grouped.mapInArrow(_link_groups(budget), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = BUDGET, keys: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row of ``docs``.

    With ``keys`` (bigint columns that tell rows apart) also these and ``component``,
    a fingerprint, which unlike ``component_id`` is never null or shared by components.
    """
    marked = stored(fingerprints(docs, width, keys), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = components(link_fingerprints(classes, budget))
    # A component's id is the smallest doc_id of all its fingerprints.
    member = classes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = member.groupBy("component").agg(F.min("first").alias("component_id"))
    named = member.join(smallest, "component").select("fp", "component_id", "component")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id", *((*keys, "component") if keys else ()))
