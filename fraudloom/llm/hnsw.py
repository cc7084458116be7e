"""Embedding near-duplicates by navigable small-world graphs per shard.

Vectors are dealt to shards by hash; each shard becomes one graph of layers in
which near vectors are neighbours, built in blocks with numpy and written to the
shared folder. The vectors of every shard then ask every shard: the search goes down
the layers and keeps a beam of the best vectors seen. Two things widen it. An
audit on a fixed random set of questions compares each shard's answers with a
full scan and doubles the shard's beam until questions find on average ``recall``
of their links to other vectors, judged apart by number of links (1, 2 to 3, 4 to
7, ...), so that neither large groups nor a question's match with itself hide
what isolated pairs lose. If few questions have few links, made ones that link
with a vector of the shard are judged too. And a question whose whole beam links is
asked again with a doubled beam, or, where a scan of the shard costs less than that,
answered by a scan; every question goes through the graph first. Links are verified
by cosine in double precision. A task takes two shards and both directions between
them, so that a link found from one end counts for both. It returns link counts and
a spanning forest of its links, not the pairs; components are joined over all tasks.

Equal vectors are one entry of their shard with a count. Vectors that are null,
empty, zero, or hold null or non-finite components link with nothing. Vectors of
different length never link. Repeated rows count as vectors of their own; a
null vec_id is never the smallest of a component that has another.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import AtomicFile, open_fs, shuffle_partitions, stored
from fraudloom.llm.components import components
from fraudloom.session import work_dir

SHARD_BYTES = 128 << 20  # of a shard's vectors in double precision; a task holds two shards
MIN_SHARDS = 4
SCAN_SHARE = 1 / 64  # a widened beam that would hold this share of a shard gives way to a scan (1: the whole shard)
AUDIT_ROWS = 2_048
AUDIT_LINKED = 100  # questions with few links that are enough to tell a recall of 0.99
_BLOCK = 256


class Graph:
    """Layered neighbour graph over unit vectors; nodes of a layer come first in the order."""

    def __init__(self, unit: np.ndarray, links: int = 16, width: int = 48, seed: int = 2):
        self.x = np.ascontiguousarray(unit, np.float32)
        n = len(self.x)
        draws = np.random.default_rng(seed).random(n)
        levels = np.sort((-np.log(1.0 - draws) / math.log(links)).astype(np.int64))[::-1]
        self.links, self.width = links, width
        self.layers = [
            np.full((int((levels >= level).sum()), links * (1 if level else 2)), -1, np.int32)
            for level in range(int(levels[0]) + 1 if n else 1)
        ]
        done = 0
        while done < n:
            step = min(n - done, max(1, min(1_024, done)))
            self._insert(done, done + step)
            done += step

    def search(self, questions: np.ndarray, beam: int, layer: int, entry: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes below number ``limit`` for each question: ids (-1: none) and cosines."""
        nodes, q, near = self.layers[layer], len(questions), self.x
        row = np.arange(q)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -np.inf, np.float32)
        ids[:, 0], sims[:, 0] = entry, np.einsum("ij,ij->i", near[entry], questions)
        open_ = np.zeros((q, beam), bool)
        open_[:, 0] = True
        seen = np.zeros((q, limit), bool)
        seen[row, entry] = True
        active = row
        while len(active):
            score = np.where(open_[active], sims[active], -np.inf)
            at = score.argmax(axis=1)
            alive = score[np.arange(len(active)), at] > -np.inf
            active, at = active[alive], at[alive]
            if not len(active):
                break
            open_[active, at] = False
            found = nodes[ids[active, at]].astype(np.int64)
            valid = (found >= 0) & (found < limit)
            found[~valid] = 0
            valid &= ~seen[active[:, None], found]
            asked, places = np.nonzero(valid)  # padding stands for node 0 and must not unmark it
            seen[active[asked], found[asked, places]] = True
            got = np.einsum("ikj,ij->ik", near[found], questions[active])
            got[~valid] = -np.inf
            better = got.max(axis=1) > sims[active].min(axis=1)
            rows = active[better]
            if len(rows):
                all_sims = np.concatenate([sims[rows], got[better]], axis=1)
                best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
                pick = np.arange(len(rows))[:, None]
                all_ids = np.concatenate([ids[rows], np.where(valid[better], found[better], -1)], axis=1)
                all_open = np.concatenate([open_[rows], valid[better]], axis=1)
                ids[rows], sims[rows], open_[rows] = all_ids[pick, best], all_sims[pick, best], all_open[pick, best]
        return ids, sims

    def descend(self, questions: np.ndarray, to_layer: int, limit: int) -> np.ndarray:
        """Entry points for ``to_layer``: greedy steps through the layers above."""
        entry = np.zeros(len(questions), np.int64)
        for layer in range(len(self.layers) - 1, to_layer, -1):
            ids, sims = self.search(questions, 4, layer, entry, min(limit, len(self.layers[layer])))
            entry = ids[np.arange(len(ids)), sims.argmax(axis=1)]
        return entry

    def ask(self, questions: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        questions = np.ascontiguousarray(questions, np.float32)
        n = len(self.x)
        return self.search(questions, min(beam, n), 0, self.descend(questions, 0, n), n)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Up to ``keep`` candidates per row, first those nearer to the row than to any chosen one."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        valid = np.isfinite(sims)
        vectors = self.x[np.where(valid, ids, 0)]
        between = np.einsum("ikd,ild->ikl", vectors, vectors)
        chosen = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            blocked = ((between[:, k, :] >= sims[:, k:k + 1]) & chosen).any(axis=1)
            chosen[:, k] = valid[:, k] & ~blocked & (chosen.sum(axis=1) < keep)
        rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :keep]
        out = np.take_along_axis(np.where(valid, ids, -1), rank, 1)
        if out.shape[1] < keep:
            out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
        return out

    def _insert(self, first: int, last: int) -> None:
        new = self.x[first:last]
        for layer, nodes in enumerate(self.layers):
            stop = min(last, len(nodes))
            if stop <= first:
                break
            mine, held = new[:stop - first], min(first, len(nodes))
            own = mine @ mine.T
            np.fill_diagonal(own, -np.inf)
            few = min(self.width // 2, len(mine))
            top = np.argpartition(-own, few - 1, axis=1)[:, :few]
            ids, sims = top + first, np.take_along_axis(own, top, 1)
            if held:
                for at in range(0, len(mine), _BLOCK):
                    some = mine[at:at + _BLOCK]
                    entry = self.descend(some, layer, held)
                    old_ids, old_sims = self.search(some, min(self.width, held), layer, entry, held)
                    if not at:
                        before = [(old_ids, old_sims)]
                    else:
                        before.append((old_ids, old_sims))
                ids = np.concatenate([np.concatenate([b[0] for b in before]), ids], axis=1)
                sims = np.concatenate([np.concatenate([b[1] for b in before]), sims], axis=1)
            for at in range(0, len(mine), _BLOCK):
                part = slice(at, at + _BLOCK)
                nodes[first + at:first + at + len(mine[part]), :self.links] = self._diverse(ids[part], sims[part], self.links)
            self._link_back(nodes, first, stop)

    def _link_back(self, nodes: np.ndarray, first: int, last: int) -> None:
        source = np.repeat(np.arange(first, last), self.links)
        target = nodes[first:last, :self.links].ravel().astype(np.int64)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        begins = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[begins, len(target)])
        width = nodes.shape[1]
        for at in range(0, len(begins), _BLOCK):
            chunk, count = begins[at:at + _BLOCK], counts[at:at + _BLOCK]
            most = min(int(count.max()), 4 * width)
            place = chunk[:, None] + np.arange(most)
            there = np.arange(most) < count[:, None]
            came = np.where(there, source[np.minimum(place, len(source) - 1)], -1)
            owner = target[chunk]
            ids = np.concatenate([nodes[owner].astype(np.int64), came], axis=1)
            ids[:, width:][(came[:, :, None] == nodes[owner][:, None, :]).any(axis=2)] = -1
            sims = np.einsum("ikd,id->ik", self.x[np.maximum(ids, 0)], self.x[owner])
            sims[ids < 0] = -np.inf
            if ids.shape[1] > 3 * width:
                best = np.argpartition(-sims, 3 * width - 1, axis=1)[:, :3 * width]
                ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
            nodes[owner] = self._diverse(ids, sims, width)


class Shard:
    """A graph with the keys, copies and double-precision vectors of its nodes."""

    def __init__(self, keys: np.ndarray, copies: np.ndarray, unit: np.ndarray, graph: Graph | None = None,
                 scan_share: float = SCAN_SHARE):
        # Order is random as keys are hashes; nodes of upper layers come first.
        self.keys, self.copies, self.unit = keys, copies, unit
        self.graph = graph or Graph(unit)
        self.scan_share = scan_share

    def save(self, path: str) -> None:
        held = io.BytesIO()
        layers = {f"layer{i}": layer for i, layer in enumerate(self.graph.layers)}
        np.savez(held, keys=self.keys, copies=self.copies, unit=self.unit, **layers)
        file = AtomicFile(path)
        file.write(held.getvalue())
        file.close()

    @classmethod
    def load(cls, path: str, scan_share: float = SCAN_SHARE) -> Shard:
        fs, name = open_fs(path)
        with fs.open_input_file(name) as file, np.load(file) as held:
            graph, unit = Graph.__new__(Graph), held["unit"]
            graph.x = unit.astype(np.float32)
            graph.layers = [held[f"layer{i}"] for i in range(sum(n.startswith("layer") for n in held.files))]
            return cls(held["keys"], held["copies"], unit, graph, scan_share)

    def scan(self, questions: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Question and node numbers of all links, by comparing with every node in blocks."""
        step = max(1, (1 << 22) // max(1, len(self.unit)))
        for at in range(0, len(questions), step):
            rows, nodes = np.nonzero(questions[at:at + step] @ self.unit.T >= least)
            yield rows + at, nodes

    def asked(self, questions: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Question and node numbers of the links the graph finds, and questions left to a scan.

        Links are verified in double precision; a question left to a scan has none here.
        """
        none = np.zeros(0, np.int64)
        for at in range(0, len(questions), _BLOCK):
            waiting, wide = np.arange(at, min(len(questions), at + _BLOCK)), beam
            while len(waiting):
                if wide >= len(self.unit) or wide > beam and wide >= self.scan_share * len(self.unit):
                    yield none, none, waiting
                    break
                ids, sims = self.graph.ask(questions[waiting], wide)
                full = (sims >= least - 1e-5).all(axis=1)  # there may be more
                rows, places = np.nonzero((sims >= least - 1e-5) & ~full[:, None])
                # Each node once per question: links are counted.
                rows, nodes = np.divmod(np.unique(rows * len(self.unit) + ids[rows, places]), len(self.unit))
                sure = np.einsum("ij,ij->i", questions[waiting[rows]], self.unit[nodes]) >= least
                yield waiting[rows[sure]], nodes[sure], none
                waiting, wide = waiting[full], wide * 2

    def links(self, questions: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Question and node numbers of the links that the graph or, for wide beams, a scan finds."""
        for rows, nodes, dense in self.asked(questions, least, beam):
            yield rows, nodes
            for rows, nodes in self.scan(questions[dense], least):
                yield dense[rows], nodes

    def _counts(self, answers: Iterator[tuple[np.ndarray, np.ndarray]], asked: int, own: np.ndarray | None) -> np.ndarray:
        """Number of distinct nodes that each of ``asked`` questions got, without the one of its own key."""
        counts = np.zeros(asked, np.int64)
        for rows, nodes in answers:
            rows, nodes = np.divmod(np.unique(rows * len(self.unit) + nodes), len(self.unit))
            if own is not None:
                rows = rows[self.keys[nodes] != own[rows]]
            counts += np.bincount(rows, minlength=asked)
        return counts

    def made_questions(self, least: float, most: int = 256) -> np.ndarray:
        """Vectors whose cosine with a random node lies between ``least`` and 1."""
        rnd = np.random.default_rng(3)
        x = self.unit[rnd.choice(len(self.unit), min(most, len(self.unit)), replace=False)]
        aside = rnd.normal(size=x.shape)
        aside -= (aside * x).sum(axis=1, keepdims=True) * x
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
        cosine = least + (1 - least) * rnd.uniform(1e-6, 1, (len(x), 1))
        made = cosine * x + np.sqrt(np.maximum(0, 1 - cosine * cosine)) * aside
        return made / np.linalg.norm(made, axis=1, keepdims=True)

    def recalls(self, questions: np.ndarray, own: np.ndarray | None, true: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Mean share of a question's links that is found, for each class of number of links in ``true``."""
        some = np.flatnonzero(true)
        found = self._counts(
            self.links(questions[some], least, beam), len(some), None if own is None else own[some])
        classes = np.log2(true[some]).astype(np.int64)
        held = np.bincount(classes)
        return np.bincount(classes, weights=found / true[some])[held > 0] / held[held > 0]

    def audited_beam(self, questions: np.ndarray, least: float, recall: float, beam: int = 16,
                     own: np.ndarray | None = None) -> int:
        """The smallest doubling of ``beam`` that finds ``recall`` of the links of ``questions`` in each class.

        ``own`` has the keys of the questions: matches with themselves do not count.
        """
        sets = [(questions, own)]
        true = [self._counts(self.scan(questions, least), len(questions), own)]
        if ((true[0] > 0) & (true[0] < beam)).sum() < AUDIT_LINKED:
            made = self.made_questions(least)
            sets.append((made, None))
            true.append(self._counts(self.scan(made, least), len(made), None))
        while beam < len(self.unit):
            if all((self.recalls(*asked, held, least, beam) >= recall).all() for asked, held in zip(sets, true)):
                break
            beam *= 2
        return beam


def prepared(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``key`` (hash of the vector, null if it can link with nothing), ``dim``, ``unit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, units = [], [], []
            for value in batch.column("embedding").to_pylist():
                good = None
                if value and None not in value:
                    made = np.array(value, np.float64)
                    size = np.abs(made).max()
                    if np.isfinite(size) and size > 0:
                        made = made / size  # keeps very large and small lengths in range
                        good = made / np.sqrt(made @ made)
                keys.append(None if good is None else xxhash.xxh3_128_digest((np.array(value, np.float64) + 0.0).tobytes()))
                dims.append(0 if good is None else len(good))
                units.append(None if good is None else good.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                ["vec_id", "key", "dim", "unit"])

    columns = [F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")]
    return vectors.select(*columns).mapInArrow(run, "vec_id bigint, key binary, dim int, unit binary")


def _matrix(units, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(-1, dim)


def build_shards(entries: DataFrame, total: int, size: int, least: float, recall: float, min_shards: int = MIN_SHARDS,
                 scan_share: float = SCAN_SHARE) -> list[tuple[str, int, int]]:
    """Build, audit and write all graphs; returns path, dimension and beam of each."""
    spark = entries.sparkSession
    shards = max(min_shards, math.ceil(size / SHARD_BYTES))
    folder = work_dir(spark, "graphs")
    some = entries.where(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(max(1, total // AUDIT_ROWS))) == 0)
    audit = spark.sparkContext.broadcast([(r.dim, bytes(r.unit), bytes(r.key)) for r in some.select("dim", "unit", "key").collect()])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        dim, number = int(group["dim"].iloc[0]), int(group["shard"].iloc[0])
        group = group.sort_values("key")
        keys = np.frombuffer(b"".join(group["key"]), "V16")
        shard = Shard(keys, group["copies"].to_numpy(np.int64), _matrix(group["unit"], dim), scan_share=scan_share)
        asked = [(unit, key) for d, unit, key in audit.value if d == dim]
        own = np.frombuffer(b"".join(key for _, key in asked), "V16")
        beam = shard.audited_beam(_matrix([unit for unit, _ in asked], dim), least, recall, own=own)
        path = f"{folder}/{dim}-{number:05d}.npz"
        shard.save(path)
        return pd.DataFrame({"path": [path], "dim": [dim], "beam": [beam]})

    dealt = entries.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    dealt = dealt.repartition(max(shards, shuffle_partitions(spark)), "dim", "shard")
    made = stored(dealt.groupBy("dim", "shard").applyInPandas(build, "path string, dim int, beam int"), "graph-list")
    return [(r.path, r.dim, r.beam) for r in made.orderBy("path").collect()]  # one row per shard


class _Forest:
    """Union-find over numbers, many pairs at a time; a parent is never larger than its child."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
                self.parent = up
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def joint_links(s: Shard, t: Shard, least: float, beams: tuple[int, int],
                most: int = 1 << 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors linked to each node of ``s`` in ``t`` and of ``t`` in ``s``, and roots over the nodes of both.

    A link counts at both ends if the search from either finds it. Pairs are held
    only for nodes that no scan answers; with ``most`` pairs held, scans answer
    the rest. ``s`` may be ``t``: the second counts are zero then.
    """
    same, n, offset = s is t, len(t.unit), 0 if s is t else len(s.unit)
    forest = _Forest(offset + n)
    held, exact = [np.zeros(0, np.int64)], []
    for shard, asking, beam in ((t, s, beams[1]), (s, t, beams[0]))[:1 if same else 2]:
        scanned, room = np.zeros(len(asking.unit), bool), most
        for at in range(0, len(scanned), _BLOCK):
            if room <= 0:
                scanned[at:] = True
                break
            for rows, nodes, dense in shard.asked(asking.unit[at:at + _BLOCK], least, beam):
                scanned[at + dense] = True
                held.append((rows + at) * n + nodes if asking is s else nodes * n + rows + at)
                room -= len(rows)
        exact.append(scanned)
    exact_s, exact_t = exact[0], exact[-1]
    found = np.unique(np.concatenate(held))
    held = [found]
    counts = [np.zeros(len(s.unit), np.int64), np.zeros(n, np.int64)]

    def add(side: int, at: np.ndarray, copies: np.ndarray) -> None:
        counts[side] += np.bincount(at, copies, len(counts[side])).astype(np.int64)

    for side in range(1 if same else 2):
        asking, shard = ((s, t), (t, s))[side]
        some = np.flatnonzero((exact_s, exact_t)[side])
        for rows, nodes in shard.scan(asking.unit[some], least):
            rows = some[rows]
            if same:
                rows, nodes = rows[rows != nodes], nodes[rows != nodes]
            add(side, rows, shard.copies[nodes])
            i, j = (nodes, rows) if side else (rows, nodes)
            forest.join(i, j + offset)
            # The other end hears of it, unless a scan answers that too.
            told = ~(exact_s if side else exact_t)[nodes]
            codes = i[told] * n + j[told]
            at = np.minimum(np.searchsorted(found, codes), max(0, len(found) - 1))
            held.append(codes[found[at] != codes] if len(found) else codes)
    found = np.unique(np.concatenate(held))
    i, j = np.divmod(found, n)
    if same:
        i, j = np.divmod(np.unique(np.concatenate([found, j * n + i])), n)
        i, j = i[i != j], j[i != j]
    forest.join(i, j + offset)
    add(0, i[~exact_s[i]], t.copies[j[~exact_s[i]]])
    if not same:
        add(1, j[~exact_t[j]], s.copies[i[~exact_t[j]]])
    return counts[0], counts[1], forest.parent[forest.parent]


def find_links(entries: DataFrame, graphs: list[tuple[str, int, int]], total: int, least: float, block: int = 16_384,
               scan_share: float = SCAN_SHARE) -> DataFrame:
    """``key``, ``n`` (vectors linked in one shard) and ``root``, one key of the same component."""
    spark = entries.sparkSession
    known = spark.sparkContext.broadcast(graphs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, second in zip(batch.column("first").to_pylist(), batch.column("second").to_pylist()):
                (path, dim, beam), (other, width, other_beam) = known.value[first], known.value[second]
                if dim != width:
                    continue
                s = Shard.load(path, scan_share)
                t = s if first == second else Shard.load(other, scan_share)
                n_s, n_t, root = joint_links(s, t, least, (beam, other_beam))
                keys, n = (s.keys, n_s) if s is t else (np.concatenate([s.keys, t.keys]), np.concatenate([n_s, n_t]))
                linked = np.flatnonzero(n)
                for at in range(0, len(linked), 50_000):
                    some = linked[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[some].tolist(), pa.binary()), pa.array(n[some], pa.int64()),
                         pa.array(keys[root[some]].tolist(), pa.binary())], ["key", "n", "root"])

    last = len(graphs) - 1
    pairs = spark.range(len(graphs)).select(
        F.col("id").alias("first"), F.explode(F.sequence("id", F.lit(last).cast("bigint"))).alias("second"))
    tasks = max(1, min(len(graphs) * (last + 2) // 2, max(shuffle_partitions(spark), math.ceil(total / block))))
    return pairs.repartition(tasks).mapInArrow(run, "key binary, n bigint, root binary")


def near_vectors(vectors: DataFrame, least: float = 0.95, recall: float = 0.99, min_shards: int = MIN_SHARDS,
                 scan_share: float = SCAN_SHARE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``."""
    rows = stored(prepared(vectors), "vectors")
    entries = stored(
        rows.where("key is not null").groupBy("key").agg(
            F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"),
            F.first("unit").alias("unit")),
        "vector-entries")
    held = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("dim") * F.lit(8).cast("bigint")).alias("bytes")).first()
    total = held.n
    graphs = build_shards(entries, total, held.bytes or 0, least, recall, min_shards, scan_share)
    found = stored(find_links(entries, graphs, total, least, scan_share=scan_share), "vector-links")
    linked = found.groupBy("key").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = (
        entries.select("key", "first", "copies").join(linked, "key", "left")
        .join(groups.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "key").alias("component"))
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(smallest, "component").select("key", "n_links", "component_id")
    out = rows.select("vec_id", "key").join(classes, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
