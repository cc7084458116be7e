"""Hard-negative mining by inner products over cover trees.

Candidates get one more component that makes all norms equal, sqrt(M^2 - |x|^2);
with a zero there, a question's inner product with a candidate then depends on
their distance alone. A shard's candidates form a cover tree: the points of a node
of level i lie within base^i of its centre, and centres of its children are more
than their own level's radius apart. From a node's measured radius follow bounds of all inner products
below it (an angle on the sphere of radius M). A search takes nodes by their upper
bound, best first, skips those whose bounds lie outside all windows it still has
room in, and computes the inner products of leaves exactly, in integers.

Rows are dealt to shards by hash, trees are written to the shared folder, and
anchors go over them in blocks: a task takes one block and some of the shards, one
after the other, and keeps the best finds so far, which narrow the next search.
First every anchor finds its positives, then the negatives in each positive's
window; finds of different tasks meet per anchor. No limit or sample is involved:
results are exact and do not depend on the number of shards.

A row without vec_id or label, or whose vector is null or holds a null or
non-finite component (or is 2^31 or longer in integers), takes no part. Vectors of
different lengths never meet. Rows are told apart even if equal: a repeated anchor
is answered for each of its rows, and finds the other one. Equal scores are ordered
by vec_id. An anchor without positives gives no rows. Only ``vec_id``, ``label``
and ``embedding`` are read; a table without rows gives none.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.common import AtomicFile, floored, open_fs, shuffle_partitions, stored
from fraudloom.session import work_dir

SHARD_BYTES = 32 << 20  # of a shard's vectors in double precision
BLOCK_ANCHORS = 4_096
_LEAF = 48
_BASE = 1.3
_PAD = 1e-6  # radians added to every angle, far above the error of computing it
_EXACT = float(1 << 53)
_ALL = 1 << 62


class Best:
    """The first ``k`` finds of one window: higher scores first, then smaller ids, then smaller rows."""

    def __init__(self, k: int, low: int = -_ALL, high: int = _ALL):
        self.k, self.low, self.high = k, low, high
        self.floor = low  # what a find must reach to get in
        none = np.zeros(0, np.int64)
        self.scores, self.ids, self.rows = none, none, none

    def offer(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        some = np.flatnonzero((scores >= self.floor) & (scores <= self.high))
        if not len(some):
            return
        if len(some) > 4 * self.k:
            least = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= least]
        scores = np.concatenate([self.scores, scores[some]])
        ids, rows = np.concatenate([self.ids, ids[some]]), np.concatenate([self.rows, rows[some]])
        order = np.lexsort((rows, ids, -scores))[:self.k]
        self.scores, self.ids, self.rows = scores[order], ids[order], rows[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


class CoverTree:
    """Points in the order of the tree. A node has points of its own (a leaf's, or children of one point) and child nodes."""

    # Arrays over nodes: first and last own point, first and last child, level, angle that covers all its points.
    NODES = ("points_from", "points_to", "child_from", "child_to", "level", "angle")

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.rows, self.x = ids, labels, rows, np.asarray(x, np.float64)
        squares = np.einsum("ij,ij->i", self.x, self.x)
        self.norm = float(np.sqrt(squares.max())) if len(x) else 0.0
        extra = np.sqrt(np.maximum(0.0, self.norm**2 - squares))
        self._build(np.column_stack([self.x, extra]))

    def _build(self, lifted: np.ndarray) -> None:
        order, centres = [], []
        nodes: dict[str, list] = {name: [] for name in self.NODES}

        def add(points: np.ndarray, level: int, angle: float) -> int:
            centres.append(points[0] if len(points) else 0)
            for name, value in zip(self.NODES, (0, 0, 0, 0, level, angle)):
                nodes[name].append(value)
            return len(centres) - 1

        everything = np.arange(len(lifted))
        open_nodes = [(add(everything, 0, math.pi), everything)]
        placed = 0
        while open_nodes:
            node, points = open_nodes.pop()
            own, children = points, []
            reach = self._distances(lifted, points).max() if len(points) > _LEAF else 0.0
            if reach > _PAD * self.norm:
                level = math.ceil(math.log(reach, _BASE)) - 1  # the highest that splits the node
                groups = self._net(lifted, points, _BASE**level)
                own = np.array([g[0] for g in groups if len(g) == 1], np.int64)
                children = [g for g in groups if len(g) > 1]
            nodes["points_from"][node], nodes["points_to"][node] = placed, placed + len(own)
            order.append(own)
            placed += len(own)
            nodes["child_from"][node] = len(centres)
            for group in children:
                angle = 2 * math.asin(min(1.0, self._distances(lifted, group).max() / (2 * self.norm)))
                open_nodes.append((add(group, level, angle), group))
            nodes["child_to"][node] = len(centres)
        at = np.concatenate(order)
        self.centres = self.x[np.array(centres)] if len(self.x) else self.x
        self.ids, self.labels, self.rows, self.x = self.ids[at], self.labels[at], self.rows[at], self.x[at]
        for name, values in nodes.items():
            setattr(self, name, np.array(values, np.float64 if name == "angle" else np.int64))

    def _distances(self, lifted: np.ndarray, points: np.ndarray) -> np.ndarray:
        """From the first point to all."""
        off = lifted[points] - lifted[points[0]]
        return np.sqrt(np.einsum("ij,ij->i", off, off))

    def _net(self, lifted: np.ndarray, points: np.ndarray, radius: float, block: int = 256) -> list[np.ndarray]:
        """Groups within ``radius`` of their first points, which are further than that apart.

        Every point goes to the first centre that reaches it; an uncovered point becomes a centre.
        """
        near_from = self.norm**2 - radius * radius / 2  # distance as an inner product on the sphere
        rest, members, numbers, groups = points, [], [], 0
        while len(rest):
            few = rest[:block]
            near = lifted[few] @ lifted[rest].T >= near_from
            near[np.arange(len(few)), np.arange(len(few))] = True
            covered, centres = np.zeros(len(few), bool), []
            for i in range(len(few)):
                if not covered[i]:
                    centres.append(i)
                    covered |= near[i, :len(few)]
            near = near[centres]
            taken = near.any(axis=0)
            members.append(rest[taken])
            numbers.append(near.argmax(axis=0)[taken] + groups)
            groups += len(centres)
            rest = rest[~taken]
        members, numbers = np.concatenate(members), np.concatenate(numbers)
        order = np.argsort(numbers, kind="stable")  # a centre stays ahead of its group
        return np.split(members[order], np.flatnonzero(np.diff(numbers[order])) + 1)

    def _scores(self, points: slice, question: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.x[points] @ question).astype(np.int64)
        return self.x[points].astype(np.int64) @ question.astype(np.int64)

    def search(self, question: np.ndarray, label: int, same: bool, but_row: int, windows: list[Best]) -> None:
        """Offer the points of the same (or another) label to ``windows``."""
        length = float(np.sqrt(question @ question))
        scale = length * self.norm
        exact = scale < _EXACT
        heap = [(-math.inf, 0, -math.inf)]
        while heap:
            upper, node, lower = heapq.heappop(heap)
            if -upper < min(b.floor for b in windows):
                break
            if not any(lower <= b.high and -upper >= b.floor for b in windows):
                continue
            first, last = self.points_from[node], self.points_to[node]
            if last > first:
                right = self.labels[first:last] == label if same else self.labels[first:last] != label
                if same:
                    right &= self.rows[first:last] != but_row
                scores = self._scores(slice(first, last), question, exact)[right]
                ids, rows = self.ids[first:last][right], self.rows[first:last][right]
                for best in windows:
                    best.offer(scores, ids, rows)
            children = slice(self.child_from[node], self.child_to[node])
            if children.stop > children.start:
                cosine = self.centres[children] @ question / scale if scale else np.zeros(children.stop - children.start)
                at, cover = np.arccos(np.clip(cosine, -1, 1)), self.angle[children] + _PAD
                uppers = scale * np.cos(np.maximum(0, at - cover)) + 1e-9 * scale
                lowers = scale * np.cos(np.minimum(math.pi, at + cover)) - 1e-9 * scale
                wanted = np.zeros(len(uppers), bool)
                for best in windows:
                    wanted |= (lowers <= best.high) & (uppers >= best.floor)
                for i in np.flatnonzero(wanted).tolist():
                    heapq.heappush(heap, (-uppers[i], children.start + i, lowers[i]))

    def save(self, path: str) -> None:
        held = io.BytesIO()
        nodes = {name: getattr(self, name) for name in self.NODES}
        np.savez(held, ids=self.ids, labels=self.labels, rows=self.rows, x=self.x.astype(np.int32),
                 centres=self.centres.astype(np.int32), norm=self.norm, **nodes)
        file = AtomicFile(path)
        file.write(held.getvalue())
        file.close()

    @classmethod
    def load(cls, path: str) -> CoverTree:
        fs, name = open_fs(path)
        tree = cls.__new__(cls)
        with fs.open_input_file(name) as file, np.load(file) as held:
            for key in ("ids", "labels", "rows", *cls.NODES):
                setattr(tree, key, held[key])
            tree.x, tree.centres = held["x"].astype(np.float64), held["centres"].astype(np.float64)
            tree.norm = float(held["norm"])
        return tree


def _matrix(values, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dim).astype(np.float64)


def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """``row`` (a number of its own), ``vec_id``, ``label``, ``dim``, ``v`` of the rows that take part; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, binary, usable = floored(batch.column("embedding"), scale, 1 << 31)
            long = [float(np.square(np.frombuffer(v, "<i4").astype(np.float64)).sum()) for v in binary.to_pylist()]
            usable &= np.array(long) < float(1 << 62)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), binary],
                ["vec_id", "label", "dim", "v"]).filter(pa.array(usable))

    named = vectors.where("vec_id is not null and label is not null").select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<double>"))
    made = named.mapInArrow(run, "vec_id bigint, label bigint, dim int, v binary")
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "candidates")


def build_trees(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[tuple[str, int]]:
    """Write one tree per shard; path and vector length of each (one row per shard comes to the driver)."""
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("dim") * 8).alias("bytes")).first()
    # As many as fit; small tables still make work for several tasks.
    shards = max(1, math.ceil((size.bytes or 0) / shard_bytes), min(shuffle_partitions(spark), math.ceil(size.n / 2_048)))
    folder = work_dir(spark, "trees")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        dim, number = int(group["dim"].iloc[0]), int(group["shard"].iloc[0])
        group = group.sort_values("row")
        columns = (group[c].to_numpy(np.int64) for c in ("vec_id", "label", "row"))
        path = f"{folder}/{dim}-{number:06d}.npz"
        CoverTree(*columns, _matrix(group["v"], dim)).save(path)
        return pd.DataFrame({"path": [path], "dim": [dim]})

    # Dealt to a fixed number of tasks: adaptive execution would put small shards into one.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).repartition(
        max(shards, shuffle_partitions(spark)), "dim", "shard")
    made = stored(dealt.groupBy("dim", "shard").applyInPandas(build, "path string, dim int"), "tree-list")
    return [(r.path, r.dim) for r in made.orderBy("path").collect()]


def ask(anchors: DataFrame, trees: list[tuple[str, int]], total: int, same: bool, k: int,
        percent: tuple[int, int] | None = None, block: int = BLOCK_ANCHORS) -> DataFrame:
    """Finds of all ``anchors`` (row, vec_id, label, dim, v, ``of_ids``, ``of_scores``) in all trees.

    For each entry of ``of_scores`` the first ``k`` rows of the same or another
    label, with scores within ``percent`` of that entry if given.
    """
    spark = anchors.sparkSession
    known = spark.sparkContext.broadcast(trees)
    blocks = max(1, math.ceil(total / block))
    parts = max(1, min(len(trees), math.ceil(shuffle_partitions(spark) / blocks)))

    def window(score: int) -> Best:
        if percent is None:
            return Best(k)
        return Best(k, -(-percent[0] * score // 100), percent[1] * score // 100)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        dim, part = int(group["dim"].iloc[0]), int(group["part"].iloc[0])
        questions = _matrix(group["v"], dim)
        windows = [[window(int(s)) for s in scores] for scores in group["of_scores"]]
        labels, rows = group["label"].tolist(), group["row"].tolist()
        for path, width in known.value[part::parts]:
            if width != dim:
                continue
            tree = CoverTree.load(path)
            for at, question in enumerate(questions):
                some = [b for b in windows[at] if b.floor <= b.high]
                if some:
                    tree.search(question, labels[at], same, rows[at], some)
        out = []
        for at, (anchor, ids, scores) in enumerate(zip(group["vec_id"], group["of_ids"], group["of_scores"])):
            for place, best in enumerate(windows[at]):
                out += [(rows[at], anchor, place, ids[place], scores[place], *found)
                        for found in zip(best.scores.tolist(), best.ids.tolist(), best.rows.tolist())]
        return pd.DataFrame(out, columns=["row", "anchor_id", "place", "of_id", "of_score", "score", "found_id", "found_row"])

    dealt = (
        anchors.withColumn("block", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(blocks)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        .repartition(max(blocks * parts, shuffle_partitions(spark)), "dim", "block", "part")
    )
    found = dealt.groupBy("dim", "block", "part").applyInPandas(
        run, "row bigint, anchor_id bigint, place int, of_id bigint, of_score bigint, score bigint, "
             "found_id bigint, found_row bigint")
    # At most k rows of each part meet here.
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "found_id", "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   percent: tuple[int, int] = (30, 90), scale: int = 256, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    Anchors are the rows that take part and meet ``is_anchor`` (over vec_id and
    label). Positives are an anchor's first rows of its label, negatives the first
    rows of other labels whose scores are within ``percent`` of the positive's.
    """
    rows = integer_rows(vectors, scale)
    trees = build_trees(rows, shard_bytes)
    anchors = stored(rows.where(is_anchor), "anchors")
    total = anchors.count()
    whole = anchors.withColumns({
        "of_ids": F.array(F.lit(0).cast("bigint")), "of_scores": F.array(F.lit(0).cast("bigint"))})
    first = ask(whole, trees, total, same=True, k=positives)
    chosen = first.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "found_id", "score"))).alias("held"))  # at most `positives`
    paired = stored(
        anchors.join(chosen, "row").withColumns({"of_ids": F.col("held.found_id"), "of_scores": F.col("held.score")})
        .drop("held"), "anchors-with-positives")
    found = ask(paired, trees, total, same=False, k=negatives, percent=percent)
    return found.select(
        "anchor_id", F.col("of_id").alias("positive_id"), F.col("rank").cast("int"), F.col("found_id").alias("negative_id"),
        F.col("of_score").alias("positive_score"), F.col("score").alias("negative_score"))
