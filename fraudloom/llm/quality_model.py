"""Quality classifier as a sparse rule ensemble.

A forest of shallow trees is grown on text statistics; every path from a root to
a node becomes a rule, a conjunction of bounds on statistics. A logistic
regression with lasso penalty weighs the rules (each an indicator of 0 or 1) and
keeps few. The kept rules are compiled into one Spark column expression, so
scoring is a projection of the statistics.

Labels of a document are averaged and rounded up at one half; null labels do not
count. If no labels, or labels of one kind only, are there to learn from, every
score is the share of label 1 (0.5 without labels). Null and empty texts have
all statistics at zero and are scored like any other; repeated rows get equal
scores; a null doc_id counts as not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import slices, stored
from fraudloom.llm.textstats import Text

STATISTICS = {
    "words": lambda t, n: t.n_words,
    "word_length": lambda t, n: t.word_chars / n,
    "symbols": lambda t, n: t.n_symbols / n,
    "copied_lines": lambda t, n: t.n_dup_lines / max(1, t.lines[0]),
    "repeated": lambda t, n: t.n_repeat_words / n,
    "capitals": lambda t, n: t.count("upper") / max(1, t.count("upper") + t.count("lower")),
    "bangs": lambda t, n: t.count("bang") / n,
    "ends": lambda t, n: t.count("stop") / n,
    "digits": lambda t, n: t.count("digit") / n,
    "distinct": lambda t, n: t.n_distinct / n,
    "longest": lambda t, n: t.longest_word,
    "line_words": lambda t, n: t.n_words / max(1, t.lines[0]),
}


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one double per statistic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [Text(text) for text in batch.column("text").to_pylist()]
            columns = [
                pa.array([float(make(t, max(1, t.n_words))) for t in texts], pa.float64())
                for make in STATISTICS.values()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *STATISTICS])

    schema = "doc_id bigint, " + ", ".join(f"{name} double" for name in STATISTICS)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


@dataclass(frozen=True, order=True)
class Bounds:
    """A rule: every named statistic lies above ``low`` and at most at ``high``."""

    terms: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, low, high in self.terms:
            if low != float("-inf"):
                holds = holds & (F.col(name) > low)
            if high != float("inf"):
                holds = holds & (F.col(name) <= high)
        return holds.cast("double")


def tree_rules(forest) -> list[Bounds]:
    """The distinct paths of all trees, each as one conjunction."""
    names, found = list(STATISTICS), set()

    def walk(node, bounds: dict[str, tuple[float, float]]):
        if bounds:
            found.add(Bounds(tuple((n, *bounds[n]) for n in sorted(bounds))))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = names[split.featureIndex()], float(split.threshold())
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        walk(node.leftChild(), {**bounds, name: (low, min(high, at))})
        walk(node.rightChild(), {**bounds, name: (max(low, at), high)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return sorted(found)


def learn(train: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002) -> Column:
    """The score as a column over the statistics; ``train`` has them and ``label`` (0.0 or 1.0)."""
    share = train.agg(F.avg("label")).first()[0]
    if share is None:
        return F.lit(0.5)
    if share in (0.0, 1.0):
        return F.lit(share)
    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(train)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, seed=8, subsamplingRate=0.7, minInstancesPerNode=3,
    ).fit(assembled.select("features", "label"))
    rules = tree_rules(forest)
    if not rules:
        return F.lit(share)
    indicators = train.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=50).fit(indicators)
    weighted = F.lit(float(lasso.intercept))
    for rule, weight in zip(rules, lasso.coefficients.toArray()):
        if weight:
            weighted = weighted + rule.column() * float(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-weighted))


def held_out_part() -> Column:
    """0 to 4, from the doc_id as text; part 0 is never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``."""
    measured = stored(statistics(docs), "statistics")
    known = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label"))
    train = stored(measured.where(held_out_part() != 0).join(known, "doc_id"), "labelled")
    score = learn(train)
    return measured.select(
        "doc_id", (F.col("doc_id").isNotNull() & (held_out_part() == 0)).alias("held_out"), score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
