"""Quality rules as a short-circuit cascade.

Each rule looks at a few measures of a text and rejects it or not; a text is
kept if no rule rejects it. Before the run every rule is timed and counted on a
sample, and the rules are ordered by rejections per second: cheap rules that
reject much come first, and a rejected text meets no further rule, so the
measures of later rules are never computed for it. The order changes the work,
not the verdict.

Null and empty texts have no words and are rejected. Repeated rows get equal
verdicts; ``keep`` passes all columns of kept rows through unchanged.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import slices
from fraudloom.llm.textstats import Text


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


# Limits in whole per cent, so that every engine decides alike.
BASE_RULES = (
    Rule("short", lambda t: t.n_words < 50),
    Rule("repeats", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda t: 100 * t.n_symbols > 30 * t.n_words),
    Rule("copied lines", lambda t: 100 * t.n_dup_lines > 60 * t.lines[0]),
    Rule("capitals", lambda t: 100 * t.count("upper") > 50 * (t.count("upper") + t.count("lower"))),
    Rule("sentence ends", lambda t: t.count("stop") > t.n_words),
    Rule("word length", lambda t: t.word_chars > 40 * t.n_words or t.word_chars < 2 * t.n_words),
)
SAMPLE_ROWS = 2_000


def ordered_by_yield(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejections per second on about ``sample_rows`` rows."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen += 1
                for i, rule in enumerate(rules):
                    fresh = Text(text)
                    began = time.perf_counter()
                    rejected[i] += rule.rejects(fresh)
                    spent[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "spent": spent, "rejected": rejected},
                                         pa.schema([("rule", pa.int32()), ("spent", pa.float64()), ("rejected", pa.int64())]))

    total = docs.count()
    if not total:
        return rules
    sample = docs.select("text").sample(min(1.0, sample_rows / total), seed=9)
    figures = sample.mapInArrow(measure, "rule int, spent double, rejected bigint").groupBy("rule").agg(
        F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected")).collect()
    worth = {row.rule: (row.rejected + 0.5) / (row.spent + 1e-6) for row in figures}
    return tuple(rules[i] for i in sorted(range(len(rules)), key=lambda i: -worth.get(i, 0.0)))


def passes(text: Text, rules: tuple[Rule, ...]) -> bool:
    return not any(rule.rejects(text) for rule in rules)


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    cascade = ordered_by_yield(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [passes(Text(text), cascade) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Base measures, ``base_failed`` and the cascade's verdict ``kept`` of every row."""
    cascade = ordered_by_yield(docs, rules)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [Text(text) for text in batch.column("text").to_pylist()]
            kept = [passes(text, cascade) for text in texts]
            failed = [not passes(text, BASE_RULES) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([getattr(t, n) for t in texts], pa.int64()) for n in names),
                 pa.array(failed, pa.bool_()), pa.array([k and not f for k, f in zip(kept, failed)], pa.bool_())],
                ["doc_id", *names, "base_failed", "kept"])

    schema = f"doc_id bigint, {', '.join(f'{n} bigint' for n in names)}, base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
