"""Token counts without ids.

1. Every distinct pre-token of the corpus is found with its number of
   occurrences (combined in the tasks, then by key).
2. The library counts the pieces of each distinct pre-token once; the counts
   are a written table.
3. Documents are turned into pre-token frequencies and joined to that table.
   The most frequent pre-tokens (at most ``frequent`` of them, of at most 64 bytes
   each, a bound that does not grow) are joined inside the tasks from a broadcast map; all others go
   through a shuffle join on the pre-token. Sums per document
   give the counts.

Strings of special tokens are pre-tokens of their own, as the library treats
them by default. Null texts count as empty (0 tokens). Rows repeated in the
input are repeated in the output, rows of equal doc_id are kept apart by text.
A null doc_id is kept. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudloom.llm.common import slices, stored, words_after_space

FREQUENT = 1 << 18
_REMEMBER = 300_000
_SHORT = 64  # bytes of a pre-token that may be sent to all tasks
_SETTLED = "\u0250"
_PATTERN = regex.compile(public_tokenizers.PATTERN)  # the pattern of byte-level pre-tokenizers


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    tokenizer = Tokenizer.from_file(path)
    special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
    return tokenizer, frozenset(special), cut


class _Splitter:
    """Pre-tokens of whole texts as the library cuts them.

    Chunks of Latin letters and ASCII are cut by the same pattern here; all others,
    where Unicode versions may differ, by the library itself.
    """

    def __init__(self, path: str):
        self.tokenizer, self.special, self.cut = _tokenizer(path)

    def chunk(self, text: str) -> tuple[str, ...]:
        spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return tuple(text[a:b] for _, (a, b) in spans)

    def after_space(self, part: str) -> list[str] | tuple[str, ...]:
        if not (part.isascii() or max(part) < _SETTLED):
            return self.chunk(" " + part)
        if part.isalpha():
            return (" " + part,)
        return _PATTERN.findall(" " + part)

    def parts(self, text: str) -> tuple[list[str], list[str]]:
        """Whole pre-tokens, and parts that a space precedes."""
        if self.cut is None or not self.cut.search(text):
            head, *rest = words_after_space(text)
            return [*(self.chunk(head) if head else ())], rest
        whole: list[str] = []
        rest: list[str] = []
        for segment in self.cut.split(text):
            if segment in self.special:
                whole.append(segment)
            elif segment:
                head, *more = words_after_space(segment)
                whole.extend(self.chunk(head) if head else ())
                rest.extend(more)
        return whole, rest


def pre_token_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Distinct pre-tokens: ``piece``, ``n`` occurrences, ``tokens`` of one occurrence."""
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(tokenizer_path)
        whole, after = Counter(), Counter()

        def flush():
            pieces = Counter(whole)
            for part, n in after.items():
                for piece in splitter.after_space(part):
                    pieces[piece] += n
            whole.clear()
            after.clear()
            names = list(pieces)
            for at in range(0, len(names), 50_000):
                some = names[at:at + 50_000]
                yield pa.RecordBatch.from_pydict({
                    "piece": pa.array(some, pa.string()), "n": pa.array([pieces[p] for p in some], pa.int64())})

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                first, rest = splitter.parts(text or "")
                whole.update(first)
                after.update(rest)
                if len(after) + len(whole) > _REMEMBER:
                    yield from flush()
        yield from flush()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _, _ = _tokenizer(tokenizer_path)
        for batch in slices(batches, "piece"):
            for at in range(0, batch.num_rows, 5_000):
                part = batch.slice(at, 5_000)
                made = tokenizer.encode_batch_fast(part.column("piece").to_pylist(), add_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column("piece"), part.column("n"), pa.array([len(e) for e in made], pa.int64())],
                    ["piece", "n", "tokens"])

    found = docs.select("text").mapInArrow(occurrences, "piece string, n bigint")
    distinct = found.groupBy("piece").agg(F.sum("n").alias("n"))
    return stored(distinct.mapInArrow(tokens, "piece string, n bigint, tokens bigint"), "pretokens")


def _least_frequent(table: DataFrame, most: int) -> float:
    """Occurrence class (16 per doubling) from which on at most ``most`` pre-tokens lie."""
    classes = table.groupBy(_occurrence_class().alias("c")).agg(F.count(F.lit(1)).alias("held")).collect()
    least, held = float("inf"), 0
    for row in sorted(classes, key=lambda r: -r.c):  # at most 16 * 63 rows
        held += row.held
        if held > most:
            break
        least = row.c
    return least


def _occurrence_class():
    return F.floor(F.log2("n") * 16)


def count_tokens(docs: DataFrame, tokenizer_path: str, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    table = pre_token_table(docs, tokenizer_path)
    is_frequent = (_occurrence_class() >= F.lit(_least_frequent(table, frequent))) & (
        F.octet_length("piece") <= _SHORT)
    few = table.where(is_frequent).select("piece", "tokens").toArrow().to_pydict()
    frequent_counts = spark.sparkContext.broadcast(dict(zip(few["piece"], few["tokens"])))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, count = _Splitter(tokenizer_path), frequent_counts.value
        known: dict[str, int] = {}  # tokens of parts all of whose pre-tokens are frequent
        for batch in slices(batches):
            docs_, keys, sizes, pieces, values = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = (text or "").encode()
                key = xxhash.xxh3_128_digest(data)
                whole, rest = splitter.parts(text or "")
                told = list(map(known.get, rest))
                sum_known = sum(filter(None, told))
                open_pieces = whole
                for part in [p for p, n in zip(rest, told) if n is None]:
                    cut = splitter.after_space(part)
                    numbers = [count.get(piece) for piece in cut]
                    if None in numbers:
                        open_pieces.extend(cut)
                    else:
                        sum_known += sum(numbers)
                        if len(part) <= 64 and len(known) < _REMEMBER:
                            known[part] = sum(numbers)
                rare = Counter()
                for piece in open_pieces:
                    n = count.get(piece)
                    if n is None:
                        rare[piece] += 1
                    else:
                        sum_known += n
                rows = 1 + len(rare)
                docs_ += [doc_id] * rows
                keys += [key] * rows
                sizes += [len(data)] * rows
                pieces += [None, *rare]
                values += [sum_known, *rare.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(pieces, pa.string()), pa.array(values, pa.int64())],
                ["doc_id", "text_key", "n_bytes", "piece", "value"])

    schema = "doc_id bigint, text_key binary, n_bytes bigint, piece string, value bigint"
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(frequencies, schema)
    # A row without a piece carries what is known already; it keeps its own key out of the join.
    rows = stored(rows, "frequencies")
    known = rows.where("piece is null").withColumn("tokens", F.col("value"))
    rare = (
        rows.where("piece is not null")
        .join(table.where(~is_frequent).select("piece", F.col("tokens").alias("each")), "piece")
        .withColumn("tokens", F.col("value") * F.col("each"))
    )
    columns = ["doc_id", "text_key", "n_bytes", "tokens", "own"]
    both = known.withColumn("own", F.lit(1)).select(columns).unionAll(
        rare.withColumn("own", F.lit(0)).select(columns))
    summed = both.groupBy("doc_id", "text_key", "n_bytes").agg(
        F.sum("tokens").alias("tokens"), F.sum("own").alias("copies"))
    # Repeated rows were summed together: divide, and repeat the result.
    return summed.select(
        "doc_id", "n_bytes", F.expr("tokens div copies").alias("n_tokens"),
        F.explode(F.expr("sequence(1, copies)")).alias("copy")).drop("copy")
