"""Corpus preparation: quality rules, line dedup, near-duplicates, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept;
``run`` writes and rereads every result. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudloom.llm import linededup, mixing, quality_rules, simhash
from fraudloom.llm.common import stored
from fraudloom.llm.queries import encoded_digests
from fraudloom.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines; n_chars follows the new text."""
    shorter = linededup.dedup_lines(docs.select(*COLUMNS))
    return shorter.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: of its smallest doc_id (null last), any text of that doc_id in the group."""
    # 128 bits of the whole row, nulls told from empty values.
    told = [*(F.col(c).isNull() for c in COLUMNS), *COLUMNS]
    rows = docs.select(*COLUMNS).withColumns({"h1": F.xxhash64(*told), "h2": F.xxhash64(F.lit(1), *told)})
    found = simhash.near_duplicates(rows, keys=("h1", "h2"))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h1", "h2"))
    first = found.groupBy("component").agg(smallest.alias("row")).select("row.h1", "row.h2")
    # Rows equal in all columns are still there: combined in the tasks.
    return rows.join(first, ["h1", "h2"], "left_semi").select(*COLUMNS).distinct()


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often (0 to 2 times) as the mix takes them."""
    return mixing.mix(docs.select(*COLUMNS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded bytes of every row."""
    return encoded_digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("source mix", source_mix),
    ("byte-level bpe", token_ids),
]

# Rank merging, seeded XXH64 and the knapsack's choice are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
