"""Idempotent micro-batch sinks, merged batch folders and payload delivery.

A table that a stream writes consists of one folder per batch. A replayed batch
overwrites its own folder, so a restart adds no duplicate. ``merge_batches``
folds finished batches into one folder and publishes a pointer to it; from then
on readers open that folder and the batches after it only.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudloom.sources.versions import Folder, Versions

DELIVERY = "payload_json string, n_rows int, delivered boolean, attempts int"


def batch_path(base: str, table: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/{table}/batch_id={batch_id}"


def write_batch(df: DataFrame, base: str, table: str, batch_id: int, fmt: str = "parquet") -> str:
    path = batch_path(base, table, batch_id)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def _versions(spark: SparkSession, base: str, table: str) -> Versions:
    return Versions(spark, f"{base.rstrip('/')}/{table}.versions")


def finished_batches(spark: SparkSession, base: str, table: str) -> list[int]:
    """Batches whose folders are complete, in order."""
    folder = Folder(spark, f"{base.rstrip('/')}/{table}")
    named = [n for n in folder.names() if n.startswith("batch_id=")]
    return sorted(int(n.split("=")[1]) for n in named if folder.holds(f"{n}/_SUCCESS"))


def read_batches(
    spark: SparkSession, base: str, table: str, fmt: str = "parquet", before: int | None = None,
    after: int | None = None, schema: str | None = None,
) -> DataFrame:
    """All batches of a table, with their number in ``batch_id``.

    ``before`` and ``after`` (both exclusive) leave batches out; with ``before`` a
    replayed batch reads what it read the first time. A table that holds nothing
    yet is an empty one if its ``schema`` is given.
    """
    versions, at = _versions(spark, base, table), f"{base.rstrip('/')}/{table}"
    newest = versions.newest()
    merged = versions.read(newest) if newest is not None else {"upto": -1, "folders": []}
    least = max(merged["upto"], -1 if after is None else after)
    wanted = [b for b in finished_batches(spark, base, table) if b > least and (before is None or b < before)]
    reader = spark.read.format(fmt).option("basePath", at)
    parts = []
    if wanted:
        df = (reader.schema(f"{schema}, batch_id string") if schema else reader).load(
            [batch_path(base, table, b) for b in wanted])
        parts.append(df.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if merged["folders"]:
        held = spark.read.parquet(*[path for path, _ in merged["folders"]])
        if after is not None:
            held = held.where(F.col("batch_id") > after)
        parts.append(held if before is None else held.where(F.col("batch_id") < before))
    if not parts:
        if schema is None:
            raise ValueError(f"{at} holds no batch")
        # Not from Python rows, which start workers: a filter that Spark folds to an empty table.
        nothing = F.from_json(F.lit(None).cast("string"), F.lit(f"{schema}, batch_id bigint"))
        return spark.range(1).select(nothing.alias("row")).select("row.*").where(F.lit(False))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_batches(
    spark: SparkSession, base: str, table: str, reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    fmt: str = "parquet", schema: str | None = None, fan_in: int | None = None,
) -> bool:
    """Fold all batches but the newest, which may still be replayed; False if there is nothing to do.

    ``reduce`` turns rows (with ``batch_id``) into those worth keeping, for instance
    the newest per key; it must keep ``batch_id``. Without ``fan_in`` the table
    becomes one folder, which suits tables whose size does not grow with time. With
    it only the new batches are written, and as soon as there are ``fan_in`` folders
    of one level they become one of the next: a row is written again once a level,
    and there are at most ``fan_in`` folders a level. ``reduce`` then sees the rows
    of the folders it joins.

    What the version before replaced is deleted now, so readers that began with it
    still find its files.
    """
    versions, done = _versions(spark, base, table), finished_batches(spark, base, table)
    newest = versions.newest()
    old = versions.read(newest) if newest is not None else {"upto": -1, "folders": [], "replaces": []}
    upto = max((b for b in done[:-1] if b > old["upto"]), default=None)
    if upto is None:
        return False
    number = 0 if newest is None else newest + 1
    replaced: list[str] = []

    def written(rows: DataFrame, level: int) -> list:
        path = f"{base.rstrip('/')}/{table}.merged/{number:010d}-{level}"
        reduce(rows).hint("rebalance").write.mode("overwrite").parquet(path)
        return [path, level]

    after = old["upto"] if fan_in else None
    folders = list(old["folders"]) if fan_in else []
    folders.append(written(read_batches(spark, base, table, fmt, before=upto + 1, after=after, schema=schema), 0))
    if not fan_in:
        replaced = [path for path, _ in old["folders"]]
    while fan_in and [level for _, level in folders].count(folders[-1][1]) >= fan_in:
        level = folders[-1][1]
        joined = [path for path, of in folders if of == level]
        folders = [f for f in folders if f[1] != level] + [written(spark.read.parquet(*joined), level + 1)]
        replaced += joined
    versions.publish(number, {"upto": upto, "folders": folders, "replaces": replaced})
    if newest is not None:
        forget_batches(spark, base, table, old["upto"])
        for path in old["replaces"]:
            Folder(spark, path).delete()
        versions.forget(newest)
    return True


def forget_batches(spark: SparkSession, base: str, table: str, upto: int) -> None:
    """Delete the folders of batches that nobody reads any more."""
    folder = Folder(spark, f"{base.rstrip('/')}/{table}")
    for batch in finished_batches(spark, base, table):
        if batch <= upto:
            folder.delete(f"batch_id={batch}")


def newest_rows(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the row of the last batch that wrote it, ``batch_id`` kept; cut down per task before the exchange."""
    last = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return batches.withColumn("_back", F.row_number().over(last)).where("_back = 1").drop("_back")


def latest_by_key(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert view: ``newest_rows`` without their batch."""
    return newest_rows(batches, keys).drop("batch_id")


# Seconds to wait before the second, third and fourth round.
PAUSES = (1.0, 2.0, 4.0)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Claims:
    """Names of payloads about to be sent, written to the shared folder before the first of them goes out.

    A payload that is claimed is never sent again, whatever became of the sender.
    """

    def __init__(self, path: str):
        self.fs, self.path = _open(path)
        self.fs.create_dir(self.path, recursive=True)

    def known(self, bucket: int) -> set[str]:
        prefix, names = f"{bucket:05d}-", set()
        for entry in self.fs.get_file_info(pafs.FileSelector(self.path)):
            if entry.base_name.startswith(prefix) and not entry.base_name.endswith(".tmp"):
                with self.fs.open_input_file(entry.path) as file:
                    names.update(file.read().decode().split("\n"))
        return names

    def add(self, bucket: int, names: list[str]) -> None:
        target = f"{self.path}/{bucket:05d}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(f"{target}.tmp") as file:
            file.write("\n".join(names).encode())
        self.fs.move(f"{target}.tmp", target)


def deliver(
    payloads: DataFrame,
    send: Callable[[str], int],
    pauses: tuple[float, ...] = PAUSES,
    claims: str | None = None,
    buckets: int = 64,
) -> DataFrame:
    """Send each payload; ``send`` returns a status code, 200 and 202 count as taken.

    A batch is sent in rounds: all payloads first, then after each pause those
    still open, so one pause serves all of them. What is open after the last round
    is given up. The result lists every payload with its outcome, so what was
    dropped stays on record.

    ``claims`` is a folder that makes delivery at most once over task retries and
    replays: payloads (told apart by their text and ``n_rows``-th repetition) are
    dealt to ``buckets``, and a task writes down what it is about to send before
    it does. What an earlier try claimed is listed as not delivered with 0 attempts:
    it may or may not have arrived.
    """
    def taken(payload: str) -> bool:
        try:
            return send(payload) in (200, 202)
        except Exception:  # any transport error counts as a failed try
            return False

    def rounds(batch: pd.DataFrame) -> pd.DataFrame:
        texts = batch["payload_json"].tolist()
        attempts, waiting = [0] * len(texts), list(range(len(texts)))
        for pause in (0.0, *pauses):
            if not waiting:
                break
            time.sleep(pause)
            for at in waiting:
                attempts[at] += 1
            waiting = [at for at in waiting if not taken(texts[at])]
        refused = set(waiting)
        return batch[["payload_json", "n_rows"]].assign(
            delivered=[at not in refused for at in range(len(texts))], attempts=attempts)

    def send_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rounds(batch)

    def send_once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, known = Claims(claims), {}
        for batch in batches:
            for bucket, some in batch.groupby("bucket"):
                if bucket not in known:
                    known[bucket] = held.known(bucket)
                claimed = some["name"].isin(known[bucket])
                yield some[claimed][["payload_json", "n_rows"]].assign(delivered=False, attempts=0)
                fresh = some[~claimed]
                if len(fresh):
                    held.add(bucket, fresh["name"].tolist())
                    yield rounds(fresh)

    if claims is None:
        return payloads.select("payload_json", "n_rows").mapInPandas(send_all, DELIVERY)
    name = F.concat_ws("-", F.xxhash64("payload_json"), F.xxhash64("payload_json", F.lit(1)), "copy")
    repeated = Window.partitionBy("payload_json").orderBy("n_rows")
    named = (
        payloads.select("payload_json", "n_rows").withColumn("copy", F.row_number().over(repeated))
        .select("payload_json", "n_rows", name.alias("name"),
                F.pmod(F.xxhash64("payload_json"), F.lit(buckets)).cast("int").alias("bucket"))
    )
    return named.repartition(buckets, "bucket").mapInPandas(send_once, DELIVERY)
