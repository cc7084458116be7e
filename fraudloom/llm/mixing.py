"""Mixing sources to target weights by subset sums.

Sources share a budget of words by weight. A source's target may be several
times what it has up to a limit, so whole copies are taken first; the rest of
its budget is a subset-sum problem over documents of known length. It is solved
on counts of documents per exact length: most of the budget goes to all lengths
in proportion, what remains (a few document lengths) is filled by a bounded
knapsack over the lengths still left, so the words taken meet the target exactly
wherever the lengths allow it. Which documents of a length are taken is decided
by a seeded hash.

A source's part of the problem is its table of lengths, never its documents.
Documents of a length are ranked in hash buckets of about ``bucket_rows`` rows,
so a length or source that holds a third of all rows is not ranked in one task.

Null texts have size 0. A null source is a source of its own and comes last.
Repeated rows are documents of their own. Only ``doc_id``, ``source`` and
``text`` are read by ``plan_mix``; ``mix`` passes the columns of ``docs`` through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.llm.common import stored, whole_text

WEIGHTS = (5.0, 2.0, 1.0)


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words between ASCII blanks) and a seeded hash per row."""
    words = F.regexp_count(whole_text(), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words.cast("bigint").alias("size"), F.xxhash64(whole_text()).alias("text_key"))


def targets(lengths: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target``: the budget shared by weight, no target above its limit.

    The excess of limited sources goes to the others by weight until none is
    above. One row per source; each step is one aggregate.
    """
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # Sources are few against documents; their rank gives the weight.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    sources = stored(sources.withColumn("weight", pick), "sources")
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    most = F.col("source_size") * limit
    level = 0.0
    while True:
        limited = F.col("weight") * level > most
        row = sources.agg(
            F.sum(F.when(limited, most)).alias("taken"), F.sum(F.when(~limited, F.col("weight"))).alias("open")).first()
        if not row.open:
            break
        found = (total - (row.taken or 0.0)) / row.open
        if found <= level:
            break
        level = found
    return sources.select("source", "source_size", F.least(most, F.col("weight") * level).alias("target"))


def fill(sizes_: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come nearest to ``budget`` from below.

    Proportional part first, then the longest lengths that fit, then a bounded
    knapsack over what is left below one longest document.
    """
    sizes_, counts = sizes_.astype(np.int64), counts.astype(np.int64)
    take = np.zeros(len(sizes_), np.int64)
    held = int((sizes_ * counts).sum())
    budget = min(int(budget), held)
    if budget <= 0 or held == 0:
        return take
    if budget == held:
        return counts.copy()
    # Whole-number arithmetic: products may pass 63 bits.
    take = np.array([int(c) * budget // held for c in counts], np.int64)
    rest = budget - int((sizes_ * take).sum())
    longest = int(sizes_.max())
    for i in np.argsort(-sizes_, kind="stable"):
        if rest <= longest:
            break
        if sizes_[i]:
            more = min(int(counts[i] - take[i]), (rest - longest) // int(sizes_[i]) + 1, rest // int(sizes_[i]))
            take[i] += max(0, more)
            rest -= max(0, more) * int(sizes_[i])
    # Reachable sums as bits; for each sum the item that reached it first.
    reach, mask = 1, (1 << (rest + 1)) - 1
    first = np.full(rest + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for i in np.argsort(-sizes_, kind="stable"):
        left, pack = int(counts[i] - take[i]), 1
        while left > 0 and sizes_[i] and not reach >> rest & 1:
            some = min(pack, left)
            width = some * int(sizes_[i])
            left, pack = left - some, pack * 2
            if width > rest:
                break
            fresh = (reach << width) & mask & ~reach
            if fresh:
                bits = np.unpackbits(np.frombuffer(fresh.to_bytes(rest // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits)] = len(items)
                items.append((int(i), some))
                reach |= fresh
    best = reach.bit_length() - 1
    while best > 0:
        i, some = items[int(first[best])]
        take[i] += some
        best -= some * int(sizes_[i])
    return take


def _fill_source(group: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths: copies everyone gets, and how many get one more."""
    group = group.sort_values("size", kind="stable")
    source_size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    whole = int(target // source_size) if source_size else 0
    extra = fill(group["size"].to_numpy(), group["n"].to_numpy(), round(target - whole * source_size))
    return group.assign(copies=whole, extra=extra)[
        ["source", "size", "n", "source_size", "target", "copies", "extra"]]


def plan_mix(docs: DataFrame, seed: int = 6, bucket_rows: int = 1_000, **shares) -> DataFrame:
    """``doc_id, source, size, text_key, source_size, target, copies`` (times the mix takes it) per row."""
    sized = stored(sizes(docs), "sizes")
    lengths = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    goal = targets(lengths, **shares)
    with_goal = lengths.join(goal, lengths["source"].eqNullSafe(goal["source"])).select(
        lengths["source"], "size", "n", "source_size", "target")
    plan = stored(
        with_goal.groupBy("source").applyInPandas(
            _fill_source, "source string, size bigint, n bigint, source_size bigint, target double, copies int, extra bigint"),
        "mix-plan")

    # Hash buckets within a length; every bucket gets its own number to take.
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_key"), F.lit(1 << 52)).alias("draw")
    named = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "source_size", "target", "copies", "extra")
    dealt = stored(
        sized.join(named, sized["source"].eqNullSafe(named["p_source"]) & (sized["size"] == named["p_size"]))
        .select("doc_id", "source", "size", "text_key", "n", "source_size", "target", "copies", "extra", draw)
        .withColumn("bucket", F.expr(f"draw div (({1 << 52} + n div {bucket_rows}) div (n div {bucket_rows} + 1) + 1)")),
        "dealt")
    # Rows in earlier buckets, in two levels: no task orders all buckets of one length.
    held = dealt.groupBy("source", "size", F.expr("bucket div 1024").alias("shelf"), "bucket").agg(
        F.count(F.lit(1)).alias("held"), F.first("extra").alias("extra"))
    earlier = (Window.unboundedPreceding, -1)
    shelf_order = Window.partitionBy("source", "size").orderBy("shelf").rowsBetween(*earlier)
    shelves = held.groupBy("source", "size", "shelf").agg(F.sum("held").alias("on_shelf")).select(
        F.col("source").alias("s_source"), F.col("size").alias("s_size"), F.col("shelf").alias("s_shelf"),
        F.coalesce(F.sum("on_shelf").over(shelf_order), F.lit(0)).alias("opening"))
    in_order = Window.partitionBy("source", "size", "shelf").orderBy("bucket").rowsBetween(*earlier)
    buckets = (
        held.withColumn("inside", F.coalesce(F.sum("held").over(in_order), F.lit(0)))
        .join(shelves, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("size") == F.col("s_size"))
              & (F.col("shelf") == F.col("s_shelf")))
        .withColumn("before", F.col("opening") + F.col("inside"))
        .select(F.col("source").alias("b_source"), F.col("size").alias("b_size"), F.col("bucket").alias("b_bucket"),
                F.greatest(F.lit(0), F.least("held", F.col("extra") - F.col("before"))).alias("take"))
    )
    ranked = dealt.withColumn(
        "rank", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw", "doc_id", "text_key")))
    taken = ranked.join(
        buckets,
        ranked["source"].eqNullSafe(buckets["b_source"]) & (ranked["size"] == buckets["b_size"])
        & (ranked["bucket"] == buckets["b_bucket"]))
    return taken.select(
        "doc_id", "source", "size", "text_key", "source_size", "target",
        (F.col("copies") + (F.col("rank") <= F.col("take")).cast("int")).alias("copies"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    plan = plan_mix(docs, **settings)
    marked = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("m_doc"),
        F.col("source").cast("string").alias("m_source"), F.xxhash64(whole_text()).alias("m_text"))
    totals = plan.groupBy(
        F.col("doc_id").alias("t_doc"), F.col("source").alias("t_source"), F.col("text_key").alias("t_text")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))
    joined = marked.join(
        totals.where("copies > 0"),
        F.col("m_doc").eqNullSafe(F.col("t_doc")) & F.col("m_source").eqNullSafe(F.col("t_source"))
        & (F.col("m_text") == F.col("t_text")))
    # Rows equal in doc_id, source and text share what their group takes.
    twins = Window.partitionBy("m_doc", "m_source", "m_text").orderBy("copies")
    single = joined.where("rows = 1").select("row", F.col("copies").alias("times"))
    several = joined.where("rows > 1").withColumn("at", F.row_number().over(twins)).select(
        "row", F.expr("copies div rows + cast(at <= copies % rows as int)").alias("times")).where("times > 0")
    copies = single.unionByName(several)
    return copies.select("row", F.explode(F.expr("sequence(1, cast(times as int))")).alias("copy")).select("row.*")
