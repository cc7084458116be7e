"""Trailing-window features on a stream, from a stored tail.

What a card's next events need of its past is a table: per distinct millisecond
of its last window the number, the large ones and the sum of its events, and per
month the time of its last event. A micro-batch joins the tails of its cards and
runs the batch operator over both, so a hot card is split there as in batches.
Then it writes the new tails of its cards. Nothing runs in Python workers and no
state store is involved; the tail is an ordinary batch table of ``sinks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.config import RuleConfig
from fraudloom.functions.times import year_month
from fraudloom.operators.trailing import large_amount, trailing_features

_CARD, _TS = "nameOrig", "ingestion_timestamp_ms"
_DAY_MS = 86_400_000

# month is null in rows of the window; in others ``at`` is the time of the month's last event.
STATE = "nameOrig string, month string, at bigint, n bigint, large bigint, amount decimal(22,2)"


def newest_state(stored: DataFrame) -> DataFrame:
    """Each card's rows of the last batch that wrote it, ``batch_id`` kept."""
    of_card = Window.partitionBy(_CARD)
    return stored.withColumn("_last", F.max("batch_id").over(of_card)).where("batch_id = _last").drop("_last")


def card_state(state: DataFrame) -> DataFrame:
    """One row per card: newest event and a map of months to last events."""
    return state.groupBy(_CARD).agg(
        F.max(F.when(F.col("month").isNull(), F.col("at"))).alias("_newest"),
        F.map_from_entries(F.collect_list(F.when(
            F.col("month").isNotNull(), F.struct(F.col("month"), F.col("at"))))).alias("_last_of_month"),
    )


def batch_features(
    tx: DataFrame, state: DataFrame, cfg: RuleConfig = RuleConfig(), delay_ms: int = 10_000,
    reference: DataFrame | None = None, resolve=lambda joined: joined, hot_cards: bool = True,
) -> DataFrame:
    """``tx`` plus ``n_window``, ``hv_window``, ``amount_window``, ``prev_ts`` and ``is_late``, and lookups of ``reference``.

    ``state`` holds the tails of the batch's cards (``STATE``). Over input that is
    in order per card from one micro-batch to the next, the result equals the batch
    features. A late event is judged against the tail it finds, newer events
    included, and is never dropped; ``is_late`` marks those more than ``delay_ms``
    behind the card's newest event of earlier batches. ``hot_cards`` as in
    ``trailing_features``.
    """
    side = card_state(state)
    if reference is not None:
        side = side.join(reference, _CARD, "full")
    tail = state.where("month is null").select(_CARD, "at", "n", "large", "amount")
    featured = trailing_features(tx, cfg, reference=side, amounts=True, resolve=resolve, carried=tail, hot_cards=hot_cards)
    ts = F.col(_TS)
    return featured.withColumns({
        "prev_ts": F.coalesce("prev_ts", F.try_element_at("_last_of_month", year_month(ts))),
        "is_late": F.coalesce(ts + delay_ms < F.col("_newest"), F.lit(False)),
    }).drop("_newest", "_last_of_month")


def next_state(tx: DataFrame, state: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """The tails of the batch's cards after ``tx``.

    Each card's newest event is found first, by an aggregate that tasks combine, so
    that of the window only what stays in it is moved and summed.
    """
    ts, zero, amount = F.col(_TS), F.lit(0).cast("bigint"), F.col("amount").try_cast("decimal(18,2)")
    in_window = state.where("month is null").select(_CARD, "at", "n", "large", "amount")
    of_months = state.where("month is not null").select(_CARD, "month", "at", "n", "large", "amount")

    newest = tx.select(_CARD, ts.alias("at")).unionByName(in_window.select(_CARD, "at")).groupBy(_CARD).agg(
        F.max("at").alias("_newest"))
    arrived = tx.select(
        _CARD, ts.alias("at"), F.lit(1).cast("bigint").alias("n"), large_amount(cfg).cast("bigint").alias("large"),
        amount.cast("decimal(22,2)").alias("amount"))
    window = (
        in_window.unionByName(arrived).join(newest, _CARD).where(F.col("at") >= F.col("_newest") - cfg.window_ms)
        .groupBy(_CARD, "at").agg(*_sums())
    )
    seen = tx.select(
        _CARD, year_month(ts).alias("month"), ts.alias("now"), zero.alias("n"), zero.alias("large"),
        zero.cast("decimal(22,2)").alias("amount"))
    months = (
        of_months.withColumnRenamed("at", "before").unionByName(seen, allowMissingColumns=True)
        .dropna(subset=[_CARD, "month"])
        .groupBy(_CARD, "month").agg(F.coalesce(F.max("now"), F.max("before")).alias("at"), *_sums())
    )
    return window.withColumn("month", F.lit(None).cast("string")).unionByName(months).select(
        _CARD, "month", "at", "n", "large", "amount")


def _sums() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("large").alias("large"), F.sum("amount").cast("decimal(22,2)").alias("amount")]


def expired_cards(state: DataFrame, idle_days: int) -> DataFrame:
    """Cards whose newest event is more than ``idle_days`` behind the newest of all."""
    last = state.where("month is null").groupBy(_CARD).agg(F.max("at").alias("at"))
    newest = last.agg(F.max("at").alias("newest"))  # one row
    return last.crossJoin(F.broadcast(newest)).where(
        F.col("at") < F.col("newest") - idle_days * _DAY_MS).select(_CARD)


def living_state(stored: DataFrame, idle_days: int) -> DataFrame:
    """The newest state of all cards that are not expired."""
    state = newest_state(stored)
    return state.join(expired_cards(state, idle_days), _CARD, "left_anti")
