"""Per-card trailing window and previous event.

For every transaction: how many of the card's transactions, and how many large
ones, lie in the last ``window_ms`` (both ends included, the transaction itself
too), and when the card's previous transaction of the same month was. Equal
time stamps count in arrival order (``seq``), so a RANGE frame, which counts all
peers of a tie, is not the same thing.

Each transaction becomes two rows: +1 where it arrives and -1 where it leaves
the window. A running sum over both is the trailing count. It costs constant
work per row whatever the window holds, while a sliding frame would re-read the
whole frame for each row.

A card that holds a large share of all rows is cut into time slots. What
earlier slots leave behind (still open transactions, last time stamp) is summed
per slot with map-side combine and joined back as the opening balance of the
slot. All other cards use the single slot -1 and need no opening balance.

Streams hand in what earlier batches left (``carried``): counts per card and
millisecond, which are in the window from the start and leave it like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudloom.config import RuleConfig
from fraudloom.functions.times import event_time
from fraudloom.operators.skew import heavy_keys

_CARD, _TS = "nameOrig", "ingestion_timestamp_ms"
_WHOLE = -1
_START = -(1 << 60)  # a place before all times


def _month(ts_ms: Column) -> Column:
    return F.trunc(F.to_date(event_time(ts_ms)), "month")


def large_amount(cfg: RuleConfig) -> Column:
    """Whether the amount counts as large; NaN, which compares as largest, does not."""
    return (F.col("amount") >= cfg.high_value) & ~F.isnan("amount")


def _slot(cfg: RuleConfig) -> Column:
    return F.when(F.col("_hot"), F.expr(f"_pos div {cfg.slot_ms}")).otherwise(_WHOLE)


def _marked(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``_hot`` is true for rows of hot cards, of which there are none if ``hot`` is None."""
    if hot is None:
        return rows.withColumn("_hot", F.lit(False))
    return rows.join(F.broadcast(hot.select(_CARD, F.lit(True).alias("_hot"))), _CARD, "left")


def _carried_rows(carried: DataFrame, hot: DataFrame | None, cfg: RuleConfig, amounts: bool) -> DataFrame:
    """Earlier counts as rows that enter before all events and leave like events."""
    rows = _marked(carried, hot).select("*", F.explode(F.array(F.lit(2), F.lit(0))).alias("_arrives"))
    enters = F.col("_arrives") == 2
    sign = F.when(enters, 1).otherwise(-1)
    columns = {
        "_pos": F.when(enters, F.lit(_START)).otherwise(F.col("at") + cfg.window_ms + 1),
        "_one": sign * F.col("n"), "_large": sign * F.col("large"), "_arrived": F.lit(None).cast("bigint"),
    }
    if amounts:
        columns["_amount"] = sign * F.col("amount").cast("decimal(22,2)")
    return rows.withColumns(columns).withColumn("_slot", _slot(cfg))


def _arrivals_and_exits(tx: DataFrame, hot: DataFrame | None, cfg: RuleConfig, amounts: bool) -> DataFrame:
    marked = _marked(tx, hot).select("*", F.explode(F.array(F.lit(1), F.lit(0))).alias("_arrives"))
    arrives = F.col("_arrives") == 1
    sign = F.when(arrives, 1).otherwise(-1)
    ts = F.col(_TS)
    rows = marked.withColumns({
        "_pos": F.when(arrives, ts).otherwise(ts + cfg.window_ms + 1),
        "_one": sign,
        "_large": F.when(large_amount(cfg), sign).otherwise(0),
        "_arrived": F.when(arrives, ts),
    })
    if amounts:
        # decimal: a running sum that adds and subtracts doubles would drift
        rows = rows.withColumn("_amount", sign * F.col("amount").try_cast("decimal(18,2)"))
    return rows.withColumn("_slot", _slot(cfg))


def _opening_balances(rows: DataFrame, amounts: bool) -> DataFrame:
    """Per slot of a hot card: sums and last arrival of all its earlier slots."""
    sums = ["_one", "_large"] + (["_amount"] if amounts else [])
    per_slot = rows.where("_hot").groupBy(_CARD, "_slot").agg(
        *[F.sum(c).alias(c) for c in sums], F.max("_arrived").alias("_arrived")
    )
    earlier = Window.partitionBy(_CARD).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return per_slot.select(
        _CARD, "_slot",
        *[F.sum(c).over(earlier).alias("_open" + c) for c in sums],
        F.max("_arrived").over(earlier).alias("_open_arrived"),
    )


def trailing_features(
    tx: DataFrame,
    cfg: RuleConfig = RuleConfig(),
    reference: DataFrame | None = None,
    amounts: bool = False,
    resolve: Callable[[DataFrame], DataFrame] = lambda joined: joined,
    carried: DataFrame | None = None,
    hot_cards: bool = True,
) -> DataFrame:
    """``tx`` plus ``n_window``, ``hv_window``, ``prev_ts`` (and ``amount_window``).

    ``reference`` holds one row per card, keyed ``nameOrig``. It is joined in the
    same exchange that the window needs, so lookups cost no shuffle of ``tx``.
    ``resolve`` turns its columns into those that are wanted. It runs below the
    window, where its results are computed once; above it they would be copied
    into every expression that uses them. ``carried`` has counts of earlier events
    (``nameOrig, at, n, large, amount``); they only count, ``prev_ts`` knows events
    of ``tx`` alone. ``hot_cards=False`` is for callers that know that no card has
    more than ``hot_card_rows`` rows, such as of a micro-batch with fewer rows: nothing
    is counted or split then, and the result is the same.
    """
    hot = heavy_keys(tx, [_CARD], cfg.hot_card_rows) if hot_cards else None
    rows = _arrivals_and_exits(tx, hot, cfg, amounts)
    work = ["_arrives", "_pos", "_one", "_large", "_arrived"] + (["_amount"] if amounts else [])
    earlier = None
    balanced = rows
    if carried is not None:
        earlier = _carried_rows(carried, hot, cfg, amounts)
        kept = [_CARD, "_slot", "_hot", *work]
        balanced = rows.select(kept).unionByName(earlier.select(kept))
    side, group = reference, [_CARD]
    if hot is not None:
        side, group = _opening_balances(balanced, amounts), [_CARD, "_slot"]
    if hot is not None and reference is not None:
        whole = reference.withColumn("_slot", F.lit(_WHOLE).cast("bigint"))
        # the semi join sinks below the aggregation: only hot cards' lookups are built twice
        of_hot = reference.join(F.broadcast(hot.select(_CARD)), _CARD, "left_semi")
        side = whole.unionByName(side.join(of_hot, _CARD, "left"), allowMissingColumns=True)

    # The leaving row only carries its time stamp: its other columns are blanked
    # before the exchange.
    carried = [c for c in tx.columns if c not in (_CARD, _TS, "seq")]
    numbered = F.coalesce(F.col("seq"), F.raise_error(F.lit("an event without seq has no place in the order")))
    narrow = rows.select(
        _CARD, "_slot", _TS, numbered.alias("seq"), *work,
        *[F.when(F.col("_arrives") == 1, F.col(c)).alias(c) for c in carried],
    )
    if earlier is not None:
        narrow = narrow.unionByName(earlier.select(_CARD, "_slot", *work), allowMissingColumns=True)
    order = Window.partitionBy(*group).orderBy("_pos", "_arrives", "seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def running(name: str) -> Column:
        since = F.sum(name).over(so_far)
        return since if hot is None else F.coalesce(F.col("_open" + name), F.lit(0)) + since

    last = F.last("_arrived", ignorenulls=True).over(before)
    out = {
        "n_window": running("_one"),
        "hv_window": running("_large"),
        "_prev": last if hot is None else F.coalesce(last, F.col("_open_arrived")),
    }
    if amounts:
        out["amount_window"] = running("_amount").cast("decimal(18,2)")
    same_month = _month(F.col("_prev")) == _month(F.col(_TS))
    features = ["n_window", "hv_window", "prev_ts"] + (["amount_window"] if amounts else [])
    joined = resolve(narrow if side is None else narrow.join(side, group, "left"))
    held = [*narrow.columns, *(side.columns if side is not None else [])]
    lookups = [c for c in joined.columns if c not in held]
    if reference is not None:
        lookups += [c for c in reference.columns if c in joined.columns and c != _CARD]
    return (
        joined
        .withColumns(out)
        .where(F.col("_arrives") == 1)
        .withColumn("prev_ts", F.when(same_month, F.col("_prev")))
        .select(*tx.columns, *lookups, *features)
    )
