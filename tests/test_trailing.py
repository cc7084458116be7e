"""Trailing window and previous event, also for cards that are split."""

from dataclasses import replace
from datetime import datetime, timezone

from helpers import T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fraudloom.config import RuleConfig
from fraudloom.operators.trailing import trailing_features

CFG = RuleConfig()
SPLIT = replace(CFG, hot_card_rows=2, slot_ms=1000)


def features(df, cfg=CFG, **kwargs):
    return {r.seq: r for r in trailing_features(df, cfg, **kwargs).collect()}


def brute_force(events, window_ms, high):
    """Counts by looking at every earlier event of the card, in arrival order by (ts, seq)."""
    out = {}
    month = lambda ts: datetime.fromtimestamp(ts / 1000, timezone.utc).strftime("%Y%m")
    ordered = sorted(events, key=lambda e: (e[1], e[2]))
    for i, (card, ts, seq, amount) in enumerate(ordered):
        past = [e for e in ordered[: i + 1] if e[0] == card]
        inside = [e for e in past if e[1] >= ts - window_ms]
        before = [e for e in past[:-1] if month(e[1]) == month(ts)]
        out[seq] = (len(inside), sum(e[3] >= high for e in inside), before[-1][1] if before else None)
    return out


def test_ties_count_in_arrival_order(tx_of):
    got = features(tx_of(("C1", T0, 1, 5), ("C1", T0, 2, 5), ("C1", T0, 3, 5)))
    assert [got[s].n_window for s in (1, 2, 3)] == [1, 2, 3]


def test_window_border_is_inclusive(tx_of):
    got = features(tx_of(("C1", T0, 1, 5), ("C1", T0 + 300_000, 2, 5), ("C2", T0, 3, 5), ("C2", T0 + 300_001, 4, 5)))
    assert (got[2].n_window, got[4].n_window) == (2, 1)


def test_large_count_includes_small_current_event(tx_of):
    got = features(tx_of(*[("C1", T0 + i, i, 10_000) for i in range(3)], ("C1", T0 + 9, 9, 1)))
    assert got[9].hv_window == 3 and got[9].n_window == 4


def test_nan_is_not_large(tx_of):
    assert features(tx_of(("C1", T0, 1, float("nan"))))[1].hv_window == 0


def test_previous_event_restarts_with_the_month(tx_of):
    end = T0 + 31 * 86_400_000
    got = features(tx_of(("C1", end - 1, 1, 5), ("C1", end, 2, 5), ("C1", end + 7, 3, 5)))
    assert (got[2].prev_ts, got[3].prev_ts) == (None, end)
    assert got[2].n_window == 2  # the window itself does not restart


def test_amount_sums_are_exact(tx_of):
    got = features(tx_of(*[("C1", T0 + 400_000 * i, i, 0.1) for i in range(20)]), amounts=True)
    assert {float(r.amount_window) for r in got.values()} == {0.1}


event = st.tuples(
    st.sampled_from(["C1", "C2"]),
    st.integers(0, 40).map(lambda n: T0 + 31 * 86_400_000 - 20 * 60_000 + n * 60_000),
    st.just(0),
    st.sampled_from([1.0, 9_999.99, 10_000.0]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40), st.randoms())
def test_equals_brute_force_in_any_input_order(tx_of, events, random):
    events = [(c, ts, i, a) for i, (c, ts, _, a) in enumerate(events)]
    want = brute_force(events, CFG.window_ms, CFG.high_value)
    random.shuffle(events)
    df = tx_of(*events)
    for cfg in (CFG, SPLIT):
        got = {s: (r.n_window, r.hv_window, r.prev_ts) for s, r in features(df, cfg).items()}
        assert got == want


def test_one_card_with_a_third_of_all_rows_is_split(spark, tx_of):
    events = [("HOT", T0 + 997 * i, i, 10_000 if i % 7 == 0 else 1) for i in range(600)]
    events += [(f"C{i % 40}", T0 + 501 * i, 1000 + i, 1) for i in range(1200)]
    cfg = replace(CFG, hot_card_rows=100, slot_ms=10_000)
    got = {s: (r.n_window, r.hv_window, r.prev_ts) for s, r in features(tx_of(*events), cfg).items()}
    assert got == brute_force(events, cfg.window_ms, cfg.high_value)
