"""Random inputs against a plain-Python model of each operator's semantics."""

from collections import defaultdict
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradewatch.operators import pump as P
from tradewatch.operators.candles import ohlcv

from test_pump import candles as make_candles

T0 = datetime(2024, 1, 1, 23, 40)
COLS = "trade_id long, price double, qty double, usd_value double, trade_time timestamp_ntz, is_sell boolean"

trade = st.tuples(
    st.one_of(st.none(), st.integers(0, 30)),  # ids repeat and may be NULL
    st.integers(1, 50).map(float),
    st.integers(1, 5).map(float),
    st.integers(0, 40 * 60 * 1_000_000 // 250_000).map(lambda k: T0 + timedelta(microseconds=k * 250_000)),
    st.one_of(st.none(), st.booleans()),
)

from hypothesis import Phase

SETTINGS = dict(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
                phases=[Phase.explicit, Phase.reuse, Phase.generate])


def model_candles(rows):
    groups = defaultdict(list)
    for tid, price, qty, ts, side in rows:
        start = ts.replace(minute=ts.minute - ts.minute % 5, second=0, microsecond=0)
        groups[start].append((tid, price, qty, ts, side))
    out = {}
    for start, g in groups.items():
        # order (time, id, price), NULL id first
        key = lambda r: (r[3], -1 if r[0] is None else r[0], r[1])
        first, last = min(g, key=key), max(g, key=key)
        ids = [r for r in g if r[0] is not None]
        out[start] = (
            start.date(), first[1], max(r[1] for r in g), min(r[1] for r in g), last[1],
            sum(r[2] for r in g), len(ids), sum(1 for r in ids if r[4] is False), sum(1 for r in ids if r[4] is True),
        )
    return out


@settings(**SETTINGS)
@given(st.lists(trade, min_size=1, max_size=40))
def test_candles_match_model(spark, rows):
    df = spark.createDataFrame([(t, p, q, p * q, ts, s) for t, p, q, ts, s in rows], COLS)
    got = {
        r.window_start: (r.trade_date, r.open, r.high, r.low, r.close, r.volume_pepe, r.trade_count,
                         r.buyer_initiated_count, r.seller_initiated_count)
        for r in ohlcv(df).collect()
    }
    assert got == model_candles(rows)


def model_events(closes, vols, cfg=P.PumpConfig()):
    n, out = len(closes), []
    for i in range(n):
        prev = closes[i - 1] if i > 0 else None
        pct = (closes[i] - prev) / prev * 100 if prev is not None and prev > 0 else None
        lo, hi = max(0, i + cfg.avg_frame[0]), min(n - 1, i + cfg.avg_frame[1])
        avg = sum(vols[lo:hi + 1]) / (hi - lo + 1)
        if pct is None or not (pct >= cfg.min_pump_pct and vols[i] >= avg * cfg.volume_multiple):
            continue
        future = closes[i + 1:i + 1 + cfg.lookahead_candles]
        if not future:
            continue
        dump = (min(future) - closes[i]) / closes[i] * 100
        if dump <= cfg.max_dump_pct:
            out.append((i, pct, min(future)))
    return out


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([40.0, 45.0, 50.0, 55.0, 60.0, 80.0, 100.0]),
                          st.sampled_from([1.0, 2.0, 5.0, 20.0])), min_size=2, max_size=30))
def test_pump_events_match_model(spark, cv):
    closes, vols = [c for c, _ in cv], [v for _, v in cv]
    c = make_candles(spark, closes, vols, date(2024, 1, 1))
    t0 = datetime(2024, 1, 1)
    got = sorted(
        (int((r.pump_window_start - t0).total_seconds() // 300), round(r.pump_pct, 9), r.price_after_dump)
        for r in P.pump_dump(c).collect()
    )
    want = sorted((i, round(p, 9), m) for i, p, m in model_events(closes, vols))
    assert got == want
    assert sorted(P.pump_dump(c).collect()) == sorted(P.pump_dump_join_form(c).collect())


# ------------------------------------------------------------------ cleaning and DQ
from tradewatch.operators import dq as DQ  # noqa: E402
from tradewatch.operators.clean import clean_trades, typed_trades  # noqa: E402

DAY = date(2024, 1, 1)
T_DAY = 1704067200000000
TEXT = "trade_id string, price string, qty string, quote_qty string, time string, is_buyer_maker string, is_best_match string, trade_date date"

num_text = st.sampled_from(["1.5", "2", "0", "-1", "NaN", "abc", "", None, "3.25"])
raw_row = st.tuples(
    st.sampled_from(["1", "2", "3", "4", None, "x"]),
    num_text,
    num_text,
    st.sampled_from([str(T_DAY + 5), str(T_DAY + 3_600_000_000), str(T_DAY + 86_400_000_000), str(T_DAY - 1), None, "t"]),
    st.sampled_from(["true", "false", "True", None, "maybe"]),
)


def _num(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def _int(x):
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _gt0(v):  # Spark: NaN is larger than every number, NULL compares as NULL
    return v is not None and (v != v or v > 0)


def model_dq(rows):
    total = len(rows)
    price = [_num(r[1]) for r in rows]
    qty = [_num(r[2]) for r in rows]
    times = [_int(r[3]) for r in rows]
    in_day = [t is not None and T_DAY <= t < T_DAY + 86_400_000_000 for t in times]
    ids = [_int(r[0]) for r in rows]
    bad_p = sum(1 for p in price if p is None or (p == p and p <= 0))
    bad_q = sum(1 for q in qty if q is None or (q == q and q <= 0))
    out = sum(1 for ok in in_day if not ok)
    dups = total - len(set(ids))
    kept = [i for i in range(total) if _gt0(price[i]) and _gt0(qty[i]) and in_day[i]]
    survivors = {ids[i] for i in kept}
    return (total, bad_p, bad_q, out, dups), survivors


@settings(**SETTINGS)
@given(st.lists(raw_row, min_size=1, max_size=25))
def test_clean_and_dq_match_model(spark, rows):
    df = spark.createDataFrame([(i, p, q, None, t, s, "true", DAY) for i, p, q, t, s in rows], TEXT)
    r = DQ.dq_report(typed_trades(df)).collect()[0]
    want_counts, want_ids = model_dq(rows)
    assert (r.total_rows, r.invalid_prices, r.invalid_qty, r.out_of_range_timestamps, r.duplicate_trade_ids) == want_counts
    got = clean_trades(df).collect()
    assert {x.trade_id for x in got} == want_ids and len(got) == len(want_ids)
