"""Kernels against worked examples."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import kernels as K
from tidemark.operators.backtest import Position, fee, fill_price, pretrade


def split_equals_whole(kernel, pdf, cut):
    whole, _ = kernel(None, pdf)
    a, state = kernel(None, pdf.iloc[:cut].reset_index(drop=True))
    b, _ = kernel(state, pdf.iloc[cut:].reset_index(drop=True))
    pd.testing.assert_frame_equal(pd.concat([a, b], ignore_index=True), whole, check_dtype=False)


def test_sequence_check():
    out, _ = K.sequence_check()(None, pd.DataFrame({"seq": [1, 2, 3, 5, 5, 4, 6, 2000, 10]}))
    a, g, d = "accept", "accept_with_gap", "drop_duplicate"
    assert out["action"].tolist() == [a, a, a, g, d, d, a, g, a]
    assert out["missed"].sum() == 1994 and out["restarted"].tolist() == [False] * 8 + [True]


def test_rsi_variants():
    closes = pd.DataFrame({"close": [10, 11, 10.5, 11.5, 12, 11.8, 12.4, 12.1, 12.9, 13.2, 12.7, 13.5, 13.1, 13.9, 14.2, 13.8]})
    bars = K.rsi()(None, closes)[0]["rsi"].tolist()
    signal = K.rsi(variant="signal")(None, closes)[0]["rsi"].tolist()
    assert bars[-2:] == pytest.approx([74.97805092186128, 70.95289831916662])
    assert signal[-2:] == pytest.approx([76.25, 72.35401459854016])
    assert bars[13] is None


@pytest.mark.parametrize("cut", [1, 7, 30])
def test_state_carries_over(cut):
    rng = np.random.default_rng(0)
    n = 60
    pdf = pd.DataFrame({"sym": "x", "close": 100 + rng.normal(0, 1, n).cumsum(), "price": 100 + rng.normal(0, 1, n).cumsum(), "sd": rng.normal(0, 100, n)})
    for kernel in (K.ema("price", 5), K.macd(), K.fixed_bars("dib", 250.0), K.fixed_bars("drb", 250.0)):
        split_equals_whole(kernel, pdf, cut)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-500, 500), min_size=1, max_size=400), st.integers(1, 2000))
def test_fixed_bars_equal_a_plain_loop(sd, th):
    got = K.fixed_bars("dib", float(th))(None, pd.DataFrame({"sd": np.array(sd, float)}))[0]["bn"].tolist()
    theta, bn, expected = 0.0, 0, []
    for x in sd:
        theta += x
        if abs(theta) >= th:
            theta, bn = 0.0, bn + 1
        expected.append(bn)
    assert got == expected


def test_adaptive_bar_closes_on_its_trigger():
    pdf = pd.DataFrame({"sd": [5.0, 6.0, -3.0, 20.0], "bt": [1, 1, -1, 1], "dvol": [5.0, 6.0, 3.0, 20.0], "et": 2.0, "pb": 0.6, "ed": 5.0, "th": 10.0, "sigma": 1.0, "anchor": 10.0})
    out, _ = K.adaptive_bars("rwdib")(None, pdf)
    assert out["bn"].tolist() == [0, 0, 1, 1] and out["theta"].tolist() == [5.0, 11.0, -3.0, 17.0]


def book(*deltas):
    rows = [("BTC", 0, "snapshot", 100, 100, 0, [[50000 - i, i + 1] for i in range(5)], [[50001 + i, i + 1] for i in range(5)]), ("BTC", 1, "delta", 101, 101, 1, [], [])]
    rows += [("BTC", i + 2, "delta", a, b, i + 2, bids, []) for i, (a, b, bids) in enumerate(deltas)]
    return K.order_book()(None, pd.DataFrame(rows, columns=["sym", "ord", "kind", "firstId", "finalId", "eventMs", "bids", "asks"]))[0].iloc[-1]


def test_order_book_levels():
    x = book((102, 102, [[50000, 7.5]]))
    assert (x.bidQty1, x.bidPrice2, x.bidQty2) == (7.5, 49999, 2)
    x = book((102, 102, [[50000, 0]]))
    assert (x.bidPrice1, x.bidQty1, x.bidPrice4, x.bidQty4, x.bidPrice5, x.bidQty5) == (49999, 2, 49996, 5, 0, 0)
    x = book((102, 102, [[50001, 9]]))
    assert (x.bidPrice1, x.bidQty1, x.bidPrice2, x.bidPrice5, x.bidQty5) == (50001, 9, 50000, 49997, 4)
    x = book((105, 110, [[50000, 1]]))
    assert not x.isValid and x.bidPrice1 == 0


def test_order_book_keeps_deltas_before_a_snapshot():
    rows = [("B", 0, "delta", 101, 103, 0, [[10, 1]], []), ("B", 1, "snapshot", 100, 100, 1, [[9, 1]], [[11, 1]]), ("B", 2, "delta", 104, 104, 2, [[10, 0]], [])]
    out = K.order_book()(None, pd.DataFrame(rows, columns=["sym", "ord", "kind", "firstId", "finalId", "eventMs", "bids", "asks"]))[0]
    assert out["bidPrice1"].tolist() == [10, 9]


def test_imbalance_and_its_compatible_form():
    row = lambda q: {f"{s}Qty{i}": float(q) for s in ("bid", "ask") for i in range(1, 6)}
    pdf = pd.DataFrame([row(1), row(0), row(2)])
    assert K.imbalance()(None, pdf)[0]["smoothOBI"].tolist() == [0, 0, 0]
    assert K.imbalance(compat=True)(None, pdf)[0]["smoothOBI"].tolist() == [0, None, None]


def test_positions_and_fills():
    assert fill_price(60500, True) == pytest.approx(60503.025) and fill_price(60500, False) == pytest.approx(60496.975)
    assert fee(0.1 * 60503.025) == pytest.approx(3.02515125)
    p = Position()
    p.fill(1, 100, 0)
    p.fill(1, 110, 0)
    assert p.cost == 105
    p.fill(-1, 120, 0)
    assert (p.realized, p.qty) == (15, 1)
    p.fill(-2, 90, 0)
    assert (p.realized, p.qty, p.cost) == (0, -1, 90)


def test_pretrade():
    assert pretrade("buy", 2, 0, 1.0, False) == (1.0, "")
    assert pretrade("buy", 1, 1, 1.0, False) == (0.0, "atCap")
    assert pretrade("buy", 1, 0, 1.0, True) == (0.0, "killSwitch")
    assert pretrade("flatten", 0, 3, 1.0, True) == (-3, "")
    assert pretrade("sell", 1, 0, None, False) == (0.0, "unknownSymbol")


def test_online_bars_close_and_restart():
    pdf = pd.DataFrame({"sym": "x", "time": pd.Timestamp(0), "price": [10.0, 11.0, 12.0, 11.0], "qty": 100.0, "buyerIsMaker": False})
    out, state = K.online_bars(2000.0)(None, pdf)
    assert out["kind"].tolist() == ["dib"] and out["close"].tolist() == [11.0] and out["position"].tolist() == [1]
    assert state["th"] == pytest.approx(0.02 * 2100 + 0.98 * 2000) and state["n"] == 2


def plain_adaptive(kind, pdf, start):
    """Closes of the tick-by-tick kernel: (bn, th, theta, et, pb, ed) and the place."""
    out, state = K.adaptive_bars(kind)(None, pdf.assign(**start))
    hit = out["theta"].abs() >= out["th"]
    return [(*r, i) for r, i in zip(out.loc[hit, ["bn", "th", "theta", "et", "pb", "ed"]].itertuples(index=False, name=None), np.flatnonzero(hit), strict=True)], state


@pytest.mark.parametrize("kind", ["dib", "drb", "rwdib"])
@pytest.mark.parametrize("th", [40.0, 400.0, 20_000.0])
@pytest.mark.parametrize("cuts", [(), (1, 2, 700), (400,)])
def test_searched_bars_equal_the_scan(kind, th, cuts):
    import json

    rng = np.random.default_rng(int(th) + len(cuts))
    n = 1500
    sd = np.round(rng.normal(0, 60, n), 2) * np.where(rng.random(n) < 0.02, 50, 1)
    sd[200:900] = np.abs(sd[200:900])  # one long run
    pdf = pd.DataFrame({"sd": sd, "bt": np.where(sd > 0, 1, -1), "dvol": np.abs(sd), "anchor": th * (1 + np.arange(n) // 500 / 3)})
    start = {"et": 9.0, "pb": 0.55, "ed": 40.0, "th": th, "theta": 3.25, "bn": 4, "tib": 2, "bib": 1, "dib": 8.5}
    want, _ = plain_adaptive(kind, pdf, start)
    fed = pdf.assign(sym="x", tradeId=np.arange(n), day=np.arange(n) // 500, start=None)
    fed = pd.concat([fed.iloc[:1].assign(start=json.dumps(start | {"anchors": {str(d): th * (1 + d / 3) for d in range(3)}})), fed], ignore_index=True)
    state, got, kernel = None, [], K.bar_marks(kind, 20)
    for a, b in zip([0, *(c + 1 for c in cuts)], [*(c + 1 for c in cuts), n + 1], strict=True):
        out, state = kernel(state, fed.iloc[a:b].reset_index(drop=True))
        state = json.loads(json.dumps(state))
        got += out[out["closed"].astype(bool)][["bn", "th", "theta", "et", "pb", "ed", "tradeId"]].itertuples(index=False, name=None)
    assert got == want and len(got) > 0


@pytest.mark.parametrize("kind", ["dib", "drb"])
@pytest.mark.parametrize("th", [1.0, 90.0, 5000.0])
def test_searched_fixed_bars_equal_the_scan(kind, th):
    rng = np.random.default_rng(3)
    sd = np.round(rng.normal(5, 60, 2000), 2)
    want = K.fixed_bars(kind, th)(None, pd.DataFrame({"sd": sd}))[0]
    fed = pd.DataFrame({"sym": "x", "tradeId": np.arange(-1, 2000), "day": 1, "sd": [0.0, *sd], "start": [f'{{"th": {th}}}', *[None] * 2000]})
    out, _ = K.bar_marks(kind)(None, fed)
    pd.testing.assert_frame_equal(K.bar_marks(kind, th=th)(None, fed.iloc[1:])[0], out)
    assert not len(K.bar_marks(kind)(None, fed.iloc[1:])[0])  # no start, no bars
    closed = out["closed"].astype(bool)
    assert np.flatnonzero(np.diff(want["bn"], prepend=0)).tolist() == out.loc[closed, "tradeId"].tolist()
    assert tuple(out.loc[~closed, ["bn", "theta", "tib", "bib", "dib"]].iloc[-1]) == tuple(want[["bn", "theta", "tib", "bib", "dib"]].iloc[-1])


def plain_online(rows, first, floor=1000.0, ratio=0.2):
    """Live bars tick by tick."""
    th, position, bn, last, bt, out = first, 0, 0, None, 1, []
    bar = None
    for t, p, q in rows:
        bt = bt if last is None or p == last else 1 if p > last else -1
        last, usd = p, p * q
        bar = bar or {"start": t, "open": p, "high": p, "low": p, "n": 0, "theta": 0.0, "run": 0.0, "up": 1, "vol": 0.0, "usd": 0.0, "bought": 0.0}
        bar |= {"high": max(bar["high"], p), "low": min(bar["low"], p), "n": bar["n"] + 1, "theta": bar["theta"] + bt * usd, "run": (bar["run"] if bt == bar["up"] else 0.0) + usd, "up": bt, "vol": bar["vol"] + q, "usd": bar["usd"] + usd, "bought": bar["bought"] + (usd if bt > 0 else 0.0)}
        lim = max(th, floor)
        kind = "dib" if abs(bar["theta"]) >= lim else "drb" if bar["run"] >= lim else None
        if kind:
            pct = 100 * bar["bought"] / bar["usd"]
            if kind == "dib":
                position = 1 if pct > 65 else -1 if pct < 35 else position
                share = abs(bar["theta"]) / bar["usd"]
                th = 0.02 * (bar["usd"] * share) + 0.98 * th
            out.append((kind, bn, bar["start"], t, bar["open"], bar["high"], bar["low"], p, bar["n"], bar["vol"], bar["usd"], pct, bar["theta"], bar["run"], bar["up"], lim, position))
            bn, bar = bn + 1, {"start": t, "open": p, "high": p, "low": p, "n": 0, "theta": 0.0, "run": 0.0, "up": 1, "vol": 0.0, "usd": 0.0, "bought": 0.0}
    return out


@pytest.mark.parametrize("first", [300.0, 9000.0, 120_000.0])
def test_searched_online_bars_equal_the_scan(first):
    import json

    rng = np.random.default_rng(9)
    n = 3000
    price = 100 + np.round(rng.normal(0, 0.02, n).cumsum(), 2)
    price[500:1400] = 100 + np.arange(900) * 0.01
    qty = np.round(rng.exponential(3, n), 3) + 0.001
    pdf = pd.DataFrame({"sym": "x", "time": pd.to_datetime(np.arange(n), unit="s"), "price": price, "qty": qty, "buyerIsMaker": False})
    state, got, kernel = None, [], K.online_bars(first)
    for a, b in ((0, 1), (1, 777), (777, 777), (777, n)):
        out, state = kernel(state, pdf.iloc[a:b].reset_index(drop=True))
        state = json.loads(json.dumps(state))
        got += out.drop(columns="sym").itertuples(index=False, name=None)
    assert got == plain_online(zip(pdf["time"], price.tolist(), qty.tolist(), strict=True), first) and got


def test_sliding_volatility_is_linear_and_resumes():
    import json

    rng = np.random.default_rng(2)
    n = 4000
    pdf = pd.DataFrame({"sym": "x", "time": pd.to_datetime(rng.integers(1, 40, n).cumsum(), unit="s"), "price": 100 * np.exp(rng.normal(0, 1e-3, n).cumsum())})
    t, p = pdf["time"].astype("int64").to_numpy() // 10 ** (9 if "ns" in str(pdf["time"].dtype) else 0), pdf["price"].to_numpy()
    last, kept, want = 0, [], []
    for i in range(1, n):
        if t[i] - t[last] >= 30:
            kept.append((t[i], np.log(p[i] / p[last])))
            last = i
            inside = [r for at, r in kept if at > t[i] - 3600]
            if len(inside) >= 10:
                want.append((pdf["time"][i], 100 * np.sqrt(31_536_000 / 30) * np.std(inside), len(inside), len(inside) >= 120))
    state, got, kernel = None, [], K.sampled_volatility()
    for a, b in ((0, 1), (1, 900), (900, n)):
        out, state = kernel(state, pdf.iloc[a:b].reset_index(drop=True))
        state = json.loads(json.dumps(state))
        got += out.drop(columns="sym").itertuples(index=False, name=None)
    assert [(a, c, d) for a, _, c, d in got] == [(a, c, d) for a, _, c, d in want]
    assert np.allclose([r[1] for r in got], [r[1] for r in want], rtol=1e-9)


def plain_barriers(rows, horizon):
    out = []
    for i, (bn, _, _, close, sigma, upper, lower) in enumerate(rows):
        ahead = rows[i + 1 : i + 1 + horizon]
        hit = next((r for r in ahead if sigma is not None and (r[1] >= upper or r[2] <= lower)), None)
        last = (None, None) if sigma is None or not ahead else (hit[0], hit[3]) if hit else (ahead[-1][0], ahead[-1][3])
        out.append((bn, hit and hit[0], bool(hit and hit[1] >= upper), bool(hit and hit[2] <= lower), *last))
    return sorted(out)


@pytest.mark.parametrize("horizon", [1, 3, 40, 10_000])
@pytest.mark.parametrize("wide", [0.0, 0.004, 0.05])
def test_barriers_equal_a_plain_search(horizon, wide):
    rng = np.random.default_rng(horizon)
    n = 400
    close = np.round(100 * np.exp(rng.normal(0, 0.004, n).cumsum()), 2)
    high, low = close + rng.integers(0, 40, n) / 100, close - rng.integers(0, 40, n) / 100
    sigma = np.where((np.arange(n) % 53 == 0), np.nan, wide)
    pdf = pd.DataFrame({"sym": "x", "bn": np.arange(n) * 2, "high": high, "low": low, "close": close, "sigma": sigma, "upperPx": close * (1 + 2 * sigma), "lowerPx": close * (1 - sigma), "end": False})
    rows = [(int(r.bn), r.high, r.low, r.close, None if np.isnan(r.sigma) else r.sigma, r.upperPx, r.lowerPx) for r in pdf.itertuples()]
    pdf.loc[n - 1, "end"] = True
    state, got, kernel = None, [], K.barriers(horizon)
    for a, b in ((0, 1), (1, 250), (250, n)):
        out, state = kernel(state, pdf.iloc[a:b].reset_index(drop=True))
        none = lambda x: None if x is None or x is pd.NA or x != x else x
        got += [(r.bn, none(r.hitBn), r.up, r.dn, none(r.lastBn), none(r.lastClose)) for r in out.itertuples()]
    assert sorted(got) == plain_barriers(rows, horizon)
    assert not state["wait"]


def test_barriers_forget_what_is_decided():
    n = 20_000
    close = 1000.0 - np.arange(n) * 0.01  # upper prices are never touched
    pdf = pd.DataFrame({"sym": "x", "bn": np.arange(n), "high": close, "low": close, "close": close, "sigma": 0.01, "upperPx": close * 1.02, "lowerPx": close * 0.5, "end": False})
    _, state = K.barriers(100)(None, pdf)
    assert len(state["wait"]) == 100 and len(state["up"]) + len(state["dn"]) < 1000
