"""Kernels of the recursive operators (see scan.py): recurrences that no window frame expresses."""

from __future__ import annotations

import heapq
import json
import math
from collections import deque

import numpy as np
import pandas as pd

from .scan import Kernel, State


def _ewm(values: np.ndarray, alpha: float, last: float | None) -> list[float]:
    """e = alpha x + (1 - alpha) e, starting at the first value; the order of operations is fixed."""
    out = []
    for x in values.tolist():
        last = x if last is None else alpha * x + (1 - alpha) * last
        out.append(last)
    return out


def ema(column: str, n: int, out: str = "ema") -> Kernel:
    alpha = 2 / (1 + n)

    def run(state: State, pdf: pd.DataFrame):
        e = _ewm(pdf[column].to_numpy(float), alpha, (state or {}).get("e"))
        return pdf.assign(**{out: e}), {"e": e[-1]}

    return run


def macd(column: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> Kernel:
    def run(state: State, pdf: pd.DataFrame):
        s, x = state or {}, pdf[column].to_numpy(float)
        f, w = _ewm(x, 2 / (1 + fast), s.get("f")), _ewm(x, 2 / (1 + slow), s.get("s"))
        m = np.array(f) - np.array(w)
        g = _ewm(m, 2 / (1 + signal), s.get("g"))
        return pdf.assign(macd=m, macdSignal=g, macdHist=m - np.array(g)), {"f": f[-1], "s": w[-1], "g": g[-1]}

    return run


def rsi(column: str = "close", n: int = 14, variant: str = "bars") -> Kernel:
    """Wilder's RSI.  The seed of the bars variant counts a gain of 0, but no loss, for the first
    row; that of the signal variant counts neither.  Null until n rows went before, or without losses."""

    def run(state: State, pdf: pd.DataFrame):
        s, out = dict(state or {"i": 0, "last": None, "gains": 0.0, "losses": 0.0, "g": None, "l": None}), []
        for x in pdf[column].to_numpy(float).tolist():
            d = None if s["last"] is None else x - s["last"]
            gain = (0.0 if variant == "bars" else None) if d is None else max(d, 0.0)
            loss = None if d is None else max(-d, 0.0)
            s["last"] = x
            if s["i"] <= n:
                s["gains"], s["losses"] = s["gains"] + (gain or 0.0), s["losses"] + (loss or 0.0)
                if s["i"] == n:
                    s["g"], s["l"] = s["gains"] / (n + 1 if variant == "bars" else n), s["losses"] / n
            else:
                s["g"], s["l"] = (gain + s["g"] * (n - 1)) / n, (loss + s["l"] * (n - 1)) / n
            s["i"] += 1
            rs = None if s["g"] is None or not s["l"] else s["g"] / s["l"]
            out.append(None if rs is None else 100 * rs / (1 + rs))
        return pdf.assign(rsi=np.array(out, object)), s

    return run


def label_sigma(span: int = 100) -> Kernel:
    """EWMA of absolute log returns, seeded with the first; null on the first bar."""
    alpha = 2 / (span + 1)

    def run(state: State, pdf: pd.DataFrame):
        s, out = dict(state or {"last": None, "e": None}), []
        for x in pdf["close"].to_numpy(float).tolist():
            if s["last"] is not None:
                r = abs(math.log(x / s["last"]))
                s["e"] = r if s["e"] is None else alpha * r + (1 - alpha) * s["e"]
            s["last"] = x
            out.append(s["e"])
        return pdf.assign(sigma=np.array(out, object)), s

    return run


def sequence_check(column: str = "seq", restart: int = 1000) -> Kernel:
    """accept, accept_with_gap (and how many are missing) or drop_duplicate; a number that is at
    least ``restart`` below the last one means that the sender began anew."""

    def run(state: State, pdf: pd.DataFrame):
        last, action, missed, fresh = (state or {}).get("last"), [], [], []
        for q in pdf[column].tolist():
            gap = 0 if last is None else q - last - 1
            if gap < 0 and last - q < restart:
                action.append("drop_duplicate")
                missed.append(0)
                fresh.append(False)
                continue
            action.append("accept_with_gap" if gap > 0 else "accept")
            missed.append(max(gap, 0))
            fresh.append(gap < 0)
            last = q
        return pdf.assign(action=action, missed=missed, restarted=fresh), {"last": last}

    return run


def imbalance(alpha: float = 0.05, compat: bool = False) -> Kernel:
    """Order-book imbalance and its EMA.  A row of no depth has null raw and leaves the EMA as it
    is; with compat it makes the EMA null for good."""
    bid, ask = [f"bidQty{i}" for i in range(1, 6)], [f"askQty{i}" for i in range(1, 6)]

    def run(state: State, pdf: pd.DataFrame):
        s, raws, out = dict(state or {"e": None, "dead": False}), [], []
        b, a = pdf[bid].to_numpy(float).sum(1), pdf[ask].to_numpy(float).sum(1)
        for x, y in zip(b.tolist(), a.tolist(), strict=True):
            raw = (x - y) / (x + y) if x + y else None
            if raw is None:
                s["dead"] |= compat
            else:
                s["e"] = raw if s["e"] is None else alpha * raw + (1 - alpha) * s["e"]
            raws.append(raw)
            out.append(None if s["dead"] else s["e"])
        return pdf.assign(rawOBI=np.array(raws, object), smoothOBI=np.array(out, object)), s

    return run


def thinned(every_s: float, column: str = "time") -> Kernel:
    """Rows at least every_s after the last one kept; the first is kept."""

    def run(state: State, pdf: pd.DataFrame):
        last, keep = (state or {}).get("last"), []
        for t in (pdf[column].astype("datetime64[us]").astype("int64") / 1e6).tolist():
            keep.append(last is None or t - last >= every_s)
            last = t if keep[-1] else last
        return pdf[keep], {"last": last}

    return run


def sampled_volatility(sample_s: float = 30, window_s: float = 3600, least: int = 10, valid: int = 120, every_s: float = 5) -> Kernel:
    """Realized volatility from returns between trades at least sample_s apart, over window_s; a row
    at least every_s after the one before it.

    The window is a queue with the sums of its returns and of their squares, in whole units of 2^-52
    and 2^-104: exact, so that what leaves takes away just what it brought."""
    year, unit = 31_536_000, float(1 << 52)

    def run(state: State, pdf: pd.DataFrame):
        s = dict(state or {"t": None, "p": None, "returns": [], "inserted": None})
        kept, out = deque((t, int(u)) for t, u in s["returns"]), []
        one, two = sum(u for _, u in kept), sum(u * u for _, u in kept)
        times = pdf["time"].astype("datetime64[us]").astype("int64").to_numpy() / 1e6
        at = 0 if s["t"] is None and len(pdf) else -1
        if at == 0:
            s["t"], s["p"] = float(times[0]), float(pdf["price"].iloc[0])
        prices, sym, stamps = pdf["price"].to_numpy(float), pdf["sym"].iloc[0] if len(pdf) else None, pdf["time"]
        while True:
            late = times[at + 1 : at + 257] - (s["t"] or 0) >= sample_s  # the next trade that is taken
            while len(late) and not late.any():
                at += len(late)
                late = times[at + 1 : at + 4097] - s["t"] >= sample_s
            if not len(late):
                break
            at += 1 + int(late.argmax())
            t, p = float(times[at]), float(prices[at])
            u = round(math.log(p / s["p"]) * unit)
            kept.append((t, u))
            one, two = one + u, two + u * u
            s["t"], s["p"] = t, p
            while kept[0][0] <= t - window_s:
                _, gone = kept.popleft()
                one, two = one - gone, two - gone * gone
            n = len(kept)
            if n >= least:
                vol = math.sqrt(year / sample_s) * math.sqrt((n * two - one * one) / (n * n)) / unit
                if vol > 0 and (s["inserted"] is None or t - s["inserted"] >= every_s):
                    s["inserted"] = t
                    out.append((sym, stamps.iloc[at], 100 * vol, n, n >= valid))
        s["returns"] = [(t, str(u)) for t, u in kept]
        return pd.DataFrame(out, columns=["sym", "time", "annualizedVol", "samples", "isValid"]), s

    return run


def fixed_bars(kind: str, threshold: float | None = None) -> Kernel:
    """Bar numbers under a constant threshold (or the column ``th``), of ticks with signed dollars sd,
    and the open bar's theta, tib (ticks), bib (buys) and dib (dollars) after each tick.

    dib and rwdib add sd up; drb starts again when the sign changes, zero counting as not positive.
    The tick that reaches the threshold opens the next bar, whose counts begin after it.  Within a
    bar the sums are one cumsum each, which adds in order.
    """

    def run(state: State, pdf: pd.DataFrame):
        theta, bn, tib, bib, dib = ((state or {}).get(k, 0) for k in ("theta", "bn", "tib", "bib", "dib"))
        sd = pdf["sd"].to_numpy(float)
        buy, dollars = (sd > 0).astype(np.int64), np.abs(sd)
        th = float(pdf["th"].iloc[0]) if threshold is None else threshold
        out = {"bn": np.empty(len(sd), np.int64), "theta": np.zeros(len(sd)), "tib": np.zeros(len(sd), np.int64), "bib": np.zeros(len(sd), np.int64), "dib": np.zeros(len(sd))}
        on = lambda first, values: np.cumsum(np.concatenate([[first], values]))[1:]
        at = 0
        while at < len(sd):
            step = 256
            while True:  # search a growing piece for the tick that closes
                piece = sd[at : at + step]
                if kind == "drb":
                    run_, last = np.empty(len(piece)), theta
                    for i, x in enumerate(piece.tolist()):
                        run_[i] = last = last + x if (x > 0) == (last > 0) else x
                        if abs(last) >= th:
                            run_ = run_[: i + 1]
                            break
                else:
                    run_ = on(theta, piece)
                hit = np.flatnonzero(np.abs(run_) >= th)
                if len(hit) or at + step >= len(sd):
                    break
                step *= 4
            end = at + int(hit[0]) if len(hit) else len(sd)
            if end > at:
                out["bn"][at:end], out["theta"][at:end], out["tib"][at:end] = bn, run_[: end - at], np.arange(tib + 1, tib + 1 + end - at)
                out["bib"][at:end], out["dib"][at:end] = on(bib, buy[at:end]), on(dib, dollars[at:end])
                theta, tib, bib, dib = (out[k][end - 1].item() for k in ("theta", "tib", "bib", "dib"))
            if len(hit):
                bn, theta, tib, bib, dib = bn + 1, 0.0, 0, 0, 0.0
                out["bn"][end] = bn
                end += 1
            at = end
        return pdf.assign(**out), {"theta": theta, "bn": bn, "tib": tib, "bib": bib, "dib": dib}

    return run


def adaptive_bars(kind: str, span: int = 20, kappa: float = 0.02) -> Kernel:
    """Bars whose threshold follows the bars so far; the tick that reaches it closes its own bar.

    The first row's columns et, pb, ed and th start the state, and theta, bn, tib, bib and dib where
    there are any (the bar that a warm-up left open); the anchor is that of each row, as it may change by day.  At a close, dib and drb update et (ticks), pb (share of buys) and
    ed (dollars a tick) by EWMA and set the threshold anew; rwdib updates et and pulls the threshold
    towards the anchor.  Rows get bn, th (in force) and theta, and et, pb, ed as they are after it.
    """
    alpha = 2 / (span + 1)
    mean = lambda old, new: alpha * new + (1 - alpha) * old

    def run(state: State, pdf: pd.DataFrame):
        if state is None:
            state = {k: float(pdf[k].iloc[0]) for k in ("et", "pb", "ed", "th")} | {k: pdf[k].iloc[0].item() if k in pdf else 0 for k in ("theta", "bn", "tib", "bib", "dib")}
        et, pb, ed, th, theta, bn, tib, bib, dib = (state[k] for k in ("et", "pb", "ed", "th", "theta", "bn", "tib", "bib", "dib"))
        out = []
        for sd, buy, dollars, anchor in zip(pdf["sd"].tolist(), (pdf["bt"] > 0).tolist(), pdf["dvol"].tolist(), pdf["anchor"].tolist(), strict=True):
            theta = sd if kind == "drb" and (sd > 0) != (theta > 0) else theta + sd
            tib, bib, dib = tib + 1, bib + buy, dib + dollars
            row = (bn, th, theta)
            if abs(theta) >= th:
                now = mean(et, tib)
                if kind == "rwdib":
                    raw = th * math.sqrt(now / et)
                    th = raw + kappa * (anchor - raw)
                else:
                    pb, ed = mean(pb, bib / tib), mean(ed, dib / tib)
                    th = now * ed * (abs(2 * pb - 1) if kind == "dib" else max(pb, 1 - pb))
                et, theta, bn, tib, bib, dib = now, 0.0, bn + 1, 0, 0, 0.0
            out.append((*row, et, pb, ed))
        cols = dict(zip(("bn", "th", "theta", "et", "pb", "ed"), zip(*out, strict=True), strict=True))
        return pdf.assign(**cols), {"et": et, "pb": pb, "ed": ed, "th": th, "theta": theta, "bn": bn, "tib": tib, "bib": bib, "dib": dib}

    return run


class _Ticks:
    """The signed dollars of a chunk, and the sums of runs of one sign (zero is not positive), each added up
    in order from the run's first tick on."""

    #: Ticks of a bar that are looked at one by one before whole pieces are.
    FEW = 32

    def __init__(self, sd: np.ndarray, kind: str) -> None:
        self.sd, self.each, self.kind, self.n = sd, sd.tolist(), kind, len(sd)
        if kind == "drb":
            up = sd > 0
            starts = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]])) if len(sd) else np.empty(0, np.int64)
            self.stops = np.append(starts[1:], len(sd))
            self.runs = _run_sums(sd, starts, self.stops - starts)

    def search(self, at: int, theta: float, th: float) -> tuple[int, float]:
        """(place, theta) of the first tick from ``at`` on where theta, which is as given before it, reaches
        the threshold, or (n, theta at the end).  Between two closes the threshold stands still."""
        few = min(at + self.FEW, self.n)
        for i in range(at, few):
            x = self.each[i]
            theta = x if self.kind == "drb" and (x > 0) != (theta > 0) else theta + x
            if abs(theta) >= th:
                return i, theta
        at, step = few, 256
        while at < self.n:
            sums = self._sums(at, min(at + step, self.n), theta)
            hit = np.abs(sums) >= th
            if hit.any():
                i = int(hit.argmax())
                return at + i, float(sums[i])
            theta, at, step = float(sums[-1]), at + len(sums), step * 4
        return self.n, theta

    def _sums(self, at: int, stop: int, theta: float) -> np.ndarray:
        if self.kind != "drb":
            return np.cumsum(np.concatenate([[theta], self.sd[at:stop]]))[1:]
        out = self.runs[at:stop].copy()
        run = min(int(self.stops[np.searchsorted(self.stops, at, "right")]), stop)
        same = (self.sd[at] > 0) == (theta > 0)  # the run that ``at`` lies in began with the bar or before
        out[: run - at] = np.cumsum(np.concatenate([[theta], self.sd[at:run]]))[1:] if same else np.cumsum(self.sd[at:run])
        return out


def _run_sums(x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = x.astype(float)
    for s, n in zip(starts[lengths > 64].tolist(), lengths[lengths > 64].tolist(), strict=True):
        out[s : s + n] = np.cumsum(x[s : s + n])
    s, n, d = starts[lengths <= 64], lengths[lengths <= 64], 1
    while len(s := s[n > d]):
        n = n[n > d]
        out[s + d] = out[s + d - 1] + x[s + d]
        d += 1
    return out


def _counted(sd: np.ndarray, tib: int, bib: int, dib: float) -> tuple[int, int, float]:
    """Ticks, buys and dollars after further ticks; dollars are added in order."""
    return tib + len(sd), bib + int(np.count_nonzero(sd > 0)), float(np.cumsum(np.concatenate([[dib], np.abs(sd)]))[-1])


#: What the searches give: a row for each close (closed), and one for the bar that a chunk leaves open.
MARKS = "sym string, bn long, tradeId long, day int, closed boolean, th double, theta double, et double, pb double, ed double, tib long, bib long, dib double"
_MARKS = [c.split()[0] for c in MARKS.split(", ")]
_OPEN = {"bn": 0, "theta": 0.0, "tib": 0, "bib": 0, "dib": 0.0, "et": 0.0, "pb": 0.0, "ed": 0.0}


def bar_marks(kind: str, span: int | None = None, th: float | None = None, kappa: float = 0.02) -> Kernel:
    """Where bars end, found by search in running sums instead of tick by tick (see fixed_bars and
    adaptive_bars for the rules).

    Rows: sym, tradeId, day, sd (signed dollars), start.  The first row of a symbol is no tick: its ``start``
    is the JSON of the state (th, what _OPEN names, and for rwdib with a span ``anchors`` by day); a symbol
    without such a row is passed over.  With ``th`` all begin at this threshold, and no row is needed.
    Without a span the threshold is constant and the tick that reaches it opens the next bar, whose
    number its mark has; with a span thresholds adapt and the tick closes its own bar.
    """
    alpha = 2 / ((span or 1) + 1)
    mean, first = lambda old, new: alpha * new + (1 - alpha) * old, th

    def run(state: State, pdf: pd.DataFrame):
        if state is None and first is not None:
            state = _OPEN | {"th": first}
        elif state is None:
            start = json.loads(pdf["start"].iloc[0] or "{}")
            state, pdf = _OPEN | {k: v for k, v in start.items() if v is not None}, pdf.iloc[1:]
        if not len(pdf) or "th" not in state:
            return pd.DataFrame([], columns=_MARKS), state
        bn, theta, tib, bib, dib, et, pb, ed, th = (state[k] for k in (*_OPEN, "th"))
        sym, ticks, out = pdf["sym"].iloc[0], _Ticks(pdf["sd"].to_numpy(float), kind), []
        ids, days, anchors = pdf["tradeId"].to_numpy(), pdf["day"].to_numpy(), state.get("anchors") or {}
        at = 0
        while at < ticks.n:
            end, theta = ticks.search(at, theta, th)
            if end < ticks.n and span is None:
                bn, theta, tib, bib, dib = bn + 1, 0.0, 0, 0, 0.0
                out.append((sym, bn, ids[end], days[end], True, th, theta, et, pb, ed, tib, bib, dib))
            elif end < ticks.n:
                tib, bib, dib = _counted(ticks.sd[at : end + 1], tib, bib, dib)
                now, was = mean(et, tib), (th, theta)
                if kind == "rwdib":
                    raw = th * math.sqrt(now / et)
                    th = raw + kappa * (anchors[str(days[end])] - raw)
                else:
                    pb, ed = mean(pb, bib / tib), mean(ed, dib / tib)
                    th = now * ed * (abs(2 * pb - 1) if kind == "dib" else max(pb, 1 - pb))
                et = now
                out.append((sym, bn, ids[end], days[end], True, *was, et, pb, ed, tib, bib, dib))
                bn, theta, tib, bib, dib = bn + 1, 0.0, 0, 0, 0.0
            else:
                tib, bib, dib = _counted(ticks.sd[at:], tib, bib, dib)
            at = end + 1
        out.append((sym, bn, ids[-1], days[-1], False, th, theta, et, pb, ed, tib, bib, dib))
        return pd.DataFrame(out, columns=_MARKS), state | dict(zip((*_OPEN, "th"), (bn, theta, tib, bib, dib, et, pb, ed, th), strict=True))

    return run


_ONLINE = ["sym", "kind", "bn", "barstart", "barend", "open", "high", "low", "close", "ticks", "volume", "dollars", "buyPct", "theta", "maxRun", "direction", "threshold", "position"]
ONLINE_SCHEMA = "sym string, kind string, bn long, barstart timestamp_ntz, barend timestamp_ntz, open double, high double, low double, close double, ticks long, volume double, dollars double, buyPct double, theta double, maxRun double, direction int, threshold double, position int"


def online_bars(first: float = 50_000.0, ratio: float = 0.2, floor: float = 1_000.0, sign: str = "tick") -> Kernel:
    """Live imbalance (dib) and run (drb) bars of one stream: the bar closes where the dollar
    imbalance, or else the run of dollars in one direction, reaches the threshold; either closing
    starts all counts again at the same price and time.  Only an imbalance bar moves the threshold
    (EWMA of its imbalance) and the position: more than 65 % bought gives +1, less than 35 % -1.
    Signs come from the tick rule (flat keeps the last, the first is +1) or from buyerIsMaker."""

    def run(state: State, pdf: pd.DataFrame):
        s, out = dict(state or {"last": None, "bt": 1, "th": first, "ratio": ratio, "bn": 0, "position": 0, "start": None, **_EMPTY}), []
        if not len(pdf):
            return pd.DataFrame(out, columns=_ONLINE), s
        price, qty = pdf["price"].to_numpy(float), pdf["qty"].to_numpy(float)
        times = pdf["time"].astype("datetime64[us]").astype("int64").to_numpy()
        ticks = _Live(np.where(pdf["buyerIsMaker"].to_numpy(bool), -1, 1) if sign == "maker" else _tick_signs(price, s["last"], s["bt"]), price * qty)
        if s["start"] is None:
            s |= {"start": int(times[0]), "open": float(price[0]), "high": float(price[0]), "low": float(price[0])}
        sym, at, after = pdf["sym"].iloc[0], 0, lambda first_, values: float(np.cumsum(np.concatenate([[first_], values]))[-1])
        while at < ticks.n:
            th = max(s["th"], floor)
            end, theta, run_ = ticks.search(at, s["theta"], s["run"], s["up"], th)
            part = slice(at, min(end + 1, ticks.n))
            usd = ticks.usd[part]
            s |= {
                "high": max(s["high"], float(price[part].max())), "low": min(s["low"], float(price[part].min())), "n": s["n"] + len(usd), "vol": after(s["vol"], qty[part]), "usd": after(s["usd"], usd),
                "theta": theta, "run": run_, "up": int(ticks.bt[part][-1]), "bought": after(s["bought"], np.where(ticks.bt[part] > 0, usd, 0.0)),
            }
            if end < ticks.n:
                kind, p, time = "dib" if abs(theta) >= th else "drb", float(price[end]), int(times[end])
                pct = 100 * s["bought"] / s["usd"] if s["usd"] > 0 else 50.0
                if kind == "dib":
                    s["position"] = 1 if pct > 65 else -1 if pct < 35 else s["position"]
                    share = abs(theta) / s["usd"] if s["usd"] > 0 else s["ratio"]
                    s["th"], s["ratio"] = 0.02 * (s["usd"] * share) + 0.98 * s["th"], 0.05 * share + 0.95 * s["ratio"]
                out.append((sym, kind, s["bn"], s["start"], time, s["open"], s["high"], s["low"], p, s["n"], s["vol"], s["usd"], pct, theta, run_, s["up"], th, s["position"]))
                s |= {"bn": s["bn"] + 1, "start": time, **_EMPTY, "open": p, "high": p, "low": p}
            at = end + 1
        s |= {"last": float(price[-1]), "bt": int(ticks.bt[-1])}
        rows = pd.DataFrame(out, columns=_ONLINE)
        return rows.assign(barstart=rows["barstart"].astype("datetime64[us]"), barend=rows["barend"].astype("datetime64[us]")), s

    return run


#: The counts of a bar that no tick has reached yet.
_EMPTY = {"open": 0.0, "high": 0.0, "low": 0.0, "n": 0, "theta": 0.0, "run": 0.0, "up": 1, "vol": 0.0, "usd": 0.0, "bought": 0.0}
#: The state of online_bars; ``start`` in microseconds.
ONLINE_STATE = "last double, bt int, th double, ratio double, bn long, position int, start long, open double, high double, low double, n long, theta double, run double, up int, vol double, usd double, bought double"


def _tick_signs(price: np.ndarray, last: float | None, sign: int) -> np.ndarray:
    """+1 after a rise and -1 after a fall of the price; without either the sign before."""
    step = np.sign(np.diff(price, prepend=price[0] if last is None else last)).astype(np.int64)
    moved = np.maximum.accumulate(np.where(step != 0, np.arange(len(step)), -1))
    return np.where(moved >= 0, step[moved], sign)


class _Live(_Ticks):
    """Ticks whose bars close by the imbalance or by a run of one sign, whichever reaches the threshold."""

    def __init__(self, bt: np.ndarray, usd: np.ndarray) -> None:
        self.bt, self.usd, self.sd, self.kind, self.n = bt, usd, bt * usd, "dib", len(bt)
        self.pairs = list(zip(bt.tolist(), usd.tolist(), strict=True))
        starts = np.flatnonzero(np.concatenate([[True], bt[1:] != bt[:-1]]))
        self.stops = np.append(starts[1:], self.n)
        self.runs = _run_sums(usd, starts, self.stops - starts)

    def search(self, at: int, theta: float, run: float, up: int, th: float) -> tuple[int, float, float]:
        few = min(at + self.FEW, self.n)
        for i in range(at, few):
            b, x = self.pairs[i]
            theta, run, up = theta + b * x, run + x if b == up else x, b
            if abs(theta) >= th or run >= th:
                return i, theta, run
        at, step = few, 256
        while at < self.n:
            stop = min(at + step, self.n)
            sums, runs = self._sums(at, stop, theta), self.runs[at:stop].copy()
            end = min(int(self.stops[np.searchsorted(self.stops, at, "right")]), stop)
            runs[: end - at] = np.cumsum(np.concatenate([[run if self.bt[at] == up else 0.0], self.usd[at:end]]))[1:]
            hit = (np.abs(sums) >= th) | (runs >= th)
            i = int(hit.argmax()) if hit.any() else stop - at - 1
            theta, run, up = float(sums[i]), float(runs[i]), int(self.bt[at + i])
            if hit[i]:
                return at + i, theta, run
            at, step = stop, step * 4
        return self.n, theta, run


BARRIER_SCHEMA = "sym string, bn long, close double, sigma double, upperPx double, lowerPx double, hitBn long, up boolean, dn boolean, lastBn long, lastClose double"
_BARRIERS = [c.split()[0] for c in BARRIER_SCHEMA.split(", ")]


def barriers(horizon: int) -> Kernel:
    """Which bar of the next ``horizon`` first touches a bar's upper or lower price.

    Rows in order: sym, bn, high, low, close, sigma, upperPx, lowerPx, end, which marks the symbol's last bar.  Bars that wait stand in a heap by upper and one by lower price and in a queue by age, so a
    bar costs the logarithm of the horizon and not the horizon.  A row is given when it is decided:
    hitBn, up and dn of the touch, or null with the last bar that was seen; without a sigma at once."""

    def run(state: State, pdf: pd.DataFrame):
        s = state or {"i": 0, "up": [], "dn": [], "wait": {}, "first": 0}
        up, dn, wait, out, i, first = s["up"], s["dn"], s["wait"], [], s["i"], s["first"]
        sigmas = pdf["sigma"].isna().tolist()
        cols = [pdf[c].tolist() for c in ("sym", "bn", "high", "low", "close", "sigma", "upperPx", "lowerPx", "end")]
        for none, sym, bn, high, low, close, sigma, upper, lower, end in zip(sigmas, *cols, strict=True):
            for heap, price in ((up, high), (dn, -low)):
                while heap and heap[0][0] <= price:
                    k = heapq.heappop(heap)[1]
                    if (w := wait.pop(k, None)) is not None:
                        out.append((*w, bn, high >= w[4], low <= w[5], bn, close))
            while first < i and (first not in wait or first <= i - horizon):
                if (w := wait.pop(first, None)) is not None:
                    out.append((*w, None, False, False, bn, close))
                first += 1
            if none:
                out.append((sym, bn, close, None, None, None, None, False, False, None, None))
            else:
                wait[i] = (sym, bn, close, sigma, upper, lower)
                heapq.heappush(up, (upper, i))
                heapq.heappush(dn, (-lower, i))
                if len(up) + len(dn) > 4 * len(wait) + 64:  # what is decided leaves the heaps
                    up, dn = ([x for x in h if x[1] in wait] for h in (up, dn))
                    heapq.heapify(up)
                    heapq.heapify(dn)
            if end:
                out += [(*w, None, False, False, *((bn, close) if k < i else (None, None))) for k, w in wait.items()]
                wait.clear()
            i += 1
        rows = pd.DataFrame(out, columns=_BARRIERS)
        return rows.astype({"hitBn": "Int64", "lastBn": "Int64"}), {"i": i, "up": up, "dn": dn, "wait": wait, "first": first}

    return run


_LEVELS = [f"{side}{what}{i}" for side in ("bid", "ask") for what in ("Price", "Qty") for i in range(1, 6)]
BOOK_SCHEMA = "sym string, ord long, eventMs long, isValid boolean, " + ", ".join(f"{c} double" for c in _LEVELS)


def merged(levels: list, updates: list, best_first: bool, depth: int = 5) -> list:
    """Price levels after updates: quantity 0 deletes, a known price changes, a new one is put in
    its place; what falls beyond ``depth`` is forgotten and does not come back."""
    for price, qty in updates:
        rest = [x for x in levels if x[0] != price]
        if qty and not (len(rest) == len(levels) and len(levels) == depth and (price < levels[-1][0] if best_first else price > levels[-1][0])):
            rest.append((price, qty))
        levels = sorted(rest, reverse=best_first)[:depth]
    return levels


def order_book(heartbeat_ms: int = 50) -> Kernel:
    """Level-5 quotes from snapshots and deltas in order of arrival.

    Rows: sym, ord, kind (snapshot or delta), firstId, finalId, eventMs, bids, asks (lists of
    [price, qty]).  Before a snapshot deltas are kept and then replayed up to the first that fails.
    A gap publishes one invalid row of zeros and starts over.  A quote is published if it is the
    first, changes validity or a level, or heartbeat_ms after the last."""

    def fit(s: dict, first: int, final: int) -> str:
        if s["state"] == "syncing":
            return "gap" if first > s["snap"] + 1 else "stale" if final < s["snap"] + 1 else "apply"
        return "stale" if final < s["last"] else "gap" if first > s["last"] + 1 else "apply"

    def apply(s: dict, r: dict) -> bool:
        what = fit(s, r["firstId"], r["finalId"])
        if what == "apply":
            s |= {"bids": merged(s["bids"], r["bids"], True), "asks": merged(s["asks"], r["asks"], False), "last": r["finalId"], "state": "valid"}
        return what != "gap"

    def run(state: State, pdf: pd.DataFrame):
        empty = {"state": "init", "snap": 0, "last": 0, "bids": [], "asks": [], "kept": []}
        s, out = dict(state or empty | {"shown": None, "at": 0}), []
        pairs = lambda x: [(float(a), float(b)) for a, b in (x if x is not None else [])]

        def publish(r: dict, valid: bool) -> None:
            side = lambda x: [v[k] for k in (0, 1) for v in (x + [(0.0, 0.0)] * 5)[:5]]
            row = (valid, *(side(s["bids"]) + side(s["asks"]) if valid else [0.0] * 20))
            if s["shown"] is None or s["shown"][0] != valid or valid and (row != s["shown"] or r["eventMs"] - s["at"] >= heartbeat_ms):
                out.append((r["sym"], r["ord"], r["eventMs"], *row))
                s["shown"], s["at"] = row, r["eventMs"]

        def fail(r: dict) -> None:
            publish(r, False)
            s.update(empty)

        for r in pdf.to_dict("records"):
            r |= {"bids": pairs(r["bids"]), "asks": pairs(r["asks"])}
            if r["kind"] == "snapshot":
                if s["state"] != "init":
                    continue
                kept = s["kept"]
                s |= {"state": "syncing", "snap": r["finalId"], "last": r["finalId"], "bids": merged([], r["bids"], True), "asks": merged([], r["asks"], False), "kept": []}
                if not all(apply(s, k) for k in kept):
                    fail(r)
                elif s["state"] == "valid":
                    publish(r, True)
            elif s["state"] == "init":
                s["kept"] = [*s["kept"], {k: r[k] for k in ("firstId", "finalId", "bids", "asks")}]
            elif not apply(s, r):
                fail(r)
            elif s["state"] == "valid":
                publish(r, True)
        return pd.DataFrame(out, columns=["sym", "ord", "eventMs", "isValid", *_LEVELS]), s

    return run
