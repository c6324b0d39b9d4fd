"""Event-driven backtests: a strategy sees one ordered stream of trades and funding events.

Spark parallelises over runs (a strategy with its parameters) and deals the sort of events by slices; a run
itself depends on its path and is one ordered scan with bounded memory.  The result is an audit of fills, rejections, funding and
policy actions; report() sums it up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from importlib import import_module
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import State, sliced_scan

# Basis points and limits of the simulated venue.
TAKER_BPS, HALF_SPREAD_BPS, KILL_AT, STOP_AT = 5.0, 0.5, 0.10, 0.02
CAPS = {"BTCUSDT": 1.0, "ETHUSDT": 10.0, "SOLUSDT": 200.0}
AUDIT = "run string, ord long, time timestamp_ntz, sym string, event string, qty double, price double, fee double, reason string, position double, cost double, realized double, fees double, funding double, mark double"


class Strategy(Protocol):
    """on_trade returns the state and intents (action, qty) with action buy, sell or flatten.

    A strategy may also have on_fill(state, fill) and on_funding(state, event), which return the
    state, and on_timer(state, time), which returns the state and intents (action, qty, sym); fill
    and event are dicts.
    """

    def init(self) -> dict: ...

    def on_trade(self, state: dict, sym: str, price: float, position: float) -> tuple[dict, list[tuple[str, float]]]: ...


def load_strategy(name: str, parameters: dict | None = None) -> Strategy:
    """``package.module:Class`` made with the parameters; init and on_trade must be there."""
    module, _, cls = name.partition(":")
    strategy = getattr(import_module(module), cls)(**(parameters or {}))
    for needed in ("init", "on_trade"):
        if not callable(getattr(strategy, needed, None)):
            raise TypeError(f"{name} has no {needed}")
    return strategy


def inferred(value: str) -> int | float | str:
    """A word of a command line as a long if it reads back unchanged, else a float, else itself."""
    try:
        if str(int(value)) == value:
            return int(value)
    except ValueError:
        pass
    try:
        return float(value)
    except ValueError:
        return value


#: Flags of the runner; all others are the strategy's parameters.
RUNNER_FLAGS = {"-strategy": "strategy", "-ns": "namespace", "-sym": "sym", "-start": "start", "-end": "end", "-table": "table", "-hdb": "hdb"}


def parse_arguments(args: list[str]) -> tuple[dict[str, str], dict[str, int | float | str]]:
    """(the runner's options, the strategy's parameters) of ``-flag value`` pairs."""
    runner, parameters = {}, {}
    for i in range(0, len(args), 2):
        if i + 1 >= len(args):
            raise ValueError(f"missing value for {args[i]}")
        if not args[i].startswith("-"):
            raise ValueError(f"unexpected argument (no leading dash): {args[i]}")
        if args[i] in RUNNER_FLAGS:
            runner[RUNNER_FLAGS[args[i]]] = args[i + 1]
        else:
            parameters[args[i][1:]] = inferred(args[i + 1])
    return runner, parameters


@dataclass(frozen=True)
class Momentum:
    """Long or flat by the crossing of two EMAs, from the 2 slow-th trade of a symbol on."""

    fast: int = 12
    slow: int = 26
    qty: float = 0.1

    def init(self) -> dict:
        return {}

    def on_trade(self, state: dict, sym: str, price: float, position: float):
        f, s, n = state.get(sym, (price, price, 0))
        a, b = 2 / (1 + self.fast), 2 / (1 + self.slow)
        f, s, n = a * price + (1 - a) * f, b * price + (1 - b) * s, n + 1
        intents = []
        if n >= 2 * self.slow:
            if f > s and position <= 0:
                intents = [("buy", self.qty)]
            elif f < s and position > 0:
                intents = [("flatten", 0.0)]
        return state | {sym: (f, s, n)}, intents


@dataclass
class Position:
    qty: float = 0.0
    cost: float = 0.0
    realized: float = 0.0
    fees: float = 0.0
    funding: float = 0.0
    mark: float = 0.0

    def fill(self, qty: float, price: float, fee: float) -> None:
        """Opening and adding average the cost, reducing realises, flipping does both."""
        if self.qty * qty >= 0:
            total = self.qty + qty
            self.cost = (self.cost * self.qty + price * qty) / total if total else 0.0
        else:
            closed = min(abs(qty), abs(self.qty))
            self.realized += closed * (price - self.cost) * (1 if self.qty > 0 else -1)
            if abs(qty) > abs(self.qty):
                self.cost = price
        self.qty, self.fees, self.mark = self.qty + qty, self.fees + fee, price

    @property
    def unrealized(self) -> float:
        return (self.mark - self.cost) * self.qty

    @property
    def net(self) -> float:
        return self.realized + self.unrealized - self.fees - self.funding


def fill_price(price: float, buy: bool) -> float:
    half = price * HALF_SPREAD_BPS / 10_000
    return price + half if buy else price - half


def fee(notional: float, bps: float = TAKER_BPS, discount: float = 0.0) -> float:
    return notional * (bps * (100 - discount) / 100) / 10_000


def pretrade(action: str, qty: float, position: float, cap: float | None, killed: bool) -> tuple[float, str]:
    """The signed quantity that may be traded, and why it is 0: the cap binds the projected position."""
    if action == "flatten":
        return (-position, "") if position else (0.0, "noPosition")
    if killed:
        return 0.0, "killSwitch"
    if cap is None:
        return 0.0, "unknownSymbol"
    signed = qty if action == "buy" else -qty
    if abs(position + signed) <= cap:
        return signed, ""
    room = cap - position if action == "buy" else cap + position
    return (room if action == "buy" else -room, "") if room > 0 else (0.0, "atCap")


@dataclass
class Account:
    strategy: Strategy
    caps: dict[str, float] | None
    initial: float
    stop_loss: bool = True
    every: pd.Timedelta | None = None
    timer: pd.Timestamp | None = None
    book: dict[str, Position] = field(default_factory=dict)
    state: dict | None = None
    killed: bool = False
    out: list[tuple] = field(default_factory=list)

    def note(self, r: dict, event: str, qty: float, price: float, paid: float, reason: str) -> None:
        p = self.book[r["sym"]]
        self.out.append((r["run"], r["ord"], r["time"], r["sym"], event, qty, price, paid, reason, p.qty, p.cost, p.realized, p.fees, p.funding, p.mark))

    def trade(self, r: dict, action: str, qty: float, reason: str = "") -> None:
        p = self.book[r["sym"]]
        cap = 1e18 if self.caps is None else self.caps.get(r["sym"])
        signed, no = pretrade(action, qty, p.qty, cap, self.killed)
        if no:
            self.note(r, "reject", qty, r["price"], 0.0, no)
            return
        price = fill_price(r["price"], signed > 0)
        paid = fee(abs(signed) * price)
        p.fill(signed, price, paid)
        self.note(r, "fill", signed, price, paid, reason or action)
        self.call("on_fill", {"sym": r["sym"], "qty": signed, "price": price, "fee": paid, "source": reason or "strategy"})

    def call(self, name: str, event: dict) -> None:
        if hasattr(self.strategy, name):
            self.state = getattr(self.strategy, name)(self.state, event)

    def policies(self, r: dict) -> None:
        """The kill switch over all positions, once, or else the stop-loss of the row's."""
        p = self.book[r["sym"]]
        equity = self.initial + sum(x.net for x in self.book.values())
        if not self.killed and 1 - equity / self.initial >= KILL_AT:
            self.killed = True
            for sym, x in self.book.items():
                if x.qty:
                    self.trade(r | {"sym": sym, "price": x.mark}, "flatten", 0.0, "killSwitch")
        elif self.stop_loss and p.qty and p.unrealized <= -STOP_AT * abs(p.qty) * p.cost:
            self.trade(r, "flatten", 0.0, "stopLoss")

    def tick(self, r: dict) -> None:
        """The timers that are due before the row's time, each at its own."""
        if self.every is None:
            return
        if self.timer is None:
            self.timer = r["time"] + self.every
        while self.timer < r["time"]:
            at = r | {"time": self.timer}
            self.timer += self.every
            if hasattr(self.strategy, "on_timer"):
                self.state, intents = self.strategy.on_timer(self.state, at["time"])
                for action, qty, sym in intents:
                    if sym in self.book and self.book[sym].mark:
                        self.trade(at | {"sym": sym, "price": self.book[sym].mark}, action, qty)
            for sym, p in list(self.book.items()):
                if p.mark:
                    self.policies(at | {"sym": sym, "price": p.mark})

    def on_event(self, r: dict) -> None:
        if self.state is None:
            self.state = self.strategy.init()
        self.tick(r)
        p = self.book.setdefault(r["sym"], Position())
        if r["kind"] == 0:
            mark = r["mark"] if r["mark"] == r["mark"] and r["mark"] is not None else p.mark
            paid = abs(p.qty) * mark * r["rate"] * (1 if p.qty > 0 else -1 if p.qty < 0 else 0)
            p.funding += paid
            if p.qty:
                self.note(r, "funding", p.qty, mark, paid, "")
            self.call("on_funding", {"sym": r["sym"], "time": r["time"], "rate": r["rate"], "mark": mark, "paid": paid})
            return
        p.mark = r["price"]
        self.state, intents = self.strategy.on_trade(self.state, r["sym"], r["price"], p.qty)
        for action, qty in intents:
            self.trade(r, action, qty)
        self.policies(r)


def run(trades: DataFrame, funding: DataFrame, strategies: dict[str, Strategy], caps: dict[str, float] | None = None, initial: float = 100_000.0, compat: bool = False, timer: timedelta | None = None, by_symbol: bool = False) -> DataFrame:
    """The audit (AUDIT) of each named strategy over trades (time, sym, tradeId, price) and funding
    (sym, fundingTime, fundingRate, markPrice; null marks stand for the last price).

    Funding that falls between two trades comes before the second, at its own time.  Without caps
    every symbol may be traded freely.  compat switches the stop-loss off, which the reference's
    own code never fires.  With ``timer``, on_timer and the policies also run at that cadence of
    the stream's own time, from the first event on and in order with funding.  by_symbol gives each
    symbol an account of its own, and so a task of its own: for strategies and policies that look at
    one symbol only.  More than scan.SLICE events are scanned slice by slice when this is called; accounts,
    with the strategies and their states, are pickled from slice to slice.
    """

    def kernel(state: State, pdf: pd.DataFrame):
        account = (state or {}).get("account") or Account(strategies[pdf["run"].iloc[0]], caps, initial, not compat, None if timer is None else pd.Timedelta(timer))
        for r in pdf.to_dict("records"):
            account.on_event(r)
        out, account.out = account.out, []
        return pd.DataFrame(out, columns=[c.split()[0] for c in AUDIT.split(", ")]), {"account": account}

    none = F.lit(None).cast("double")
    events = trades.select(F.col("time").cast("timestamp_ntz").alias("time"), F.lit(1).alias("kind"), "sym", F.col("tradeId").alias("ord"), "price", none.alias("rate"), none.alias("mark"))
    events = events.unionByName(funding.select(F.col("fundingTime").cast("timestamp_ntz").alias("time"), F.lit(0).alias("kind"), "sym", F.lit(-1).cast("long").alias("ord"), none.alias("price"), F.col("fundingRate").alias("rate"), F.col("markPrice").alias("mark")))
    by_run = lambda rows: rows.withColumn("run", F.explode(F.array(*map(F.lit, strategies))))
    return sliced_scan(events, ["run", "sym"] if by_symbol else ["run"], ["time", "kind", "sym", "ord"], kernel, AUDIT, by_run)


def report(audit: DataFrame, initial: float = 100_000.0) -> DataFrame:
    """By run: fills, rejections, realised, fees, funding, net and equity (open positions at their last mark in the audit)."""
    last = audit.groupBy("run", "sym").agg(F.max_by(F.struct("position", "cost", "realized", "fees", "funding", "mark"), F.struct("time", "ord")).alias("p"), F.count_if(F.col("event") == "fill").alias("fills"), F.count_if(F.col("event") == "reject").alias("rejections"))
    sums = last.groupBy("run").agg(F.sum("fills").alias("fills"), F.sum("rejections").alias("rejections"), *(F.sum(f"p.{c}").alias(c) for c in ("realized", "fees", "funding")), F.sum((F.col("p.mark") - F.col("p.cost")) * F.col("p.position")).alias("unrealized"))
    return sums.withColumn("net", F.col("realized") - F.col("fees") - F.col("funding")).withColumn("equity", F.lit(initial) + F.col("net") + F.col("unrealized"))
