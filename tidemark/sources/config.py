"""Settings of the sources, from a JSON file with defaults."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path


@dataclass(frozen=True)
class Market:
    host: str = "stream.example"
    port: str = "9443"
    stream_suffix: str = "@trade"
    tp_table: str = "trade"
    schema: str = "spot_trade"


@dataclass(frozen=True)
class Router:
    host: str = "localhost"
    port: int = 5010


@dataclass(frozen=True)
class Reconnect:
    initial_backoff_ms: int = 1000
    max_backoff_ms: int = 8000


@dataclass(frozen=True)
class Logging:
    level: str = "info"
    file: str = ""


@dataclass(frozen=True)
class Config:
    symbols: list[str] = field(default_factory=list)
    market: Market = Market()
    tickerplant: Router = Router()
    reconnect: Reconnect = Reconnect()
    logging: Logging = Logging()


def _filled(cls, given: dict):
    """Known names only, and values of the defaults' kinds; what is left out keeps its default."""
    out, default = {}, cls()
    for f in fields(cls):
        if f.name in given:
            now, old = given[f.name], getattr(default, f.name)
            if is_dataclass(old) != isinstance(now, dict) or not is_dataclass(old) and not isinstance(now, type(old)):
                raise TypeError(f"{f.name} is {type(now).__name__}")
            out[f.name] = _filled(type(old), now) if is_dataclass(old) else now
    return cls(**out)


def load(text: str) -> Config:
    """From the text of a JSON object."""
    return _filled(Config, json.loads(text))


def read(path: str) -> Config:
    return load(Path(path).read_text())
