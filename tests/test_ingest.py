"""Sources, store, logs and streams by their registered queries on a small table, each held to its SQL."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from tidemark.plans import QUERIES, SQL
from tidemark.plans.ingest import scratch

DAYS, N = 6, 900


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """events of six days with ties in time and repeated values, and orders; as files of their names."""
    root, rng = tmp_path_factory.mktemp("ingest"), random.Random(7)
    at = dt.datetime(2024, 1, 1)
    times = sorted(at + dt.timedelta(seconds=rng.randrange(DAYS * 86_400), microseconds=rng.randrange(3) * 333) for _ in range(N))
    kinds = ("click", "view", "signup", "purchase", "error")
    events = pd.DataFrame({"event_id": range(N), "ts": pd.Series(times).astype("datetime64[us]"), "user_id": 1, "event_type": [rng.choice(kinds) for _ in range(N)], "value": [rng.randrange(1, 9000) / 100 for _ in range(N)], "props": [f'{{"k": {rng.randrange(100)}}}' for _ in range(N)]})
    orders = pd.DataFrame({"o_orderkey": range(1, 3000, 7), "o_custkey": [i % 997 for i in range(1, 3000, 7)]})
    events.to_parquet(root / "events.parquet", index=False)
    orders.to_parquet(root / "orders.parquet", index=False)
    return str(root)


def as_rows(df):
    return sorted(tuple(None if pd.isna(v) else str(v) if isinstance(v, pd.Timestamp) else v for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


NAMES = [
    "json_trades", "json_rejects", "json_depth", "csv_archives", "store_load", "store_counts", "store_order", "load_dates", "log_check", "durable_log", "stamped_log", "recovered_sequence",
    "stream_windows", "stream_distinct", "stream_fan_out", "stream_days_ema", "stream_state", "end_of_day", "retention", "formatted", "book_replay", "latency_percentiles", "handler_view", "latency_view",
]


@pytest.mark.parametrize("name", NAMES)
def test_equals_its_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("events", "orders"):
        con.execute(f"create view {t} as select * from '{tables}/{t}.parquet'")
    got, want = QUERIES[name](spark, tables).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(want)
    assert as_rows(got) == as_rows(want)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(far, "x")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_ranks_sort_only_the_cells_they_fall_into(spark):
    """Values of any sign, nulls, ties; the plan sorts values by cell, never by group alone."""
    from pyspark.sql import functions as F

    from tidemark.functions.semantics import nearest_ranks

    rng = random.Random(3)
    data = [("a", 1.7e12 + rng.randrange(10_000)) for _ in range(3000)] + [("b", rng.gauss(0, 50)) for _ in range(501)] + [("c", 2.0)] * 7 + [(None, float(x)) for x in (-3, 1, 1)] + [("d", None)] * 2
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r for r in nearest_ranks(df, ("g",), {"x": "x"}, {"P0": 0.0, "P50": 0.5, "P95": 0.95, "P100": 1.0}).collect()}
    for g in ("a", "b", "c", None):
        v = sorted(x for k, x in data if k == g)
        at = lambda p: v[int(p * (len(v) - 1) + 0.5)]  # noqa: B023, E731
        assert (got[g].xP0, got[g].xP50, got[g].xP95, got[g].xP100, got[g].xMax, got[g].cnt) == (v[0], at(0.5), at(0.95), v[-1], v[-1], len(v))
    assert (got["d"].xP50, got["d"].xMax, got["d"].cnt) == (None, None, 2)
    plan = nearest_ranks(df.where(F.col("g") == "a"), ("g",), {"x": "x"}, {"P50": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Window" in line and "v#" in line.split("windowspecdefinition")[-1].split("specifiedwindowframe")[0]]
    assert sorts and all("cell#" in line for line in sorts)


def test_schema_status(spark):
    from tidemark.plans.serving import schema_status
    from tidemark.schemas import fields

    want, df = fields("sym:s n:j"), spark.createDataFrame([("a", 1)], "sym string, n int")
    got = schema_status(spark, {"good": (df.withColumn("n", df.n.cast("long")), want), "bad": (df, want), "none": (df.limit(0), want)}).collect()
    assert [(r.table, r.validated, r.valid, r.expectedFields, r.amiss) for r in got] == [("good", True, True, 2, []), ("bad", True, False, 2, ["n"]), ("none", False, True, 2, ["n"])]


def test_streams_of_days_hold_a_day_of_a_symbol_at_a_time(spark, tables):
    """The state of both queries' stream is keyed by symbol and day, so no call gets a symbol's whole history."""
    from tidemark.plans.ingest import _day_stream

    rows, checkpoint = _day_stream(spark, tables)
    assert rows.count() == N
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").load()
    assert state.select("key.*").columns == ["sym", "day_"] and 0 < state.count() <= 5 * 2
