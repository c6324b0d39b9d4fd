"""Order-dependent operators as ordered scans.

A kernel is a function (state, chunk) -> (rows, state) over the rows of one key in order; the
state is a small dict.  ordered_scan() sorts each key's rows within its partition and feeds them to
the kernel in Arrow batches, so a key of any length needs the memory of a batch.  sliced_scan() does the
same slice by slice where one key has all rows, whose sort would otherwise be one task's.
streaming.stateful runs the same kernels over micro-batches, with the state in Spark's state store.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from ..sources.shared import scratch

State = dict | None
Kernel = Callable[[State, pd.DataFrame], tuple[pd.DataFrame, dict]]


def _runs(pdf: pd.DataFrame, keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Consecutive rows of equal keys; sorted rows whose ends agree are of one key."""
    first, last = (tuple(pdf[keys].iloc[i]) for i in (0, -1)) if len(pdf) else (None, None)
    if len(pdf) and first == last:
        yield first, pdf
    elif len(pdf):
        marks = (pdf[keys].fillna("\0") != pdf[keys].fillna("\0").shift()).any(axis=1).cumsum()
        for _, part in pdf.groupby(marks.to_numpy(), sort=False):
            yield tuple(part[keys].iloc[0]), part.reset_index(drop=True)


def chained(*kernels: Kernel) -> Kernel:
    """Several kernels over the same rows in one scan, each adding its columns."""

    def run(state: State, pdf: pd.DataFrame):
        states = (state or {}).get("each") or [None] * len(kernels)
        for i, kernel in enumerate(kernels):
            pdf, states[i] = kernel(states[i], pdf)
        return pdf, {"each": states}

    return run


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], kernel: Kernel, schema: StructType | str) -> DataFrame:
    """The kernel's rows for each key, in order within the key.  ``order`` must be total."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in frames:
            for key, part in _runs(pdf, keys):
                if key != current:
                    current, state = key, None
                out, state = kernel(state, part)
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


#: Rows of a slice.
SLICE = 1_000_000


def sliced_scan(df: DataFrame, keys: list[str], order: list[str], kernel: Kernel, schema: str, spread: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ordered_scan() of spread(df), whose rows may all have one key.  ``spread`` works row by row, such as an
    explode that adds keys; ``order`` is of columns of df and total.

    More than SLICE rows are dealt by ranges of ``order`` to slices of about as many, written to the shared
    folder, and scanned slice after slice when this is called: a slice begins with the states that the one
    before it left, as seed rows before the rows of their keys.  A task sorts one slice, whatever the number
    of rows.  States are pickled between slices."""
    n = math.ceil(df.count() / SLICE)
    if n <= 1:
        return ordered_scan(spread(df), keys, order, kernel, schema)
    spark, path = df.sparkSession, scratch(df.sparkSession, "slices")
    df.repartitionByRange(n, *order).withColumn("slice_", F.spark_partition_id()).write.partitionBy("slice_").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    slices = sorted(r.slice_ for r in stored.select("slice_").distinct().collect())
    names = StructType.fromDDL(schema).names
    types, seeds = spread(stored).schema, None
    both = StructType(StructType.fromDDL(schema).fields)
    for k in keys:
        both = both.add(f"seed_{k}", types[k].dataType)
    both = both.add("seed_", BinaryType())

    def seed(key: tuple, state: State) -> pd.DataFrame:
        return pd.DataFrame([dict.fromkeys(names) | {f"seed_{k}": v for k, v in zip(keys, key)} | {"seed_": cloudpickle.dumps(state)}], dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for pdf in frames:
            for key, part in _runs(pdf, keys):
                if key != current:
                    if current is not None:
                        yield seed(current, state)
                    current, state = key, None
                if part["seed_"].iloc[0] is not None:
                    state, part = pickle.loads(part["seed_"].iloc[0]), part.iloc[1:]
                if len(part):
                    out, state = kernel(state, part.drop(columns="seed_").reset_index(drop=True))
                    yield out.assign(**{c: None for c in both.names[len(names) :]})
        if current is not None:
            yield seed(current, state)

    for at in slices:
        rows = spread(stored.where(F.col("slice_") == at).drop("slice_")).withColumn("seed_", F.lit(None).cast("binary"))
        rows = rows if seeds is None else rows.unionByName(seeds, allowMissingColumns=True)
        rows.repartition(*keys).sortWithinPartitions(*keys, F.col("seed_").isNull(), *order).mapInPandas(run, both).write.parquet(f"{path}/out/{at}")
        seeds = spark.read.schema(both).parquet(f"{path}/out/{at}").where("seed_ is not null").select(*(F.col(f"seed_{k}").alias(k) for k in keys), "seed_")
    return spark.read.schema(both).parquet(*(f"{path}/out/{at}" for at in slices)).where("seed_ is null").select(*names)


def kept(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder that all executors share (spark.checkpoint.dir) and read from
    there: its scan runs once, and a lost executor costs no other.  For small results."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", f"file:/tmp/checkpoints/{sc.applicationId}"))
    return df.checkpoint()
