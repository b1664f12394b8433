"""Aggregates of the user's own: create, add, merge, extract.

An accumulator says how to begin a state, add a value to it, merge two states and read the
result.  It runs in three steps, each a pass over Arrow batches:

1. Each task adds its rows to a state per key.  Beyond ``held`` keys the states go out, and
   the task begins anew.
2. Serialised states are shuffled by key and salt, sorted, and merged one after another.
3. What is left, at most one state per key and salt, is shuffled by key, merged and read.

A task holds one state at a time in the last two steps, and a key with a third of the rows
has its states merged in as many tasks as there are salts.  Merging must not depend on the
order of the states.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

STATE, SALT = "_state", "_salt"
SALTS = 16
HELD = 10_000

Batches = Iterator[pa.RecordBatch]


class Accumulator(Protocol):
    """States must survive pickling; ``merge`` may change and return its first argument."""

    def create(self) -> Any: ...

    def add(self, state: Any, value: Any) -> Any: ...

    def merge(self, left: Any, right: Any) -> Any: ...

    def extract(self, state: Any) -> Any: ...


class Mean:
    """Sum and count; the mean of nothing is NaN."""

    def create(self):
        return 0, 0

    def add(self, state, value):
        return state if value is None else (state[0] + value, state[1] + 1)

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def extract(self, state):
        return state[0] / state[1] if state[1] else float("nan")


class Longest:
    """The ``k`` longest different texts, alphabetical among equals; not a sum of anything."""

    def __init__(self, k: int):
        self.k = k

    def create(self):
        return []

    def _best(self, texts):
        return sorted(texts, key=lambda t: (-len(t), t))[: self.k]

    def add(self, state, value):
        if value is None or value in state:
            return state
        if len(state) == self.k and len(value) < len(state[-1]):
            return state
        return self._best([*state, value])

    def merge(self, left, right):
        return self._best({*left, *right})

    def extract(self, state):
        return state


def _partial(accumulator: Accumulator, keys: int, held: int, salts: int) -> Callable:
    """The states of a task's rows: the last column is the value, the others the key."""

    def run(batches: Batches) -> Batches:
        salt = TaskContext.get().partitionId() % salts
        states: dict[tuple, Any] = {}
        schema = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*states)) if keys else []
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
            packed = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
            salted = pa.array([salt] * len(states), pa.int32())
            names = [*schema.names[:keys], STATE, SALT]
            return pa.RecordBatch.from_arrays([*arrays, packed, salted], names)

        for batch in batches:
            schema = batch.schema
            columns = [c.to_pylist() for c in batch.columns]
            for *key, value in zip(*columns):
                key = tuple(key)
                state = states[key] if key in states else accumulator.create()
                states[key] = accumulator.add(state, value)
            if len(states) > held:
                yield out()
                states.clear()
        if states:
            yield out()

    return run


def _merged(accumulator: Accumulator, keys: int, names: list[str], done: pa.DataType | None) -> Callable:
    """One row per run of equal keys: the merged state, or with ``done`` the result."""

    def run(batches: Batches) -> Batches:
        key, state, rows = None, None, []
        schema = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(c, f.type) for c, f in zip(columns[:-1], schema)]
            if done is None:
                last = pa.array([pickle.dumps(s) for s in columns[-1]], pa.binary())
            else:
                last = pa.array([accumulator.extract(s) for s in columns[-1]], done)
            return pa.RecordBatch.from_arrays([*arrays, last], names)

        for batch in batches:
            schema = batch.schema
            columns = [c.to_pylist() for c in batch.columns]
            for *own, packed in zip(*columns):
                fresh, own = pickle.loads(packed), tuple(own)
                if own == key:
                    state = accumulator.merge(state, fresh)
                    continue
                if key is not None:
                    rows.append((*key, state))
                key, state = own, fresh
            if rows:
                yield out()
                rows = []
        if key is not None:
            rows.append((*key, state))
            yield out()

    return run


def accumulated(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    accumulator: Accumulator,
    result: T.DataType,
    name: str = "result",
    salts: int = SALTS,
    held: int = HELD,
    defaults: bool = True,
) -> DataFrame:
    """The accumulator's result per key; without keys as one row.

    Without keys the result of an empty state stands for no rows, unless ``defaults`` is off.
    Values of a key column must be equal to themselves and hashable.
    """
    keys = list(keys)
    rows = df.select(*keys, value)
    fields = [rows.schema[k] for k in keys]
    state, salt = T.StructField(STATE, T.BinaryType()), T.StructField(SALT, T.IntegerType())
    partial = rows.mapInArrow(
        _partial(accumulator, len(keys), held, salts), T.StructType([*fields, state, salt])
    )
    if not keys and defaults:
        spark = df.sparkSession
        empty = spark.createDataFrame([(pickle.dumps(accumulator.create()), 0)], partial.schema)
        partial = partial.unionByName(empty)
    by_salt = partial.repartition(*keys, SALT).sortWithinPartitions(*keys, SALT)
    merged = by_salt.select(*keys, SALT, STATE).mapInArrow(
        _merged(accumulator, len(keys) + 1, [*keys, SALT, STATE], None),
        T.StructType([*fields, salt, state]),
    )
    by_key = merged.repartition(*keys) if keys else merged.repartition(1)
    ordered = by_key.sortWithinPartitions(*keys) if keys else by_key
    return ordered.select(*keys, STATE).mapInArrow(
        _merged(accumulator, len(keys), [*keys, name], to_arrow_type(result)),
        T.StructType([*fields, T.StructField(name, result)]),
    )
