"""A user's own aggregates with partial results: create, add, merge, result.

Every task reduces its rows to one accumulator per key before anything is shuffled. Accumulators are merged in two levels, first per key and
salt and then per key, in order of the key, so a task holds two accumulators at a time however many there are of a key. A key with a
third of all rows is one accumulator per task from the start.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

STATE = "__state"
OPEN_KEYS = 100_000


class UserAggregate:
    """What a user's aggregate says. Accumulators are any values that pickle; ``add`` gets the rows of one key that a batch holds, and ``merge``
    must give the same result in any order."""

    def create(self):
        raise NotImplementedError

    def add(self, state, rows: pd.DataFrame):
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, state) -> tuple:
        raise NotImplementedError


def _same(a: tuple, b: tuple) -> bool:
    """Whether two keys are equal as a group, where NULL equals NULL and NaN equals NaN."""
    return all(x == y or (x is None and y is None) or (x != x and y != y) for x, y in zip(a, b, strict=True))


def _group(key: tuple) -> tuple:
    return tuple("\0nan" if k is not None and k != k else k for k in key)


def aggregate_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str], aggregate: UserAggregate, result: str, salts: int = 64) -> DataFrame:
    """One row per key with the columns of ``result``, a DDL of what ``aggregate.result`` returns. Without keys there is one row, also for no rows."""
    keys, columns = list(keys), list(columns)
    schema = df.select(*keys).schema
    partial = T.StructType([*schema.fields, T.StructField(STATE, T.BinaryType())])
    final = T.StructType([*schema.fields, *T._parse_datatype_string(result).fields])
    partial_arrow, final_arrow = to_arrow_schema(partial), to_arrow_schema(final)
    n = len(keys)

    def batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_keys: dict[tuple, list] = {}
        for rows in batches:
            values = list(zip(*[rows.column(i).to_pylist() for i in range(n)], strict=True)) if n else [()] * rows.num_rows
            groups: dict[tuple, list[int]] = {}
            for place, key in enumerate(values):
                groups.setdefault(_group(key), []).append(place)
            # The rows of a key are put beside each other once, so that each key is a slice of the batch.
            order = [place for places in groups.values() for place in places]
            frame = pa.Table.from_batches([rows]).to_pandas()[columns].take(order)
            low = 0
            for name, places in groups.items():
                held = open_keys.setdefault(name, [values[places[0]], aggregate.create()])
                held[1] = aggregate.add(held[1], frame.iloc[low : low + len(places)])
                low += len(places)
            if len(open_keys) > OPEN_KEYS:
                yield batch([(*key, pickle.dumps(state)) for key, state in open_keys.values()], partial_arrow)
                open_keys = {}
        yield batch([(*key, pickle.dumps(state)) for key, state in open_keys.values()], partial_arrow)

    def merged(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> tuple:
            return (*current, *aggregate.result(state)) if last else (*current, pickle.dumps(state))

        for rows in batches:
            done, names = [], [rows.column(i).to_pylist() for i in range(n + 1)]
            for *key, packed in zip(*names, strict=True):
                if current is not None and _same(tuple(key), current):
                    state = aggregate.merge(state, pickle.loads(packed))
                    continue
                if current is not None:
                    done.append(row())
                current, state = tuple(key), pickle.loads(packed)
            yield batch(done, final_arrow if last else partial_arrow)
        if current is not None:
            yield batch([row()], final_arrow if last else partial_arrow)
        elif last and not n:
            yield batch([aggregate.result(aggregate.create())], final_arrow)

    parts = df.select(*keys, *[c for c in columns if c not in keys]).mapInArrow(reduced, partial)
    salted = parts.withColumn("__salt", F.pmod(F.xxhash64(STATE), F.lit(salts)))
    first = salted.repartition(*keys, "__salt").sortWithinPartitions(*keys, "__salt").select(*keys, STATE)
    halfway = first.mapInArrow(lambda b: merged(b, False), partial)
    gathered = halfway.repartition(*keys).sortWithinPartitions(*keys) if keys else halfway.coalesce(1)
    return gathered.mapInArrow(lambda b: merged(b, True), final)
