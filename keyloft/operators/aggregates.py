"""Aggregates of the user's own: steps that begin, update, merge and end a state.

Each task updates the states of its rows' groups and gives a row for each group; only those states are
shuffled and merged, so that a group with very many rows costs no more than one row a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: A task that has seen so many groups gives their states away and begins anew.
MOST_GROUPS = 100_000


@dataclass(frozen=True)
class Aggregate:
    """state and result are DDL types; a state is a tuple. final may be left out: then the state's first field is the result."""

    state: str
    result: str
    begin: Callable[[], tuple]
    update: Callable[..., tuple]
    merge: Callable[[tuple, tuple], tuple]
    final: Callable[[tuple], Any] = lambda state: state[0]


REGISTRY: dict[str, Aggregate] = {}


def register(name: str, aggregate: Aggregate) -> None:
    REGISTRY[name.lower()] = aggregate


def partial(df: DataFrame, by: Sequence[str], aggregate: Aggregate, arguments: Sequence[str], most: int = MOST_GROUPS) -> DataFrame:
    """`by` columns and state: one row for each group and task, and more for a task with very many groups."""
    keys = [F.struct(*(F.col(f"`{c}`") for c in by)).alias("key")]
    rows = df.select(*keys, F.struct(*(F.col(f"`{a}`").alias(f"a{i}") for i, a in enumerate(arguments))).alias("args"))
    schema = StructType([rows.schema["key"], *StructType.fromDDL(f"state struct<{aggregate.state}>")])
    fields = [f.name for f in schema["state"].dataType]
    kind, state = (to_arrow_type(schema[c].dataType) for c in ("key", "state"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, tuple] = {}

        def rows_of() -> pa.RecordBatch:
            out = [dict(zip(by, k)) for k in states]
            made = [dict(zip(fields, s)) for s in states.values()]
            return pa.RecordBatch.from_arrays([pa.array(out, kind), pa.array(made, state)], ["key", "state"])

        for b in batches:
            ids = list(zip(*(b.column("key").field(i).to_pylist() for i in range(kind.num_fields)))) if kind.num_fields else [()] * b.num_rows
            given = b.column("args")
            for k, *a in zip(ids, *(given.field(i).to_pylist() for i in range(given.type.num_fields))):
                states[k] = aggregate.update(states[k] if k in states else aggregate.begin(), *a)
            if len(states) >= most:
                yield rows_of()
                states = {}
        if states:
            yield rows_of()

    return rows.mapInArrow(run, schema)


def aggregated(df: DataFrame, by: Sequence[str], name: str, arguments: Sequence[str], alias: str = "value") -> DataFrame:
    """df's groups with the result of a registered aggregate. Nulls reach the steps as None; no rows give no groups."""
    aggregate = REGISTRY[name.lower()]
    states = partial(df, by, aggregate, arguments)
    fields = [f.name for f in states.schema["state"].dataType]
    schema = StructType([states.schema["key"], *StructType.fromDDL(f"v {aggregate.result}")])

    result = to_arrow_type(schema["v"].dataType)

    def end(given: pa.Table) -> pa.Table:
        total = None
        for s in given.column("state").to_pylist():
            s = tuple(s[f] for f in fields)
            total = s if total is None else aggregate.merge(total, s)
        return pa.table({"key": given.column("key").slice(0, 1), "v": pa.array([aggregate.final(total)], result)})

    merged = states.groupBy("key").applyInArrow(end, schema)
    return merged.select(*(F.col(f"key.`{c}`").alias(c) for c in by), F.col("v").alias(alias))
