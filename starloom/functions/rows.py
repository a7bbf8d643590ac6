"""Array elements as rows, with the array computed once."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

SLICE = 128  # rows that a helper holds as Python objects at once


def element_rows(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """``keep`` and one row per array element; empty arrays and null elements give none.

    A plain explode makes the optimizer test the array's size beforehand, which
    computes a costly array (tokens, parsed markup, an Arrow helper) twice.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def numbered_rows(df: DataFrame, keep: list, array: Column, position: str, name: str) -> DataFrame:
    """The same with the element's 0-based position."""
    return df.select(*keep, F.posexplode_outer(array).alias(position, name)).filter(F.col(position).isNotNull())


def by_row(one: Callable, kind: DataType) -> Callable[..., Column]:
    """Arrow helper that calls ``one`` with the values of each row.

    A batch may have ten thousand long texts: only a slice of it is turned into Python objects at
    a time, and its results go back to Arrow before the next.
    """
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(*columns: pa.Array) -> pa.Array:
        done = [pa.array([], arrow)]
        for at in range(0, len(columns[0]), SLICE):
            done.append(pa.array([one(*row) for row in zip(*(c.slice(at, SLICE).to_pylist() for c in columns))], arrow))
        return pa.concat_arrays(done)

    return run


def by_tokens(one: Callable, kind: DataType) -> Callable[..., Column]:
    """The same for two token arrays; ``one`` gets their tokens as numbers, equal ones for equal tokens."""
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        done = [pa.array([], arrow)]
        for at in range(0, len(left), SLICE):
            sides = [c.slice(at, SLICE) for c in (left, right)]
            coded = pa.concat_arrays([c.flatten() for c in sides]).dictionary_encode().indices.fill_null(-1).to_numpy().tolist()
            rows = []
            for side in sides:
                sizes, start, mine = side.value_lengths().to_pylist(), 0 if not rows else len(sides[0].flatten()), []
                for n in sizes:
                    mine.append(None if n is None else coded[start:start + n])
                    start += n or 0
                rows.append(mine)
            done.append(pa.array([one(a, b) for a, b in zip(*rows)], arrow))
        return pa.concat_arrays(done)

    return run
