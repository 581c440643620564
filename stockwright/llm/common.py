"""Shared pieces of the text operators: reading, naming values inside expressions, row keys."""

from __future__ import annotations

from collections.abc import Callable

from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Shared = TypeVar("Shared")

# ASCII letters, as the contracts lower-case only these.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def share(spark: SparkSession, value: Shared) -> Callable[[], Shared]:
    """Sends a value of bounded size to every task once; the result gives it back there.

    Its class travels with it, so executors need no copy of this package.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(packed.value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with a name for ``value``: it is computed once per row, even when a lambda uses it per element."""
    return F.transform(F.array(value), body)[0]


def text_of(rows: DataFrame, column: str = "text") -> Column:
    return F.coalesce(rows[column].cast("string"), F.lit(""))


def word_table() -> bytes:
    """Byte map for ``bytes.translate``: A-Z to lower case, ASCII other than letters and digits to a blank.

    Every byte of a non-ASCII character is kept, so splitting at blanks yields the runs of
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
    """
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(out)


def white_table() -> bytes:
    """Byte map that lower-cases A-Z and turns the six white-space characters into a blank."""
    out = bytearray(range(256))
    for b in range(65, 91):
        out[b] = b + 32
    for c in WHITE:
        out[ord(c)] = 32
    return bytes(out)


def slices(batches, rows: int = 512):
    """Arrow batches in pieces of at most ``rows`` rows, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(column) -> list[str]:
    """Texts of an Arrow column, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]
