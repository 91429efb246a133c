"""Extractors by name: table functions from a record to any number of rows.

An extractor is a generator over the values of a record, declared with the
columns that it takes and the schema of what it yields. It runs as a Python table
function on Arrow batches where the records are, and has a name in SQL once it is
registered with a session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class Extractor:
    takes: tuple[str, ...]
    gives: StructType
    run: Callable[..., Iterator[tuple]]

    def function(self):
        """The table function; one object serves a partition."""
        run = self.run

        class Extract:
            def eval(self, *values):
                yield from run(*values)

        return F.udtf(Extract, returnType=self.gives)


_KNOWN: dict[str, Extractor] = {}


def register(name: str, takes: Sequence[str], gives: StructType) -> Callable[[Callable[..., Iterator[tuple]]], Callable[..., Iterator[tuple]]]:
    """Make a generator known. It gets the columns ``takes`` of a record and
    yields tuples of ``gives``; what it doesn't yield leaves no row."""

    def keep(run: Callable[..., Iterator[tuple]]) -> Callable[..., Iterator[tuple]]:
        _KNOWN[name] = Extractor(tuple(takes), gives, run)
        return run

    return keep


def known(name: str) -> Extractor:
    if name not in _KNOWN:
        raise KeyError(f"no extractor {name}; known: {', '.join(sorted(_KNOWN))}")
    return _KNOWN[name]


def publish(spark: SparkSession, name: str) -> None:
    """Give an extractor its name in the SQL of a session."""
    spark.udtf.register(name, known(name).function())


def extract(name: str, records: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of the records beside each row that the extractor yields for them."""
    extractor = known(name)
    rows = extractor.function()(*(F.col(c).outer() for c in extractor.takes))
    return records.lateralJoin(rows).select(*keep, *extractor.gives.names)
