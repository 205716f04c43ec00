"""User functions: vectorised Python for what has no built-in form.

A function gets whole Arrow arrays, not rows.  ``register`` makes it known to
SQL and returns it for the DataFrame API; it travels by value, so executors
need no package.  An aggregate is stated as sums: one function per term of its
state, and one that finishes the sums.  Spark adds the terms up itself, with
partial sums on the map side, so no group is ever collected for Python,
however many rows its key holds.

    hour_x = register(spark, "hour_x", lambda t: ..., "double")
    spark.sql("SELECT user, typical_hour(sum(hour_x(t)), sum(hour_y(t))) FROM visits GROUP BY user")
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def vectorised(fn: Callable[..., pa.Array], returns: str):
    """``fn`` of Arrow arrays as a column function."""
    module = sys.modules.get(fn.__module__)
    if module is not None and module.__name__ != "__main__":
        cloudpickle.register_pickle_by_value(module)

    def arrays(*a: pa.Array) -> pa.Array:
        return fn(*a)

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # the kind of function is told by its type hints, which must be the objects themselves
    arrays.__annotations__ = {"a": pa.Array, "return": pa.Array}
    return F.arrow_udf(arrays, returns)


def register(spark: SparkSession, name: str, fn: Callable[..., pa.Array], returns: str):
    """``fn`` as a SQL function; returns the column function."""
    return spark.udf.register(name, vectorised(fn, returns))


@dataclass
class SumAggregate:
    """An aggregate whose state is sums: ``terms`` of a row, and what ``finish`` makes of their sums."""

    terms: dict[str, Callable[..., pa.Array]]
    finish: Callable[..., pa.Array]
    returns: str = "double"
    fields: list[str] = field(default_factory=list)

    def per_key(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """``(key columns, name)``: one row per key."""
        inputs = [F.col(f) for f in self.fields]
        valued = rows.select(key, *[vectorised(fn, "double")(*inputs).alias(f"__{t}") for t, fn in self.terms.items()])
        by = valued.columns[0]
        sums = valued.groupBy(by).agg(*[F.sum(f"__{t}").alias(f"__{t}") for t in self.terms])
        return sums.select(by, vectorised(self.finish, self.returns)(*[F.col(f"__{t}") for t in self.terms]).alias(name))

    def register(self, spark: SparkSession, name: str) -> None:
        """``name`` (of the sums) and ``name_<term>`` (of a row) as SQL functions."""
        register(spark, name, self.finish, self.returns)
        for t, fn in self.terms.items():
            register(spark, f"{name}_{t}", fn, "double")
