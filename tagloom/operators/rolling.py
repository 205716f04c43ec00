"""R/F/E activity measures kept from day to day, without reading the past again.

A day's visits of a user are one partial (last visit, visits, views, clicks),
written once into the day's partition.  The state of a date adds the day that
enters the lookback period and subtracts the day that leaves it; the last visit
is a maximum over all days and needs no subtraction.  A slot reads the state
before, two day partitions and nothing else.

Users stay in the state when their visits leave the period (frequency 0).
Times that are no timestamp and rows of no user are as in ``rfe_measures``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import as_of_lit

SUMS = ("visits", "views", "clicks")


def day_partials(
    events: DataFrame, user_col: str, ts_col: str, action_col: str, view_value: str = "view", click_value: str = "click"
) -> DataFrame:
    """``(userId, last, visits, views, clicks, day)``: one row per user and day."""
    ts = F.col(ts_col).try_cast("timestamp_ntz")
    act = F.col(action_col)
    timed = events.select(F.col(user_col).cast("string").alias("userId"), ts.alias("__t"), act.alias("__a")).where("__t IS NOT NULL")
    return timed.groupBy("userId", F.to_date("__t").alias("day")).agg(
        F.max("__t").alias("last"),
        F.count(F.lit(1)).alias("visits"),
        F.count_if(F.col("__a") == view_value).alias("views"),
        F.count_if(F.col("__a") == click_value).alias("clicks"),
    ).select("userId", "last", *SUMS, "day")


def write_days(partials: DataFrame, path: str) -> str:
    """Write (or replace) the partitions of the days in ``partials``."""
    out = partials.hint("rebalance", "day").write.partitionBy("day").mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def first_state(partials: DataFrame, as_of, lookback_days: int) -> DataFrame:
    """The state of ``as_of`` from all days before it."""
    recent = F.col("day") >= F.date_sub(as_of_lit(as_of), lookback_days)
    sums = [F.coalesce(F.sum(F.when(recent, F.col(c))), F.lit(0)).alias(c) for c in SUMS]
    return partials.where(F.col("day") < as_of_lit(as_of)).groupBy("userId").agg(F.max("last").alias("last"), *sums)


def changes(partials: DataFrame, as_of, lookback_days: int) -> DataFrame:
    """Signed partials between the states of the day before ``as_of`` and of ``as_of``: two days."""
    entering = _date(as_of) - dt.timedelta(days=1)
    leaving = entering - dt.timedelta(days=lookback_days)
    two = partials.where(F.col("day").isin(entering, leaving))
    enters = F.col("day") == F.lit(entering)
    sign = F.when(enters, 1).otherwise(-1)
    return two.select("userId", F.when(enters, F.col("last")).alias("last"), *[(F.col(c) * sign).alias(c) for c in SUMS])


def advance(state: DataFrame, partials: DataFrame, as_of, lookback_days: int) -> DataFrame:
    """The state of ``as_of`` from that of the day before."""
    both = state.select("userId", "last", *SUMS).unionByName(changes(partials, as_of, lookback_days))
    return both.groupBy("userId").agg(F.max("last").alias("last"), *[F.sum(c).alias(c) for c in SUMS]).where("last IS NOT NULL")


def state_measures(state: DataFrame, as_of) -> DataFrame:
    """``(userId, recency, frequency, engagement)`` of a state, as ``rfe_measures`` gives them."""
    return state.select(
        "userId",
        F.datediff(as_of_lit(as_of), F.to_date("last")).cast("int").alias("recency"),
        F.col("visits").cast("bigint").alias("frequency"),
        F.round(F.col("views") / F.nullif(F.col("clicks"), F.lit(0)), 6).alias("engagement"),
    )
