"""Epoch / date expressions used by the recency and age models.

The session time zone is pinned to UTC (see ``tagloom.session``), so epoch
seconds map to the same calendar date everywhere.  ``as_of`` is always a
literal date passed in, never ``current_date()`` inside a query, so plans
constant-fold and results are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.strings import _c


def as_of_lit(as_of: str | _dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def epoch_to_long(s: Column | str) -> Column:
    """Epoch-seconds string -> bigint; malformed text gives null (try_cast)."""
    return _c(s).try_cast("bigint")


# Epoch seconds of 0001-01-01 and 9999-12-31, the range of dates.
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799


def epoch_to_date(seconds: Column | str) -> Column:
    """Date of epoch seconds; null outside the years 1 to 9999."""
    s = _c(seconds)
    return F.to_date(F.timestamp_seconds(F.when(s.between(MIN_EPOCH, MAX_EPOCH), s)))


def timestamp_to_epoch(ts: Column | str) -> Column:
    """timestamp / timestamp_ntz -> epoch seconds (UTC wall clock)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def shifted_days_since(last_epoch: Column | str, as_of, shift_days: int = 30) -> Column:
    """``datediff(as_of - shift_days, date(last))`` — negative inside the shift window."""
    return F.datediff(F.date_sub(as_of_lit(as_of), shift_days), epoch_to_date(last_epoch))


def age_years(birthday: Column | str, as_of) -> Column:
    """Completed years between a birthday (date or 'yyyy-MM-dd' string) and ``as_of``.

    Year difference, minus one while the birthday's (month, day) is still
    ahead in the ``as_of`` year.  Text that is no date (``\\N``) has no age.
    """
    b = _c(birthday).try_cast("date")
    a = as_of_lit(as_of)
    before = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return (F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)).cast("int")
