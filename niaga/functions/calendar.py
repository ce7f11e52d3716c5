"""Date expressions. They use calendar fields only, so no time zone is involved."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from niaga.functions.arithmetic import div_exact


def date_key(ts: Column) -> Column:
    """YYYYMMDD as INT."""
    d = F.to_date(ts)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def date_month(key: Column) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return div_exact(key, F.lit(100)).cast("int")


def elapsed_days(start_ts: Column, snapshot: dt.date) -> Column:
    """Whole 24-hour periods from a timestamp to midnight of ``snapshot``, floored."""
    day = F.to_date(start_ts)
    past_midnight = (start_ts > day.cast("timestamp_ntz")).cast("int")
    return (F.datediff(F.lit(snapshot), day) - past_midnight).cast("int")


def whole_seconds(ts: Column) -> Column:
    """A timestamp without its fraction of a second."""
    fraction = F.extract(F.lit("SECOND"), ts) % 1
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)
