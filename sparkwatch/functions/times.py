"""Clock and timestamp expressions. Whatever reads a clock takes ``as_of`` so that a run can be repeated."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | str | date | datetime | None

# Fixed value: the ISO 8601 shape that feeds use for publish times.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)


def as_timestamp(as_of: AsOf = None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def today(as_of: AsOf = None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_timestamp(as_of).cast("date")


def _parsed(c: Column | str) -> Column:
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(c.rlike(ISO_TIMESTAMP), F.try_to_timestamp(c))


def parse_ts(c: Column | str, as_of: AsOf = None) -> Column:
    """ISO timestamp in the session zone; an offset is converted; missing or bad text gives ``as_of``."""
    return F.coalesce(_parsed(c), as_timestamp(as_of))


def ts_was_imputed(c: Column | str) -> Column:
    """True where parse_ts had to fall back to ``as_of``."""
    return _parsed(c).isNull()


def year_month(c: Column | str) -> Column:
    """yyyyMM as an integer, the layout column of monthly tables."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(c) * 100 + F.month(c)
