"""Date helpers (H5-H10, H18): parts, ISO weekday, weekend flag, names, smart key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def date_key(c) -> Column:
    """Smart key ``YYYYMMDD`` as INT, computed arithmetically (no string formatting)."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_dow(c) -> Column:
    """ISO weekday: Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(c)) + 1).cast("int")


def is_weekend(c) -> Column:
    return F.weekday(_c(c)) >= 5


def month_name(c) -> Column:
    """Full English month name, not blank-padded."""
    return F.date_format(_c(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def date_parts(ts) -> dict[str, Column]:
    """year, month, day, isodow, is_weekend of a timestamp (the staging orders columns)."""
    ts = _c(ts)
    return {
        "year": F.year(ts).cast("int"),
        "month": F.month(ts).cast("int"),
        "day": F.dayofmonth(ts).cast("int"),
        "isodow": iso_dow(ts),
        "is_weekend": is_weekend(ts),
    }
