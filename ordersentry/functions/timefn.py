"""Time helpers (C8, C12, S9).  The session zone must be UTC."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def event_date(col: Column | str) -> Column:
    """``date(ts)`` in the (UTC) session zone."""
    return F.to_date(_c(col))


def hour_in(col: Column | str, start: int = 0, end: int = 4) -> Column:
    """``start <= hour(ts) < end``."""
    h = F.hour(_c(col))
    return (h >= F.lit(start)) & (h < F.lit(end))


def hour_of_iso_text(col: Column | str) -> Column:
    """Hour written in an ISO-8601 text, in the text's own offset (no zone
    conversion), e.g. ``2025-03-01T02:30:00+07:00`` -> 2."""
    return F.substring(_c(col), 12, 2).try_cast("int")


def micros(col: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp (with or without zone)."""
    return F.unix_micros(_c(col).cast("timestamp"))


def previous_day(ds: str | _dt.date) -> _dt.date:
    """The day an incremental run for ``ds`` extracts: ``ds - 1 day``."""
    if isinstance(ds, str):
        ds = _dt.date.fromisoformat(ds[:10])
    return ds - _dt.timedelta(days=1)


def on_day(col: Column | str, day: _dt.date) -> Column:
    """``date(col) = day``; Catalyst turns it into a range on the raw column."""
    return F.to_date(_c(col)) == F.lit(day)
