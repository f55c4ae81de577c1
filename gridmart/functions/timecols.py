"""Column functions for time handling (parse, local parts, hour keys).

All are ``Column -> Column`` and stay inside whole-stage codegen.  They assume
the session zone is UTC (see ``gridmart.session``); under that pin a cast
between ``TIMESTAMP`` and ``TIMESTAMP_NTZ`` keeps the UTC wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.schemas import PRICE_TIME_PATTERN

ColumnOrName = Column | str

WALL_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_offset_instant(c: ColumnOrName, pattern: str = PRICE_TIME_PATTERN) -> Column:
    """ISO text with an offset (``2023-08-22T00:00:00+02:00``) -> instant.

    Malformed text gives NULL instead of failing the job, so the null
    profile can count it.
    """
    return F.try_to_timestamp(_c(c), F.lit(pattern))


def parse_wall_ntz(c: ColumnOrName) -> Column:
    """ISO wall-clock text without offset (``2026-03-29T01:00``, seconds allowed)
    -> NTZ; NULL if malformed, a partial date included.  Independent of the
    session zone."""
    return F.when(_c(c).rlike(WALL_TEXT), _c(c).try_cast("timestamp_ntz"))


def utc_wall(c: ColumnOrName) -> Column:
    """Instant -> its UTC wall clock as NTZ (exact under the UTC pin)."""
    return _c(c).cast("timestamp_ntz")


def as_instant(c: ColumnOrName) -> Column:
    """UTC wall clock (NTZ) -> instant (exact under the UTC pin)."""
    return _c(c).cast("timestamp")


def to_local_wall(utc_wall_col: ColumnOrName, zone: str) -> Column:
    """UTC wall clock (NTZ) -> wall clock in ``zone`` (NTZ).  On the autumn DST
    change two UTC hours map to the same local wall hour."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(utc_wall_col))


def instant_to_local_wall(c: ColumnOrName, zone: str) -> Column:
    return to_local_wall(utc_wall(c), zone)


def local_date(c: ColumnOrName, zone: str) -> Column:
    """Local calendar date of an instant."""
    return F.to_date(instant_to_local_wall(c, zone))


def local_hour(c: ColumnOrName, zone: str) -> Column:
    return F.hour(instant_to_local_wall(c, zone))


def hour_key(c: ColumnOrName, ntz: bool) -> Column:
    """Truncate to the hour and keep the input's type.

    ``date_trunc`` returns ``TIMESTAMP`` even for NTZ input; the explicit cast
    makes both join sides carry the same key type.
    """
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz" if ntz else "timestamp")


def epoch_hour(c: ColumnOrName) -> Column:
    """Whole hours since 1970-01-01 00:00 UTC, as BIGINT.  Accepts instants and
    UTC wall clocks."""
    return F.floor(F.unix_seconds(_c(c).cast("timestamp")) / F.lit(3600)).cast("long")



def period(date_col: ColumnOrName, granularity: str) -> Column:
    """Partition value of a date: the date itself ("day") or the first day of
    its month ("month")."""
    if granularity == "day":
        return _c(date_col)
    if granularity == "month":
        return F.trunc(_c(date_col), "month")
    raise ValueError(f"granularity must be one of {GRANULARITIES}")


def period_of(d: _dt.date, granularity: str) -> _dt.date:
    """``period`` for a Python date (for pruning literals)."""
    if granularity == "day":
        return d
    if granularity == "month":
        return d.replace(day=1)
    raise ValueError(f"granularity must be one of {GRANULARITIES}")


def feed_local_date(c: ColumnOrName) -> Column:
    """Leading ``yyyy-MM-dd`` of raw feed text: the date as written in the
    feed's own zone, whatever the session zone.  NULL if malformed."""
    return F.substring(_c(c), 1, 10).try_cast("date")


def day_range(c: ColumnOrName, day: _dt.date | str, ntz: bool) -> Column:
    """``to_date(c) == day`` written as a half-open range, so the predicate is
    pushed into the parquet scan and prunes row groups."""
    d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    lo = _dt.datetime.combine(d, _dt.time())
    hi = lo + _dt.timedelta(days=1)
    return (_c(c) >= utc_literal(lo, ntz)) & (_c(c) < utc_literal(hi, ntz))


def utc_literal(wall: _dt.datetime | str, ntz: bool) -> Column:
    """Literal for a UTC wall-clock time given as text or naive datetime (read
    in the pinned UTC session zone, never in the Python process zone)."""
    text = wall if isinstance(wall, str) else wall.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def ts_literal(value, ntz: bool) -> Column:
    """Literal of a collected timestamp value with the column's own type.

    NTZ literals are built from text, so the wall clock is kept whatever the
    Python process zone; a comparison against a literal of the column's own
    type is pushed into the parquet scan.
    """
    if value is None:
        return F.lit(None).cast("timestamp_ntz" if ntz else "timestamp")
    if ntz:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def between_closed(c: ColumnOrName, lo, hi, ntz: bool) -> Column:
    """Closed range ``lo <= c <= hi`` on literal bounds (pushed to the scan)."""
    return (_c(c) >= ts_literal(lo, ntz)) & (_c(c) <= ts_literal(hi, ntz))
