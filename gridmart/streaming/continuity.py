"""Hourly continuity watched as rows arrive, with a timer for the hour that
does not.

Each series keeps the last hour that the watermark has closed and the few later
ones it has seen.  When the watermark closes an hour that does not follow the
last one, the hole between them is reported; when it closes an hour that has not
come at all, a timer of the series reports it as open, without any row of that
series and without a look at gold.  Other series' rows move the watermark on, so
a region that stops is found while the others go on.

Of the closed hours the reported holes are those of ``operators.gaps``; rows
later than the watermark are not taken back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridmart.functions.timecols import epoch_hour
from gridmart.session import ship

HOUR_MS = 3_600_000
#: Hours since 1970: the last closed one, the one an open hole was reported
#: behind, and those seen but not closed yet (bounded by the watermark's delay).
STATE = "last long, reported long, seen array<long>"
OUT = "region string, kind string, previous_hour long, hour long, gap_hours long"
CLOSED, OPEN = "closed", "open"


def advance(region, hours: Iterable[int], last: int | None, reported: int | None, seen: Iterable[int],
            closed_before: int):
    """One step of a series: (reports, last, reported, seen).

    ``closed_before``: hours below it are closed."""
    ahead = sorted({h for h in (*seen, *hours) if last is None or h > last})
    reports = []
    while ahead and ahead[0] < closed_before:
        hour = ahead.pop(0)
        if last is not None and hour > last + 1:
            reports.append((region, CLOSED, last, hour, hour - last))
        last = hour
    if last is not None and last + 1 < closed_before and reported != last:
        reports.append((region, OPEN, last, None, closed_before - last))
        reported = last
    return reports, last, reported, ahead


def _wake_at(last: int | None, reported: int | None, seen: list[int]) -> int | None:
    """When the watermark closes the next hour that matters (ms since 1970)."""
    waits = [seen[0] + 1] if seen else []
    if last is not None and reported != last:
        waits.append(last + 2)                              # the end of the hour after the last
    return min(waits) * HOUR_MS if waits else None


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, reported, seen = state.get if state.exists else (None, None, [])
    hours = [int(h) for frame in frames for h in frame["hour"].dropna().unique()]
    watermark = state.getCurrentWatermarkMs()
    reports, last, reported, seen = advance(key[0], hours, last, reported, seen or [], watermark // HOUR_MS)
    state.update((last, reported, seen))
    wake = _wake_at(last, reported, seen)
    if wake is not None:
        state.setTimeoutTimestamp(max(wake, watermark + 1))
    frame = pd.DataFrame(reports, columns=["region", "kind", "previous_hour", "hour", "gap_hours"])
    yield frame.astype({"previous_hour": "Int64", "hour": "Int64", "gap_hours": "Int64"})


def holes(rows: DataFrame, key: str, time_col: str, delay: str = "2 hours") -> DataFrame:
    """The holes of a stream of rows: (key, kind, previous_hour, hour_utc,
    gap_hours) as they are closed, or, with no hour_utc, found open.

    ``time_col`` is an instant.  Repeats of an hour are dropped by (key, hour), on
    all tasks, so a series that holds a third of all rows sends its state one row
    an hour."""
    ship(rows.sparkSession)
    timed = rows.filter(F.col(key).isNotNull() & F.col(time_col).isNotNull()) \
        .select(F.col(key).alias("region"), F.date_trunc("hour", time_col).alias("_t")) \
        .withWatermark("_t", delay).dropDuplicates(["region", "_t"]).withColumn("hour", epoch_hour("_t"))
    found = timed.groupBy("region").applyInPandasWithState(
        _step, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)

    def instant(c):
        return F.timestamp_seconds(F.col(c) * 3600)
    return found.select(F.col("region").alias(key), "kind", instant("previous_hour").alias("previous_hour"),
                        instant("hour").alias("hour_utc"), "gap_hours")
