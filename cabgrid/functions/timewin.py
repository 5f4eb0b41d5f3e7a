"""Time buckets and time-of-day keys as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def window_end(ts, length: str, slide: str | None = None) -> Column:
    """End of the tumbling window of ``length`` holding ``ts``.

    A tumbling ``window()`` compiles to a plain projection (no Expand), so a
    grouping key built from it keeps the aggregate's hash partitioning.
    """
    return F.window(_c(ts), length, slide or length).end


def window_start(ts, length: str, slide: str | None = None) -> Column:
    return F.window(_c(ts), length, slide or length).start


def micros(length: str) -> int:
    """Microseconds of a duration such as ``30 minutes``."""
    return pd.Timedelta(length).value // 1000


def pane_windows(pane_end: str, length: str, slide: str) -> Column:
    """Ends of the windows of ``length`` that hold the pane of one ``slide`` ending at ``pane_end``."""
    later = F.timestamp_add("MICROSECOND", F.lit(micros(length) - micros(slide)), pane_end)
    return F.sequence(pane_end, later, F.expr(f"INTERVAL {micros(slide)} MICROSECONDS"))


def epoch_micros(ts) -> Column:
    """Microseconds of a zone-free timestamp since 1970-01-01 00:00, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))


def from_epoch_micros(us) -> Column:
    """The inverse of ``epoch_micros``."""
    return F.timestamp_add("MICROSECOND", _c(us), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def time_of_day(ts) -> Column:
    """``HH:mm`` text of a timestamp: the daily profile key.

    Built from ``hour``/``minute``, which read a ``TIMESTAMP_NTZ`` as it is;
    ``date_format`` would first cast it to the session zone, and a wall-clock
    time inside a daylight-saving gap (02:30 on a spring-forward day in New
    York) would come out an hour later.
    """
    c = _c(ts)
    return F.format_string("%02d:%02d", F.hour(c), F.minute(c))


def utc_wallclock(ts) -> Column:
    """An instant (session-zone ``TIMESTAMP``) as its UTC wall clock (``TIMESTAMP_NTZ``).

    Streams need zone-aware timestamps for watermarks; outputs go back to
    zone-free values that match the batch results whatever the session zone.
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def wallclock_instant(ts) -> Column:
    """The inverse of ``utc_wallclock``: a UTC wall clock as an instant, whatever the session zone."""
    return F.timestamp_micros(epoch_micros(ts))


def utc_text(ts) -> Column:
    """ISO text with an explicit ``Z`` for a zone-free timestamp.

    Written to files that a stream later reads as instants, so the reading
    session's zone cannot shift the value. Built from the zone-free string
    cast (``date_format`` would pass through the session zone first).
    """
    return F.concat(F.regexp_replace(_c(ts).cast("string"), " ", "T"), F.lit("Z"))
