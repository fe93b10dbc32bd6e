"""Time expressions that do not depend on the session time zone."""

from pyspark.sql import Column, functions as F


def epoch_seconds(col: str | Column, kind: str = "ntz") -> Column:
    """Whole epoch seconds of a timestamp, independent of the session zone.

    ``kind="ntz"``: a ``timestamp_ntz`` wall clock read as UTC (the driver
    tables). ``kind="ltz"``: a ``timestamp`` instant (e.g. a Kafka record
    time), converted with ``unix_seconds``.
    """
    c = F.col(col) if isinstance(col, str) else col
    if kind == "ltz":
        return F.unix_seconds(c)
    if kind != "ntz":
        raise ValueError(f"kind must be 'ntz' or 'ltz', not {kind!r}")
    # From the date and time of day: a difference of timestamps would pass
    # through the session zone, where some wall-clock times do not exist.
    t = c.cast("timestamp_ntz")
    return (F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600
            + F.minute(t) * 60 + F.second(t)).cast("long")


def utc_date(epoch_col: str | Column) -> Column:
    """Calendar date (UTC) of epoch seconds, via integer day arithmetic."""
    c = F.col(epoch_col) if isinstance(epoch_col, str) else epoch_col
    return F.date_from_unix_date(F.floor(c / F.lit(86400)).cast("int"))


def year_month(epoch_col: str | Column) -> Column:
    """``yyyyMM`` of epoch seconds in UTC, as bigint (e.g. 199507).

    The original format string used minutes where months were meant; the
    monthly statistic is computed per calendar month as its docs describe.
    """
    d = utc_date(epoch_col)
    return (F.year(d) * 100 + F.month(d)).cast("long")
