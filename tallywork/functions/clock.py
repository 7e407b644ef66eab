"""Clock values that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the batch time format.
BATCH_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
DAY_MILLIS = 24 * 60 * 60 * 1000


def _millis_of_day(ts: Column) -> Column:
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (seconds.cast("bigint") * 1000) + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")


def batch_time(ts: Column) -> Column:
    """Format a wall-clock timestamp as a batch time header."""
    return F.date_format(ts, BATCH_TIME_FORMAT)


def batch_time_of_millis(millis: Column) -> Column:
    """Format epoch milliseconds as a batch time header, in the session zone."""
    return batch_time(F.timestamp_millis(millis))


def millis_to_midnight(ts: Column) -> Column:
    """Milliseconds from a zone-less timestamp to the start of the next day."""
    return F.lit(DAY_MILLIS).cast("bigint") - _millis_of_day(ts)


def utc_instant(ts: Column) -> Column:
    """Read a zone-less timestamp as a UTC instant, as watermarks need one.

    A plain cast would use the session zone, and with it shift windows and
    days around clock changes.
    """
    micros_of_second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    seconds = (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86_400
        + F.hour(ts).cast("bigint") * 3600
        + F.minute(ts).cast("bigint") * 60
    )
    return F.timestamp_micros(seconds * 1_000_000 + micros_of_second)


def utc_text(instant: Column) -> Column:
    """A UTC instant on whole seconds as text, whatever the session zone is."""
    seconds = F.unix_seconds(instant)
    day = F.date_format(F.date_from_unix_date(F.floor(seconds / 86_400).cast("int")), "yyyy-MM-dd")
    rest = F.pmod(seconds, F.lit(86_400))

    def two(value: Column) -> Column:
        return F.lpad(value.cast("int").cast("string"), 2, "0")

    clock = F.concat_ws(":", two(F.floor(rest / 3600)), two(F.floor(rest / 60) % 60), two(rest % 60))
    return F.concat_ws(" ", day, clock)
