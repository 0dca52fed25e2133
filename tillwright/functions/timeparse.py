"""Event-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parsed as text: independent of both the Python and the session time zone.
EPOCH_NTZ = "1970-01-01 00:00:00"


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text -> UTC wall-clock ``timestamp_ntz``; bad text -> null.

    ``try_to_timestamp`` honours any offset in the text and never raises under
    ANSI mode. The instant is then laid out as UTC wall-clock time through
    epoch microseconds, so the result does not depend on the session zone.
    """
    text = F.col(text) if isinstance(text, str) else text
    instant = F.try_to_timestamp(text).cast("timestamp")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
