"""Time-zone and calendar helpers.

Market times are wall-clock times in the exchange zone, held as TIMESTAMP_NTZ.
``convert_timezone`` over an NTZ value does not depend on the session time zone,
so the same epoch always maps to the same wall clock on every executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketbars.schemas import MARKET_TZ

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_to_market_time(epoch: Column, tz: str = MARKET_TZ) -> Column:
    """Epoch seconds (numeric) -> exchange wall clock (TIMESTAMP_NTZ)."""
    secs = F.floor(epoch).cast("bigint")
    utc_ntz = F.timestamp_add("SECOND", secs, F.expr(_EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_ntz)


def ntz_epoch_seconds(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> whole epoch seconds (floor).

    Built from the value's own date and clock fields, so no conversion to a
    session-zone TIMESTAMP happens anywhere.
    """
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def hour_start(ts: Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, built from its fields (zone-free)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def bar_date(wall: Column) -> Column:
    return F.to_date(wall)


def bar_time(wall: Column) -> Column:
    """``HH:mm:ss`` text; sorts correctly as a string. Cut from the NTZ's own
    text: ``date_format`` would go through a session-zone timestamp."""
    return F.substring(wall.cast("string"), 12, 8)


def bar_timestamp_text(wall: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, used only at the CSV edge."""
    return F.substring(wall.cast("string"), 1, 19)


def parse_dmy(text: Column) -> Column:
    """``d-M-yyyy`` date (non-padded accepted); blank or invalid -> NULL."""
    return F.try_to_date(text, "d-M-yyyy")


def lenient_date(value: Column) -> Column:
    """Any timestamp-like text or value -> DATE, bad -> NULL."""
    return F.try_to_timestamp(value.cast("string")).cast("date")
