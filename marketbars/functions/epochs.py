"""Expiry epochs found in symbol-master cells.

Written so that every intermediate value is referenced a bounded number of
times (no nested re-use), which keeps the generated expression linear in size
also inside higher-order functions, where Spark does no common-subexpression
elimination.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketbars.functions.symbols import strip_ws
from marketbars.functions.timefmt import epoch_to_market_time
from marketbars.schemas import EPOCH_MS_RANGE, EPOCH_S_RANGE

_DIGITS = r"^\s*[0-9]+\s*$"


def epoch_digits(cell: Column) -> Column:
    """Stripped, digit-only text -> BIGINT; anything else -> NULL.

    A digit string beyond the BIGINT range gives NULL, which is the same
    verdict as "implausible" (the plausible range ends far below it).
    """
    return F.when(cell.rlike(_DIGITS), strip_ws(cell).try_cast("bigint"))


def stripped_epoch_digits(text: Column) -> Column:
    """``epoch_digits`` for text that is already stripped."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def plausible_seconds(raw: Column) -> Column:
    """Epoch (seconds, or milliseconds in the ms band) -> plausible seconds or NULL.

    Millisecond values ``[1e12, 1e13)`` are divided by 1000 (integer division);
    the result must lie in the plausible seconds range. Larger values are ids.
    """
    lo, hi = EPOCH_S_RANGE
    ms_lo, ms_hi = EPOCH_MS_RANGE
    ms_top = min(ms_hi - 1, hi * 1000 + 999)     # floor(raw / 1000) <= hi
    return (F.when(raw.between(lo, hi), raw)
             .when(raw.between(ms_lo, ms_top), F.floor(raw / 1000))).cast("bigint")


def plausible_expiry_epoch(cell: Column) -> Column:
    """Symbol-master cell -> plausible epoch seconds (BIGINT) or NULL."""
    return plausible_seconds(epoch_digits(cell))


def expiry_epoch_to_date(cell: Column) -> Column:
    """Symbol-master expiry cell -> exchange-local DATE, or NULL."""
    return seconds_to_market_date(plausible_expiry_epoch(cell))


def seconds_to_market_date(secs: Column) -> Column:
    return F.to_date(epoch_to_market_time(secs))
