"""Futures-symbol parsing over cell arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketbars.schemas import CONTINUOUS_SUFFIX, FUT_SYMBOL_PATTERN, MONTHS


_WS = " \t\n\r\x0b\x0c"


def strip_ws(c: Column) -> Column:
    """Leading/trailing ASCII whitespace removed (``str.strip`` on ASCII text)."""
    return F.btrim(c, F.lit(_WS))


_strip = strip_ws


def first_match(cells: Column, pattern: str = FUT_SYMBOL_PATTERN) -> Column:
    """struct(symbol, pos): the first stripped cell matching ``pattern``.

    ``pos`` is 1-based (``array_position``); 0 and a NULL symbol when no
    cell matches. Only the first match is considered.
    """
    stripped = F.transform(cells, lambda c: F.coalesce(_strip(c), F.lit("")))
    flags = F.transform(stripped, lambda c: c.rlike(pattern))
    pos = F.array_position(flags, True)
    symbol = F.when(pos > 0, F.try_element_at(stripped, pos.cast("int")))
    return F.struct(symbol.alias("symbol"), pos.cast("int").alias("pos"))


def fut_symbol_parts(symbol: Column) -> Column:
    """``EXCH:ROOTyyMONFUT`` -> struct(exch, root, yy, mon); NULL fields if no match."""
    def part(i: int) -> Column:
        return F.when(symbol.rlike(FUT_SYMBOL_PATTERN),
                      F.regexp_extract(symbol, FUT_SYMBOL_PATTERN, i))
    return F.struct(part(1).alias("exch"), part(2).alias("root"),
                    part(3).alias("yy"), part(4).alias("mon"))


def _month_map() -> Column:
    return F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i))])


def month_expiry(yy: Column, mon: Column) -> Column:
    """First day of the symbol's month (``2000+yy``); unknown month -> NULL."""
    month = F.try_element_at(_month_map(), mon)
    return F.when(month.isNotNull(),
                  F.make_date(F.lit(2000) + yy.cast("int"), month, F.lit(1)))


def continuous_ticker(root: Column, series: Column) -> Column:
    """``ROOT-SERIES.NFO`` (the suffix is fixed, also for BSE roots)."""
    return F.concat(root, F.lit("-"), series, F.lit(CONTINUOUS_SUFFIX))
