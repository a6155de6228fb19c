"""String helpers for names, captions and ledgers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(n: Column) -> Column:
    """Integer with comma thousands separators (``12,345``)."""
    return F.format_number(n.cast("bigint"), 0)


def ledger_name(target: Column) -> Column:
    """Ledger file name of a target: ``.{name}.dates.json``."""
    return F.concat(F.lit("."), target, F.lit(".dates.json"))


def spot_stem_from_name(name: Column) -> Column:
    """``spot_Nifty 50.csv`` -> ``Nifty 50``."""
    return F.regexp_extract(name, r"^spot_(.*)\.csv$", 1)
