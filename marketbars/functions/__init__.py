"""Column-level helpers built only from Spark SQL built-in functions."""

from marketbars.functions.coerce import (  # noqa: F401
    nan_to_null, strike_to_int, to_bigint, to_double,
)
from marketbars.functions.epochs import expiry_epoch_to_date, plausible_expiry_epoch  # noqa: F401
from marketbars.functions.symbols import (  # noqa: F401
    continuous_ticker, first_match, fut_symbol_parts, month_expiry,
)
from marketbars.functions.timefmt import (  # noqa: F401
    bar_date, bar_time, bar_timestamp_text, epoch_to_market_time, lenient_date,
    ntz_epoch_seconds, parse_dmy,
)
