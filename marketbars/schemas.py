"""Table schemas, natural keys and the fixed values of the data model.

Types are declared once here and applied on every read and write, so a column
never drifts between integer and floating point from one day to the next.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to line up with
# existing histories: column orders, natural keys, index dimensions, routing,
# file-name patterns and labels, the option types, the futures-symbol pattern, the
# contract-series labels, the month abbreviations, the expiry window, the epoch
# plausibility range, the 2026 F&O holiday list, the validation messages and the
# ingest statuses that alerts and ledgers read.
# ---------------------------------------------------------------------------

MARKET_TZ = "Asia/Kolkata"

OPTIONS_COLUMNS = [
    "Ticker", "Date", "Time", "Open", "High", "Low", "Close", "Volume",
    "OpenInterest", "Underlying", "Expiry", "Strike", "OptionType",
]
FUTURES_COLUMNS = [
    "Ticker", "Date", "Time", "Open", "High", "Low", "Close", "Volume",
    "OpenInterest", "SourceFile", "Underlying", "ContractSeries",
]
SPOT_COLUMNS = ["timestamp", "Open", "High", "Low", "Close", "Volume"]

DEDUP_KEYS = {
    "options": ["Ticker", "Date", "Time"],
    "futures": ["Ticker", "Date", "Time"],
    "spot": ["Index", "timestamp"],     # one file per index has no Index column
}

OPTION_TYPES = ["CE", "PE"]

# index -> (vendor index symbol, exchange, option-symbol prefixes)
UNDERLYINGS = {
    "NIFTY": ("NSE:NIFTY50-INDEX", "NSE", ["NSE:NIFTY", "NIFTY"]),
    "BANKNIFTY": ("NSE:NIFTYBANK-INDEX", "NSE", ["NSE:BANKNIFTY", "BANKNIFTY"]),
    "SENSEX": ("BSE:SENSEX-INDEX", "BSE", ["BSE:SENSEX", "SENSEX"]),
}
DEFAULT_UNDERLYINGS = ["NIFTY", "BANKNIFTY", "SENSEX"]

# index -> (futures root, exchange, symbol-master segment)
FUTURES_SPECS = {
    "NIFTY": ("NIFTY", "NSE", "NSE_FO"),
    "BANKNIFTY": ("BANKNIFTY", "NSE", "NSE_FO"),
    "SENSEX": ("SENSEX", "BSE", "BSE_FO"),
}
CONTRACT_SERIES = ["I", "II", "III"]
CONTINUOUS_SUFFIX = ".NFO"

# index -> spot file stem
SPOT_STEMS = {"NIFTY": "Nifty 50", "BANKNIFTY": "Nifty Bank", "SENSEX": "Sensex"}

OPTIONS_FILENAMES = {"NSE": "options_nse.parquet", "BSE": "options_bse.parquet"}
FUTURES_FILENAME = "futures.parquet"
SPOT_FILENAME_PATTERN = "spot_%s.csv"

YEARLY_FILES = {
    "options_nse": "NSE_INDEX_OPTIONS_%d.parquet",
    "options_bse": "BSE_INDEX_OPTIONS_%d.parquet",
    "futures": "INDEX_FUTURES_%d.parquet",
}
SPOT_FILES = {"NIFTY": "Nifty 50.csv", "BANKNIFTY": "Nifty Bank.csv", "SENSEX": "Sensex.csv"}

FILE_LABELS = {
    "options_nse.parquet": "NSE Index Options (NIFTY, BANKNIFTY)",
    "options_bse.parquet": "BSE Index Options (SENSEX)",
    "futures.parquet": "Index Futures (near/next/far)",
}

MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN",
          "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

FUT_SYMBOL_PATTERN = r"^([A-Z]+):([A-Z]+)([0-9]{2})([A-Z]{3})FUT$"

EXPIRY_WINDOW_DAYS = 35
EPOCH_MS_RANGE = (1_000_000_000_000, 10_000_000_000_000)   # [lo, hi)
EPOCH_S_RANGE = (1_000_000_000, 2_051_222_400)              # [lo, hi]

HOLIDAYS_2026 = [
    ("2026-01-26", "Republic Day"),
    ("2026-02-17", "Mahashivratri"),
    ("2026-03-14", "Holi"),
    ("2026-03-31", "Id-Ul-Fitr (Ramadan)"),
    ("2026-04-02", "Ram Navami"),
    ("2026-04-03", "Good Friday"),
    ("2026-04-14", "Dr. Baba Saheb Ambedkar Jayanti"),
    ("2026-05-01", "Maharashtra Day"),
    ("2026-05-25", "Buddha Purnima"),
    ("2026-06-07", "Bakri Id (Eid-ul-Adha)"),
    ("2026-07-07", "Muharram"),
    ("2026-08-15", "Independence Day"),
    ("2026-09-05", "Milad-un-Nabi (Prophet Mohammad Birthday)"),
    ("2026-09-14", "Ganesh Chaturthi"),
    ("2026-10-02", "Mahatma Gandhi Jayanti"),
    ("2026-10-21", "Dussehra"),
    ("2026-11-09", "Diwali (Laxmi Puja)"),
    ("2026-11-10", "Diwali (Balipratipada)"),
    ("2026-11-30", "Guru Nanak Jayanti"),
    ("2026-12-25", "Christmas"),
]

# Label written into futures SourceFile for rows produced by the daily job.
# Histories that used another label pass theirs as ``source_label``.
FUTURES_SOURCE_LABEL = "daily_extraction"

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

OPTIONS_SCHEMA = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("OpenInterest", T.LongType()),
    T.StructField("Underlying", T.StringType()),
    T.StructField("Expiry", T.DateType()),
    T.StructField("Strike", T.IntegerType()),
    T.StructField("OptionType", T.StringType()),
])

FUTURES_SCHEMA = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("OpenInterest", T.LongType()),
    T.StructField("SourceFile", T.StringType()),
    T.StructField("Underlying", T.StringType()),
    T.StructField("ContractSeries", T.StringType()),
])

SPOT_SCHEMA = T.StructType([
    T.StructField("Index", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
])

# One landed history response: request columns + vendor payload.
BAR_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trading_date", T.DateType()),
    T.StructField("s", T.StringType()),
    T.StructField("message", T.StringType()),
    # cells as text: one bad cell must not cost the parser the whole response
    T.StructField("candles", T.ArrayType(T.ArrayType(T.StringType()))),
])
# The same with ``candles`` as raw JSON text, as read from a file.
BAR_PAYLOAD_RAW_SCHEMA = T.StructType(
    [*BAR_PAYLOAD_SCHEMA.fields[:-1], T.StructField("candles", T.StringType())])

EXPIRY_ITEM = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("expiry", T.StringType()),
])
CHAIN_ITEM = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("option_type", T.StringType()),
    T.StructField("strike_price", T.StringType()),      # a number or quoted text
])
# One landed option-chain response. ``requested_expiry`` is the epoch sent with
# the request (empty for the listing call); contracts are tagged with it.
CHAIN_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("underlying", T.StringType()),
    T.StructField("trading_date", T.DateType()),
    T.StructField("requested_expiry", T.StringType()),
    T.StructField("s", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("expiryData", T.ArrayType(EXPIRY_ITEM)),
        T.StructField("optionsChain", T.ArrayType(CHAIN_ITEM)),
    ])),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()),
    T.StructField("dates_json", T.StringType()),
])

OUTCOME_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("kind", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("rows", T.LongType()),
])

SCHEMAS = {"options": OPTIONS_SCHEMA, "futures": FUTURES_SCHEMA, "spot": SPOT_SCHEMA}
