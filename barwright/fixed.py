"""Constants that results depend on and that callers expect by default."""

# Instruments loaded when the caller names none.
DEFAULT_TICKERS = [
    "PETR4.SA",
    "VALE3.SA",
    "ITUB4.SA",
    "BBDC4.SA",
    "ABEV3.SA",
    "WEGE3.SA",
    "RENT3.SA",
    "MGLU3.SA",
    "BPAC11.SA",
    "LREN3.SA",
    "BBAS3.SA",
    "RADL3.SA",
]

# Instruments shown in the report's volatility and heatmap sections.
FOCUS_TICKERS = ["PETR4.SA", "VALE3.SA", "ITUB4.SA", "BBDC4.SA", "ABEV3.SA"]

# The characters of Unicode's White_Space property.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

TICKER_SUFFIX = ".SA"
DEFAULT_SOURCE = "yahoo_finance"
HISTORY_DAYS = 365

ROLLING_ROWS = 20
TRADING_DAYS_PER_YEAR = 252
BOLLINGER_WIDTH = 2.0
ZSCORE_LIMIT = 3.0
ZSCORE_MIN_VALUES = 5
HISTOGRAM_BINS = 60
TOP_SERIES = 5
SUMMARY_ROWS = 12

# Column names used by the price feeds.
FEED_COLUMNS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}
FEED_DATE_ALIASES = ["Date", "index", "Datetime"]

# Report labels.
REPORT_NAME_FORMAT = "report_%y%m%d_%H%M"
DATE_LABEL_FORMAT = "dd/MM/yy"
