"""Fixed schemas on the wire and at rest."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, REAL, LONG = T.StringType(), T.DoubleType(), T.LongType()

PRICES = _struct(open=REAL, high=REAL, low=REAL, close=REAL, volume=LONG)

# `bar_time` is an addition to the feed's event: of bars below a day it has only the day.
STOCK_EVENT = _struct(
    symbol=TEXT, interval=TEXT, event_date=TEXT, event_time=TEXT, bar_time=TEXT, source=TEXT, data=PRICES
)

INDEX_EVENT = _struct(
    event_type=TEXT, index_code=TEXT, event_date=TEXT, event_time=TEXT, ingest_time=TEXT,
    source=TEXT, year=T.IntegerType(), month=T.IntegerType(), data=PRICES,
)

# Volume is DOUBLE on the wire: producers send `2500.0`, which an INT field reads as NULL.
INTRADAY_EVENT = _struct(
    time=TEXT, symbol=TEXT, open=REAL, high=REAL, low=REAL, close=REAL, volume=REAL
)

TICK_EVENT = _struct(ts=TEXT, symbol=TEXT, event_id=LONG, price=LONG, volume=LONG)

BARS = _struct(
    symbol=TEXT, interval=TEXT, trade_date=T.DateType(), open=REAL, high=REAL, low=REAL,
    close=REAL, volume=LONG, event_date=TEXT, event_time=TEXT, source=TEXT, bar_time=TEXT,
    source_offset=LONG, bar_mark=TEXT, month=TEXT,
)

INDEX_BARS = _struct(
    index_code=TEXT, trade_date=T.DateType(), event_type=TEXT, open=REAL, high=REAL, low=REAL,
    close=REAL, volume=LONG, event_date=TEXT, event_time=TEXT, ingest_time=TEXT, source=TEXT,
    year=T.IntegerType(), event_month=T.IntegerType(), source_offset=LONG, month=TEXT,
)

PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]
BAR_COLUMNS = ["symbol", "interval", "trade_date", *PRICE_COLUMNS]
BAR_KEY = ["symbol", "interval", "trade_date"]
# Bars below a day also have a time, or a mark if that is not known; those of others are NULL.
LANDED_KEY = [*BAR_KEY, "bar_time", "bar_mark"]
