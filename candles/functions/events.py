"""JSON events to flat bars and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candles.functions.columns import event_columns, text_date, text_time
from candles.schemas import BAR_COLUMNS, BAR_KEY, INDEX_EVENT, INTRADAY_EVENT, PRICE_COLUMNS, STOCK_EVENT

CORRUPT = "_corrupt"
# Intervals of minutes and hours; M is a month.
BELOW_A_DAY = "^[0-9]+[mhH]$"


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add `parsed`, and `_corrupt` with the text of events that are not JSON (else NULL).

    A field that cannot be read is NULL and its event stays; only such events are parsed again, to
    tell them from text that is no JSON at all. A filter on a parsed field would otherwise be pushed down together with a second parse
    of every event; as the output of a generator the struct is parsed once.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_json(text, wide, {"columnNameOfCorruptRecord": CORRUPT})
    return df.select("*", F.explode(F.array(parsed)).alias("parsed")).withColumn(
        CORRUPT, F.when(F.col(f"parsed.{CORRUPT}").isNotNull() & F.try_parse_json(text).isNull(), text))


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull() & F.col("parsed").isNotNull())


def corrupt(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull() | F.col("parsed").isNull())


def source_offset(events: DataFrame) -> Column:
    """The place of an event in its source, NULL where the source does not tell."""
    known = F.col("offset").cast("bigint") if "offset" in events.columns else F.lit(None).cast("bigint")
    return known.alias("source_offset")


def _prices(parent: str) -> list[Column]:
    return [F.col(f"{parent}.data.{c}").alias(c) for c in PRICE_COLUMNS]


def stock_bars(events: DataFrame) -> DataFrame:
    """Raw stock events to flat, typed rows; events that are not JSON give NULL fields.

    `bar_time` is the time of a bar below a day, from the event's field of that name: the event time is
    that of the crawl.
    """
    df = parse_json(events, STOCK_EVENT)
    return df.select(
        "parsed.symbol",
        "parsed.interval",
        text_date("parsed.event_date").alias("trade_date"),
        *_prices("parsed"),
        "parsed.event_date",
        "parsed.event_time",
        "parsed.source",
        F.when(F.col("parsed.interval").rlike(BELOW_A_DAY), F.col("parsed.bar_time")).alias("bar_time"),
        source_offset(df),
        "value",
        CORRUPT,
    )


def untimed() -> Column:
    """Whether a flat stock row is a bar below a day whose event did not tell its time."""
    return F.coalesce(F.col("interval").rlike(BELOW_A_DAY) & F.col("bar_time").isNull(), F.lit(False))


def with_marks(rows: DataFrame) -> DataFrame:
    """Flat stock rows with `bar_mark`: what tells bars below a day apart whose event did not tell their
    time, namely their prices and volume, and a number for those of a crawl that agree in all of them."""
    unmarked = untimed()
    nth = F.row_number().over(Window.partitionBy(*BAR_KEY, "event_time", *PRICE_COLUMNS).orderBy("source_offset", "value"))
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PRICE_COLUMNS], F.col("_nth").cast("string"))
    marked = rows.where(unmarked).withColumn("_nth", nth).withColumn("bar_mark", text).drop("_nth")
    return rows.where(~unmarked).withColumn("bar_mark", F.lit(None).cast("string")).unionByName(marked)


def index_bars(events: DataFrame) -> DataFrame:
    """Raw index events to flat, typed rows."""
    df = parse_json(events, INDEX_EVENT)
    return df.select(
        "parsed.index_code",
        text_date("parsed.event_date").alias("trade_date"),
        "parsed.event_type",
        *_prices("parsed"),
        "parsed.event_date",
        "parsed.event_time",
        "parsed.ingest_time",
        "parsed.source",
        "parsed.year",
        F.col("parsed.month").alias("event_month"),
        source_offset(df),
        "value",
        CORRUPT,
    )


def intraday_bars(events: DataFrame) -> DataFrame:
    """Raw intraday events, batch or stream: star-expanded, time parsed, arrival stamped."""
    df = valid(parse_json(events, INTRADAY_EVENT)).select("parsed.*").drop(CORRUPT)
    return df.withColumns({
        "time": text_time("time"),
        "volume": F.col("volume").cast("bigint"),
        "ingestion_time": F.current_timestamp(),
    })


def flatten_bars(df: DataFrame, *more: str) -> DataFrame:
    """Bars stored flat or with a nested `data` struct, to flat bars, with `more` of their columns."""
    keys = [c for c in BAR_COLUMNS if c not in PRICE_COLUMNS]
    if "data" in df.columns:
        return df.select(*keys, *[F.col(f"data.{c}").alias(c) for c in PRICE_COLUMNS], *more)
    return df.select(*BAR_COLUMNS, *more)


def nest_prices(df: DataFrame) -> DataFrame:
    return df.withColumn("data", F.struct(*PRICE_COLUMNS)).drop(*PRICE_COLUMNS)


def to_stock_events(df: DataFrame, source: str) -> DataFrame:
    """Flat bars to the nested stock event."""
    event = nest_prices(event_columns(df).withColumns({
        "event_type": F.lit("ohlcv"), "source": F.lit(source),
    }))
    return event.select(
        "event_type", "symbol", "interval", "event_date", "event_time", "source", "data"
    )


def to_index_events(df: DataFrame, source: str, ingest_time: str | Column) -> DataFrame:
    """Flat index bars (`index_code`) to the nested index event."""
    stamped = F.lit(ingest_time) if isinstance(ingest_time, str) else ingest_time
    event = nest_prices(event_columns(df).withColumns({
        "event_type": F.lit("market_index"), "source": F.lit(source), "ingest_time": stamped,
    }))
    return event.select(
        "event_type", "index_code", "event_date", "event_time", "ingest_time", "source",
        "year", "month", "data",
    )


def to_kafka_records(df: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """`key`, `value` and `topic` columns, as the Kafka sink takes them; key NULL if none."""
    text = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(
        text.alias("key"), F.to_json(F.struct("*")).alias("value"), F.lit(topic).alias("topic")
    )


def profile_events(
    df: DataFrame, order: str, event_time: str | Column, source: str, symbol: str = "symbol"
) -> DataFrame:
    """First profile row of each symbol as an event whose `data` is a free-form text map."""
    fields = [c for c in df.columns if c != symbol]
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in fields]
    stamped = F.lit(event_time) if isinstance(event_time, str) else event_time
    # min_by keeps one row per symbol and map task before the shuffle.
    first = df.withColumn("_data", F.map_from_entries(F.array(*pairs))).groupBy(symbol).agg(
        F.min_by(F.map_entries("_data"), order).alias("_entries")
    )
    return first.select(
        F.lit("fundamental_profile").alias("event_type"),
        symbol,
        stamped.alias("event_time"),
        F.lit(source).alias("source"),
        F.map_from_entries("_entries").alias("data"),
    )


def to_long(df: DataFrame, ids: list[str]) -> DataFrame:
    """Wide profile to one (field, value) row per column; the form that scales of a transpose."""
    rest = [c for c in df.columns if c not in ids]
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in rest])
    return text.unpivot(ids, rest, "field", "value")
