"""The batch jobs: land, daily view, analyst, compaction, serving reads."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candles import schemas
from candles.functions.columns import normalize_date, row_key, text_time, with_month
from candles.functions.events import CORRUPT, flatten_bars, index_bars, stock_bars, untimed, with_marks
from candles.operators.bars import latest_date, newest
from candles.operators.incremental import SERIES_KEY, new_rows
from candles.operators.indicators import VIEW_PAST, indicators
from candles.operators.quality import counted, is_complete
from candles.operators.series import BARS, Series
from candles.session import discard, scratch, scratch_removed
from candles.sources.readers import any_of, partition_values, run_ended
from candles.sources.sinks import BAR_PARTITIONS, INDEX_PARTITIONS, read_table, upsert, write_bars

INDEX_KEY = ["index_code", "trade_date"]


def _land(
    rows: DataFrame, path: str, named: str, key: list[str], order: list[str], partition_cols: list[str],
    rejected: str | None,
) -> int:
    reason = F.when(F.col(CORRUPT).isNotNull(), "not json").when(F.col(named).isNull(), f"no {named}").when(
        F.col("trade_date").isNull(), "no date")
    with scratch_removed(rows.sparkSession):
        # The feed is read and parsed once; all that follows starts from this copy. The text of an event is kept
        # where something asks for it: it was refused, or its bar has no time and stands by its place among others.
        rows, asked = rows.withColumn("reason", reason), F.col("reason").isNotNull()
        asked = asked | untimed() if "bar_time" in rows.columns else asked
        rows = _computed(rows.withColumn("value", F.when(asked, F.col("value"))), "parsed")
        refused, seen = counted(rows.filter("reason is not null").select("value", "reason").distinct(), "rejected")
        upsert(refused, rejected or f"{path.rstrip('/')}.rejected", ["reason", "value"], [], ["reason"])
        good = rows.filter("reason is null")
        good = (with_marks(good) if "bar_time" in good.columns else good).drop(CORRUPT, "reason", "value")
        upsert(with_month(good), path, key, order, partition_cols, stored_rows=True)
        return seen.get["n"]


def land_ohlcv(
    events: DataFrame, path: str, partition_cols: list[str] = BAR_PARTITIONS, rejected: str | None = None
) -> int:
    """Raw stock events into the bar table; landing the same events again changes nothing.

    Of one bar's events the newest by event time, then by its place in the source, counts. Bars below
    a day are told apart by their time, if the event tells it (`bar_time`; the event time is that of the
    crawl). Those that do not are all kept: two of a day are the same bar only if they agree in all
    prices and the volume, and stand at the same place among the equal ones of their crawl. Events that are not JSON or lack a symbol or date are kept with
    the reason in `rejected` (by default beside the table); their number is returned.
    """
    return _land(stock_bars(events), path, "symbol", schemas.LANDED_KEY, ["event_time", "source_offset"], partition_cols, rejected)


def land_market(
    events: DataFrame, path: str, partition_cols: list[str] = INDEX_PARTITIONS, rejected: str | None = None
) -> int:
    """Raw index events into the index table. The event time of all revisions of a bar is its date, so
    the time of ingestion tells which is newest."""
    return _land(index_bars(events), path, "index_code", INDEX_KEY, ["ingest_time", "source_offset"], partition_cols, rejected)


#: Bars below a day: one series may have thousands a day, so it is cut into slices.
INTRADAY = Series(order=("bar_at",), dated=False)


def intraday_view(bars: DataFrame) -> DataFrame:
    """Flat bars of less than a day with their time `bar_at` and the row key; bars whose event did not tell their
    time cannot be put in order and stay in the landed table."""
    at = bars.withColumn("bar_at", text_time("bar_time")).where("bar_at is not null")
    return normalize_date(flatten_bars(at, "bar_at")).withColumn("es_id", row_key(*INTRADAY.keys, F.col("bar_at").cast("string")))


def daily_view(bars: DataFrame) -> DataFrame:
    """Flat bars with a DATE and the daily row key."""
    flat = normalize_date(flatten_bars(bars))
    return flat.withColumn("es_id", row_key(*schemas.BAR_KEY))


def analyst(
    bars: DataFrame,
    stored: DataFrame | None,
    history: str = "full",
    policy: str = "anti",
    series: Series = BARS,
) -> DataFrame:
    """Indicators of the bars the stored view lacks, with the running totals beside them.

    history="full" computes them over the whole series and then keeps the new rows.
    "continue" computes them for rows newer than the stored ones, from the newest stored rows
    and their totals; late rows are left to "full". "new_only" lets every run start its
    averages afresh.
    """
    if series.dated:
        bars = normalize_date(flatten_bars(bars))
    if stored is None:
        return indicators(bars, series, so_far=True)
    if history == "new_only":
        return indicators(new_rows(bars, stored, policy, series.keys, series.time), series, so_far=True)
    if history == "full":
        return new_rows(indicators(bars, series, so_far=True), stored, policy, series.keys, series.time)
    if history == "continue":
        fresh = new_rows(bars, stored, "max_date", series.keys, series.time)
        seeds = newest(stored, VIEW_PAST, series.keys, series.order)
        return indicators(fresh, series, seeds, so_far=True)
    raise ValueError(f"unknown history {history!r}")


def run_daily(bars: DataFrame, path: str, series: Series = BARS) -> None:
    """Keep the daily view at `path`: whole bars replaced by key, in the folders that `bars` touches. With
    `INTRADAY` it keeps the bars below a day, which their time tells apart."""
    view = daily_view(bars) if series.dated else intraday_view(bars)
    upsert(with_month(view), path, [*series.keys, series.time])


def _view_of(bars: DataFrame, series: Series) -> DataFrame:
    return normalize_date(flatten_bars(bars)) if series.dated else intraday_view(bars).drop("es_id")


def _months_to_read(bars: DataFrame, state: DataFrame, series: Series) -> DataFrame:
    """`bars` in the months that have rows newer than their series' newest one in `state`, or rows of
    series that it lacks. Keys and times alone are read to find them."""
    keys = list(series.keys)
    known = latest_date(state, series.keys, series.time)
    times = series_times(bars, series).groupBy(*keys, "month").agg(F.max(series.time).alias("_newest"))
    joined = times.join(known, keys, "left")
    open_ = joined.where(F.col("latest_date").isNull() | (F.col("_newest") > F.col("latest_date")))
    return bars.filter(any_of(partition_values(open_, ["month"]), ["month"]))


def series_times(bars: DataFrame, series: Series) -> DataFrame:
    """Keys, time and month of bars."""
    if series.dated:
        return normalize_date(bars.select(*series.keys, series.time, "month"), series.time)
    return bars.select(*series.keys, text_time("bar_time").alias(series.time), "month").where(F.col(series.time).isNotNull())


def run_analyst(bars: DataFrame, path: str, series: Series = BARS) -> None:
    """Keep the indicator view at `path` up to date with `bars`.

    Beside the view lies a small table of each series' newest rows and totals (`path`.state). A run reads
    that table, the keys and times of all bars, and the months that have rows newer than their series'
    newest or rows of series that the table lacks; a series that is traded no more costs nothing. It computes
    and upserts those rows. Rows that are older are late and left to `run_corrections`. A run that is repeated after a
    failure starts from the same state and writes the same rows.
    """
    spark, state_path = bars.sparkSession, f"{path.rstrip('/')}.state"
    state = read_table(spark, state_path)
    if state is not None and "month" in bars.columns:
        bars = _months_to_read(bars, state, series)
    with scratch_removed(spark):
        fresh = analyst(_view_of(bars, series), state, "full" if state is None else "continue", series=series)
        fresh = _computed(fresh, "computed")
        upsert(with_month(fresh), path, [*series.keys, series.time], stored_rows=True)
        _keep_newest(fresh if state is None else state.select(*fresh.columns).unionByName(fresh), state_path, series)


def _computed(df: DataFrame, name: str) -> DataFrame:
    """`df`, written to scratch and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _keep_newest(rows: DataFrame, state_path: str, series: Series) -> None:
    """Replace the state by the newest of `rows`, which may come from that state."""
    kept = _computed(newest(rows, VIEW_PAST, series.keys, series.order).drop("nth"), "state")
    kept.write.mode("overwrite").parquet(state_path)


def run_corrections(changed: DataFrame, bars: DataFrame, path: str, series: Series = BARS) -> None:
    """Bring corrected and late bars into the indicator view at `path`.

    `changed` names them by series and time, and `bars`, the table by months, has them already. Of each
    series in `changed` the rows from its first changed bar on are computed anew, starting from
    the rows and totals that the view has before it; other series, and rows before, stay. Months before the
    first change are read only as far as the view's 29 rows of past reach, and only for those series. The
    state of `run_analyst` follows, so that runs after it go on from the corrected totals.
    """
    spark, keys, time = bars.sparkSession, list(series.keys), series.time
    state_path = f"{path.rstrip('/')}.state"
    view, state = read_table(spark, path), read_table(spark, state_path)
    if view is None or state is None:
        raise ValueError(f"there is no view at {path} to correct")
    with scratch_removed(spark):
        cuts = _computed(changed.groupBy(*keys).agg(F.min(time).alias("_cut")), "cuts")
        first = cuts.agg(F.date_format(F.min("_cut"), "yyyy-MM")).first()[0]
        if first is None:
            return
        later = _view_of(bars.filter(F.col("month") >= first), series).join(cuts, keys).where(F.col(time) >= F.col("_cut"))
        past = view.filter(F.col("month") <= cuts.agg(F.date_format(F.max("_cut"), "yyyy-MM")).first()[0])
        past = past.join(cuts, keys).where(F.col(time) < F.col("_cut"))
        # Rows that a series has in the months after one, down from its first change.
        per_month = past.groupBy(*keys, "month").agg(F.count(F.lit(1)).alias("_n"))
        after = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1))
        reached = per_month.withColumn("_after", F.coalesce(after, F.lit(0))).where(F.col("_after") < VIEW_PAST)
        needed = past.filter(any_of(partition_values(reached, ["month"]), ["month"]))
        seeds = _computed(newest(needed.drop("_cut"), VIEW_PAST, series.keys, series.order), "seeds")
        fresh = _computed(indicators(later.drop("_cut"), series, seeds, so_far=True), "computed")
        upsert(with_month(fresh), path, [*keys, time], stored_rows=True)
        others = state.join(cuts, keys, "left_anti").select(*fresh.columns)
        _keep_newest(others.unionByName(seeds.select(*fresh.columns)).unionByName(fresh), state_path, series)


def training_gate(spark: SparkSession, path: str, min_rows: int, holidays: list[str] = ()) -> bool:
    """Whether models may be trained on the bar table at `path`: the run that wrote it has ended, no day
    falls short and no market day is absent."""
    if not run_ended(spark, path):
        return False
    return is_complete(spark.read.parquet(path), min_rows, holidays=holidays)


def compact(spark: SparkSession, path: str, partition_cols: list[str], where: str | None = None) -> None:
    """Rewrite the chosen partitions into few, sorted files.

    `where` may name partition columns only, since folders are replaced as a whole. The compacted copy
    is complete in scratch, and has as many rows, before a folder of the table is replaced.
    """
    table = spark.read.parquet(path)
    if where:
        kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in partition_cols)
        try:
            spark.createDataFrame([], kinds).filter(where)
        except AnalysisException as error:
            raise ValueError(f"only partition columns can choose folders: {where}") from error
    chosen = table.filter(where) if where else table
    staged = scratch(spark, "compacted")
    try:
        chosen.write.parquet(staged)
        copy = spark.read.schema(table.schema).parquet(staged)
        if copy.count() != chosen.count():
            raise ValueError(f"{path} changed while it was compacted")
        write_bars(copy, path, partition_cols, mode="replace")
    finally:
        discard(spark, staged)


def candlestick(df: DataFrame, symbol: str | None = None, months: int = 12, end: str | None = None) -> DataFrame:
    """Chart data: the `months` before `end`, or before each symbol's newest bar.

    With `end` given, a monthly split is pruned to the folders that matter.
    """
    chosen = df if symbol is None else df.filter(F.col("symbol") == symbol)
    day = F.col("trade_date")
    if end is not None:
        last = F.lit(end).cast("date")
        chosen = chosen.filter((day > F.add_months(last, -months)) & (day <= last))
        if "month" in df.columns:
            first = F.date_format(F.add_months(last, -months), "yyyy-MM")
            chosen = chosen.filter(F.col("month").between(first, F.date_format(last, "yyyy-MM")))
        return chosen
    ends = latest_date(chosen, SERIES_KEY)
    if "month" in df.columns:
        # Months are found first, so that only folders that some chart needs are read: those of a symbol
        # suspended long ago and those of today, not the years between.
        month = F.trunc("latest_date", "month")
        needed = ends.where("latest_date is not null").select(
            F.explode(F.sequence(F.add_months(month, -months), month, F.expr("interval 1 month"))).alias("month"))
        named = needed.select(F.date_format("month", "yyyy-MM").alias("month"))
        chosen = chosen.filter(any_of(partition_values(named, ["month"]), ["month"]))
    recent = chosen.join(ends, list(SERIES_KEY))
    return recent.filter(day > F.add_months("latest_date", -months)).select(*df.columns)


def search(df: DataFrame, predicate=None, n: int = 10) -> DataFrame:
    """The `n` newest matching bars, ties by symbol."""
    found = df if predicate is None else df.filter(predicate)
    return found.orderBy(F.desc("trade_date"), F.desc("symbol"), F.desc("interval")).limit(n)


def folder_months(df: DataFrame) -> list[str]:
    """Months of a table's folders, newest first; names are listed and no file is opened."""
    found = {m for f in df.inputFiles() for m in re.findall(r"/month=([0-9]{4}-[0-9]{2})/", f)}
    return sorted(found, reverse=True)


def search_early(df: DataFrame, predicate=None, n: int = 10) -> DataFrame:
    """What `search` returns, from a table by months of which only the newest are read.

    Months are read from the newest on, twice as many each time, until `n` rows match: no row of an unread
    month can be newer than the nth. If fewer match, all months have been read.
    """
    months, taken = folder_months(df), 1
    while True:
        some = df.filter(F.col("month").isin(months[:taken]))
        found = search(some, predicate, n)
        if taken >= len(months) or found.count() == n:
            return found
        taken *= 2


def top_movers(df: DataFrame, group: str, n: int = 10, as_of: str | None = None, interval: str = "1D") -> DataFrame:
    """Ranking of one day, the newest up to `as_of`: top_gain, top_lose or top_volume.

    Symbols without a bar of that day are not ranked; a return is measured from a symbol's bar before.
    Only the two newest bars of a symbol leave a task.
    """
    value = {
        "top_gain": F.col("_return"), "top_lose": F.col("_return"),
        "top_volume": F.col("_volume").cast("double"),
    }
    if group not in value:
        raise ValueError(f"unknown group {group!r}")
    known = df.filter(F.col("interval") == interval).select("symbol", "trade_date", "close", "volume")
    if as_of is not None:
        known = known.filter(F.col("trade_date") <= F.lit(as_of).cast("date"))
    newest_day = known.agg(F.max("trade_date")).first()[0]
    last = newest(known, 2, ("symbol",))
    pairs = last.groupBy("symbol").agg(
        F.max("trade_date").alias("_day"),
        F.max(F.when(F.col("nth") == 1, F.col("close"))).alias("_close"),
        F.max(F.when(F.col("nth") == 2, F.col("close"))).alias("_before"),
        F.max("nth").alias("_bars"),
        F.max(F.when(F.col("nth") == 1, F.col("volume"))).alias("_volume"),
    ).filter(F.col("_day") == F.lit(newest_day).cast("date"))
    change = F.try_divide((F.col("_close") - F.col("_before")).cast("double"), F.col("_before").cast("double")) * 100
    ranked = pairs.withColumn("_return", F.when(F.col("_bars") == 1, 0.0).otherwise(change)).select(
        "symbol", value[group].alias("value")
    ).na.drop()
    order = F.asc("value") if group == "top_lose" else F.desc("value")
    first = ranked.orderBy(order, "symbol").limit(n)
    # The ranking is `n` rows long, so numbering it in one task is safe.
    listed = first.agg(F.sort_array(F.collect_list(F.struct(
        (F.col("value") if group == "top_lose" else -F.col("value")).alias("by"), "symbol", "value"
    ))).alias("rows"))
    return listed.select(F.posexplode("rows").alias("_i", "_row")).select(
        (F.col("_i") + 1).cast("bigint").alias("rank"), "_row.symbol", "_row.value"
    )
