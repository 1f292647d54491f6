"""Technical indicators. Every function adds columns to the bars it is given.

Bars need one row per (symbol, interval, trade_date); run `quality.dedup_latest` first if
the feed repeats rows. Each call reads its input twice (once for the slice totals, once for
the rows, over one shared shuffle), so for several indicators prefer `indicators`, or write
the table between calls, over a long chain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candles.functions.columns import row_key
from candles.operators.series import (
    BARS,
    Accessor,
    RowValue,
    Series,
    earlier,
    matched,
    so_far,
    with_past,
)

LOSS_FLOOR = 1e-8


def _return_of(series: Series) -> RowValue:
    """Percent change to the previous close: 0 on the first bar, NULL after a close of 0."""

    def value(cur: Accessor, prev: Accessor) -> Column:
        before = prev("close")
        change = F.try_divide((cur("close") - before).cast("double"), before.cast("double"))
        return F.when(prev(series.time).isNull(), F.lit(0.0)).otherwise(change * 100)

    return value


def _one(cur: Accessor, prev: Accessor) -> Column:
    return F.lit(1)


def _opening_close(series: Series) -> RowValue:
    """The close of the first bar, 0 elsewhere: its running total is that first close."""
    return lambda cur, prev: F.when(
        prev(series.time).isNull(), cur("close").cast("double")
    ).otherwise(F.lit(0.0))


def _trailing_mean(series: Series, n: int) -> Column:
    mean = F.avg("close").over(series.frame().rowsBetween(-(n - 1), 0))
    return F.when(F.col("_total_n") >= n, mean)


def _finish(df: DataFrame) -> DataFrame:
    extra = [c for c in df.columns if c.startswith("_total_") or c == "_change"]
    return df.filter(~F.col("_copied")).drop("_copied", "_slice", *extra)


def vwap(df: DataFrame, series: Series = BARS, name: str = "vwap") -> DataFrame:
    """Running sum(close * volume) / max(sum(volume), 1)."""
    past = with_past(df, series, 1, _vwap_totals())
    return _finish(past.withColumn(name, _vwap()))


def _vwap_totals() -> dict[str, RowValue]:
    return {
        "turnover": lambda cur, prev: cur("close").cast("double") * cur("volume"),
        "volume": lambda cur, prev: cur("volume"),
    }


def _vwap() -> Column:
    return F.coalesce(F.col("_total_turnover"), F.lit(0.0)) / F.greatest(
        F.col("_total_volume"), F.lit(1)
    )


def sma(df: DataFrame, n: int, series: Series = BARS, name: str | None = None) -> DataFrame:
    """Mean of the last `n` closes, NULL while fewer than `n` bars exist."""
    past = with_past(df, series, n - 1, {"n": _one})
    return _finish(past.withColumn(name or f"ma{n}", _trailing_mean(series, n)))


def bollinger(df: DataFrame, n: int = 30, width: float = 2.0, series: Series = BARS) -> DataFrame:
    """`middle` = mean of `n` closes; `upper`, `lower` = middle +- width population deviations."""
    past = with_past(df, series, n - 1, {"n": _one})
    band = F.stddev_pop("close").over(series.frame().rowsBetween(-(n - 1), 0)) * width
    return _finish(
        past.withColumn("middle", _trailing_mean(series, n))
        .withColumn("upper", F.col("middle") + band)
        .withColumn("lower", F.col("middle") - band)
    )


def _lagged(series: Series, value: RowValue) -> Column:
    return value(F.col, lambda c: F.lag(c).over(series.frame()))


def daily_return(df: DataFrame, series: Series = BARS, name: str = "daily_return") -> DataFrame:
    past = with_past(df, series, 1)
    return _finish(past.withColumn(name, _lagged(series, _return_of(series))))


def _running_mean_totals(series: Series) -> dict[str, RowValue]:
    ret = _return_of(series)
    return {
        "return": lambda cur, prev: F.coalesce(ret(cur, prev), F.lit(0.0)),
        "returns": lambda cur, prev: F.when(ret(cur, prev).isNotNull(), 1).otherwise(0),
    }


def _running_mean() -> Column:
    return F.try_divide(F.col("_total_return"), F.col("_total_returns"))


def running_mean_return(
    df: DataFrame, series: Series = BARS, name: str = "cumulative_return"
) -> DataFrame:
    """Running mean of the daily returns so far, NULL returns skipped."""
    past = with_past(df, series, 1, _running_mean_totals(series))
    return _finish(past.withColumn(name, _running_mean()))


def compound_return(
    df: DataFrame, series: Series = BARS, name: str = "compound_return"
) -> DataFrame:
    """Percent change since the first close of the series."""
    past = with_past(df, series, 1, {"opening": _opening_close(series)})
    opening = F.col("_total_opening")
    return _finish(past.withColumn(name, F.try_divide(F.col("close") - opening, opening) * 100))


def _change(series: Series) -> Column:
    previous = F.lag("close").over(series.frame())
    return F.when(F.lag(series.time).over(series.frame()).isNull(), F.lit(0)).otherwise(
        F.col("close") - previous
    )


def _rsi(series: Series, n: int) -> Column:
    """Needs `_change`, `_total_n` and `n` rows of past."""
    last = series.frame().rowsBetween(-(n - 1), 0)
    gain = F.sum(F.greatest(F.col("_change"), F.lit(0))).over(last) / n
    loss = F.sum(F.greatest(-F.col("_change"), F.lit(0))).over(last) / n
    strength = gain / F.greatest(loss, F.lit(LOSS_FLOOR))
    return F.when(F.col("_total_n") >= n, 100 - 100 / (1 + strength))


def rsi(df: DataFrame, n: int = 14, series: Series = BARS, name: str | None = None) -> DataFrame:
    """Relative strength from plain sums over the last `n` changes; the first change is 0."""
    past = with_past(df, series, n, {"n": _one}).withColumn("_change", _change(series))
    return _finish(past.withColumn(name or f"rsi{n}", _rsi(series, n)))


# Longest trailing frame of the view below, less its own row.
VIEW_PAST = 29


def _view_totals(series: Series) -> dict[str, RowValue]:
    return {"n": _one, **_vwap_totals(), **_running_mean_totals(series)}


def indicators(
    df: DataFrame, series: Series = BARS, seeds: DataFrame | None = None, so_far: bool = False
) -> DataFrame:
    """The analyst's view: bars, their row key and eight indicators, from one shuffle.

    With `so_far` the running totals are kept as columns `<name>_so_far`. A view that has them
    can be continued: `seeds` are its newest rows, at most `VIEW_PAST` per series, all older
    than `df`. Then only `df` and the seeds are read, however long the history is.
    """
    totals = _view_totals(series)
    if seeds is not None:
        seeds = seeds.select(*df.columns, *[f"{n}_so_far" for n in totals], "nth")
        df = df.unionByName(seeds, allowMissingColumns=True)
        totals = {n: _continued(n, value) for n, value in totals.items()}
    past = with_past(df, series, VIEW_PAST, totals).withColumn("_change", _change(series))
    band = F.stddev_pop("close").over(series.frame().rowsBetween(-29, 0)) * 2
    full = past.withColumns({
        "es_id": row_key(*series.keys, series.time),
        "vwap": _vwap(),
        "ma7": _trailing_mean(series, 7),
        "ma30": _trailing_mean(series, 30),
        "daily_return": _lagged(series, _return_of(series)),
        "cumulative_return": _running_mean(),
        "rsi14": _rsi(series, 14),
        "_band": band,
    }).withColumns({
        "bollinger_upper": F.col("ma30") + F.col("_band"),
        "bollinger_lower": F.col("ma30") - F.col("_band"),
    })
    if seeds is not None:
        full = full.filter(F.col("nth").isNull()).drop("nth")
    names = [f"{n}_so_far" for n in totals]
    full = full.withColumns({f"{n}_so_far": F.col(f"_total_{n}") for n in totals}) if so_far else full.drop(*names)
    return _finish(full).drop("_band")


def _continued(name: str, value: RowValue) -> RowValue:
    """Row value after seeds: the newest seed brings the total so far, older ones nothing."""

    def row_value(cur: Accessor, prev: Accessor) -> Column:
        known = F.when(cur("nth") == 1, cur(f"{name}_so_far")).otherwise(F.lit(0))
        return F.when(cur("nth").isNull(), value(cur, prev)).otherwise(known)

    return row_value


# The columns of the stored indicator view, in order; a fixed layout.
INDICATOR_COLUMNS = [
    "symbol", "trade_date", "open", "high", "low", "close", "volume", "es_id",
    "vwap", "ma7", "ma30", "bollinger_upper", "bollinger_lower",
    "daily_return", "cumulative_return", "rsi14",
]


def ema_one_step(
    df: DataFrame, period: int = 5, series: Series = BARS, name: str = "ema"
) -> DataFrame:
    """k * close + (1 - k) * previous close with k = 2 / (period + 1); NULL on the first bar."""
    k = 2 / (period + 1)
    past = with_past(df, series, 1)
    previous = F.lag("close").over(series.frame())
    return _finish(past.withColumn(name, F.col("close") * k + previous * (1 - k)))


def next_close(
    df: DataFrame, series: Series = BARS, name: str = "close_next", time: str | None = None
) -> DataFrame:
    """Label every bar with the close that follows it (and, as `time`, when that was).

    The newest bar of a series has no label and is dropped.
    """
    frame = series.frame(backwards=True)
    past = with_past(df, series, 1, backwards=True).withColumn(name, F.lag("close").over(frame))
    if time:
        past = past.withColumn(time, F.lag(series.time).over(frame))
    return _finish(past).na.drop(subset=[name])


def ema(
    df: DataFrame, periods: dict[str, int], column: str = "close", series: Series = BARS
) -> DataFrame:
    """Recursive averages e(t) = k * x(t) + (1 - k) * e(t - 1), starting at e(1) = x(1).

    `periods` maps output column to period. A NULL leaves the average where it was.

    With r = 1 - k, e(t) = r^t * (e(0) + k * sum(x(i) * r^-i)): one running sum. It is taken over
    blocks of values short enough for r^-i to stay finite. A block maps the average before it to the
    one after it, w * e + v with w = r^size; these maps are put together along the blocks of a slice,
    and then along the slices of a series, so that every value counts.
    """
    ratio = {n: 1 - 2 / (p + 1) for n, p in periods.items()}
    x = F.col(column).cast("double")
    frame, parts = series.frame(), series.parts
    cut = series.cut(df).repartition(*parts)
    longest = min((int(-300 / math.log(r)) for r in ratio.values() if r > 0), default=300)
    at = F.count(column).over(so_far(frame))
    marked = cut.withColumns({
        "_at": at, "_block": F.floor(F.greatest(at - 1, F.lit(0)) / longest).cast("int"),
    }).withColumn("_place", F.col("_at") - F.col("_block") * longest)

    def own(r: float) -> Column:
        if r == 0:  # period 1: the average is the value itself
            return F.coalesce(F.max_by(x, F.when(x.isNotNull(), F.col("_at"))), F.lit(0.0))
        return F.pow(F.lit(r), F.max("_place")) * F.coalesce(
            F.sum(x * (1 - r) * F.pow(F.lit(r), -F.col("_place"))), F.lit(0.0))

    blocks = marked.groupBy(*parts, "_block").agg(
        F.max("_place").alias("n"),
        F.max(F.when((F.col("_at") == 1) & x.isNotNull(), x)).alias("_first"),
        *[own(r).alias(f"v_{n}") for n, r in ratio.items()],
    )
    slices = blocks.groupBy(*parts).agg(
        F.sum("n").alias("_values"), F.max("_first").alias("_first"),
        F.sort_array(F.collect_list(F.struct("_block", "n", *[f"v_{n}" for n in ratio]))).alias("_blocks"),
    ).withColumns({f"_map_{n}": _folded(n, r) for n, r in ratio.items()})
    maps = [f"_map_{n}" for n in ratio]
    if series.dated:
        slices = slices.withColumn("_start", F.lit(0)).withColumns({f"_enter_{n}": F.col("_first") for n in ratio})
    else:
        slices = _along_slices(slices, series, list(ratio))
    entering = slices.select(*parts, "_start", *maps, *[f"_enter_{n}" for n in ratio])

    out = matched(marked, entering, parts)
    within = so_far(Window.partitionBy(*parts, "_block").orderBy(*series.order))
    known = F.col("_start") + F.col("_at") > 0
    for name, r in ratio.items():
        block = F.element_at(f"_map_{name}.before", F.col("_block") + 1)
        before = block["w"] * F.col(f"_enter_{name}") + block["v"]
        if r == 0:
            value = F.coalesce(F.last(x, ignorenulls=True).over(within), before)
        else:
            total = F.coalesce(F.sum(x * (1 - r) * F.pow(F.lit(r), -F.col("_place"))).over(within), F.lit(0.0))
            value = F.pow(F.lit(r), F.col("_place")) * (before + total)
        out = out.withColumn(name, F.when(known, value))
    return out.drop("_slice", "_at", "_block", "_place", "_start", *maps, *[f"_enter_{n}" for n in ratio])


def _folded(name: str, r: float) -> Column:
    """The maps before each of `_blocks`, and (w, v) of all of them together."""
    kind = "array<struct<w: double, v: double>>"

    def step(done: Column, block: Column) -> Column:
        weight = F.pow(F.lit(r), block["n"])
        return F.struct(
            (done["w"] * weight).alias("w"), (done["v"] * weight + block[f"v_{name}"]).alias("v"),
            F.concat(done["before"], F.array(F.struct(done["w"].alias("w"), done["v"].alias("v")))).alias("before"))

    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("v"), F.array().cast(kind).alias("before"))
    return F.aggregate("_blocks", start, step)


def _along_slices(slices: DataFrame, series: Series, names: list[str]) -> DataFrame:
    """Put the slices' maps together by doubling: after i rounds a row stands for 2^i slices."""
    order = series.slices()
    rounds = ((slices.agg(F.max("_slice")).first()[0] or 0) + 1).bit_length()
    joined = slices.withColumns({
        "_start": F.coalesce(F.sum("_values").over(earlier(order)), F.lit(0)),
        "_opening": F.first("_first", ignorenulls=True).over(so_far(order)),
        **{f"_w_{n}": F.col(f"_map_{n}.w") for n in names}, **{f"_v_{n}": F.col(f"_map_{n}.v") for n in names},
    })
    for i in range(rounds):
        far = {c: F.coalesce(F.lag(c, 2**i).over(order), F.lit(d)) for n in names for c, d in ((f"_w_{n}", 1.0), (f"_v_{n}", 0.0))}
        joined = joined.withColumns({f"{c}_far": value for c, value in far.items()})
        joined = joined.withColumns({
            **{f"_v_{n}": F.col(f"_v_{n}") + F.col(f"_w_{n}") * F.col(f"_v_{n}_far") for n in names},
            **{f"_w_{n}": F.col(f"_w_{n}") * F.col(f"_w_{n}_far") for n in names},
        }).drop(*[f"{c}_far" for c in far])
    return joined.withColumns({
        f"_enter_{n}": F.coalesce(F.lag(f"_w_{n}").over(order), F.lit(1.0)) * F.col("_opening")
        + F.coalesce(F.lag(f"_v_{n}").over(order), F.lit(0.0)) for n in names})


def macd(
    df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, series: Series = BARS
) -> DataFrame:
    """`macd` = fast EMA - slow EMA, `signal` = EMA of `macd`, `histogram` = their difference.

    An EMA of an EMA is a weighted difference of two EMAs of the input when their periods
    differ, so all three lines come from one pass over the closes.
    """
    if signal in (fast, slow):
        lines = ema(df, {"_fast": fast, "_slow": slow}, series=series)
        lines = lines.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
        lines = ema(lines, {"signal": signal}, column="macd", series=series)
        return lines.withColumn("histogram", F.col("macd") - F.col("signal"))

    def smoothed(name: str, period: int) -> Column:
        r, s = 1 - 2 / (period + 1), 1 - 2 / (signal + 1)
        k, j = 1 - r, 1 - s
        return (F.col(name) * (r * j) - F.col("_signal") * (s * k)) / (r - s)

    lines = ema(df, {"_fast": fast, "_slow": slow, "_signal": signal}, series=series)
    return (
        lines.withColumn("macd", F.col("_fast") - F.col("_slow"))
        .withColumn("signal", smoothed("_fast", fast) - smoothed("_slow", slow))
        .withColumn("histogram", F.col("macd") - F.col("signal"))
        .drop("_fast", "_slow", "_signal")
    )
