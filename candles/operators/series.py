"""Ordered computations over series, of which some may be too long for one task.

A series with one row per date is bounded by the calendar (some 11,000 rows in 30 years): a plain
window over the series does. Trades have no such bound: a window over one symbol would put its whole
history into one task. Their rows are sorted by range of (keys, order), and every range is a slice: of
about the same size whatever the symbols' shares, so a quiet symbol lies in one slice and a busy one in
many, cut even inside one instant. Each slice receives what it needs from its past:

* copies of the last `rows` rows before it, so trailing frames and `lag` are exact;
* running totals up to its first row, attached to the last of those copies.

The cut rows are written once to the shared scratch folder, since a second sampling of the ranges could
cut elsewhere. What is passed between slices is one row of numbers per slice, and the edge rows, which
find the slices they belong to by a join on their position; no task sees all edges of a symbol.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candles.session import scratch

#: Rows of a slice, about: ranges are cut by a sample.
SLICE_ROWS = 2_000_000
Accessor = Callable[[str], Column]
RowValue = Callable[[Accessor, Accessor], Column]


@dataclass(frozen=True)
class Series:
    """What identifies a series and what orders it.

    `order` must be a total order within a series; its first column is the time. `dated` series have
    one row per date, others are cut into slices: `pieces` of them, or as many as adaptive execution
    finds right for the size of the data, and more where they would have more than `SLICE_ROWS` rows.
    """

    keys: tuple[str, ...] = ("symbol", "interval")
    order: tuple[str, ...] = ("trade_date",)
    dated: bool = True
    pieces: int | None = None

    @property
    def time(self) -> str:
        return self.order[0]

    @property
    def parts(self) -> tuple[str, ...]:
        """The columns that identify what one window sees."""
        return self.keys if self.dated else (*self.keys, "_slice")

    def cut(self, df: DataFrame) -> DataFrame:
        """`df` with the number of its slice; dated series and frames cut before stay as they are."""
        if self.dated or "_slice" in df.columns:
            return df
        by = [*self.keys, *self.order]
        # As many slices as tasks, or more, so that none has much above SLICE_ROWS rows.
        needed = self.pieces or -(-df.count() // SLICE_ROWS)
        usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = df.repartitionByRange(needed, *by) if self.pieces or needed > usual else df.repartitionByRange(*by)
        return _written(ranged.withColumn("_slice", F.spark_partition_id()), "slices")

    def frame(self, backwards: bool = False) -> WindowSpec:
        """Window over one slice (or dated series) in series order."""
        return Window.partitionBy(*self.parts).orderBy(*_directed(self.order, backwards))

    def slices(self, backwards: bool = False) -> WindowSpec:
        """Window over the one-row-per-slice summary of a series."""
        return Window.partitionBy(*self.keys).orderBy(*_directed(("_slice",), backwards))


BARS = Series()
TICKS = Series(keys=("symbol",), order=("ts", "event_id"), dated=False)


def matched(left: DataFrame, right: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Join on equal names; nulls are equal, so that a series without a symbol is one as well."""
    right = right.withColumnsRenamed({n: f"_its_{n}" for n in names})
    same = [F.col(n).eqNullSafe(F.col(f"_its_{n}")) for n in names]
    return left.join(right, same).drop(*[f"_its_{n}" for n in names])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _directed(names: tuple[str, ...], backwards: bool) -> list[Column]:
    return [F.col(n).desc() if backwards else F.col(n).asc() for n in names]


def whole(frame: WindowSpec) -> WindowSpec:
    return frame.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def so_far(frame: WindowSpec) -> WindowSpec:
    return frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def earlier(frame: WindowSpec) -> WindowSpec:
    return frame.rowsBetween(Window.unboundedPreceding, -1)


class _Previous:
    """Hands out lagged columns and remembers which ones were asked for."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def __call__(self, name: str) -> Column:
        if name not in self.names:
            self.names.append(name)
        return F.col(f"_prev_{name}")

    def columns(self, frame: WindowSpec) -> dict[str, Column]:
        return {f"_prev_{n}": F.lag(n).over(frame) for n in self.names}


def with_past(
    df: DataFrame,
    series: Series,
    rows: int,
    totals: dict[str, RowValue] | None = None,
    backwards: bool = False,
) -> DataFrame:
    """`df` cut into slices, each preceded by copies of the `rows` rows before it.

    Adds `_copied`, and for every entry of `totals` a column `_total_<name>`: the sum of that row
    value from the start of the series to the current row. A row value is a function of two
    accessors, the current row's columns and the previous row's (NULL on the first row of the
    series). Callers evaluate their own frames over `series.frame()` and then drop the rows with
    `_copied`. A dated series is not cut and has no copies.
    """
    totals = totals or {}
    rows = max(rows, 1)
    frame = series.frame(backwards)
    previous = _Previous()
    values = {name: value(F.col, previous) for name, value in totals.items()}
    cut = series.cut(df).repartition(*series.parts)
    merged = cut.withColumn("_copied", F.lit(False))
    if not series.dated:
        past = _past_of_slices(cut, series, rows, totals, backwards).repartition(*series.parts)
        merged = merged.unionByName(past, allowMissingColumns=True)
        values = {
            name: F.when(F.col("_copied"), F.col(f"_carry_{name}")).otherwise(value) for name, value in values.items()}
    merged = merged.withColumns(previous.columns(frame))
    merged = merged.withColumns({f"_total_{n}": F.sum(value).over(so_far(frame)) for n, value in values.items()})
    return merged.drop(*[f"_carry_{name}" for name in totals], *previous.columns(frame))


def _past_of_slices(
    cut: DataFrame, series: Series, rows: int, totals: dict[str, RowValue], backwards: bool
) -> DataFrame:
    """The rows that slices need from before them, with `_slice` naming who needs them."""
    frame, keys = series.frame(backwards), list(series.keys)
    names = [c for c in cut.columns if c != "_slice"]
    previous = _Previous()
    inner = {n: value(F.col, previous) for n, value in totals.items()}
    record = F.struct(*names)
    marked = cut.withColumns({
        "_at": F.row_number().over(frame),
        "_size": F.count(F.lit(1)).over(whole(frame)),
        **previous.columns(frame),
    })
    # One row per slice.
    summary = marked.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_size"),
        F.first(F.when(F.col("_at") == 1, record), ignorenulls=True).alias("_first"),
        F.first(F.when(F.col("_at") == F.col("_size"), record), ignorenulls=True).alias("_last"),
        *[F.sum(F.when(F.col("_at") > 1, value)).alias(f"_inner_{n}") for n, value in inner.items()],
    )
    order = series.slices(backwards)
    summary = summary.withColumns({
        "_start": F.coalesce(F.sum("_size").over(earlier(order)), F.lit(0)),
        "_before": F.lag("_last").over(order),
    })
    summary = summary.withColumns({
        f"_full_{n}": F.coalesce(F.col(f"_inner_{n}"), F.lit(0))
        + F.coalesce(value(lambda c: F.col("_first")[c], lambda c: F.col("_before")[c]), F.lit(0))
        for n, value in totals.items()
    }).withColumns({f"_carry_{n}": F.sum(f"_full_{n}").over(earlier(order)) for n in totals})
    carried = [f"_carry_{n}" for n in totals]
    starts = _written(summary.select(*keys, "_slice", "_start", *carried), "slice-starts")

    # A row is needed by the slices that start less than `rows` places after it. Places and starts
    # meet in buckets of `rows` places, so a row looks into two.
    edges = marked.filter(F.col("_size") - F.col("_at") < rows).select(*keys, "_slice", "_at", record.alias("_row"))
    edges = matched(edges, starts.select(*keys, "_slice", "_start"), (*keys, "_slice"))
    edges = edges.select(*keys, (F.col("_start") + F.col("_at")).alias("_place"), "_row")
    bucket = F.floor(F.col("_place") / rows)
    edges = edges.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1)))
    wanting = starts.withColumn("_bucket", F.floor(F.col("_start") / rows))
    needed = matched(edges, wanting, (*keys, "_bucket")).filter(
        (F.col("_place") <= F.col("_start")) & (F.col("_start") < F.col("_place") + rows))
    return needed.select(
        *[F.col("_row")[n].alias(n) for n in names],
        "_slice",
        F.lit(True).alias("_copied"),
        *[F.when(F.col("_place") == F.col("_start"), F.col(c)).alias(c) for c in carried],
    )
