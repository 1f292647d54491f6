"""The speed layer: parse, one-step EMA, dedup, candles and indicators with memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from candles.functions.columns import row_key
from candles.operators.bars import candles, newest
from candles.operators.indicators import ema, ema_one_step, rsi, sma
from candles.operators.series import TICKS, Series
from candles.session import discard, scratch, scratch_removed
from candles.sources.sinks import read_batches, read_table, write_batch


def start(
    df: DataFrame,
    each_batch,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run `each_batch(rows, batch_id)` on every micro-batch, every ten seconds by default."""
    writer: DataStreamWriter = df.writeStream.foreachBatch(each_batch).outputMode(output_mode)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def append_batches(path: str):
    """Micro-batch sink: each batch in its own folder, so a replay writes the same rows again."""

    def each(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, path, batch_id)

    return each


def ema_batches(path: str, period: int = 5, series: Series = TICKS, value: str = "close"):
    """Per micro-batch: one-step EMA within the batch, row key, keyed append."""

    def each(rows: DataFrame, batch_id: int) -> None:
        close = rows if value == "close" else rows.withColumn("close", F.col(value))
        with scratch_removed(rows.sparkSession):
            keyed = ema_one_step(close, period, series).withColumn(
                "es_id", row_key(*series.keys, F.col(series.time).cast("string"))
            )
            write_batch(keyed, path, batch_id)

    return each


def dedup_stream(df: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of `keys` that arrive within `delay`; state older than that is freed."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def stream_candles(df: DataFrame, width: str, delay: str, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Tumbling candles on a stream. Ticks later than `delay` behind the newest are dropped."""
    return candles(df.withWatermark(order[0], delay), width, order)


class Remembered:
    """Indicators that continue across micro-batches.

    What a series must remember is small: its newest rows and its last averages. After each
    batch that state is written as a table under the batch's number, and the next batch reads
    it back. So a restarted or replayed batch starts from exactly the state it had, and the
    rows of a busy symbol are still spread over time slices within the batch.

    Rows at or before the newest remembered row of their symbol are late: they are left out
    and kept apart under `late`.
    """

    def __init__(self, path: str, series: Series = TICKS, value: str = "price") -> None:
        self.path, self.series, self.value = path, series, value

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What the batch before left; a series must not silently start afresh without it."""
        if batch_id == 0:
            return None
        state = read_table(spark, f"{self.path}/state/{batch_id - 1}")
        if state is None:
            raise ValueError(f"the state after batch {batch_id - 1} is missing below {self.path}")
        return state

    def _split_late(self, rows: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        if state is None:
            return rows, rows.limit(0)
        at = F.struct(*[F.col(c) for c in self.series.order])
        last = state.groupBy(*self.series.keys).agg(F.max(at).alias("_last"))
        joined = rows.join(last, list(self.series.keys), "left")
        known = F.col("_last").isNotNull() & (at <= F.col("_last"))
        return joined.filter(~known).drop("_last"), joined.filter(known).drop("_last")

    def _run(self, rows: DataFrame, batch_id: int, keep: int, compute, remember) -> None:
        spark = rows.sparkSession
        columns = [*self.series.keys, *self.series.order, "close"]
        state = self._state(spark, batch_id)
        batch = rows.withColumn("close", F.col(self.value).cast("double")).select(*columns)
        late_path = f"{self.path}/late"
        with scratch_removed(spark):
            # The source and what stands before this sink run once: everything starts from this copy.
            copied = scratch(spark, "batch")
            batch.write.parquet(copied)
            batch = spark.read.schema(batch.schema).parquet(copied)
            fresh, late = self._split_late(batch, state)
            write_batch(late, late_path, batch_id)
            both = fresh.withColumn("_old", F.lit(False))
            if state is not None:
                # Only series that ticked are computed; the others' state is passed on.
                ticked = batch.select(*self.series.keys).distinct()
                old = state.join(ticked, list(self.series.keys), "left_semi")
                both = both.unionByName(old.select(*columns).withColumn("_old", F.lit(True)))
            write_batch(compute(both).filter(~F.col("_old")).drop("_old"), f"{self.path}/out", batch_id)
            # The written output is read back, so that the state costs no second pass.
            kept = remember(spark.read.parquet(f"{self.path}/out/batch={batch_id}")).select(*columns)
            if state is not None:
                kept = kept.unionByName(state.select(*columns))
            kept = newest(kept, keep, self.series.keys, self.series.order).drop("nth")
            kept.write.mode("overwrite").parquet(f"{self.path}/state/{batch_id}")
        if batch_id > 1:  # a replay needs the state before the last batch, nothing older
            discard(spark, f"{self.path}/state/{batch_id - 2}")

    def sma(self, n: int):
        """Micro-batch function: mean of the last `n` values as `value`."""

        def each(rows: DataFrame, batch_id: int) -> None:
            self._run(
                rows, batch_id, max(n - 1, 1),
                lambda both: sma(both, n, self.series, "value"),
                lambda out: out,
            )

        return each

    def rsi(self, n: int = 14):
        """Micro-batch function: relative strength over the last `n` changes as `value`. The change of
        the oldest remembered row is not looked at, so one more row is kept."""

        def each(rows: DataFrame, batch_id: int) -> None:
            self._run(
                rows, batch_id, n,
                lambda both: rsi(both, n, self.series, "value"),
                lambda out: out,
            )

        return each

    def ema(self, period: int):
        """Micro-batch function: recursive EMA as `value`. The remembered row carries it."""

        def each(rows: DataFrame, batch_id: int) -> None:
            self._run(
                rows, batch_id, 1,
                lambda both: ema(both, {"value": period}, series=self.series),
                lambda out: out.withColumn("close", F.col("value")),
            )

        return each

    def result(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, f"{self.path}/out", [*self.series.keys, *self.series.order])

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/late")
