"""Next-close prediction: label, time split, two regressors and their errors."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candles.operators.bars import SERIES
from candles.operators.indicators import next_close
from candles.operators.quality import is_complete
from candles.operators.series import BARS, RowValue, Series, with_past
from candles.schemas import PRICE_COLUMNS
from candles.session import scratch, scratch_removed
from candles.sources.sinks import metrics_frame

LABEL = "close_next"
#: Training rows of a partition, about: a forest's task reads its partition from memory at some 200 bytes a row.
FIT_ROWS = 500_000


def labelled(bars: DataFrame, series: Series = BARS) -> DataFrame:
    """Bars with `close_next` and its date `next_date`."""
    return next_close(bars, series, LABEL, "next_date")


def time_split(df: DataFrame, cut: str, embargo: int = 0) -> tuple[DataFrame, DataFrame]:
    """Labelled rows before `cut` and from it on.

    The label of the last training row of a series is its first test close; embargo=1 drops
    that row.
    """
    bound = F.lit(cut).cast("date")
    train = df.filter(F.col("trade_date") < bound)
    if embargo:
        train = train.filter(F.col("next_date") < bound)
    return train, df.filter(F.col("trade_date") >= bound)


def split_once(bars: DataFrame, cut: str, *more: str) -> tuple[DataFrame, DataFrame]:
    """Prices and labels (and columns `more`) of the training and the test rows, written to scratch: bars
    are made and put in order once, however often a fit passes over them."""
    spark, path = bars.sparkSession, scratch(bars.sparkSession, "labelled")
    rows = labelled(bars).select("trade_date", *PRICE_COLUMNS, LABEL, *more)
    rows.write.parquet(path)
    train, test = time_split(spark.read.schema(rows.schema).parquet(path), cut)
    return train.drop("trade_date"), test.drop("trade_date")


def spread(train: DataFrame) -> DataFrame:
    """`train` in even partitions, more of them the more rows there are; as it is if no partition has more
    than `FIT_ROWS` rows. A forest draws its samples by partition, so its trees depend on them."""
    sizes = train.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return train.repartition(-(-row["all"] // FIT_ROWS)) if (row["most"] or 0) > FIT_ROWS else train


def assembler(columns: list[str] = PRICE_COLUMNS) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features")


def fit_linear(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=[assembler(), LinearRegression(labelCol=LABEL)]).fit(train)


def fit_forest(train: DataFrame, trees: int = 100, seed: int = 42) -> PipelineModel:
    forest = RandomForestRegressor(labelCol=LABEL, numTrees=trees, seed=seed)
    return Pipeline(stages=[assembler(), forest]).fit(train)


def evaluate(predicted: DataFrame) -> dict[str, float]:
    """RMSE and R2 from one pass over the scored rows."""
    miss = F.col(LABEL) - F.col("prediction")
    row = predicted.agg(F.avg(miss * miss).alias("error"), F.var_pop(LABEL).alias("spread")).first()
    return {"rmse": math.sqrt(row.error), "r2": 1 - row.error / row.spread if row.spread else float("nan")}


def train_and_score(
    bars: DataFrame, cut: str, symbol: str | None = None, trees: int = 100, min_rows: int = 0
) -> DataFrame:
    """RMSE and R2 of both models, over one symbol or over all of them together.

    With `min_rows`, days with fewer bars fail the run before anything is trained.
    """
    if min_rows and not is_complete(bars, min_rows):
        raise ValueError(f"there are days with fewer than {min_rows} bars")
    chosen = bars if symbol is None else bars.filter(F.col("symbol") == symbol)
    # The fits iterate over the training rows; bars are made and put in order once for both sides.
    rows = labelled(chosen).select("trade_date", *PRICE_COLUMNS, LABEL).persist()
    train, test = (side.drop("trade_date") for side in time_split(rows, cut))
    train = spread(train).persist()
    try:
        models = {"linear": fit_linear(train), "forest": fit_forest(train, trees)}
        metrics = [
            (name, metric, value)
            for name, model in models.items()
            for metric, value in evaluate(model.transform(test)).items()
        ]
    finally:
        train.unpersist()
        rows.unpersist()
    return metrics_frame(bars.sparkSession, metrics)


def linear_scores(bars: DataFrame, cut: str) -> DataFrame:
    """RMSE and R2 of the linear model over all bars."""
    with scratch_removed(bars.sparkSession):
        train, test = split_once(bars, cut)
        scores = evaluate(fit_linear(train).transform(test))
    return metrics_frame(bars.sparkSession, [("linear", name, value) for name, value in scores.items()])


def _forest_scored(bars: DataFrame, cut: str, trees: int, *more: str) -> tuple[DataFrame, Column, Column]:
    """Scored test rows with columns `more`, and the squared errors of the forest and of the training
    rows' mean label."""
    train, test = split_once(bars, cut, *more)
    mean = train.agg(F.avg(LABEL)).first()[0]
    scored = fit_forest(spread(train.select(*PRICE_COLUMNS, LABEL)), trees).transform(test)
    miss, plain = F.col(LABEL) - F.col("prediction"), F.col(LABEL) - F.lit(mean)
    return scored, miss * miss, plain * plain


def forest_against_mean(bars: DataFrame, cut: str, trees: int = 20) -> DataFrame:
    """(model, n, beats_mean): test rows the forest scored, and whether its error is below that of
    always saying the training rows' mean label."""
    scored, error, plain = _forest_scored(bars, cut, trees)
    return scored.agg(
        F.lit("forest").alias("model"), F.count("prediction").alias("n"), (F.avg(error) < F.avg(plain)).alias("beats_mean"))


def forest_by_symbol(bars: DataFrame, cut: str, trees: int = 20) -> DataFrame:
    """(model, symbol, n, beats_mean): the test rows of each symbol that the forest scored, and whether its
    error over all of them is below that of always saying the training rows' mean label."""
    scored, error, plain = _forest_scored(bars, cut, trees, "symbol")
    sums = scored.groupBy("symbol").agg(
        F.count("prediction").alias("n"), F.sum(error).alias("_error"), F.sum(plain).alias("_plain"))
    # The test rows are scored once; what follows has a row for each symbol.
    path = scratch(bars.sparkSession, "forest")
    sums.write.parquet(path)
    sums = bars.sparkSession.read.schema(sums.schema).parquet(path)
    better = sums.agg((F.sum("_error") < F.sum("_plain")).alias("better")).first()[0]
    return sums.where("n > 0").select(F.lit("forest").alias("model"), "symbol", "n", F.lit(better).cast("boolean").alias("beats_mean"))


def walk_forward(bars: DataFrame, series: Series = BARS, least: int = 2) -> DataFrame:
    """Bars with `slope`, `intercept` and `prediction` of the next close, each from the rows before it.

    At every bar, next close on close is fitted by least squares to all pairs of the series that are
    known by then, the last one ending in this bar's close. All these fits come from running sums of
    products, so the series is passed over once, however many dates models are cut at. NULL where fewer
    than `least` pairs are known or all closes so far are the same; pairs with a missing close do not count.
    """
    def pair(value) -> RowValue:
        def row_value(cur, prev):
            x, y = prev("close").cast("double"), cur("close").cast("double")
            return F.when(x.isNotNull() & y.isNotNull(), value(x, y))
        return row_value

    sums = {"pairs": lambda x, y: F.lit(1.0), "x": lambda x, y: x, "y": lambda x, y: y, "xx": lambda x, y: x * x, "xy": lambda x, y: x * y}
    past = with_past(bars, series, 1, {name: pair(value) for name, value in sums.items()})
    n, x, y, xx, xy = (F.col(f"_total_{name}") for name in sums)
    slope = F.when(n >= least, F.try_divide(n * xy - x * y, F.nullif(n * xx - x * x, F.lit(0.0))))
    fitted = past.filter(~F.col("_copied")).withColumn("slope", slope).withColumn("intercept", (y - F.col("slope") * x) / n)
    return fitted.withColumn("prediction", F.col("intercept") + F.col("slope") * F.col("close")).select(
        *bars.columns, "slope", "intercept", "prediction")


def ols_close(train: DataFrame) -> DataFrame:
    """One-feature least squares per symbol: next close on close."""
    return train.groupBy(*SERIES).agg(
        F.regr_slope(LABEL, "close").alias("slope"),
        F.regr_intercept(LABEL, "close").alias("intercept"),
    )


def naive_rmse(test: DataFrame) -> DataFrame:
    """Error of predicting that tomorrow's close is today's."""
    miss = (F.col(LABEL) - F.col("close")).cast("double")
    return test.groupBy(*SERIES).agg(F.sqrt(F.avg(miss * miss)).alias("value"))


def naive_r2(test: DataFrame) -> DataFrame:
    miss = (F.col(LABEL) - F.col("close")).cast("double")
    spread = F.var_pop(LABEL)
    return test.groupBy(*SERIES).agg((1 - F.try_divide(F.avg(miss * miss), spread)).alias("value"))
