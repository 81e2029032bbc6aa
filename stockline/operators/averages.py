"""Historical averages and their use as predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockline import spec

# Grain and output column of each historical average.
GRAINS = {
    "prediction_avg": (spec.STORE, spec.ITEM),
    "prediction_avg_dow": (spec.STORE, spec.ITEM, "DayOfWeek"),
    "prediction_avg_month": (spec.STORE, spec.ITEM, "Month"),
    "prediction_avg_all_store": (spec.ITEM,),
    "prediction_avg_dow_all_store": (spec.ITEM, "DayOfWeek"),
    "prediction_avg_month_all_store": (spec.ITEM, "Month"),
}
ITEM_AVERAGE = "prediction_avg_all_store"
ITEM_DAY_AVERAGE = "prediction_avg_dow_all_store"
# Fixed value: rows of the finest grain that one task expands to all grains.
EXPANDED_ROWS = 100_000


def historical_average(df: DataFrame, name: str, value: str = spec.QUANTITY) -> DataFrame:
    return df.groupBy(*GRAINS[name]).agg(F.avg(value).alias(name))


def all_averages(df: DataFrame, value: str = spec.QUANTITY) -> DataFrame:
    """Every historical average from one pass over the fact.

    Sums and counts are first combined at the finest grain; the grouping sets
    then multiply those few rows instead of the fact. Where they are not few,
    they are dealt to tasks by their number: six rows for each in a hash table
    are far larger than the compressed bytes that Spark cuts tasks by.
    """
    finest = [spec.STORE, spec.ITEM, "DayOfWeek", "Month"]
    partial = df.groupBy(*finest).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    tasks = max(1, -(-df.count() // EXPANDED_ROWS))
    # A store and item have few rows; by all of the columns, Spark would take the partitions of the aggregation.
    partial = partial.repartition(tasks, spec.STORE, spec.ITEM)
    sets = [[F.col(c) for c in grain] for grain in GRAINS.values()]
    return (partial.groupingSets(sets, *[F.col(c) for c in finest])
            .agg(F.grouping_id().alias("grain"),
                 F.try_divide(F.sum("__sum"), F.sum("__n")).alias("average")))


def with_average(test: DataFrame, train: DataFrame, name: str, value: str = spec.QUANTITY) -> DataFrame:
    """Join one historical average of ``train`` to the rows of ``test``."""
    return test.join(historical_average(train, name, value), list(GRAINS[name]), "left")


def with_item_averages(test: DataFrame, train: DataFrame, value: str = spec.QUANTITY,
                       names: Sequence[str] = (ITEM_AVERAGE, ITEM_DAY_AVERAGE)) -> DataFrame:
    for name in names:
        test = with_average(test, train, name, value)
    return test


def predict_by_average(test: DataFrame, train: DataFrame, value: str = spec.QUANTITY,
                       source: str = ITEM_AVERAGE) -> DataFrame:
    """Test rows with complete averages, one of them taken as the prediction."""
    return (with_item_averages(test, train, value).na.drop("any")
            .withColumn("prediction", F.col(source)))
