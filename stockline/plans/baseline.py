"""The baseline job: text files in, historical averages or a boosted model out."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from stockline import spec
from stockline.functions import metrics
from stockline.functions.dates import with_calendar
from stockline.operators import averages, clean
from stockline.operators.model import baseline_pipeline
from stockline.sources.files import read_csv

# Columns of the text files and their types.
SALES_COLUMNS = [
    "BranchCode", "MaterialCode", "Date", "avgPriceDis", "avgPrice", "supPrice", "label",
    "TotalNetSale", "TotalQtySale", "types", "Branch", "Name",
]
DOUBLES = ["avgPriceDis", "avgPrice", "TotalQtySale", "supPrice", "label", "TotalNetSale"]
INTEGERS = ["label", "ZipCode"]
DAYS = ["Date"]


def prepare(sales: DataFrame, locations: DataFrame) -> DataFrame:
    """All-text rows joined to their place, typed and given calendar columns."""
    present = [c for c in SALES_COLUMNS if c.lower() in {s.lower() for s in sales.columns}]
    rows = clean.drop_empty_rows(sales.select(*present).join(locations, spec.STORE, "left"))
    typed = clean.cast_ints(clean.cast_doubles(rows, DOUBLES), INTEGERS)
    return with_calendar(clean.cast_dates(typed, DAYS))


def read_inputs(spark: SparkSession, sales_path: str, location_path: str) -> DataFrame:
    return prepare(read_csv(spark, sales_path), read_csv(spark, location_path))


def average_baseline(rows: DataFrame, split=spec.START_OOT,
                     source: str = averages.ITEM_AVERAGE) -> tuple[DataFrame, DataFrame]:
    """Predictions of the historical average, and their evaluation."""
    train, test = clean.split_by_day(rows, split)
    predicted = averages.predict_by_average(test, train, source=source)
    return predicted, metrics.evaluate(predicted)


def boosted_baseline(rows: DataFrame, model_path: str, split=spec.START_OOT,
                     **params) -> tuple[DataFrame, DataFrame]:
    """Predictions of the boosted pipeline, saved and loaded again, and their evaluation."""
    train, test = clean.split_by_day(rows, split)
    fitted = baseline_pipeline(**params).fit(train)
    fitted.write().overwrite().save(model_path)
    predicted = PipelineModel.load(model_path).transform(test)
    wanted = metrics.STANDARD | {
        "percent_oos": lambda y, p: metrics.percent_oos(y, p, sold_only=True)}
    return predicted, metrics.evaluate(predicted, measures=wanted)
