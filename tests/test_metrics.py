import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from stockline.functions import metrics

PAIRS = [(0.0, 1.0), (2.0, 1.0), (1.0, 2.0), (0.0, 0.0), (3.0, -2.0)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(PAIRS, "TotalQtySale double, prediction double")


def test_standard_measures(scored):
    row = metrics.evaluate(scored).first()
    for name in ("rmse", "mse", "r2", "mae"):
        judge = RegressionEvaluator(labelCol="TotalQtySale", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(judge.evaluate(scored))
    assert row.mape == pytest.approx((50 + 100 + 500 / 3) / 3)
    logs = [(math.log(p + 1) - math.log(y + 1)) ** 2 for y, p in PAIRS if p > -1]
    assert row.rmsle == pytest.approx(math.sqrt(sum(logs) / len(logs)))
    assert row.accuracy == pytest.approx(100 - (math.exp(row.rmsle) - 1) * 100)
    assert row.percent_oos == pytest.approx(40)
    assert row.percent_oos_sale == pytest.approx(100 * 2 / 3)
    assert row.percent_sales_oos == pytest.approx((1 + 5) / 6)


def test_zero_actuals(scored):
    mean = sum(y for y, _ in PAIRS) / len(PAIRS)
    errors = [abs(y - p) / y if y else p / mean for y, p in PAIRS]
    row = metrics.evaluate(scored, measures={"m": metrics.mape_zero_safe, "s": metrics.smape}).first()
    assert row.m == pytest.approx(100 * sum(map(abs, errors)) / len(errors))
    parts = [100 * abs(p - y) / ((p + y) / 2) for y, p in PAIRS if p + y]
    assert row.s == pytest.approx(sum(parts) / len(parts))


def test_sold_only_misses(spark):
    df = spark.createDataFrame([(0.0, -1.0), (2.0, 1.0), (1.0, 5.0), (4.0, 4.0)], "TotalQtySale double, prediction double")
    row = metrics.evaluate(df, measures={
        "all": metrics.percent_oos, "sold": lambda y, p: metrics.percent_oos(y, p, sold_only=True)}).first()
    assert (row["all"], row["sold"]) == (50.0, 25.0)


def test_all_zero_actuals_do_not_fail(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "TotalQtySale double, prediction double")
    row = metrics.evaluate(df).first()
    assert row.r2 is None and row.mape is None and row.percent_oos_sale is None and row.percent_sales_oos is None


def test_groups(scored):
    from pyspark.sql import functions as F
    by = metrics.evaluate(scored.withColumn("sold", F.col("TotalQtySale") > 0), by=["sold"])
    assert by.count() == 2


def test_single_aggregation(scored):
    text = metrics.evaluate(scored)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
