"""Forecast error and out-of-stock measures as aggregate expressions.

Each function returns a ``Column`` aggregate, so any mix of them is computed
in one pass; ``evaluate`` bundles the standard set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockline import spec


def _error(y: Column, p: Column) -> Column:
    return p - y


def _both(y: Column, p: Column) -> Column:
    return y.isNotNull() & p.isNotNull()


def mse(y: Column, p: Column) -> Column:
    return F.avg(F.pow(_error(y, p), 2))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(_error(y, p)))


def r2(y: Column, p: Column) -> Column:
    spread = F.var_pop(F.when(_both(y, p), y))
    return 1 - F.try_divide(mse(y, p), spread)


def mape(y: Column, p: Column) -> Column:
    """Mean absolute percentage error; rows with a zero actual drop out."""
    return F.avg(F.try_divide(100 * F.abs(_error(y, p)), y))


def mape_zero_safe(y: Column, p: Column) -> Column:
    """As ``mape``, but a zero actual is measured against the mean actual.

    The mean factors out of the sum over the zero rows, so one pass suffices.
    """
    known = F.sum(F.when(y != 0, F.abs(F.try_divide(F.abs(_error(y, p)), y))))
    unsold = F.sum(F.when(y == 0, F.abs(p)))
    unsold_share = F.when(unsold.isNull(), F.lit(0.0)).otherwise(
        F.try_divide(unsold, F.abs(F.avg(y))))
    return 100 * F.try_divide(F.coalesce(known, F.lit(0.0)) + unsold_share, F.count(_error(y, p)))


def smape(y: Column, p: Column) -> Column:
    """Symmetric percentage error; rows where both sides are zero drop out."""
    return F.avg(F.try_divide(100 * F.abs(_error(y, p)), (p + y) / 2))


def rmsle(y: Column, p: Column) -> Column:
    """Root mean squared log error; rows outside the log's domain drop out."""
    return F.sqrt(F.avg(F.pow(F.log(p + 1) - F.log(y + 1), 2)))


def accuracy(y: Column, p: Column) -> Column:
    return 100 - (F.exp(rmsle(y, p)) - 1) * 100


def percent_oos(y: Column, p: Column, sold_only: bool = False) -> Column:
    """Share of all rows predicted below the actual.

    ``sold_only`` leaves out rows without sales from the count of misses.
    """
    missed = (p < y) & (y != 0) if sold_only else p < y
    return F.try_divide(100.0 * F.count_if(missed), F.count(F.lit(1)))


def percent_oos_sale(y: Column, p: Column) -> Column:
    return F.try_divide(100.0 * F.count_if(p < y), F.count_if(y > 0))


def percent_sales_oos(y: Column, p: Column) -> Column:
    """Share of the sold quantity that the prediction would not have covered."""
    short = F.when(p > y, F.lit(0.0)).otherwise(y - p)
    return F.try_divide(F.sum(short), F.sum(y))


STANDARD = {
    "rmse": rmse,
    "mse": mse,
    "r2": r2,
    "mae": mae,
    "mape": mape,
    "rmsle": rmsle,
    "accuracy": accuracy,
    "percent_oos": percent_oos,
    "percent_oos_sale": percent_oos_sale,
    "percent_sales_oos": percent_sales_oos,
}


def evaluate(df: DataFrame, actual: str = spec.QUANTITY, predicted: str = "prediction",
             measures: dict | None = None, by: list[str] | None = None) -> DataFrame:
    """One row of measures (or one per group of ``by``) from a single aggregation."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    wanted = measures or STANDARD
    return df.groupBy(*(by or [])).agg(*[fn(y, p).alias(name) for name, fn in wanted.items()])
