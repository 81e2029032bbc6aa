"""Days since the last sale of a group, and the longest such run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockline.operators.trailing import (
    attach_to_rows, days_window, history_slice, output_slice, with_day_number)
from stockline.spec import RecencySpec


def group_day_flags(df: DataFrame, spec: RecencySpec, rolled: bool = False) -> DataFrame:
    """Whether anything of the group was sold on the day."""
    source = "flag" if rolled else spec.flag
    return df.groupBy(*spec.group_cols, spec.date).agg(F.max(source).alias(spec.flag))


def with_last_sale(daily: DataFrame, spec: RecencySpec) -> DataFrame:
    """Day of the latest sale that the lag leaves visible, within the longest gap."""
    frame = days_window(spec.group_cols, spec.longest + spec.lag, 1 + spec.lag)
    sale_day = F.when(F.col(spec.flag) == 1, F.col(spec.date))
    return with_day_number(daily, spec.date).select("*", F.max(sale_day).over(frame).alias("last_sell_date"))


def with_run(df: DataFrame, spec: RecencySpec) -> DataFrame:
    """Days without a sale as seen ``lag`` days ago; the longest gap if none is visible."""
    gap = F.datediff(F.col(spec.date), F.col("last_sell_date")) - spec.lag
    return df.select("*", F.coalesce(gap, F.lit(spec.longest)).alias(spec.run_column))


def with_longest_runs(df: DataFrame, spec: RecencySpec) -> DataFrame:
    return df.select("*", *[
        F.max(spec.run_column)
        .over(days_window(spec.group_cols, days + spec.lag + 1, spec.lag + 1))
        .alias(spec.max_column(days))
        for days in spec.horizons])


def daily_features(daily: DataFrame, spec: RecencySpec, start=None, end=None) -> DataFrame:
    """All recency columns from flags per group and day."""
    full = (daily
            .transform(with_last_sale, spec)
            .transform(with_run, spec)
            .transform(with_longest_runs, spec))
    return output_slice(full, start, end, spec.date).select(*spec.group_cols, spec.date, *spec.columns())


def recency_features(df: DataFrame, spec: RecencySpec, start=None, end=None,
                     rolled: bool = False) -> DataFrame:
    """All recency columns of a grouping set, one row per group and day."""
    recent = history_slice(df, start, spec.history_days(), spec.date, end)
    return daily_features(group_day_flags(recent, spec, rolled), spec, start, end)


def recency_row_features(df: DataFrame, spec: RecencySpec, keys: Sequence[str],
                         start=None, end=None) -> DataFrame:
    rows = output_slice(df, start, end, spec.date)
    return attach_to_rows(rows, recency_features(df, spec, start, end), spec.group_cols, keys, spec.date)
