"""Lagged trailing statistics per grouping set.

The fact is first rolled up to one row per group and day. That step combines
on the map side and shuffles on (group, day), so a group holding a third of
all sales is spread over its days; afterwards no group has more rows than the
calendar has days, and the windows below work on bounded partitions. All
windows of a grouping set share partitioning and order: one exchange and one
sort serve both levels.

Every frame ends ``lag + 1`` days before the row and spans ``n + 1`` days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from stockline import spec as names
from stockline.functions.dates import as_date, month_end, shift_days
from stockline.session import small_methods
from stockline.spec import TrailingSpec

DAY = "__day"
# The number of the task that has a group.
DEALT = "__dealt"
# Fixed value: a group with more rows than this is spread over its days.
HEAVY_ROWS = 2_000_000


def with_day_number(daily: DataFrame, date: str) -> DataFrame:
    """The date as a number, as a column of its own.

    Windows that order by the same column, not by equal expressions, share
    one sort.
    """
    return daily.withColumn(DAY, F.unix_date(date))


def days_window(group_cols: Sequence[str], first: int, last: int) -> WindowSpec:
    """Frame from ``first`` to ``last`` days before the row."""
    return Window.partitionBy(*group_cols).orderBy(DAY).rangeBetween(-first, -last)


def trailing_window(spec: TrailingSpec, days: int) -> WindowSpec:
    return days_window(spec.group_cols, days + spec.lag + 1, spec.lag + 1)


def history_slice(df: DataFrame, start, days: int, date: str, end=None) -> DataFrame:
    """Only the input that results from ``start`` to ``end`` can depend on.

    A filter above a window stays above it, so the input is cut explicitly; a
    month column, where there is one, lets the stored partitions prune.
    """
    def bounded(column: str, move) -> DataFrame:
        cut = df
        if start is not None:
            cut = cut.filter(F.col(column) >= F.lit(move(shift_days(start, -days))))
        return cut if end is None else cut.filter(F.col(column) <= F.lit(move(as_date(end))))

    df = bounded(date, as_date)
    return bounded(names.MONTH, month_end) if names.MONTH in df.columns else df


def output_slice(df: DataFrame, start, end, date: str) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(as_date(start)))
    return df if end is None else df.filter(F.col(date) <= F.lit(as_date(end)))


def roll_up(df: DataFrame, columns: Sequence[str], measures: Sequence[str], sold: str = names.SOLD,
            date: str = names.DATE) -> DataFrame:
    """Daily totals at a grain that several grouping sets can be derived from."""
    return df.groupBy(*columns, date).agg(
        *[F.sum(m).alias(m) for m in measures],
        F.sum(sold).alias("label"), F.count(sold).alias("count"), F.max(sold).alias("flag"))


def regroup_days(rolled: DataFrame, spec: TrailingSpec) -> DataFrame:
    """As ``group_days``, from a roll-up that holds the group columns."""
    return rolled.groupBy(*spec.group_cols, spec.date).agg(
        *[F.sum(c).alias(c) for c in (*spec.measures, "label", "count")])


def group_days(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Sum of each measure, of the sold flag and its count, per group and day.

    A decimal measure is summed exactly and stays decimal.
    """
    return df.groupBy(*spec.group_cols, spec.date).agg(
        *[F.sum(m).alias(m) for m in spec.measures],
        F.sum(spec.sold).alias("label"),
        F.count(spec.sold).alias("count"))



def _running(column: str, group_cols: Sequence[str], upto: int) -> tuple[Column, Column]:
    """Sum and count of a column over all days up to ``upto`` days before the row."""
    frame = (Window.partitionBy(*group_cols).orderBy(DAY)
             .rangeBetween(Window.unboundedPreceding, -upto))
    return F.sum(column).over(frame), F.count(column).over(frame)


def exact_window_sums(daily: DataFrame, spec: TrailingSpec, outputs: dict[str, str]) -> DataFrame:
    """Trailing sums of integers and decimals, as differences of running sums.

    ``outputs`` maps a column to the name of its sum, with ``{}`` for the
    days. A running sum costs one addition per row whatever the horizon; the
    difference is free of rounding because the type is exact.
    """
    edges = sorted({spec.lag + 1, *[days + spec.lag + 2 for days in spec.horizons]})
    running = []
    for c in outputs:
        for k in edges:
            total, known = _running(c, spec.group_cols, k)
            running += [F.coalesce(total, F.lit(0)).alias(f"__sum_{c}_{k}"), known.alias(f"__n_{c}_{k}")]

    def between(c: str, days: int) -> Column:
        near, far = spec.lag + 1, days + spec.lag + 2
        known = F.col(f"__n_{c}_{near}") - F.col(f"__n_{c}_{far}")
        return F.when(known > 0, F.col(f"__sum_{c}_{near}") - F.col(f"__sum_{c}_{far}"))

    return daily.select("*", *running).select(*daily.columns, *[
        between(c, days).alias(name.format(days)) for c, name in outputs.items() for days in spec.horizons])


def float_window_sums(daily: DataFrame, spec: TrailingSpec, outputs: dict[str, str]) -> DataFrame:
    """Trailing sums of floating-point columns.

    Running sums would leave rounding residue, so the days are added up; the
    horizons are cut into adjoining pieces and no day is added twice.
    """
    horizons = sorted(spec.horizons)
    pieces, near = [], spec.lag + 1
    for days in horizons:
        far = days + spec.lag + 1
        pieces += [F.sum(c).over(days_window(spec.group_cols, far, near)).alias(f"__part_{c}_{days}")
                   for c in outputs]
        near = far + 1
    sums = {}
    for c, name in outputs.items():
        total = None
        for days in horizons:
            part = F.col(f"__part_{c}_{days}")
            total = part if total is None else F.coalesce(total + part, total, part)
            sums[name.format(days)] = total
    return daily.select("*", *pieces).select(*daily.columns, *[t.alias(n) for n, t in sums.items()])


def with_sums(daily: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Trailing sums of the measures, of the sold flag and of the row count."""
    names = {m: spec.column(m, "sum", "{}") for m in spec.measures}
    names |= {"label": "label_sum_{}d", "count": "count_sum_{}d"}
    floats = {f.name for f in daily.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    numbered = with_day_number(daily, spec.date)
    exact = exact_window_sums(numbered, spec, {c: n for c, n in names.items() if c not in floats})
    rest = {c: n for c, n in names.items() if c in floats}
    return float_window_sums(exact, spec, rest) if rest else exact


def with_averages(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Plain averages divide by rows, ``_inc0`` averages by sold rows."""
    columns = []
    for m in spec.measures:
        for days in spec.horizons:
            total = F.col(spec.column(m, "sum", days)).cast("double")
            columns.append(F.try_divide(total, f"count_sum_{days}d").alias(spec.column(m, "avg", days)))
            columns.append(F.try_divide(total, f"label_sum_{days}d")
                           .alias(spec.column(m, "avg", days, all_days=True)))
    return df.select("*", *columns)


def gap_column(measure: str, days: int, all_days: bool) -> str:
    return f"__gaps_{measure}_{days}{'_inc0' if all_days else ''}"


def with_gap_sums(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Trailing sums of the squared distance of past days from their own averages.

    A past day is compared with the average that was trailing on that day. The
    plain variant takes only days with exactly one sold row.
    """
    gaps, sums = [], []
    for m in spec.measures:
        actual = F.col(m).cast("double")
        for days in spec.horizons:
            frame = trailing_window(spec, days)
            every, single = f"__gap_{m}_{days}_inc0", f"__gap_{m}_{days}"
            gaps.append(F.pow(actual - F.col(spec.column(m, "avg", days, all_days=True)), 2).alias(every))
            gaps.append(F.when(F.col("label") == 1, F.pow(actual - F.col(spec.column(m, "avg", days)), 2))
                        .otherwise(0.0).alias(single))
            sums += [F.sum(every).over(frame).alias(gap_column(m, days, True)),
                     F.sum(single).over(frame).alias(gap_column(m, days, False))]
    return df.select("*", *gaps).select(*df.columns, *sums)


def with_deviations(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Root of the mean squared distance of past days from their own averages."""
    return df.select("*", *[
        F.sqrt(F.try_divide(gap_column(m, days, flag), f"{'count' if flag else 'label'}_sum_{days}d"))
        .alias(spec.column(m, "stddev", days, flag))
        for m in spec.measures for days in spec.horizons for flag in (True, False)])


def with_variation(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """Coefficient of variation: deviation over average."""
    return df.select("*", *[
        F.try_divide(spec.column(m, "stddev", days, flag), spec.column(m, "avg", days, flag))
        .alias(spec.column(m, "cv", days, flag))
        for m in spec.measures for days in spec.horizons for flag in (False, True)])


def with_sum_ratios(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    def total(m: str, days: int) -> Column:
        return F.col(spec.column(m, "sum", days)).cast("double")

    return df.select("*", *[
        F.try_divide(total(m, a), total(m, b)).alias(spec.ratio_column(m, a, b))
        for m in spec.measures for a, b in spec.ratios])


def sum_columns(spec: TrailingSpec) -> list[str]:
    """The window sums that all statistics of a row follow from, about half as many as there are statistics."""
    sums = [spec.column(m, "sum", days) for m in spec.measures for days in spec.horizons]
    counts = [f"{kind}_sum_{days}d" for kind in ("label", "count") for days in spec.horizons]
    return sums + counts + [gap_column(m, days, flag) for m in spec.measures for days in spec.horizons for flag in (True, False)]


def window_sums(daily: DataFrame, spec: TrailingSpec, start=None, end=None) -> DataFrame:
    """Group, date, number of the day and all window sums from totals per group and day."""
    small_methods(daily.sparkSession)
    full = (daily
            .transform(with_sums, spec)
            .transform(with_averages, spec)
            .transform(with_gap_sums, spec))
    exact = {spec.column(m, "sum", days) for m in spec.measures for days in spec.horizons}
    return output_slice(full, start, end, spec.date).select(*spec.group_cols, spec.date, DAY, *[
        F.col(c).cast("double").alias(c) if c in exact else c for c in sum_columns(spec)])


def statistics(df: DataFrame, spec: TrailingSpec) -> DataFrame:
    """All trailing columns in place of the window sums; no other row is looked at."""
    kept = [c for c in df.columns if c not in (*sum_columns(spec), DAY)]
    return (df.transform(with_averages, spec)
            .transform(with_deviations, spec)
            .transform(with_variation, spec)
            .transform(with_sum_ratios, spec)
            .select(*kept, *[F.col(c).cast("double").alias(c) for c in spec.columns()]))


def daily_features(daily: DataFrame, spec: TrailingSpec, start=None, end=None) -> DataFrame:
    """All trailing columns from totals per group and day."""
    return statistics(window_sums(daily, spec, start, end), spec)


def trailing_features(df: DataFrame, spec: TrailingSpec, start=None, end=None,
                      rolled: bool = False) -> DataFrame:
    """All trailing columns of a grouping set, one row per group and day.

    With ``start`` only the history that can reach the asked days is read.
    ``rolled`` input comes from ``roll_up``.
    """
    recent = history_slice(df, start, spec.history_days(), spec.date, end)
    return daily_features((regroup_days if rolled else group_days)(recent, spec), spec, start, end)


def heavy_groups(df: DataFrame, group_cols: Sequence[str], limit: int | None = None) -> Column | None:
    """Whether a row's group has more rows than one task should get; None if no group has.

    The groups come to the driver: at most one for each ``limit`` rows.
    """
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > (limit or HEAVY_ROWS))
    found = counts.drop("__n").collect()
    same = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(group_cols, row, strict=True)]) for row in found]
    return reduce(Column.__or__, same) if same else None


def attach_to_rows(df: DataFrame, daily: DataFrame, group_cols: Sequence[str], keys: Sequence[str],
                   date: str = names.DATE, month: str = names.MONTH) -> DataFrame:
    """Group-day features at row grain: key, day, month and the feature columns."""
    on = [c for c in daily.columns if c in (DEALT, *group_cols, date)]
    features = [c for c in daily.columns if c not in (*on, DAY)]
    rows = df.select(*dict.fromkeys([*keys, date, month, *group_cols]))
    outs = list(dict.fromkeys([*keys, date, month]))
    if DEALT not in on:
        return rows.join(daily.drop(DAY), on, "left").select(*outs, *features)
    # The order of the windows is that of the join, so the features are neither shuffled nor sorted.
    near = with_day_number(dealt_by_group(rows, group_cols), date)
    return near.join(daily.drop(date), [DEALT, *group_cols, DAY], "left").select(*outs, *features)


def dealt_by_group(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Rows of the same group in the same task, of the same number whatever the frame."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(DEALT, F.pmod(F.hash(*group_cols), F.lit(tasks))).repartitionById(tasks, F.col(DEALT))


def trailing_row_features(df: DataFrame, spec: TrailingSpec, keys: Sequence[str],
                          start=None, end=None) -> DataFrame:
    """All trailing columns of a grouping set, one row per row of the fact.

    Rows of the fact are narrow and are brought to the tasks whose windows
    have their group; the features, which are wide, stay where they are. Only
    groups with very many rows are dealt by group and day instead.
    """
    rows = output_slice(df, start, end, spec.date)
    daily = group_days(history_slice(df, start, spec.history_days(), spec.date, end), spec)

    def by_day(rows: DataFrame, daily: DataFrame) -> DataFrame:
        return attach_to_rows(rows, window_sums(daily, spec, start, end), spec.group_cols, keys, spec.date)

    def by_group(rows: DataFrame, daily: DataFrame) -> DataFrame:
        dealt = dealt_by_group(daily, spec.group_cols)
        sums = window_sums(dealt, replace(spec, group_cols=(DEALT, *spec.group_cols)), start, end)
        return attach_to_rows(rows, sums, spec.group_cols, keys, spec.date)

    heavy = heavy_groups(rows, spec.group_cols)
    if heavy is None:
        found = by_group(rows, daily)
    else:
        found = by_group(rows.filter(~heavy), daily.filter(~heavy)).unionAll(by_day(rows.filter(heavy), daily.filter(heavy)))
    return statistics(found, spec)
