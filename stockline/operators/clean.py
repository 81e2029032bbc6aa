"""Casts, null handling, filters and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from stockline import spec
from stockline.functions.dates import as_date, month_end


def cast_columns(df: DataFrame, columns: Sequence[str], to: str) -> DataFrame:
    """Cast ``columns``; a value that does not parse becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def cast_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, columns, "double")


def cast_ints(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, columns, "int")


def cast_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cast_columns(df, columns, "date")


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def drop_incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def fill_numbers(df: DataFrame, columns: Sequence[str] | None = None, value: float = 0) -> DataFrame:
    return df.na.fill(value, subset=list(columns) if columns else None)


def fill_strings(df: DataFrame, columns: Sequence[str] | None = None,
                 value: str = "others") -> DataFrame:
    return df.na.fill(value, subset=list(columns) if columns else None)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (columns or df.columns)])


def trim_last_blank(df: DataFrame, column: str) -> DataFrame:
    """Remove one trailing blank, form feed, tab or vertical tab."""
    return df.withColumn(column, F.regexp_replace(column, "[ \f\t\v]$", ""))


def with_sold_flag(df: DataFrame, quantity: str = spec.QUANTITY, flag: str = spec.SOLD,
                   above: float = 0) -> DataFrame:
    """1 where something was sold, else 0; an existing flag is kept."""
    if flag in df.columns:
        return df
    return df.withColumn(flag, F.when(F.col(quantity) > above, 1).otherwise(0))


def with_row_ids(df: DataFrame, column: str = "idx") -> DataFrame:
    """Unique row numbers; they change with the physical layout of the input.

    Write the result once and read it back before joining on these ids.
    """
    return df.withColumn(column, F.monotonically_increasing_id())


def in_period(df: DataFrame, start, end, date: str = spec.DATE, month: str = spec.MONTH) -> DataFrame:
    """Rows between two days, bounded by month as well so that partitions prune."""
    first, last = as_date(start), as_date(end)
    return df.filter(
        F.col(month).between(F.lit(month_end(first)), F.lit(month_end(last)))
        & F.col(date).between(F.lit(first), F.lit(last)))


def split_by_day(df: DataFrame, split, date: str = spec.DATE) -> tuple[DataFrame, DataFrame]:
    day = F.lit(as_date(split))
    return df.filter(F.col(date) < day), df.filter(F.col(date) >= day)


def split_by_month(df: DataFrame, dev, oot, end, month: str = spec.MONTH) -> tuple[DataFrame, DataFrame]:
    """Development months before ``oot`` and out-of-time months from it to ``end``."""
    dev_eom, oot_eom, end_eom = (F.lit(month_end(d)) for d in (dev, oot, end))
    eom = F.col(month)
    return (df.filter((eom >= dev_eom) & (eom < oot_eom)),
            df.filter((eom >= oot_eom) & (eom <= end_eom)))


def remainder(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``sample``."""
    return df.join(sample.select(*keys), list(keys), "left_anti")


def stratified_split(df: DataFrame, fraction: float, label: str, keys: Sequence[str],
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Sample every class of ``label`` at ``fraction``; also return the rest.

    Whether a row is drawn depends on its key alone, so both sides stay
    disjoint and complete when a lost task is run again, and the rest needs no
    join against the sample. A row without a label falls into no class.
    """
    buckets = 1 << 32
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (label, *keys)])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    drawn = F.col(label).isNotNull() & (place < F.lit(round(fraction * buckets)))
    return df.filter(drawn), df.filter(~drawn)


def random_split(df: DataFrame, weights: Sequence[float] = (0.9, 0.1), seed: int = 2021) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)
