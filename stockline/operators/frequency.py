"""Category counts, running totals and the cumulative frequency cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockline.session import durable


def category_counts(df: DataFrame, column: str, code: str = "code", count: str = "n") -> DataFrame:
    return df.groupBy(F.col(column).alias(code)).agg(F.count(F.lit(1)).alias(count))


def flag_counts(df: DataFrame, columns: Sequence[str], code: str = "code", count: str = "n") -> DataFrame:
    """How often each 0/1 column is set: one pass, then one row per column."""
    totals = df.agg(*[F.sum(c).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias(code), F.coalesce(F.col(c), F.lit(0)).cast("long").alias(count))
        for c in columns])
    return totals.select(F.inline(pairs))


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str,
                  total: str | None = None) -> DataFrame:
    """Sum of ``value`` over all rows up to this one in a total ``order``.

    A window without partitions would put every row into one task. Here the
    rows are range-partitioned, each slice is summed on its own, and only the
    slice totals (one row per shuffle partition) are added up in one place.
    The ranges are sampled, so they are written down before both uses. With
    ``total`` the sum of all rows is added as a column of that name.
    """
    slices = durable(df.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id()))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (slices.groupBy("__slice").agg(F.sum(value).alias("__total"))
               .select("__slice", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"),
                       F.sum("__total").over(Window.partitionBy()).alias(total or "__all")))
    inside = (Window.partitionBy("__slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (slices.join(F.broadcast(offsets), "__slice")
            .withColumn(out, F.col("__before") + F.sum(value).over(inside))
            .drop("__slice", "__before", "__all"))


def cumulative_share(counts: DataFrame, code: str = "code", count: str = "n") -> DataFrame:
    """Add ``cumsum`` and ``share`` in order of falling count, ties by name."""
    order = [F.col(count).desc(), F.col(code).asc()]
    ordered = running_total(counts, order, count, "cumsum", "__grand")
    return ordered.withColumn("share", F.try_divide("cumsum", "__grand")).drop("__grand")


def tied_cumulative_sum(df: DataFrame, value: str, out: str = "cumsum") -> DataFrame:
    """Running sum in falling order of ``value`` where equal values share the sum.

    Equal values are merged first; the number of distinct values, not of rows,
    decides how much is ordered.
    """
    levels = df.groupBy(value).agg(F.sum(value).alias("__level"))
    summed = running_total(levels, [F.col(value).desc()], "__level", out).drop("__level")
    return df.join(summed, value, "left")


def frequency_cut(counts: DataFrame, cutoff: float, code: str = "code", count: str = "n") -> DataFrame:
    """Categories whose cumulative share, themselves included, is within ``cutoff``."""
    return cumulative_share(counts, code, count).filter(F.col("share") <= cutoff)


def percentile_cutoff(df: DataFrame, cutoff: float, columns: Sequence[str]) -> list[str]:
    """Names of the frequent flags, most frequent first.

    The columns are read as 0/1 flags. Their names, at most as many as there
    are columns, select columns and are returned as a list; for the values of
    one categorical column see ``frequent_categories``.
    """
    kept = frequency_cut(flag_counts(df, columns), cutoff).orderBy("cumsum")
    return [row.code for row in kept.select("code").collect()]


def frequent_categories(df: DataFrame, cutoff: float, column: str) -> DataFrame:
    """``(code, n, cumsum, share)`` of the frequent values of a categorical column."""
    return frequency_cut(category_counts(df, column), cutoff)


def sort_by_count(counts: DataFrame, code: str = "code", count: str = "n") -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(code).asc())


def category_codes(df: DataFrame, column: str, code: str = "code", place: str = "place") -> DataFrame:
    """``(code, place)``: values of a column as text, numbered by falling frequency, ties by name.

    The same numbers as those of an index fitted by ``pyspark.ml``, but as a
    table: no list of values comes to the driver or into a model, so the column
    may be an identifier. NULL is no value.
    """
    counts = category_counts(df.select(F.col(column).cast("string").alias(code)).filter(F.col(code).isNotNull()), code, code)
    numbered = running_total(counts.withColumn("__one", F.lit(1).cast("long")), [F.col("n").desc(), F.col(code)], "__one", place)
    return numbered.select(code, (F.col(place) - 1).cast("double").alias(place))


def with_codes(df: DataFrame, codes: DataFrame, column: str, out: str, code: str = "code", place: str = "place") -> DataFrame:
    """Add the number of each row's value; unknown ones and NULL share the number after the last.

    The codes join at their measured size once they are written; hot values of a shuffled join are split by adaptive execution.
    """
    known = durable(codes.select(F.col(code).alias("__code"), F.col(place).alias("__place")))
    joined = df.join(known, F.col(column).cast("string") == F.col("__code"), "left")
    return joined.select(*df.columns, F.coalesce("__place", F.lit(float(known.count()))).alias(out))
