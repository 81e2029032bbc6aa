"""Promotion codes: vocabulary, frequency cut and one column per code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockline import spec
from stockline.operators.frequency import frequency_cut, sort_by_count


def _codes(column: str) -> Column:
    return F.array_distinct(F.split(F.col(column), r"\|"))


def promo_counts(df: DataFrame, column: str = spec.PROMOTION,
                 none_code: str = spec.NO_PROMOTION) -> DataFrame:
    """Rows carrying each code: the sums of the one-hot columns, in one pass.

    The strings are counted before they are split, so the work behind the
    shuffle depends on the number of combinations, not on the number of rows.
    """
    combos = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return (combos.select(F.explode(_codes(column)).alias("code"), "rows")
            .filter(F.col("code") != none_code)
            .groupBy("code").agg(F.sum("rows").alias("n")))


def promo_codes(df: DataFrame, column: str = spec.PROMOTION,
                none_code: str = spec.NO_PROMOTION) -> DataFrame:
    return promo_counts(df, column, none_code).select("code")


def with_promo_flags(df: DataFrame, codes: Sequence[str], column: str = spec.PROMOTION) -> DataFrame:
    """Replace ``column`` by one 0/1 column per code; a NULL carries no code."""
    kept = [c for c in df.columns if c != column]
    listed = df.withColumn("__codes", _codes(column))
    flags = [
        F.coalesce(F.array_contains("__codes", F.lit(code)).cast("int"), F.lit(0)).alias(code)
        for code in codes]
    return listed.select(*kept, *flags)


def one_hot_promotion(df: DataFrame, cutoff: float = spec.PROMO_CUTOFF,
                      column: str = spec.PROMOTION, none_code: str = spec.NO_PROMOTION) -> DataFrame:
    """One column per frequent code, or per any code when ``cutoff`` is 1.

    The code list becomes the schema, so it is the one thing brought to the
    driver here.
    """
    counts = promo_counts(df, column, none_code)
    chosen = frequency_cut(counts, cutoff).orderBy("cumsum") if cutoff < 1 else sort_by_count(counts)
    return with_promo_flags(df, [row.code for row in chosen.select("code").collect()], column)
