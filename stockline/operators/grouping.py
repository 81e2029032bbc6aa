"""All grouping sets of a feature plan in one pass.

The roll-ups per day are expanded to every grouping set at once: one long table
with the name of the set, the group columns (null where a set does not have
them) and the daily totals. The windows of all sets that share measures and
horizons then run as one plan, partitioned by set and group: one exchange and
one sort, where a plan for each set would cost as many. Sets part only where
they are written, each into a folder of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from stockline import spec as names
from stockline.operators import recency, trailing
from stockline.spec import RecencySpec, TrailingSpec

SET = "grouping_set"
Spec = TrailingSpec | RecencySpec


def set_name(group_cols: Sequence[str]) -> str:
    return "-".join(group_cols)


def daily_sets(rolled: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[str], date: str = names.DATE) -> DataFrame:
    """Totals per set, group and day from one roll-up; a set's absent columns are null, as told by its name."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    marks = {set_name(s): sum(1 << (len(columns) - i) for i, c in enumerate(columns) if c not in s) for s in sets}
    mark = F.coalesce(*[F.when(F.col("__mark") == value, F.lit(name)) for name, value in marks.items()])
    grouped = rolled.groupingSets([[*s, date] for s in sets], *columns, date).agg(
        F.grouping_id().alias("__mark"), *[F.sum(c).alias(c) for c in (*measures, "label", "count")], F.max("flag").alias("flag"))
    return grouped.withColumn(SET, mark).drop("__mark")


def alike(specs: Sequence[Spec]) -> list[list[Spec]]:
    """Specifications that differ in name and group columns only, together."""
    found: dict[Spec, list[Spec]] = {}
    for s in specs:
        found.setdefault(replace(s, name="", group_cols=()), []).append(s)
    return list(found.values())


def common_spec(specs: Sequence[Spec]) -> Spec:
    """One specification over the rows of all sets."""
    columns = dict.fromkeys(c for s in specs for c in s.group_cols)
    return replace(specs[0], name="set", group_cols=(SET, *columns))


def set_windows(daily: DataFrame, specs: Sequence[Spec], start=None, end=None) -> DataFrame:
    """The windows of all sets in one plan; ``set_statistics`` makes features of them."""
    wide = common_spec(specs)
    rows = daily.filter(F.col(SET).isin([set_name(s.group_cols) for s in specs]))
    recent = trailing.history_slice(rows, start, wide.history_days(), wide.date, end)
    if isinstance(wide, RecencySpec):
        flags = recent.select(*wide.group_cols, wide.date, F.col("flag").alias(wide.flag))
        return recency.daily_features(flags, wide, start, end)
    return trailing.window_sums(recent, wide, start, end)


def set_statistics(rows: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """The features of each row under the column names of ``common_spec``; other columns stay."""
    wide = common_spec(specs)
    return rows if isinstance(wide, RecencySpec) else trailing.statistics(rows, wide)


def set_features(daily: DataFrame, specs: Sequence[Spec], start=None, end=None) -> DataFrame:
    """The features of all sets in one plan, under the column names of ``common_spec``."""
    return set_statistics(set_windows(daily, specs, start, end), specs)


def own_columns(spec: Spec, specs: Sequence[Spec]) -> tuple[tuple[str, str], ...]:
    """Stored and proper name of every feature column of one set."""
    return tuple(zip(common_spec(specs).columns(), spec.columns(), strict=True))
