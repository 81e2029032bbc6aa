"""A feature store of tables partitioned by month end.

Feature tables may be stored at row grain (joined on the row key) or, far
smaller, at the grain of a group and day (joined on the group columns).
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockline import spec
from stockline.functions.dates import as_date, calendar_between, month_end, month_ends, with_month_end
from stockline.operators.clean import in_period
from stockline.session import settings, shuffles_removed
from stockline.sources.files import child_names, move_path, path_exists, remove_path

log = logging.getLogger(__name__)

# What to do with months that are already stored.
KEEP, OVERWRITE, SOFT_OVERWRITE = "", "overwrite", "soft_overwrite"
SAVE_MODES = (KEEP, OVERWRITE, SOFT_OVERWRITE)
COMBINED = "combined_ft"
# Folders beside the tables: months on their way in, and out.
STAGED, RETIRED = ".staged", ".retired"
# The number of a run of days, and the bytes of assembled rows that one should hold; beyond the larger size, tables are sorted and not hashed.
SLICE = "__slice"
SLICE_BYTES, HASHED_BYTES = 64 << 20, 512 << 20
# The bytes of assembled rows whose sides are shuffled at a time; one month at least.
ROUND_BYTES = 8 << 30


class DuplicateKeys(ValueError):
    """A feature table has several rows for one key and would multiply rows."""


@dataclass(frozen=True)
class FeatureTable:
    """A stored table and the columns, besides day and month, that identify a row.

    ``unique``: it was made by grouping on exactly these columns, so its keys
    need no check. ``columns``: stored and proper names of its features, where
    they differ.
    """

    name: str
    on: tuple[str, ...]
    unique: bool = False
    columns: tuple[tuple[str, str], ...] = ()

    def key(self) -> tuple[str, ...]:
        """The columns that identify a row once its day is known."""
        return tuple(sorted(set(self.on) - set(spec.CALENDAR)))


@dataclass(frozen=True)
class Slices:
    """Runs of days of equal length: ``count`` of them, ``days`` long, from ``first`` on."""

    first: dt.date
    days: int
    count: int
    hashed: bool

    def deal(self, df: DataFrame, date: str) -> DataFrame:
        """The rows, those of a slice in one partition of that number."""
        day = F.datediff(F.col(date), F.lit(self.first))
        number = F.coalesce(F.pmod(F.floor(day / self.days), F.lit(self.count)), F.lit(0)).cast("int")
        return df.withColumn(SLICE, number).repartitionById(self.count, F.col(SLICE))


@dataclass(frozen=True)
class FeatureStore:
    spark: SparkSession
    root: str
    date: str = spec.DATE
    month: str = spec.MONTH
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path(name))

    def months(self, name: str) -> list[dt.date]:
        """Stored months, from the partition folders and not from the data."""
        prefix = f"{self.month}="
        found = [n.removeprefix(prefix) for n in child_names(self.spark, self.path(name)) if n.startswith(prefix)]
        return sorted(dt.date.fromisoformat(m) for m in found)

    def has_day(self, name: str, day) -> bool:
        """Whether any row of the day is stored; reads until the first one."""
        value = as_date(day)
        if month_end(value) not in self.months(name):
            return False
        return not in_period(self.read(name), value, value, self.date, self.month).isEmpty()

    def missing_months(self, name: str, start, end) -> DataFrame:
        """Months between two days without a partition."""
        stored = self.spark.createDataFrame([(m,) for m in self.months(name)], f"{self.month} date")
        return calendar_between(self.spark, start, end, self.month).join(stored, self.month, "left_anti")

    def first_missing_month(self, name: str, start, end) -> dt.date | None:
        stored = set(self.months(name))
        return next((m for m in month_ends(start, end) if m not in stored), None)

    def months_to_write(self, name: str, start, end, save_mode: str = KEEP) -> list[dt.date]:
        """The months a run has to produce under the save mode."""
        if save_mode not in SAVE_MODES:
            raise ValueError(f"unknown save mode {save_mode!r}, expected one of {SAVE_MODES}")
        if save_mode == OVERWRITE or not path_exists(self.spark, self.path(name)):
            return month_ends(start, end)
        first = self.first_missing_month(name, start, end)
        return month_ends(first, end) if save_mode == SOFT_OVERWRITE and first else []

    def exists(self, name: str, start=None, end=None) -> bool:
        """Whether the table is there and covers the period: that day, or every month of it."""
        if not path_exists(self.spark, self.path(name)):
            return False
        if start is None:
            return True
        if as_date(start) == as_date(end):
            return self.has_day(name, start)
        return self.first_missing_month(name, start, end) is None

    def save_feature(self, df: DataFrame, feature: Callable[..., DataFrame], name: str, start, end,
                     overwrite: bool = True, **params) -> bool:
        """Compute a feature table and write the rows from ``start`` to ``end``.

        With ``overwrite`` they replace the table. Without, months that are
        stored are kept and only missing ones are written; returns False if
        none is missing.
        """
        if not overwrite and self.exists(name, start, end):
            log.info("feature table %s is kept", name)
            return False
        rows = feature(df, **params)
        if self.month not in rows.columns:
            rows = with_month_end(rows, self.date, self.month)
        rows = in_period(rows, start, end, self.date, self.month)
        if overwrite or as_date(start) == as_date(end) or not path_exists(self.spark, self.path(name)):
            self._write(rows, name)
        else:
            stored = self.months(name)
            missing = [m for m in month_ends(start, end) if m not in stored]
            self.replace_months(rows.filter(F.col(self.month).isin(missing)), name, missing)
        return True

    def save_sets(self, df: DataFrame, name: str, by: str, values: Sequence[str], start, end,
                  finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Write the rows from ``start`` to ``end`` of each value of ``by`` as a table of its own, all in one job.

        The table of a value is ``name/by=value``; those not listed stay as they are. ``finish`` adds what follows
        from a row alone, once the rows are dealt and sorted for the writers.
        """
        rows = df if self.month in df.columns else with_month_end(df, self.date, self.month)
        rows = in_period(rows, start, end, self.date, self.month)
        for value in values:
            remove_path(self.spark, self.path(f"{name}/{by}={value}"))
        with shuffles_removed(self.spark):
            dealt = rows.hint("rebalance", by, self.month).sortWithinPartitions(by, self.month)
            (dealt.transform(finish).write.format(self.fmt).mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(by, self.month).save(self.path(name)))

    def replace_months(self, df: DataFrame | Sequence[DataFrame], name: str, months: Sequence[dt.date] = (), dealt: bool = False) -> None:
        """Write the months that occur in ``df``, or in several frames one after the other, and leave all others as they are.

        Listed ``months`` without new rows are emptied. The new months are
        written beside the table and put in place when all of them stand, so a
        failed write leaves the old ones; a run stopped while a month changes
        places is repaired by the next call. ``df`` may read the same table.
        The columns must be those of the stored table. ``dealt``: few tasks
        have rows of the same month, so they write where they are.
        """
        self.repair(name)
        parts = [df] if isinstance(df, DataFrame) else df
        if self.months(name):
            old, new = set(self.read(name).columns), set(parts[0].columns)
            if old != new:
                raise ValueError(f"columns of {name} would change: {sorted(old ^ new)}")
        new_name = f"{STAGED}/{uuid.uuid4().hex}"
        staged, prefix = self.path(new_name), f"{self.month}="
        try:
            for part in parts:
                self._write(part, new_name, dealt, "append")
            fresh = [n for n in child_names(self.spark, staged) if n.startswith(prefix)]
            for month in sorted({*fresh, *(prefix + m.isoformat() for m in months)}):
                place = f"{self.path(name)}/{month}"
                if path_exists(self.spark, place):
                    move_path(self.spark, place, f"{self.path(RETIRED)}/{name}/{month}")
                if month in fresh:
                    move_path(self.spark, f"{staged}/{month}", place)
                remove_path(self.spark, f"{self.path(RETIRED)}/{name}/{month}")
        finally:
            remove_path(self.spark, staged)
        self.spark.catalog.refreshByPath(self.path(name))

    def repair(self, name: str) -> None:
        """Finish what a stopped ``replace_months`` left: a retired month returns unless another took its place."""
        retired = f"{self.path(RETIRED)}/{name}"
        for part in child_names(self.spark, retired):
            if part.startswith(f"{self.month}="):
                if path_exists(self.spark, f"{self.path(name)}/{part}"):
                    remove_path(self.spark, f"{retired}/{part}")
                else:
                    move_path(self.spark, f"{retired}/{part}", f"{self.path(name)}/{part}")

    def _write(self, df: DataFrame, name: str, dealt: bool = False, mode: str = "overwrite") -> None:
        # One writer per month would be a bottleneck, every task writing every
        # month a flood of files: rebalancing by month splits only large ones.
        with shuffles_removed(self.spark):
            ((df if dealt else df.hint("rebalance", self.month)).write.format(self.fmt).mode(mode)
             .option("partitionOverwriteMode", "static")
             .partitionBy(self.month).save(self.path(name)))

    def combine(self, df: DataFrame, features: Sequence[FeatureTable], start, end,
                save_mode: str = KEEP, name: str = COMBINED, months_per_commit: int = 1) -> DataFrame:
        """Join every feature table to the fact, store the result by month and return the period's rows.

        Each commit covers ``months_per_commit`` months, so an interrupted run
        resumes with the first missing one. Feature tables are checked once for
        repeated keys, before anything is written: rows can neither be lost nor
        multiplied by the left joins.
        """
        months = self.months_to_write(name, start, end, save_mode)
        self.check_keys([f for f in features if not f.unique], months)
        for at in range(0, len(months), months_per_commit):
            batch = months[at:at + months_per_commit]
            rows = df.filter(F.col(self.month).isin(batch))
            log.info("writing %s, months %s to %s", name, batch[0], batch[-1])
            if not features:
                self.replace_months(rows, name, batch)
                continue
            # Each side is dealt once, by its days, and every join and the writers find it there: the settings
            # let joins do with that, and there is nothing to plan anew between them.
            with settings(self.spark, requireAllClusterKeysForCoPartition=False, adaptive__enabled=False):
                self.replace_months(self.rounds(rows, features, batch), name, batch, dealt=True)
        return in_period(self.read(name), start, end, self.date, self.month)

    def assemble(self, df: DataFrame, features: Sequence[FeatureTable], months: Sequence[dt.date]) -> DataFrame:
        """The rows of ``df`` with the columns of all tables.

        Tables with the same key are joined to each other first, at their own
        small size, so the fact is shuffled once per key and not once per table.
        """
        merged: dict[tuple[str, ...], DataFrame] = {}
        for feature in features:
            key, (table, _) = feature.key(), self.feature_rows(feature, months)
            on = [*key, self.date, self.month]
            merged[key] = merged[key].join(table, on, "full") if key in merged else table
        for key, table in merged.items():
            df = df.join(table, [*key, self.date, self.month], "left")
        return df

    def day_bytes(self, df: DataFrame, features: Sequence[FeatureTable]) -> dict[dt.date, int]:
        """Bytes of the assembled rows of each day. One row per day comes to the driver, at most."""
        width = 8 * (len(df.columns) + sum(len(f.columns) or len(self.read(f.name).columns) for f in features))
        return {r[0]: r["count"] * width for r in df.groupBy(self.date).count().collect() if r[0]}

    def rounds(self, df: DataFrame, features: Sequence[FeatureTable], months: Sequence[dt.date]) -> list[DataFrame]:
        """The assembled rows in runs of months, so that what is shuffled for one is gone before the next."""
        daily, runs, held = self.day_bytes(df, features), [], 0
        for month in months:
            size = sum(n for day, n in daily.items() if month_end(day) == month)
            if not runs or held + size > ROUND_BYTES:
                runs.append([])
                held = 0
            runs[-1].append(month)
            held += size
        return [self.assemble_dealt(df.filter(F.col(self.month).isin(run)), features, run, self.slices(df, features, run, daily))
                for run in runs]

    def slices(self, df: DataFrame, features: Sequence[FeatureTable], months: Sequence[dt.date],
               daily: dict[dt.date, int] | None = None) -> Slices:
        """So many days to a slice that its assembled rows stay small; one day at least. ``daily``: the bytes of each day, if known."""
        first = months[0].replace(day=1)
        sizes = [n for day, n in (daily or self.day_bytes(df, features)).items() if first <= day <= months[-1]]
        span = (months[-1] - first).days + 1
        wanted = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(sizes) // SLICE_BYTES))
        days = -(-span // min(wanted, span))
        return Slices(first, days, -(-span // days), max(sizes, default=0) * days <= HASHED_BYTES)

    def assemble_dealt(self, df: DataFrame, features: Sequence[FeatureTable], months: Sequence[dt.date], slices: Slices) -> DataFrame:
        """As ``assemble``, for many days: rows and tables meet by slices of days, so none is shuffled twice."""
        columns = [F.col(c) for c in df.columns]
        df = slices.deal(df, self.date)
        for number, feature in enumerate(features):
            table, added = self.feature_rows(feature, months)
            on = [*feature.key(), self.date, self.month]
            # One value to all later joins, which else copy every column so far for each row.
            packed = f"__features_{number}"
            columns += [F.col(packed)[c].alias(c) for c in added]
            table = slices.deal(table.select(*on, F.struct(*added).alias(packed)), self.date)
            if slices.hashed:
                table = table.hint("shuffle_hash")
            df = df.join(table, [*on, SLICE], "left")
        # Rows that share features lie together, so that files and vectors made of them take less space; writers ask for rows by month.
        alike = [c for c in (spec.CATEGORY_2, "DistrictEN", "ProvinceEN") if c in df.columns]
        return df.select(*columns).sortWithinPartitions(self.month, self.date, *alike)

    def feature_rows(self, feature: FeatureTable, months: Sequence[dt.date]) -> tuple[DataFrame, list[str]]:
        """Key, day, month and features of a table under their proper names, and the names of the features."""
        table, key = self.months_of(feature.name, months), feature.key()
        if feature.columns:
            table = table.select(*feature.on, self.date, self.month, *[F.col(old).alias(new) for old, new in feature.columns])
        table = table.drop(*set(feature.on) - set(key))
        return table, [c for c in table.columns if c not in (*key, self.date, self.month)]

    def months_of(self, name: str, months: Sequence[dt.date]) -> DataFrame:
        return self.read(name).filter(F.col(self.month).isin(list(months)))

    def check_keys(self, features: Sequence[FeatureTable], months: Sequence[dt.date]) -> None:
        """Fail on a repeated key. One job reads the key columns of all tables."""
        if not months:
            return
        checks = [
            repeated_keys(self.months_of(f.name, months), [*f.key(), self.date, self.month])
            .select(F.lit(f.name).alias("table")) for f in features]
        if not checks:
            return
        found = checks[0]
        for check in checks[1:]:
            found = found.unionAll(check)
        first = found.first()
        if first is not None:
            raise DuplicateKeys(f"feature table {first.table} has repeated keys")


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
