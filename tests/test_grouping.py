"""All grouping sets in one plan against one plan for each."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stockline import spec
from stockline.operators import grouping, recency, trailing
from stockline.spec import RecencySpec, TrailingSpec

SETS = [("item",), ("store",), ("item", "store"), ("item", "DayOfWeek")]


@pytest.fixture(scope="module")
def fact(spark):
    draw, day = random.Random(5), dt.date(2020, 1, 1)
    rows = [(draw.choice([1, 2, None]), draw.choice(["a", "b", "", None]), day + dt.timedelta(days=draw.randrange(300)), draw.choice([0, 1, 1]),
             float(draw.randrange(9)), draw.randrange(100)) for _ in range(1500)]
    return spark.createDataFrame(rows, "item int, store string, Date date, label int, qty double, net int").withColumn("DayOfWeek", F.dayofweek("Date"))


def rolled(fact):
    return trailing.roll_up(fact, ["item", "store", "DayOfWeek"], ["qty", "net"])


@pytest.mark.parametrize("period", [(None, None), ("2020-07-01", "2020-07-20")])
def test_trailing_sets(fact, period):
    specs = [TrailingSpec(f"s{i}", cols, ("qty", "net"), (30, 60), ((30, 60),)) for i, cols in enumerate(SETS)]
    together = grouping.set_features(grouping.daily_sets(rolled(fact), SETS, ["qty", "net"]), specs, *period).cache()
    for s in specs:
        mine = together.filter(F.col(grouping.SET) == grouping.set_name(s.group_cols)).select(
            *s.group_cols, "Date", *[F.round(old, 6).alias(new) for old, new in grouping.own_columns(s, specs)])
        alone = trailing.trailing_features(fact, s, *period).select(*s.group_cols, "Date", *[F.round(c, 6).alias(c) for c in s.columns()])
        assert mine.count() == alone.count() > 0
        assert mine.exceptAll(alone).isEmpty()


def test_recency_sets(fact):
    specs = [RecencySpec(f"s{i}", cols, (30, 60)) for i, cols in enumerate(SETS)]
    together = grouping.set_features(grouping.daily_sets(rolled(fact), SETS, ["qty", "net"]), specs)
    for s in specs:
        mine = together.filter(F.col(grouping.SET) == grouping.set_name(s.group_cols)).select(
            *s.group_cols, "Date", *[F.col(old).alias(new) for old, new in grouping.own_columns(s, specs)])
        alone = recency.recency_features(fact, s)
        assert mine.count() == alone.count() and mine.exceptAll(alone).isEmpty()


def test_settings_that_differ_are_apart():
    specs = [TrailingSpec("a", ("x",)), TrailingSpec("b", ("y", "z")), TrailingSpec("c", ("x",), horizons=(7,), ratios=())]
    assert [[s.name for s in same] for same in grouping.alike(specs)] == [["a", "b"], ["c"]]
    assert grouping.common_spec(specs[:2]).group_cols == (grouping.SET, "x", "y", "z")


def test_one_plan_has_one_exchange_for_the_windows_of_all_sets(fact, capsys):
    specs = [TrailingSpec(f"s{i}", cols, ("qty", "net")) for i, cols in enumerate(SETS)]
    daily = grouping.daily_sets(rolled(fact), SETS, ["qty", "net"])
    grouping.set_features(daily, specs).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 3  # roll-up, sets, windows
    assert plan.count(" Sort ") + plan.count("- Sort [") >= 1 and plan.count("Sort [") == 1
