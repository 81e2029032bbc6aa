"""Trailing statistics and recency against plain Python on small series."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stockline import spec
from stockline.operators import recency, trailing
from stockline.session import settings as session_settings
from stockline.sources import tables
from stockline.spec import RecencySpec, TrailingSpec

ORIGIN = dt.date(2020, 1, 1)
SCHEMA = "g string, Date date, TotalQtySale double, label int"


def series(spark, rows):
    return spark.createDataFrame(
        [(g, ORIGIN + dt.timedelta(days=d), float(q), s) for g, d, q, s in rows], SCHEMA)


def one_measure(**changes):
    return TrailingSpec(**({"name": "g", "group_cols": ("g",), "measures": ("TotalQtySale",)} | changes))


def expected(rows, group: TrailingSpec):
    """The same statistics, computed row by row."""
    days = {}
    for g, d, q, s in rows:
        x, l, c = days.get((g, d), (0.0, 0, 0))
        days[g, d] = (x + q, l + s, c + 1)

    def past(g, d, n):
        return [e for (h, e) in days if h == g and d - (n + group.lag + 1) <= e <= d - (group.lag + 1)]

    def ratio(a, b):
        return None if a is None or not b else a / b

    def averages(g, d, n):
        frame = past(g, d, n)
        total = sum(days[g, e][0] for e in frame) if frame else None
        sold = sum(days[g, e][1] for e in frame)
        return total, ratio(total, sum(days[g, e][2] for e in frame)), ratio(total, sold), sold, frame

    out = {}
    for g, d in days:
        row = {}
        for n in group.horizons:
            total, avg, avg_all, sold, frame = averages(g, d, n)
            gaps, singles = [], []
            for e in frame:
                _, past_avg, past_all, _, _ = averages(g, e, n)
                x, l, _ = days[g, e]
                gaps.append(None if past_all is None else (x - past_all) ** 2)
                singles.append(0.0 if l != 1 else None if past_avg is None else (x - past_avg) ** 2)
            def root(terms, by):
                known = [t for t in terms if t is not None]
                value = ratio(sum(known), by) if known else None
                return None if value is None else math.sqrt(value)
            sd = root(singles, sold)
            sd_all = root(gaps, sum(days[g, e][2] for e in frame))
            row |= {"sum": total, "avg": avg, "avg_inc0": avg_all, "stddev": sd, "stddev_inc0": sd_all,
                    "cv": ratio(sd, avg), "cv_inc0": ratio(sd_all, avg_all)}
        out[g, d] = row
    return out


def check(spark, rows, group):
    n = group.horizons[0]
    got = trailing.trailing_features(series(spark, rows), group).collect()
    want = expected(rows, group)
    assert len(got) == len(want)
    for r in got:
        w = want[r.g, (r.Date - ORIGIN).days]
        for stat in ("sum", "avg", "stddev", "cv"):
            for suffix, flag in (("", False), ("_inc0", True)):
                if stat == "sum" and flag:
                    continue
                value = r[group.column("TotalQtySale", stat, n, flag)]
                assert value == pytest.approx(w[stat + suffix], rel=1e-9) if w[stat + suffix] is not None else value is None


def test_frame_bounds(spark):
    """Day 6 back is seen and day 5 is not; the frame covers n + 1 days."""
    rows = [("a", d, d + 1, 1) for d in (0, 5, 6, 7, 96, 97, 200)]
    group = one_measure(horizons=(90,), ratios=())
    got = {(r.Date - ORIGIN).days: r[group.columns()[0]] for r in
           trailing.trailing_features(series(spark, rows), group).collect()}
    assert got == {0: None, 5: None, 6: 1.0, 7: 1.0, 96: 1 + 6 + 7 + 8, 97: 6 + 7 + 8, 200: None}
    check(spark, rows, group)


def test_sold_counts_decide_deviation(spark):
    rows = [("a", 0, 4, 0), ("a", 0, 6, 0), ("a", 8, 5, 1), ("a", 16, 7, 1), ("a", 16, 2, 1),
            ("a", 24, 9, 0), ("a", 32, 1, 1), ("a", 40, 3, 1)]
    check(spark, rows, one_measure(horizons=(30,), ratios=()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 9), st.integers(0, 1)),
                min_size=1, max_size=40))
def test_random_series(spark, rows):
    check(spark, rows, one_measure(horizons=(14,), ratios=(), lag=3))


def test_ratio_and_column_count(spark):
    group = one_measure(horizons=(10, 20), ratios=((10, 20),), lag=0)
    rows = [("a", 0, 5, 1), ("a", 15, 3, 1), ("a", 20, 2, 1)]
    got = trailing.trailing_features(series(spark, rows), group).orderBy("Date").collect()
    assert [r[group.ratio_column("TotalQtySale", 10, 20)] for r in got] == [None, None, 3 / 8]
    full = TrailingSpec("mc", ("MaterialCode",))
    assert len(full.columns()) == len(set(full.columns())) == 44


def test_history_slice_is_exact_and_tight(spark):
    """The sliced history gives the full result; one day less does not."""
    group = one_measure(horizons=(20,), ratios=(), lag=3)
    reach = group.history_days()
    assert reach == 2 * (20 + 3 + 1)
    start = 200
    rows = [("a", start - reach, 7, 1), ("a", start - reach // 2, 3, 1), ("a", start, 1, 1)]
    df = series(spark, rows)
    first = ORIGIN + dt.timedelta(days=start)

    def on_first_day(source):
        return trailing.trailing_features(source, group).filter(F.col("Date") == first).first()

    def seen(days):
        return on_first_day(trailing.history_slice(df, first, days, "Date"))

    assert seen(reach) == on_first_day(df)
    assert seen(reach - 1) != on_first_day(df)


def test_history_slice_on_sales(spark, small):
    group = TrailingSpec("cat_lv2", (spec.CATEGORY_2,), measures=(spec.QUANTITY,), horizons=(90,), ratios=())
    fact = tables.sales_for(spark, small, group.group_cols)
    period = ("1999-01-01", "1999-03-31")
    full = trailing.output_slice(trailing.trailing_features(fact, group), *period, spec.DATE)
    cut = trailing.trailing_features(fact, group, *period)
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in full.dtypes]
    assert full.select(digits).exceptAll(cut.select(digits)).isEmpty() and full.count() == cut.count() > 0


def test_exact_and_float_sums_agree(spark, small):
    group = TrailingSpec("br", (spec.STORE,), measures=(spec.NET_SALE,), horizons=(60, 180), ratios=())
    fact = tables.sales(spark, small)
    loose = fact.withColumn(spec.NET_SALE, F.col(spec.NET_SALE).cast("double"))
    names = [group.column(spec.NET_SALE, "sum", d) for d in group.horizons]
    a, b = (trailing.trailing_features(df, group).select(spec.STORE, spec.DATE, *names) for df in (fact, loose))
    pairs = a.alias("a").join(b.alias("b"), [spec.STORE, spec.DATE])
    assert pairs.count() == a.count() == b.count()
    for n in names:
        same = F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) | (F.abs(F.col(f"a.{n}") - F.col(f"b.{n}")) < 1e-4)
        assert pairs.filter(~F.coalesce(same, F.lit(False))).isEmpty()


def test_recency_history_slice(spark, small):
    group = RecencySpec("cat_lv2_br", (spec.CATEGORY_2, spec.STORE))
    fact = tables.sales_for(spark, small, group.group_cols)
    full = trailing.output_slice(recency.recency_features(fact, group), "1999-01-01", "1999-03-31", spec.DATE)
    cut = recency.recency_features(fact, group, "1999-01-01", "1999-03-31")
    assert full.exceptAll(cut).isEmpty() and full.count() == cut.count() > 0


@pytest.mark.parametrize("gap,run", [(6, 1), (7, 2), (95, 90), (96, 90), (5, 90)])
def test_recency_runs(spark, gap, run):
    rows = [("a", 0, 1, 1), ("a", gap, 0, 0)]
    group = RecencySpec("g", ("g",))
    got = {(r.Date - ORIGIN).days: r.zero_consc_g for r in
           recency.recency_features(series(spark, rows), group).collect()}
    assert got[0] == 90 and got[gap] == run


def test_longest_run(spark):
    rows = [("a", 0, 1, 1), ("a", 20, 0, 0), ("a", 30, 1, 1), ("a", 40, 0, 0)]
    group = RecencySpec("g", ("g",), horizons=(15, 60))
    got = {(r.Date - ORIGIN).days: r for r in recency.recency_features(series(spark, rows), group).collect()}
    assert got[40].zero_consc_g == 5
    assert got[40].zero_consc_max_15d_g == 25      # day 30, seen from day 25 on
    assert got[40].zero_consc_max_60d_g == 90      # day 0 has no sale before it


def test_rows_are_kept(spark, small):
    group = TrailingSpec("mc", (spec.ITEM,))
    fact = tables.sales_for(spark, small, group.group_cols)
    assert trailing.trailing_row_features(fact, group, tables.KEYS).count() == fact.count()


def test_group_days_combine_before_the_shuffle(spark, small):
    """The roll-up is partial before its exchange, and the windows add one exchange."""
    group = TrailingSpec("mc", (spec.ITEM,))
    plan = trailing.trailing_features(tables.sales(spark, small), group)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum") >= 1
    assert text.count("Sort [") == 1


def test_rollup_gives_the_same_features(spark, small):
    wide = (spec.CATEGORY_2, "ProvinceEN", spec.STORE, "DayOfWeek")
    fact = tables.sales_for(spark, small, wide)
    rolled = trailing.roll_up(fact, wide, [spec.QUANTITY, spec.NET_SALE])
    group = TrailingSpec("cat_lv2_dow", (spec.CATEGORY_2, "DayOfWeek"), horizons=(60,), ratios=())
    digits = [F.floor(F.col(c) * 1000 + 0.5).alias(c) for c in group.columns()]
    a, b = (trailing.trailing_features(df, group, rolled=r).select(*group.group_cols, spec.DATE, *digits)
            for df, r in ((fact, False), (rolled, True)))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()
    runs = RecencySpec("cat_lv2_br", (spec.CATEGORY_2, spec.STORE), horizons=(60,))
    a, b = recency.recency_features(fact, runs), recency.recency_features(rolled, runs, rolled=True)
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_no_method_is_too_large_to_be_compiled(spark):
    """The fused code of all statistics is larger than the virtual machine compiles, so it must not be fused."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    trailing.trailing_features(series(spark, [("a", 0, 1, 1), ("a", 9, 2, 1)]), one_measure())
    assert int(spark.conf.get(limit)) <= 8000
    spark.conf.set(limit, 4000)
    trailing.trailing_features(series(spark, [("a", 0, 1, 1)]), one_measure())
    assert int(spark.conf.get(limit)) == 4000
    spark.conf.unset(limit)


def test_rows_go_to_the_features(spark, small):
    """Features are not shuffled again to meet the rows: two exchanges of the roll-up, one of the narrow rows."""
    group = TrailingSpec("mc", (spec.ITEM,))
    plan = trailing.trailing_row_features(tables.sales(spark, small), group, tables.KEYS)
    with session_settings(spark, autoBroadcastJoinThreshold=-1):
        text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("- Exchange ") == 3


def test_heavy_and_unknown_groups_get_the_same_rows(spark, monkeypatch):
    """Whether a group is dealt as a whole or by its days; a null group is in no table and gets nulls."""
    group = one_measure(horizons=(30,), ratios=())
    rows = [(g, d, d % 7, d % 2) for g, n in (("a", 90), ("b", 20), ("c", 3), (None, 40)) for d in range(n)]
    df = series(spark, rows * 2).withColumns({"idx": F.monotonically_increasing_id(), spec.MONTH: F.last_day("Date")}).cache()
    daily = trailing.trailing_features(df, group)
    want = sorted(trailing.attach_to_rows(df, daily, ("g",), ["idx"]).collect())
    assert len(want) == len(rows) * 2
    for limit in (50, 10, 1, 1000):
        monkeypatch.setattr(trailing, "HEAVY_ROWS", limit)
        assert sorted(trailing.trailing_row_features(df, group, ["idx"]).collect(), key=lambda r: r.idx) == want
