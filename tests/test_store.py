import datetime as dt
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stockline.functions.dates import month_ends, with_month_end
from stockline.session import fresh_folder, settings
from stockline.sources.files import (
    child_names, export_csv, move_path, overwrite_table, read_categories, read_category_groups, read_checked, read_csv)
from stockline.sources.store import DuplicateKeys, FeatureStore, FeatureTable

START, END = "2020-06-01", "2020-09-30"


@pytest.fixture
def store(spark):
    return FeatureStore(spark, fresh_folder(spark, "test-store"))


@pytest.fixture(scope="module")
def facts(spark):
    days = spark.sql(f"select explode(sequence(date'{START}', date'{END}', interval 3 days)) as Date")
    return (days.crossJoin(spark.range(3).select(F.col("id").alias("item")))
            .withColumns({"Date_EOM": F.last_day("Date"), "x": F.dayofyear("Date") + F.col("item"),
                          "key": F.dayofyear("Date") * 10 + F.col("item")}))


def keep(df):
    return df


def by_day(df, plus=0):
    return df.groupBy("item", "Date").agg((F.sum("x") + plus).alias("total"))


def test_save_keeps_the_period(store, facts):
    assert store.save_feature(facts, keep, "ft", "2020-06-10", "2020-08-20")
    row = store.read("ft").agg(F.min("Date"), F.max("Date")).first()
    assert row[0] >= dt.date(2020, 6, 10) and row[1] <= dt.date(2020, 8, 20)
    assert store.months("ft") == [dt.date(2020, 6, 30), dt.date(2020, 7, 31), dt.date(2020, 8, 31)]


def test_existing_table_is_kept_or_replaced(store, facts):
    store.save_feature(facts, by_day, "ft", START, END)
    assert not store.save_feature(facts, by_day, "ft", START, END, overwrite=False, plus=5)
    before = store.read("ft").agg(F.sum("total")).first()[0]
    assert store.save_feature(facts, by_day, "ft", START, "2020-07-31", overwrite=True, plus=5)
    assert store.months("ft")[-1] == dt.date(2020, 7, 31)
    assert store.read("ft").agg(F.sum("total")).first()[0] != before


def test_single_day_check(store, facts):
    day = facts.agg(F.max("Date")).first()[0]
    store.save_feature(facts, keep, "ft", START, END)
    assert store.exists("ft", day, day)
    other = day - dt.timedelta(days=1)
    assert not store.exists("ft", other, other)
    assert store.exists("ft", START, END)
    assert not store.exists("nothing", day, day)
    assert store.save_feature(facts, keep, "ft", other, other, overwrite=False)


def test_replace_months_leaves_the_others(store, facts):
    store.save_feature(facts, keep, "ft", START, END)
    july = facts.filter("Date_EOM = '2020-07-31'").withColumn("x", F.lit(-1))
    store.replace_months(july, "ft")
    store.replace_months(july, "ft")
    got = {r.Date_EOM: (r["count"], r.low) for r in store.read("ft").groupBy("Date_EOM").agg(
        F.count("*").alias("count"), F.min("x").alias("low")).collect()}
    assert len(got) == 4 and got[dt.date(2020, 7, 31)][1] == -1
    assert sum(n for n, _ in got.values()) == facts.count()
    assert all(low > 0 for month, (_, low) in got.items() if month != dt.date(2020, 7, 31))


def test_months_to_write(store, facts):
    all_months = [dt.date(2020, 6, 30), dt.date(2020, 7, 31), dt.date(2020, 8, 31), dt.date(2020, 9, 30)]
    assert store.months_to_write("ft", START, END) == all_months
    store.save_feature(facts.filter("Date_EOM <> '2020-08-31'"), keep, "ft", START, END)
    assert [r.Date_EOM for r in store.missing_months("ft", START, END).collect()] == [dt.date(2020, 8, 31)]
    assert store.first_missing_month("ft", START, END) == dt.date(2020, 8, 31)
    assert store.months_to_write("ft", START, END) == []
    assert store.months_to_write("ft", START, END, "overwrite") == all_months
    assert store.months_to_write("ft", START, END, "soft_overwrite") == all_months[2:]
    store.replace_months(facts.filter("Date_EOM = '2020-08-31'"), "ft")
    assert store.first_missing_month("ft", START, END) is None
    assert store.months_to_write("ft", START, END, "soft_overwrite") == []
    with pytest.raises(ValueError):
        store.months_to_write("ft", START, END, "sometimes")


def test_combine_keeps_rows_and_resumes(store, facts):
    store.save_feature(facts, by_day, "day_ft", START, END)
    store.save_feature(facts.filter("item < 2"), lambda df: df.select("key", "Date", (F.col("x") * 2).alias("twice")),
                       "row_ft", START, END)
    features = [FeatureTable("day_ft", ("item",)), FeatureTable("row_ft", ("key",))]
    wide = store.combine(facts.filter("Date_EOM < '2020-08-01'"), features, START, "2020-07-31", "soft_overwrite")
    assert store.months("combined_ft") == [dt.date(2020, 6, 30), dt.date(2020, 7, 31)]
    wide = store.combine(facts, features, START, END, "soft_overwrite", months_per_commit=2)
    assert wide.count() == facts.count()
    assert wide.filter("total <> x").isEmpty()
    assert wide.filter("item < 2 and twice <> 2 * x or item = 2 and twice is not null").isEmpty()


def test_combine_refuses_repeated_keys(store, facts):
    store.save_feature(facts.unionAll(facts.limit(1)), lambda df: df.select("key", "Date", "x"), "bad_ft", START, END)
    with pytest.raises(DuplicateKeys):
        store.combine(facts.drop("x"), [FeatureTable("bad_ft", ("key",))], START, END)
    assert store.months("combined_ft") == []


def test_months_prune(store, facts):
    store.save_feature(facts, keep, "ft", START, END)
    from stockline.operators.clean import in_period
    text = in_period(store.read("ft"), "2020-07-02", "2020-07-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date_EOM" in text


def test_failed_write_leaves_the_old_months(store, facts, monkeypatch):
    """Neither a write that fails nor a run stopped between two moves loses a month."""
    store.replace_months(facts, "kept")
    before = sorted(store.read("kept").collect())
    broken = facts.withColumn("x", F.expr("if(key % 7 = 0, cast(raise_error('stop') as bigint), x)"))
    with pytest.raises(Exception, match="stop"):
        store.replace_months(broken, "kept", store.months("kept"))
    assert sorted(store.read("kept").collect()) == before
    moves = []

    def stop_at_second(spark, path, target):
        moves.append(target)
        if len(moves) == 2:
            raise OSError("stopped")
        move_path(spark, path, target)

    monkeypatch.setattr("stockline.sources.store.move_path", stop_at_second)
    changed = facts.withColumn("x", F.col("x") + 1)
    with pytest.raises(OSError, match="stopped"):
        store.replace_months(changed, "kept")
    monkeypatch.undo()
    assert len(store.months("kept")) == 3
    store.repair("kept")
    assert sorted(store.read("kept").collect()) == before
    store.replace_months(store.read("kept").withColumn("x", F.col("x") + 1), "kept", store.months("kept"))
    assert sorted(store.read("kept").select(changed.columns).collect()) == sorted(changed.collect())
    assert child_names(store.spark, store.path(".retired/kept")) == []
    store.replace_months(changed.limit(0), "kept", [dt.date(2020, 7, 31)])
    assert dt.date(2020, 7, 31) not in store.months("kept") and len(store.months("kept")) == 3


def test_faulty_records_are_set_apart(spark, tmp_path):
    """Each line is a good row or a quarantined one; repeated headers and blank lines are neither."""
    (tmp_path / "a.csv").write_text('"Day",N,Name\n2020-01-01,1,"x, y"\n\nday,n,name\n2020-13-01,z,b\n,,\n2020-01-02,2\n2020-01-02,2,b,c\n')
    (tmp_path / "b.csv").write_text("n,day,name\n2020-01-01,1,x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bare.csv").write_text("day,n,name")
    good, bad = read_checked(spark, str(tmp_path), "day date, n int, name string")
    assert good.dtypes == [("day", "date"), ("n", "int"), ("name", "string")]
    assert {(str(r.day), r.n, r.name) for r in good.collect()} == {("2020-01-01", 1, "x, y"), ("None", None, None)}
    assert {(r.file.rsplit("/", 1)[1], r.line, r.reason) for r in bad.collect()} == {
        ("a.csv", "2020-13-01,z,b", "day,n"), ("a.csv", "2020-01-02,2", "fields"), ("a.csv", "2020-01-02,2,b,c", "fields"),
        ("b.csv", "n,day,name", "header"), ("b.csv", "2020-01-01,1,x", "header")}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b,1", 1.5, None), ("c", None, "x")], "MaterialCode string, avgPrice double, types string")
    path = export_csv(df, str(tmp_path), "report")
    assert path.endswith("/report.csv")
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["report.csv"]
    text = read_csv(spark, path)
    assert {t for _, t in text.dtypes} == {"string"} and text.count() == 2
    typed = read_csv(spark, path, "avgPrice double, MaterialCode string")
    assert typed.columns == ["avgPrice", "MaterialCode"]
    assert {r.MaterialCode: r.avgPrice for r in typed.collect()} == {"b,1": 1.5, "c": None}
    assert dict(read_csv(spark, path, infer=True).dtypes)["avgPrice"] == "double"


def test_category_files(spark, tmp_path):
    (tmp_path / "items.csv").write_text('Class Name,Product ID,Other\n"TEA, COFFEE",17,x\n')
    (tmp_path / "groups.csv").write_text(',my_category,product_cat_lv1\n0,"TEA, COFFEE",beverages\n')
    item = read_categories(spark, str(tmp_path / "items.csv")).first()
    assert item.asDict() == {"product_cat_lv2": "TEA, COFFEE", "MaterialCode": "17"}
    group = read_category_groups(spark, str(tmp_path / "groups.csv"), "my_category").first()
    assert group.asDict() == {"product_cat_lv2": "TEA, COFFEE", "product_cat_lv1": "beverages"}


def test_overwrite_reports_rows(spark, facts):
    path = fresh_folder(spark, "table")
    assert overwrite_table(facts, path) == facts.count()
    assert overwrite_table(facts.limit(2).select("x"), path) == 2
    assert spark.read.parquet(path).columns == ["x"]


def test_history_reads_only_the_months_it_needs(store, facts):
    from stockline.operators.trailing import trailing_features
    from stockline.spec import TrailingSpec
    store.save_feature(facts.withColumn("label", F.lit(1)), keep, "ft", START, END)
    group = TrailingSpec("item", ("item",), measures=("x",), horizons=(5,), ratios=(), lag=1)
    late = trailing_features(store.read("ft"), group, "2020-09-10", "2020-09-30")
    assert late.count() > 0
    text = late._jdf.queryExecution().executedPlan().toString()
    assert "Date_EOM" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(Date,2020-08-27)" in text


def test_later_period_adds_its_months_and_keeps_the_others(store, facts):
    store.save_feature(facts.filter("Date < '2020-07-15'"), by_day, "ft", START, "2020-07-31")
    before = store.read("ft").filter("Date_EOM = '2020-06-30'").count() if "Date_EOM" in store.read("ft").columns else None
    assert store.save_feature(facts, by_day, "ft", START, END, overwrite=False)
    assert store.months("ft") == [dt.date(2020, 6, 30), dt.date(2020, 7, 31), dt.date(2020, 8, 31), dt.date(2020, 9, 30)]
    assert before is None or store.read("ft").filter("Date_EOM = '2020-06-30'").count() == before
    assert not store.save_feature(facts, by_day, "ft", START, END, overwrite=False)


def test_combine_returns_its_period_only(store, facts):
    store.save_feature(facts, by_day, "ft", START, END)
    table = [FeatureTable("ft", ("item",))]
    store.combine(facts, table, START, END)
    part = store.combine(facts, table, "2020-07-05", "2020-07-20")
    row = part.agg(F.min("Date"), F.max("Date")).first()
    assert row[0] >= dt.date(2020, 7, 5) and row[1] <= dt.date(2020, 7, 20)


def test_a_month_without_new_rows_is_emptied(store, facts):
    store.save_feature(facts, by_day, "ft", START, END)
    table = [FeatureTable("ft", ("item",))]
    store.combine(facts, table, START, END)
    none = store.combine(facts.filter("Date > '2020-07-31'"), table, "2020-07-01", "2020-07-31", "overwrite")
    assert none.count() == 0
    assert dt.date(2020, 7, 31) not in store.months("combined_ft") and dt.date(2020, 8, 31) in store.months("combined_ft")


def test_a_table_does_not_change_its_columns_silently(store, facts):
    store.replace_months(facts, "ft")
    with pytest.raises(ValueError, match="would change"):
        store.replace_months(facts.withColumn("more", F.lit(1)), "ft")


def test_rows_are_shuffled_once_whatever_the_number_of_tables(spark, store, capsys):
    """Rows and tables meet by slices of days: an exchange for each, none between the joins or before the writers."""
    days = spark.range(400).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("idx"),
                                   F.expr("date_add(date'2020-06-01', cast(id % 90 as int))").alias("Date"))
    months = month_ends("2020-06-01", "2020-08-31")
    tables = [FeatureTable(f"by_{n}", on, unique=True) for n, on in (("a", ("a",)), ("b", ("b",)), ("ab", ("a", "b")))]
    for t in tables:
        store.save_feature(days, lambda d, t=t: d.groupBy(*t.on, "Date").agg(F.sum("idx").alias(f"sum_{t.name}")), t.name, months[0].replace(day=1), months[-1])
    # A row without its day's group, and a null key.
    rows = with_month_end(days.unionByName(days.limit(1).withColumns({"a": F.lit(None).cast("long"), "idx": F.lit(-1).cast("long")})))
    store.save_feature(rows, keep, "rows", months[0].replace(day=1), months[-1])
    rows = store.read("rows")
    want = store.assemble(rows, tables, months)
    for hashed in (True, False):
        with settings(spark, requireAllClusterKeysForCoPartition=False, adaptive__enabled=False, autoBroadcastJoinThreshold=-1):
            got = store.assemble_dealt(rows, tables, months, replace(store.slices(rows, tables, months), hashed=hashed))
            got.explain("simple")
            assert capsys.readouterr().out.count("Exchange") == 1 + len(tables)
            assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    wide = store.combine(rows, tables, months[0].replace(day=1), months[-1], "overwrite", months_per_commit=2)
    assert sorted(wide.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_rounds_of_months_give_the_same_rows(spark, store, facts, monkeypatch):
    """Months are assembled in runs of bounded size; rows that share features lie together, by day and category."""
    store.save_feature(facts, by_day, "totals", START, END)
    tables = [FeatureTable("totals", ("item",), unique=True)]
    want = sorted(store.combine(facts, tables, START, END, "overwrite", "whole", months_per_commit=9).collect())
    written, write = [], FeatureStore._write

    def watched(self, df, name, *more):
        plan = df._jdf.queryExecution().executedPlan().toString()
        written.append((df.select("Date_EOM").distinct().count(), plan.index("Sort [Date_EOM") < plan.index("Join")))
        write(self, df, name, *more)

    monkeypatch.setattr(FeatureStore, "_write", watched)
    monkeypatch.setattr("stockline.sources.store.ROUND_BYTES", 1)
    with settings(spark, autoBroadcastJoinThreshold=-1):
        got = sorted(store.combine(facts, tables, START, END, "overwrite", "parts", months_per_commit=9).collect())
    assert got == want and written == [(1, True)] * 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_what_a_write_shuffles_is_deleted(spark, store, facts):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before = shuffled()
    store.save_feature(facts, by_day, "totals", START, END)
    # They are deleted by other threads.
    until = time.monotonic() + 30
    while not shuffled() <= before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffled() <= before
