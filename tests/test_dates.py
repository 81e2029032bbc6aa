import datetime as dt

from pyspark.sql import functions as F

from stockline.functions import dates


def test_month_values():
    assert dates.month_end("2020-02-11") == dt.date(2020, 2, 29)
    assert dates.month_end("2021-12-31") == dt.date(2021, 12, 31)
    assert dates.shift_months("2020-01-31", 1) == dt.date(2020, 2, 29)
    assert dates.shift_months("2020-01-31", -2) == dt.date(2019, 11, 30)
    assert dates.shift_days("2020-03-01", -7) == dt.date(2020, 2, 23)
    assert dates.month_ends("2020-06-01", "2020-12-31") == [
        dt.date(2020, 6, 30), dt.date(2020, 7, 31), dt.date(2020, 8, 31), dt.date(2020, 9, 30),
        dt.date(2020, 10, 31), dt.date(2020, 11, 30), dt.date(2020, 12, 31)]


def test_columns_agree_with_values(spark):
    days = spark.sql("select explode(sequence(date'2019-12-20', date'2021-01-10', interval 9 days)) as d")
    rows = days.select("d", F.last_day("d").alias("e"), dates.month_shifted(F.col("d"), 5).alias("s")).collect()
    assert all(r.e == dates.month_end(r.d) and r.s == dates.shift_months(r.d, 5) for r in rows)


def test_calendar(spark):
    df = spark.sql("select date'2020-01-05' as Date union all select date'2021-01-03'")
    rows = {str(r.Date): r for r in dates.with_calendar(df).collect()}
    assert rows["2020-01-05"].DayOfWeek == 1 and rows["2020-01-05"].WeekOfYear == 1
    assert rows["2021-01-03"].WeekOfYear == 53 and rows["2021-01-03"].Yearday == 3
    assert rows["2020-01-05"].MonthQuarter == rows["2020-01-05"].Quarter == 1


def test_calendar_between(spark):
    got = [r.Date_EOM for r in dates.calendar_between(spark, "2020-11-15", "2021-02-01").orderBy("Date_EOM").collect()]
    assert got == dates.month_ends("2020-11-15", "2021-02-01")
