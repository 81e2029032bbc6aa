import datetime as dt

from pyspark.sql import functions as F

from stockline.operators import clean, dims


def test_casts_never_fail(spark):
    df = spark.createDataFrame([("1.0", "2020-01-31"), ("x", "2020-13-01"), (None, "")], "n string, d string")
    rows = clean.cast_dates(clean.cast_ints(clean.cast_doubles(df, ["n"]), ["n"]), ["d"]).collect()
    assert [tuple(r) for r in rows] == [(1, dt.date(2020, 1, 31)), (None, None), (None, None)]


def test_null_handling(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, s string")
    cleaned = clean.nan_to_null(df)
    assert [r.x for r in cleaned.collect()] == [1.0, None, None]
    assert clean.drop_empty_rows(cleaned).count() == 1
    assert clean.drop_incomplete_rows(cleaned).count() == 1
    filled = clean.fill_strings(clean.fill_numbers(cleaned))
    assert [tuple(r) for r in filled.collect()] == [(1.0, "a"), (0.0, "others"), (0.0, "others")]
    assert tuple(clean.null_counts(cleaned).first()) == (2, 2)
    # a fill of the wrong type leaves the column alone
    assert clean.fill_numbers(cleaned, ["s"]).filter("s is null").count() == 2


def test_trim_takes_one_blank(spark):
    df = spark.createDataFrame([("a ",), ("a  ",), ("a\t",), ("a",), ("a\x0b",), ("a\x0c",)], "p string")
    assert [r.p for r in clean.trim_last_blank(df, "p").collect()] == ["a", "a ", "a", "a", "a", "a"]


def test_sold_flag(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (-1.0,)], "TotalQtySale double")
    flagged = clean.with_sold_flag(df)
    assert [r.label for r in flagged.collect()] == [1, 0, 0, 0]
    kept = clean.with_sold_flag(df.withColumn("label", F.lit(7)))
    assert {r.label for r in kept.collect()} == {7}


def test_splits(spark):
    df = spark.sql("select explode(sequence(date'2020-05-20', date'2021-01-05', interval 1 day)) as Date")
    df = df.withColumn("Date_EOM", F.last_day("Date"))
    train, test = clean.split_by_day(df, "2020-12-01")
    assert train.agg(F.max("Date")).first()[0] == dt.date(2020, 11, 30)
    assert train.count() + test.count() == df.count()
    dev, oot = clean.split_by_month(df, "2020-06-01", "2020-12-01", "2020-12-31")
    assert dev.agg(F.min("Date"), F.max("Date")).first() == (dt.date(2020, 6, 1), dt.date(2020, 11, 30))
    assert oot.agg(F.min("Date"), F.max("Date")).first() == (dt.date(2020, 12, 1), dt.date(2020, 12, 31))
    assert clean.in_period(df, "2020-06-05", "2020-06-09").count() == 5


def test_stratified_split(spark):
    df = spark.range(4000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    drawn, rest = clean.stratified_split(df, 0.25, "label", ["id"])
    assert drawn.count() + rest.count() == 4000
    assert drawn.join(rest, "id").isEmpty()
    for r in drawn.groupBy("label").count().collect():
        assert abs(r["count"] / (1000 if r.label else 3000) - 0.25) < 0.05
    assert clean.remainder(df, drawn, ["id"]).exceptAll(rest).isEmpty()
    again, _ = clean.stratified_split(df.repartition(7), 0.25, "label", ["id"])
    assert again.exceptAll(drawn).isEmpty()
    assert [p.count() for p in clean.stratified_split(df, 1.0, "label", ["id"])] == [4000, 0]


def test_dimension_joins_do_not_multiply(spark):
    fact = spark.createDataFrame([("s1", "m1"), ("s2", "m2"), ("s3", None)], "BranchCode string, MaterialCode string")
    locations = spark.createDataFrame(
        [("s1", 1, "Bangna ", "d"), ("s1", None, None, None), ("s2", 2, "P", "e")],
        "BranchCode string, ZipCode int, ProvinceEN string, DistrictEN string")
    rows = {r.BranchCode: r for r in dims.with_location(fact, locations).collect()}
    assert len(rows) == 3 and rows["s1"].ProvinceEN == "Bangna" and rows["s3"].ZipCode is None
    categories = spark.createDataFrame([("c1", "m1"), ("c2", "m2")], "product_cat_lv2 string, MaterialCode string")
    groups = spark.createDataFrame([("c1", "g1")], "product_cat_lv2 string, product_cat_lv1 string")
    rows = {r.BranchCode: (r.product_cat_lv1, r.product_cat_lv2)
            for r in dims.with_category(fact, categories, groups).collect()}
    assert rows == {"s1": ("g1", "c1"), "s2": ("others", "c2"), "s3": ("others", "others")}


def test_position_falls_back_to_province(spark):
    rows = spark.createDataFrame([(1, "a"), (9, "a"), (9, "z"), (None, None)], "ZipCode int, ProvinceEN string")
    table = spark.createDataFrame(
        [(1, "a", 10.0, 100.0), (1, "a", 20.0, 110.0), (2, "a", 30.0, 120.0)],
        "ZipCode int, ProvinceEN string, latitude double, longitude double")
    got = {(r.ZipCode, r.ProvinceEN): (r.latitude, r.longitude) for r in dims.with_lat_long(rows, table).collect()}
    assert got == {(1, "a"): (15.0, 105.0), (9, "a"): (20.0, 110.0), (9, "z"): (None, None), (None, None): (None, None)}


def test_price_features_without_a_price(spark):
    df = spark.createDataFrame([(10.0, 8.0, 6.0), (0.0, 0.0, 1.0)], "avgPrice double, avgPriceDis double, supPrice double")
    rows = [(r.revenue, r.discount, r.percentage_discount) for r in dims.with_price_features(df).collect()]
    assert rows == [(4.0, 2.0, 20.0), (-1.0, 0.0, None)]
