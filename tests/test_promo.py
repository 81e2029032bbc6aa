import pytest

from stockline.operators import frequency, promo


@pytest.fixture(scope="module")
def promos(spark):
    return spark.createDataFrame(
        [(1, "NORMAL"), (2, "DS001"), (3, "DS001|FR002"), (4, "DS0011"), (5, None), (6, "DS001|DS001")],
        "id int, types string")


def test_codes_match_whole_tokens(promos):
    rows = {r.id: r.asDict() for r in promo.with_promo_flags(promos, ["DS001", "FR002"]).collect()}
    assert [rows[i]["DS001"] for i in range(1, 7)] == [0, 1, 1, 0, 0, 1]
    assert [rows[i]["FR002"] for i in range(1, 7)] == [0, 0, 1, 0, 0, 0]
    assert "types" not in rows[1]


def test_counts_equal_flag_sums(promos):
    counts = {r.code: r.n for r in promo.promo_counts(promos).collect()}
    assert counts == {"DS001": 3, "FR002": 1, "DS0011": 1}
    flags = promo.with_promo_flags(promos, sorted(counts))
    assert {r.code: r.n for r in frequency.flag_counts(flags, sorted(counts)).collect()} == counts


def test_one_hot_cut(promos):
    assert promo.one_hot_promotion(promos, 1).columns == ["id", "DS001", "DS0011", "FR002"]
    assert promo.one_hot_promotion(promos, 0.8).columns == ["id", "DS001", "DS0011"]
    assert promo.one_hot_promotion(promos, 0.5).columns == ["id"]


@pytest.mark.parametrize("cutoff,kept", [(0.99, ["a", "b"]), (0.95, ["a"]), (1, ["a", "b", "c"]), (0.5, [])])
def test_cut_is_inclusive(spark, cutoff, kept):
    rows = [("a",)] * 90 + [("b",)] * 9 + [("c",)]
    df = spark.createDataFrame(rows, "c string")
    found = frequency.frequent_categories(df, cutoff, "c").orderBy("cumsum")
    assert [r.code for r in found.collect()] == kept


def test_cut_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("z",), ("x",), ("y",)] * 5, "c string")
    found = frequency.frequent_categories(df, 0.7, "c").orderBy("cumsum")
    assert [r.code for r in found.collect()] == ["x", "y"]


def test_flags_and_categories_cut_alike(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (0, 0)], "p int, q int")
    assert frequency.percentile_cutoff(df, 0.75, ["p", "q"]) == ["p"]


def test_running_total_over_many_slices(spark):
    from pyspark.sql import functions as F
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 997).alias("n"), F.col("id").alias("k"))
        got = frequency.running_total(df, [F.col("n").desc(), F.col("k").asc()], "n", "cumsum")
        rows = sorted(((-r.n, r.k, r.n, r.cumsum) for r in got.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = 0
    for _, _, n, cumsum in rows:
        total += n
        assert cumsum == total


def test_tied_sum(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "k string, v int")
    assert {r.k: r.cumsum for r in frequency.tied_cumulative_sum(df, "v").collect()} == {
        "a": 5, "b": 11, "c": 11, "d": 12}
