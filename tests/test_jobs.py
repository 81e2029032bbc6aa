"""The four jobs from end to end on a small synthetic chain of stores."""

import datetime as dt

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from stockline import spec
from stockline.functions.dates import with_calendar
from stockline.operators import averages, embedding, model, promo
from stockline.operators.dims import Dimensions
from stockline.plans import baseline, embed, score, train
from stockline.session import fresh_folder
from stockline.sources import tables
from stockline.sources.store import FeatureStore
from stockline.spec import FeaturePlan, RecencySpec, TrailingSpec

PERIODS = train.Periods(tables.START, "2001-06-01", "2001-10-01", "2001-10-31")
PLAN = FeaturePlan(
    keys=tables.KEYS,
    trailing=(TrailingSpec("mc", (spec.ITEM,), horizons=(60, 90)[:1], ratios=()),
              TrailingSpec("cat_lv2", (spec.CATEGORY_2,), horizons=(60, 90), ratios=((60, 90),))),
    recency=(RecencySpec("cat_lv2_br", (spec.CATEGORY_2, spec.STORE), horizons=(60,)),),
    promo_numbers=("RF_A", "LS_F", "DS001"))


@pytest.fixture(scope="module")
def sides(spark, small) -> Dimensions:
    return tables.dimensions(spark, small)


@pytest.fixture(scope="module")
def fact(spark, small):
    return tables.with_supply_price(tables.sales(spark, small), small)


@pytest.fixture(scope="module")
def trained(spark, fact, sides):
    store = FeatureStore(spark, fresh_folder(spark, "features"))
    folder = fresh_folder(spark, "model")
    result = train.train(fact, sides, store, folder, PLAN, PERIODS, promo_cutoff=1, months_per_commit=3,
                         numTrees=3, maxDepth=3, seed=1)
    return store, folder, result


def test_training(spark, fact, trained):
    store, folder, result = trained
    oot = fact.filter(F.col("Date").between("2001-10-01", "2001-10-31"))
    assert result.predictions.count() == oot.count() > 0
    row = result.evaluation.first()
    assert 0 < row.mae <= row.rmse < 40
    importance = result.importance.collect()
    assert importance and importance[-1]["cumsum"] == pytest.approx(1.0)
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)
    assert (spark.read.option("header", True).csv(f"{folder}/feat_imps/importance.csv").count() == len(importance))
    assert store.months("combined_ft")[-1] == dt.date(2001, 10, 31)
    assert not model.save_model(result.predictions, result.model_path)


def test_scoring(spark, fact, sides, trained):
    _, _, result = trained
    day = dt.date(2001, 10, 27)
    store = FeatureStore(spark, fresh_folder(spark, "scoring"))
    scored = score.score_day(fact, sides, store, result.model_path, day, PLAN)
    assert scored.count() == fact.filter(F.col("Date") == day - dt.timedelta(days=7)).count() + \
        fact.filter(F.col("Date") == day).count()
    assert scored.filter("prediction is null").isEmpty()
    assert {r.Date for r in scored.select("Date").distinct().collect()} == {day}
    path = score.score_to_csv(scored, fresh_folder(spark, "out"), day)
    assert path.endswith("forecast_2001-10-27")
    assert spark.read.option("header", True).csv(path).count() == scored.count()


def test_scoring_lag_reaches_every_feature():
    plan = FeaturePlan().with_lag(7)
    assert {s.lag for s in plan.trailing + plan.recency} == {7}
    assert plan.history_days() == 2 * 188
    assert len(FeaturePlan().numbers()) + len(spec.CATEGORIES) == 27 + 6 + 10 * 44 + 4 * 4


def test_full_plan_builds(spark, fact, sides):
    """Every default group yields its columns on the sales model."""
    from stockline.operators import recency, trailing
    base = tables.sales_for(spark, "/root/testdata/sf0.001", ("ProvinceEN", spec.CATEGORY_2, "DayOfWeek"))
    for group in FeaturePlan().trailing:
        assert trailing.trailing_features(base, group).columns == [*group.group_cols, "Date", *group.columns()]
    for group in FeaturePlan().recency:
        assert recency.recency_features(base, group).columns == [*group.group_cols, "Date", *group.columns()]


@pytest.fixture(scope="module")
def text_inputs(spark, fact, sides):
    folder = fresh_folder(spark, "text")
    (fact.select("BranchCode", "MaterialCode", "Date", "avgPriceDis", "avgPrice", "supPrice", "label",
                 F.col("TotalNetSale").cast("double").alias("totalNetSale"), "TotalQtySale", "types")
     .withColumns({"Branch": F.lit("b"), "Name": F.lit("n")})
     .write.option("header", True).csv(f"{folder}/sales"))
    sides.locations.write.option("header", True).csv(f"{folder}/location")
    return f"{folder}/sales", f"{folder}/location"


def test_average_baseline(spark, text_inputs):
    rows = baseline.read_inputs(spark, *text_inputs)
    types = dict(rows.dtypes)
    assert types["label"] == "int" and types["Date"] == "date" and types["TotalQtySale"] == "double"
    predicted, evaluation = baseline.average_baseline(rows, "2001-10-01")
    history = {r.MaterialCode: r.a for r in rows.filter("Date < '2001-10-01'").groupBy("MaterialCode").agg(
        F.avg("TotalQtySale").alias("a")).collect()}
    got = predicted.collect()
    assert got and all(r.prediction == pytest.approx(history[r.MaterialCode]) for r in got)
    assert evaluation.first().rmse > 0


def test_boosted_baseline(spark, text_inputs):
    rows = baseline.read_inputs(spark, *text_inputs)
    predicted, evaluation = baseline.boosted_baseline(
        rows, fresh_folder(spark, "gbt"), "2001-10-01", maxIter=2, maxDepth=2, seed=1)
    assert 0 < predicted.count() <= rows.filter("Date >= '2001-10-01'").count()
    assert evaluation.first().percent_oos is not None


def test_hashed_identifiers(spark, text_inputs):
    rows = baseline.read_inputs(spark, *text_inputs)
    predicted, _ = baseline.boosted_baseline(
        rows, fresh_folder(spark, "gbt"), "2001-10-01", hashed=["MaterialCode", "BranchCode"], hash_size=64,
        maxIter=1, maxDepth=2, seed=1)
    assert predicted.count() == rows.filter("Date >= '2001-10-01'").count()


def test_grouping_sets_equal_single_averages(spark, fact):
    rows = with_calendar(fact)
    every = averages.all_averages(rows)
    for name, grain in averages.GRAINS.items():
        others = [c for c in ("BranchCode", "MaterialCode", "DayOfWeek", "Month") if c not in grain]
        part = every.filter(" and ".join(f"{c} is null" for c in others)).filter(
            " and ".join(f"{c} is not null" for c in grain)).select(*grain, F.round("average", 9))
        single = averages.historical_average(rows, name).select(*grain, F.round(name, 9))
        assert part.exceptAll(single).isEmpty() and part.count() == single.count()


def test_unseen_categories_score(spark):
    seen = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0), ("b", 3.0, 4.0)], "c string, x double, TotalQtySale double")
    new = spark.createDataFrame([("z", 1.0, 0.0)], "c string, x double, TotalQtySale double")
    transforms = model.fit_transforms(seen, ["c"], ["x"], one_hot=True)
    fitted = model.fit_regressor(transforms.transform(seen), RandomForestRegressor, numTrees=2)
    assert fitted.transform(transforms.transform(new)).first().prediction > 0


def test_embeddings(spark, small):
    rows = tables.sales_for(spark, small, (spec.CATEGORY_2, "DistrictEN", "DayOfWeek"))
    wide = promo.with_promo_flags(rows, ["RF_A", "LS_F"]).withColumnsRenamed({"RF_A": "RA001", "LS_F": "LF002"})
    assert sorted(embed.promo_columns(wide, 1.0)) == ["LF002", "RA001"]
    folder = fresh_folder(spark, "vectors")
    categories = [spec.CATEGORY_2, "DistrictEN", "DayOfWeek"]
    held, test = embed.train_and_save(
        wide, folder, categories, ["Month", "avgPrice"], ["RA001", "LF002"],
        tables.START, tables.START_OOT, tables.END, size=3, maxIter=50, stepSize=0.1)
    spread = wide.select(F.stddev(F.log1p("TotalQtySale"))).first()[0]
    assert 0 < held.first().rmsle < spread and 0 < test.first().rmsle < spread
    vectors = embedding.load_embeddings(spark, folder)
    assert {r["column"]: r["count"] for r in vectors.categories.groupBy("column").count().collect()} == {
        spec.CATEGORY_2: 25, "DistrictEN": 5, "DayOfWeek": 7}
    out = embedding.embedding_features(wide, vectors, categories, tables.KEYS)
    assert out.count() == wide.count()
    assert [c for c in out.columns if "_embed" in c] == [
        *[f"{c}_embed{i}" for c in categories for i in range(3)], *[f"promo_embed{i}" for i in range(3)]]


def test_unknown_category_has_a_zero_vector(spark):
    lookup = spark.createDataFrame([("c", "a", [1.0, 2.0])], "column string, category string, vector array<double>")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    got = {r.c: (r.c_embed0, r.c_embed1) for r in embedding.with_category_embeddings(df, lookup, {"c": 2}).collect()}
    assert got == {"a": (1.0, 2.0), "b": (0.0, 0.0), None: (0.0, 0.0)}


def test_promo_vectors_add_up(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (0, None)], "p int, q int")
    got = embedding.with_promo_embedding(df, {"p": [1.0, 2.0], "q": [0.5, -1.0]})
    assert [(r.promo_embed0, r.promo_embed1) for r in got.collect()] == [(1.0, 2.0), (1.5, 1.0), (0.0, 0.0)]


def test_hashed_identifiers_are_one_input_each(spark, text_inputs):
    rows = with_calendar(baseline.read_inputs(spark, *text_inputs))
    fitted = model.baseline_pipeline(maxIter=1, maxDepth=2, seed=1).fit(rows)
    out = fitted.transform(rows)
    assert len(out.first()["inputs"]) < 64
    means = rows.groupBy("MaterialCode").agg(F.avg("TotalQtySale").alias("a"))
    # Few items share one of the 4,096 positions, so nearly all have their own mean.
    near = out.select("MaterialCode", "MaterialCode_mean").distinct().join(means, "MaterialCode")
    assert near.filter("abs(MaterialCode_mean - a) < 1e-9").count() > 0.8 * near.count()


def test_unseen_and_absent_identifiers_have_a_mean(spark):
    seen = spark.createDataFrame([("a", 2.0), ("a", 4.0), (None, 12.0)], "c string, y double")
    fitted = model.HashedMeans(["c"], ["m"], "y", 1 << 12).fit(seen)
    new = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert {r.c: r.m for r in fitted.transform(new).collect()} == {"a": 3.0, "b": 6.0, None: 12.0}


def test_a_small_lookup_of_large_estimate_is_broadcast(spark):
    rows = spark.range(1000).select((F.col("id") % 5).cast("string").alias("c"))
    lookup = spark.range(3_000_000).select((F.col("id") % 5).cast("string").alias("category")).distinct().select(
        F.lit("c").alias("column"), "category", F.array(F.lit(1.0)).alias("vector"))
    out = embedding.with_category_embeddings(rows, lookup, {"c": 1})
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.sum("c_embed0")).first()[0] == 1000


@pytest.fixture(scope="module")
def few_combinations(spark):
    n = F.col("id")
    return spark.range(4000).select(
        F.when(n % 11 != 0, F.concat(F.lit("c"), n % 4)).alias("c"), (n % 3).cast("string").alias("d"),
        (n % 5 == 0).cast("int").alias("p"), (n % 7 < 3).cast("int").alias("q"),
        (n * 37 % 101).cast("double").alias("x"), (n * 53 % 89).alias("y"), F.lit(3).alias("same"),
        (n % 4 * (n * 37 % 101) / 20 + n % 3 + (n % 5 == 0).cast("int") * 4).alias("TotalQtySale"))


@pytest.mark.parametrize("params", [{"regParam": 0.001}, {"fitIntercept": False, "fitLinear": False}, {"tol": 0.05}])
def test_vectors_from_sums_equal_those_from_rows(spark, few_combinations, monkeypatch, params):
    columns = (["c", "d"], ["p", "q"], ["x", "y", "same"])
    given = dict(size=3, maxIter=12, stepSize=0.1, seed=7) | params
    new = few_combinations.limit(50).unionByName(few_combinations.limit(5).withColumn("c", F.lit("unseen")))

    def learn():
        vectors, pipeline = embedding.train_embeddings(few_combinations, *columns, **given)
        found = {(r.column, r.category): r.vector for r in vectors.categories.collect()}
        return found | {r.promo: r.vector for r in vectors.promos.collect()}, [r.prediction for r in pipeline.transform(new).collect()]

    vectors, predicted = learn()
    monkeypatch.setattr(embedding, "sums_pay", lambda *_: False)
    wanted, expected = learn()
    assert vectors.keys() == wanted.keys() and len(vectors) == 4 + 3 + 2
    for name, vector in wanted.items():
        assert vectors[name] == pytest.approx(vector, abs=1e-8)
    assert predicted == pytest.approx(expected, abs=1e-8)


def test_steps_do_not_read_the_rows(spark, few_combinations, monkeypatch):
    read, fit = [], embedding.FMRegressor.fit
    monkeypatch.setattr(embedding.FMRegressor, "fit", lambda self, df, *more: read.append(df.count()) or fit(self, df, *more))
    embedding.train_embeddings(few_combinations, ["c", "d"], ["p", "q"], ["x", "y"], size=3, maxIter=5, stepSize=0.1, seed=7)
    assert sum(read) < 100


def test_a_quantity_that_is_no_number_is_an_error(spark, few_combinations):
    rows = few_combinations.withColumn("TotalQtySale", F.when(F.col("x") != 5, F.col("TotalQtySale")))
    with pytest.raises(Exception, match="(?i)number|label"):
        embedding.train_embeddings(rows, ["c", "d"], ["p", "q"], ["x", "y"], size=3, maxIter=2, seed=7)


def test_trees_are_fitted_in_few_tasks(spark, trained):
    """Every task of a level sends a histogram per node, so tasks are as few as memory and cores allow."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.read.parquet(f"{trained[1]}/training_dataset").repartition(4 * cores)
    assert model.in_few_tasks(rows).rdd.getNumPartitions() == cores
    width, n = len(rows.first()[model.FEATURES]), rows.count()
    assert model.in_few_tasks(rows, size=-(-n * 4 * width // (2 * cores))).rdd.getNumPartitions() == 2 * cores
    assert model.in_few_tasks(rows, size=1).rdd.getNumPartitions() == 4 * cores
    assert model.in_few_tasks(rows.limit(0)).count() == 0
    read = []
    given = lambda self, df, *more: read.append(df.rdd.getNumPartitions()) or RandomForestRegressor.fit(self, df, *more)
    model.fit_regressor(rows, type("Watched", (RandomForestRegressor,), {"fit": given}), numTrees=1, maxDepth=1)
    assert read == [cores]
