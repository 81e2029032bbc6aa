"""Training: features, assembly, model, evaluation, importance."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from stockline import spec
from stockline.functions import metrics
from stockline.functions.dates import shift_days, with_month_end
from stockline.operators import clean, dims, grouping, model, trailing
from stockline.sources.files import export_csv, overwrite_table, path_exists
from stockline.sources.store import FeatureStore, FeatureTable, SOFT_OVERWRITE
from stockline.spec import FeaturePlan

log = logging.getLogger(__name__)

BASIC = "basic_ft"
DAILY_SETS = "daily_sets_ft"


@dataclass(frozen=True)
class Periods:
    start: str = spec.START
    dev: str = spec.START_DEV
    oot: str = spec.START_OOT
    end: str = spec.END


@dataclass(frozen=True)
class Trained:
    predictions: DataFrame
    evaluation: DataFrame
    importance: DataFrame
    model_path: str


def save_basic(sales: DataFrame, sides: dims.Dimensions, store: FeatureStore, start, end,
               promo_cutoff: float, overwrite: bool) -> DataFrame:
    """Basic features written once; everything else starts from the stored rows."""
    if spec.MONTH not in sales.columns:
        sales = with_month_end(sales)
    store.save_feature(sales, dims.basic_features, BASIC, start, end, overwrite,
                       dims=sides, promo_cutoff=promo_cutoff)
    return clean.with_sold_flag(store.read(BASIC))


def save_rollups(base: DataFrame, store: FeatureStore, specs: Sequence[grouping.Spec], measures: Sequence[str], start, end) -> None:
    """Daily totals of all grouping sets, from one pass over the fact per roll-up.

    They are rewritten on every run, for the days that the asked features can
    reach back to.
    """
    first = shift_days(start, -max(s.history_days() for s in specs))
    wanted = list(dict.fromkeys(s.group_cols for s in specs))
    parts = []
    for name, columns in [*spec.ROLLUPS.items(), *((f"daily_{grouping.set_name(g)}", g) for g in wanted)]:
        sets = [g for g in wanted if set(g) <= set(columns)]
        wanted = [g for g in wanted if g not in sets]
        if sets:
            kept = [c for c in columns if any(c in g for g in sets)]
            store.save_feature(clean.in_period(base, first, end), trailing.roll_up, name, first, end, True,
                               columns=kept, measures=measures)
            parts.append(grouping.daily_sets(store.read(name), sets, measures))
    daily = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    store.save_feature(daily, lambda rows: rows, DAILY_SETS, first, end, True)


def save_features(base: DataFrame, store: FeatureStore, plan: FeaturePlan, start, end,
                  overwrite: bool) -> list[FeatureTable]:
    """One table per feature set, trailing and recency at the grain of group and day.

    All sets that share their settings are computed by one plan.
    """
    saved, due = [], []
    for kind, specs in (("ts_agg", plan.trailing), ("consc", plan.recency)):
        for number, same in enumerate(grouping.alike(specs)):
            name = f"{kind}_sets_{number}"
            tables = [FeatureTable(f"{name}/{grouping.SET}={grouping.set_name(s.group_cols)}", s.group_cols, True, grouping.own_columns(s, same))
                      for s in same]
            saved += tables
            todo = [s for s, t in zip(same, tables, strict=True) if overwrite or not store.exists(t.name, start, end)]
            if todo:
                due.append((name, same, todo))
    if due:
        save_rollups(base, store, [s for _, _, todo in due for s in todo], plan.measures(), start, end)
        daily = store.read(DAILY_SETS)
        for name, same, todo in due:
            sets = [grouping.set_name(s.group_cols) for s in todo]
            windows = grouping.set_windows(daily.filter(F.col(grouping.SET).isin(sets)), same, start, end)
            store.save_sets(windows, name, grouping.SET, sets, start, end, lambda rows, same=same: grouping.set_statistics(rows, same))
    return saved


def model_rows(wide: DataFrame, plan: FeaturePlan) -> DataFrame:
    """Model inputs without nulls; a promotion that never occurred is a column of zeros."""
    absent = {c: F.lit(0) for c in plan.promo_numbers if c not in wide.columns}
    rows = wide.withColumns(absent) if absent else wide
    return clean.fill_strings(clean.fill_numbers(rows, plan.numbers()), list(plan.categories))


def train(sales: DataFrame, sides: dims.Dimensions, store: FeatureStore, model_folder: str,
          plan: FeaturePlan | None = None, periods: Periods | None = None, label: str = spec.QUANTITY,
          regressor=RandomForestRegressor, promo_cutoff: float = spec.PROMO_CUTOFF,
          overwrite_features: bool = False, save_mode: str = SOFT_OVERWRITE,
          overwrite_model: bool = False, months_per_commit: int = 1, **params) -> Trained:
    """From the sales fact to a stored model and its out-of-time evaluation.

    A stored model is kept only if it was fitted for the same plan and periods.
    """
    plan, periods = plan or FeaturePlan(), periods or Periods()
    spark, root = sales.sparkSession, model_folder.rstrip("/")
    made_for = f"{plan} {periods} {regressor.__name__} {sorted(params.items())}"
    known = path_exists(spark, f"{root}/made_for") and spark.read.text(f"{root}/made_for", wholetext=True).first()
    overwrite_model = overwrite_model or not known or known[0].strip() != made_for
    base = save_basic(sales, sides, store, periods.start, periods.end, promo_cutoff, overwrite_features)
    saved = save_features(base, store, plan, periods.dev, periods.end, overwrite_features)
    wide = store.combine(base, saved, periods.dev, periods.end, save_mode, months_per_commit=months_per_commit)
    rows = model_rows(wide, plan)
    log.info("%d model inputs", len(plan.numbers()) + len(plan.categories))

    dev, oot = clean.split_by_month(rows, periods.dev, periods.oot, periods.end)
    transforms = model.fit_transforms(dev, plan.categories, plan.numbers(), one_hot=True)
    kept = list(dict.fromkeys([*plan.keys, spec.ITEM, spec.STORE, spec.DATE, label, model.FEATURES]))
    for name, part in (("training_dataset", dev), ("testing_dataset", oot)):
        if overwrite_model or not path_exists(spark, f"{root}/{name}"):
            rows_written = overwrite_table(transforms.transform(part).select(*kept), f"{root}/{name}")
            log.info("%s has %d rows", name, rows_written)

    model_path = f"{root}/saved_model"
    vectors = spark.read.parquet(f"{root}/training_dataset")
    model.save_model(vectors, model_path, regressor, label=label, transforms=transforms,
                     overwrite=overwrite_model, **params)
    spark.createDataFrame([(made_for,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/made_for")
    fitted = PipelineModel.load(model_path).stages[-1]
    overwrite_table(fitted.transform(spark.read.parquet(f"{root}/testing_dataset")), f"{root}/testing_prediction")

    predictions = spark.read.parquet(f"{root}/testing_prediction")
    evaluation = metrics.evaluate(predictions, label)
    importance = model.feature_importance(predictions, fitted)
    export_csv(importance, f"{root}/feat_imps", "importance")
    return Trained(predictions, evaluation, importance, model_path)
