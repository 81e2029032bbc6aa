"""Indexing, assembling, fitting and scoring with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorIndexer)
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window, functions as F

from stockline import spec
from stockline.sources.files import path_exists

FEATURES = "features_col"
PREDICTION = "prediction"
# Bytes that the binned inputs of the rows of one task may take while trees are fitted.
TASK_BYTES = 128 << 20


def string_indexer(columns: Sequence[str], invalid: str = "keep", suffix: str = "_idx") -> StringIndexer:
    """Categories numbered by falling frequency, ties by name."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns],
                         stringOrderType="frequencyDesc", handleInvalid=invalid)


def fit_transforms(train: DataFrame, categories: Sequence[str], numbers: Sequence[str],
                   one_hot: bool = False, invalid: str = "keep") -> PipelineModel:
    """Index the categories and assemble them with the numbers into one vector.

    All categories are indexed by one stage, hence in one job. Categories
    unseen in training get an index of their own when scoring.
    """
    stages, encoded = [], []
    if categories:
        stages.append(string_indexer(categories, invalid))
        encoded = [f"{c}_idx" for c in categories]
        if one_hot:
            encoded = [f"{c}_vec" for c in categories]
            stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in categories], outputCols=encoded))
    stages.append(VectorAssembler(inputCols=[*numbers, *encoded], outputCol=FEATURES))
    return Pipeline(stages=stages).fit(train)


def in_few_tasks(train: DataFrame, features: str = FEATURES, size: int = TASK_BYTES) -> DataFrame:
    """The rows in as few tasks as memory and the cores allow, none of more than ``size`` bytes of binned inputs.

    Each task of a level of trees sends a histogram per node, input and bin,
    however few rows it has, so the shuffle grows with the tasks. A tree keeps
    four bytes per row and input.
    """
    first = train.select(features).first()
    if first is None:
        return train
    wanted = -(-train.count() * 4 * len(first[0]) // size)
    tasks, cores = train.rdd.getNumPartitions(), train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(wanted, cores)) if tasks > max(wanted, cores) else train


def fit_regressor(train: DataFrame, regressor=RandomForestRegressor, features: str = FEATURES,
                  label: str = spec.QUANTITY, **params) -> Model:
    """Fit on rows that are stored; they are read several times."""
    return regressor(labelCol=label, featuresCol=features, predictionCol=PREDICTION, **params).fit(in_few_tasks(train, features))


class HashedMeans(Estimator):
    """Columns hashed to ``size`` positions, each position as the mean label it had in training.

    The fitted stage looks the means up in one array per column, so a row gets
    one number where a flag per position would give it ``size`` of them. A null
    has a position of its own; one that training did not see gets the mean of all.
    """

    def __init__(self, columns: Sequence[str], outputs: Sequence[str], label: str, size: int) -> None:
        super().__init__()
        self.columns, self.outputs, self.label, self.size = list(columns), list(outputs), label, size

    def place(self, column: str) -> str:
        return f"coalesce(if(`{column}` is null, null, pmod(hash(cast(`{column}` as string)), {self.size})), {self.size})"

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        known = dataset.filter(F.col(self.label).isNotNull())
        overall = known.agg(F.avg(self.label).cast("double")).first()[0] or 0.0
        parts = ["*"]
        for column, output in zip(self.columns, self.outputs, strict=True):
            # At most one row per position comes to the driver.
            means = known.groupBy(F.expr(self.place(column)).alias("place")).agg(F.avg(self.label).cast("double").alias("mean"))
            found = {r["place"]: r["mean"] for r in means.collect()}
            # As one text, which Spark turns into an array once per plan; thousands of literals would be analysed by every later stage.
            values = ",".join(repr(found.get(i, overall)) for i in range(self.size + 1))
            parts.append(f"get(cast(split('{values}', ',') as array<double>), {self.place(column)}) as `{output}`")
        return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def baseline_pipeline(numbers: Sequence[str] = tuple(spec.BASELINE_NUMBERS),
                      strings: Sequence[str] = tuple(spec.BASELINE_STRINGS),
                      label: str = spec.QUANTITY, regressor=GBTRegressor,
                      hashed: Sequence[str] = (spec.ITEM, spec.STORE), hash_size: int = 1 << 12, **params) -> Pipeline:
    """Index, one-hot encode, find small categoricals, assemble and boost.

    Rows with an indexed category unseen in training are skipped. An index
    keeps every label in the model, on the driver; identifiers, of which there
    may be too many for that, are ``hashed`` to ``hash_size`` positions instead,
    which enter as their mean label: a tree keeps a number per row and input, and
    orders the values of a category by their means anyway.
    """
    index, one_hot, small = "_place", "_flags", "_small"
    features, means = "inputs", [f"{h}_mean" for h in hashed]
    named = [s for s in strings if s not in hashed]
    stages, vectors = [], [f"{s}{small}" for s in named]
    if named:
        stages += [
            string_indexer(named, "skip", index),
            OneHotEncoder(inputCols=[s + index for s in named], outputCols=[s + one_hot for s in named]),
            *[VectorIndexer(inputCol=s + one_hot, outputCol=s + small, maxCategories=10) for s in named]]
    if hashed:
        stages.append(HashedMeans(hashed, means, label, hash_size))
        vectors += means
    return Pipeline(stages=[
        *stages,
        VectorAssembler(inputCols=[*numbers, *vectors], outputCol=features),
        regressor(labelCol=label, featuresCol=features, predictionCol=PREDICTION, **params),
    ])


def save_model(train: DataFrame, path: str, regressor=RandomForestRegressor, features: str = FEATURES,
               label: str = spec.QUANTITY, transforms: PipelineModel | None = None,
               overwrite: bool = False, **params) -> bool:
    """Fit and save a model, fused with its transforms if these are given.

    Returns False if a model exists and is to be kept.
    """
    if not overwrite and path_exists(train.sparkSession, path):
        return False
    fitted = fit_regressor(train, regressor, features, label, **params)
    model = PipelineModel(stages=[transforms, fitted] if transforms is not None else [fitted])
    model.write().overwrite().save(path)
    return True


def score(df: DataFrame, model_path: str, columns: Sequence[str]) -> DataFrame:
    return PipelineModel.load(model_path).transform(df).select(*columns, PREDICTION)


def feature_importance(scored: DataFrame, model: Model, features: str = FEATURES) -> DataFrame:
    """Importance of each input of a tree model, with its running sum.

    The table has one row per input of the model, which bounds it.
    """
    groups = scored.schema[features].metadata["ml_attr"]["attrs"].values()
    importance = model.featureImportances
    rows = [(attr["name"], float(importance[attr["idx"]])) for group in groups for attr in group]
    table = scored.sparkSession.createDataFrame(
        [r for r in rows if r[1] != 0], "feature_name string, importance double")
    down = F.col("importance").desc()
    return (table.withColumn("cumsum", F.sum("importance").over(Window.orderBy(down)))
            .orderBy(down, "feature_name"))
