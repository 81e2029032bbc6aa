"""Category vectors: learning, lookup tables and application.

The vectors are the factors of a factorisation machine fitted on one-hot
categories, promotion flags and numbers against ``log(1 + quantity)``, that
is, under a squared log error. Fitting is distributed; only the factors, one
row per category, come back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, VectorAssembler
from pyspark.ml.regression import FMRegressor
from pyspark.sql import Column, DataFrame, functions as F

from stockline import spec
from stockline.operators.clean import fill_numbers, fill_strings, nan_to_null
from stockline.operators.factors import Inputs, fit_on_sums, predictor, sums_pay
from stockline.operators.model import string_indexer
from stockline.session import on_file
from stockline.sources.files import overwrite_table, read_table

# Fixed value: the longest vector of a category.
LONGEST_VECTOR = 50


@dataclass(frozen=True)
class Embeddings:
    """``categories(column, category, vector)`` and ``promos(promo, vector)``."""

    categories: DataFrame
    promos: DataFrame

    def save(self, folder: str) -> None:
        overwrite_table(self.categories, f"{folder.rstrip('/')}/categories")
        overwrite_table(self.promos, f"{folder.rstrip('/')}/promos")


def load_embeddings(spark, folder: str) -> Embeddings:
    root = folder.rstrip("/")
    return Embeddings(read_table(spark, f"{root}/categories"), read_table(spark, f"{root}/promos"))


def clean_for_embedding(df: DataFrame, categories: Sequence[str], numbers: Sequence[str],
                        promos: Sequence[str]) -> DataFrame:
    text = df.withColumns({c: F.col(c).cast("string") for c in categories})
    return fill_strings(fill_numbers(nan_to_null(text), [*numbers, *promos]), categories)


def vector_size(levels: int) -> int:
    return min(LONGEST_VECTOR, levels // 2 + 1)


def train_embeddings(train: DataFrame, categories: Sequence[str], promos: Sequence[str],
                     numbers: Sequence[str], label: str = spec.QUANTITY, size: int | None = None,
                     **params) -> tuple[Embeddings, Pipeline]:
    """Learn a vector per category and per promotion code.

    All vectors share one length, by default that of the largest category.
    Returns the lookup tables and the fitted pipeline, whose prediction is on
    the log scale. Where the categories and flags have far fewer combinations
    than there are rows, the steps run on sums of each combination, not on rows.
    """
    spark = train.sparkSession
    indexed = [f"{c}_idx" for c in categories]
    hot = [f"{c}_hot" for c in categories]
    encode = Pipeline(stages=[
        string_indexer(categories, "keep"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=False, handleInvalid="keep"),
        VectorAssembler(inputCols=list(numbers), outputCol="numbers_raw"),
        MinMaxScaler(inputCol="numbers_raw", outputCol="numbers_scaled"),
        VectorAssembler(inputCols=[*hot, *promos, "numbers_scaled"], outputCol="embedding_inputs"),
    ]).fit(train)
    labels = [list(found) for found in encode.stages[0].labelsArray]
    k = size or max(vector_size(len(found)) for found in labels)
    logged = train.withColumn("log_label", F.log1p(label))
    machine = FMRegressor(featuresCol="embedding_inputs", labelCol="log_label", factorSize=k, **params)
    schema, scaler = encode.transform(train.limit(0)).schema, encode.stages[3]
    places = [schema[c].metadata["ml_attr"]["num_attrs"] for c in hot]
    inputs = Inputs(categories, places, promos, numbers, scaler.originalMin.toArray().tolist(), scaler.originalMax.toArray().tolist())
    if sums_pay(logged, inputs, machine):
        weights = fit_on_sums(logged, encode.stages[0], inputs, "log_label", machine)
        factors, last = weights.factors, predictor(weights, inputs, encode.stages[0], machine.getPredictionCol())
    else:
        last = machine.fit(encode.transform(logged))
        factors = last.factors.toArray()

    rows = [(column, name, [float(v) for v in factors[at + i]])
            for column, found, at in zip(categories, labels, inputs.starts) for i, name in enumerate(found)]
    promo_rows = [(code, [float(v) for v in factors[inputs.first_flag + i]]) for i, code in enumerate(promos)]
    lookups = Embeddings(
        spark.createDataFrame(rows, "column string, category string, vector array<double>"),
        spark.createDataFrame(promo_rows, "promo string, vector array<double>"))
    encode.stages.append(last)
    return lookups, encode


def predict_quantity(pipeline, df: DataFrame) -> DataFrame:
    """Quantities from the log-scale prediction, never below zero."""
    return pipeline.transform(df).withColumn(
        "prediction", F.greatest(F.lit(0.0), F.expm1("prediction")))


def _spread(vector: Column, prefix: str, size: int) -> list[Column]:
    return [F.coalesce(F.get(vector, F.lit(i)), F.lit(0.0)).alias(f"{prefix}_embed{i}") for i in range(size)]


def with_category_embeddings(df: DataFrame, lookup: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Add ``{column}_embed{i}`` for each column and its vector length; unknown is 0.

    The lookup is written first: by its true size a small one is broadcast,
    where an estimate would shuffle all rows of a category into one task.
    """
    lookup = on_file(lookup, "vectors")
    for column, size in columns.items():
        vectors = lookup.filter(F.col("column") == column).select(
            F.col("category").alias("__category"), F.col("vector").alias("__vector"))
        joined = df.join(vectors, F.col(column).cast("string") == F.col("__category"), "left")
        df = joined.select(*df.columns, *_spread(F.col("__vector"), column, size))
    return df


def promo_weights(lookup: DataFrame) -> dict[str, list[float]]:
    """The promotion vectors as values: there is one per flag column."""
    return {row.promo: list(row.vector) for row in lookup.collect()}


def with_promo_embedding(df: DataFrame, weights: dict[str, Sequence[float]]) -> DataFrame:
    """Add ``promo_embed{i}``: the sum of the vectors of the row's promotions."""
    size = len(next(iter(weights.values())))
    sums = []
    for i in range(size):
        total = F.lit(0.0)
        for code, vector in weights.items():
            total = total + F.coalesce(F.col(code), F.lit(0)) * F.lit(float(vector[i]))
        sums.append(total.alias(f"promo_embed{i}"))
    return df.select("*", *sums)


def vector_lengths(lookup: DataFrame) -> dict[str, int]:
    sizes = lookup.groupBy("column").agg(F.max(F.size("vector")).alias("size"))
    return {row["column"]: row["size"] for row in sizes.collect()}


def embedding_features(df: DataFrame, embeddings: Embeddings, columns: Sequence[str],
                       keys: Sequence[str], promo: bool = True) -> DataFrame:
    """Row key, day, month and all embedding columns."""
    sizes = vector_lengths(embeddings.categories)
    out = with_category_embeddings(df, embeddings.categories, {c: sizes[c] for c in columns})
    if promo:
        out = with_promo_embedding(out, promo_weights(embeddings.promos))
    added = [c for c in out.columns if c not in df.columns]
    return out.select(*dict.fromkeys([*keys, spec.DATE, spec.MONTH]), *added)
