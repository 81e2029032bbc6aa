"""Learning category vectors from the assembled features."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from stockline import spec
from stockline.functions import metrics
from stockline.operators import clean, embedding
from stockline.operators.frequency import percentile_cutoff
from stockline.session import durable


def promo_columns(df: DataFrame, cutoff: float = spec.PROMO_CUTOFF,
                  pattern: str = spec.PROMO_CODE_PATTERN) -> list[str]:
    """Frequent promotion flags, found by the shape of their names."""
    flags = [c for c in df.columns if re.match(pattern, c)]
    return percentile_cutoff(df, cutoff, flags) if len(flags) > 1 else flags


def train_and_save(wide: DataFrame, folder: str, categories: Sequence[str] = tuple(spec.EMBEDDED_CATEGORIES),
                   numbers: Sequence[str] = tuple(spec.EMBEDDING_NUMBERS), promos: Sequence[str] | None = None,
                   dev=spec.START_DEV, oot=spec.START_OOT, end=spec.END, label: str = spec.QUANTITY,
                   seed: int = 2021, **params) -> tuple[DataFrame, DataFrame]:
    """Store the vectors; return the validation and the out-of-time error.

    One in ten development rows is held out for validation.
    """
    flags = list(promos) if promos is not None else promo_columns(wide)
    rows = durable(embedding.clean_for_embedding(wide, categories, numbers, flags))
    before, test = clean.split_by_day(clean.in_period(rows, dev, end), oot)
    fit, held_out = clean.random_split(before, seed=seed)
    vectors, pipeline = embedding.train_embeddings(fit, categories, flags, numbers, label, seed=seed, **params)
    vectors.save(folder)
    error = {"rmsle": metrics.rmsle}
    return tuple(metrics.evaluate(embedding.predict_quantity(pipeline, part), label, measures=error)
                 for part in (held_out, test))
