"""Factorisation machines fitted on sums in place of rows.

Among the rows that share their categories and flags, a factorisation machine
is a polynomial in the numbers: a constant, one term per number and one per
pair of numbers. The squared error of such a polynomial and all its gradients
follow from the sums of the products of these terms, with each other and with
the label. So the rows are read once, for the sums of each combination, and
every step of the fit works on the combinations: it gives the steps that
``FMRegressor`` takes over all rows, up to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import FMRegressor
from pyspark.sql import DataFrame, functions as F

from stockline.session import durable

# Fixed value: with more sums than this per combination the rows are the smaller form.
MOST_SUMS = 200


def finite(column: str) -> str:
    """The column as a double; a null or what is no finite number is an error, as it is in the library."""
    value = f"cast(`{column}` as double)"
    return f"if(abs({value}) < double('Infinity'), {value}, cast(raise_error('no finite number in {column}') as double))"


@dataclass(frozen=True)
class Inputs:
    """Inputs of the machine in order: the places of each category, the flags, the numbers scaled to 0..1."""

    categories: Sequence[str]
    places: Sequence[int]
    flags: Sequence[str]
    numbers: Sequence[str]
    low: Sequence[float]
    high: Sequence[float]

    @property
    def first_flag(self) -> int:
        return sum(self.places)

    @property
    def first_number(self) -> int:
        return self.first_flag + len(self.flags)

    @property
    def size(self) -> int:
        return self.first_number + len(self.numbers)

    @cached_property
    def starts(self) -> list[int]:
        return [sum(self.places[:i]) for i in range(len(self.places))]

    @cached_property
    def pairs(self) -> list[tuple[int, int]]:
        return list(combinations(range(len(self.numbers)), 2))

    @cached_property
    def terms(self) -> list[tuple[int, ...]]:
        """The terms of the polynomial, each as the numbers that it multiplies."""
        return [(), *((i,) for i in range(len(self.numbers))), *self.pairs]

    @cached_property
    def products(self) -> list[tuple[int, ...]]:
        return sorted({tuple(sorted(a + b)) for a in self.terms for b in self.terms})

    @cached_property
    def product_of(self) -> np.ndarray:
        """The product of each two terms, by its place in ``products``."""
        place = {p: i for i, p in enumerate(self.products)}
        return np.array([[place[tuple(sorted(a + b))] for b in self.terms] for a in self.terms])

    def scaled(self, i: int) -> str:
        if self.high[i] == self.low[i]:
            return "0.5D"
        return f"(({finite(self.numbers[i])} - ({self.low[i]!r}D)) / ({self.high[i] - self.low[i]!r}D))"


def sums_pay(train: DataFrame, inputs: Inputs, machine: FMRegressor) -> bool:
    """Whether the sums of all combinations are less than the inputs of all rows, and the fit takes all rows at each step."""
    per_group = len(inputs.products) + len(inputs.terms)
    if per_group > MOST_SUMS or machine.getSolver() != "adamW" or machine.getMiniBatchFraction() < 1:
        return False
    keys = [*inputs.categories, *inputs.flags]
    found = train.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*keys)).alias("groups")).first()
    return found.groups * per_group < found.rows * (len(keys) + len(inputs.numbers))


def group_sums(train: DataFrame, indexer: StringIndexerModel, inputs: Inputs, label: str) -> DataFrame:
    """``(places, flags, sums, targets)`` of each combination of categories and flags."""
    names = [f"__number{i}" for i in range(len(inputs.numbers))]
    rows = train.select(*inputs.categories, *[F.expr(finite(c)).alias(c) for c in inputs.flags],
                        *[F.expr(inputs.scaled(i)).alias(n) for i, n in enumerate(names)], F.expr(finite(label)).alias("__label"))

    def product(of: tuple[int, ...], times=None):
        out = times
        for i in of:
            out = F.col(names[i]) if out is None else out * F.col(names[i])
        return F.lit(1.0) if out is None else out

    sums = [F.sum(product(p)).alias(f"__sum{i}") for i, p in enumerate(inputs.products)]
    targets = [F.sum(product(t, F.col("__label"))).alias(f"__target{i}") for i, t in enumerate(inputs.terms)]
    grouped = indexer.transform(rows.groupBy(*inputs.categories, *inputs.flags).agg(*sums, *targets))
    return grouped.select(
        F.array(*[F.col(c).cast("int") + start for c, start in zip(indexer.getOutputCols(), inputs.starts, strict=True)]).alias("places"),
        F.array(*inputs.flags).cast("array<double>").alias("flags"),
        F.array(*[f"__sum{i}" for i in range(len(sums))]).alias("sums"),
        F.array(*[f"__target{i}" for i in range(len(targets))]).alias("targets"))


@dataclass(frozen=True)
class Weights:
    """What a factorisation machine learns, one row of ``factors`` and one of ``linear`` per input."""

    factors: np.ndarray
    linear: np.ndarray
    intercept: float

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([self.factors.ravel(), self.linear, [self.intercept]])

    def like(self, flat: np.ndarray) -> Weights:
        at = self.factors.size
        return Weights(flat[:at].reshape(self.factors.shape), flat[at:-1], float(flat[-1]))


def summed_gradient(groups: DataFrame, w: Weights, inputs: Inputs) -> np.ndarray:
    """Slope of the summed squared error over all combinations; one number per weight comes to the driver.

    The tasks get arrays and need no copy of this library.
    """
    factors, linear, intercept = w.factors, w.linear, w.intercept
    flag, number = slice(inputs.first_flag, inputs.first_number), slice(inputs.first_number, inputs.size)
    pairs, product_of, many = inputs.pairs, inputs.product_of, len(inputs.numbers)

    def gradient(places, flags, sums, targets):
        numbers, squares = factors[number], (factors ** 2).sum(axis=1)
        total = factors[places].sum(axis=1) + flags @ factors[flag]
        own = squares[places].sum(axis=1) + flags ** 2 @ squares[flag]
        terms = np.empty(targets.shape)
        terms[:, 0] = intercept + linear[places].sum(axis=1) + flags @ linear[flag] + ((total ** 2).sum(axis=1) - own) / 2
        terms[:, 1:many + 1] = linear[number] + total @ numbers.T
        for at, (i, j) in enumerate(pairs, many + 1):
            terms[:, at] = numbers[i] @ numbers[j]
        slope = 2 * (np.einsum("gab,gb->ga", sums[:, product_of], terms) - targets)
        constant, single, double = slope[:, 0], slope[:, 1:many + 1], slope[:, many + 1:].sum(axis=0)

        by_factor, by_linear = np.zeros_like(factors), np.zeros_like(linear)
        pull = constant[:, None] * total + single @ numbers
        for at in places.T:
            np.add.at(by_linear, at, constant)
            np.add.at(by_factor, at, pull - constant[:, None] * factors[at])
        by_linear[flag] = constant @ flags
        by_factor[flag] = flags.T @ pull - (constant @ flags ** 2)[:, None] * factors[flag]
        by_linear[number] = single.sum(axis=0)
        by_factor[number] = single.T @ total
        for value, (i, j) in zip(double, pairs, strict=True):
            by_factor[number][i] += value * numbers[j]
            by_factor[number][j] += value * numbers[i]
        return np.concatenate([by_factor.ravel(), by_linear, [constant.sum()]])

    def run(batches):
        found = np.zeros(factors.size + linear.size + 1)
        for batch in batches:
            lists = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("places", "flags", "sums", "targets")]
            if batch.num_rows:
                found += gradient(*[x.reshape(batch.num_rows, x.size // batch.num_rows) for x in lists])
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.float64())], names=["at", "value"])

    out = np.zeros(w.flat.size)
    for row in groups.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[row.at] = row.value
    return out


def fit_on_sums(train: DataFrame, indexer: StringIndexerModel, inputs: Inputs, label: str, machine: FMRegressor) -> Weights:
    """The weights that ``machine`` would learn, by its own settings and from its own start.

    The start is that of the library: one step of no length, over one row.
    """
    one = train.sparkSession.createDataFrame([(Vectors.sparse(inputs.size, {}), 0.0)], ["start", "label"])
    drawn = machine.copy().setFeaturesCol("start").setLabelCol("label").setMaxIter(1).setStepSize(1e-300).setRegParam(0.0).fit(one)
    w = Weights(drawn.factors.toArray(), drawn.linear.toArray(), 0.0)
    learned = np.concatenate([np.ones(w.factors.size), np.full(w.linear.size, float(machine.getFitLinear())),
                              [float(machine.getFitIntercept())]])
    groups = durable(group_sums(train, indexer, inputs, label))
    rows = groups.agg(F.sum(F.get("sums", F.lit(0)))).first()[0]
    mean, spread, flat = np.zeros(w.flat.size), np.zeros(w.flat.size), w.flat
    for step in range(1, machine.getMaxIter() + 1):
        slope = summed_gradient(groups, w, inputs) * learned / rows
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope ** 2
        move = machine.getStepSize() * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.999 ** step)) + 1e-8)
        before, flat = flat, flat - move - machine.getRegParam() * flat
        w = w.like(flat)
        if step > 1 and np.linalg.norm(before - flat) < machine.getTol() * max(np.linalg.norm(flat), 1.0):
            break
    return w


def predictor(w: Weights, inputs: Inputs, indexer: StringIndexerModel, output: str) -> SQLTransformer:
    """The fitted machine as a stage that reads the indexed categories, the flags and the numbers."""
    squares = (w.factors ** 2).sum(axis=1)

    def added(values: np.ndarray, power: int) -> str:
        parts = []
        for column, start, places in zip(indexer.getOutputCols(), inputs.starts, inputs.places, strict=True):
            # As one text, which Spark turns into an array once per plan.
            text = ",".join(repr(float(v)) for v in values[start:start + places])
            parts.append(f"get(cast(split('{text}', ',') as array<double>), cast(`{column}` as int))")
        numbers = [finite(c) for c in inputs.flags] + [inputs.scaled(i) for i in range(len(inputs.numbers))]
        parts += [f"({float(v)!r}D) * {' * '.join([n] * power)}" for v, n in zip(values[inputs.first_flag:], numbers, strict=True)]
        return " + ".join(parts)

    both = " + ".join(f"power({added(column, 1)}, 2)" for column in w.factors.T)
    return SQLTransformer(statement=f"SELECT *, ({w.intercept!r}D) + {added(w.linear, 1)} + ({both} - ({added(squares, 2)})) / 2 AS `{output}` FROM __THIS__")
