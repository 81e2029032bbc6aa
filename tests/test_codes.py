"""Numbers of categories as a table, against the index of the library."""

from __future__ import annotations

import random

from pyspark.ml.feature import StringIndexer

from stockline.operators.frequency import category_codes, with_codes


def test_numbers_are_those_of_the_library(spark):
    draw = random.Random(5)
    names = [f"k{i}" for i in range(300)] + ["ä", "Z", "", "10", "9"]
    rows = spark.createDataFrame([(draw.choice(names[:1 + draw.randrange(len(names))]),) for _ in range(4000)], "k string")
    library = StringIndexer(inputCol="k", outputCol="place", stringOrderType="frequencyDesc").fit(rows)
    found = {r["code"]: r["place"] for r in category_codes(rows, "k").collect()}
    assert found == {name: float(i) for i, name in enumerate(library.labels)}


def test_unknown_values_and_nulls_share_the_last_number(spark):
    known = spark.createDataFrame([(1,), (2,), (2,), (None,)], "item int")
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "item int, place string")
    found = with_codes(rows, category_codes(known, "item"), "item", "number").collect()
    assert sorted((r["place"], r["number"]) for r in found) == [("n", 2.0), ("x", 1.0), ("y", 0.0), ("z", 2.0)]
    empty = with_codes(rows, category_codes(known.limit(0), "item"), "item", "number")
    assert {r["number"] for r in empty.collect()} == {0.0}
