"""The averages of all grains in tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockline import spec
from stockline.operators import averages


def test_tasks_that_expand_grains_grow_in_number_with_the_rows(spark, monkeypatch, capsys):
    monkeypatch.setattr(averages, "EXPANDED_ROWS", 20)
    rows = spark.range(200).select(
        (F.col("id") % 3).alias(spec.STORE), (F.col("id") % 5).alias(spec.ITEM), (F.col("id") % 7).alias("DayOfWeek"),
        (F.col("id") % 12).alias("Month"), F.col("id").cast("double").alias(spec.QUANTITY))
    found = averages.all_averages(rows)
    found.explain("simple")
    assert ", 10), REPARTITION_BY_NUM" in capsys.readouterr().out
    got = {r[spec.ITEM]: r.average for r in found.filter("grain = 11").collect()}
    assert got == {r[spec.ITEM]: r.a for r in rows.groupBy(spec.ITEM).agg(F.avg(spec.QUANTITY).alias("a")).collect()}
