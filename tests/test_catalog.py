"""The contract: names, schemas and a sample of the SQL comparisons."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
from stockline.catalog import QUERIES  # noqa: E402
from stockline.oracle import oracle_queries  # noqa: E402

SAMPLE = [
    "trailing_counts", "ts_agg_cat_lv2_dow", "ts_agg_scoring_day", "consc_cat_lv2_br", "cast_types", "null_audit",
    "clean_province", "month_calendar", "lat_long", "basic_features", "freq_cut_categorical", "cumsum_share",
    "baseline_grouping_sets", "eval_metrics", "oos_metrics", "mape_zero_safe", "fs_missing_months",
    "scoring_day_rows", "fs_second_period", "fs_replace_empty_month", "eps_neighbors", "stratified_split", "core_points", "string_index", "promo_embedding",
    "months_to_write", "csv_strings", "overwritten_table", "csv_report", "category_files", "named_flags", "row_ids", "random_parts",
    "category_index", "label_codes", "planted_boosted", "saved_vectors", "embedding_rows",
]


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(contract.queries()) and set(oracle_queries()) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and len(df.columns) == 46


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, small, name):
    problem, rows = compare.differences(spark, compare.connect(small), small, name)
    assert problem == "" and rows > 0
