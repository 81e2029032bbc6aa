"""Every operator as a query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockline import spec
from stockline.functions import dates, metrics
from stockline.functions.distance import METRICS, distance
from stockline.operators import (
    averages, clean, density, dims, embedding, frequency, model, promo, recency, trailing)
from stockline.plans import baseline, embed, train
from stockline.plans.score import score_day, scoring_rows
from stockline.session import durable, fresh_folder
from stockline.sources import files, tables
from stockline.sources.store import SAVE_MODES, FeatureStore, FeatureTable, repeated_keys
from stockline.spec import FeaturePlan, RecencySpec, TrailingSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round the floating-point columns, the named ones to their own digits.

    Written as plain arithmetic, which every engine evaluates alike; built-in
    rounding differs between engines on ties.
    """
    def to_digits(name: str):
        scale = 10.0 ** special.get(name, digits)
        return F.floor(F.col(name) * scale + 0.5) / F.lit(scale)

    return df.withColumns({n: to_digits(n) for n, t in df.dtypes if t in ("double", "float")})


TRAILING = {n: TrailingSpec(n, g) for n, g in spec.TRAILING_GROUPS.items()}
RECENCY = {n: RecencySpec(n, g) for n, g in spec.RECENCY_GROUPS.items()}
BRAND = TRAILING["cat_lv2"]
PLACE = TRAILING["cat_lv2_pv"]
RUNS = RECENCY["cat_lv2_br"]


def fact(spark: SparkSession, folder: str, group: TrailingSpec | RecencySpec) -> DataFrame:
    return tables.sales_for(spark, folder, group.group_cols)


# --- trailing statistics ---------------------------------------------------

def stat_digits(group: TrailingSpec) -> dict[str, int]:
    """Deviations add many squares, so they are compared to three digits."""
    return {group.column(m, "stddev", d, a): 3
            for m in group.measures for d in group.horizons for a in (False, True)}


def trailing_rounded(df: DataFrame, group: TrailingSpec) -> DataFrame:
    return rounded(df, 6, **stat_digits(group))


@query("group_day_rollup")
def group_day_rollup(spark, folder):
    daily = trailing.group_days(fact(spark, folder, PLACE), PLACE)
    return daily.withColumns({m: F.col(m).cast("double") for m in PLACE.measures})


def brand_sums(spark, folder):
    return trailing.with_sums(trailing.group_days(fact(spark, folder, BRAND), BRAND), BRAND)


@query("trailing_sum")
def trailing_sum(spark, folder):
    return brand_sums(spark, folder).select(
        *BRAND.group_cols, spec.DATE,
        *[F.col(BRAND.column(m, "sum", d)).cast("double").alias(BRAND.column(m, "sum", d))
          for m in BRAND.measures for d in BRAND.horizons])


@query("trailing_counts")
def trailing_counts(spark, folder):
    return brand_sums(spark, folder).select(
        *BRAND.group_cols, spec.DATE,
        *[f"{kind}_sum_{d}d" for d in BRAND.horizons for kind in ("label", "count")])


def trailing_part(columns: Callable[[TrailingSpec], list[str]], group: TrailingSpec) -> Query:
    def run(spark, folder):
        full = trailing.trailing_features(fact(spark, folder, group), group)
        return trailing_rounded(full.select(*group.group_cols, spec.DATE, *columns(group)), group)
    return run


def stat_columns(stat: str, kinds: tuple[bool, ...]) -> Callable[[TrailingSpec], list[str]]:
    return lambda g: [g.column(m, stat, d, k) for m in g.measures for d in g.horizons for k in kinds]


def ratio_columns(group: TrailingSpec) -> list[str]:
    return [group.ratio_column(m, a, b) for m in group.measures for a, b in group.ratios]


QUERIES["trailing_avg"] = trailing_part(stat_columns("avg", (False, True)), PLACE)
QUERIES["trailing_stddev_inc0"] = trailing_part(stat_columns("stddev", (True,)), PLACE)
QUERIES["trailing_stddev"] = trailing_part(stat_columns("stddev", (False,)), PLACE)
QUERIES["trailing_cv"] = trailing_part(stat_columns("cv", (False, True)), PLACE)
QUERIES["sum_ratio"] = trailing_part(ratio_columns, PLACE)
for _group in TRAILING.values():
    QUERIES[f"ts_agg_{_group.name}"] = trailing_part(TrailingSpec.columns, _group)


@query("ts_agg_mc_rows")
def ts_agg_mc_rows(spark, folder):
    group = TRAILING["mc"]
    return trailing_rounded(
        trailing.trailing_row_features(fact(spark, folder, group), group, tables.KEYS), group)


@query("ts_agg_scoring_day")
def ts_agg_scoring_day(spark, folder):
    """One month of features from just the history that can reach it."""
    return trailing_rounded(trailing.trailing_features(
        fact(spark, folder, BRAND), BRAND, tables.START_OOT, tables.END), BRAND)


# --- recency ---------------------------------------------------------------

@query("group_day_flag")
def group_day_flag(spark, folder):
    return recency.group_day_flags(fact(spark, folder, RUNS), RUNS)


@query("last_sell_date")
def last_sell_date(spark, folder):
    daily = recency.group_day_flags(fact(spark, folder, RUNS), RUNS)
    return recency.with_last_sale(daily, RUNS).select(*daily.columns, "last_sell_date")


@query("zero_consc")
def zero_consc(spark, folder):
    return recency.recency_features(fact(spark, folder, RUNS), RUNS).select(
        *RUNS.group_cols, spec.DATE, RUNS.run_column)


@query("zero_consc_max")
def zero_consc_max(spark, folder):
    return recency.recency_features(fact(spark, folder, RUNS), RUNS).drop(RUNS.run_column)


def recency_query(group: RecencySpec) -> Query:
    return lambda spark, folder: recency.recency_features(fact(spark, folder, group), group)


for _runs in RECENCY.values():
    QUERIES[f"consc_{_runs.name}"] = recency_query(_runs)


@query("consc_mc_ds_rows")
def consc_mc_ds_rows(spark, folder):
    group = RECENCY["mc_ds"]
    return recency.recency_row_features(fact(spark, folder, group), group, tables.KEYS)


# --- cleaning, calendar, filters -------------------------------------------

def with_holes(df: DataFrame) -> DataFrame:
    """The fact with some values taken out, to give the null operators work."""
    line = F.col("LineNumber")
    return df.select(
        "OrderKey", "LineNumber", spec.ITEM, spec.STORE, spec.DATE,
        F.when(line % 3 != 0, F.col(spec.QUANTITY)).alias(spec.QUANTITY),
        F.when(line % 2 != 0, F.col(spec.PROMOTION)).alias(spec.PROMOTION))


@query("project_rename")
def project_rename(spark, folder):
    return (tables.table(spark, folder, "lineitem")
            .select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
            .withColumnsRenamed({"l_partkey": spec.ITEM, "l_suppkey": spec.STORE})
            .drop("l_returnflag").toDF("item", "store", "quantity"))


@query("cast_types")
def cast_types(spark, folder):
    """Text columns with unreadable entries, cast by type."""
    line = tables.table(spark, folder, "lineitem")
    bad = F.col("l_linenumber") == 3
    text = line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(bad, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(bad, "").otherwise(F.col("l_quantity").cast("string")).alias("flag"),
        F.when(bad, "unknown").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("day"))
    numbers = clean.cast_doubles(text, ["quantity", "flag"])
    return clean.cast_dates(clean.cast_ints(numbers, ["flag"]), ["day"])


@query("dropna_all")
def dropna_all(spark, folder):
    holes = with_holes(tables.sales(spark, folder)).select(spec.QUANTITY, spec.PROMOTION)
    return clean.drop_empty_rows(holes)


@query("dropna_any")
def dropna_any(spark, folder):
    return clean.drop_incomplete_rows(with_holes(tables.sales(spark, folder)))


@query("fillna_mixed")
def fillna_mixed(spark, folder):
    holes = with_holes(tables.sales(spark, folder))
    return clean.fill_strings(clean.fill_numbers(holes, [spec.QUANTITY]), [spec.PROMOTION])


@query("nan_to_null")
def nan_to_null(spark, folder):
    broken = F.when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return clean.nan_to_null(tables.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", broken.alias("quantity")))


@query("null_audit")
def null_audit(spark, folder):
    return clean.null_counts(with_holes(tables.sales(spark, folder)))


@query("clean_province")
def clean_province(spark, folder):
    return clean.trim_last_blank(tables.locations(spark, folder), "ProvinceEN")


@query("sold_label")
def sold_label(spark, folder):
    holes = with_holes(tables.sales(spark, folder))
    return clean.with_sold_flag(holes, above=tables.SOLD_ABOVE).select(*tables.KEYS, spec.DATE, spec.SOLD)


@query("month_end")
def month_end(spark, folder):
    days = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE)
    return dates.with_month_end(days)


@query("time_split")
def time_split(spark, folder):
    train, test = clean.split_by_day(tables.sales(spark, folder).select(*tables.KEYS, spec.DATE), tables.START_OOT)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("oot_split")
def oot_split(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.MONTH)
    dev, oot = clean.split_by_month(rows, tables.START_DEV, tables.START_OOT, tables.END)
    return dev.withColumn("part", F.lit("dev")).unionByName(oot.withColumn("part", F.lit("oot")))


@query("pruned_range")
def pruned_range(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.MONTH, spec.QUANTITY)
    return clean.in_period(rows, "1998-03-10", "1999-02-20")


@query("extract_date")
def extract_date(spark, folder):
    return dates.with_calendar(tables.sales(spark, folder).select(*tables.KEYS, spec.DATE))


@query("month_shift")
def month_shift(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return tables.table(spark, folder, "orders").select(
        "o_orderkey", day.alias("day"),
        dates.month_shifted(day, 3).alias("three_months_on"),
        dates.month_shifted(day, -14).alias("fourteen_months_back"),
        F.date_add(day, -7).alias("week_before"))


@query("month_calendar")
def month_calendar(spark, folder):
    bounds = tables.sales(spark, folder).agg(F.min(spec.DATE).alias("first"), F.max(spec.DATE).alias("last"))
    return dates.month_calendar(bounds, "first", "last")


# --- dimensions and promotions ---------------------------------------------

@query("location_join")
def location_join(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE)
    return dims.with_location(rows, tables.locations(spark, folder))


@query("lat_long")
def lat_long(spark, folder):
    return rounded(dims.lat_long_feature(
        tables.sales(spark, folder), tables.locations(spark, folder), tables.lat_long(spark, folder), tables.KEYS))


@query("category_join")
def category_join(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE)
    return dims.with_category(rows, tables.categories(spark, folder), tables.category_groups(spark, folder))


@query("store_cluster")
def store_cluster(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE)
    return dims.with_store_cluster(rows, tables.stores(spark, folder))


@query("discount_feature")
def discount_feature(spark, folder):
    rows = tables.with_supply_price(tables.sales(spark, folder), folder)
    return rounded(dims.with_price_features(rows).select(
        *tables.KEYS, spec.DATE, "revenue", "discount", "percentage_discount"))


@query("promo_codes")
def promo_codes(spark, folder):
    return promo.promo_codes(tables.sales(spark, folder))


@query("promo_onehot")
def promo_onehot(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.PROMOTION)
    return promo.one_hot_promotion(rows, cutoff=1)


FLAGS = ["RF_A", "RF_R", "LS_F", "LS_O"]


@query("freq_cut_onehot")
def freq_cut_onehot(spark, folder):
    flags = promo.with_promo_flags(tables.sales(spark, folder), FLAGS)
    return rounded(frequency.frequency_cut(frequency.flag_counts(flags, FLAGS), 0.8))


@query("freq_cut_categorical")
def freq_cut_categorical(spark, folder):
    return rounded(frequency.frequent_categories(tables.sales(spark, folder), spec.PROMO_CUTOFF, spec.ITEM), 9)


@query("cumsum_share")
def cumsum_share(spark, folder):
    counts = frequency.category_counts(tables.sales(spark, folder), spec.ITEM)
    return frequency.tied_cumulative_sum(counts, "n")


@query("sort_desc")
def sort_desc(spark, folder):
    return frequency.sort_by_count(frequency.category_counts(tables.sales(spark, folder), spec.STORE))


@query("basic_features")
def basic_features(spark, folder):
    """The bundle; a code that is not frequent in the data has a flag of zero."""
    rows = tables.with_supply_price(tables.sales(spark, folder), folder)
    full = dims.basic_features(rows, tables.dimensions(spark, folder), 0.8)
    rare = {c: F.lit(0) for c in FLAGS if c not in full.columns}
    return rounded(full.withColumns({spec.NET_SALE: F.col(spec.NET_SALE).cast("double")} | rare))


# --- averages and metrics --------------------------------------------------

def history_and_test(spark, folder):
    rows = dates.with_calendar(tables.sales(spark, folder).select(
        *tables.KEYS, spec.DATE, spec.QUANTITY, spec.SOLD))
    return clean.split_by_day(rows, tables.START_OOT)


def average_query(name: str) -> Query:
    def run(spark, folder):
        train, _ = history_and_test(spark, folder)
        return rounded(averages.historical_average(train, name))
    return run


for _key, _name in {
    "avg_store_item": "prediction_avg",
    "avg_store_item_dow": "prediction_avg_dow",
    "avg_store_item_month": "prediction_avg_month",
    "avg_item": "prediction_avg_all_store",
    "avg_item_dow": "prediction_avg_dow_all_store",
    "avg_item_month": "prediction_avg_month_all_store",
}.items():
    QUERIES[_key] = average_query(_name)


@query("baseline_grouping_sets")
def baseline_grouping_sets(spark, folder):
    train, _ = history_and_test(spark, folder)
    return rounded(averages.all_averages(train))


@query("baseline_item_avg")
def baseline_item_avg(spark, folder):
    train, test = history_and_test(spark, folder)
    rows = test.select(*tables.KEYS, spec.DATE, "DayOfWeek", spec.QUANTITY)
    return rounded(averages.with_average(rows, train, averages.ITEM_AVERAGE))


@query("baseline_dow_avg")
def baseline_dow_avg(spark, folder):
    train, test = history_and_test(spark, folder)
    rows = test.select(*tables.KEYS, spec.DATE, "DayOfWeek", spec.QUANTITY)
    return rounded(averages.with_average(rows, train, averages.ITEM_DAY_AVERAGE))


def predicted(spark, folder, value: str) -> DataFrame:
    train, test = history_and_test(spark, folder)
    return averages.predict_by_average(test, train, value)


@query("eval_metrics")
def eval_metrics(spark, folder):
    return rounded(metrics.evaluate(predicted(spark, folder, spec.QUANTITY)))


@query("oos_metrics")
def oos_metrics(spark, folder):
    wanted = {
        "percent_oos": metrics.percent_oos,
        "percent_oos_sold": lambda y, p: metrics.percent_oos(y, p, sold_only=True),
        "percent_oos_sale": metrics.percent_oos_sale,
        "percent_sales_oos": metrics.percent_sales_oos,
    }
    rows = predicted(spark, folder, spec.SOLD)
    return rounded(metrics.evaluate(rows, spec.SOLD, measures=wanted))


@query("mape_zero_safe")
def mape_zero_safe(spark, folder):
    rows = predicted(spark, folder, spec.SOLD)
    return rounded(metrics.evaluate(rows, spec.SOLD, measures={"mape_zero_safe": metrics.mape_zero_safe}))


@query("smape")
def smape(spark, folder):
    rows = predicted(spark, folder, spec.SOLD)
    return rounded(metrics.evaluate(rows, spec.SOLD, measures={"smape": metrics.smape}))


# --- feature store, scoring rows, sampling ---------------------------------

def brand_days(spark, folder) -> DataFrame:
    daily = trailing.group_days(fact(spark, folder, BRAND), BRAND)
    return dates.with_month_end(daily.select(spec.CATEGORY_2, spec.DATE, spec.QUANTITY))


def scratch_store(spark) -> FeatureStore:
    return FeatureStore(spark, fresh_folder(spark, "store"))


@query("fs_roundtrip")
def fs_roundtrip(spark, folder):
    store = scratch_store(spark)
    store.save_feature(brand_days(spark, folder), lambda df: df, "brand_days", "1996-02-10", "2000-06-20")
    return store.read("brand_days")


@query("fs_replace_month")
def fs_replace_month(spark, folder):
    store = scratch_store(spark)
    daily = brand_days(spark, folder)
    store.save_feature(daily, lambda df: df, "brand_days", tables.START, tables.END)
    month = daily.filter(F.col(spec.MONTH) == "1998-05-31")
    store.replace_months(month.withColumn(spec.QUANTITY, -F.col(spec.QUANTITY)), "brand_days")
    return store.read("brand_days")


@query("fs_second_period")
def fs_second_period(spark, folder):
    """A quarter is stored, then half a year is asked for without overwriting."""
    store = scratch_store(spark)
    daily = brand_days(spark, folder)
    for end in ("1997-03-31", "1997-06-30"):
        store.save_feature(daily, lambda df: df, "brand_days", "1997-01-01", end, overwrite=False)
    return store.read("brand_days")


@query("fs_replace_empty_month")
def fs_replace_empty_month(spark, folder):
    """A stored month whose rows have all gone is empty after it is replaced."""
    store = scratch_store(spark)
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.MONTH, spec.QUANTITY)
    period = ("1997-01-01", "1997-06-30")
    store.combine(rows, [], *period, months_per_commit=6)
    gone = rows.filter(F.col(spec.MONTH) != "1997-02-28")
    return store.combine(gone, [], *period, save_mode="overwrite", months_per_commit=6)


@query("fs_missing_months")
def fs_missing_months(spark, folder):
    store = scratch_store(spark)
    gaps = F.month(spec.DATE).isin(2, 7) & (F.year(spec.DATE) > 1996)
    store.save_feature(brand_days(spark, folder), lambda df: df.filter(~gaps), "brand_days",
                       tables.START, tables.END)
    return store.missing_months("brand_days", tables.START, tables.END)


@query("months_to_write")
def months_to_write(spark, folder):
    """What a run has to write in each save mode where May and later July of 1997 are missing, and where there is no table."""
    store, period = scratch_store(spark), ("1997-01-01", "1997-08-31")
    store.save_feature(brand_days(spark, folder), lambda df: df.filter(~F.month(spec.DATE).isin(5, 7)), "brand_days", *period)
    found = [(name, mode, month) for name in ("brand_days", "absent") for mode in SAVE_MODES
             for month in store.months_to_write(name, *period, mode)]
    return spark.createDataFrame(found, f"name string, mode string, {spec.MONTH} date")


@query("combine_features")
def combine_features(spark, folder):
    """The fact with the position of its store and two group-day feature tables, stored by month."""
    store = scratch_store(spark)
    period = (tables.START, tables.END)
    places = dims.store_dimension(tables.locations(spark, folder), tables.lat_long(spark, folder))
    sold = tables.sales_for(spark, folder, (spec.CATEGORY_2,)).join(places, spec.STORE, "left").select(
        *tables.KEYS, spec.CATEGORY_2, spec.DATE, spec.MONTH, spec.QUANTITY, spec.NET_SALE, spec.SOLD,
        "latitude", "longitude")
    store.save_feature(sold, lambda df: df, "basic_ft", *period)
    rows = store.read("basic_ft")
    store.save_feature(rows, trailing.trailing_features, "ts_agg_ft", *period, spec=BRAND)
    store.save_feature(rows, recency.recency_features, "consc_ft", *period, spec=RUNS)
    fact_rows = rows.drop(spec.NET_SALE, spec.SOLD)
    wide = store.combine(
        fact_rows,
        [FeatureTable("ts_agg_ft", BRAND.group_cols, unique=True),
         FeatureTable("consc_ft", RUNS.group_cols, unique=True)],
        *period, save_mode="overwrite", months_per_commit=100)
    return trailing_rounded(wide, BRAND)


FULL_PLAN = FeaturePlan(keys=tables.KEYS, promo_numbers=tuple(FLAGS))


@query("full_features")
def full_features(spark, folder):
    """Every input of the models: basic columns, ten trailing and four recency groups, stored and assembled."""
    store, period = scratch_store(spark), (tables.START, tables.END)
    rows = tables.with_supply_price(tables.sales(spark, folder), folder)
    base = train.save_basic(rows, tables.dimensions(spark, folder), store, *period, promo_cutoff=1, overwrite=True)
    saved = train.save_features(base, store, FULL_PLAN, *period, overwrite=True)
    wide = store.combine(base, saved, *period, save_mode="overwrite", months_per_commit=100)
    digits = {c: d for group in FULL_PLAN.trailing for c, d in stat_digits(group).items()}
    return rounded(wide.select(*tables.KEYS, spec.DATE, spec.MONTH, spec.QUANTITY, *FULL_PLAN.categories,
                               *FULL_PLAN.numbers()), 6, **digits)


@query("key_uniqueness")
def key_uniqueness(spark, folder):
    return repeated_keys(tables.sales(spark, folder), ["OrderKey", "LineNumber"])


@query("scoring_day_rows")
def scoring_day_rows(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.QUANTITY)
    return scoring_rows(rows, "2001-10-27")


@query("csv_scan")
def csv_scan(spark, folder):
    """Sales written as text and read back under an explicit schema."""
    path = f"{fresh_folder(spark, 'csv')}"
    tables.sales(spark, folder).select(
        spec.STORE, spec.ITEM, spec.DATE, spec.QUANTITY, spec.PROMOTION
    ).write.option("header", True).csv(path)
    return files.read_csv(spark, path, files.SALES_SCHEMA)


@query("csv_quarantine")
def csv_quarantine(spark, folder):
    """Sales written as text with faults in them, read back as good rows and quarantined lines.

    Second lines have a wrong day, third ones a value too many, fourth ones a
    wrong day and mark, and fifth ones are in files with another header.
    """
    path = fresh_folder(spark, "faulty")
    line = F.concat_ws(
        ",", "OrderKey", "LineNumber", spec.STORE, spec.ITEM,
        F.when(F.col("LineNumber").isin(2, 4), "soon").otherwise(F.col(spec.DATE).cast("string")),
        F.when(F.col("LineNumber") == 4, "x").otherwise(F.col(spec.SOLD).cast("string")),
        F.when(F.col("LineNumber") == 3, "more"))
    sales = tables.sales(spark, folder)
    names = ["OrderKey", "LineNumber", spec.STORE, spec.ITEM, spec.DATE, spec.SOLD]
    for part, header in (("LineNumber <> 5", names), ("LineNumber = 5", names[::-1])):
        # One column, set apart by tabs, so that the commas within it stay as they are.
        (sales.filter(part).select(line.alias(",".join(header)))
         .write.mode("append").option("header", True).option("sep", "\t").csv(path))
    good, bad = files.read_checked(
        spark, path, "OrderKey long, LineNumber int, BranchCode string, MaterialCode string, Date date, label int")
    # The unknown header is quarantined too, once per written file.
    bad = bad.filter(F.col("line") != ",".join(names[::-1])).drop("file")
    return good.unionByName(bad, allowMissingColumns=True)


@query("csv_strings")
def csv_strings(spark, folder):
    """Sales written as text and read back without a schema: every column is a string."""
    path = fresh_folder(spark, "csv")
    tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.SOLD, spec.PROMOTION).write.option("header", True).csv(path)
    return files.read_csv(spark, path)


@query("overwritten_table")
def overwritten_table(spark, folder):
    """A table replaced by one of other columns and partitions, beside the rows that both writes reported."""
    path, rows = f"{fresh_folder(spark, 'table')}/sales", tables.sales(spark, folder)
    first = files.overwrite_table(rows.select(*tables.KEYS), path)
    second = files.overwrite_table(rows.filter(F.col(spec.SOLD) == 1).select(
        "OrderKey", "LineNumber", spec.QUANTITY, spec.MONTH), path, partition_by=spec.MONTH)
    return files.read_table(spark, path).select(
        "*", F.lit(first).cast("long").alias("first_rows"), F.lit(second).cast("long").alias("second_rows"))


@query("csv_report")
def csv_report(spark, folder):
    """A small result exported as one file of a given name and read back."""
    path = files.export_csv(frequency.category_counts(tables.sales(spark, folder), spec.PROMOTION), fresh_folder(spark, "report"), "promotions")
    return files.read_csv(spark, path, "code string, n long")


@query("category_files")
def category_files(spark, folder):
    """Item to category to group, from two files with the names that such files have."""
    root = fresh_folder(spark, "categories")
    back = {ours: theirs for theirs, ours in files.CATEGORY_NAMES.items()}
    tables.categories(spark, folder).withColumnsRenamed(back).write.option("header", True).csv(f"{root}/items")
    tables.category_groups(spark, folder).write.option("header", True).csv(f"{root}/groups")
    groups = files.read_category_groups(spark, f"{root}/groups", spec.CATEGORY_2, spec.CATEGORY_1)
    return files.read_categories(spark, f"{root}/items").join(groups, spec.CATEGORY_2, "left").select(
        spec.ITEM, spec.CATEGORY_2, spec.CATEGORY_1)


@query("named_flags")
def named_flags(spark, folder):
    """The flags of the frequent promotions, found by the shape of their names."""
    flagged = promo.with_promo_flags(tables.sales(spark, folder), FLAGS)
    return flagged.select(*tables.KEYS, spec.DATE, *sorted(embed.promo_columns(flagged, 1.0, "^LS_[A-Z]$")))


@query("row_ids")
def row_ids(spark, folder):
    """Rows, and how many different numbers they got."""
    return clean.with_row_ids(tables.sales(spark, folder)).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("idx").alias("numbers"))


@query("random_parts")
def random_parts(spark, folder):
    """A random split has every row once, and about nine tenths of them in the first part."""
    rows = durable(tables.sales(spark, folder).select(*tables.KEYS, spec.DATE))
    first, second = (durable(part) for part in clean.random_split(rows))
    near = abs(first.count() / max(rows.count(), 1) - 0.9) < 0.03
    return first.unionByName(second).withColumn("near", F.lit(near))


@query("anti_remainder")
def anti_remainder(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.SOLD)
    sample = rows.filter(F.col(spec.SOLD) == 1)
    return clean.remainder(rows, sample, [*tables.KEYS, spec.DATE])


@query("stratified_split")
def stratified_split(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.SOLD)
    drawn, rest = clean.stratified_split(rows, 0.3, spec.SOLD, [*tables.KEYS, spec.DATE])
    return (drawn.withColumn("part", F.lit("sample")).unionByName(rest.withColumn("part", F.lit("rest"))))


# --- density clustering ----------------------------------------------------

EPS, MIN_PTS = 0.01, 5


def hood(spark, folder) -> density.Neighbourhood:
    return density.neighbourhood(tables.points(spark, folder), EPS, MIN_PTS, dim=2)


@query("pairwise_distance")
def pairwise_distance(spark, folder):
    """Each vector and the one with the next id, under every metric."""
    vectors = tables.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    following = vectors.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("following"))
    return vectors.join(following, "id").select("id", *[
        distance(F.col("embedding"), F.col("following"), m).alias(m.replace("-", "_")) for m in METRICS])


@query("eps_neighbors")
def eps_neighbors(spark, folder):
    """The neighbours of all points that are not core points."""
    return density.loose_neighbours(tables.points(spark, folder), EPS, MIN_PTS, dim=2)


@query("core_points")
def core_points(spark, folder):
    return density.core_points(hood(spark, folder))


@query("dbscan_clusters")
def dbscan_clusters(spark, folder):
    return density.clusters(hood(spark, folder))


@query("dbscan_noise")
def dbscan_noise(spark, folder):
    found = hood(spark, folder)
    return density.noise(found, density.clusters(found))


# --- models ----------------------------------------------------------------

FIRST_HALF = "1995-07-01"


@query("string_index")
def string_index(spark, folder):
    rows = tables.sales_for(spark, folder, (spec.CATEGORY_2,)).select(*tables.KEYS, spec.DATE, spec.CATEGORY_2)
    return model.string_indexer([spec.CATEGORY_2]).fit(rows).transform(rows)


@query("category_index")
def category_index(spark, folder):
    """Items numbered by how often they sold in the first half year; those sold later only share the last number."""
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE)
    before, _ = clean.split_by_day(rows, FIRST_HALF)
    return frequency.with_codes(rows, frequency.category_codes(before, spec.ITEM), spec.ITEM, "item_idx")


@query("label_codes")
def label_codes(spark, folder):
    """The numbers of all labels of three categorical columns."""
    rows = tables.sales_for(spark, folder, (spec.CATEGORY_2, "DistrictEN", "DayOfWeek"))
    codes = [frequency.category_codes(rows, c).select(F.lit(c).alias("column"), "code", "place")
             for c in (spec.CATEGORY_2, "DistrictEN", "DayOfWeek")]
    return codes[0].unionByName(codes[1]).unionByName(codes[2])


def trained(spark, folder, plan: FeaturePlan, rows: DataFrame | None = None, **params) -> train.Trained:
    """The training job on the test tables: stored features, a fitted forest, its predictions."""
    rows = tables.with_supply_price(tables.sales(spark, folder) if rows is None else rows, folder)
    periods = train.Periods(tables.START, tables.START_DEV, tables.START_OOT, tables.END)
    return train.train(rows, tables.dimensions(spark, folder), scratch_store(spark), fresh_folder(spark, "model"),
                       plan, periods, promo_cutoff=1, months_per_commit=100, seed=7, **params)


@query("rf_forecast")
def rf_forecast(spark, folder):
    """The job with all inputs. A forest averages known quantities, so it cannot leave their range."""
    low, high = tables.sales(spark, folder).filter(F.col(spec.DATE) < tables.START_OOT).agg(
        F.min(spec.QUANTITY), F.max(spec.QUANTITY)).first()
    inside = F.coalesce(F.col("prediction").between(low, high), F.lit(False))
    return trained(spark, folder, FULL_PLAN, numTrees=10, maxDepth=5).predictions.select(
        *tables.KEYS, spec.DATE, spec.QUANTITY, inside.alias("inside"))


@query("feature_importance")
def feature_importance(spark, folder):
    """What must hold for the importance table: it adds up to one, falls, and its running sum rises to it."""
    table = trained(spark, folder, FULL_PLAN, numTrees=10, maxDepth=5).importance
    ranked = table.agg(F.sum("importance").alias("total"), F.min("importance").alias("least"),
                       F.max("cumsum").alias("reached"), F.count(F.lit(1)).alias("n"),
                       F.count_distinct("feature_name").alias("names"),
                       F.sort_array(F.collect_list(F.struct("cumsum", (-F.col("importance")).alias("fall")))).alias("steps"))
    falling = F.forall(F.sequence(F.lit(1), F.size("steps") - 1),
                       lambda i: F.get("steps", i - 1)["fall"] <= F.get("steps", i)["fall"])
    return ranked.select((F.abs(F.col("total") - 1) < 1e-9).alias("adds_up"), (F.col("least") > 0).alias("positive"),
                         (F.abs(F.col("reached") - 1) < 1e-9).alias("reaches_one"),
                         (F.col("n") == F.col("names")).alias("names_differ"), falling.alias("falls"))


@query("gbt_forecast")
def gbt_forecast(spark, folder):
    """Which rows get a prediction: those with known promotions; identifiers are hashed, so new ones count too."""
    rows = dates.with_calendar(tables.sales(spark, folder)).withColumns({
        c: F.col(c).cast("string") for c in (spec.ITEM, spec.STORE)})
    predicted, _ = baseline.boosted_baseline(
        rows, fresh_folder(spark, "gbt"), tables.START_OOT, maxIter=5, maxDepth=4, seed=7)
    return predicted.select(*tables.KEYS, spec.DATE, spec.QUANTITY, F.col("prediction").isNotNull().alias("predicted"))


@query("score_two_days")
def score_two_days(spark, folder):
    """Three days in two months scored on one store; every call returns its own day only."""
    plan = FeaturePlan(keys=tables.KEYS, promo_numbers=tuple(FLAGS), trailing=(BRAND,), recency=(RUNS,))
    fitted = trained(spark, folder, plan, numTrees=3, maxDepth=3)
    rows = tables.with_supply_price(tables.sales(spark, folder), folder)
    store, out = scratch_store(spark), None
    for call, day in enumerate(("2001-10-20", "2001-10-27", "2001-11-01"), 1):
        scored = score_day(rows, tables.dimensions(spark, folder), store, fitted.model_path, day, plan)
        part = durable(scored.select(F.lit(call).alias("call"), *tables.KEYS, spec.DATE,
                                     F.col("prediction").isNotNull().alias("predicted")))
        out = part if out is None else out.unionByName(part)
    return out


def planted(spark, folder) -> DataFrame:
    """Sales whose quantity follows from the promotion alone: 40 under RF_A, otherwise 10."""
    rows = tables.sales(spark, folder)
    quantity = F.when(F.array_contains(F.split(spec.PROMOTION, r"\|"), "RF_A"), 40).otherwise(10)
    return rows.withColumn(spec.QUANTITY, quantity.cast(rows.schema[spec.QUANTITY].dataType))


@query("planted_forecast")
def planted_forecast(spark, folder):
    """The whole job where the quantity follows from one flag: values forecast, values scored, and the importance table.

    Every tree that may look at all inputs splits on that flag alone, so each
    value is exact; a flag lost or shifted anywhere on the way changes them.
    """
    rows = planted(spark, folder)
    fitted = trained(spark, folder, FULL_PLAN, rows, numTrees=10, maxDepth=5, featureSubsetStrategy="all")
    value = (*tables.KEYS, spec.DATE, "prediction")
    forecast = fitted.predictions.select(F.lit("forecast").alias("part"), *value)
    scored = durable(score_day(tables.with_supply_price(rows, folder), tables.dimensions(spark, folder), scratch_store(spark),
                               fitted.model_path, "2001-10-27", FULL_PLAN).select(F.lit("score").alias("part"), *value))
    importance = fitted.importance.withColumn("part", F.lit("importance"))
    return rounded(forecast.unionByName(scored).unionByName(importance, allowMissingColumns=True))


@query("planted_boosted")
def planted_boosted(spark, folder):
    """Values of the boosted pipeline, saved and loaded again, where the quantity follows from the promotion."""
    rows = dates.with_calendar(planted(spark, folder)).withColumns({c: F.col(c).cast("string") for c in (spec.ITEM, spec.STORE)})
    predicted, _ = baseline.boosted_baseline(rows, fresh_folder(spark, "gbt"), tables.START_OOT, maxIter=5, maxDepth=4, seed=7)
    return rounded(predicted.select(*tables.KEYS, spec.DATE, "prediction"))


# --- embeddings ------------------------------------------------------------

PROMO_WEIGHTS = {"RF_A": [0.5, -1.25], "RF_R": [1.5, 0.25], "LS_F": [-0.75, 2.0]}


def made_vectors(spark, folder) -> DataFrame:
    """Vectors of the brands and of the weekdays, derived from the tables."""
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("double")
    brands = tables.table(spark, folder, "part").select("p_brand").distinct().select(
        F.lit(spec.CATEGORY_2).alias("column"), F.col("p_brand").alias("category"),
        F.array(number / 2, -number / 4, F.lit(1.0)).alias("vector"))
    day = F.dayofweek(F.col("l_shipdate").cast("date"))
    days = (tables.table(spark, folder, "lineitem").select(day.alias("d")).distinct()
            .select(F.lit("DayOfWeek").alias("column"), F.col("d").cast("string").alias("category"),
                    F.array(F.col("d") * 1.5, F.col("d") * -0.5).alias("vector")))
    return brands.unionByName(days)


@query("saved_vectors")
def saved_vectors(spark, folder):
    """Vectors of categories and promotions, stored as tables and loaded again, one row a number."""
    path = fresh_folder(spark, "vectors")
    promos = spark.createDataFrame(list(PROMO_WEIGHTS.items()), "promo string, vector array<double>")
    embedding.Embeddings(made_vectors(spark, folder), promos).save(path)
    loaded = embedding.load_embeddings(spark, path)
    both = loaded.categories.unionByName(loaded.promos.select(F.lit("promo").alias("column"), F.col("promo").alias("category"), "vector"))
    return both.select("column", "category", F.posexplode("vector").alias("place", "value"))


@query("embedding_rows")
def embedding_rows(spark, folder):
    """Inputs of the vectors: categories as text, unknown ones named, numbers that are none turned into zero."""
    rows = promo.with_promo_flags(tables.sales_for(spark, folder, ("DayOfWeek",)), FLAGS)
    line = F.col("LineNumber")
    holes = rows.withColumn("avgPrice", F.when(line % 3 == 0, float("nan")).when(line % 3 == 1, F.col("avgPrice"))).withColumn(
        "DayOfWeek", F.when(line % 2 != 0, F.col("DayOfWeek")))
    ready = embedding.clean_for_embedding(holes, ["DayOfWeek"], ["avgPrice"], FLAGS)
    return rounded(ready.select(*tables.KEYS, spec.DATE, "DayOfWeek", "avgPrice", *FLAGS))


@query("embedding_lookup")
def embedding_lookup(spark, folder):
    rows = tables.sales_for(spark, folder, (spec.CATEGORY_2, "DayOfWeek")).select(
        *tables.KEYS, spec.DATE, spec.CATEGORY_2, "DayOfWeek")
    return embedding.with_category_embeddings(
        rows, made_vectors(spark, folder), {spec.CATEGORY_2: 3, "DayOfWeek": 2})


@query("promo_embedding")
def promo_embedding(spark, folder):
    rows = tables.sales(spark, folder).select(*tables.KEYS, spec.DATE, spec.PROMOTION)
    flagged = promo.with_promo_flags(rows, list(PROMO_WEIGHTS))
    return embedding.with_promo_embedding(flagged, PROMO_WEIGHTS)


@query("embedding_vectors")
def embedding_vectors(spark, folder):
    """The categories that get a learned vector, its length, and whether all of it is finite."""
    rows = tables.sales_for(spark, folder, (spec.CATEGORY_2, "DistrictEN", "DayOfWeek"))
    flagged = promo.with_promo_flags(rows, FLAGS)
    categories, numbers = [spec.CATEGORY_2, "DistrictEN", "DayOfWeek"], ["Month", "avgPriceDis", "avgPrice"]
    clean_rows = durable(embedding.clean_for_embedding(flagged, categories, numbers, FLAGS).select(
        *categories, *numbers, *FLAGS, spec.QUANTITY))
    vectors, _ = embedding.train_embeddings(clean_rows, categories, FLAGS, numbers, size=4, maxIter=20, stepSize=0.1, seed=7)
    finite = F.forall("vector", lambda x: F.abs(x) < float("inf"))
    return vectors.categories.select("column", "category", F.size("vector").alias("size"), finite.alias("finite"))
