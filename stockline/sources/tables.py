"""The sales model expressed on the star-schema test tables.

``lineitem`` is the fact; ``part``, ``supplier``, ``nation``, ``region`` and
``customer`` provide items, stores and places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockline import spec
from stockline.operators.dims import Dimensions, with_category, with_location
from stockline.functions.dates import with_calendar

KEYS = ("OrderKey", "LineNumber", "MaterialCode", "BranchCode")
START, START_DEV, START_OOT, END = "1995-01-02", "1995-07-01", "2001-10-01", "2001-11-04"
SOLD_ABOVE = 25


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item under the column names of the sales fact."""
    line = table(spark, folder, "lineitem")
    price = F.try_divide("l_extendedprice", "l_quantity")
    day = F.col("l_shipdate").cast("date")
    return line.select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_partkey").alias(spec.ITEM),
        F.col("l_suppkey").alias(spec.STORE),
        day.alias(spec.DATE),
        F.last_day(day).alias(spec.MONTH),
        F.col("l_quantity").alias(spec.QUANTITY),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias(spec.NET_SALE),
        F.when(F.col("l_quantity") > SOLD_ABOVE, 1).otherwise(0).alias(spec.SOLD),
        price.alias("avgPrice"),
        (price * (1 - F.col("l_discount"))).alias("avgPriceDis"),
        F.when(F.col("l_returnflag") == "N", F.lit(spec.NO_PROMOTION))
        .otherwise(F.concat(F.lit("RF_"), "l_returnflag", F.lit("|LS_"), "l_linestatus"))
        .alias(spec.PROMOTION))


def with_supply_price(df: DataFrame, folder: str) -> DataFrame:
    price = table(df.sparkSession, folder, "part").select(
        F.col("p_partkey").alias(spec.ITEM), F.col("p_retailprice").alias("supPrice"))
    return df.join(price, spec.ITEM, "left")


def locations(spark: SparkSession, folder: str) -> DataFrame:
    """Place of each store; one province in three carries a trailing blank."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    blank = F.when(F.col("n_nationkey") % 3 == 0, F.lit(" ")).otherwise(F.lit(""))
    return (table(spark, folder, "supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("s_suppkey").alias(spec.STORE), F.col("s_nationkey").alias("ZipCode"),
                    F.concat("n_name", blank).alias("ProvinceEN"), F.col("r_name").alias("DistrictEN")))


def lat_long(spark: SparkSession, folder: str) -> DataFrame:
    """Positions per customer; a fifth of the zip codes is unknown."""
    nation = table(spark, folder, "nation")
    return (table(spark, folder, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("ZipCode"),
                    F.col("n_name").alias("ProvinceEN"),
                    (F.col("c_custkey") % 180).cast("double").alias("latitude"),
                    (F.col("c_custkey") % 360).cast("double").alias("longitude")))


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_brand").alias(spec.CATEGORY_2), F.col("p_partkey").alias(spec.ITEM))


def category_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Four groups for the first twenty brands; that of the others is null."""
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
    return (table(spark, folder, "part").select("p_brand").distinct()
            .select(F.col("p_brand").alias(spec.CATEGORY_2),
                    F.when(number <= 20, F.concat(F.lit("group_"), number % 4)).alias(spec.CATEGORY_1)))


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of the stores; those in debt have nulls."""
    key = F.col("s_suppkey")
    solvent = F.col("s_acctbal") >= 0
    return table(spark, folder, "supplier").select(
        key.alias(spec.STORE),
        F.when(solvent, 1990 + key % 20).cast("int").alias("YearOpened"),
        F.when(solvent, 1 + key % 12).cast("int").alias("MonthOpened"),
        F.when(solvent, F.concat(F.lit("cluster_"), F.col("s_nationkey") % 5)).alias("LocationCluster"),
        F.when(solvent, F.when(F.col("s_acctbal") < 5000, "small").otherwise("large")).alias("StoreType"))


def dimensions(spark: SparkSession, folder: str) -> Dimensions:
    return Dimensions(locations(spark, folder), lat_long(spark, folder), categories(spark, folder),
                      category_groups(spark, folder), stores(spark, folder))


def sales_for(spark: SparkSession, folder: str, columns: tuple[str, ...]) -> DataFrame:
    """The fact with just the joins that the named columns need."""
    df = sales(spark, folder)
    if {"ProvinceEN", "DistrictEN", "ZipCode"} & set(columns):
        df = with_location(df, locations(spark, folder))
    if {spec.CATEGORY_1, spec.CATEGORY_2} & set(columns):
        df = with_category(df, categories(spark, folder), category_groups(spark, folder))
    if "DayOfWeek" in columns or "Month" in columns:
        df = with_calendar(df)
    return df


def points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per sold item: its mean quantity and mean discount, scaled to like spreads."""
    return table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.array(
        F.round(F.avg("l_quantity") / 50, 9), F.round(F.avg("l_discount") * 10, 9)).alias("value"))
