"""Readers with explicit schemas, and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from stockline.session import on_file

# Schemas of the input files.
SALES_SCHEMA = (
    "BranchCode string, MaterialCode string, Date date, avgPriceDis double, avgPrice double, "
    "supPrice double, label int, TotalNetSale double, TotalQtySale double, types string, "
    "Branch string, Name string")
LOCATION_SCHEMA = "BranchCode string, ZipCode int, ProvinceEN string, DistrictEN string"
LAT_LONG_SCHEMA = "ZipCode int, ProvinceEN string, latitude double, longitude double"
STORE_SCHEMA = (
    "BranchCode string, LocationCluster string, StoreType string, YearOpened int, MonthOpened int")
CATEGORY_NAMES = {"Class Name": "product_cat_lv2", "Product ID": "MaterialCode"}
#: Holds a record that does not fit its schema.
BROKEN = "__broken"


def read_csv(spark: SparkSession, path: str, schema: str | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header. Without a schema every column is a string.

    ``infer`` costs a pass over the whole file, so a schema is preferable. A
    schema is matched to the header by name: columns may come in any order,
    with further ones among them, but in the same way in all files of a
    folder. A file with another header fails the read.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", infer).csv(path)
    wanted = spark.createDataFrame([], schema).schema
    types = {f.name.lower(): f for f in wanted}
    header = reader.csv(path).columns
    ddl = ", ".join(
        f"`{c}` {types[c.lower()].dataType.simpleString() if c.lower() in types else 'string'}"
        for c in header)
    present = [f.name for f in wanted if f.name.lower() in {c.lower() for c in header}]
    return reader.option("enforceSchema", False).schema(ddl).csv(path).select(*present)


def read_checked(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """CSV whose faulty records are set apart: ``(good, bad)``.

    ``good`` has the columns of ``schema``, ``bad`` has file, line and reason:
    ``header`` for all lines of a file that never names the columns of the
    schema in their order (letter case and quotes aside), ``fields`` for a
    wrong number of values, otherwise the names of the columns whose values
    are not of their type, or ``format`` where the type would do but the
    notation does not. Every line but headers and blank ones is in exactly one
    of the two. A repeated header, as in joined files, is no record; quoted
    values cannot hold line ends. Headers cost a second pass over the text;
    the list of files is written first, so Spark joins it by its true size and
    does not shuffle the lines while it is small.
    """
    wanted = spark.createDataFrame([], schema).schema
    header = ",".join(wanted.names).lower()
    lines = (spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
             .withColumn("named", F.lower(F.translate("line", '" ', "")) == header))
    files = on_file(lines.groupBy("file").agg(F.max("named").alias("known")), "headers")

    def parsed(types: dict[str, str]) -> Column:
        ddl = ", ".join(f"`{c}` {t}" for c, t in types.items())
        return F.from_csv("line", f"{ddl}, `{BROKEN}` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})

    types = {f.name: f.dataType.simpleString() for f in wanted}
    records = (lines.filter("NOT named AND trim(line) <> ''").join(files, "file")
               .withColumn("row", parsed(types))
               .withColumn("known", F.coalesce("known", F.lit(False))))
    whole = F.col("known") & F.col("row")[BROKEN].isNull()
    raw = F.col("raw")
    untyped = F.concat_ws(",", *[
        F.when(raw[c].isNotNull() & raw[c].try_cast(t).isNull(), F.lit(c)) for c, t in types.items()])
    reason = (F.when(~F.col("known"), "header").when(raw[BROKEN].isNotNull(), "fields")
              .when(untyped != "", untyped).otherwise("format"))
    bad = (records.filter(~whole).withColumn("raw", parsed(dict.fromkeys(types, "string")))
           .select("file", "line", reason.alias("reason")))
    return records.filter(whole).select(*[F.col("row")[c].alias(c) for c in types]), bad


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A columnar table; ``delta`` works where its package is installed."""
    return spark.read.format(fmt).load(path)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Item to category, under the column names of the sales model."""
    raw = read_csv(spark, path)
    return raw.select(*CATEGORY_NAMES).withColumnsRenamed(CATEGORY_NAMES)


def read_category_groups(spark: SparkSession, path: str, category: str = "product_cat_lv2",
                         group: str = "product_cat_lv1") -> DataFrame:
    """Category to category group; ``category`` names the file's own column."""
    return (read_csv(spark, path).select(category, group)
            .toDF("product_cat_lv2", "product_cat_lv1"))


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: str | None = None) -> int:
    """Replace a table, schema included, and report its rows.

    The rows are counted while they are written. ``path`` must not feed ``df``.
    """
    seen = Observation()
    writer = (df.observe(seen, F.count(F.lit(1)).alias("rows"))
              .write.format(fmt).mode("overwrite").option("overwriteSchema", "true"))
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    return seen.get["rows"]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there is one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder; the folder that it goes to is made, ``target`` must not exist yet."""
    source, goal = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(goal.getParent())
    if fs.exists(goal) or not fs.rename(source, goal):
        raise OSError(f"cannot move {path} to {target}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def export_csv(df: DataFrame, folder: str, name: str) -> str:
    """Write a small result as the one file ``folder/name.csv``.

    A single file needs a single writing task: for reports, not for tables.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    staged = f"{folder.rstrip('/')}/.{name}-{uuid.uuid4().hex}"
    target = f"{folder.rstrip('/')}/{name}.csv"
    df.coalesce(1).write.option("header", True).csv(staged)
    part = next(n for n in child_names(spark, staged) if n.endswith(".csv"))
    source, goal = jvm.org.apache.hadoop.fs.Path(f"{staged}/{part}"), jvm.org.apache.hadoop.fs.Path(target)
    fs = goal.getFileSystem(conf)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, goal, True, True, conf)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return target
