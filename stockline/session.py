"""Session helpers: shared scratch folders and durable cuts of the lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may
    fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stockline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_file(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it from there.

    A joined or grouped side is planned by an estimate that can be far above
    its true size; a file's size is known, so Spark decides by that whether to
    broadcast it.
    """
    return on_new_path(df, name)[0]


def on_new_path(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``on_file``, with the path, for callers that delete the copy later."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and continue from there.

    Used where a plan would otherwise be evaluated twice with different
    results, or grow with every round of an iteration. The written copy
    survives the loss of executors.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


# Fixed value: methods of more bytes than this are never compiled by the virtual machine.
LARGEST_METHOD = 8000


def small_methods(spark: SparkSession) -> None:
    """Let operators that would fuse into one method too large to be compiled run one by one.

    Spark fuses up to 64 kB, and such a method is interpreted row by row. A
    lower limit that the session names is kept.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > LARGEST_METHOD:
        spark.conf.set(name, LARGEST_METHOD)


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings ``spark.sql.…``, dots as double underscores, for what is run inside; afterwards they are as before."""
    names = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """What a write inside shuffles is deleted when it is done, not when the driver happens to collect its garbage."""
    return settings(spark, classic__shuffleDependency__fileCleanup__enabled=True)
