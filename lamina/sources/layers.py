"""Parquet tables between the stages, each kept as committed versions.

A layer is a folder of data folders and of empty files whose names say, in order,
which data folder holds. A write makes a new data folder and then such a file, so a
write that is killed leaves the old rows, readers of the old rows are not disturbed,
and a layer can be overwritten with rows that were read from it.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

COMMIT = "_commit-"
# Versions that stay after a write: the new one, and the one that jobs may still read.
KEPT_VERSIONS = 2


class Version(NamedTuple):
    """A committed write: its number, its rows if they were counted, its data folder."""

    number: int
    rows: int | None
    data: str


def _store(spark: SparkSession, path: str):
    """The file system of ``path`` and what makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The committed versions of a layer, oldest first; none for plain Parquet or a missing path."""
    store, make = _store(spark, path)
    if not store.exists(make(path)):
        return []
    names = sorted(f.getPath().getName() for f in store.listStatus(make(path)))
    parts = [n.removeprefix(COMMIT).split("_") for n in names if n.startswith(COMMIT)]
    return [Version(int(n), int(rows) if rows else None, f"{path}/data-{data}") for n, rows, data in parts]


def write_layer(df: DataFrame, path: str, counted: bool = False) -> str:
    """Put the rows in place of those of the layer; ``df`` may have been read from it.

    With ``counted`` the commit carries the number of rows, taken from the files just written.
    """
    spark = df.sparkSession
    store, make = _store(spark, path)
    name = uuid.uuid4().hex
    data = f"{path}/data-{name}"
    try:
        df.write.parquet(data)
        rows = str(spark.read.parquet(data).count()) if counted else ""
    except BaseException:
        store.delete(make(data), True)
        raise
    before = versions(spark, path)
    number = before[-1].number + 1 if before else 1
    store.create(make(f"{path}/{COMMIT}{number:010d}_{rows}_{name}"), False).close()
    for old in before[: 1 - KEPT_VERSIONS]:
        held = "" if old.rows is None else old.rows
        store.delete(make(f"{path}/{COMMIT}{old.number:010d}_{held}_{old.data.rsplit('-', 1)[1]}"), False)
        store.delete(make(old.data), True)
    return path


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last committed version; plain Parquet is read as it is."""
    found = versions(spark, path)
    return spark.read.parquet(found[-1].data if found else path)


def read_for_model(
    spark: SparkSession, refined: str, features: str
) -> tuple[DataFrame, DataFrame]:
    """Refined and feature layer together, as the model stage wants them."""
    return read_layer(spark, refined), read_layer(spark, features)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, rows: int = 10) -> None:
    """Print the first rows in full width."""
    df.show(rows, truncate=False)


def write_csv(df: DataFrame, folder: str) -> str:
    """Report table as CSV part files with a header."""
    df.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def write_json(df: DataFrame, folder: str) -> str:
    df.write.mode("overwrite").json(folder)
    return folder
