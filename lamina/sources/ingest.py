"""CSV files into the raw layer, with audit columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import domain
from lamina.functions.scalars import col
from lamina.sources.layers import read_layer, versions, write_layer


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header line; all columns text unless asked otherwise.

    Text is read without an inference pass. With ``infer`` Spark reads the
    file once more to choose types; one bad token then makes a column text.
    """
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def with_audit(df: DataFrame, file_name: str, rows: int | None, batch: str | None = None) -> DataFrame:
    """Origin, row count, batch id (one per load) and load time on every row; no count if it is not known yet."""
    origin, size, batch_id, loaded = domain.AUDIT_COLUMNS
    counted = {} if rows is None else {size: F.lit(rows).cast("bigint")}
    return df.withColumns(
        {
            origin: F.lit(file_name),
            **counted,
            batch_id: F.lit(batch or str(uuid.uuid4())),
            loaded: F.current_timestamp(),
        }
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw table with its row count, which the commit of the write carries, on every row."""
    rows = read_layer(spark, path)
    origin, size, batch_id, loaded = domain.AUDIT_COLUMNS
    count = next((v.rows for v in reversed(versions(spark, path))), None)
    if size in rows.columns or count is None:
        return rows
    audit = [F.col(origin), F.lit(count).cast("bigint").alias(size), F.col(batch_id), F.col(loaded)]
    return rows.select(*[col(n) for n in rows.columns if n not in domain.AUDIT_COLUMNS], *audit)


def table_name(path: str) -> str:
    """The table is named after the file."""
    return os.path.basename(path.rstrip("/")).removesuffix(".csv")


def ingest(
    spark: SparkSession,
    path: str,
    raw_folder: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    **options: str,
) -> str:
    """One CSV (file or folder of parts) to one raw table; its path, for ``read_raw``.

    ``options`` are the reader's, such as ``sep``, ``escape`` or ``multiLine``.

    The text is read once. The row count has to be on every row, so it is taken from the
    footers of the files written, kept with the commit and added by ``read_raw``.
    """
    source = read_csv(spark, path, schema, infer, **options)
    name = table_name(path)
    audited = with_audit(source, f"{name}.csv", None)
    return write_layer(audited, os.path.join(raw_folder, f"{name}.parquet"), counted=True)


def ingest_all(
    spark: SparkSession,
    files: Mapping[str, str] | list[str],
    raw_folder: str,
    infer: bool = False,
    **options: str,
) -> dict[str, str]:
    """Every listed CSV to its raw table: table name -> Parquet path."""
    paths = list(files.values()) if isinstance(files, Mapping) else files
    return {table_name(p): ingest(spark, p, raw_folder, infer=infer, **options) for p in paths}


def layer_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, columns.

    Each table is counted on its own partitions (from Parquet footers where
    it is a plain scan) and the one-row counts are put together.
    """
    report = None
    for name, df in tables.items():
        line = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"),
            "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
        )
        report = line if report is None else report.unionByName(line)
    return report
