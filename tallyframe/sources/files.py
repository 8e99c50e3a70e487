"""Reading: stored tables, delimited text with declared types, catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyframe.operators.scoring import align_levels
from tallyframe.sources.sinks import MISSING


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A stored Parquet table; a declared schema spares the job that reads it from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    missing: str = MISSING,
    levels: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Delimited text with a header.

    ``schema`` declares names and types; without it types are inferred, at the
    price of a second pass. ``missing`` is a token that stands for a missing
    value, as a field without quotes that is empty always does. Quoted line breaks
    are part of a text, so a file is read by one task: write many files. ``levels`` lists the allowed values of level columns; others become
    missing.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=True, nullValue=missing, lineSep="\n")
    reader = reader.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.withColumns({c: align_levels(c, v) for c, v in (levels or {}).items()}) if levels else df


def read_catalog(spark: SparkSession, table: str | None = None, query: str | None = None) -> DataFrame:
    """A catalog table, or the result of a query."""
    return spark.sql(query) if query else spark.table(table)


def csv_to_columnar(
    spark: SparkSession, files: dict[str, str], schemas: dict[str, str], out: str, levels: dict | None = None
) -> dict[str, str]:
    """Convert several CSV files to Parquet folders with declared types and levels; returns their paths."""
    paths = {}
    for name, path in files.items():
        names = T.StructType.fromDDL(schemas[name]).names
        declared = {c: v for c, v in (levels or {}).items() if c in names}
        read_csv(spark, path, schemas[name], levels=declared).write.mode("overwrite").parquet(f"{out}/{name}")
        paths[name] = f"{out}/{name}"
    return paths


def collect_bounded(df: DataFrame, max_rows: int = 100_000):
    """A finished, small result as a pandas table; refuses larger ones."""
    result = df.limit(max_rows + 1).toPandas()
    if len(result) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    return result
