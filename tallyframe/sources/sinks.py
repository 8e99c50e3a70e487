"""Writing: delimited text, replaced and appended tables, one folder per level, views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# What stands for a missing value, so that it differs from an empty text.
MISSING = "\\N"


def write_csv(df: DataFrame, path: str, missing: str = MISSING) -> None:
    """Delimited text with a header, as one folder of part files; texts keep their blanks and line breaks."""
    writer = df.write.mode("overwrite").options(header=True, escape='"', nullValue=missing, lineSep="\n")
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def own_name(table: str) -> str:
    """A catalog name of this call's own, so that two runs do not write one table."""
    return f"{table}_{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Create or replace a catalog table stored at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def recreate_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Drop the table if there is one, then create it from a query result."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def persist_to(df: DataFrame, path: str) -> DataFrame:
    """Store an intermediate result under a name and continue from the stored copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_split(df: DataFrame, level: str, path: str) -> None:
    """One folder per value of ``level``.

    The rebalance hint gathers each level into files of even size: a small level
    gets one file, and a level holding much of the table is spread over many
    tasks.
    """
    df.hint("rebalance", level).write.mode("overwrite").partitionBy(level).parquet(path)


def read_split(spark: SparkSession, path: str, level: str, value: str) -> DataFrame:
    """One level's rows; only its folder is read."""
    return spark.read.parquet(path).filter(F.col(level) == value)


def define_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
