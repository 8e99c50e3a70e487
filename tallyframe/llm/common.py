"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash buckets per group in distributed prefix sums: three hexadecimal digits.
BUCKET_DIGITS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_text(key: str = "doc_id") -> Column:
    """The record key as text; a missing key is the empty text."""
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def order_hash(salt: str, *parts: Column) -> Column:
    """A hash-random hexadecimal sort key, the same in every run."""
    return F.md5(F.concat(F.lit(f"{salt}:"), *[x for p in parts for x in (p, F.lit(":"))]))


def unit_from_hex(digest: Column) -> Column:
    """52 bits of a hexadecimal digest as a number above 0 and below 1."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(2**52)


def empty_if_null(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def held_out(key: str, folds: int, fold: int) -> Column:
    """True where crc32 of the key as text, modulo ``folds``, is ``fold``."""
    return F.crc32(key_text(key).cast("binary")) % folds == fold


#: Rows and bytes per Arrow batch: texts may be long, and a worker holds a batch whole.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
_ROWS_SETTING, _BYTES_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """The table as it is; its session hands Python at most BATCH_ROWS rows, and about ``most_bytes`` bytes, at once from now on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS_SETTING)) <= BATCH_ROWS:
        conf.set(_ROWS_SETTING, str(BATCH_ROWS))
    conf.set(_BYTES_SETTING, str(most_bytes))
    return df
