"""Tables that are published whole."""

import pytest
from pyspark.sql import functions as F

from tallyframe.sources.published import PublishedTable


def numbers(spark, n, **more):
    return spark.range(n).withColumns({k: F.lit(v) for k, v in more.items()})


def test_versions(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    assert table.publish(numbers(spark, 5), "first").count() == 5
    # A version is written once: the rerun returns what is there, whatever it was given.
    assert table.publish(numbers(spark, 9), "first").count() == 5
    assert table.publish(numbers(spark, 7, note="x"), "second").columns == ["id", "note"]
    assert table.read().count() == 7 and table.read("first").count() == 5
    assert table.commits().count() == 2
    with pytest.raises(LookupError):
        table.read("third")


def test_dead_writers_are_passed_over(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    # A writer that died before its commit, at any stage of its data.
    numbers(spark, 3).write.parquet(f"{tmp_path}/t/data/dead")
    with pytest.raises(LookupError):
        table.read()
    table.publish(numbers(spark, 4), "v")
    numbers(spark, 3).write.parquet(f"{tmp_path}/t/data/dead2")
    assert table.read().count() == 4
    assert table.clean() == 2 and table.clean() == 0 and table.read().count() == 4


def test_two_writers_of_one_version(spark, tmp_path):
    """Both saw no commit and wrote: every reader takes the same one."""
    a, b = PublishedTable(spark, f"{tmp_path}/t"), PublishedTable(spark, f"{tmp_path}/t")
    a.publish(numbers(spark, 4), "v")
    row = a.commits().first()
    numbers(spark, 6).write.parquet(f"{tmp_path}/t/data/zz")
    late = spark.createDataFrame([(row.number, "v", "data/zz", row.fields)], "number bigint, version string, folder string, fields string")
    late.write.mode("append").parquet(f"{tmp_path}/t/commits")
    assert a.commits().count() == 1 and a.read().count() == b.read().count() == 4


def test_empty_table(spark, tmp_path):
    table = PublishedTable(spark, f"{tmp_path}/t")
    assert table.publish(numbers(spark, 0, k="a"), "v").columns == ["id", "k"] and table.read().count() == 0
