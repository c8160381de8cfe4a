import os
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from postings import fixed
from postings.operators import quality
from postings.sources import warehouse


def raw(spark, *rows):
    """Raw rows from (day, id) pairs; all other columns NULL."""
    df = spark.createDataFrame([(date(2026, 9, n), i) for n, i in rows], "run_date date, source_id string")
    others = [F.lit(None).cast(t).alias(c) for c, t in fixed.RAW_COLUMNS if c not in df.columns]
    return df.select("*", *others)


@pytest.fixture
def raw_table(spark):
    warehouse.ensure_layers(spark)
    spark.sql("DROP TABLE IF EXISTS raw.t")
    warehouse.create_raw_table(spark, "raw.t")
    return "raw.t"


def ids(spark, table="raw.t"):
    return sorted((r.run_date.day, r.source_id) for r in spark.table(table).collect())


def test_replace_days(spark, raw_table):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    warehouse.replace_days(raw(spark, (1, "a"), (1, "b"), (1, "c")), raw_table)
    warehouse.replace_days(raw(spark, (2, "x")), raw_table)
    warehouse.replace_days(raw(spark, (1, "a"), (1, "d")), raw_table)
    assert ids(spark) == [(1, "a"), (1, "d"), (2, "x")]
    warehouse.replace_days(raw(spark, (1, "a"), (1, "d")), raw_table)
    assert ids(spark) == [(1, "a"), (1, "d"), (2, "x")]
    warehouse.replace_days(raw(spark), raw_table)
    assert warehouse.row_count(spark, raw_table) == 3
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_raw_table_has_the_fixed_types(spark, raw_table):
    stored = {f.name: f.dataType for f in spark.table(raw_table).schema}
    assert stored == dict(fixed.RAW_COLUMNS)
    assert warehouse.is_partitioned(spark, raw_table)


def test_unpartitioned_table_is_rebuilt(spark):
    warehouse.ensure_layers(spark)
    spark.sql("DROP TABLE IF EXISTS raw.old")
    raw(spark, (1, "a"), (2, "b")).write.saveAsTable("raw.old")
    assert warehouse.ensure_partitioned(spark, "raw.old") is True
    assert warehouse.is_partitioned(spark, "raw.old")
    assert ids(spark, "raw.old") == [(1, "a"), (2, "b")]
    assert warehouse.ensure_partitioned(spark, "raw.old") is False
    assert warehouse.ensure_partitioned(spark, "raw.missing") is False


def test_stored_reads_back_the_same(spark, rows):
    df = raw(spark, (1, "a"), (2, None))
    again = warehouse.stored(df)
    assert rows(again) == rows(df) and again.schema.names == df.schema.names


def test_the_shared_folder_comes_from_the_session():
    def fake(settings, master):
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))

    named = {"spark.checkpoint.dir": "s3a://shared/points/"}
    assert warehouse._shared_folder(fake(named, "yarn")) == "s3a://shared/points"
    assert os.path.isdir(warehouse._shared_folder(fake({}, "local[2]")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        warehouse._shared_folder(fake({}, "yarn"))


def test_data_tests(table, rows):
    df = table("k string, a string, ok boolean", ("1", "x", True), ("1", "y", None), (None, "z", False), (None, "z", None))
    results = quality.all_tests(
        quality.row_tests(df, {
            "k": quality.not_null("k"),
            "a": quality.not_accepted("a", ["x", "y"]),
            "k accepted": quality.not_accepted("k", ["1"]),
            "ok": F.col("ok") != F.lit(True),
        }),
        quality.unique_test(df, "unique", "k"),
        quality.unique_test(df, "grain", "k", "a"),
        quality.dependency_test(df, "depends", "k", {"a": F.col("a")}),
        quality.relationship_test(df, "parent", "k", table("k string", ("2",))),
        quality.relationship_test(df, "parent ok", "k", table("k string", ("1",))),
    )
    assert dict(rows(results)) == {
        "k": 2, "a": 2, "k accepted": 0, "ok": 1, "unique": 1, "grain": 1, "depends": 1, "parent": 2, "parent ok": 0}
    with pytest.raises(quality.DataTestFailure, match="grain: 1"):
        quality.enforce(results)
    quality.enforce(results.where("n_bad = 0"))
