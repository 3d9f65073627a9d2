"""Profiles from footers and bitmaps."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.sources import catalog


def sample(spark, n=5000):
    return spark.range(n).select(
        (F.col("id") * 3 - 4000).alias("a"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("int")).alias("b"),
        (F.col("id") / 8).alias("x"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"),
        F.concat(F.lit("long text " * 20), F.col("id").cast("string")).alias("t"),
        F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("at"),
        (F.col("id") % 3).cast("int").alias("p"),
    )


@pytest.mark.parametrize("parts", [(), ("p",), ("d",)])
def test_footers_tell_what_a_scan_does(spark, database, parts):
    name = f"{database}.t"
    catalog.create_as(sample(spark), name, parts)
    columns = ["a", "b", "x", "d", "t", "at", "p"]
    expected = profile.column_profile(catalog.read(spark, name), columns).first()
    assert profile.footer_profile(spark, name, columns).first() == expected
    assert profile.footer_profile(spark, name, ["d"]).first()["max_d"] == "2024-03-30"


def test_the_aggregate_is_pushed_into_the_scan(spark, database):
    name = f"{database}.t"
    catalog.create_as(sample(spark), name, ("p",))
    with profile._footers_only(spark):
        plan = profile.footer_frame(spark, name, ["a", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(a), MAX(a), MIN(d), MAX(d)]" in plan
    assert "ReadSchema: struct<count(*):bigint,min(a):bigint" in plan
    assert profile._footer_values(spark, name, ["a", "d"]) == (5000, "-4000", "10997", "2024-01-01", "2024-03-30")


def test_settings_are_restored(spark, database):
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before = [spark.conf.get(k) for k in keys]
    catalog.create_as(sample(spark, 10), f"{database}.t")
    profile.footer_profile(spark, f"{database}.t", ["a"])
    assert [spark.conf.get(k) for k in keys] == before


def test_files_without_statistics_are_scanned(spark, database, tmp_path):
    name = f"{database}.t"
    sample(spark, 100).coalesce(1).write.option("parquet.column.statistics.enabled", "false").option("path", f"{tmp_path}/plain").saveAsTable(name)
    expected = profile.column_profile(catalog.read(spark, name), ["a", "x"]).first()
    assert profile.footer_profile(spark, name, ["a", "x"]).first() == expected
    catalog.create(spark, f"{database}.e", "a int, t string")
    assert tuple(profile.footer_profile(spark, f"{database}.e", ["a", "t"]).first()) == (0, None, None, None, None)


def test_bitmaps_count_exactly(spark):
    df = spark.range(-70_000, 70_000).select(
        F.col("id").alias("dense"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 101).cast("int").alias("few"),
        (F.col("id") % 77 * 10**14).alias("wide"),
        F.lit(None).cast("bigint").alias("none"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"),
        F.lit(2**63 - 1).alias("largest"),
    )
    counts = profile.distinct_counts(df, df.columns)
    assert rows(counts) == rows(df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in df.columns])).alias("s")).groupBy("s.c").agg(F.count_distinct("s.v")))
    dense = profile.distinct_of_bitmaps(profile.column_bitmaps(df, ["dense", "few", "d"]))
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("FileScan") + plan.count("Range (") == 1
    assert rows(profile.distinct_counts(df.limit(0), ["dense", "d"])) == [("d", 0), ("dense", 0)]
    with pytest.raises(TypeError, match="string"):
        profile.column_bitmaps(df.select(F.lit("x").alias("s")), ["s"])


def test_bitmaps_of_days_combine(spark):
    df = spark.range(9000).select((F.col("id") % 4).alias("day"), (F.col("id") * F.col("id") % 1000).alias("user"))
    kept = profile.column_bitmaps(df, ["user"], by=("day",))
    assert rows(profile.distinct_of_bitmaps(kept, ("day",)), "day", "distinct_count") == rows(df.groupBy("day").agg(F.count_distinct("user")))
    assert profile.distinct_of_bitmaps(kept).first()["distinct_count"] == df.select("user").distinct().count()
