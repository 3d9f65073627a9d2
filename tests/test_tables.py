from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import layout, profile
from tidemark.operators.merge import MergeSpec
from tidemark.operators.select import pad_union, sample_rows, select_ordered, select_prefix, stack_by_position
from tidemark.plans.derived import DerivedTable
from tidemark.sources import catalog
from tidemark.sources.staging import register, sql_over, stage, staged


def test_names(spark, database):
    assert catalog.split_name(spark, f"{database}.t") == (database, "t")
    for bad in ("t", "a.b.c", ".t"):
        with pytest.raises(ValueError, match="database.table"):
            catalog.split_name(spark, bad)
    with pytest.raises(ValueError, match="no database"):
        catalog.split_name(spark, "nowhere.t")


def test_absent_table(spark, database):
    name = f"{database}.t"
    assert catalog.read(spark, name) is None
    assert profile.columns(spark, name) is None
    assert profile.column_types(spark, name) is None
    assert profile.schema(spark, name) is None
    assert catalog.ddl_text(spark, name) is None
    assert profile.row_count(spark, name) == 0
    assert profile.distinct_count(spark, name, "a") == 0
    assert profile.extreme(spark, name, "a", "max") is None
    row = profile.table_profile(spark, name).first()
    assert (row["exists"], row["row_count"], row["columns"]) == (False, 0, None)
    assert catalog.drop(spark, name) is False


def test_create_and_replace(spark, database):
    name = f"{database}.t"
    catalog.create(spark, name, "a int, d date")
    with pytest.raises(ValueError, match="replace"):
        catalog.create(spark, name, "a int")
    catalog.append(spark.sql("select date'2024-01-02' d, 1 a"), name)
    catalog.create(spark, name, "b string", replace=True)
    assert spark.table(name).columns == ["b"] and spark.table(name).count() == 0
    with pytest.raises(Exception):
        catalog.parse_ddl("not a column list at all")


def test_append_by_name_and_by_position(spark, database):
    name = f"{database}.t"
    catalog.create(spark, name, "a int, b int")
    swapped = spark.sql("select 2 b, 1 a")
    catalog.append(swapped, name)
    catalog.append(swapped, name, by_name=False)
    assert rows(spark.table(name)) == [(1, 2), (2, 1)]
    with pytest.raises(ValueError, match="not in both"):
        catalog.append(spark.sql("select 1 a, 2 c"), name)
    catalog.overwrite(spark.table(name).filter("a = 1"), name)
    assert rows(spark.table(name)) == [(1, 2)]


@pytest.mark.parametrize("parts", [(), ("b",)])
def test_overwrite_from_itself(spark, database, parts):
    name = f"{database}.t"
    catalog.create_as(spark.range(10).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b")), name, parts)
    with pytest.raises(ValueError, match="exists"):
        catalog.create_as(spark.table(name), name)
    catalog.overwrite(spark.table(name).filter("b <> 1"), name)
    assert rows(spark.table(name), "b") == [(0,)] * 4 + [(2,)] * 3


def test_publish_leaves_earlier_readers_alone(spark, database):
    name = f"{database}.t"
    catalog.create_as(spark.range(3), name)
    before = spark.table(name)
    assert before.count() == 3
    catalog.publish(spark.range(5), name)
    assert before.count() == 3
    assert spark.table(name).count() == 5


def test_failed_publish_leaves_the_table(spark, database):
    name = f"{database}.t"
    catalog.create_as(spark.range(3), name)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        catalog.publish(broken, name)
    assert spark.table(name).count() == 3


def test_a_column_called_location(spark, database):
    name = f"{database}.t"
    catalog.create_as(spark.sql("select 1 id, 'here' Location"), name)
    catalog.publish(spark.sql("select 2 id, 'there' Location"), name)
    assert rows(catalog.read(spark, name)) == [(2, "there")]
    assert catalog.drop(spark, name)


def test_drop_all(spark, database):
    catalog.create_as(spark.range(1), f"{database}.a")
    report = catalog.drop_all(spark, [f"{database}.a", f"{database}.b"])
    assert rows(report) == [(f"{database}.a", True), (f"{database}.b", False)]
    assert not catalog.exists(spark, f"{database}.a")


def test_a_table_made_elsewhere(spark, database, tmp_path):
    """Publishing and dropping leave the folders around such a table alone."""
    name = f"{database}.plain"
    spark.range(2).write.option("path", f"{tmp_path}/plain").saveAsTable(name)
    (tmp_path / "neighbour").mkdir()
    catalog.publish(catalog.read(spark, name).unionByName(spark.range(1)), name)
    assert catalog.read(spark, name).count() == 3
    catalog.drop(spark, name)
    assert (tmp_path / "neighbour").exists() and not (tmp_path / "plain.versions").exists()


def test_ensure_like(spark, database):
    like = spark.sql("select 1 a, array(named_struct('x', 'y')) s")
    made = catalog.ensure_like(like, f"{database}.t")
    assert made.count() == 0 and dict(made.dtypes) == dict(like.dtypes)
    assert "a" in catalog.ddl_text(spark, f"{database}.t") and "\n" not in catalog.ddl_text(spark, f"{database}.t")


def test_profile(spark, database):
    name = f"{database}.t"
    data = [(1, date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)), (1, date(2024, 1, 5), None), (None, None, None)]
    df = spark.createDataFrame(data, "a int, d date, t timestamp_ntz")
    catalog.create_as(df, name)
    assert profile.row_count(spark, name) == 3
    assert profile.distinct_count(spark, name, "a") == 1
    assert profile.distinct_count(spark, name, "zz") == 0
    assert profile.extreme(spark, name, "d", "max") == "2024-01-05"
    assert profile.extreme(spark, name, "d", "max", as_text=False) == date(2024, 1, 5)
    assert profile.extreme(spark, name, "t", "min") == "2024-01-02 03:04:05"
    assert profile.extreme(spark, name, "a", "min") == 1
    assert profile.extreme(spark, name, "zz", "min") is None
    with pytest.raises(ValueError):
        profile.extreme(spark, name, "a", "avg")
    assert profile.columns(spark, name) == ["a", "d", "t"]
    row = profile.table_profile(spark, name).first()
    assert (row["database"], row["table"], row["row_count"]) == (database, "t", 3)
    assert row["column_types"] == {"a": "int", "d": "date", "t": "timestamp_ntz"}
    assert profile.freshness(df, "d").first()[0] == "2024-01-05"
    catalog.overwrite(df.limit(0), name)
    assert profile.extreme(spark, name, "d", "max") is None


def test_derived_table(spark, database):
    spec = MergeSpec(("user_id",), lambda t, s: t("user_name") != s("user_name"))
    name = f"{database}.u"
    build = lambda v: lambda s: s.createDataFrame(v, "user_id string, user_name string")
    assert tuple(DerivedTable(name, build([("1", "a"), ("2", "b")]), spec).refresh(spark).first()) == (0, 0, 0, 0)
    counts = DerivedTable(name, build([("2", "B"), ("3", "c")]), spec).refresh(spark).first()
    assert tuple(counts) == (2, 1, 0, 1)
    assert rows(spark.table(name)) == [("1", "a"), ("2", "B"), ("3", "c")]
    with pytest.raises(ValueError, match="no rows"):
        DerivedTable(name, build([]), spec).refresh(spark)
    with pytest.raises(TypeError):
        DerivedTable(name, "select 1", spec)
    text = f"  SELECT user_id, 'z' as user_name FROM {name}"
    assert DerivedTable.from_select(name, text, spec).refresh(spark).first()["num_updated_rows"] == 3
    with pytest.raises(ValueError, match="select"):
        DerivedTable.from_select(name, "delete from t", spec)
    with pytest.raises(TypeError):
        DerivedTable(name, build([]), "merge into")


def test_selection(spark):
    df = spark.sql("select 1 a, 2 b, 3 user_x")
    picked, ignored = select_ordered(df, ["user_x", "a"])
    assert picked.columns == ["user_x", "a"] and ignored == ["b"]
    with pytest.raises(ValueError):
        select_ordered(df, [])
    with pytest.raises(ValueError, match="zz"):
        select_ordered(df, ["zz"])
    assert select_prefix(df, "user_").columns == ["user_x"]
    assert rows(stack_by_position(spark.sql("select 1 a, 2 b"), spark.sql("select 3 b, 4 a"))) == [(1, 2), (3, 4)]
    padded = pad_union([spark.sql("select 1 z"), spark.sql("select 2 a")])
    assert padded.columns == ["a", "z"] and rows(padded) == [(None, 1), (2, None)]


def test_sample_is_repeatable(spark):
    df = spark.range(1000).repartition(7)
    picked = rows(sample_rows(df, "id"))
    assert len(picked) == 3 and picked == rows(sample_rows(df.repartition(3), "id"))
    assert picked != rows(sample_rows(df, "id", seed=1))
    assert rows(sample_rows(spark.range(2), "id")) == [(0,), (1,)]


def test_staging(spark):
    df = spark.range(5)
    with staged(df) as kept:
        assert rows(kept) == rows(df)
        (file, *_) = kept.inputFiles()
    assert not Path(file.removeprefix("file://")).exists()
    assert stage(df).dtypes == df.dtypes
    register(df, "some_view")
    assert spark.sql("select max(id) from some_view").first()[0] == 4
    assert sql_over(spark, "select count(*) from {d} where id > {low}", d=df, low=2).first()[0] == 2


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_cluster_table(spark, database, parts):
    name = f"{database}.t"
    n = 20_000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).alias("x"),
        F.concat(F.lit("k"), (F.col("id") * 104729 % n).cast("string")).alias("y"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 300).cast("int"))).alias("d"),
        (F.col("id") % 2).cast("int").alias("part"),
    )
    catalog.create_as(df, name, parts)
    report = layout.cluster_table(spark, name, ["x", "y"], target_bytes=20_000).first()
    assert report["rows"] == n and report["files_after"] > 4
    assert rows(spark.table(name).groupBy("part").agg(F.count("*"), F.sum("x"), F.count("d"), F.max("y"))) == rows(
        df.groupBy("part").agg(F.count("*"), F.sum("x"), F.count("d"), F.max("y"))
    )
    spread = layout.file_layout(spark.table(name), ["x"]).select(F.avg(F.col("max_x") - F.col("min_x"))).first()[0]
    assert spread < n * 0.75  # a file covers part of the range, where it covered all before
    with pytest.raises(ValueError):
        layout.cluster_table(spark, name, ["zz"])


def test_a_hot_value_is_spread_over_files(spark, database):
    """A third of identical rows does not end up in one file."""
    name = f"{database}.t"
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("x"), F.lit("same").alias("y"))
    catalog.create_as(hot, name)
    before = layout.layout_summary(spark.table(name)).first()["bytes"]
    layout.cluster_table(spark, name, ["x"], target_bytes=before // 6)
    files = layout.file_layout(spark.table(name), ["x"])
    assert files.agg(F.max("rows")).first()[0] < 30_000 / 4
    assert spark.table(name).filter("x = 7").count() == hot.filter("x = 7").count()
