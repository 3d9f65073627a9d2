from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import nested, text, times


def one(spark, column, **values):
    """The column over a single row of literals."""
    base = spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in values.items()])
    return base.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-05T10:00:01Z", datetime(2024, 1, 5, 10, 0, 1)),
        ("2024-01-05 10:00:01", datetime(2024, 1, 5, 10, 0, 1)),
        ("2024-13-05T10:00:01Z", None),
        ("", None),
        (None, None),
    ],
)
def test_to_time(spark, value, expected):
    assert one(spark, times.to_time(F.col("v")), v=F.lit(value).cast("string")) == expected


def test_malformed_is_not_missing(spark):
    flag = times.is_malformed_time(F.col("v"))
    assert one(spark, flag, v="soon") is True
    assert one(spark, flag, v=F.lit(None).cast("string")) is False


def test_text_forms(spark):
    ts = F.lit(datetime(2024, 2, 3, 4, 5, 6)).cast("timestamp_ntz")
    assert one(spark, times.time_text(F.col("t")), t=ts) == "2024-02-03 04:05:06"
    assert one(spark, times.time_text(F.col("t"), api=True), t=ts) == "2024-02-03T04:05:06Z"
    assert one(spark, times.reformat_to_api(F.col("t")), t="2024-02-03 04:05:06") == "2024-02-03T04:05:06Z"
    assert one(spark, times.reformat_to_api(F.col("t"), "yyyyMMdd"), t="20240203") == "2024-02-03T00:00:00Z"
    with pytest.raises(PySparkException):
        one(spark, times.reformat_to_api(F.col("t")), t="yesterday")


def test_unix_day_ignores_the_session_zone(spark):
    seconds = 1704067200 + 3600  # 2024-01-01 01:00 UTC
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, times.unix_day_text(F.col("s")), s=seconds) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert one(spark, times.unix_day_text(F.col("s")), s=-1) == "1969-12-31"


def test_day_span(spark):
    span = times.day_span(F.col("a"), F.col("b"))
    assert one(spark, span, a="2024-02-28", b="2024-03-01") == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    with pytest.raises(PySparkException, match="first day"):
        one(spark, span, a="2024-02-28", b="2024-02-01")


def test_day_span_times(spark):
    span = times.day_span_times(F.col("a"), F.col("b"))
    assert one(spark, span, a="2024-01-01", b="2024-01-02") == [datetime(2024, 1, 1), datetime(2024, 1, 2, 23, 59, 59)]
    assert one(spark, span, a="2024-01-01", b="2024-01-01") == [datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59, 59)]


def test_run_clock(spark):
    at = datetime(2024, 5, 6, 7, 8, 9)
    assert one(spark, times.run_day(at)) == "2024-05-06"
    assert one(spark, times.run_time(at)) == "2024-05-06T07:08:09Z"
    assert len(one(spark, times.run_day())) == 10


def test_fold(spark):
    fold = nested.fold_to_int(F.col("a"))
    assert one(spark, fold, a=F.array(F.lit(1), F.lit(2))) == 3
    assert one(spark, fold, a=F.array().cast("array<int>")) == 0
    assert one(spark, fold, a=F.array(F.lit(1), F.lit(None).cast("int"))) is None
    with pytest.raises(PySparkException):
        one(spark, fold, a=F.array(F.lit(2147483647), F.lit(1)))


def test_arrays(spark):
    names = F.array(F.lit("b"), F.lit(None).cast("string"), F.lit("A"))
    assert one(spark, nested.sorted_lower(F.col("a")), a=names) == ["a", "b", None]
    assert one(spark, nested.none_if_empty(F.col("a")), a=F.array().cast("array<string>")) is None
    assert one(spark, nested.none_if_empty(F.col("a")), a=names) == ["b", None, "A"]


def test_engines(spark):
    flags = F.from_json(
        F.lit('{"SparkDFExecutionEngine": true, "PandasExecutionEngine": true, "A": true, "B": false, "C": true}'),
        "map<string, boolean>",
    )
    got = one(spark, nested.engine_classes(nested.true_keys(F.col("m"))), m=flags)
    assert got == ["spark", "pandas", "sql", "sql"]


def test_names(spark):
    assert one(spark, text.spaced(F.col("x")), x="CHANGES_REQUESTED") == "changes requested"
    assert one(spark, text.underscored(F.col("x")), x="Expect Column Values") == "expect_column_values"
    assert one(spark, text.schema_name(F.col("x")), x="a/b/ExpectColumnMax.json") == "ExpectColumnMax"
    with pytest.raises(PySparkException, match="no schema name"):
        one(spark, text.schema_name(F.col("x")), x="a/b/readme.md")


def test_urls(spark):
    record = F.from_json(
        F.lit('{"url": "u", "html_url": "h", "pulls_url": "p{/number}", "mirror_url": null, "name": "n", "id": 1}'),
        "map<string,string>",
    )
    urls = text.url_map(F.col("r"))
    assert one(spark, urls, r=record) == {"url": "u", "html": "h", "pulls": "p{/number}"}
    assert one(spark, text.pick_url(urls, "pulls"), r=record) == "p"
    assert one(spark, text.pick_url(urls, "pulls", with_params=True), r=record) == "p{/number}"
    assert one(spark, text.pick_url(urls), r=record) == "u"
    with pytest.raises(PySparkException, match="html, pulls, url"):
        one(spark, text.pick_url(urls, "issues"), r=record)


def test_url_keys_that_become_equal_keep_the_last(spark):
    record = F.from_json(F.lit('{"x_urlurl": "1", "xurl": "2"}'), "map<string,string>")
    assert one(spark, text.url_map(F.col("r")), r=record) == {"xurl": "2"}


def test_rows_helper_sorts_nulls_first(spark):
    assert rows(spark.createDataFrame([(2,), (None,), (1,)], "a int")) == [(None,), (1,), (2,)]
