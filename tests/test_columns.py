"""Column functions on hand-made values, ANSI mode on."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quirelake import functions as q
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    "weekday,code",
    [("MONDAY", 0), ("SUNDAY", 6), ("월", 0), ("일", 6), ("mon", 0), ("sun", 6),
     ("FINISHED", 7), ("day", 7), ("monday", 7), ("", 7), (None, 7)],
)
def test_release_day(spark, weekday, code):
    assert one(spark, q.release_day(text(weekday))) == code


def test_weekday_key_agrees_with_release_day(spark):
    days = spark.range(14).select(F.date_add(F.lit(date(2025, 2, 24)), F.col("id").cast("int")).alias("d"))
    got = days.select(q.weekday_key("d").alias("k"), q.release_day(q.weekday_key("d")), F.weekday("d"))
    for key, code, weekday in rows(got):
        assert code == weekday
    assert got.where("k IS NULL").count() == 0


@pytest.mark.parametrize(
    "value,expected",
    [("25.02.27", date(2025, 2, 27)), ("95.01.02", date(2095, 1, 2)), ("25.02.29", None),
     ("2025-02-27", None), ("soon", None), ("", None), (None, None)],
)
def test_short_date(spark, value, expected):
    assert one(spark, q.short_date(text(value))) == expected


@pytest.mark.parametrize(
    "value,expected",
    [("2025-02-27T23:30:00", date(2025, 2, 27)), ("2025-02-27", date(2025, 2, 27)),
     ("2025-02-27T23:30:00-02:00", date(2025, 2, 28)), ("2025-02-27T10:00:00Z", date(2025, 2, 27)),
     ("n/a", None), (None, None)],
)
def test_iso_date(spark, value, expected):
    assert one(spark, q.iso_date(text(value))) == expected


def test_epoch_ms_date(spark):
    assert one(spark, q.epoch_ms_date(F.lit(1740614399999))) == date(2025, 2, 26)
    assert one(spark, q.epoch_ms_date(F.lit(1740614400000))) == date(2025, 2, 27)
    assert one(spark, q.epoch_ms_date(F.lit(None).cast("bigint"))) is None


@pytest.mark.parametrize(
    "path,title,stem,day",
    [("s3a://b/raw/kakao/comments/2025/02/27/51/501.json", "51", "501", date(2025, 2, 27)),
     ("file:/data/2001/01/01/x/raw/k/c/2025/02/27/51/501.v2.json", "51", "501", date(2025, 2, 27)),
     ("x.json", None, "x", None)],
)
def test_path_keys(spark, path, title, stem, day):
    p = F.lit(path)
    assert one(spark, q.path_title(p)) == title
    assert one(spark, q.path_stem(p)) == stem
    assert one(spark, q.landing_date(p)) == day


@pytest.mark.parametrize(
    "value,first,second",
    [("12_34", 12, 34), ("12", 12, None), ("a_b", None, None), ("", None, None),
     (None, None, None), ("1_2_3", 1, 2)],
)
def test_key_part(spark, value, first, second):
    assert one(spark, q.key_part(text(value), 0)) == first
    assert one(spark, q.key_part(text(value), 1)) == second


def test_join_names_skips_nulls(spark):
    names = F.array(F.lit("A"), F.lit(None), F.lit("C"))
    assert one(spark, q.join_names(names)) == "A / C"
    assert one(spark, q.join_names(F.array().cast("array<string>"))) == ""
    assert one(spark, q.join_names(F.lit(None).cast("array<string>"))) == ""


@pytest.mark.parametrize("value,rest", [("#ab", "ab"), ("ab", "b"), ("", ""), (None, None)])
def test_drop_prefix(spark, value, rest):
    assert one(spark, q.drop_prefix(text(value))) == rest


@pytest.mark.parametrize(
    "value,body",
    [('cb({"a": 1});', '{"a": 1}'), ('cb({"a": "(x)"});', '{"a": "(x)"}'), ("none", None),
     ("(", ""), (None, None)],
)
def test_jsonp_body(spark, value, body):
    assert one(spark, q.jsonp_body(text(value))) == body


def test_fill_template(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "title_id bigint, page bigint")
    url = q.fill_template("u/{title_id}?p={page}&x=1", title_id="title_id", page="page")
    assert rows(df.select(url)) == [(None,), ("u/1?p=2&x=1",)]


def test_first_item_of_empty_array(spark):
    assert one(spark, q.first_item(F.array().cast("array<int>"))) is None
    assert one(spark, q.first_item(F.lit(None).cast("array<int>"))) is None
    assert one(spark, q.first_item(F.array(F.lit(4), F.lit(5)))) == 4


def test_explode_or(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, xs array<string>")
    got = df.select("i", q.explode_or("xs", F.lit("day")).alias("x"))
    assert rows(got) == [(1, "a"), (1, "b"), (2, "day"), (3, "day")]
