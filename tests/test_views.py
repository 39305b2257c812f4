"""Compaction shapes and views on landed documents."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirelake.operators import compacted, views
from quirelake.operators.curation import curate_genres, genres_of_cards
from quirelake.sources import read_landing
from tests import landed
from tests.conftest import rows
from tests.landed import DAY1, DAY2


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landed.write(root, landed.edge_cases())

    def read(platform, target, *days):
        return read_landing(spark, str(root), platform, target, list(days) or None)

    return read


def test_weekday_lists(docs):
    pages = docs("naver", "titles")
    every = compacted.titles_of_all_weekdays(pages)
    assert rows(every.selectExpr("weekday_str", "title.titleId", "landing_date")) == [
        ("FRIDAY", 4, DAY2),
        ("MONDAY", 1, DAY1),
        ("MONDAY", 2, DAY1),
        ("THURSDAY", 2, DAY1),
        ("THURSDAY", 2, DAY1),
        ("THURSDAY", 3, DAY1),
        ("THURSDAY", 3, DAY2),
    ]
    own_day = compacted.titles_of_run_day(pages)
    assert rows(own_day.selectExpr("weekday_str", "title.titleId")) == [
        ("FRIDAY", 4),
        ("THURSDAY", 2),
        ("THURSDAY", 2),
        ("THURSDAY", 3),
    ]


def test_weekday_lists_read_as_a_struct(spark, docs):
    page = landed.edge_cases()["naver", "titles", DAY1]["titles"]
    text = spark.createDataFrame([(json.dumps(page),)], "doc string")
    kind = "titleListMap struct<MONDAY: {0}, TUESDAY: {0}, THURSDAY: {0}, SUNDAY: {0}>"
    listed = "array<struct<titleId: bigint>>"
    parsed = text.select(F.from_json("doc", kind.format(listed)).alias("d")).select("d.*")
    found = compacted.titles_of_all_weekdays(parsed)
    expected = compacted.titles_of_all_weekdays(docs("naver", "titles", DAY1))
    columns = ["weekday_str", "title.titleId"]
    assert rows(found, *columns) == rows(expected, *columns)


def test_finished_lists(docs):
    titles = views.naver_titles(compacted.finished_list(docs("naver", "finished_titles")), True)
    assert rows(titles, "id", "weekday", "release_day", "is_completed") == [
        (8, "FINISHED", 7, True),
        (9, "FINISHED", 7, True),
    ]


def test_info_weekdays(docs):
    info = views.naver_info_weekdays(docs("naver", "title_info", DAY1))
    assert rows(info, "title_id", "genre_name", "release_day") == [
        (2, "drama", 0), (2, "drama", 0), (2, "drama", 3), (2, "drama", 3),
        (2, "school", 0), (2, "school", 3), (8, "gag", 7), (9, "gag", 7),
    ]
    days = views.naver_title_days(docs("naver", "title_info", DAY1))
    assert rows(days.distinct(), "id", "release_day") == [(2, 0), (2, 3), (8, 7), (9, 7)]


def test_likes_and_comments(docs):
    likes = views.naver_likes(docs("naver", "episode_likes", DAY1))
    assert rows(likes, "title_id", "id", "likes", "response_date") == [
        (None, None, 3, DAY2), (2, 1, 5, DAY2), (2, 2, 7, DAY2), (2, 2, 9, DAY2), (3, 1, 4, DAY1),
    ]
    comments = views.naver_comments(docs("naver", "comments", DAY1))
    assert rows(comments, "title_id", "id", "comments") == [
        (None, None, 0), (2, 1, 11), (2, 6, 3), (3, 1, 8),
    ]


def test_empty_comment_list_alone_in_its_batch(docs):
    comments = views.naver_comments(docs("naver", "comments", DAY2))
    assert rows(comments, "title_id", "comments") == [(None, 0)]


def test_cards_and_keywords(docs):
    pages = compacted.sections(docs("kakao", "titles", DAY1))
    assert rows(views.kakao_titles(pages), "id", "author", "weekday", "genre_name") == [
        (51, "A / B", "목", "#love"),
        (51, "A / B", "월", "#love"),
        (51, "A / B", "월", "#school"),
        (53, "A / C", "월", "#gag"),
    ]
    kept = views.kakao_titles(pages, keep_empty=True)
    assert rows(kept.where("genre_name IS NULL"), "id") == [(52,), (54,)]
    genres = curate_genres(genres_of_cards(views.kakao_cards(pages)))
    assert rows(genres, "title_id", "genre_name") == [(51, "love"), (51, "school"), (53, "gag")]


def test_badges(docs):
    badges = views.kakao_views_by_badge(docs("kakao", "title_info", DAY1))
    assert rows(badges, "id", "views", "release_day") == [(51, 1000, 0), (51, 1000, 3), (58, 80, 5)]
    assert rows(views.kakao_views(docs("kakao", "title_info")), "id", "views") == [
        (51, 1000), (53, 30), (55, 5), (58, 80),
    ]


def test_path_keyed_views(docs):
    likes = views.kakao_likes(docs("kakao", "episode_likes"))
    assert rows(likes, "title_id", "id", "likes") == [
        (None, 504, 24), (51, 501, 21), (51, 502, 22), (51, 503, 23),
    ]
    comments = views.kakao_comments(compacted.with_path_keys(docs("kakao", "comments")))
    assert rows(comments, "title_id", "id", "comments") == [
        (51, 501, 31), (51, 503, 33), (51, 504, 34),
    ]


def test_opaque_documents_are_kept_whole(docs):
    info = docs("naver", "episode_info")
    assert rows(info.selectExpr("to_json(document)")) == [
        ('{"anything":[1,{"deep":"x"}]}',),
        ('{"other":"shape"}',),
    ]


def test_nothing_landed(docs):
    assert docs("kakao", "episode_likes", DAY2).count() == 0


lists = st.lists(st.lists(st.integers(1, 3), max_size=3), max_size=7)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(lists)
def test_explode_keeps_every_item(spark, by_day):
    data = [({landed.WEEKDAYS[i]: [(t,) for t in ts] for i, ts in enumerate(by_day)},)]
    pages = spark.createDataFrame(data, "titleListMap map<string, array<struct<titleId: int>>>")
    assert compacted.titles_of_all_weekdays(pages).count() == sum(map(len, by_day))
