"""Follow-up work tables on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from quirelake.operators import frontier
from quirelake.sources import read_files, read_landing
from tests import landed
from tests.conftest import rows
from tests.landed import DAY1, DAY2


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landed.write(root, landed.edge_cases())
    return lambda platform, target: read_landing(spark, str(root), platform, target, [DAY1])


def test_harvest(docs):
    lists = docs("naver", "titles")
    assert rows(frontier.naver_title_ids(lists)) == [(1,), (2,), (3,)]
    assert rows(frontier.naver_title_ids(lists, F.lit("THURSDAY"))) == [(2,), (3,)]
    # the second card group of a page is not harvested
    assert rows(frontier.kakao_title_ids(docs("kakao", "titles"))) == [(51,), (52,), (54,)]


def test_ongoing_and_finished_may_repeat(spark):
    a = spark.createDataFrame([(1,), (2,)], "title_id int")
    assert frontier.all_title_ids(a, a).count() == 4


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_numbered(spark, block):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (4, 1), (5, -1)], "t int, n bigint")
    got = frontier.numbered(df, "n", "i", block=block)
    assert rows(got, "t", "i") == [(1, i) for i in range(1, 6)] + [(4, 1)]


def test_numbered_spreads_a_large_count(spark):
    df = spark.createDataFrame([(1, 40_000)], "t int, n bigint")
    got = frontier.numbered(df, "n", "i", block=100)
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    assert got.agg(F.sum("i")).first()[0] == 40_000 * 40_001 // 2


def test_latest_episodes(spark):
    data = [(1, i) for i in range(1, 6)] + [(2, 9)]
    df = spark.createDataFrame(data, "title_id int, id int")
    assert rows(frontier.latest_episodes(df, 2), "title_id", "id", "rank") == [
        (1, 4, 2), (1, 5, 1), (2, 9, 1),
    ]


def test_of_copies_the_last_file_counts(spark):
    data = [(1, 7, "b", "x/2.json"), (1, 7, "z", "x/1.json"), (1, 6, "q", "x/1.json")]
    df = spark.createDataFrame(data, "title_id int, id int, title string, filename string")
    for frame in (df, df.orderBy("filename").repartition(3)):
        assert rows(frontier.latest_episodes(frame, 1), "id", "title") == [(7, "b")]


def test_platforms_do_not_hide_each_other(spark):
    ids = spark.createDataFrame([(1,), (2,)], "title_id int")
    titles = frontier.of_platform(ids, "naver").unionByName(frontier.of_platform(ids, "kakao"))
    counts = spark.createDataFrame([(1, 4, "naver")], "title_id int, episodes bigint, platform string")
    assert rows(frontier.uncovered(titles, counts), "title_id", "platform") == [
        (1, "kakao"), (2, "kakao"), (2, "naver"),
    ]


def test_free_only(spark, docs):
    from quirelake.operators.compacted import listed_episodes

    listed = frontier.kakao_listed_episodes(listed_episodes(docs("kakao", "episodes")))
    assert rows(frontier.free_episodes(listed), "id") == [(501,), (502,), (504,)]


def test_uncovered(spark):
    titles = spark.createDataFrame([(1,), (2,), (3,)], "title_id int")
    counts = spark.createDataFrame([(1, 4), (2, 0)], "title_id int, episodes bigint")
    assert rows(frontier.uncovered(titles, counts)) == [(2,), (3,)]


def test_flags(docs):
    comments = frontier.comments_flags(docs("naver", "comments"))
    assert comments.where("no_comments").count() == 1
    likes = frontier.likes_flags(docs("naver", "episode_likes"))
    flagged = frontier.exceptions(likes, "no_likes", F.col("contents")[0]["contentsId"])
    assert rows(flagged) == [("2_6", "no_likes")]
    lists = frontier.articles_flags(docs("naver", "episodes"))
    assert rows(lists.where("no_articles"), "titleId") == [(9,)]
    assert frontier.listing_flags(docs("naver", "titles")).where("odd_items").count() == 0


def test_odd_items_and_unreadable_listings(spark, tmp_path):
    folder = tmp_path / "raw/naver/titles/2025/02/27"
    folder.mkdir(parents=True)
    texts = {
        "odd": '{"titleListMap": {"MONDAY": [{"titleId": 1}, "oops", 7, null, {"titleId": 2}],'
        ' "TUESDAY": null, "FRIDAY": [{"titleId": 3, "author": ["a"], "viewCount": "many"}]}}',
        "fine": '{"titleListMap": {"MONDAY": [{"titleId": 4, "titleName": "t", "more": 1}]}}',
        "cut": '{"titleListMap": {"MONDAY": [{"titleId": 5}, {"titl',
        "nameless": '{"titleListMap": {"MONDAY": [{"titleName": "t"}]}}',
        "empty": "{}",
    }
    for name, text in texts.items():
        (folder / f"{name}").mkdir()
        (folder / f"{name}/titles.json").write_text(text)
    path = str(folder)
    docs = read_files(spark, path, "naver", "titles", report=True)
    ids = frontier.naver_title_ids(docs)
    assert rows(ids.where("title_id IS NOT NULL")) == [(1,), (2,), (3,), (4,)]
    name = F.element_at(F.split("filename", "/"), -2)
    flags = frontier.listing_flags(docs).select(name, "odd_items", "unreadable")
    assert rows(flags) == [
        ("cut", False, True), ("empty", False, False), ("fine", False, False),
        ("nameless", True, False), ("odd", True, False),
    ]
    plain = read_files(spark, path, "naver", "titles")
    assert rows(frontier.naver_title_ids(plain).where("title_id IS NOT NULL")) == rows(
        ids.where("title_id IS NOT NULL")
    )
    assert plain.columns == ["titleListMap", "filename", "landing_date"]
    none = read_landing(spark, str(tmp_path), "naver", "titles", [DAY2], report=True)
    assert frontier.listing_flags(none).count() == 0
