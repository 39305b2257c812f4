"""The plans Spark picks for the operators that have to scale."""

import re

import pytest

from quirelake.operators import compacted, curation, frontier, views
from quirelake.plans import runs
from quirelake.plans import star_docs as docs
from quirelake.sources import read_curated, write_curated
from tests import landed
from tests.landed import DAY1, DAY2

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark):
    """Plan as if no side were small enough to broadcast by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: docs.table(spark, SF_DIR, name)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def chained(table):
    orders, lineitem = table("orders"), table("lineitem")
    return curation.curate_episodes(
        views.naver_episodes(compacted.articles(docs.naver_episode_docs(orders))),
        views.naver_likes(docs.naver_likes_docs(lineitem, orders)),
        views.naver_comments(docs.naver_comments_docs(lineitem, orders)),
    )


def test_chained_join_shuffles_each_input_once_for_both_joins(large):
    plan = final_plan(chained(large))
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\], \[[^\]]*\], LeftOuter", plan)
    assert len(joins) == 2 and all("__salt" in keys for keys in joins)
    salted = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "__salt" in x]
    assert len(salted) == 3
    assert "ReusedExchange" in plan


def test_nothing_is_shuffled_on_bare_keys_when_no_key_is_heavy(large):
    plan = final_plan(chained(large))
    bare = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
            if re.fullmatch(r"(title_id#\d+L, id#\d+L|id#\d+L, title_id#\d+L), \d+", x)]
    assert not bare and "__owner" in plan


def test_only_tables_of_bounded_size_are_broadcast(large):
    """The keys a sketch names and their exact counts; no side of a join, and no cut of either."""
    plan = plan_of(chained(large))
    built = re.findall(r"BroadcastHashJoin \[([^\]]*)\], \[([^\]]*)\], (\w+)", plan)
    assert built and all(
        kind == ("LeftSemi" if "__key" in right else "LeftOuter") for _, right, kind in built
    )
    assert not any("__salt" in left for left, _, _ in built)
    assert "Limit" not in plan and "TakeOrdered" not in plan


def test_documents_that_pass_through_are_packed_without_a_shuffle(spark, tmp_path, monkeypatch):
    from quirelake.sources import landing

    names = {f"{i // 10}/{i}": {"data": {"episodeId": i, "likeCount": i}} for i in range(40)}
    for day in (DAY1, DAY2):
        landed.write(tmp_path, {("kakao", "episode_likes", day): names})
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.json")) // 2
    monkeypatch.setattr(landing, "PACKED_BYTES", size // 2 + 1)
    read = landing.read_packed(spark, str(tmp_path), "kakao", "episode_likes", [DAY1, DAY2])
    assert "Exchange" not in plan_of(read) and read.count() == 80
    runs.optimize_days(spark, str(tmp_path), [DAY1, DAY2], ["kakao"])
    for day in ("27", "28"):
        files = list(tmp_path.glob(f"optimized/episode_likes/year=2025/month=02/day={day}/*/*.parquet"))
        assert 1 <= len(files) <= 2


def test_a_direct_run_parses_each_target_once(spark, tmp_path, monkeypatch):
    landed.write(tmp_path, landed.edge_cases())
    scanned = []
    plain = runs.read_landing

    def counted(spark, root, platform, target, *args, **options):
        scanned.append((platform, target))
        return plain(spark, root, platform, target, *args, **options)

    monkeypatch.setattr(runs, "read_landing", counted)
    read = runs.staged(runs.direct_source(spark, str(tmp_path), [DAY1, DAY2]), str(tmp_path))
    tables = runs.curate_tables(read, variant=runs.DIRECT)
    assert len(scanned) == len(set(scanned)) == 12
    scans = {t: final_plan(f).count("FileScan json") for t, f in tables.items()}
    # listings of the other platform and the title info come from the written stage
    assert scans["genres"] == 0 and scans["titles"] <= 3


def test_distinct_combines_before_the_shuffle(large):
    infos = views.naver_genres(docs.naver_info_docs(large("part")))
    plan = plan_of(curation.curate_genres(infos))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_all_weekdays_come_from_one_scan(large):
    titles = compacted.titles_of_all_weekdays(docs.naver_title_docs(large("part")))
    assert plan_of(views.naver_titles(titles)).count("FileScan") == 1


def test_top_rows_are_cut_before_the_shuffle(large):
    orders = large("orders").selectExpr("o_custkey AS title_id", "o_orderkey AS id")
    plan = plan_of(frontier.latest_episodes(orders, 10))
    assert "WindowGroupLimit" in plan
    below_shuffle = plan[plan.index("Exchange") :]
    assert "Partial" in below_shuffle


def test_scan_reads_only_what_is_asked(large):
    plan = plan_of(views.kakao_views(docs.kakao_view_docs(large("supplier"))))
    assert "ReadSchema: struct<s_suppkey:bigint,s_acctbal:double>" in plan


def test_curated_reader_lists_only_its_scope(spark, tmp_path):
    root = str(tmp_path)
    ddl = "landing_date date, platform string, title_id bigint, genre_name string"
    data = [(d, p, 1, "x") for d in (DAY1, DAY2) for p in ("naver", "kakao")]
    write_curated(spark.createDataFrame(data, ddl), root, "genres")
    scoped = read_curated(spark, root, "genres", [DAY2], ["kakao"])
    assert len(scoped.inputFiles()) == 1
    whole = read_curated(spark, root, "genres").where("day = 28 AND platform = 'kakao'")
    assert "PartitionFilters: [isnotnull(day" in plan_of(whole)


def test_date_filter_reaches_below_the_distinct(large):
    orders = large("orders")
    episodes = views.naver_episodes(compacted.articles(docs.naver_episode_docs(orders)))
    left = episodes.distinct().where("updated_date IS NOT NULL")
    plan = plan_of(left)
    assert plan.index("HashAggregate") < plan.index("Filter isnotnull")
