"""Whole runs over a lake, against plain loops over the same documents."""

import os
import shutil
from glob import glob

import pytest

from quirelake.operators.skew import SkewPolicy
from quirelake.plans import runs
from quirelake.sources import read_curated, read_quarantine
from tests import brute, landed
from tests.conftest import in_order, rows
from tests.landed import DAY1, DAY2

BOTH = [DAY1, DAY2]


def lake(tmp_path, docs):
    landed.write(tmp_path, docs)
    return str(tmp_path)


def assert_curated(spark, root, docs, days, variant):
    expected = brute.curated(docs, days, variant)
    for table, columns in brute.COLUMNS.items():
        got = read_curated(spark, root, table)
        found = rows(got, "year", "month", "day", "platform", *columns)
        assert found == in_order(expected[table]), table


def test_days_edge_cases(spark, tmp_path):
    docs = landed.edge_cases()
    root = lake(tmp_path, docs)
    runs.run_days(spark, root, BOTH)
    assert_curated(spark, root, docs, BOTH, runs.DAILY)


def test_rerun_replaces_only_its_own_date(spark, tmp_path):
    docs = {k: v for k, v in landed.edge_cases().items() if k[0] == "naver"}
    root = lake(tmp_path, docs)
    runs.run_days(spark, root, BOTH, ["naver"])
    runs.run_days(spark, root, [DAY2], ["naver"])
    assert_curated(spark, root, docs, BOTH, runs.DAILY)
    before = read_curated(spark, root, "genres").count()
    runs.curate_days(spark, root, BOTH, ["naver"], mode="append")
    assert read_curated(spark, root, "genres").count() == 2 * before


def test_history_edge_cases(spark, tmp_path):
    docs = landed.edge_cases()
    root = lake(tmp_path, docs)
    runs.run_history(spark, root)
    assert_curated(spark, root, docs, BOTH, runs.HISTORY)


def test_rerun_of_a_date_that_lost_its_documents(spark, tmp_path):
    docs = {k: v for k, v in landed.edge_cases().items() if k[0] == "naver"}
    root = lake(tmp_path, docs)
    runs.run_days(spark, root, BOTH, ["naver"])
    shutil.rmtree(tmp_path / "raw/naver/titles" / f"{DAY1:%Y/%m/%d}")
    shutil.rmtree(tmp_path / "raw/naver/title_info" / f"{DAY1:%Y/%m/%d}")
    runs.run_days(spark, root, [DAY1], ["naver"])
    left = {k: v for k, v in docs.items()
            if not (k[2] == DAY1 and k[1] in ("titles", "title_info"))}
    assert_curated(spark, root, left, BOTH, runs.DAILY)


def files_of(root, *parts):
    found = glob("/".join([root, *parts, "**", "*.parquet"]), recursive=True)
    return {f: os.path.getmtime(f) for f in found}


def test_history_reads_and_writes_only_dates_with_new_files(spark, tmp_path):
    docs = landed.edge_cases()
    first = {k: v for k, v in docs.items() if k[2] == DAY1}
    root = lake(tmp_path, first)
    runs.run_history(spark, root)
    day1 = ("processed", "*", "year=2025", "month=02", "day=27")
    before = files_of(root, *day1), files_of(root, "historical", "optimized", "*", "*", f"landing_date={DAY1}")
    assert before[0] and before[1]
    lake(tmp_path, docs)  # the second date lands; files of the first are written as they were
    runs.run_history(spark, root)
    assert_curated(spark, root, docs, BOTH, runs.HISTORY)
    after = files_of(root, *day1), files_of(root, "historical", "optimized", "*", "*", f"landing_date={DAY1}")
    assert before == after
    untouched = files_of(root, "processed"), files_of(root, "historical", "optimized")
    runs.run_history(spark, root)
    assert untouched == (files_of(root, "processed"), files_of(root, "historical", "optimized"))
    runs.curate_history(spark, root, everything=True)
    assert_curated(spark, root, docs, BOTH, runs.HISTORY)


def test_history_goes_on_after_a_failure_between_its_stages(spark, tmp_path, monkeypatch):
    docs = landed.edge_cases()
    root = lake(tmp_path, docs)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(runs, "write_history", lost)
        with pytest.raises(RuntimeError):
            runs.run_history(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(runs, "write_curated", lost)
        with pytest.raises(RuntimeError):
            runs.run_history(spark, root)
    runs.run_history(spark, root)
    assert_curated(spark, root, docs, BOTH, runs.HISTORY)


def odd_listing():
    """A section list with something odd at every level, and the same without it."""
    card = lambda i: {"content": {"id": i, "title": f"k{i}", "authors": [{"name": "A"}],
                                  "featuredCharacterImageA": "/x", "seoKeywords": ["#a"]}}
    good = {"data": [{"title": "월", "cardGroups": [{"cards": [card(1), card(2)]}]}]}
    odd_card = card(2)
    odd_card["content"]["authors"] = ["B", {"name": "A"}, 5]
    odd = {"data": ["oops", {"title": "월", "cardGroups": [
        None, 7, {"cards": [card(1), 3, {"content": "text"}, odd_card, ["x"]]}, {"cards": "none"},
    ]}, {"title": "화", "cardGroups": {"a": 1}}, {"title": 3}]}
    return good, odd


@pytest.mark.parametrize("run", [runs.run_days, runs.run_history])
def test_odd_items_at_every_level_cost_only_themselves(spark, tmp_path, run):
    good, odd = odd_listing()
    names = {DAY1: "titles_월", DAY2: "titles_화"}
    for place, doc in (("good", good), ("odd", odd)):
        docs = {("kakao", "titles", day): {name: doc} for day, name in names.items()}
        lake(tmp_path / place, docs)
    cut = tmp_path / "odd/raw/kakao/titles/2025/02/27/titles_cut.json"
    cut.write_text('{"data": [{"title": "월", "card')
    options = {} if run is runs.run_history else {"dates": BOTH}
    for place in ("good", "odd"):
        run(spark, str(tmp_path / place), platforms=["kakao"], quarantine=True, **options)
    found = [{t: rows(f) for t, f in runs.read_scope(spark, str(tmp_path / p)).items()}
             for p in ("good", "odd")]
    assert found[0] == found[1] and len(found[0]["titles"]) == 4
    assert read_quarantine(spark, str(tmp_path / "good")).count() == 0
    held = read_quarantine(spark, str(tmp_path / "odd"), [DAY1], ["kakao"])
    assert rows(held, "target", "problem") == [("titles", "odd_items"), ("titles", "unreadable")]
    assert read_quarantine(spark, str(tmp_path / "odd")).count() == 3
    # mended documents leave the quarantine again
    if run is runs.run_days:
        cut.unlink()
        lake(tmp_path / "odd", {("kakao", "titles", DAY1): {names[DAY1]: good}})
        run(spark, str(tmp_path / "odd"), dates=[DAY1], platforms=["kakao"], quarantine=True)
        assert rows(read_quarantine(spark, str(tmp_path / "odd")), "day") == [(28,)]


def test_choices_reach_the_runs(spark, tmp_path):
    root = lake(tmp_path, landed.edge_cases())
    found = {}
    for choice in ({}, {"keep_empty": True}, {"join": "star"}):
        runs.run_days(spark, root, BOTH, **choice)
        found[str(choice)] = {t: rows(f) for t, f in runs.read_scope(spark, root).items()}
        source = runs.direct_source(spark, root, BOTH, all_weekdays=False)
        want = runs.curate_tables(source, variant=runs.DAILY, **choice)
        for table, frame in want.items():
            assert frame.count() == len(found[str(choice)][table])
    plain, kept, star = found.values()
    assert len(kept["titles"]) > len(plain["titles"]) and star["episodes"] != plain["episodes"]


def test_history_under_one_date(spark, tmp_path):
    only = {k: v for k, v in landed.edge_cases().items() if k[2] == DAY2}
    as_day1 = {(p, t, DAY1): f for (p, t, _), f in only.items()}
    root = lake(tmp_path, only)
    runs.run_history(spark, root, dates=[DAY2], as_of=DAY1)
    assert_curated(spark, root, as_day1, [DAY1], runs.HISTORY)


def test_direct_edge_cases(spark, tmp_path):
    docs = landed.edge_cases()
    root = lake(tmp_path, docs)
    runs.run_direct(spark, root, BOTH)
    assert_curated(spark, root, docs, BOTH, runs.DIRECT)


def test_direct_limited_to_titles(spark, tmp_path):
    root = lake(tmp_path, landed.edge_cases())
    wanted = spark.createDataFrame([(2,), (51,)], "title_id bigint")
    limits = {"titles": wanted}, {"folders": ["2", "51"]}
    by_frame, by_folder = (
        rows(runs.curate_tables(source, variant=runs.DIRECT)["episodes"])
        for source in (runs.direct_source(spark, root, [DAY1], **limit) for limit in limits)
    )
    assert by_frame == by_folder
    assert {r[2] for r in by_frame} == {2, 51}


def test_one_platform_leaves_the_other_alone(spark, tmp_path):
    docs = landed.edge_cases()
    root = lake(tmp_path, docs)
    runs.run_days(spark, root, [DAY1], platforms=["naver"])
    runs.run_days(spark, root, [DAY1], platforms=["kakao"])
    assert_curated(spark, root, docs, [DAY1], runs.DAILY)


@pytest.mark.parametrize("variant", [runs.DAILY, runs.HISTORY, runs.DIRECT])
@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, tmp_path, seed, variant):
    docs = landed.random_docs(seed)
    root = lake(tmp_path, docs)
    source = runs.direct_source(spark, root, BOTH, all_weekdays=variant.all_weekdays)
    spread = SkewPolicy(min_rows=2)
    expected = brute.curated(docs, BOTH, variant)
    for table, frame in runs.curate_tables(source, variant=variant, policy=spread).items():
        dated = frame.selectExpr(
            "year(landing_date)", "month(landing_date)", "day(landing_date)", "platform",
            *brute.COLUMNS[table],
        )
        assert rows(dated) == in_order(expected[table]), table


def test_empty_lake_gives_empty_tables(spark, tmp_path):
    runs.run_days(spark, str(tmp_path), [DAY1])
    for frame in runs.read_scope(spark, str(tmp_path)).values():
        assert frame.count() == 0
