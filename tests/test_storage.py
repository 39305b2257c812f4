"""Compaction, inventory, selection and the Parquet layers."""

import json
import os
import shutil
from datetime import timedelta
from glob import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quirelake import sources
from quirelake.operators.compacted import articles
from quirelake.sources.layout import backup_path, landing_path, merged_path
from quirelake.streaming import compact, pending, read_ledger, read_merged
from tests import landed
from tests.conftest import rows
from tests.landed import DAY1, DAY2


@pytest.fixture
def root(tmp_path):
    landed.write(tmp_path, landed.edge_cases())
    return str(tmp_path)


def parquet_files(path):
    return glob(os.path.join(path, "**", "*.parquet"), recursive=True)


def test_paths_name_only_what_is_asked():
    assert landing_path("r", "naver", "titles") == "r/raw/naver/titles"
    one = landing_path("r", "naver", "episodes", [DAY1], ["2"])
    assert one == "r/raw/naver/episodes/2025/02/27/2"
    two = landing_path("r", "naver", "episodes", [DAY1, DAY2])
    assert two == "r/raw/naver/episodes/{2025/02/27,2025/02/28}"


def test_files_elsewhere_are_not_read(spark, root):
    stray = {("naver", "episodes", DAY1): {"stray": {"titleId": 99}, "a/b/c": {"titleId": 98}}}
    landed.write(Path(root), stray)
    docs = sources.read_landing(spark, root, "naver", "episodes", [DAY1])
    assert rows(docs, "titleId") == [(2,), (3,), (9,)]


def test_compaction_resumes(spark, root):
    assert compact(spark, root, "naver", "comments", files_per_batch=2) == 5
    assert read_merged(spark, root, "naver", "comments").count() == 5
    assert compact(spark, root, "naver", "comments", files_per_batch=2) == 0
    late = {("naver", "comments", DAY1): {"7/1": {"result": {"count": {"total": 0}}}}}
    landed.write(Path(root), late)
    path = f"{root}/raw/naver/comments/2025/02/27/7/1.json"
    os.utime(path, (0, 0))  # an old time stamp does not hide a new file
    assert compact(spark, root, "naver", "comments", files_per_batch=2) == 1
    merged = read_merged(spark, root, "naver", "comments")
    assert merged.count() == 6
    assert merged.select("filename").distinct().count() == 6
    assert rows(merged.groupBy("landing_date").count()) == [(DAY1, 5), (DAY2, 1)]


def test_compaction_file_count(spark, root):
    compact(spark, root, "naver", "episode_likes", output_files=2)
    batches = glob(merged_path(root, "naver", "episode_likes") + "/landing_date=*/batch=*")
    assert len(batches) == 2  # one per date
    assert all(1 <= len(parquet_files(batch)) <= 2 for batch in batches)


def dated_info(root, days):
    for i, day in enumerate(days):
        docs = {("naver", "title_info", day): {str(i): {"gfpAdCustomParam": {"titleId": i}}}}
        landed.write(Path(root), docs)


def test_count_above_a_hundred_batches(spark, tmp_path):
    days = [DAY1 + timedelta(days=i) for i in range(103)]
    dated_info(tmp_path, days)
    assert compact(spark, str(tmp_path), "naver", "title_info", files_per_batch=40) == 103
    ledger = read_ledger(spark, str(tmp_path), "naver", "title_info")
    assert ledger.where("batch = 0 AND documents = 1").count() == 103
    merged = read_merged(spark, str(tmp_path), "naver", "title_info", days[7:9])
    assert rows(merged, "gfpAdCustomParam.titleId", "landing_date") == [(7, days[7]), (8, days[8])]


def test_batch_written_but_not_entered_is_written_anew(spark, root):
    compact(spark, root, "naver", "comments")
    # as if the driver was lost before the ledger was written for the second date
    shutil.rmtree(f"{root}/checkpoints/naver/comments/ledger/landing_date={DAY2}")
    assert rows(read_merged(spark, root, "naver", "comments"), "landing_date") == [(DAY1,)] * 4
    late = {("naver", "comments", DAY2): {"7/1": {"result": {"count": {"total": 0}}}}}
    landed.write(Path(root), late)
    assert compact(spark, root, "naver", "comments") == 2
    merged = read_merged(spark, root, "naver", "comments")
    assert merged.count() == 6 and merged.select("filename").distinct().count() == 6


def test_ledger_knows_odd_names_and_empty_files(spark, tmp_path):
    days = [DAY1]
    dated_info(tmp_path, days)
    folder = tmp_path / "raw/naver/title_info/2025/02/27"
    (folder / "empty.json").write_text("[]")
    (folder / "a {b} [c] 100%.json").write_text('{"gfpAdCustomParam": {"titleId": 5}}')
    assert compact(spark, str(tmp_path), "naver", "title_info") == 2
    ledger = read_ledger(spark, str(tmp_path), "naver", "title_info")
    assert rows(ledger, "documents") == [(0,), (1,), (1,)]
    assert compact(spark, str(tmp_path), "naver", "title_info") == 0
    assert pending(spark, str(tmp_path), "naver", "title_info").count() == 0


def test_changes_between_inventories(spark, root):
    folder = f"{root}/raw/kakao/episode_likes/2025/02/27"
    before = sources.inventory(spark, root, "kakao", "episode_likes").collect()
    ddl = "path string, length bigint, modified timestamp, filename string, landing_date date"
    names = sorted(glob(f"{folder}/**/*.json", recursive=True))
    os.remove(names[0])
    Path(names[1]).write_text(Path(names[1]).read_text() + "    ")
    Path(names[2]).write_text("{}")
    late = {("kakao", "episode_likes", DAY2): {"9/9": {"data": {"episodeId": 9}}}}
    landed.write(Path(root), late)
    after = sources.inventory(spark, root, "kakao", "episode_likes")
    changes = sources.inventory_changes(spark.createDataFrame(before, ddl), after)
    got = rows(changes, "change", "landing_date")
    assert got == [("added", DAY2), ("changed", DAY1), ("gone", DAY1), ("grown", DAY1)]
    assert sources.inventory_changes(after, after).count() == 0


def test_compaction_of_one_date(spark, root):
    compact(spark, root, "naver", "episodes", dates=[DAY2])
    assert rows(read_merged(spark, root, "naver", "episodes"), "landing_date") == [(DAY2,)]


def test_compaction_of_nothing(spark, root):
    assert compact(spark, root, "kakao", "nothing", schema="x int") == 0


def test_inventory(spark, root):
    files = sources.inventory(spark, root, "kakao", "episode_likes")
    assert files.count() == 4
    assert files.where("length > 0 AND modified IS NOT NULL").count() == 4
    assert "content" not in files.columns


def test_pinned_schema_can_be_widened(spark, root):
    wide = "titleListMap map<string, array<struct<titleId: bigint, unread: struct<x: int>>>>"
    docs = sources.read_landing(spark, root, "naver", "titles", [DAY2], schema=wide)
    got = docs.selectExpr("titleListMap['FRIDAY'][0].unread.x")
    assert rows(got) == [(1,)]


def test_explicit_files(spark, root):
    paths = [f"{root}/raw/kakao/title_info/2025/02/27/{i}.json" for i in (51, 58)]
    docs = sources.read_files(spark, paths, "kakao", "title_info")
    assert rows(docs, "data.id", "landing_date") == [(51, DAY1), (58, DAY1)]


def test_one_document_per_line(spark, tmp_path):
    folder = tmp_path / "raw/naver/title_info/2025/02/27"
    folder.mkdir(parents=True)
    lines = [json.dumps({"gfpAdCustomParam": {"titleId": i}}) for i in range(3)]
    (folder / "all.json").write_text("\n".join(lines))
    docs = sources.read_landing(
        spark, str(tmp_path), "naver", "title_info", [DAY1], multiline=False
    )
    assert rows(docs, "gfpAdCustomParam.titleId") == [(0,), (1,), (2,)]


def test_optimized_layout_and_scopes(spark, root):
    shaped = articles(sources.read_landing(spark, root, "naver", "episodes"))
    for _ in range(2):
        sources.write_optimized(shaped, root, "naver", "episodes", max_files=10)
    day = f"{root}/optimized/episodes/year=2025/month=02/day=27/platform=naver"
    assert 1 <= len(parquet_files(day)) <= 10
    read = sources.read_optimized(spark, root, "naver", "episodes")
    assert rows(read.groupBy("landing_date").count()) == [(DAY1, 8), (DAY2, 1)]
    one = sources.read_optimized(spark, root, "naver", "episodes", [DAY2])
    assert rows(one, "title_id", "article.no") == [(2, 1)]
    assert sources.read_optimized(spark, root, "kakao", "episodes").count() == 0


def test_append_keeps_what_was_there(spark, root):
    shaped = articles(sources.read_landing(spark, root, "naver", "episodes", [DAY2]))
    for mode in ("overwrite", "append", "append"):
        sources.write_optimized(shaped, root, "naver", "episodes", mode=mode)
    assert sources.read_optimized(spark, root, "naver", "episodes").count() == 3


def curated(spark, *data):
    ddl = "landing_date date, platform string, title_id bigint, genre_name string"
    return spark.createDataFrame(list(data), ddl)


def test_curated_overwrite_is_per_partition(spark, tmp_path):
    root = str(tmp_path)
    first = curated(spark, (DAY1, "naver", 1, "a"), (DAY1, "kakao", 2, "b"), (DAY2, "naver", 3, "c"))
    sources.write_curated(first, root, "genres")
    sources.write_curated(curated(spark, (DAY1, "naver", 9, "z")), root, "genres")
    whole = sources.read_curated(spark, root, "genres")
    assert rows(whole, "title_id", "month", "platform") == [
        (2, 2, "kakao"), (3, 2, "naver"), (9, 2, "naver"),
    ]
    assert rows(sources.read_curated(spark, root, "genres", [DAY1]), "title_id") == [(2,), (9,)]
    scoped = sources.read_curated(spark, root, "genres", [DAY1], ["kakao"])
    assert rows(scoped, "title_id", "platform") == [(2, "kakao")]
    assert sources.read_curated(spark, root, "genres", platforms=["naver"]).count() == 2


def test_a_rerun_empties_what_it_no_longer_finds(spark, tmp_path):
    root = str(tmp_path)
    first = curated(spark, (DAY1, "naver", 1, "a"), (DAY1, "kakao", 2, "b"), (DAY2, "naver", 3, "c"))
    sources.write_curated(first, root, "genres")
    scope = [(DAY1, "naver"), (DAY2, "naver"), (DAY2, "kakao")]
    # rows outside of the scope are none of this commit's business
    rerun = curated(spark, (DAY2, "naver", 4, "d"), (DAY1, "kakao", 9, "z"))
    for _ in range(2):
        sources.write_curated(rerun, root, "genres", scope=scope)
        whole = sources.read_curated(spark, root, "genres")
        assert rows(whole, "title_id", "platform") == [(2, "kakao"), (4, "naver")]
    sources.write_curated(rerun.limit(0), root, "genres", scope=scope[1:])
    assert rows(sources.read_curated(spark, root, "genres"), "title_id") == [(2,)]
    sources.write_curated(first, root, "genres", mode="append", scope=scope)
    assert rows(sources.read_curated(spark, root, "genres"), "title_id") == [(1,), (2,), (3,)]


def test_views_for_sql(spark, tmp_path):
    root = str(tmp_path)
    sources.write_curated(curated(spark, (DAY1, "naver", 1, "a")), root, "genres")
    sources.register_views(spark, root)
    assert rows(spark.sql("SELECT genre_name FROM genres")) == [("a",)]
    assert rows(spark.sql("SELECT count(*) FROM titles")) == [(0,)]


def test_backup_overwrites(spark, tmp_path):
    frame = spark.range(100)
    for _ in range(2):
        sources.backup(frame, str(tmp_path), "naver", "titles", max_files=5)
    path = backup_path(str(tmp_path), "naver", "titles")
    assert spark.read.parquet(path).count() == 100
    assert len(parquet_files(path)) <= 5


def test_preview(spark):
    frame = spark.range(1_000)
    assert sources.preview(frame).count() == 25
    assert rows(sources.preview(frame, 3, ["id"])) == [(0,), (1,), (2,)]


def test_documents_of_some_titles(spark, root):
    docs = sources.read_landing(spark, root, "naver", "episodes", [DAY1])
    wanted = spark.createDataFrame([(3,), (3,), (77,)], "title_id bigint")
    assert rows(sources.of_titles(docs, wanted), "titleId") == [(3,)]
    assert docs.where(F.col("titleId") == 3).count() == 1


def test_days_compacted_elsewhere(spark, root):
    """Compacted days with inferred schemas, more fields and file names as keys."""
    from quirelake.plans import runs

    part = "year=2025/month=02/day=27/platform=kakao"

    def raw(target):
        path = f"{root}/raw/kakao/{target}/2025/02/27"
        reader = spark.read.option("recursiveFileLookup", "true")
        return reader.json(path, multiLine=True).select("*", "_metadata.file_path")

    named = {"filename": F.col("file_path")}
    segment = lambda i: F.element_at(F.split("file_path", "/"), i)
    keyed = named | {"title_id": segment(-2), "episode_id": segment(-1)}
    frames = {
        "titles": raw("titles").select(F.explode("data").alias("data")),
        "title_info": raw("title_info").drop("file_path"),
        "episodes": raw("episodes").select(F.explode("data.episodes").alias("episodes")),
        "episode_likes": raw("episode_likes").withColumns(named).drop("file_path"),
        "comments": raw("comments").withColumns(keyed).drop("file_path"),
    }
    for target, frame in frames.items():
        frame.write.parquet(f"{root}/optimized/{target}/{part}")
    runs.curate_days(spark, root, [DAY1], ["kakao"])
    found = {t: rows(f) for t, f in runs.read_scope(spark, root).items()}
    runs.run_days(spark, root, [DAY1], ["kakao"])
    assert found == {t: rows(f) for t, f in runs.read_scope(spark, root).items()}
    assert len(found["episodes"]) == 3


@pytest.fixture
def open_files(spark, monkeypatch):
    """What the session says of files side by side, at every write to Parquet."""
    from pyspark.sql import DataFrameWriter

    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        seen.append((path, spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return plain(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_partitions_are_written_without_a_sort(spark, tmp_path, open_files):
    from datetime import date

    from quirelake.sources import tables

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    days = [(i, date(2025, 3, 1 + i % 12)) for i in range(60)]
    rows = spark.createDataFrame(days, "id long, landing_date date").coalesce(1)
    for mode in ("overwrite", "append"):
        tables._save(rows, f"{tmp_path}/t", ["landing_date"], mode, None)
    assert [int(n) for _, n in open_files] == [tables.OPEN_FILES] * 2
    assert spark.conf.get(setting) == before
    read = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(map(tuple, read.select("id", "landing_date").collect())) == sorted(days * 2)


def test_batches_are_merged_without_a_sort(spark, root, open_files):
    compact(spark, root, "naver", "episodes")
    merged = merged_path(root, "naver", "episodes")
    assert [int(n) for path, n in open_files if path == merged] == [8]
    assert read_merged(spark, root, "naver", "episodes").count() > 0


def test_many_files_are_looked_up_by_few_tasks(spark, tmp_path):
    from quirelake.sources import tables

    files = tables.LISTING_TASKS + 22
    folder = tmp_path / "raw/naver/episodes/2025/02/27/1"
    folder.mkdir(parents=True)
    for n in range(files):
        (folder / f"{n}.json").write_text('{"titleId": 1, "articleList": []}')
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.sparkContext.setJobGroup("looked up", "looked up")
    try:
        assert compact(spark, str(tmp_path), "naver", "episodes", multiline=False) == files
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup("looked up") for s in status.getJobInfo(j).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages if status.getStageInfo(s)]
    assert max(tasks) == tables.LISTING_TASKS
    assert spark.conf.get(setting) == before


def test_a_file_each_is_written_by_many_tasks(spark, tmp_path):
    from __spark_entry__ import queries

    shared = spark.conf.get("spark.checkpoint.dir")
    there = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    columns = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    suppliers = [(n, f"s{n}", n % 5, float(n % 3 - 1)) for n in range(40)] + [(None, None, None, None)]
    spark.createDataFrame(suppliers, columns).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    found = rows(queries()["quarantined_documents"](spark, str(tmp_path)))
    assert len([r for r in found if r[0] == "title"]) == 33
    [new] = set(os.listdir(shared)) - there
    files = glob(f"{shared}/{new}/raw/kakao/finished_titles/2025/02/27/*.json")
    assert len(files) == 41
    assert len({os.path.basename(f).split("-")[1] for f in files}) > 1


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_landed_files_are_dated_by_counted_names(spark, root):
    from quirelake.functions import landing_date

    for target in ("titles", "episodes"):
        docs = sources.read_landing(spark, root, "naver", target)
        assert "regexp_extract" not in _plan(docs)
        named = docs.select("landing_date", landing_date("filename").alias("searched"))
        assert named.count() > 0
        assert named.where("NOT landing_date <=> searched").count() == 0
    paths = ["file:/l/raw/2024/01/01/2025/02/27/f.json", "file:/l/2025/13/27/f.json", "file:/f.json"]
    made = spark.createDataFrame([(p,) for p in paths], "filename string")
    found = sources.landing.at_depth(made, "titles")
    assert [(r.filename, str(r.landing_date)) for r in found.collect()] == [
        (paths[0], "2025-02-27"), (paths[1], "None")]


def test_listed_items_are_read_once(spark, root):
    for platform in ("naver", "kakao"):
        plan = _plan(sources.read_landing(spark, root, platform, "titles"))
        assert "schema_of_variant" not in plan
    listed = _plan(sources.read_landing(spark, root, "naver", "titles"))
    assert listed.count("try_variant_get") == 1


def test_partition_texts_are_made_once_a_partition(spark):
    from quirelake.sources import tables

    data = [(1, DAY1, "naver"), (1, DAY1, "naver"), (2, DAY2, "naver"), (3, None, "naver"), (4, DAY1, None)]
    made = spark.createDataFrame(data, "id long, landing_date date, platform string")
    for scope in ([(DAY1, "naver"), (DAY1, "naver")], [(DAY1, "naver"), (DAY2, "naver")], None):
        expected = tables.partitioned(tables.in_scope(made, scope))
        found = tables.scope_partitioned(made, scope)
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found, *expected.columns) == rows(expected)


def test_fresh_history_is_written_as_it_lies(spark, root, monkeypatch):
    from quirelake.plans import runs
    from quirelake.sources import tables

    moved, plain = [], tables.in_files
    monkeypatch.setattr(tables, "in_files", lambda df, by, n=None: moved.append(by) or plain(df, by, n))
    runs.compact_history(spark, root, platforms=["naver"])
    assert ["platform", "landing_date"] not in moved
    first = sources.read_history(spark, root, "naver", "episodes")
    held, day = rows(first.select("title_id", "article.no")), first.first().landing_date
    again = Path(root) / f"raw/naver/episodes/{day:%Y/%m/%d}/77"
    again.mkdir(parents=True)
    (again / "0.json").write_text('{"titleId": 77, "articleList": [{"no": 1}]}')
    runs.compact_history(spark, root, platforms=["naver"])
    assert moved.count(["platform", "landing_date"]) == 1
    found = sources.read_history(spark, root, "naver", "episodes").select("title_id", "article.no")
    assert rows(found) == sorted([*held, (77, 1)], key=lambda t: tuple((v is not None, str(v)) for v in t))
