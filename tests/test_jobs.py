"""The command line."""

from datetime import date

import jobs
from quirelake.sources import read_curated
from tests import landed


def test_dates():
    args = jobs.arguments(["days", "--root", "r", "--first", "2025-02-27", "--end", "2025-03-02"])
    assert jobs.dates_of(args) == [date(2025, 2, 27), date(2025, 2, 28), date(2025, 3, 1)]
    assert jobs.dates_of(jobs.arguments(["days", "--root", "r"])) == [date.today()]


def test_optimize_curate_read(spark, tmp_path, capsys):
    landed.write(tmp_path, landed.edge_cases())
    common = ["--root", str(tmp_path), "--date", "2025-02-27", "--platform", "kakao"]
    jobs.main(["optimize", *common], spark)
    jobs.main(["curate", *common], spark)
    assert read_curated(spark, str(tmp_path), "titles").count() == 3
    jobs.main(["read", *common], spark)
    shown = capsys.readouterr().out
    assert "genres" in shown and "school" in shown


def test_direct_with_backup(spark, tmp_path, capsys):
    landed.write(tmp_path, landed.edge_cases())
    common = ["--root", str(tmp_path), "--date", "2025-02-27"]
    jobs.main(["direct", *common, "--backup", "--show"], spark)
    assert "episodes" in capsys.readouterr().out
    saved = {
        (platform, name): spark.read.parquet(f"{tmp_path}/temp/{platform}/{name}").count()
        for platform in ("naver", "kakao")
        for name in ("finished_titles", "finished_episode_likes")
    }
    assert saved == {
        ("naver", "finished_titles"): 2,
        ("naver", "finished_episode_likes"): 5,
        ("kakao", "finished_titles"): 1,
        ("kakao", "finished_episode_likes"): 4,
    }
