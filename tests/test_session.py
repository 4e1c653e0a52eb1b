from pathlib import Path
from types import SimpleNamespace

import pytest

from tagledger.__main__ import main
from tagledger.session import scratch_root, scratch_scope, shuffles_sized_for, stage


def test_scratch_is_under_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert scratch_root(spark).startswith(named.rstrip("/"))
    assert scratch_root(spark).endswith(spark.sparkContext.applicationId)


def test_no_machine_local_scratch_on_a_cluster():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(RuntimeError):
        scratch_root(session)


def test_scope_removes_what_was_staged_inside(spark):
    kept = stage(spark.range(3), "kept")
    with scratch_scope(spark):
        inner = stage(spark.range(3), "inner")
        (folder,) = {str(Path(f).parent) for f in inner.inputFiles()}
        folder = Path(folder.removeprefix("file:"))
        assert inner.count() == 3 and folder.exists()
    assert not folder.exists() and kept.count() == 3


def test_shuffles_are_sized_and_set_back(spark, tmp_path, monkeypatch):
    (tmp_path / "f").write_bytes(b"x" * 1000)
    monkeypatch.setattr("tagledger.session.PARTITION_BYTES", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffles_sized_for(spark, str(tmp_path)) as count:
        assert count == 40 and spark.conf.get("spark.sql.shuffle.partitions") == "40"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_command_line(spark, tmp_path, capsys):
    roots = ["--bronze", str(tmp_path / "b"), "--silver", str(tmp_path / "s"), "--source", "shop"]
    assert main([*roots, "--run-date", "2026-08-04", "--run-hour", "06"]) == 0
    assert "no files for year=2026/month=08/day=04/hour=06" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main([*roots, "--run-date", "2026-08-04"])
