"""Scratch tables live in the shared folder and can be dropped."""

import os

from pickwise import workspace


def test_scratch_tables(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        assert workspace.scratch_root(spark).startswith(root.rstrip("/"))
    own = workspace.scratch_path(spark, "own-root")
    monkeypatch.setattr(workspace, "scratch_root", lambda _: own)
    df = workspace.materialize(spark.range(10), "numbers")
    assert df.count() == 10 and os.listdir(own)
    assert workspace.drop_scratch(spark)
    assert not os.path.exists(own)


def test_scope_deletes_all_but_what_is_kept(spark, monkeypatch):
    own = workspace.scratch_path(spark, "scope")
    monkeypatch.setattr(workspace, "scratch_root", lambda _: own)
    with workspace.scratch_scope(spark) as outer:
        with workspace.scratch_scope(spark) as keep:
            kept = workspace.materialize(spark.range(3), "kept")
            workspace.materialize(spark.range(4), "gone")
            keep(kept)
        assert [name.split("-")[0] for name in os.listdir(own)] == ["kept"] and kept.count() == 3
        last = workspace.materialize(spark.range(5), "last")
        outer(last)
    assert [name.split("-")[0] for name in os.listdir(own)] == ["last"] and last.count() == 5


def test_scope_cleans_up_after_an_error(spark, monkeypatch):
    own = workspace.scratch_path(spark, "scope")
    monkeypatch.setattr(workspace, "scratch_root", lambda _: own)
    try:
        with workspace.scratch_scope(spark):
            workspace.materialize(spark.range(3), "gone")
            raise ValueError
    except ValueError:
        assert os.listdir(own) == []
