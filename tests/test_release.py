"""Scratch tables of one application go when they are released."""

from __future__ import annotations

from pathlib import Path

import panelloom.session as session


def test_release_deletes_only_the_applications_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_folder", lambda _: str(tmp_path / "mine"))
    spark.range(3).write.parquet(session.fresh_path(spark, "t"))
    other = tmp_path / "other"
    other.mkdir()
    assert list(Path(tmp_path / "mine").iterdir())
    session.release_scratch(spark)
    assert not (tmp_path / "mine").exists() and other.exists()
