import os

from lakeloom.session import durable, release, scratch_path, shared_dir


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert scratch_path(spark, "a").startswith(shared_dir(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_durable_rows_cut_lineage(spark):
    kept = durable(spark.range(5))
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3, 4]
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_release_removes_only_this_application(spark, tmp_path, monkeypatch):
    import lakeloom.session as session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    durable(spark.range(3))
    (tmp_path / "other").mkdir()
    assert release(spark)
    assert os.listdir(tmp_path / "lakeloom") == [] and (tmp_path / "other").exists()
