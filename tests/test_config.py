"""The shared folder comes from the session, never invented when configured."""

from __future__ import annotations

from tillwright.config import scratch_path, shared_dir


def test_shared_dir_is_the_sessions_checkpoint_dir(spark):
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b
