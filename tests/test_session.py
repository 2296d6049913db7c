"""Intermediate tables go under the session's checkpoint folder."""
from railpulse.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    d = ensure_checkpoint_dir(spark)
    assert d == checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a.startswith(d.rstrip("/") + "/tables/t-") and a != b
