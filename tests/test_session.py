"""Session helpers."""

from airlens.session import checkpoint_root, ensure_utc, scratch_dir


def test_scratch_lives_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root.rstrip("/") + "/airlens/x-")


def test_ensure_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
