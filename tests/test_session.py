"""The shared work folder and written stages."""

from tristar.plans.inspect import plan_text
from tristar.session import batch_bytes, ensure_checkpoint_dir, scratch_dir, write_stage


def test_work_folder_is_the_configured_one(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/x-")


def test_write_stage_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    staged = write_stage(df, "stage-test")
    assert sorted(tuple(r) for r in staged.collect()) == [(i, 2 * i) for i in range(100)]
    assert "Range" not in plan_text(staged)        # reads the written files, not the source


def test_batch_bytes_scales_with_parallelism(spark):
    assert batch_bytes(spark, waves=1, split_bytes=1) == spark.sparkContext.defaultParallelism
