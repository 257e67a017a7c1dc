"""The shared scratch folder."""

from ledger_sync.session import scratch_path


def test_scratch_lies_in_a_shared_folder(spark):
    first, second = scratch_path(spark, "staging"), scratch_path(spark, "staging")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = named or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    assert first.startswith(f"{root}/staging-") and first != second
    spark.range(1).write.parquet(first)


def test_the_checkpoint_folder_of_the_caller_is_not_touched(spark):
    before = spark.sparkContext.getCheckpointDir()
    scratch_path(spark, "staging")
    assert spark.sparkContext.getCheckpointDir() == before
