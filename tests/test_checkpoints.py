from pathlib import Path

from lodeworks.operators import checkpoints


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """They would lie on the executors' disks until the driver collects its garbage."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for folder in found for f in Path(folder.getPath()).rglob("shuffle_*.data")}

    before = files()
    setting = spark.conf.get(checkpoints.CLEANUP, None)
    rows = spark.range(1000).groupBy("id").count()
    stored = checkpoints.store(rows, checkpoints.scratch_path(spark, "stored"))
    assert not files() - before
    assert stored.count() == rows.count() == 1000
    assert spark.conf.get(checkpoints.CLEANUP, None) == setting
