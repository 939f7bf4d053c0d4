from __future__ import annotations

from pathlib import Path

from folioscope import storage


def test_landed_tables_are_read_back_and_removed(spark):
    rows = spark.range(5).selectExpr("id", "cast(null as string) x")
    landed = storage.land(rows, "some")
    assert landed.dtypes == rows.dtypes and landed.count() == 5
    folder = Path(storage.shared_dir(spark).removeprefix("file://")) / "folioscope" / spark.sparkContext.applicationId
    before = len(list(folder.iterdir()))
    storage.release(storage.land(rows, "other"), None)
    assert before == len(list(folder.iterdir())) > 0 and landed.count() == 5
    storage.clean(spark)
    assert not folder.exists()


def test_batches_are_bounded(spark):
    storage.bounded_batches(spark, 1 << 20)
    storage.bounded_batches(spark, 1 << 24)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") == str(1 << 20)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_frugal_work_is_the_same_work(spark):
    rows = spark.range(1000).mapInArrow(storage.frugal(lambda batches: (b for b in batches)), "id long")
    assert rows.count() == 1000
    ended = []

    def run(batches):
        try:
            yield from batches
        finally:
            ended.append(True)

    work = storage.frugal(run)(iter([1, 2, 3]))
    assert next(work) == 1
    work.close()
    assert ended == [True]
