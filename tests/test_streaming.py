from __future__ import annotations

import datetime

from folioscope.streaming import ordered, workflow


def stream(spark, tmp_path, batches, schema):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{k}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))


def results(spark, df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name).collect()


def test_uploads_are_registered_once(spark, tmp_path):
    source = stream(spark, tmp_path, [[(1, "x")], [(2, "x"), (3, "y")]], "id int, data string")
    got = results(spark, workflow.first_uploads(source, "data"), tmp_path, "uploads")
    assert len(got) == 2 and {r.data for r in got} == {"x", "y"}


def test_stages_over_a_stream(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    ordered.use_rocksdb(spark)
    schema = "deal string, at timestamp, request_id long, stage string"
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    # out of order within a batch and over two; the last ones move the watermark on
    batches = [[("d", at(4), 3, "Due diligence"), ("d", at(1), 0, "Offer"), ("d", at(3), 2, "NDA")], [("d", at(2), 1, "NDA"), ("e", at(5), 4, None)], [("z", at(30), 8, "x")], [("d", at(31), 5, "Offer")], [("z", at(59), 9, "x")], [("z", at(59), 10, "x")]]
    source = stream(spark, tmp_path, batches, schema)
    got = {r.request_id: (r.accepted, r.state) for r in results(spark, workflow.stage_machine(source, "deal", delay="10 minutes"), tmp_path, "stages") if r.deal != "z"}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert got == {0: (False, "Sourcing"), 1: (True, "NDA"), 2: (False, "NDA"), 3: (True, "Due diligence"), 4: (False, "Sourcing"), 5: (True, "Offer")}
