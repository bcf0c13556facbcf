"""Sessions in a stream against the batch form, over a restart."""

import os
import time

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import sessions
from cartwheel.sources import testdata as td
from cartwheel.streaming import sessions as SS
from helpers import SF001

COLUMNS = ["user_id", "event_id", "session_seq", "is_session_start", "current_step"]


@pytest.fixture()
def rocks_db(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, SS.ROCKS_DB)
    yield
    spark.conf.set(key, before)


def test_numbers_equal_the_batch_form_over_a_restart(spark, tmp_dir, rocks_db):
    bronze = td.bronze(spark, SF001).where("user_id is not null").dropDuplicates(["event_id"])
    bronze = bronze.select("user_id", "event_id", "event_type", "event_timestamp").checkpoint()
    path, out, checkpoint = (os.path.join(tmp_dir, n) for n in ("events", "out", "ckpt"))

    def add(rows):
        rows.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # the file source takes files in order of time

    def run():
        stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1).parquet(path)
        numbered = SS.session_numbers_stream(stream)
        q = numbered.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        q = q.outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(300)
        return q

    middle = bronze.select(F.percentile_approx(F.col("event_timestamp").cast("timestamp"), 0.5).alias("m")).first()["m"]
    early = F.col("event_timestamp").cast("timestamp") <= F.lit(middle)
    add(bronze.where(early).orderBy(F.rand(3)))  # out of order inside the delay of its batch
    run()
    some = spark.read.parquet(out).count()
    assert 0 <= some < bronze.count()
    add(bronze.where(~early).orderBy(F.rand(4)))
    add(spark.createDataFrame([("u_end", "end", "page_view")], "user_id string, event_id string, event_type string").withColumn(
        "event_timestamp", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")))
    q = run()
    got = spark.read.parquet(out).where("user_id <> 'u_end'").select(*COLUMNS)
    want = sessions.session_progress(sessions.sessionize(bronze)).select(*COLUMNS)
    assert got.count() == bronze.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # events don't stay in state once they have been numbered
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    users = bronze.select("user_id").distinct().count()
    assert held[-1] <= 3 * (users + 1), held
