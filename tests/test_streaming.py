"""The same rows in 1, 3 and 7 micro-batches give the same table as the batch upsert."""
import pytest
from pyspark.sql import functions as F

from survey_helpers import SF_SMALL
from parcelspark.operators import ingest as I
from parcelspark.operators import sinks as SK
from parcelspark.plans.q_ingest import ORDER, PRESENCE, UPSERT_COLS
from parcelspark.sources.schemas import INCOMING_SCHEMA
from parcelspark.sources.survey_views import survey_view
from parcelspark.streaming import incremental as ST


@pytest.mark.parametrize("files_per_trigger", [None, 3, 1])
def test_stream_equals_batch(spark, scratch, files_per_trigger):
    inc = survey_view(spark, SF_SMALL, "incoming")
    src = f"{scratch}/landing"
    # one landing file per year, written in date order: arrival order = record order, so applying
    # micro-batches one after another must give the batch answer
    years = sorted(r[0] for r in inc.select(F.year("submitted_date")).distinct().collect())
    for y in years:
        ST.land_json(inc.where(F.year("submitted_date") == y), src, partitions=1)
    empty = spark.createDataFrame([], "uuid string, sum_owner string, logo string, sum_landlord string")
    q = ST.incremental_upsert(spark, src, INCOMING_SCHEMA, f"{scratch}/table", f"{scratch}/history",
                              f"{scratch}/ckpt", "uuid", UPSERT_COLS, ORDER, PRESENCE,
                              max_files_per_trigger=files_per_trigger)
    q.awaitTermination()
    got = SK.read_current(spark, f"{scratch}/table")
    want = I.upsert(empty, inc, "uuid", UPSERT_COLS, ORDER, PRESENCE)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hist = ST.read_history(spark, f"{scratch}/history")
    assert hist.agg(F.sum("records_processed")).first()[0] == inc.count()


def test_replayed_batch_is_idempotent(spark, scratch):
    inc = survey_view(spark, SF_SMALL, "incoming")
    empty = spark.createDataFrame([], "uuid string, sum_owner string, logo string, sum_landlord string")
    fn = ST.upsert_batch_fn(f"{scratch}/t", f"{scratch}/h", "uuid", UPSERT_COLS, ORDER, PRESENCE, "main", "submitted_date")
    fn(inc, 0)
    first = SK.read_current(spark, f"{scratch}/t").collect()
    fn(inc, 0)  # replay after a failure
    assert sorted(SK.read_current(spark, f"{scratch}/t").collect()) == sorted(first)
    assert SK.current_version(spark, f"{scratch}/t") == 1
    del empty


def test_status_stream(spark, scratch):
    inc = survey_view(spark, SF_SMALL, "incoming")
    fn = ST.upsert_batch_fn(f"{scratch}/t", f"{scratch}/h", "uuid", UPSERT_COLS, ORDER, PRESENCE, "main", "submitted_date")
    fn(inc.limit(10), 0)
    fn(inc, 1)
    s = ST.sync_status_stream(spark, f"{scratch}/h")
    q = s.writeStream.outputMode("complete").format("memory").queryName("status_test").start()
    q.processAllAvailable()
    q.stop()
    row = spark.sql("select * from status_test").first()
    assert row["successful_sync_count"] == 2 and row["last_records_processed"] == inc.count()


def test_hourly_perf_stream_matches_batch(spark, scratch):
    hist = survey_view(spark, SF_SMALL, "sync_history")
    hist.withColumn("batch_id", F.lit(0).cast("bigint")).write.parquet(f"{scratch}/h/batch_id=0")
    s = ST.hourly_perf_stream(spark, f"{scratch}/h")
    q = s.writeStream.outputMode("complete").format("memory").queryName("perf_test").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select hour, sync_type, total_duration, attempts_timed, total_records from perf_test")
    want = (hist.where("status = 'success'")
            .groupBy(F.date_trunc("hour", "sync_timestamp").cast("timestamp_ntz").alias("hour"), "sync_type")
            .agg(F.sum("duration_seconds").cast("bigint").alias("total_duration"),
                 F.count("duration_seconds").alias("attempts_timed"),
                 F.sum("records_processed").cast("bigint").alias("total_records")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
