"""Structured Streaming: the polling loop as micro-batches.

``incremental_upsert`` reads landed feed files with ``readStream`` and, per
micro-batch (``foreachBatch``), applies the presence-aware upsert to a
versioned table (version = batch id; a replayed batch makes the same
version again in a folder of its own: idempotent) and appends one history row per batch (also keyed by the
batch id).  ``sync_status_stream`` keeps the per-type status as a streaming
aggregation over the history log (update mode).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import ingest as I
from parcelspark.operators import sinks as SK
from parcelspark.operators import sync_state as S
from parcelspark.sources.schemas import SYNC_HISTORY_SCHEMA, TS_FORMAT
from parcelspark.streaming.history import read_history  # noqa: F401  (read by callers of this module)


def land_json(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a DataFrame as JSON feed files (microsecond timestamps kept)."""
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode("append").option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed JSON lines as text, for readers that need to know which keys a record has."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def feed_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(schema).option("timestampNTZFormat", TS_FORMAT)
         .option("timestampFormat", TS_FORMAT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def once_from_mark(stream: DataFrame, keys: list[str], mark=None, ts_col: str = "submitted_date", watermark: str = "1 day") -> DataFrame:
    """T5/S1 with ``>=``: records at or after the mark, each (``keys`` and time) once.

    A feed that is asked for ``>= mark`` sends the records of the mark's own instant again, together with those
    that arrived there late; a strict ``>`` would miss the latter.  The state of a record is kept until the
    watermark has passed it, so it is bounded by the records of that span.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # watermarks need an instant: the zone-less time read as UTC
    timed = I.feed_incremental(stream, mark, ts_col, inclusive=True).withColumn(
        "_event_time", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(ts_col))))
    return timed.withWatermark("_event_time", watermark).dropDuplicatesWithinWatermark([*keys, "_event_time"]).drop("_event_time")


def upsert_batch_fn(table: str, history: str, key: str, columns: list[str], order: list[str],
                    presence: dict[str, str] | None, sync_type: str, ts_col: str):
    """The ``foreachBatch`` body.

    Version ``b + 1`` of the table is version ``b`` with batch ``b`` applied, so a
    batch replayed after a failure recomputes and overwrites the same version.
    """
    def apply(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        started = dt.datetime.now()
        prev = SK.read_version(spark, table, batch_id)
        if prev is None:
            if batch_id != 0:
                raise RuntimeError(f"version {batch_id} of {table} is missing; cannot apply batch {batch_id}")
            prev = spark.createDataFrame([], batch_df.select(key, *columns).schema)
        SK.write_version(I.upsert(prev, batch_df, key, columns, order, presence), table, batch_id + 1)
        stats = batch_df.agg(F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("mark")).first()
        ended = dt.datetime.now()
        row = (int(batch_id), sync_type, started, "success", int(stats["n"]), int((ended - started).total_seconds()),
               None, None, "stream", stats["mark"])
        (spark.createDataFrame([row], SYNC_HISTORY_SCHEMA)
         .write.mode("overwrite").parquet(f"{history.rstrip('/')}/batch_id={batch_id}"))
    return apply


def seed_table(initial: DataFrame, table: str) -> None:
    """Version 0 = the stored table before the first micro-batch."""
    if SK.current_version(initial.sparkSession, table) is None:
        SK.write_version(initial, table, 0)


def incremental_upsert(spark: SparkSession, source: str, schema: str, table: str, history: str, checkpoint: str,
                       key: str, columns: list[str], order: list[str], presence: dict[str, str] | None = None,
                       sync_type: str = "main_submissions", ts_col: str = "submitted_date",
                       max_files_per_trigger: int | None = None, available_now: bool = True,
                       processing_time: str | None = None):
    """T14 for one feed: stream landed records into the table; returns the started query."""
    stream = feed_stream(spark, source, schema, max_files_per_trigger)
    w = (stream.writeStream.foreachBatch(upsert_batch_fn(table, history, key, columns, order, presence,
                                                         sync_type, ts_col))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "60 seconds")
    return w.start()


def sync_status_stream(spark: SparkSession, history: str) -> DataFrame:
    """T9 as a streaming aggregation over the history log (use output mode ``update`` or ``complete``)."""
    h = spark.readStream.schema(SYNC_HISTORY_SCHEMA + ", batch_id bigint").parquet(history)
    return S.sync_fold(h)


def hourly_perf_stream(spark: SparkSession, history: str, watermark: str = "2 hours") -> DataFrame:
    """A15 in event time: successful attempts per (hour window, sync type) with a watermark, so the
    state of an hour is dropped once attempts older than the watermark stop arriving."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    h = spark.readStream.schema(SYNC_HISTORY_SCHEMA + ", batch_id bigint").parquet(history)
    # watermarks need an instant: the zone-less log time read as UTC (no session-zone dependence)
    ok = (h.where(F.col("status") == "success")
          .withColumn("event_time", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("sync_timestamp"))))
          .withWatermark("event_time", watermark))
    agg = ok.groupBy(F.window("event_time", "1 hour").alias("w"), "sync_type").agg(
        F.sum("duration_seconds").cast("bigint").alias("total_duration"),
        F.count("duration_seconds").alias("attempts_timed"),
        F.sum("records_processed").cast("bigint").alias("total_records"))
    return agg.select(F.timestamp_add("MICROSECOND", F.unix_micros(F.col("w.start")), epoch).alias("hour"),
                      "sync_type", "total_duration", "attempts_timed", "total_records")
