"""Sync bookkeeping as an append-only event log plus folds over it.

The original keeps a mutable status row per sync type and updates it on every
start / complete / fail.  Here the history log is the source of truth and the
status table is a ``groupBy(sync_type)`` fold of it (T9): the same answer,
computable incrementally in streaming (update mode) or in batch, and safe to
replay.  Appends are idempotent by ``(batch_id, sync_type)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import constants as K

HISTORY_SCHEMA = ("id int, sync_type string, sync_timestamp timestamp_ntz, status string, records_processed int, "
                  "duration_seconds int, error_message string, sync_metadata string, service_instance string, "
                  "sync_mark timestamp_ntz")


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(str(v)).cast("timestamp_ntz")


def _order() -> Column:
    return F.struct(F.col("sync_timestamp"), F.col("id"))


def exact_mean(total: str, n: str, scale: int = 4) -> Column:
    """``total / n`` of whole numbers, rounded half up to ``scale`` places in whole-number arithmetic; NULL when ``n`` is 0.

    The parts are SQL expressions.  Sums of whole numbers do not depend on the order of the rows, a floating mean does.
    """
    m = 10**scale
    return (F.expr(f"(2 * {m} * {total} + {n}) div nullif(2 * {n}, 0)").cast("decimal(30,0)")
            * F.lit(1 / m).cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(18,{scale})")


def sync_fold(history: DataFrame) -> DataFrame:
    """Current status per sync type from the history log.

    successes / failures are counts; the last status, attempt time and error are
    those of the newest attempt; records are those of the newest success; the
    mark is the newest non-NULL mark of a success (a completion without a mark
    leaves it unchanged).
    """
    o = _order()
    success = F.col("status") == "success"
    last = F.max_by(F.struct("status", "error_message"), o)
    return history.groupBy("sync_type").agg(
        F.max_by(F.col("sync_mark"), F.when(success & F.col("sync_mark").isNotNull(), o)).alias("last_sync_timestamp"),
        F.max("sync_timestamp").alias("last_attempt_timestamp"),
        last.alias("_last"),
        F.count_if(success).cast("int").alias("successful_sync_count"),
        F.count_if(F.col("status") == "error").cast("int").alias("failed_sync_count"),
        F.max_by(F.col("records_processed"), F.when(success, o)).alias("last_records_processed"),
    ).select(
        "sync_type", "last_sync_timestamp", "last_attempt_timestamp",
        F.col("_last.status").alias("last_sync_status"),
        F.when(F.col("_last.status") == "error", F.substring(F.col("_last.error_message"), 1, K.ERROR_TEXT_MAX))
        .alias("last_error_message"),
        "successful_sync_count", "failed_sync_count", "last_records_processed")


def recent_history(history: DataFrame, n: int = K.RECENT_ATTEMPTS) -> DataFrame:
    """L3: the ``n`` newest attempts (a top-N)."""
    return history.orderBy(F.col("sync_timestamp").desc(), F.col("id").desc()).limit(n)


def failed_syncs(history: DataFrame) -> DataFrame:
    """Error attempts, newest first."""
    return history.where(F.col("status") == "error").orderBy(F.col("sync_timestamp").desc(), F.col("id").desc())


def history_retention(history: DataFrame, now, days: int = K.HISTORY_RETENTION_DAYS) -> DataFrame:
    """Rows to keep (attempts at or after now - days)."""
    return history.where(F.col("sync_timestamp") >= _ts(now) - F.expr(f"INTERVAL {int(days)} DAYS"))


def sync_perf(history: DataFrame, now, hours: int = 24, by_hour: bool = False) -> DataFrame:
    """Successful attempts of the last ``hours``: mean duration and records per type (per hour)."""
    recent = history.where((F.col("status") == "success") &
                           (F.col("sync_timestamp") > _ts(now) - F.expr(f"INTERVAL {int(hours)} HOURS")))
    keys = [F.date_trunc("hour", F.col("sync_timestamp")).cast("timestamp_ntz").alias("hour")] if by_hour else []
    a = recent.groupBy(*keys, "sync_type").agg(F.sum("duration_seconds").alias("_s"), F.count("duration_seconds").alias("_n"),
                                               F.sum("records_processed").cast("bigint").alias("total_records"))
    return a.select(*(["hour"] if by_hour else []), "sync_type", exact_mean("_s", "_n").alias("avg_duration"),
                    "total_records")


def sync_success_rate(status: DataFrame) -> DataFrame:
    """Totals over types and the success rate in percent (0 when there is none)."""
    t = status.agg(F.coalesce(F.sum("successful_sync_count"), F.lit(0)).cast("bigint").alias("total_successful"),
                   F.coalesce(F.sum("failed_sync_count"), F.lit(0)).cast("bigint").alias("total_failed"))
    t = t.withColumn("_n", F.col("total_successful") + F.col("total_failed"))
    rate = exact_mean("(100 * total_successful)", "_n", 3).cast("decimal(7,3)")
    return t.select("total_successful", "total_failed",
                    F.coalesce(rate, F.lit(0).cast("decimal(7,3)")).alias("success_rate"))


def sync_recent_avg(history: DataFrame, n: int = K.RECENT_ATTEMPTS) -> DataFrame:
    """Mean duration of the ``n`` newest attempts, ignoring NULL and 0."""
    timed = F.nullif(F.col("duration_seconds"), F.lit(0))
    a = recent_history(history, n).agg(F.sum(timed).alias("_s"), F.count(timed).alias("attempts_counted"))
    return a.select(exact_mean("_s", "attempts_counted").alias("avg_duration"), "attempts_counted")


def types_in_error(status: DataFrame) -> DataFrame:
    """Sync types whose last attempt failed, with the message."""
    return status.where(F.col("last_sync_status") == "error").select("sync_type", "last_error_message",
                                                                    "last_attempt_timestamp")


def mark_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per type keep the later of two marks (``(sync_type, mark)`` tables)."""
    j = a.select("sync_type", F.col("mark").alias("_a")).join(
        b.select("sync_type", F.col("mark").alias("_b")), "sync_type", "full_outer")
    return j.select("sync_type", F.greatest("_a", "_b").alias("mark"))


def mark_presence(spark: SparkSession, status: DataFrame, history: DataFrame,
                  expected=K.SYNC_TYPES) -> DataFrame:
    """For each expected type, does it have a mark, and how many history rows."""
    exp = spark.createDataFrame([(t,) for t in expected], "sync_type string")
    h = history.groupBy("sync_type").agg(F.count(F.lit(1)).alias("history_rows"))
    return (exp.join(status.select("sync_type", "last_sync_timestamp"), "sync_type", "left")
            .join(h, "sync_type", "left")
            .select("sync_type", F.col("last_sync_timestamp").isNotNull().alias("has_mark"),
                    "last_sync_timestamp", F.coalesce("history_rows", F.lit(0)).alias("history_rows")))


def quality_trend(unified: DataFrame, now, days: int = 30, good: int = K.QUALITY_GOOD_SCORE,
                  ts_col: str = "processed_at") -> DataFrame:
    """Per day of processing: mean score, rows, rows scoring at least ``good``."""
    recent = unified.where(F.col(ts_col) >= _ts(now) - F.expr(f"INTERVAL {int(days)} DAYS"))
    day = F.date_trunc("day", F.col(ts_col)).cast("timestamp_ntz").alias("processing_date")
    a = recent.groupBy(day).agg(F.sum("data_quality_score").alias("_s"), F.count(F.lit(1)).alias("records_processed"),
                                F.count_if(F.col("data_quality_score") >= good).alias("high_quality_records"))
    return a.select("processing_date", exact_mean("_s", "records_processed").alias("avg_quality_score"),
                    "records_processed", "high_quality_records")


# ---- events (T6-T8, T10): rows for the log, made by Spark for every attempt in a table ------------

STARTS = "id int, sync_type string, sync_timestamp timestamp_ntz, service_instance string"


def _events(starts: DataFrame, status: str, **values) -> DataFrame:
    cols = {"id": F.col("id"), "sync_type": F.col("sync_type"), "sync_timestamp": F.col("sync_timestamp"),
            "status": F.lit(status), "service_instance": F.col("service_instance"), **values}
    types = dict(c.split() for c in HISTORY_SCHEMA.split(", "))
    return starts.select(*[cols.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def _seconds(end) -> Column:
    return F.floor(F.timestamp_diff("SECOND", F.col("sync_timestamp"), _ts(end)))


def start_events(starts: DataFrame) -> DataFrame:
    """Attempts ``(id, sync_type, sync_timestamp, service_instance)`` as rows in progress."""
    return _events(starts, "in_progress")


def complete_events(starts: DataFrame, end, records=0, mark=None, metadata=None) -> DataFrame:
    """The same attempts, ended well: whole seconds since the start, records, and the mark if there is one."""
    return _events(starts, "success", records_processed=F.lit(records), duration_seconds=_seconds(end),
                   sync_metadata=F.lit(metadata), sync_mark=F.lit(None) if mark is None else _ts(mark))


def fail_events(starts: DataFrame, end, message: Column | str) -> DataFrame:
    """The same attempts, failed, with the message cut to its limit."""
    text = message if isinstance(message, Column) else F.lit(message)
    return _events(starts, "error", duration_seconds=_seconds(end), error_message=F.substring(text, 1, K.ERROR_TEXT_MAX))


def mark_set_events(starts: DataFrame, mark) -> DataFrame:
    """A mark set by hand is an attempt that ends as it starts, with no records."""
    return complete_events(starts, F.col("sync_timestamp"), 0, mark)


def final_states(events: DataFrame) -> DataFrame:
    """One row for each attempt: its end replaces its start (by ``id``)."""
    ended = F.when(F.col("status") != "in_progress", 1).otherwise(0)
    return events.groupBy("id").agg(F.max_by(F.struct(*events.columns), ended).alias("r")).select("r.*")
