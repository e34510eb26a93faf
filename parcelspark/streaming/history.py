"""The sync history on disk: one-row folders while the loop runs, daily files after compaction.

Each attempt at a step is a folder ``batch_id=/sync_type=/attempt=`` of its own, so a retry never touches an
earlier record.  :func:`compact_history` gathers them into a table with one folder for each day, replaced by one
atomic rename, drops days beyond the retention and then the folders that it has taken in.  :func:`read_history`
joins both; a folder that is in the table already (compaction was stopped before it was dropped) counts once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.operators import sinks as SK
from parcelspark.operators import sync_state as S
from parcelspark.sources.schemas import SYNC_HISTORY_SCHEMA

ROW = f"{SYNC_HISTORY_SCHEMA}, batch_id bigint, attempt int"
KEY = ["batch_id", "sync_type", "attempt"]


def _daily(history: str) -> str:
    return f"{history.rstrip('/')}_daily"


def append(spark: SparkSession, history: str, batch_id: int, sync_type: str, row: tuple) -> None:
    step = f"{history}/batch_id={batch_id}/sync_type={sync_type}"
    attempt = 0
    while SK.exists(spark, f"{step}/attempt={attempt}/_SUCCESS"):
        attempt += 1
    one = spark.createDataFrame([row], SYNC_HISTORY_SCHEMA).coalesce(1)
    one.write.mode("overwrite").parquet(f"{step}/attempt={attempt}")


def _loose(spark: SparkSession, history: str) -> DataFrame:
    if not SK.exists(spark, history):
        return spark.createDataFrame([], ROW)
    rows = spark.read.schema(ROW).parquet(history)
    return rows.select(*[F.coalesce("attempt", F.lit(0)).alias(c) if c == "attempt" else F.col(c) for c in (f.split()[0] for f in ROW.split(", "))])


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """Every attempt, compacted or not, once."""
    loose, daily = _loose(spark, history), SK.read_current(spark, _daily(history))
    if daily is None:
        return loose
    return daily.select(*loose.columns).unionByName(loose.join(daily.select(*KEY), KEY, "left_anti").select(*loose.columns))


def compact_history(spark: SparkSession, history: str, now: dt.datetime, days: int = K.HISTORY_RETENTION_DAYS,
                    before: int | None = None) -> int:
    """Gather batches (with ``before``: those with a smaller id) into daily files without rows older than ``days``;
    returns the number of folders taken in.  A batch that may still come again must not be among them."""
    taken = [n for n in SK.children(spark, history) if before is None or int(n.split("=")[1]) < before]
    if not taken:
        return 0
    finished = read_history(spark, history)
    if before is not None:
        finished = finished.where(F.col("batch_id") < before)
    rows = S.history_retention(finished, now, days)
    by_day = rows.withColumn("day", F.to_date("sync_timestamp")).repartition("day")
    daily = _daily(history)
    version = SK.current_version(spark, daily)
    SK.write_version(by_day, daily, 0 if version is None else version + 1, partition_by=["day"], keep=2)
    for name in taken:
        SK.delete(spark, f"{history}/{name}")
    return len(taken)
