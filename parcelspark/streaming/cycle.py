"""The whole sync cycle as one Structured Streaming ``foreachBatch``.

Per micro-batch of landed main submissions:

1. split the records into applied and rejected ones (broken JSON, unreadable date, no key); the rejected go to a
   side folder with their reason.  Upsert the others into the properties store: keys absent from a record keep
   the stored value, last record wins;
2. write the attachment manifest of the applied records (what to fetch, object keys, priority);
3. move changed links in the store of links by due hour, and write the refresh manifest of the hours that are due;
4. upsert the persons of the person feed: all of them, or, once there is a person mark, those whose
   submission is in the batch; persons without a key go to the side folder;
5. make the rows of the touched properties anew in the unified store (all rows on the first batch of a day, whose
   date ages and processing times follow).

Tables are stores (``operators.store``): a batch rewrites the buckets it touches.  The changes of a batch, old and new
image, are written before they are applied, and a batch that comes again applies the same ones.  The last
``keep_batches`` of them stay.

Each attempt at a step appends its own history row, keyed by (batch id, sync type, attempt), so a failure stays on record
when the retry succeeds.  A failing step records an ``error`` row and re-raises, which fails the batch (the stream
retries it) -- a feed error is never turned into an empty success.  The clock is read for each batch.  Every
``compact_every`` batches the history is gathered into daily files and days beyond the retention go (T11).
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.operators import ingest as I
from parcelspark.operators import links as LK
from parcelspark.operators import propagate as PR
from parcelspark.operators import sinks as SK
from parcelspark.operators import store as ST
from parcelspark.sources.schemas import MAIN_SCHEMA, PERSONS_SCHEMA, TS_FORMAT
from parcelspark.streaming import history as H
from parcelspark.streaming.incremental import text_stream

MAIN_COLUMNS = [c.split()[0] for c in MAIN_SCHEMA.split(", ") if c.split()[0] != "uuid"]
BUCKETS = 64  # a part should hold some 100 MB of the largest table


@dataclass
class CyclePaths:
    root: str
    buckets: int = BUCKETS
    properties: str = field(init=False)
    persons: str = field(init=False)
    unified: str = field(init=False)
    links: str = field(init=False)
    changes: str = field(init=False)
    rejected: str = field(init=False)
    attachments: str = field(init=False)
    refresh: str = field(init=False)
    history: str = field(init=False)

    def __post_init__(self):
        r = self.root.rstrip("/")
        for name in ("properties", "persons", "unified", "links", "changes", "rejected", "attachments", "refresh", "history"):
            setattr(self, name, f"{r}/{name}")

    @property
    def property_store(self) -> ST.Store:
        return PR.property_store(self.properties, self.buckets)

    @property
    def person_store(self) -> ST.Store:
        return PR.person_store(self.persons, self.buckets)

    @property
    def link_store(self) -> ST.Store:
        return LK.link_store(self.links)

    def unified_store(self, spark: SparkSession, day: str) -> ST.Store:
        return PR.unified_store(spark, f"{self.unified}/{day}", self.buckets, day.split("=")[1])


def read_properties(spark: SparkSession, paths: CyclePaths) -> DataFrame:
    return ST.read(spark, paths.property_store)


def read_persons(spark: SparkSession, paths: CyclePaths) -> DataFrame:
    return ST.read(spark, paths.person_store)


def read_unified(spark: SparkSession, paths: CyclePaths) -> DataFrame | None:
    """The wide table as of the last complete batch; None before the first one."""
    day = SK.pointer(spark, paths.unified)
    return None if day is None else ST.read(spark, paths.unified_store(spark, day))


def _log(spark: SparkSession, paths: CyclePaths, batch_id: int, sync_type: str, started: dt.datetime,
         status: str, records: int | None, mark=None, error: str | None = None, metadata: str | None = None) -> None:
    ended = dt.datetime.now()
    row = (int(batch_id), sync_type, started, status, records, int((ended - started).total_seconds()),
           None if error is None else error[:K.ERROR_TEXT_MAX], metadata, "cycle", mark)
    H.append(spark, paths.history, batch_id, sync_type, row)


def _counted(df: DataFrame, write) -> int:
    """Run a write and return its rows from the write's own metrics."""
    from pyspark.sql import Observation

    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return int(seen.get["n"])


def cycle_fn(paths: CyclePaths, persons_feed: str, now_epoch: Callable[[], int], bucket: str,
             as_of: Callable[[], dt.date], order: list[str] | None = None,
             person_mark: Callable[[SparkSession], object] | None = None, keep_batches: int = 5,
             compact_every: int = 50, retention_days: int = K.HISTORY_RETENTION_DAYS):
    """The ``foreachBatch`` body over text records; ``now_epoch`` and ``as_of`` are asked for each batch."""
    order = order or ["submitted_date", "id"]

    def step(spark, batch_id, sync_type, fn, clock):
        started = dt.datetime.now()
        try:
            records, mark, counts = fn()
        except Exception as e:  # record, then fail the batch so the stream retries it
            _log(spark, paths, batch_id, sync_type, started, "error", None, error=str(e), metadata=json.dumps(clock))
            raise
        _log(spark, paths, batch_id, sync_type, started, "success", records, mark, metadata=json.dumps({**clock, **counts}))

    def dated(parsed: DataFrame, flags: dict[str, str]) -> DataFrame:
        # the submitted time of the system block, where it parses, is the record's
        derived = F.col("submitted_at").isNotNull()
        return (I.normalize_submission(parsed).withColumn("submitted_date", F.coalesce("submitted_at", "submitted_date"))
                .withColumn(flags["submitted_date"], F.col(flags["submitted_date"]) | derived)
                .drop("submission_date_text", "submitted_at"))

    def apply(text: DataFrame, batch_id: int) -> None:
        spark = text.sparkSession
        now, today = int(now_epoch()), as_of()
        flags = I.presence_flags(MAIN_SCHEMA)
        split = I.split_records(text, MAIN_SCHEMA, "uuid", TS_FORMAT, renames=I.MAIN_RENAMES,
                                prepare=lambda parsed: dated(parsed, flags)).persist()
        batch = I.applied(split)
        changes, side = f"{paths.changes}/batch_id={batch_id}", f"{paths.rejected}/batch_id={batch_id}"
        done: dict[str, DataFrame] = {}

        def mains():
            counts = I.write_rejected(split, f"{side}/main_submissions", "submitted_date")
            new = ST.upsert_changes(spark, paths.property_store, batch, order, {c: flags[c] for c in MAIN_COLUMNS})
            done["mains"] = ST.write_once(new, f"{changes}/mains")
            ST.apply_changes(paths.property_store, done["mains"])
            mark = counts.pop("mark")
            return counts["applied"], mark, counts

        def images():
            plan = LK.attachment_plan(batch, ST.images(done["mains"], "old"))
            out = f"{paths.attachments}/batch_id={batch_id}"
            return _counted(plan, lambda df: df.write.mode("overwrite").parquet(out)), None, {}

        def refresh():
            ST.apply_changes(paths.link_store, done["mains"])
            due = LK.due_links(ST.read(spark, paths.link_store, with_part=True), now)
            out = f"{paths.refresh}/batch_id={batch_id}"
            return _counted(LK.refresh_manifest(due, now, bucket), lambda df: df.write.mode("overwrite").parquet(out)), None, {}

        def persons():
            feed = spark.read.schema(PERSONS_SCHEMA).parquet(persons_feed)
            if person_mark is not None and person_mark(spark) is not None:
                feed = I.persons_of_batch(feed, batch)
            counts = I.write_rejected(I.split_persons(feed), f"{side}/person_details", "submitted_date")
            mine = I.derive_person_uuid(feed)
            new = ST.upsert_changes(spark, paths.person_store, mine, ["id"])
            done["persons"] = ST.write_once(ST.changed(new), f"{changes}/persons")
            ST.apply_changes(paths.person_store, done["persons"])
            counts.pop("mark")
            return counts["applied"], None, counts

        def rebuild():
            from pyspark.sql import Observation

            day, seen = f"as_of={today}", Observation()
            table = paths.unified_store(spark, day)
            counted = lambda df: df.observe(seen, F.count(F.lit(1)).alias("n"))
            if SK.pointer(spark, paths.unified) != day:
                PR.build_unified(table, read_properties(spark, paths), read_persons(spark, paths), today, counted)
                older = [d for d in SK.children(spark, paths.unified) if d not in (day, SK.pointer(spark, paths.unified))]
                SK.set_pointer(spark, paths.unified, day)
                for d in older:  # the last day stays for whoever reads it
                    SK.delete(spark, f"{paths.unified}/{d}")
                return int(seen.get["n"]), None, {"built": "whole"}
            touched = PR.touched_properties(done["mains"], done["persons"])
            parts = PR.refresh_unified(table, paths.property_store, paths.person_store, touched, today, counted=counted)
            return int(seen.get["n"]) if parts else 0, None, {"built": "touched", "parts": len(parts)}

        clock = {"now_epoch": now, "as_of": str(today)}
        try:
            for sync_type, fn in (("main_submissions", mains), ("image_processing", images),
                                  ("url_refresh", refresh), ("person_details", persons), ("unified_rebuild", rebuild)):
                step(spark, batch_id, sync_type, fn, clock)
        finally:
            split.unpersist()
        if batch_id >= keep_batches:
            SK.delete(spark, f"{paths.changes}/batch_id={batch_id - keep_batches}")
        if batch_id and batch_id % compact_every == 0:
            H.compact_history(spark, paths.history, dt.datetime.now(), retention_days, before=batch_id)

    return apply


def run_cycle(spark: SparkSession, mains_landing: str, persons_feed: str, root: str, checkpoint: str,
              now_epoch: int | Callable[[], int] | None, bucket: str, as_of=None,
              max_files_per_trigger: int | None = None, processing_time: str | None = None,
              person_mark: Callable[[SparkSession], object] | None = None, keep_batches: int = 5,
              buckets: int = BUCKETS):
    """Start the cycle: ``availableNow`` by default, or a ``processingTime`` trigger (the polling loop).

    ``now_epoch`` and ``as_of`` may be fixed values (tests) or callables; left out, they follow the clock.
    """
    paths = CyclePaths(root, buckets)
    now = now_epoch if callable(now_epoch) else (lambda: int(time.time()) if now_epoch is None else now_epoch)
    today = as_of if callable(as_of) else (lambda: dt.date.today() if as_of is None else as_of)
    stream = text_stream(spark, mains_landing, max_files_per_trigger)
    body = cycle_fn(paths, persons_feed, now, bucket, today, person_mark=person_mark, keep_batches=keep_batches)
    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start(), paths
