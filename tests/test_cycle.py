"""The whole cycle over two micro-batches equals the batch computation; history has every step."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from survey_helpers import SF_SMALL
from parcelspark.operators import ingest as I
from parcelspark.operators import sinks as SK
from parcelspark.operators import sync_state as S
from parcelspark.operators.unified import DEFAULT_AS_OF, unified_dataset
from parcelspark.sources.survey_views import survey_view
from parcelspark.streaming import cycle as CY
from parcelspark.streaming.incremental import land_json, read_history


def test_cycle_two_batches(spark, scratch):
    props = survey_view(spark, SF_SMALL, "properties")
    persons = survey_view(spark, SF_SMALL, "persons")
    persons.write.parquet(f"{scratch}/persons_feed")
    # two landing files: the customers' properties, then the suppliers' (no persons)
    land_json(props.where(~F.col("uuid").startswith("uuid:s")), f"{scratch}/mains", partitions=1)
    land_json(props.where(F.col("uuid").startswith("uuid:s")), f"{scratch}/mains", partitions=1)
    q, paths = CY.run_cycle(spark, f"{scratch}/mains", f"{scratch}/persons_feed", f"{scratch}/out",
                            f"{scratch}/ckpt", now_epoch=1704067200, bucket="survey-media", max_files_per_trigger=1, as_of=DEFAULT_AS_OF)
    q.awaitTermination()
    got = CY.read_unified(spark, paths)
    # batch form of the same steps: without a person mark every person of the feed comes in, after key derivation (T4)
    want = unified_dataset(props, I.derive_person_uuid(persons), as_of=DEFAULT_AS_OF)
    assert got.count() == want.count()
    assert got.select("uuid", "person_uuid", "ctl", "data_quality_score").exceptAll(
        want.select("uuid", "person_uuid", "ctl", "data_quality_score")).count() == 0
    h = read_history(spark, paths.history)
    assert h.where("status = 'success'").count() == 10  # 5 steps x 2 batches
    assert CY.read_properties(spark, paths).count() == props.count()


def _one_person(spark, path, rows):
    from parcelspark.sources.schemas import PERSONS_SCHEMA
    cols = [c.split()[0] for c in PERSONS_SCHEMA.split(", ")]
    spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], PERSONS_SCHEMA).write.mode("append").parquet(path)


def _batch(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def test_absent_keys_keep_and_nulls_clear_and_late_persons_arrive(spark, scratch):
    clock = iter(range(100, 200))
    days = iter([dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)])
    paths = CY.CyclePaths(f"{scratch}/out")
    fn = CY.cycle_fn(paths, f"{scratch}/persons", lambda: next(clock), "b", lambda: next(days), keep_batches=2)
    _one_person(spark, f"{scratch}/persons", [{"uuid": "p0_1", "id": "1", "submissions_id": "p0"}])
    sent = '{"submissionDate": "2024-01-05T10:00:00Z"}'
    fn(_batch(spark, {"uuid": "p0", "__id": "i0", "logo": "a.png", "building_image_url": "https://x", "system_json": sent,
                      "meta": "m", "survey_start": "2024-01-05T09:00:00.000000"}), 0)
    fn(_batch(spark, {"uuid": "p0", "logo": "b.png", "meta": None}), 1)
    row = CY.read_properties(spark, paths).first()
    assert row["logo"] == "b.png" and row["building_image_url"] == "https://x" and row["meta"] is None  # absent keeps, null clears
    assert row["submitted_date"] == dt.datetime(2024, 1, 5, 10) and row["survey_start"] == dt.datetime(2024, 1, 5, 9) and row["id"] == "i0"
    _one_person(spark, f"{scratch}/persons", [{"uuid": "p0_2", "id": "2", "submissions_id": "p0"}])
    fn(_batch(spark, {"uuid": "p1", "id": "i1"}), 2)  # the new person belongs to an earlier batch's property
    assert {r["uuid"] for r in CY.read_persons(spark, paths).collect()} == {"p0_1", "p0_2"}
    said = [json.loads(r["sync_metadata"]) for r in read_history(spark, paths.history).collect()]
    assert {(m["now_epoch"], m["as_of"]) for m in said} == {(100 + i, f"2024-01-0{i + 1}") for i in range(3)}
    assert SK.children(spark, paths.changes) == ["batch_id=1", "batch_id=2"]  # old changes go
    assert SK.children(spark, paths.unified) == ["as_of=2024-01-02", "as_of=2024-01-03"]  # a new day is a new build


def test_failed_attempt_stays_on_record(spark, scratch):
    paths = CY.CyclePaths(f"{scratch}/out")
    fn = CY.cycle_fn(paths, f"{scratch}/persons", lambda: 1, "b", lambda: dt.date(2024, 1, 1))
    batch = _batch(spark, {"uuid": "p0", "id": "i0"})
    with pytest.raises(Exception):
        fn(batch, 0)  # there is no person feed yet
    _one_person(spark, f"{scratch}/persons", [{"uuid": "p0_1", "id": "1", "submissions_id": "p0"}])
    fn(batch, 0)
    fold = {r["sync_type"]: r for r in S.sync_fold(read_history(spark, paths.history)).collect()}
    assert fold["person_details"]["failed_sync_count"] == 1 and fold["person_details"]["successful_sync_count"] == 1
    assert CY.read_unified(spark, paths).count() == 1


def test_person_mark_limits_to_the_batch(spark, scratch):
    paths = CY.CyclePaths(f"{scratch}/out")
    fn = CY.cycle_fn(paths, f"{scratch}/persons", lambda: 1, "b", lambda: dt.date(2024, 1, 1), person_mark=lambda s: "2024")
    _one_person(spark, f"{scratch}/persons", [{"uuid": "p0_1", "id": "1", "submissions_id": "p0"}, {"uuid": "p9_1", "id": "2", "submissions_id": "p9"}])
    fn(_batch(spark, {"uuid": "p0", "id": "i0"}), 0)
    assert [r["uuid"] for r in CY.read_persons(spark, paths).collect()] == ["p0_1"]


def _wide(df):
    return sorted(df.collect(), key=repr)


def test_records_that_cannot_be_applied_are_kept_and_counted(spark, scratch):
    paths = CY.CyclePaths(f"{scratch}/out", buckets=4)
    fn = CY.cycle_fn(paths, f"{scratch}/persons", lambda: 1, "b", lambda: dt.date(2024, 1, 1))
    _one_person(spark, f"{scratch}/persons", [{"uuid": "p0_1", "id": "1", "submissions_id": "p0"}, {"id": "2"}])
    fn(_batch(spark, {"uuid": "p0", "id": "i0", "property_description": '{"building_image": "a.jpg"}'}, {"logo": "no key"}, '{"uuid": "p1", "id"',
              {"uuid": "p2", "submitted_date": "no date"}, {"uuid": "p3", "survey_start": None}, {"uuid": "", "__id": "i4"}), 0)
    side = {(r["reason"], r["record"]) for r in spark.read.parquet(f"{paths.rejected}/batch_id=0/main_submissions").collect()}
    assert side == {("no_key", '{"logo": "no key"}'), ("broken_json", '{"uuid": "p1", "id"'), ("unreadable_date", '{"uuid": "p2", "submitted_date": "no date"}')}
    h = {r["sync_type"]: (r["records_processed"], json.loads(r["sync_metadata"])) for r in read_history(spark, paths.history).collect()}
    n, said = h["main_submissions"]
    assert n == 3 and (said["read"], said["applied"], said["rejected"]) == (6, 3, 3)
    n, said = h["person_details"]
    assert n == 1 and (said["read"], said["applied"], said["rejected"]) == (2, 1, 1)
    assert {r["uuid"] for r in CY.read_properties(spark, paths).collect()} == {"p0", "p3", "i4"}
    assert {r["submission_id"] for r in spark.read.parquet(f"{paths.attachments}/batch_id=0").collect()} == {"p0", "p3", "i4"}
    assert spark.read.parquet(f"{paths.rejected}/batch_id=0/person_details").first()["reason"] == "no_key"


def test_touched_properties_equal_a_full_build(spark, scratch):
    """Inserts, updates, late persons, a batch that comes again and one that changes nothing, within one day."""
    props, persons = survey_view(spark, SF_SMALL, "properties"), survey_view(spark, SF_SMALL, "persons")
    day = dt.date(2024, 6, 30)
    paths = CY.CyclePaths(f"{scratch}/out", buckets=8)
    fn = CY.cycle_fn(paths, f"{scratch}/persons", lambda: 1704067200, "survey-media", lambda: day)
    late = F.pmod(F.xxhash64("id"), F.lit(4))
    text = lambda df: df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    known = persons.where(F.col("uuid").isNotNull())
    known.where(late > 0).write.parquet(f"{scratch}/persons")
    changed = F.col("uuid").endswith("7")
    fn(text(props.where(~F.col("uuid").endswith("3")).withColumn("end_json", F.when(~changed, F.col("end_json")))), 0)
    whole = lambda: _wide(unified_dataset(CY.read_properties(spark, paths), CY.read_persons(spark, paths), as_of=day))
    known.where((late == 0) & (F.coalesce("submissions_id", F.lit("")) < "uuid:2")).write.mode("append").parquet(f"{scratch}/persons")
    second = text(props.where(F.col("uuid").endswith("3") | (changed & (F.col("uuid") < "uuid:3"))))
    fn(second, 1)
    fn(second, 1)  # comes again
    assert _wide(CY.read_unified(spark, paths)) == whole()
    known.where((late == 0) & (F.coalesce("submissions_id", F.lit("")) >= "uuid:2")).write.mode("append").parquet(f"{scratch}/persons")
    fn(text(props.where(changed)), 2)
    want = _wide(unified_dataset(CY.read_properties(spark, paths), known, as_of=day))
    assert _wide(CY.read_unified(spark, paths)) == want and len(want) > 1000
    files = set(CY.read_unified(spark, paths).inputFiles())
    fn(text(props.where(changed)), 3)  # nothing new
    assert set(CY.read_unified(spark, paths).inputFiles()) == files
    last = {r["sync_type"]: json.loads(r["sync_metadata"]) for r in read_history(spark, paths.history).where("batch_id = 3").collect()}
    assert last["unified_rebuild"]["parts"] == 0
