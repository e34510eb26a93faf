"""Upsert and sync state (FIXTURES 2.5)."""
import datetime as dt

from pyspark.sql import functions as F

from parcelspark.operators import ingest as I
from parcelspark.operators import sync_state as S

SCHEMA = "uuid string, ts int, sum_owner string, has_sum_owner boolean, logo string, has_logo boolean"


def test_presence_aware_upsert(spark):
    stored = spark.createDataFrame([("u1", "1", "a"), ("u2", "5", "b")], "uuid string, sum_owner string, logo string")
    batch = spark.createDataFrame([
        ("u1", 1, "2", True, None, False),      # only sum_owner present
        ("u2", 1, None, True, None, False),     # present NULL overwrites
        ("u3", 1, "7", True, "x", True),        # new key
        ("u3", 2, "8", True, None, False),      # later record, logo absent -> keep x
        (None, 3, "9", True, None, False),      # no key -> not applied
    ], SCHEMA)
    out = {r["uuid"]: (r["sum_owner"], r["logo"]) for r in
           I.upsert(stored, batch, "uuid", ["sum_owner", "logo"], ["ts"],
                    {"sum_owner": "has_sum_owner", "logo": "has_logo"}).collect()}
    assert out == {"u1": ("2", "a"), "u2": (None, "b"), "u3": ("8", "x")}
    assert I.rejected_rows(batch).count() == 1
    # replaying the same batch changes nothing
    again = I.upsert(stored, batch.unionByName(batch), "uuid", ["sum_owner", "logo"], ["ts"],
                     {"sum_owner": "has_sum_owner", "logo": "has_logo"})
    assert {r["uuid"]: (r["sum_owner"], r["logo"]) for r in again.collect()} == out


def test_derive_person_uuid(spark):
    b = spark.createDataFrame([("p1", "i1", "s1"), (None, "i2", "s1"), (None, None, "s1")],
                              "uuid string, id string, submissions_id string")
    got = sorted(r["uuid"] for r in I.derive_person_uuid(b).collect())
    assert got == ["s1_i1", "s1_i2"]


def test_sync_fold_sequence(spark):
    t0 = dt.datetime(2024, 1, 1)
    def attempt(id_, minutes):
        return spark.createDataFrame([(id_, "main", t0 + dt.timedelta(minutes=minutes), None)], S.STARTS)

    def log(*events):
        out = events[0]
        for e in events[1:]:
            out = out.unionByName(e)
        return S.final_states(out)

    s1, s2 = attempt(1, 0), attempt(2, 1)
    rows = [S.start_events(s1), S.complete_events(s1, t0 + dt.timedelta(seconds=5), 10, mark=dt.datetime(2023, 12, 31)),
            S.start_events(s2), S.fail_events(s2, t0 + dt.timedelta(minutes=2), "x" * 2000)]
    assert {r["duration_seconds"] for r in log(*rows).collect()} == {5, 60}
    st = S.sync_fold(log(*rows)).first().asDict()
    assert st["successful_sync_count"] == 1 and st["failed_sync_count"] == 1
    assert len(st["last_error_message"]) == 1000 and st["last_sync_status"] == "error"
    assert st["last_sync_timestamp"] == dt.datetime(2023, 12, 31)
    # a completion without a mark leaves the mark unchanged
    s3 = attempt(3, 3)
    hist2 = log(*rows, S.start_events(s3), S.complete_events(s3, t0 + dt.timedelta(minutes=4), 0))
    assert S.sync_fold(hist2).first()["last_sync_timestamp"] == dt.datetime(2023, 12, 31)


def test_recent_average(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, "main", t0 + dt.timedelta(minutes=i), "success", 0, d, None, None, None, None)
            for i, d in enumerate([None, 0, 2, 4])]
    h = spark.createDataFrame(rows, S.HISTORY_SCHEMA)
    assert float(S.sync_recent_avg(h).first()["avg_duration"]) == 3.0


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, "c"), ("k", 2, "b"), ("j", 1, "z")],
                               "k string, o int, v string")
    got = {r["k"]: r["v"] for r in I.latest_per_key(df, "k", ["o"]).collect()}
    assert got == {"k": "c", "j": "z"}


def test_watermark_and_feed_filter(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),)], "submitted_date timestamp_ntz")
    assert I.feed_incremental(df, "2024-01-01 00:00:00").count() == 1
    assert I.feed_incremental(df, "2024-01-01 00:00:00", inclusive=True).count() == 2
    r = I.watermark_advance(df, "2025-01-01 00:00:00").first()
    assert r["new_mark"] == dt.datetime(2025, 1, 1)
    empty = df.where(F.lit(False))
    assert I.watermark_advance(empty, "2023-01-01 00:00:00").first()["new_mark"] == dt.datetime(2023, 1, 1)


def test_columns_of_one_flag_keep_their_order_once(spark):
    """The record that a column's value comes from is found once for all columns with the same flag."""
    kind = "k string, a string, b string, c string, d string, has_a boolean, has_c boolean, n int"
    rows = [("x", "a1", "b1", "c1", "d1", True, True, 1), ("x", "a2", None, "c2", None, False, True, 2), ("x", "a3", "b3", "c3", "d3", True, False, None),
            ("y", "a4", "b4", "c4", "d4", False, None, 1), (None, "z", "z", "z", "z", True, True, 9)]
    red = I.reduce_batch(spark.createDataFrame(rows, kind), "k", ["a", "b", "c", "d"], ["n"], {"a": "has_a", "c": "has_c"})
    assert red.columns == ["k", "a", "b", "c", "d", "_has_a", "_has_b", "_has_c", "_has_d"]
    text = red._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_max_by(") == 3  # one for each flag, one for the columns without
    assert sorted(map(tuple, red.collect())) == [("x", "a1", None, "c2", None, True, True, True, True), ("y", None, "b4", None, "d4", False, True, False, True)]
