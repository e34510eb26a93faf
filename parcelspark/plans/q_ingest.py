"""Registered queries: incremental ingest (S1, S3, T1-T5, W7, J8, P56) and sync bookkeeping
(T9-T17, A13-A17, A21, L3, L5)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from parcelspark.operators import ingest as I
from parcelspark.operators import sync_state as S
from parcelspark.operators import unified as U
from parcelspark.plans import duck as D
from parcelspark.plans import oracle_unified as O
from parcelspark.plans.registry import register, views
from parcelspark.session import shared_dir
from parcelspark.sources.schemas import INCOMING_SCHEMA, PERSONS_SCHEMA, TS_FORMAT
from parcelspark.streaming.incremental import land_json

ORDER = ["submitted_date", "seq", "tb1", "tb2", "tb3"]
ORDER_SQL = "submitted_date DESC, seq DESC, tb1 DESC, tb2 DESC, tb3 DESC"
UPSERT_COLS = ["sum_owner", "logo", "sum_landlord"]
PRESENCE = {"sum_owner": "has_sum_owner", "logo": "has_logo", "sum_landlord": "has_sum_landlord"}
FEED_MARK = "2000-01-01 00:00:00"
CURRENT_MARK = "2001-06-01 00:00:00"
NOW = dt.datetime(2024, 1, 31)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def avg_exact_sql(total: str, n: str, scale: int = 4) -> str:
    m = 10 ** scale
    return (f"CAST(CAST((2 * {m} * {total} + {n}) // (2 * {n}) AS DECIMAL(30,0)) * CAST(0.{'0' * (scale - 1)}1 "
            f"AS DECIMAL({scale + 1},{scale})) AS DECIMAL(18,{scale}))")


def _landed(spark, table, schema):
    """The table as JSON feed files in the shared folder, read again as a feed."""
    path = f"{shared_dir(spark)}/feed-{uuid.uuid4().hex}"
    land_json(table, path)
    return I.read_feed(spark, path, schema, TS_FORMAT)


# ---- ingest ---------------------------------------------------------------------------------------
@register("feed_incremental", D.with_views("incoming") + f"""
SELECT * FROM incoming WHERE submitted_date > TIMESTAMP '{FEED_MARK}'""")
def feed_incremental(spark, sf):
    """S1 as a user runs it: landed JSON records, read with a schema, from the mark on."""
    return I.feed_incremental(_landed(spark, views(spark, sf, "incoming"), INCOMING_SCHEMA), FEED_MARK)


@register("feed_full_child", D.with_views("persons") + "\nSELECT * FROM persons")
def feed_full_child(spark, sf):
    """The whole child feed, without a mark, from landed JSON records."""
    return I.feed_incremental(_landed(spark, views(spark, sf, "persons"), PERSONS_SCHEMA), None)


@register("normalize_submission", D.with_views("properties") + f"""
SELECT coalesce(uuid, id) AS uuid, {D.jx('system_json', '$.submissionDate')} AS submission_date_text,
       TRY_CAST({D.jx('system_json', '$.submissionDate')} AS TIMESTAMP) AS submitted_at FROM properties""")
def normalize_submission(spark, sf):
    return I.normalize_submission(views(spark, sf, "properties")).select("uuid", "submission_date_text",
                                                                          "submitted_at")


@register("feed_parse_timestamps", D.with_views("properties") + f"""
SELECT uuid, {D.jx('system_json', '$.surveyDate')} AS survey_text,
       TRY_CAST({D.jx('system_json', '$.surveyDate')} AS TIMESTAMP) AS survey_ts FROM properties""")
def feed_parse_timestamps(spark, sf):
    p = views(spark, sf, "properties")
    t = F.get_json_object("system_json", "$.surveyDate")
    return p.select("uuid", t.alias("survey_text"), I.parse_iso_timestamp(t).alias("survey_ts"))


@register("rename_select_known", D.with_views("properties") + """
SELECT uuid, id, system_json AS system, person_details_link, logo FROM properties""")
def rename_select_known(spark, sf):
    p = views(spark, sf, "properties")
    raw = p.select("uuid", F.col("id").alias("__id"), F.col("system_json").alias("__system"),
                   F.col("person_details_link").alias("person_details@odata.navigationLink"), "logo",
                   F.lit("x").alias("unknown_field"))
    return I.rename_select_known(raw, I.MAIN_RENAMES, ["uuid", "id", "system", "person_details_link", "logo"])


@register("latest_per_key", D.with_views("incoming") + f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY {ORDER_SQL}) AS rn
FROM incoming) WHERE rn = 1""")
def latest_per_key(spark, sf):
    return I.latest_per_key(views(spark, sf, "incoming"), "uuid", ORDER)


def _upsert_sql():
    lasts = []
    for c in UPSERT_COLS:
        lasts.append(f"""l_{c} AS (SELECT uuid, {c} FROM (SELECT uuid, {c},
            row_number() OVER (PARTITION BY uuid ORDER BY {ORDER_SQL}) AS rn FROM incoming
            WHERE uuid IS NOT NULL AND {PRESENCE[c]}) WHERE rn = 1)""")
    keys = "k AS (SELECT DISTINCT uuid FROM incoming WHERE uuid IS NOT NULL UNION SELECT uuid FROM properties)"
    sel = ", ".join(f"CASE WHEN l_{c}.uuid IS NOT NULL THEN l_{c}.{c} ELSE s.{c} END AS {c}" for c in UPSERT_COLS)
    joins = " ".join(f"LEFT JOIN l_{c} ON l_{c}.uuid = k.uuid" for c in UPSERT_COLS)
    return (D.with_views("properties", "incoming") + ",\n" + ",\n".join(lasts) + ",\n" + keys +
            f"\nSELECT k.uuid, {sel} FROM k LEFT JOIN properties s ON s.uuid = k.uuid {joins}")


@register("upsert_properties", _upsert_sql())
def upsert_properties(spark, sf):
    props, inc = views(spark, sf, "properties", "incoming")
    return I.upsert(props, inc, "uuid", UPSERT_COLS, ORDER, PRESENCE)


_DERIVED = """(CASE WHEN (SELECT bool_or(uuid IS NULL) FROM persons) AND id IS NOT NULL AND submissions_id IS NOT NULL
  THEN submissions_id || '_' || id ELSE uuid END)"""


@register("derive_person_uuid", D.with_views("persons") + f"""
SELECT * FROM (SELECT {_DERIVED} AS uuid, id, submissions_id FROM persons) WHERE uuid IS NOT NULL""")
def derive_person_uuid(spark, sf):
    return I.derive_person_uuid(views(spark, sf, "persons")).select("uuid", "id", "submissions_id")


PERSON_UPSERT_COLS = ["individual_first_name", "tin", "email"]


@register("upsert_persons", D.with_views("persons") + f""",
b0 AS (SELECT * FROM (SELECT {_DERIVED} AS uuid, id, individual_first_name, tin, email FROM persons)
       WHERE uuid IS NOT NULL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY id DESC) AS rn FROM b0) WHERE rn = 1),
s AS (SELECT uuid, individual_first_name, tin, email FROM persons WHERE uuid IS NOT NULL AND uuid <> '')
SELECT coalesce(b.uuid, s.uuid) AS uuid,
  CASE WHEN b.uuid IS NOT NULL THEN b.individual_first_name ELSE s.individual_first_name END AS individual_first_name,
  CASE WHEN b.uuid IS NOT NULL THEN b.tin ELSE s.tin END AS tin,
  CASE WHEN b.uuid IS NOT NULL THEN b.email ELSE s.email END AS email
FROM s FULL OUTER JOIN b ON s.uuid = b.uuid""")
def upsert_persons(spark, sf):
    p = views(spark, sf, "persons")
    stored = p.where(F.col("uuid").isNotNull() & (F.col("uuid") != ""))
    batch = I.derive_person_uuid(p)
    return I.upsert(stored, batch, "uuid", PERSON_UPSERT_COLS, ["id"])


@register("persons_of_batch", D.with_views("persons", "incoming") + """
SELECT uuid, submissions_id FROM persons WHERE submissions_id IN (SELECT uuid FROM incoming)""")
def persons_of_batch(spark, sf):
    p, inc = views(spark, sf, "persons", "incoming")
    return I.persons_of_batch(p, inc).select("uuid", "submissions_id")


@register("watermark_advance", D.with_views("incoming") + f"""
SELECT max(submitted_date) AS batch_max,
       CASE WHEN max(submitted_date) IS NULL THEN TIMESTAMP '{CURRENT_MARK}'
            ELSE greatest(max(submitted_date), TIMESTAMP '{CURRENT_MARK}') END AS new_mark FROM incoming""")
def watermark_advance(spark, sf):
    return I.watermark_advance(views(spark, sf, "incoming"), CURRENT_MARK)


@register("max_watermark", D.with_views("properties") + """
SELECT max(submitted_date) AS max_submitted FROM properties""")
def max_watermark(spark, sf):
    return views(spark, sf, "properties").agg(F.max("submitted_date").alias("max_submitted"))


@register("key_coverage", D.with_views("persons") + """
SELECT bool_and(uuid IS NOT NULL) AS all_have_uuid, count(*) FILTER (WHERE uuid IS NOT NULL) AS with_uuid,
       count(*) AS total FROM persons""")
def key_coverage(spark, sf):
    p = views(spark, sf, "persons")
    return p.agg(F.bool_and(F.col("uuid").isNotNull()).alias("all_have_uuid"),
                 F.count_if(F.col("uuid").isNotNull()).alias("with_uuid"), F.count(F.lit(1)).alias("total"))


@register("images_processed", D.with_views("properties") + """
SELECT count(*) FILTER (WHERE building_image_url IS NOT NULL) AS with_building_url,
       count(*) FILTER (WHERE address_plus_code_url IS NOT NULL) AS with_plus_code_url FROM properties""")
def images_processed(spark, sf):
    p = views(spark, sf, "properties")
    return p.agg(F.count_if(F.col("building_image_url").isNotNull()).alias("with_building_url"),
                 F.count_if(F.col("address_plus_code_url").isNotNull()).alias("with_plus_code_url"))


# ---- sync bookkeeping -----------------------------------------------------------------------------
HIST = D.with_views("sync_history")
_FOLD_SQL = HIST + """,
o AS (SELECT *, row_number() OVER (PARTITION BY sync_type ORDER BY sync_timestamp DESC, id DESC) AS rn FROM sync_history),
ls AS (SELECT * FROM (SELECT sync_type, records_processed,
         row_number() OVER (PARTITION BY sync_type ORDER BY sync_timestamp DESC, id DESC) AS rn
         FROM sync_history WHERE status = 'success') WHERE rn = 1),
lm AS (SELECT * FROM (SELECT sync_type, sync_mark,
         row_number() OVER (PARTITION BY sync_type ORDER BY sync_timestamp DESC, id DESC) AS rn
         FROM sync_history WHERE status = 'success' AND sync_mark IS NOT NULL) WHERE rn = 1),
c AS (SELECT sync_type, max(sync_timestamp) AS last_attempt_timestamp,
        CAST(count(*) FILTER (WHERE status = 'success') AS INTEGER) AS successful_sync_count,
        CAST(count(*) FILTER (WHERE status = 'error') AS INTEGER) AS failed_sync_count FROM sync_history GROUP BY 1),
fold AS (SELECT c.sync_type, lm.sync_mark AS last_sync_timestamp, c.last_attempt_timestamp,
        o.status AS last_sync_status,
        CASE WHEN o.status = 'error' THEN substr(o.error_message, 1, 1000) END AS last_error_message,
        c.successful_sync_count, c.failed_sync_count, ls.records_processed AS last_records_processed
      FROM c JOIN o ON o.sync_type = c.sync_type AND o.rn = 1
      LEFT JOIN ls ON ls.sync_type = c.sync_type LEFT JOIN lm ON lm.sync_type = c.sync_type)
"""


@register("sync_fold", _FOLD_SQL + "SELECT * FROM fold")
def sync_fold(spark, sf):
    return S.sync_fold(views(spark, sf, "sync_history"))


@register("sync_statistics", _FOLD_SQL + """SELECT sync_type, last_sync_timestamp, last_attempt_timestamp,
  last_sync_status, successful_sync_count AS successful_syncs, failed_sync_count AS failed_syncs,
  last_records_processed, last_error_message AS last_error FROM fold""")
def sync_statistics(spark, sf):
    s = S.sync_fold(views(spark, sf, "sync_history"))
    return s.select("sync_type", "last_sync_timestamp", "last_attempt_timestamp", "last_sync_status",
                    F.col("successful_sync_count").alias("successful_syncs"),
                    F.col("failed_sync_count").alias("failed_syncs"), "last_records_processed",
                    F.col("last_error_message").alias("last_error"))


@register("types_in_error", _FOLD_SQL + """SELECT sync_type, last_error_message, last_attempt_timestamp FROM fold
WHERE last_sync_status = 'error'""")
def types_in_error(spark, sf):
    return S.types_in_error(S.sync_fold(views(spark, sf, "sync_history")))


@register("recent_history", HIST + """
SELECT * FROM sync_history ORDER BY sync_timestamp DESC, id DESC LIMIT 10""")
def recent_history(spark, sf):
    return S.recent_history(views(spark, sf, "sync_history"))


@register("failed_syncs", HIST + "\nSELECT * FROM sync_history WHERE status = 'error'")
def failed_syncs(spark, sf):
    return S.failed_syncs(views(spark, sf, "sync_history"))


@register("history_retention", HIST + f"""
SELECT * FROM sync_history WHERE sync_timestamp >= {NOW_SQL} - INTERVAL 30 DAYS""")
def history_retention(spark, sf):
    return S.history_retention(views(spark, sf, "sync_history"), NOW)


def _perf_sql(hourly: bool) -> str:
    hk = "date_trunc('hour', sync_timestamp) AS hour, " if hourly else ""
    return HIST + f"""
SELECT {hk}sync_type, {avg_exact_sql('sum(duration_seconds)', 'count(duration_seconds)')} AS avg_duration,
       CAST(sum(records_processed) AS BIGINT) AS total_records
FROM sync_history WHERE status = 'success' AND sync_timestamp > {NOW_SQL} - INTERVAL 24 HOURS
GROUP BY ALL"""


register("sync_perf_24h", _perf_sql(False))(lambda spark, sf: S.sync_perf(views(spark, sf, "sync_history"), NOW))
register("sync_perf_hourly", _perf_sql(True))(
    lambda spark, sf: S.sync_perf(views(spark, sf, "sync_history"), NOW, by_hour=True))


@register("sync_success_rate", HIST + """,
t AS (SELECT count(*) FILTER (WHERE status = 'success') AS total_successful,
             count(*) FILTER (WHERE status = 'error') AS total_failed FROM sync_history)
SELECT total_successful, total_failed,
  CASE WHEN total_successful + total_failed > 0
       THEN CAST(CAST((2 * 100000 * total_successful + total_successful + total_failed)
                      // (2 * (total_successful + total_failed)) AS DECIMAL(30,0)) * CAST(0.001 AS DECIMAL(4,3))
                 AS DECIMAL(7,3))
       ELSE CAST(0 AS DECIMAL(7,3)) END AS success_rate FROM t""")
def sync_success_rate(spark, sf):
    return S.sync_success_rate(S.sync_fold(views(spark, sf, "sync_history")))


@register("sync_recent_avg", HIST + f""",
top AS (SELECT * FROM sync_history ORDER BY sync_timestamp DESC, id DESC LIMIT 10)
SELECT {avg_exact_sql('sum(nullif(duration_seconds, 0))', 'count(nullif(duration_seconds, 0))')} AS avg_duration,
       count(nullif(duration_seconds, 0)) AS attempts_counted FROM top""")
def sync_recent_avg(spark, sf):
    return S.sync_recent_avg(views(spark, sf, "sync_history"))


@register("mark_merge", _FOLD_SQL + """,
b AS (SELECT sync_type, min(sync_timestamp) AS mark FROM sync_history WHERE status = 'error' GROUP BY 1)
SELECT coalesce(f.sync_type, b.sync_type) AS sync_type, greatest(f.last_sync_timestamp, b.mark) AS mark
FROM fold f FULL OUTER JOIN b ON f.sync_type = b.sync_type""")
def mark_merge(spark, sf):
    h = views(spark, sf, "sync_history")
    a = S.sync_fold(h).select("sync_type", F.col("last_sync_timestamp").alias("mark"))
    b = h.where(F.col("status") == "error").groupBy("sync_type").agg(F.min("sync_timestamp").alias("mark"))
    return S.mark_merge(a, b)


@register("mark_presence", _FOLD_SQL + """,
e AS (SELECT * FROM (VALUES ('main_submissions'), ('person_details'), ('image_processing'), ('url_refresh'))
      t(sync_type)),
h AS (SELECT sync_type, count(*) AS history_rows FROM sync_history GROUP BY 1)
SELECT e.sync_type, f.last_sync_timestamp IS NOT NULL AS has_mark, f.last_sync_timestamp,
       coalesce(h.history_rows, 0) AS history_rows
FROM e LEFT JOIN fold f ON f.sync_type = e.sync_type LEFT JOIN h ON h.sync_type = e.sync_type""")
def mark_presence(spark, sf):
    h = views(spark, sf, "sync_history")
    return S.mark_presence(spark, S.sync_fold(h), h)


@register("quality_trend", "SELECT processing_date, " + avg_exact_sql("sum(data_quality_score)", "count(*)") + """
  AS avg_quality_score, count(*) AS records_processed,
  count(*) FILTER (WHERE data_quality_score >= 80) AS high_quality_records
FROM (SELECT date_trunc('day', processed_at) AS processing_date, data_quality_score
      FROM (""" + O.unified_sql() + """) u WHERE processed_at >= TIMESTAMP '2024-07-01 00:00:00' - INTERVAL 30 DAYS)
GROUP BY processing_date""")
def quality_trend(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return S.quality_trend(U.unified_dataset(props, persons, as_of=U.DEFAULT_AS_OF), dt.datetime(2024, 7, 1))
