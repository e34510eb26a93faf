"""Registered queries: the reports of 2.12, each as one table of named values.

A report is several DataFrames; ``report_rows`` lays them under one another, one row per section, item and field.
The oracle builds the same rows from SQL of its own for every section."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.operators import nested as N
from parcelspark.operators.unified import unified_dataset
from parcelspark.plans import duck as D
from parcelspark.plans import oracle_unified as O
from parcelspark.plans import q_ingest, q_nested  # noqa: F401  (their oracles are parts of the reports)
from parcelspark.plans import q_links as QL
from parcelspark.plans import reports as R
from parcelspark.plans.q_unified import AS_OF
from parcelspark.plans.registry import ORACLE, register, views

# Sections and fields of each report: section -> (columns that name the item, columns that are its values)
VERIFY = {
    "audit": ([], ["total_records", "with_person_details", "empty_person_details", "populated_person_details", "populated_pct", "verdict"]),
    "top_properties": (["uuid"], ["person_count"]),
    "key_violations": (["uuid", "person_uuid"], ["violation", "occurrences"]),
}
INTEGRITY = {
    "row_counts": (["table_name"], ["row_count"]),
    "distinct_fk": (["submissions_id"], ["submissions_id"]),
    "fk_integrity": ([], ["main_count", "person_count", "named_persons", "matching_properties", "matching_persons", "verdict", "warning"]),
    "named_persons": (["uuid"], ["submissions_id", "individual_first_name", "individual_last_name", "business_name"]),
    "fk_rollup": (["prop_uuid"], ["person_count"]),
    "column_types": (["table_name", "column_name"], ["data_type"]),
}
PROFILE = {
    "main_keys": (["uuid"], ["uuid"]),
    "person_keys": (["uuid"], ["uuid"]),
    "match_pairs": (["main_uuid", "person_uuid"], ["match_type"]),
    "match_count": ([], ["total_relations"]),
    "containing_pairs": (["main_uuid", "person_uuid"], ["person_uuid"]),
    "prefix_pairs": (["main_uuid", "person_uuid"], ["contains"]),
    "row_counts": (["table_name"], ["row_count"]),
}
URLS = {
    "recent": (["uuid"], ["survey_date"]),
    "detail": (["uuid", "kind"], ["status", "expires_at"]),
    "histogram": (["kind", "status"], ["n", "pct"]),
}
HEALTH = {
    "status": (["sync_type"], ["last_sync_timestamp", "last_attempt_timestamp", "last_sync_status", "last_error_message",
                               "successful_sync_count", "failed_sync_count", "last_records_processed"]),
    "recent": (["id"], ["sync_type", "status", "sync_timestamp", "records_processed", "duration_seconds"]),
    "success_rate": ([], ["total_successful", "total_failed", "success_rate"]),
    "recent_avg": ([], ["avg_duration", "attempts_counted"]),
    "in_error": (["sync_type"], ["last_error_message", "last_attempt_timestamp"]),
}


def report_rows(report, shape):
    """``section, item, field, value``: all named DataFrames of a report as text, nothing collected."""
    out = None
    for section, (keys, fields) in shape.items():
        item = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]) if keys else F.lit("")
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields]))
        part = report[section].select(item.alias("item"), each.alias("f")).select(F.lit(section).alias("section"), "item", "f.field", "f.value")
        out = part if out is None else out.unionByName(part)
    return out


def report_sql(parts: dict[str, str], shape) -> str:
    """The same layout over one SELECT per section."""
    out = []
    for section, (keys, fields) in shape.items():
        item = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys) or "''"
        for c in fields:
            out.append(f"SELECT '{section}' AS section, {item} AS item, '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM ({parts[section]})")
    return "\nUNION ALL\n".join(out)


def _keys_sql(table: str, n: int = 5) -> str:
    return D.with_views(table) + f"SELECT uuid FROM {table} WHERE uuid IS NOT NULL ORDER BY uuid LIMIT {n}"


_VERIFY_SQL = report_sql({
    "audit": ORACLE["nested_audit"], "top_properties": ORACLE["top_properties_by_persons"],
    "key_violations": f"""SELECT uuid, person_uuid, CASE WHEN uuid IS NULL OR person_uuid IS NULL THEN 'null_key' ELSE 'duplicate' END AS violation, count(*) AS occurrences
FROM ({O.unified_sql()}) GROUP BY 1, 2 HAVING count(*) > 1 OR uuid IS NULL OR person_uuid IS NULL""",
}, VERIFY)


@register("verify_unified", _VERIFY_SQL)
def verify_unified(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return report_rows(R.verify_unified(N.nested_dataset(props, persons), unified_dataset(props, persons, as_of=AS_OF)), VERIFY)


_INTEGRITY_SQL = report_sql({
    "row_counts": ORACLE["row_counts"], "distinct_fk": ORACLE["distinct_fk"], "fk_integrity": ORACLE["fk_integrity_counts"],
    "named_persons": D.with_views("persons") + "SELECT * FROM persons WHERE individual_first_name IS NOT NULL OR business_name IS NOT NULL",
    "fk_rollup": ORACLE["persons_rollup_fk"],
    "column_types": "SELECT 'properties' AS table_name, 'uuid' AS column_name, 'string' AS data_type UNION ALL SELECT 'persons', 'submissions_id', 'string'",
}, INTEGRITY)


@register("integrity_report", _INTEGRITY_SQL)
def integrity_report(spark, sf):
    return report_rows(R.integrity_report(*views(spark, sf, "properties", "persons")), INTEGRITY)


_PROFILE_SQL = report_sql({
    "main_keys": _keys_sql("properties"), "person_keys": _keys_sql("persons"),
    "match_pairs": ORACLE["match_type_theta"], "match_count": ORACLE["match_count_theta"],
    "containing_pairs": D.with_views("properties", "persons") + "SELECT m.uuid AS main_uuid, p.uuid AS person_uuid FROM properties m JOIN persons p ON contains(p.uuid, m.uuid)",
    "prefix_pairs": ORACLE["last_underscore_pairs"], "row_counts": ORACLE["row_counts"],
}, PROFILE)


@register("relationship_profile", _PROFILE_SQL)
def relationship_profile(spark, sf):
    return report_rows(R.relationship_profile(*views(spark, sf, "properties", "persons")), PROFILE)


_DETAIL_SQL = f"""SELECT uuid, kind, {QL.d_status('u')} AS status, make_timestamp({QL.d_epoch('u')} * 1000000) AS expires_at FROM (
  SELECT uuid, 'building' AS kind, {QL.d_src('building_image_url_html')} AS u FROM ({ORACLE["recent_with_urls"]}) WHERE building_image_url_html <> ''
  UNION ALL SELECT uuid, 'plus_code', {QL.d_src('address_plus_code_url_html')} FROM ({ORACLE["recent_with_urls"]}) WHERE address_plus_code_url_html <> '') WHERE u IS NOT NULL"""
_URL_SQL = report_sql({
    "recent": ORACLE["recent_with_urls"], "detail": _DETAIL_SQL,
    "histogram": f"""SELECT kind, status, n, {QL.pct_tenths_sql('n', 'total')} AS pct
FROM (SELECT kind, status, n, sum(n) OVER (PARTITION BY kind) AS total FROM (SELECT kind, status, count(*) AS n FROM ({_DETAIL_SQL}) GROUP BY 1, 2))""",
}, URLS)


@register("url_report", _URL_SQL)
def url_report(spark, sf):
    """The fifty newest surveys with image HTML, as the report shows them."""
    return report_rows(R.url_report(views(spark, sf, "links"), QL.NOW_EPOCH), URLS)


_HEALTH_SQL = report_sql({
    "status": ORACLE["sync_fold"], "recent": ORACLE["recent_history"], "success_rate": ORACLE["sync_success_rate"],
    "recent_avg": ORACLE["sync_recent_avg"], "in_error": ORACLE["types_in_error"],
}, HEALTH)


@register("health_report", _HEALTH_SQL)
def health_report(spark, sf):
    return report_rows(R.health_report(views(spark, sf, "sync_history")), HEALTH)
