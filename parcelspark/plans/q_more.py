"""Registered queries under the inventory's own key names for operators that are column groups or
projections of larger plans (W2-W6, L1, J1, J10, J13, A4, A5, A20, A21, P18, P19, P22, P48, P49, R4, U1,
T6-T8, T10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions import labels as L
from parcelspark.operators import links as LK
from parcelspark.operators import nested as N
from parcelspark.operators import quality as Q
from parcelspark.operators import sync_state as S
from parcelspark.operators import unified as U
from parcelspark.plans import duck as D
from parcelspark.plans import oracle_unified as O
from parcelspark.plans.q_ingest import _FOLD_SQL as FOLD_SQL
from parcelspark.plans.registry import register, views

AS_OF = U.DEFAULT_AS_OF
UNIFIED_SQL = O.unified_sql()


def _unified_subset(key: str, cols: list[str]):
    sql = f"SELECT {', '.join(cols)} FROM ({UNIFIED_SQL}) u"

    def q(spark, sf):
        props, persons = views(spark, sf, "properties", "persons")
        return U.unified_dataset(props, persons, as_of=AS_OF).select(*cols)
    register(key, sql)(q)


_unified_subset("income_by_type", ["uuid", "person_uuid", "ci", "ri", "bi"])
_unified_subset("tax_by_type", ["uuid", "person_uuid", "ctl", "rtl", "btl", "commercial_tl",
                                "residential_tax_liability", "business_tax_liability"])
_unified_subset("total_building_rent", ["uuid", "person_uuid", "total_building_rent"])
_unified_subset("owner_flag", ["uuid", "person_uuid", "sum_owner"])
_unified_subset("money_formatted", ["uuid", "person_uuid", "ctl_formatted", "rtl_formatted", "btl_formatted",
                                   "total_building_rent_formatted"])
_unified_subset("quality_score", ["uuid", "person_uuid", "data_quality_score"])
_unified_subset("audit_columns", ["uuid", "person_uuid", "processed_at", "tax_year"])
_unified_subset("join_property_persons", ["uuid", "person_uuid", "property_name", "first_name"])


@register("unified_ordered", f"SELECT * FROM ({O.unified_sql(limit=K.RESULT_ROW_LIMIT)}) u")
def unified_ordered(spark, sf):
    """L1: the original's ORDER BY property, person LIMIT 50000 (a top-N; the limit is the feature)."""
    props, persons = views(spark, sf, "properties", "persons")
    return U.unified_dataset(props, persons, as_of=AS_OF, limit=K.RESULT_ROW_LIMIT)


@register("norm_property_use", D.with_views("persons") + "," + O.person_base_sql() + """
SELECT uuid AS person_uuid, property_use_raw AS norm_property_use FROM pg""")
def norm_property_use(spark, sf):
    m = U.person_measures(views(spark, sf, "persons"))
    return m.select("person_uuid", F.col("property_use_raw").alias("norm_property_use"))


@register("norm_basis", D.with_views("persons") + "," + O.person_base_sql() + """
SELECT uuid AS person_uuid, person_basis_raw AS norm_basis FROM pg""")
def norm_basis(spark, sf):
    m = U.person_measures(views(spark, sf, "persons"))
    return m.select("person_uuid", F.col("person_basis_raw").alias("norm_basis"))


@register("tax_rates", D.with_views("persons") + "," + O.person_base_sql() + """
SELECT uuid AS person_uuid, income_type,
       CASE income_type WHEN 'commercial' THEN CAST(0.15 AS DECIMAL(4,2)) WHEN 'residential_rental'
            THEN CAST(0.08 AS DECIMAL(4,2)) WHEN 'business' THEN CAST(0.27 AS DECIMAL(4,2)) END AS tax_rate FROM pg""")
def tax_rates(spark, sf):
    m = U.person_measures(views(spark, sf, "persons"))
    return m.select("person_uuid", "income_type",
                    L.tax_rate_for(F.col("income_type")).cast("decimal(4,2)").alias("tax_rate"))


@register("rates_dimension", D.with_views("persons") + "," + O.person_base_sql() + """,
r AS (SELECT * FROM (VALUES ('dalasi', CAST(1.00 AS DECIMAL(6,2))), ('euro', CAST(76.92 AS DECIMAL(6,2))),
        ('usd', CAST(71.43 AS DECIMAL(6,2))), ('pounds', CAST(90.91 AS DECIMAL(6,2)))) t(currency, rate_to_gmd))
SELECT pg.uuid AS person_uuid, pg.rent_currency_raw AS currency, r.rate_to_gmd,
       coalesce(CAST(pg.annual_rent * r.rate_to_gmd AS DECIMAL(24,6)), CAST(0 AS DECIMAL(24,6))) AS annual_rent_gmd
FROM pg LEFT JOIN r ON r.currency = pg.rent_currency_raw""")
def rates_dimension(spark, sf):
    """Conversion through a rates dimension.  The dimension has one row per currency (a proven
    bound of four rows built from the fixed rates), so it is broadcast."""
    rates = spark.createDataFrame([(k, v) for k, v in K.RATES_TO_GMD.items()], "currency string, rate_to_gmd decimal(6,2)")
    m = U.person_measures(views(spark, sf, "persons"))
    j = m.join(F.broadcast(rates), m["rent_currency_raw"] == rates["currency"], "left")
    return j.select("person_uuid", F.col("rent_currency_raw").alias("currency"), "rate_to_gmd",
                    F.coalesce((F.col("annual_rent") * F.col("rate_to_gmd")).cast("decimal(24,6)"),
                               F.lit(0).cast("decimal(24,6)")).alias("annual_rent_gmd"))


@register("fk_sample_left", D.with_views("properties", "persons") + """
SELECT m.uuid, p.uuid AS person_uuid, p.individual_first_name FROM properties m
LEFT JOIN persons p ON p.submissions_id = m.uuid ORDER BY m.uuid, p.uuid LIMIT 10""")
def fk_sample_left(spark, sf):
    """A sample of the FK left join (the limit is the sampling feature)."""
    props, persons = views(spark, sf, "properties", "persons")
    # every property gives a row at least, so the first ten properties hold the first ten rows
    first = Q.sample_rows(props.select("uuid"), 10, ["uuid"])
    own = persons.select(F.col("submissions_id"), F.col("uuid").alias("person_uuid"), "individual_first_name")
    j = first.join(own, F.col("submissions_id") == F.col("uuid"), "left").drop("submissions_id")
    return Q.sample_rows(j, 10, ["uuid", "person_uuid"])


_NESTED_COUNTS = D.with_views("properties", "persons") + """,
r AS (SELECT split_part(uuid, '_', 1) AS prop_uuid, count(*) AS n FROM persons WHERE uuid IS NOT NULL AND uuid <> ''
      GROUP BY 1),
nt AS (SELECT p.uuid, coalesce(r.n, 0) AS n FROM properties p LEFT JOIN r ON r.prop_uuid = p.uuid)
"""


@register("nested_audit_doc", _NESTED_COUNTS + """
SELECT count(*) AS total_records, count(*) FILTER (WHERE n = 0) AS empty_person_details,
       count(*) FILTER (WHERE n > 0) AS populated_person_details FROM nt""")
def nested_audit_doc(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.counts_audit(N.property_counts(props, persons)).select(
        "total_records", "empty_person_details", "populated_person_details")


@register("populated_ratio", _NESTED_COUNTS + """
SELECT count(*) FILTER (WHERE n > 0) AS populated_person_details, count(*) AS total_records,
       CAST(round(count(*) FILTER (WHERE n > 0) * 100.0 / count(*), 1) AS DECIMAL(5,1)) AS populated_pct,
       CASE WHEN count(*) FILTER (WHERE n > 0) > 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM nt""")
def populated_ratio(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.counts_audit(N.property_counts(props, persons)).select(
        "populated_person_details", "total_records", "populated_pct", "verdict")


@register("union_placeholder", D.with_views("properties", "persons") + """,
k AS (SELECT DISTINCT split_part(uuid, '_', 1) AS prop_uuid FROM persons WHERE uuid IS NOT NULL AND uuid <> '')
SELECT p.uuid, CAST(1 AS INTEGER) AS person_pos, true AS placeholder FROM properties p
WHERE p.uuid NOT IN (SELECT prop_uuid FROM k)""")
def union_placeholder(spark, sf):
    """The placeholder rows (properties whose list is empty) of the unnest."""
    props, persons = views(spark, sf, "properties", "persons")
    none = N.property_counts(props, persons).where("person_count = 0")
    return none.select("uuid", F.lit(1).alias("person_pos"), F.lit(True).alias("placeholder"))


@register("object_key", D.with_views("properties") + f"""
SELECT uuid, field, '{K.ATTACHMENT_BASE_FOLDER}/' || CASE field WHEN 'building_image' THEN 'building-images'
  WHEN 'address_plus_code' THEN 'address-plus-code-images' ELSE 'building-images' END || '/' || uuid || '-' || f
  AS object_key
FROM (SELECT uuid, 'building_image' AS field, 'b.jpg' AS f FROM properties
      UNION ALL SELECT uuid, 'address_plus_code', 'p.jpg' FROM properties
      UNION ALL SELECT uuid, 'signature', 's.png' FROM properties)""")
def object_key(spark, sf):
    p = views(spark, sf, "properties").select("uuid")
    kinds = F.explode(F.array(*[F.struct(F.lit(a).alias("field"), F.lit(b).alias("f"))
                                for a, b in [("building_image", "b.jpg"), ("address_plus_code", "p.jpg"),
                                             ("signature", "s.png")]]))
    x = p.select("uuid", kinds.alias("k")).select("uuid", "k.field", "k.f")
    return x.select("uuid", "field", LK.object_key(F.col("uuid"), F.col("field"), F.col("f")).alias("object_key"))


@register("integrity_verdict", D.with_views("properties", "persons") + """,
m AS (SELECT count(DISTINCT p.submissions_id) AS mp, count(*) AS mpe
      FROM persons p JOIN properties m ON m.uuid = p.submissions_id)
SELECT CASE WHEN (SELECT count(*) FROM properties) = 0 THEN 'EMPTY_MAIN'
            WHEN (SELECT count(*) FROM persons) = 0 THEN 'EMPTY_PERSONS'
            WHEN mp = 0 THEN 'NO_MATCHING_PROPERTIES' WHEN mpe = 0 THEN 'NO_MATCHING_PERSONS' ELSE 'OK' END AS verdict
FROM m""")
def integrity_verdict(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.fk_integrity(props, persons).select("verdict")


# ---- sync events applied to the log (T6-T8, T10) then folded (A21) ----------------------------
NOW = dt.datetime(2024, 1, 31)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def _with_events(h, kind: str):
    """Append one event per sync type present in the log, built from the log itself by the library's constructors."""
    types = h.select("sync_type").distinct()
    # a number for each type from a hash of its name: no window over all types
    starts = types.select((F.lit(1000000) + F.pmod(F.xxhash64("sync_type"), F.lit(1000000000))).cast("int").alias("id"),
                          "sync_type", F.lit(str(NOW)).cast("timestamp_ntz").alias("sync_timestamp"),
                          F.lit("host-x").alias("service_instance"))
    end = NOW + dt.timedelta(seconds=90)
    events = {"start": lambda: S.start_events(starts), "complete": lambda: S.complete_events(starts, end, 7),
              "fail": lambda: S.fail_events(starts, end, "failed: " + "x" * 1200),
              "mark": lambda: S.mark_set_events(starts, dt.datetime(2024, 1, 30, 12))}[kind]()
    if kind in ("complete", "fail"):
        events = S.final_states(S.start_events(starts).unionByName(events))
    return h.unionByName(events)


def _events_sql(kind: str) -> str:
    status = {"start": "in_progress", "complete": "success", "fail": "error", "mark": "success"}[kind]
    rec = {"complete": "7", "mark": "0"}.get(kind, "NULL")
    dur = {"complete": "90", "fail": "90", "mark": "0"}.get(kind, "NULL")
    err = "substr('failed: ' || repeat('x', 1200), 1, 1000)" if kind == "fail" else "NULL"
    mark = "TIMESTAMP '2024-01-30 12:00:00'" if kind == "mark" else "CAST(NULL AS TIMESTAMP)"
    view = D.with_views("sync_history").replace("WITH sync_history AS", "WITH h0 AS", 1)
    events = f"""
, sync_history AS (SELECT * FROM h0 UNION ALL
  SELECT CAST(1000000 + dense_rank() OVER (ORDER BY sync_type) AS INTEGER), sync_type, {NOW_SQL}, '{status}',
         CAST({rec} AS INTEGER), CAST({dur} AS INTEGER), {err}, CAST(NULL AS VARCHAR), 'host-x', {mark}
  FROM (SELECT DISTINCT sync_type FROM h0))"""
    rest = FOLD_SQL[FOLD_SQL.index(",\no AS"):]
    return view + events + rest + "SELECT * FROM fold"


for _kind, _key in (("start", "sync_start"), ("complete", "sync_complete"), ("fail", "sync_fail"),
                    ("mark", "mark_set")):
    register(_key, _events_sql(_kind))(
        (lambda k: lambda spark, sf: S.sync_fold(_with_events(views(spark, sf, "sync_history"), k)))(_kind))

register("history_counters", FOLD_SQL + """
SELECT sync_type, successful_sync_count, failed_sync_count, last_sync_status, last_attempt_timestamp,
       last_records_processed FROM fold""")(
    lambda spark, sf: S.sync_fold(views(spark, sf, "sync_history")).select(
        "sync_type", "successful_sync_count", "failed_sync_count", "last_sync_status", "last_attempt_timestamp",
        "last_records_processed"))


@register("layout_unified", f"SELECT * FROM ({UNIFIED_SQL}) u")
def layout_unified(spark, sf):
    """The wide table in its write layout (range-partitioned on district and property, sorted by
    property and person inside each file); same rows as the flagship."""
    from parcelspark.operators.sinks import layout_unified as lay
    props, persons = views(spark, sf, "properties", "persons")
    return lay(U.unified_dataset(props, persons, as_of=AS_OF))
