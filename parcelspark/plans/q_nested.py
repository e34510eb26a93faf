"""Registered queries: nested form (A1-A5, J2-J4, U1, W1, L2) and integrity/profiling (S6, S11, A7, A8,
J5-J7, J12, A20, P52-P55)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.operators import nested as N
from parcelspark.operators import quality as Q
from parcelspark.operators.unified import prop_key, valid_person_key
from parcelspark.plans import duck as D
from parcelspark.plans import oracle_unified as O
from parcelspark.operators.unified import DEFAULT_AS_OF as AS_OF
from parcelspark.plans.registry import register, views

PREFIX_KEY = "split_part(uuid, '_', 1)"
PREFIX_OK = "uuid IS NOT NULL AND uuid <> ''"
FK_KEY = "submissions_id"
FK_OK = "submissions_id IS NOT NULL AND trim(submissions_id) <> ''"


def _uuids():
    return F.array_join(F.transform("person_details", lambda x: F.coalesce(x["UUID"], F.lit("-"))), ",")


def _per_property(df, key, *extra):
    """The chunks of a property side by side, so the answer is the same for any chunk size."""
    parts = df.groupBy(key).agg(F.sum("person_count").alias("person_count"),
                                F.array_sort(F.collect_list(F.struct("person_offset", _uuids().alias("ids"))))
                                .alias("_p"), *extra)
    return parts.withColumn("person_uuids", F.array_join(F.transform("_p", lambda x: x["ids"]), ",")).drop("_p")


def _rollup_summary(df):
    names = F.size(F.filter("person_details", lambda x: x["individual_first_name"].isNotNull()))
    return _per_property(df, "prop_uuid", F.sum(names).cast("bigint").alias("first_names"))


def _rollup_oracle(key, ok):
    return D.with_views("persons") + f"""
SELECT {key} AS prop_uuid, count(*) AS person_count,
       string_agg(coalesce(uuid, '-'), ',' ORDER BY uuid NULLS LAST) AS person_uuids,
       count(individual_first_name) AS first_names
FROM persons WHERE {ok} GROUP BY 1"""


@register("persons_rollup", _rollup_oracle(PREFIX_KEY, PREFIX_OK))
def persons_rollup(spark, sf):
    return _rollup_summary(N.persons_rollup(views(spark, sf, "persons"), key="prefix"))


@register("persons_rollup_fk", _rollup_oracle(FK_KEY, FK_OK))
def persons_rollup_fk(spark, sf):
    return _rollup_summary(N.persons_rollup(views(spark, sf, "persons"), key="fk"))


def _nested_oracle(key, ok):
    return D.with_views("properties", "persons") + f""",
r AS (SELECT {key} AS prop_uuid, count(*) AS n,
             string_agg(coalesce(uuid, '-'), ',' ORDER BY uuid NULLS LAST) AS ids
      FROM persons WHERE {ok} GROUP BY 1)
SELECT p.uuid, coalesce(r.n, 0) AS person_count, coalesce(r.ids, '') AS person_uuids,
       {D.img_html('p.building_image_url')} AS building_image_url_html
FROM properties p LEFT JOIN r ON r.prop_uuid = p.uuid"""


def _nested_q(key):
    def q(spark, sf):
        props, persons = views(spark, sf, "properties", "persons")
        n = N.nested_dataset(props, persons, key=key)
        return _per_property(n, "uuid", F.first("building_image_url_html").alias("building_image_url_html"))
    return q


register("nested_left_prefix", _nested_oracle(PREFIX_KEY, PREFIX_OK))(_nested_q("prefix"))
register("nested_left_fk", _nested_oracle(FK_KEY, FK_OK))(_nested_q("fk"))


@register("unnest_persons", D.with_views("properties", "persons") + f""",
k AS (SELECT {PREFIX_KEY} AS prop_uuid, uuid FROM persons WHERE {PREFIX_OK})
SELECT p.uuid, CAST(coalesce(row_number() OVER (PARTITION BY p.uuid ORDER BY k.uuid), 1) AS INTEGER) AS person_pos,
       k.uuid IS NULL AS placeholder, k.uuid AS person_uuid
FROM properties p LEFT JOIN k ON k.prop_uuid = p.uuid""")
def unnest_persons(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    u = N.unnest_persons(N.nested_dataset(props, persons, key="prefix"))
    return u.select("uuid", "person_pos", "placeholder", F.col("person")["UUID"].alias("person_uuid"))


@register("person_index", D.with_views("persons") + f"""
SELECT uuid AS person_uuid, {PREFIX_KEY} AS prop_uuid,
       CAST(row_number() OVER (PARTITION BY {PREFIX_KEY} ORDER BY uuid) AS INTEGER) AS person_index
FROM persons WHERE {PREFIX_OK}""")
def person_index(spark, sf):
    p = views(spark, sf, "persons").where(valid_person_key(F.col("uuid")))
    p = p.select(F.col("uuid").alias("person_uuid"), prop_key(F.col("uuid")).alias("prop_uuid"))
    return N.person_index(p, "prop_uuid", "person_uuid")


@register("person_index_bounded", D.with_views("persons") + f"""
SELECT uuid AS person_uuid, substr(uuid, 1, 6) AS grp,
       CAST(row_number() OVER (PARTITION BY substr(uuid, 1, 6) ORDER BY uuid) AS INTEGER) AS person_index
FROM persons WHERE {PREFIX_OK}""")
def person_index_bounded(spark, sf):
    """W1 over nine hot groups, in slices of at most 500 rows."""
    p = views(spark, sf, "persons").where(valid_person_key(F.col("uuid")))
    p = p.select(F.col("uuid").alias("person_uuid"), F.substring("uuid", 1, 6).alias("grp"))
    return N.person_index(p, "grp", "person_uuid", slice_chars=1, bound=500)


_AUDIT_SQL = D.with_views("properties", "persons") + f""",
r AS (SELECT {PREFIX_KEY} AS prop_uuid, count(*) AS n FROM persons WHERE {PREFIX_OK} GROUP BY 1),
nt AS (SELECT p.uuid, coalesce(r.n, 0) AS n FROM properties p LEFT JOIN r ON r.prop_uuid = p.uuid),
a AS (SELECT count(*) AS total_records, count(*) AS with_person_details, CAST(0 AS BIGINT) AS null_person_details,
             count(*) FILTER (WHERE n = 0) AS empty_person_details,
             count(*) FILTER (WHERE n > 0) AS populated_person_details FROM nt)
SELECT *, CAST(round(populated_person_details * 100.0 / total_records, 1) AS DECIMAL(5,1)) AS populated_pct,
       CASE WHEN null_person_details = 0 AND populated_person_details > 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM a"""


@register("nested_audit", _AUDIT_SQL)
def nested_audit(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.counts_audit(N.property_counts(props, persons))


@register("top_properties_by_persons", D.with_views("properties", "persons") + f"""
SELECT {PREFIX_KEY} AS uuid, CAST(count(*) AS INTEGER) AS person_count FROM persons WHERE {PREFIX_OK}
  AND {PREFIX_KEY} IN (SELECT uuid FROM properties) GROUP BY 1 ORDER BY person_count DESC, uuid LIMIT 3""")
def top_properties_by_persons(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.top_properties_by_persons(N.property_counts(props, persons))


# ---- integrity and profiling ------------------------------------------------------------------
@register("assert_composite_key", D.with_views("persons") + """
SELECT uuid, 'duplicate' AS violation, count(*) AS occurrences FROM persons WHERE uuid IS NOT NULL
GROUP BY uuid HAVING count(*) > 1
UNION ALL
SELECT uuid, 'null_key' AS violation, count(*) AS occurrences FROM persons WHERE uuid IS NULL GROUP BY uuid""")
def assert_composite_key(spark, sf):
    return Q.assert_composite_key(views(spark, sf, "persons"), ["uuid"])


@register("sample_rows", D.with_views("properties") + """
SELECT uuid, submitted_date FROM properties ORDER BY uuid LIMIT 5""")
def sample_rows(spark, sf):
    return Q.sample_rows(views(spark, sf, "properties").select("uuid", "submitted_date"), 5, ["uuid"])


@register("row_counts", D.with_views("properties", "persons") + """
SELECT 'properties' AS table_name, count(*) AS row_count FROM properties
UNION ALL SELECT 'persons', count(*) FROM persons""")
def row_counts(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.row_counts(properties=props, persons=persons)


@register("distinct_fk", D.with_views("persons") + """
SELECT DISTINCT submissions_id FROM persons WHERE submissions_id IS NOT NULL""")
def distinct_fk(spark, sf):
    return views(spark, sf, "persons").where(F.col("submissions_id").isNotNull()).select("submissions_id").distinct()


@register("fk_integrity_counts", D.with_views("properties", "persons") + """,
m AS (SELECT count(DISTINCT p.submissions_id) AS matching_properties, count(*) AS matching_persons
      FROM persons p JOIN properties m ON m.uuid = p.submissions_id),
c AS (SELECT (SELECT count(*) FROM properties) AS main_count, count(*) AS person_count,
             count(*) FILTER (WHERE individual_first_name IS NOT NULL OR business_name IS NOT NULL) AS named_persons
      FROM persons)
SELECT c.*, m.*,
  CASE WHEN main_count = 0 THEN 'EMPTY_MAIN' WHEN person_count = 0 THEN 'EMPTY_PERSONS'
       WHEN matching_properties = 0 THEN 'NO_MATCHING_PROPERTIES' WHEN matching_persons = 0 THEN 'NO_MATCHING_PERSONS'
       ELSE 'OK' END AS verdict,
  CASE WHEN main_count > 0 AND person_count > 0 AND matching_properties > 0 AND matching_persons > 0
            AND named_persons = 0 THEN 'NO_NAMED_PERSONS' END AS warning
FROM c, m""")
def fk_integrity_counts(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.fk_integrity(props, persons)


_THETA = D.with_views("properties", "persons") + """,
j AS (SELECT m.uuid AS main_uuid, p.uuid AS person_uuid, p.individual_first_name, p.business_name,
        CASE WHEN p.uuid LIKE m.uuid || '%' THEN 'DIRECT_MATCH'
             WHEN split_part(p.uuid, '_', 1) = m.uuid THEN 'PREFIX_MATCH' ELSE 'NO_MATCH' END AS match_type
      FROM properties m JOIN persons p ON p.uuid LIKE m.uuid || '%' OR split_part(p.uuid, '_', 1) = m.uuid)
"""


@register("match_type_theta", _THETA + "SELECT * FROM j")
def match_type_theta(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.match_type_join(props, persons).select("main_uuid", "person_uuid", "individual_first_name",
                                                    "business_name", "match_type")


@register("match_count_theta", _THETA + "SELECT count(*) AS total_relations FROM j")
def match_count_theta(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.match_type_join(props, persons).agg(F.count(F.lit(1)).alias("total_relations"))


# Keys that hold a wildcard, and keys that lie at the start, inside and at the end of person keys.
_WILD_KEYS = "SELECT replace(uuid, '7', '_') AS uuid FROM properties UNION ALL SELECT replace(uuid, '25', '%5') FROM properties"
_INNER_KEYS = """SELECT uuid FROM properties UNION ALL SELECT substr(uuid, 4) FROM properties
UNION ALL SELECT substr(uuid, 6) || '_1' FROM properties"""


@register("match_type_wildcards", D.with_views("properties", "persons") + f""",
k AS ({_WILD_KEYS})
SELECT k.uuid AS main_uuid, p.uuid AS person_uuid,
  CASE WHEN p.uuid LIKE k.uuid || '%' THEN 'DIRECT_MATCH' ELSE 'PREFIX_MATCH' END AS match_type
FROM k JOIN persons p ON p.uuid LIKE k.uuid || '%' OR split_part(p.uuid, '_', 1) = k.uuid""")
def match_type_wildcards(spark, sf):
    """J5 with property keys that LIKE does not take literally."""
    props, persons = views(spark, sf, "properties", "persons")
    return Q.match_type_join(spark.sql(_WILD_KEYS.replace("properties", "{p}"), p=props), persons).select("main_uuid", "person_uuid", "match_type")


@register("contains_pairs", D.with_views("properties", "persons") + f""",
k AS ({_INNER_KEYS})
SELECT k.uuid AS main_uuid, p.uuid AS person_uuid FROM k JOIN persons p ON contains(p.uuid, k.uuid)""")
def contains_pairs(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.containing_pairs(spark.sql(_INNER_KEYS.replace("properties", "{p}"), p=props), persons)


@register("last_underscore_pairs", D.with_views("properties", "persons") + """
SELECT m.uuid AS main_uuid, p.uuid AS person_uuid, true AS contains
FROM persons p JOIN properties m ON regexp_replace(p.uuid, '_[^_]*$', '') = m.uuid WHERE p.uuid LIKE '%\\_%' ESCAPE '\\'""")
def last_underscore_pairs(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return Q.last_underscore_prefix_pairs(props, persons).select("main_uuid", "person_uuid", "contains")


@register("filter_valid_person_key", D.with_views("persons") + f"""
SELECT uuid, {PREFIX_KEY} AS prop_uuid FROM persons WHERE {PREFIX_OK}""")
def filter_valid_person_key(spark, sf):
    p = views(spark, sf, "persons")
    return p.where(valid_person_key(F.col("uuid"))).select("uuid", prop_key(F.col("uuid")).alias("prop_uuid"))


@register("filter_has_persons", D.with_views("properties", "persons") + f"""
SELECT uuid FROM properties WHERE uuid IN (SELECT {PREFIX_KEY} FROM persons WHERE {PREFIX_OK})""")
def filter_has_persons(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    keys = persons.where(valid_person_key(F.col("uuid"))).select(prop_key(F.col("uuid")).alias("uuid"))
    return props.join(keys, "uuid", "left_semi").select("uuid")


@register("filter_named_persons", D.with_views("persons") + """
SELECT uuid, submissions_id, individual_first_name, business_name FROM persons
WHERE individual_first_name IS NOT NULL OR business_name IS NOT NULL""")
def filter_named_persons(spark, sf):
    p = views(spark, sf, "persons")
    return (p.where(F.col("individual_first_name").isNotNull() | F.col("business_name").isNotNull())
            .select("uuid", "submissions_id", "individual_first_name", "business_name"))


@register("filter_named_persons_strict", D.with_views("persons") + """
SELECT uuid, submissions_id FROM persons
WHERE (individual_first_name IS NOT NULL AND individual_first_name <> '')
   OR (business_name IS NOT NULL AND business_name <> '')""")
def filter_named_persons_strict(spark, sf):
    p = views(spark, sf, "persons")
    f, b = F.col("individual_first_name"), F.col("business_name")
    return p.where((f.isNotNull() & (f != "")) | (b.isNotNull() & (b != ""))).select("uuid", "submissions_id")


@register("unified_from_nested", O.nested_unified_sql())
def unified_from_nested(spark, sf):
    """The nested table is a stored table in the original; it is written once as Parquet in the session's
    shared folder and each branch of the variant reads the columns it needs."""
    import uuid

    from parcelspark.session import shared_dir

    props, persons = views(spark, sf, "properties", "persons")
    path = f"{shared_dir(spark)}/nested-{uuid.uuid4().hex}"
    N.nested_dataset(props, persons, key="prefix").write.parquet(path)
    return N.unified_from_nested(spark.read.parquet(path), as_of=AS_OF)


@register("survey_date_chain", D.with_views("properties") + f"""
SELECT uuid, {O.prop_exprs(survey_mode="chain")["survey_date"]} AS survey_date FROM properties""")
def survey_date_chain(spark, sf):
    from parcelspark.operators.unified import property_fields
    return property_fields(views(spark, sf, "properties"), AS_OF, survey_mode="chain").select("uuid", "survey_date")


@register("occupancy_object_only", D.with_views("persons") + f"""
SELECT uuid, {D.jx('occupancy', '$.occupancy_basis')} AS occupancy_basis,
       {D.jx('occupancy', '$.rent_annual_amount')} AS rent_annual_amount
FROM persons WHERE uuid IS NOT NULL AND uuid <> ''""")
def occupancy_object_only(spark, sf):
    from parcelspark.functions.json import parse_object
    p = views(spark, sf, "persons").where(valid_person_key(F.col("uuid")))
    o = parse_object(F.col("occupancy"), "occupancy_basis string, rent_annual_amount string")
    return p.select("uuid", o["occupancy_basis"].alias("occupancy_basis"),
                    o["rent_annual_amount"].alias("rent_annual_amount"))
