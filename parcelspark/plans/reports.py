"""Composite pipelines users call (2.12): each returns named DataFrames, nothing is collected.

Reports are built from the same operators the registered queries use; callers
decide what to materialise (``cache`` them when several parts are read).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.operators import links as LK
from parcelspark.operators import nested as N
from parcelspark.operators import quality as Q
from parcelspark.operators import sync_state as S
from parcelspark.operators.unified import unified_dataset


def verify_unified(nested: DataFrame, unified: DataFrame | None = None) -> dict[str, DataFrame]:
    """Nested audit counts + populated ratio + the three largest lists (+ key check of the wide table)."""
    out = {"audit": Q.nested_audit(nested), "top_properties": Q.top_properties_by_persons(nested)}
    if unified is not None:
        out["key_violations"] = Q.assert_composite_key(unified, ["uuid", "person_uuid"])
    return out


def integrity_report(properties: DataFrame, persons: DataFrame) -> dict[str, DataFrame]:
    """Counts, FK coverage and verdict, named persons, FK rollup and key column types."""
    return {
        "row_counts": Q.row_counts(properties=properties, persons=persons),
        "distinct_fk": persons.where(F.col("submissions_id").isNotNull()).select("submissions_id").distinct(),
        "fk_integrity": Q.fk_integrity(properties, persons),
        "named_persons": persons.where(F.col("individual_first_name").isNotNull() | F.col("business_name").isNotNull())
        .select("uuid", "submissions_id", "individual_first_name", "individual_last_name", "business_name"),
        "fk_rollup": N.person_counts(persons, key="fk"),
        "column_types": Q.column_types(properties, "properties", ["uuid"]).unionByName(
            Q.column_types(persons, "persons", ["submissions_id"])),
    }


def relationship_profile(properties: DataFrame, persons: DataFrame, sample: int = 5) -> dict[str, DataFrame]:
    """Key samples, match pairs and their count, pairs by containment and by the last underscore, row counts."""
    pairs = Q.match_type_join(properties, persons)
    return {
        "main_keys": Q.sample_rows(properties.select("uuid").where(F.col("uuid").isNotNull()), sample, ["uuid"]),
        "person_keys": Q.sample_rows(persons.select("uuid").where(F.col("uuid").isNotNull()), sample, ["uuid"]),
        "match_pairs": pairs,
        "match_count": pairs.agg(F.count(F.lit(1)).alias("total_relations")),
        "containing_pairs": Q.containing_pairs(properties, persons),
        "prefix_pairs": Q.last_underscore_prefix_pairs(properties, persons),
        "row_counts": Q.row_counts(properties=properties, persons=persons),
    }


def url_report(table: DataFrame, now_epoch: int, threshold_hours: float = K.REFRESH_THRESHOLD_HOURS,
               recent: int | None = 50) -> dict[str, DataFrame]:
    """Newest rows with image HTML, the link status of each, and the status histogram per kind."""
    nb = LK.nonblank_strict
    with_html = table.where(nb(F.col("building_image_url_html")) | nb(F.col("address_plus_code_url_html")))
    newest = with_html.orderBy(F.col("survey_date").desc_nulls_last(), F.col("uuid"))
    if recent is not None:
        newest = newest.limit(recent)
    kinds = F.explode(F.array(
        F.struct(F.lit("building").alias("kind"), F.col("building_image_url_html").alias("html")),
        F.struct(F.lit("plus_code").alias("kind"), F.col("address_plus_code_url_html").alias("html"))))
    detail = (newest.select("uuid", "survey_date", kinds.alias("k")).select("uuid", "survey_date", "k.*")
              .where(nb(F.col("html")))
              .withColumn("url", LK.url_from_html(F.col("html"))).where(F.col("url").isNotNull())
              .withColumn("status", LK.url_status(F.col("url"), now_epoch, threshold_hours))
              .withColumn("expires_at", LK.url_expiry_ts(F.col("url"))))
    hist = detail.groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))
    hist = Q.share_of_total(hist, "n", ["kind"])
    return {"recent": newest, "detail": detail, "histogram": hist}


def health_report(history: DataFrame, recent: int = K.RECENT_ATTEMPTS) -> dict[str, DataFrame]:
    """Status per type, newest attempts, success rate and recent mean duration."""
    status = S.sync_fold(history)
    return {"status": status, "recent": S.recent_history(history, recent),
            "success_rate": S.sync_success_rate(status), "recent_avg": S.sync_recent_avg(history, recent),
            "in_error": S.types_in_error(status)}


def build_all(spark: SparkSession, properties: DataFrame, persons: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """Flagship, nested form and nested-input variant from the same inputs."""
    nested = N.nested_dataset(properties, persons)
    return {"unified": unified_dataset(properties, persons, as_of=as_of), "nested": nested,
            "unified_from_nested": N.unified_from_nested(nested, as_of=as_of)}
