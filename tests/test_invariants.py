"""Invariants of SURVEY section 5 on the small tables."""
from pyspark.sql import functions as F

from survey_helpers import SF_SMALL
from parcelspark.operators import nested as N
from parcelspark.operators import quality as Q
from parcelspark.operators.unified import unified_dataset
from parcelspark.sources.survey_views import survey_view


def test_invariants(spark):
    props = survey_view(spark, SF_SMALL, "properties")
    persons = survey_view(spark, SF_SMALL, "persons")
    u = unified_dataset(props, persons)
    # income by type adds up to the total rent of the property
    assert u.where(F.col("ci") + F.col("ri") + F.col("bi") != F.col("total_building_rent")).count() == 0
    # business income is unreachable after the use normalisation (kept as in the original rules)
    assert u.where(F.col("bi") != 0).count() == 0
    # the wide table's key is unique and not null
    assert Q.assert_composite_key(u, ["uuid", "person_uuid"]).count() == 0
    # unnest(rollup) gives back the persons that have a property
    back = N.unnest_persons(N.nested_dataset(props, persons), keep_placeholder=False)
    assert back.count() == u.count()
    # the prefix equi-join pairs are a subset of the theta-join pairs
    theta = Q.match_type_join(props, persons).select("main_uuid", "person_uuid")
    prefix = persons.where(F.col("uuid").isNotNull()).select(
        F.split_part("uuid", F.lit("_"), F.lit(1)).alias("main_uuid"), F.col("uuid").alias("person_uuid")) \
        .join(props.select(F.col("uuid").alias("main_uuid")), "main_uuid")
    assert prefix.exceptAll(theta).count() == 0
    # quality score within 0..100
    assert u.where((F.col("data_quality_score") < 0) | (F.col("data_quality_score") > 100)).count() == 0


def test_ordered_top_n_with_cutoff(spark):
    from parcelspark.operators.unified import key_cutoff
    props = survey_view(spark, SF_SMALL, "properties")
    persons = survey_view(spark, SF_SMALL, "persons")
    full = unified_dataset(props, persons).select("uuid", "person_uuid")
    top = unified_dataset(props, persons, limit=100).select("uuid", "person_uuid").collect()
    want = full.orderBy("uuid", "person_uuid").limit(100).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in want]
    keys = props.select("uuid")
    c = key_cutoff(keys, "uuid", 20)
    assert c is not None and keys.where(F.col("uuid") <= c).count() >= 20
