"""One property holding a third of all persons: the skew-safe plans equal the brute-force ones."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from survey_helpers import SF_SMALL
from parcelspark.operators import nested as N
from parcelspark.operators import unified as U
from parcelspark.sources.survey_views import survey_view


@pytest.fixture(scope="module")
def skewed(spark):
    props = survey_view(spark, SF_SMALL, "properties")
    persons = survey_view(spark, SF_SMALL, "persons")
    hot = U.valid_person_key(F.col("uuid")) & (F.pmod(F.xxhash64("id"), F.lit(3)) == 0)
    persons = persons.withColumn("uuid", F.when(hot, F.concat(F.lit("uuid:0_"), F.col("id"))).otherwise(F.col("uuid")))
    return props, persons


def test_hot_property_is_a_third(skewed):
    _, persons = skewed
    n = persons.count()
    hot = persons.where(F.col("uuid").startswith("uuid:0_")).count()
    assert 0.25 * n < hot < 0.42 * n


def test_totals_equal_window_formulation(spark, skewed):
    props, persons = skewed
    got = U.unified_dataset(props, persons).select("uuid", "person_uuid", "ci", "ri", "bi", "ctl", "rtl", "btl",
                                                   "total_building_rent", "sum_owner")
    m = U.person_measures(persons)
    w = Window.partitionBy("prop_uuid")
    rates = {"commercial": "0.15", "residential_rental": "0.08", "business": "0.27"}

    def s(kind, tax=False):
        v = F.col("annual_rent_gmd")
        if tax:
            v = (v * F.lit(rates[kind]).cast("decimal(4,2)")).cast("decimal(27,8)")
        return F.sum(F.when(F.col("income_type") == kind, v).otherwise(0)).over(w)
    brute = (m.join(props.select(F.col("uuid").alias("prop_uuid")), "prop_uuid")
             .select(F.col("prop_uuid").alias("uuid"), "person_uuid",
                     s("commercial").cast("decimal(38,6)").alias("ci"),
                     s("residential_rental").cast("decimal(38,6)").alias("ri"),
                     s("business").cast("decimal(38,6)").alias("bi"),
                     s("commercial", True).cast("decimal(38,8)").alias("ctl"),
                     s("residential_rental", True).cast("decimal(38,8)").alias("rtl"),
                     s("business", True).cast("decimal(38,8)").alias("btl"),
                     F.sum("annual_rent_gmd").over(w).cast("decimal(38,6)").alias("total_building_rent"),
                     F.when(F.max((F.col("person_basis_raw") == "owner").cast("int")).over(w) > 0, "Owner")
                     .otherwise("No Owner").alias("sum_owner")))
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0


@pytest.mark.parametrize("chunk_size", [5, 50, 10_000])
def test_nested_answers_do_not_depend_on_the_chunk_size(spark, skewed, chunk_size):
    from parcelspark.operators import quality as Q

    props, persons = skewed
    for key in ("prefix", "fk"):
        rolled = N.persons_rollup(persons, key=key, chunk_size=chunk_size)
        assert rolled.agg(F.max(F.size("person_details"))).first()[0] <= chunk_size
        nested = N.nested_dataset(props, persons, key=key, chunk_size=chunk_size)
        counts = N.property_counts(props, persons, key=key)
        assert Q.nested_audit(nested).first() == Q.counts_audit(counts).first()
        assert Q.top_properties_by_persons(nested).collect() == Q.top_properties_by_persons(counts).collect()
        back = N.unnest_persons(nested, keep_placeholder=False).select("uuid", "person_pos", F.col("person")["UUID"])
        k, ok = N.rollup_key(key)
        own = persons.where(ok).withColumn("_k", k).join(props.select(F.col("uuid").alias("_k")), "_k", "left_semi")
        order = Window.partitionBy("_k").orderBy(F.col("uuid").asc_nulls_last())
        want = own.select("_k", F.row_number().over(order).alias("pos"), "uuid")
        assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_person_index_equals_row_number(spark, skewed):
    _, persons = skewed
    p = persons.where(U.valid_person_key(F.col("uuid"))).select(
        F.col("uuid").alias("person_uuid"), U.prop_key(F.col("uuid")).alias("prop_uuid"))
    got = N.person_index(p, "prop_uuid", "person_uuid", slice_chars=3).select(
        "person_uuid", "prop_uuid", "person_index")
    brute = p.withColumn("person_index",
                         F.row_number().over(Window.partitionBy("prop_uuid").orderBy("person_uuid")).cast("int"))
    assert got.exceptAll(brute).count() == 0 and brute.exceptAll(got).count() == 0
    # the hot property was really spread over several slices
    hot = p.where(F.col("prop_uuid") == "uuid:0")
    assert hot.select(F.substring("person_uuid", 1, len("uuid:0") + 3)).distinct().count() > 8


def test_persons_are_numbered_only_where_a_property_needs_chunks(spark):
    """Properties of one chunk are rolled up by one exchange; crowded ones beside them keep their chunks and order."""
    from survey_helpers import persons_df, props_df
    people = [{"uuid": f"uuid:1_{i:02}"} for i in range(7)] + [{"uuid": f"uuid:2_{i}"} for i in range(3)] * 2 + [{"uuid": "uuid:3"}, {"uuid": None}, {"uuid": ""}]
    people += [{"uuid": f"q_{i}", "submissions_id": "uuid:2"} for i in (3, 1, 2)] + [{"uuid": None, "submissions_id": "uuid:2"}]
    persons, props = persons_df(spark, people), props_df(spark, [{"uuid": u} for u in ("uuid:1", "uuid:2", "uuid:2", "uuid:4", None)])
    nested = N.nested_dataset(props, persons, chunk_size=6)
    got = sorted((r["uuid"] or "-", r["person_chunk"], r["person_offset"], r["person_count"], [x["UUID"] for x in r["person_details"]]) for r in nested.collect())
    two = ["uuid:2_0", "uuid:2_0", "uuid:2_1", "uuid:2_1", "uuid:2_2", "uuid:2_2"]
    assert got == [("-", 0, 0, 0, []), ("uuid:1", 0, 0, 6, [f"uuid:1_{i:02}" for i in range(6)]), ("uuid:1", 1, 6, 1, ["uuid:1_06"]),
                   ("uuid:2", 0, 0, 6, two), ("uuid:2", 0, 0, 6, two), ("uuid:4", 0, 0, 0, [])]
    by_fk = {r["prop_uuid"]: [x["UUID"] for x in r["person_details"]] for r in N.persons_rollup(persons, key="fk").collect()}
    assert by_fk == {"uuid:2": ["q_1", "q_2", "q_3", None]}
    plan = nested._jdf.queryExecution().optimizedPlan().toString()
    import re
    assert len(re.findall(r"RepartitionByExpression \[prop_uuid#\d+\]", plan)) == 1
