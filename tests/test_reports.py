"""Composite reports return lazily built DataFrames that run."""
import datetime as dt

from survey_helpers import SF_SMALL
from parcelspark.operators import nested as N
from parcelspark.plans import reports as R
from parcelspark.sources.survey_views import survey_view


def test_reports_run(spark):
    props = survey_view(spark, SF_SMALL, "properties")
    persons = survey_view(spark, SF_SMALL, "persons")
    links = survey_view(spark, SF_SMALL, "links")
    hist = survey_view(spark, SF_SMALL, "sync_history")
    nested = N.nested_dataset(props, persons)
    v = R.verify_unified(nested)
    assert v["audit"].first()["null_person_details"] == 0
    i = R.integrity_report(props, persons)
    assert i["fk_integrity"].first()["verdict"] == "OK"
    rp = R.relationship_profile(props, persons)
    assert rp["match_count"].first()[0] >= rp["prefix_pairs"].count()
    u = R.url_report(links, 1704067200)
    assert u["recent"].count() == 50
    assert abs(sum(float(r["pct"]) for r in u["histogram"].where("kind = 'building'").collect()) - 100) < 0.5
    h = R.health_report(hist)
    assert h["status"].count() == 4 and h["recent"].count() == 10
    b = R.build_all(spark, props, persons, dt.date(2024, 6, 30))
    assert len(b["unified_from_nested"].columns) == 82
