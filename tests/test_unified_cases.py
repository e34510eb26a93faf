"""Tax and quality on a hand-made property (FIXTURES 2.1) and the flagship's shape."""
import datetime as dt
from decimal import Decimal

from survey_helpers import persons_df, props_df
from parcelspark.operators.unified import UNIFIED_COLUMNS, unified_dataset

LOC = '{"address_plus_code":" X1 ","street_label":"main st","town_label":"banjul","district_label":"kmc",' \
      '"centroid_gps":{"type":"Point","coordinates":[-16.5,13.45,0]}}'
DESC = '{"property_name":"P","building_type":"car_park","number_of_shops_apts_units":"3"}'


def occ(rent, cur, use=None):
    use_part = f',"property_use":"{use}"' if use else ""
    return f'{{"rent_annual_amount":"{rent}","rent_currency_unit":"{cur}"{use_part}}}'


def test_tax_case(spark):
    props = props_df(spark, [{"uuid": "uuid:p1", "property_location": LOC, "property_description": DESC,
                              "end_json": "{}", "system_json": '{"reviewState":"Rejected"}'},
                             {"uuid": "uuid:p2", "property_location": LOC, "property_description": DESC,
                              "end_json": "{}", "system_json": "{}"}])
    persons = persons_df(spark, [
        {"uuid": "uuid:p1_a", "occupancy": occ("12000", "Dalasi", "residential"),
         "person_type": '{"property_basis":"owner"}', "individual_first_name": "A"},
        {"uuid": "uuid:p1_b", "occupancy": occ("1000", " USD ", "shop"), "person_type": '{"property_basis":"tenant"}'},
        {"uuid": "uuid:p1_c", "occupancy": occ("10000001", "euro")},
    ])
    rows = unified_dataset(props, persons, as_of=dt.date(2024, 6, 30)).orderBy("person_uuid").collect()
    assert len(rows) == 3  # uuid:p2 has no person -> no row
    r = rows[0].asDict()
    assert r["ci"] == Decimal("71430") and r["ri"] == Decimal("12000") and r["bi"] == 0
    assert r["ctl"] == Decimal("10714.50") and r["rtl"] == Decimal("960.00") and r["btl"] == 0
    assert r["total_building_rent"] == Decimal("83430")
    assert r["sum_owner"] == "Owner"
    assert r["ctl_formatted"] == "GMD 10,714.50" and r["btl_formatted"] == "GMD .00"
    assert [x["basis"] for x in rows] == ["Owner", "Occupant", "Occupant"]
    assert [x["annual_rent_gmd"] for x in rows] == [Decimal("12000"), Decimal("71430"), 0]
    assert r["rejected"] == "EXCLUDE" and r["review_state"] == "Rejected"
    assert r["building_type"] == "Car_Park" and r["street"] == "Main St" and r["address_plus_code"] == "X1"
    assert r["geographic_point"] == "POINT(-16.5 13.45)"
    # quality: first name 10 + geo 10 + rent 20
    assert r["data_quality_score"] == 40
    assert list(rows[0].asDict().keys()) == UNIFIED_COLUMNS and len(UNIFIED_COLUMNS) == 83


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == UNIFIED_COLUMNS
    assert df.count() > 0
