"""Registered queries: the flagship and the column groups it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.operators import unified as U
from parcelspark.plans import duck as D
from parcelspark.plans import oracle_unified as O
from parcelspark.plans.registry import register, views
from parcelspark.sources.survey_views import duckdb_view_sql

AS_OF = U.DEFAULT_AS_OF


@register("scan_properties", f"SELECT * FROM ({duckdb_view_sql('properties')})")
def scan_properties(spark, sf):
    return views(spark, sf, "properties")


@register("scan_persons", f"SELECT * FROM ({duckdb_view_sql('persons')})")
def scan_persons(spark, sf):
    return views(spark, sf, "persons")


@register("unified_dataset", O.unified_sql())
def unified_dataset(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    return U.unified_dataset(props, persons, as_of=AS_OF)


# ---- property column groups -------------------------------------------------------------------
_PROP_GROUPS = {
    "json_paths": ["address_plus_code", "property_name", "meeting_date", "submission_date"],
    "blank_to_default": ["address_plus_code", "property_name"],
    "units_in_range": ["number_of_units"],
    "geo_lat_lon": ["latitude", "longitude"],
    "geo_point_wkt": ["geographic_point"],
    "amount_paid": ["ap"],
    "plan_amount": ["payment_plan_amount"],
    "survey_date_strict": ["survey_date"],
    "submission_ts": ["submission_date"],
    "label_building_type": ["building_type"],
    "label_follow_up": ["follow_up_status"],
    "label_review_state": ["review_state"],
    "flag_rejected": ["rejected"],
    "img_html_simple": ["building_image_url_html", "address_plus_code_url_html"],
    "form_defaults": ["form_version", "submitter_name", "receipt_number", "payment_plan_frequency"],
    "link_columns": ["go_to_odk", "address_plus_code_url_htm", "property", "value"],
    "pg_initcap_places": ["street", "town", "district"],
    "strict_dates_end": ["meeting_date", "payment_plan_start_date", "payment_plan_end_date"],
}


def _prop_query(cols):
    def q(spark, sf):
        return U.property_fields(views(spark, sf, "properties"), as_of=AS_OF).select("uuid", *cols)
    return q


def _prop_oracle(cols):
    pe = O.prop_exprs()
    sel = ", ".join(f"{pe[c]} AS {c}" for c in ["uuid", *cols])
    return D.with_views("properties") + f"\nSELECT {sel} FROM properties"


for _k, _cols in _PROP_GROUPS.items():
    register(_k, _prop_oracle(_cols))(_prop_query(_cols))


# ---- person column groups ---------------------------------------------------------------------
_PERSON_GROUPS = {
    "json_text_reparse": ["occupancy_basis", "occupancy_start_date", "payment_frequency"],
    "blank_to_null": ["business_name", "first_name", "last_name"],
    "rent_amount": ["annual_rent"],
    "norm_currency": ["rent_currency"],
    "convert_to_gmd": ["annual_rent", "annual_rent_gmd"],
    "dob_valid": ["dob"],
    "age_years": ["age"],
    "label_basis": ["basis"],
    "label_type": ["type"],
    "label_tax_registered": ["tax_registered"],
    "label_occupancy_basis": ["occupancy_basis"],
    "label_gender": ["gender"],
    "label_id_type": ["id_type"],
    "label_presence": ["occupant_or_remote"],
    "label_property_use": ["property_use"],
    "label_payment_frequency": ["payment_frequency"],
    "label_currency_unit": ["currency_unit"],
    "label_payment_method": ["occupancy_rent_payment_method"],
    "label_rent_currency": ["rent_currency"],
    "clean_tin": ["tin"],
    "tin_status": ["tin_status"],
    "clean_mobile": ["mobile_1", "mobile_2"],
    "clean_email": ["email"],
    "clean_nin": ["nin"],
    "id_documents": ["drivers_license", "passport", "passport_country", "residence_permit",
                     "residence_permit_country"],
    "passthrough_fields": ["shop_unit", "occupancy_duration"],
    "strict_dates_person": ["occupancy_start_date"],
}


def _person_query(cols):
    def q(spark, sf):
        return U.person_fields(views(spark, sf, "persons"), as_of=AS_OF).select("person_uuid", *cols)
    return q


def _person_oracle(cols):
    pe = O.person_exprs()
    sel = ", ".join(f"{pe[c]} AS {c}" for c in ["person_uuid", *cols])
    return D.with_views("persons") + "," + O.person_base_sql() + f"\nSELECT {sel} FROM pg"


for _k, _cols in _PERSON_GROUPS.items():
    register(_k, _person_oracle(_cols))(_person_query(_cols))


# ---- measures: normalisers, income type, tax per person -----------------------------------------
@register("income_type", D.with_views("persons") + "," + O.person_base_sql() + """
SELECT uuid AS person_uuid, prop_uuid, rent_currency_raw AS norm_currency, property_use_raw AS norm_property_use,
       person_basis_raw AS norm_basis, annual_rent_gmd, income_type,
       CAST(annual_rent_gmd * (CASE income_type WHEN 'commercial' THEN 0.15 WHEN 'residential_rental' THEN 0.08
            WHEN 'business' THEN 0.27 END) AS DECIMAL(27,8)) AS tax_due
FROM pg""")
def income_type_q(spark, sf):
    from parcelspark.functions import labels as L
    m = U.person_measures(views(spark, sf, "persons"))
    return m.select(
        "person_uuid", "prop_uuid", F.col("rent_currency_raw").alias("norm_currency"),
        F.col("property_use_raw").alias("norm_property_use"), F.col("person_basis_raw").alias("norm_basis"),
        "annual_rent_gmd", "income_type",
        (F.col("annual_rent_gmd") * L.tax_rate_for(F.col("income_type"))).cast("decimal(27,8)").alias("tax_due"))


@register("tax_by_property", D.with_views("properties", "persons") + "," + O.person_base_sql() + """
SELECT prop_uuid,
  CAST(SUM(CASE WHEN income_type = 'commercial' THEN annual_rent_gmd ELSE 0 END) AS DECIMAL(38,6)) AS ci,
  CAST(SUM(CASE WHEN income_type = 'residential_rental' THEN annual_rent_gmd ELSE 0 END) AS DECIMAL(38,6)) AS ri,
  CAST(SUM(CASE WHEN income_type = 'business' THEN annual_rent_gmd ELSE 0 END) AS DECIMAL(38,6)) AS bi,
  CAST(SUM(CASE WHEN income_type = 'commercial' THEN CAST(annual_rent_gmd * 0.15 AS DECIMAL(27,8)) ELSE 0 END)
       AS DECIMAL(38,8)) AS ctl,
  CAST(SUM(CASE WHEN income_type = 'residential_rental' THEN CAST(annual_rent_gmd * 0.08 AS DECIMAL(27,8)) ELSE 0 END)
       AS DECIMAL(38,8)) AS rtl,
  CAST(SUM(CASE WHEN income_type = 'business' THEN CAST(annual_rent_gmd * 0.27 AS DECIMAL(27,8)) ELSE 0 END)
       AS DECIMAL(38,8)) AS btl,
  CAST(SUM(annual_rent_gmd) AS DECIMAL(38,6)) AS total_building_rent,
  CASE WHEN COUNT(CASE WHEN person_basis_raw = 'owner' THEN 1 END) > 0 THEN 'Owner' ELSE 'No Owner' END AS sum_owner
FROM pg WHERE prop_uuid IN (SELECT uuid FROM properties) GROUP BY prop_uuid""")
def tax_by_property(spark, sf):
    props, persons = views(spark, sf, "properties", "persons")
    t = U.property_totals(U.person_measures(persons))
    t = t.join(props.select(F.col("uuid").alias("prop_uuid")), "prop_uuid", "left_semi")
    return t.select("prop_uuid", "ci", "ri", "bi", "ctl", "rtl", "btl", "total_building_rent",
                    F.when(F.col("_has_owner") > 0, "Owner").otherwise("No Owner").alias("sum_owner"))
