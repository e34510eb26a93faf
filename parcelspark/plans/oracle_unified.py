"""DuckDB text of the flagship and its column groups (oracle side).

Written the way a SQL user would: one window per property for the measures.
The Spark side uses a two-phase aggregation instead; equal results cross-check
both plans.
"""

from __future__ import annotations

from parcelspark import constants as K
from parcelspark.operators.unified import UNIFIED_COLUMNS
from parcelspark.plans import duck as D

AS_OF = "2024-06-30"


def prop_exprs(as_of: str = AS_OF, form_url: str = K.DEFAULT_FORM_URL,
               map_template: str = K.STATIC_MAP_TEMPLATE, survey_mode: str = "strict") -> dict[str, str]:
    pl, pd, en, sy = "property_location", "property_description", "end_json", "system_json"
    lat = (f"coalesce({D.coord(D.jx(pd, '$.building__geopoint.coordinates[1]'), K.LAT_MIN, K.LAT_MAX)}, "
           f"{D.coord(D.jx(pl, '$.centroid_gps.coordinates[1]'), K.LAT_MIN, K.LAT_MAX)})")
    lon = (f"coalesce({D.coord(D.jx(pd, '$.building__geopoint.coordinates[0]'), K.LON_MIN, K.LON_MAX)}, "
           f"{D.coord(D.jx(pl, '$.centroid_gps.coordinates[0]'), K.LON_MIN, K.LON_MAX)})")
    survey = D.jx(sy, "$.surveyDate")
    review = D.jx(sy, "$.reviewState")
    apc = D.blank_default(D.jx(pl, "$.address_plus_code"))
    pre, post = map_template.split("{}")
    return {
        "uuid": "uuid",
        "address_plus_code": apc,
        "street": D.initcap(D.blank_default(D.jx(pl, "$.street_label"))),
        "town": D.initcap(D.blank_default(D.jx(pl, "$.town_label"))),
        "district": D.initcap(D.blank_default(D.jx(pl, "$.district_label"))),
        "property_name": D.blank_default(D.jx(pd, "$.property_name")),
        "building_type": D.label(D.blank_default(D.jx(pd, "$.building_type")), K.BUILDING_TYPE_LABELS,
                                 fallback=K.BUILDING_TYPE_DEFAULT),
        "number_of_units": D.units(D.jx(pd, "$.number_of_shops_apts_units")),
        "latitude": lat,
        "longitude": lon,
        "geographic_point": (f"(CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN "
                             f"'POINT(' || {D.point_text(lon)} || ' ' || {D.point_text(lat)} || ')' END)"),
        "meeting_date": D.strict_date(D.jx(en, "$.meeting_date")),
        "ap": D.amount_paid(D.jx(en, "$.amount_paid")),
        "receipt_number": f"trim({D.jx(en, '$.receipt_number')})",
        "payment_plan_frequency": D.initcap(D.jx(en, "$.payment_plan_frequency")),
        "payment_plan_amount": D.guarded(D.jx(en, "$.payment_plan_amount"), K.AMOUNT_RE, "DECIMAL(18,4)"),
        "payment_plan_start_date": D.strict_date(D.jx(en, "$.payment_Plan_start_date")),
        "payment_plan_end_date": D.strict_date(D.jx(en, "$.payment_Plan_end_date")),
        "follow_up_status": D.label(D.jx(en, "$.follow_up_status"), K.FOLLOW_UP_LABELS,
                                    fallback=K.FOLLOW_UP_DEFAULT),
        "submitter_name": D.initcap(D.jx(sy, "$.submitterName")),
        "submission_date": D.prefix_ts(D.jx(sy, "$.submissionDate")),
        "form_version": f"coalesce({D.jx(sy, '$.formVersion')}, {D.q(K.FORM_VERSION_DEFAULT)})",
        "survey_date": (f"(CASE WHEN {D.m(survey, K.DATE_RE)} THEN TRY_CAST({survey} AS DATE) ELSE DATE '{as_of}' END)"
                        if survey_mode == "strict" else
                        f"coalesce({D.prefix_date(survey)}, {D.prefix_date(D.jx(sy, '$.submissionDate'))}, "
                        f"DATE '{as_of}')"),
        "review_state": D.label(review, K.REVIEW_STATE_LABELS, fallback=K.REVIEW_STATE_DEFAULT),
        "rejected": f"(CASE WHEN lower(coalesce({review}, '')) = 'rejected' THEN 'EXCLUDE' ELSE 'INCLUDE' END)",
        "building_image_url_html": D.img_html("building_image_url"),
        "address_plus_code_url_html": D.img_html("address_plus_code_url"),
        "go_to_odk": (f"'<a href=\"{form_url}/submissions/' || replace(uuid, ':', '%3A') || "
                      f"'\" target=\"_blank\" rel=\"noopener noreferrer\">GO TO ODK</a>'"),
        "address_plus_code_url_htm": f"{D.q(pre)} || coalesce({apc}, '') || {D.q(post)}",
        "property": "'Property'",
        "value": "uuid",
    }


def person_base_sql(mode: str = "flagship") -> str:
    """Persons with a valid key, unwrapped JSON fields and the tax measures (``pg``).

    ``mode="nested"``: every property with its persons (a NULL person for none), JSON
    fields read only from objects.
    """
    occ, pt = "occ", "pt"
    rent = D.rent(D.jx(occ, "$.rent_annual_amount"))
    cur = D.normalize(D.jx(occ, "$.rent_currency_unit"), K.CURRENCY_SYNONYMS, K.CURRENCY_DEFAULT)
    use = D.normalize(D.jx(occ, "$.property_use"), K.PROPERTY_USE_SYNONYMS, K.PROPERTY_USE_DEFAULT)
    basis = D.normalize(D.jx(pt, "$.property_basis"), K.BASIS_SYNONYMS, K.BASIS_DEFAULT)
    if mode == "nested":
        pp = """
pp AS (SELECT x.*, x.occupancy AS occ, x.person_type AS pt, pr0.uuid AS prop_uuid
       FROM properties pr0 LEFT JOIN (SELECT * FROM persons WHERE uuid IS NOT NULL AND uuid <> '') x
         ON split_part(x.uuid, '_', 1) = pr0.uuid),"""
    else:
        pp = f"""
pp AS (SELECT p.*, {D.unwrap('p.occupancy')} AS occ, {D.unwrap('p.person_type')} AS pt,
              split_part(p.uuid, '_', 1) AS prop_uuid
       FROM persons p WHERE p.uuid IS NOT NULL AND p.uuid <> ''),"""
    return pp + f"""
pm AS (SELECT pp.*, {rent} AS annual_rent, {cur} AS rent_currency_raw, {use} AS property_use_raw,
              {basis} AS person_basis_raw FROM pp),
pg AS (SELECT pm.*,
              coalesce(CAST(annual_rent * {D.rate('rent_currency_raw')} AS DECIMAL(24,6)), CAST(0 AS DECIMAL(24,6)))
                AS annual_rent_gmd,
              {D.income_type('property_use_raw', 'person_basis_raw')} AS income_type
       FROM pm)"""


def person_exprs(as_of: str = AS_OF, nulls: frozenset = frozenset()) -> dict[str, str]:
    """``nulls``: person columns the variant cannot see (read as NULL)."""
    occ, pt = "occ", "pt"

    def c(name):
        return "CAST(NULL AS VARCHAR)" if name in nulls else name
    dob = c("individual_dob")
    dob_d = f"TRY_CAST({dob} AS DATE)"
    tin = "tin"
    return {
        "person_uuid": "uuid",
        "basis": D.label("person_basis_raw", K.BASIS_LABELS),
        "type": D.label("type", K.TYPE_LABELS),
        "business_name": D.blank_null("business_name"),
        "first_name": D.blank_null("individual_first_name"),
        "last_name": D.blank_null("individual_last_name"),
        "tax_registered": D.label("tax_registered", K.TAX_REGISTERED_LABELS),
        "tin": D.clean_pattern(tin, K.TIN_RE),
        "mobile_1": D.clean_pattern("mobile_1", K.MOBILE_RE),
        "mobile_2": D.clean_pattern("mobile_2", K.MOBILE_RE),
        "email": f"(CASE WHEN {D.m('email', K.EMAIL_RE)} THEN lower(trim(email)) END)",
        "occupancy_basis": D.label(D.jx(occ, "$.occupancy_basis"), K.OCCUPANCY_BASIS_LABELS),
        "gender": D.label(c("individual_gender"), K.GENDER_LABELS, lower=True),
        "id_type": D.label(c("individual_id_type"), K.ID_TYPE_LABELS),
        "nin": D.clean_pattern(c("individual_nin"), K.NIN_RE),
        "drivers_license": f"trim({c('individual_drivers_licence')})",
        "passport": f"trim({c('individual_passport_number')})",
        "passport_country": D.initcap("passport_country"),
        "residence_permit": f"trim({c('individual_residence_permit_number')})",
        "residence_permit_country": D.initcap("residence_permit_country"),
        "dob": (f"(CASE WHEN {D.m(dob, K.DATE_RE)} AND {dob_d} <= DATE '{as_of}' AND {dob_d} >= DATE '{K.DOB_MIN}' "
                f"THEN {dob_d} END)"),
        "age": f"(CASE WHEN {D.m(dob, K.DATE_RE)} AND {dob_d} <= DATE '{as_of}' THEN {D.age(dob_d, as_of)} END)",
        "occupant_or_remote": D.label(D.jx(pt, "$.where_owner_landlord"), K.PRESENCE_LABELS),
        "occupancy_start_date": D.strict_date(D.jx(occ, "$.occupancy_start_date")),
        "occupancy_duration": "CAST(NULL AS VARCHAR)",
        "property_use": D.label(D.jx(occ, "$.property_use"), K.PROPERTY_USE_LABELS),
        "payment_frequency": D.label(D.jx(occ, "$.payment_frequency"), K.PAYMENT_FREQUENCY_LABELS),
        "currency_unit": D.label(D.jx(occ, "$.currency_unit"), K.CURRENCY_LABELS, default="upper"),
        "annual_rent_gmd": "annual_rent_gmd",
        "occupancy_rent_payment_method": D.label(D.jx(occ, "$.rent_payment_method"), K.PAYMENT_METHOD_LABELS),
        "shop_unit": "shop_apt_unit_number",
        "annual_rent": "annual_rent",
        "rent_currency": D.label("rent_currency_raw", K.CURRENCY_LABELS, default="upper"),
        "tin_status": (f"(CASE WHEN {D.m(tin, K.TIN_RE)} THEN 'Valid TIN' "
                       f"WHEN length(trim(coalesce({tin}, ''))) > 0 THEN 'TIN Provided (Needs Validation)' "
                       f"ELSE 'No TIN' END)"),
        "_q_person": (f"((CASE WHEN individual_first_name IS NOT NULL THEN 10 ELSE 0 END) + "
                      f"(CASE WHEN {c('individual_gender')} IS NOT NULL THEN 10 ELSE 0 END) + "
                      f"(CASE WHEN {dob_d} IS NOT NULL THEN 15 ELSE 0 END) + "
                      f"(CASE WHEN {D.m('mobile_1', K.MOBILE_RE)} THEN 15 ELSE 0 END) + "
                      f"(CASE WHEN {D.m(tin, K.TIN_RE)} THEN 20 ELSE 0 END))"),
    }


def measure_exprs(w: str = "w") -> dict[str, str]:
    g = "pg2.annual_rent_gmd"
    it = "pg2.income_type"

    def inc(kind):
        return f"CAST(SUM(CASE WHEN {it} = '{kind}' THEN {g} ELSE 0 END) OVER {w} AS DECIMAL(38,6))"

    def tax(kind):
        r = D.lit(K.TAX_RATES[kind])
        return (f"CAST(SUM(CASE WHEN {it} = '{kind}' THEN CAST({g} * {r} AS DECIMAL(27,8)) ELSE 0 END) OVER {w} "
                f"AS DECIMAL(38,8))")
    return {
        "ci": inc("commercial"), "ri": inc("residential_rental"), "bi": inc("business"),
        "ctl": tax("commercial"), "rtl": tax("residential_rental"), "btl": tax("business"),
        "total_building_rent": f"CAST(SUM(coalesce({g}, 0)) OVER {w} AS DECIMAL(38,6))",
        "sum_owner": (f"(CASE WHEN COUNT(CASE WHEN pg2.person_basis_raw = 'owner' THEN 1 END) OVER {w} > 0 "
                      f"THEN 'Owner' ELSE 'No Owner' END)"),
    }


def unified_sql(as_of: str = AS_OF, limit: int | None = None) -> str:
    pe = person_exprs(as_of)
    pr = prop_exprs(as_of)
    person_sel = ",\n       ".join(f"{v} AS {k}" for k, v in pe.items())
    prop_sel = ",\n       ".join(f"{v} AS {k}" for k, v in pr.items())
    me = measure_exprs()
    cols = []
    for c in UNIFIED_COLUMNS:
        if c in me:
            cols.append(f"{me[c]} AS {c}")
        elif c in ("ctl_formatted", "rtl_formatted", "btl_formatted", "total_building_rent_formatted"):
            src = {"ctl_formatted": "ctl", "rtl_formatted": "rtl", "btl_formatted": "btl",
                   "total_building_rent_formatted": "total_building_rent"}[c]
            cols.append(f"'GMD ' || {D.money(me[src])} AS {c}")
        elif c == "business_tax_liability":
            cols.append(f"{me['btl']} AS {c}")
        elif c == "residential_tax_liability":
            cols.append(f"{me['rtl']} AS {c}")
        elif c == "commercial_tl":
            cols.append(f"{me['ctl']} AS {c}")
        elif c == "data_quality_score":
            cols.append("CAST(pg2._q_person + (CASE WHEN pr.latitude IS NOT NULL AND pr.longitude IS NOT NULL "
                        "THEN 10 ELSE 0 END) + (CASE WHEN pg2.annual_rent_gmd > 0 THEN 20 ELSE 0 END) AS INTEGER) "
                        "AS data_quality_score")
        elif c == "processed_at":
            cols.append(f"TIMESTAMP '{as_of} 00:00:00' AS processed_at")
        elif c == "tax_year":
            cols.append(f"CAST(year(DATE '{as_of}') AS INTEGER) AS tax_year")
        elif c in pe:
            cols.append(f"pg2.{c} AS {c}")
        else:
            cols.append(f"pr.{c} AS {c}")
    tail = f"\nORDER BY uuid, person_uuid LIMIT {limit}" if limit else ""
    return (D.with_views("properties", "persons") + "," + person_base_sql() + f""",
pg2 AS (SELECT prop_uuid, person_basis_raw, income_type, {person_sel} FROM pg),
pr AS (SELECT {prop_sel} FROM properties)
SELECT {', '.join(cols)}
FROM pg2 JOIN pr ON pr.uuid = pg2.prop_uuid
WINDOW w AS (PARTITION BY pr.uuid){tail}""")


NESTED_NULLS = frozenset({"individual_gender", "individual_id_type", "individual_nin", "individual_drivers_licence",
                          "individual_passport_number", "individual_residence_permit_number", "individual_dob"})


def nested_unified_sql(as_of: str = AS_OF) -> str:
    """The nested-input variant: all properties, placeholder rows, object-only JSON, other key names."""
    from parcelspark.operators.nested import NESTED_UNIFIED_COLUMNS
    pe = person_exprs(as_of, NESTED_NULLS)
    pr = prop_exprs(as_of, survey_mode="chain")
    pr["building_image_url_html"] = D.q(K.NESTED_BUILDING_IMAGE_HTML)
    pr.pop("address_plus_code_url_html")
    person_sel = ",\n       ".join(f"{v} AS {k}" for k, v in pe.items())
    prop_sel = ",\n       ".join(f"{v} AS {k}" for k, v in pr.items())
    me = measure_exprs()
    fmt = {"ctl_formatted": "ctl", "rtl_formatted": "rtl", "btl_formatted": "btl",
           "total_building_rent_formatted": "total_building_rent"}
    alias = {"business_tax_liability": "btl", "residential_tax_liability": "rtl", "commercial_tl": "ctl"}
    cols = []
    for c in NESTED_UNIFIED_COLUMNS:
        if c in me:
            cols.append(f"{me[c]} AS {c}")
        elif c in fmt:
            cols.append(f"'GMD ' || {D.money(me[fmt[c]])} AS {c}")
        elif c in alias:
            cols.append(f"{me[alias[c]]} AS {c}")
        elif c == "data_quality_score":
            cols.append("CAST(pg2._q_person + (CASE WHEN pr.latitude IS NOT NULL AND pr.longitude IS NOT NULL "
                        "THEN 10 ELSE 0 END) + (CASE WHEN pg2.annual_rent_gmd > 0 THEN 20 ELSE 0 END) AS INTEGER) "
                        "AS data_quality_score")
        elif c == "processed_at":
            cols.append(f"TIMESTAMP '{as_of} 00:00:00' AS processed_at")
        elif c == "tax_year":
            cols.append(f"CAST(year(DATE '{as_of}') AS INTEGER) AS tax_year")
        elif c in pe:
            cols.append(f"pg2.{c} AS {c}")
        else:
            cols.append(f"pr.{c} AS {c}")
    return (D.with_views("properties", "persons") + "," + person_base_sql("nested") + f""",
pg2 AS (SELECT prop_uuid, person_basis_raw, income_type, {person_sel} FROM pg),
pr AS (SELECT {prop_sel} FROM properties)
SELECT {', '.join(cols)}
FROM pg2 JOIN pr ON pr.uuid = pg2.prop_uuid
WINDOW w AS (PARTITION BY pr.uuid)""")
