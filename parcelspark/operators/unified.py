"""The flagship: one wide row per (property, person) with tax, labels and quality.

Physical design (see README "Plans"):

* Property-level columns are computed once per property, person-level columns
  once per person, both as narrow projections before any shuffle.
* The per-property measures (income by type, tax by type, total rent, owner
  flag) are a ``groupBy`` on the property key.  Spark aggregates partially on
  the map side, so a property holding a third of all persons still sends only
  one partial row per map task -- unlike a ``Window`` over the property, which
  would put all of that property's persons into one task.
* The totals are joined to the properties (both ~1 row per key), and the result
  is joined to the persons.  That last join is the only one that moves person
  rows; AQE's skew-join rule splits an oversized person partition and
  replicates the single matching property row, and converts the join to a
  broadcast at runtime only when the measured property side is small.
* Aggregating persons into an array and unnesting it again (the original SQL)
  is the identity, so it is skipped; the nested form lives in ``nested.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions import casts as C
from parcelspark.functions import labels as L
from parcelspark.functions import text as T
from parcelspark.functions.json import parse_object, point_coordinates, unwrap_text

DEFAULT_AS_OF = dt.date(2024, 6, 30)

# Fields read from each JSON document (each document is parsed once).
LOC_FIELDS = ("address_plus_code string, street_label string, town_label string, district_label string, "
              "centroid_gps string, address_plus_code_image string")
DESC_FIELDS = ("property_name string, building_type string, number_of_shops_apts_units string, "
               "building__geopoint string, building_image string")
END_FIELDS = ("meeting_date string, amount_paid string, receipt_number string, payment_plan_frequency string, "
              "payment_plan_amount string, payment_Plan_start_date string, payment_Plan_end_date string, "
              "follow_up_status string")
SYS_FIELDS = "surveyDate string, submissionDate string, submitterName string, formVersion string, reviewState string"
OCC_FIELDS = ("rent_annual_amount string, rent_currency_unit string, property_use string, occupancy_basis string, "
              "occupancy_start_date string, payment_frequency string, currency_unit string, rent_payment_method string")
PTYPE_FIELDS = "property_basis string, where_owner_landlord string"

UNIFIED_COLUMNS = [
    "uuid", "person_uuid", "go_to_odk", "basis", "type", "business_name", "first_name", "last_name",
    "tax_registered", "tin", "mobile_1", "mobile_2", "address_plus_code", "street", "town", "district",
    "property_name", "building_type", "latitude", "longitude", "geographic_point", "number_of_units", "email",
    "occupancy_basis", "gender", "id_type", "nin", "drivers_license", "passport", "passport_country",
    "residence_permit", "residence_permit_country", "dob", "age", "occupant_or_remote", "occupancy_start_date",
    "occupancy_duration", "property_use", "payment_frequency", "currency_unit", "annual_rent_gmd",
    "occupancy_rent_payment_method", "shop_unit", "annual_rent", "rent_currency", "meeting_date",
    "ci", "ri", "bi", "ctl", "rtl", "btl", "ap", "ctl_formatted", "rtl_formatted", "btl_formatted",
    "total_building_rent_formatted", "business_tax_liability", "residential_tax_liability", "commercial_tl",
    "sum_owner", "tin_status", "total_building_rent", "receipt_number", "payment_plan_frequency",
    "payment_plan_amount", "payment_plan_start_date", "payment_plan_end_date", "follow_up_status",
    "submitter_name", "submission_date", "form_version", "survey_date", "review_state", "rejected",
    "data_quality_score", "processed_at", "tax_year", "address_plus_code_url_htm", "property", "value",
    "building_image_url_html", "address_plus_code_url_html",
]


def prop_key(person_uuid: Column) -> Column:
    """Property key of a person: text before the first ``_`` (whole text when there is none)."""
    return F.split_part(person_uuid, F.lit("_"), F.lit(1))


def valid_person_key(person_uuid: Column) -> Column:
    return person_uuid.isNotNull() & (person_uuid != "")


def point_text(v: Column) -> Column:
    """Decimal -> shortest plain text (``13.4500000000`` -> ``13.45``)."""
    return F.regexp_replace(F.regexp_replace(v.cast("string"), r"0+$", ""), r"\.$", "")


def geo_columns(building_point: Column, centroid: Column) -> tuple[Column, Column]:
    """:func:`coordinate_columns` of GeoJSON point texts."""
    return coordinate_columns(point_coordinates(building_point), point_coordinates(centroid))


def coordinate_columns(building_point: Column, centroid: Column) -> tuple[Column, Column]:
    """Latitude / longitude: building point first, then the centroid, each coordinate on its own.

    Arguments are the coordinate arrays of GeoJSON points, in the order [lon, lat].
    """
    lat = F.coalesce(C.coord_in_range(F.get(building_point, 1), K.LAT_MIN, K.LAT_MAX),
                     C.coord_in_range(F.get(centroid, 1), K.LAT_MIN, K.LAT_MAX))
    lon = F.coalesce(C.coord_in_range(F.get(building_point, 0), K.LON_MIN, K.LON_MAX),
                     C.coord_in_range(F.get(centroid, 0), K.LON_MIN, K.LON_MAX))
    return lat, lon


def property_fields(properties: DataFrame, as_of=DEFAULT_AS_OF, form_url: str = K.DEFAULT_FORM_URL,
                    map_template: str = K.STATIC_MAP_TEMPLATE, survey_mode: str = "strict") -> DataFrame:
    """All property-level output columns, one row per property (narrow; no shuffle).

    ``survey_mode="strict"``: survey date only from an exact ``yyyy-mm-dd`` surveyDate,
    else ``as_of``; ``"chain"``: leading date of surveyDate, then of submissionDate,
    then ``as_of``.
    """
    loc, desc = F.col("_loc"), F.col("_desc")
    end, sysj = F.col("_end"), F.col("_sys")
    lat, lon = coordinate_columns(F.col("_building"), F.col("_centroid"))
    survey = sysj["surveyDate"]
    review = sysj["reviewState"]
    apc = T.blank_to_default(loc["address_plus_code"])
    pre, post = map_template.split("{}")
    properties = properties.select(
        "uuid", "building_image_url", "address_plus_code_url",
        parse_object(F.col("property_location"), LOC_FIELDS).alias("_loc"),
        parse_object(F.col("property_description"), DESC_FIELDS).alias("_desc"),
        parse_object(F.col("end_json"), END_FIELDS).alias("_end"),
        parse_object(F.col("system_json"), SYS_FIELDS).alias("_sys"))
    # columns of their own, so that each point is parsed once however often its coordinates are used
    properties = properties.select("*", point_coordinates(desc["building__geopoint"]).alias("_building"),
                                   point_coordinates(loc["centroid_gps"]).alias("_centroid"))
    base = properties.select(
        F.col("uuid"),
        apc.alias("address_plus_code"),
        T.blank_to_default(loc["street_label"]).alias("_street"),
        T.blank_to_default(loc["town_label"]).alias("_town"),
        T.blank_to_default(loc["district_label"]).alias("_district"),
        T.blank_to_default(desc["property_name"]).alias("property_name"),
        T.blank_to_default(desc["building_type"]).alias("_building_type"),
        C.units_in_range(desc["number_of_shops_apts_units"]).alias("number_of_units"),
        lat.alias("latitude"), lon.alias("longitude"),
        C.strict_date(end["meeting_date"]).alias("meeting_date"),
        C.amount_paid(end["amount_paid"]).alias("ap"),
        F.trim(end["receipt_number"]).alias("receipt_number"),
        T.pg_initcap(end["payment_plan_frequency"]).alias("payment_plan_frequency"),
        C.plan_amount(end["payment_plan_amount"]).alias("payment_plan_amount"),
        C.strict_date(end["payment_Plan_start_date"]).alias("payment_plan_start_date"),
        C.strict_date(end["payment_Plan_end_date"]).alias("payment_plan_end_date"),
        L.label(end["follow_up_status"], K.FOLLOW_UP_LABELS, fallback=K.FOLLOW_UP_DEFAULT)
        .alias("follow_up_status"),
        T.pg_initcap(sysj["submitterName"]).alias("submitter_name"),
        C.prefix_timestamp(sysj["submissionDate"]).alias("submission_date"),
        F.coalesce(sysj["formVersion"], F.lit(K.FORM_VERSION_DEFAULT)).alias("form_version"),
        (F.when(T.matches(survey, K.DATE_RE), survey.try_cast("date")).otherwise(C.as_date(as_of))
         if survey_mode == "strict" else
         F.coalesce(C.prefix_date(survey), C.prefix_date(sysj["submissionDate"]), C.as_date(as_of)))
        .alias("survey_date"),
        L.label(review, K.REVIEW_STATE_LABELS, fallback=K.REVIEW_STATE_DEFAULT).alias("review_state"),
        F.when(F.lower(F.coalesce(review, F.lit(""))) == "rejected", F.lit(K.REJECTED_FLAG[0]))
        .otherwise(F.lit(K.REJECTED_FLAG[1])).alias("rejected"),
        T.img_html(F.col("building_image_url")).alias("building_image_url_html"),
        T.img_html(F.col("address_plus_code_url")).alias("address_plus_code_url_html"),
    )
    return base.select(
        "*",
        F.concat(F.lit(f'<a href="{form_url}/submissions/'), F.replace(F.col("uuid"), F.lit(":"), F.lit("%3A")),
                 F.lit('" target="_blank" rel="noopener noreferrer">GO TO ODK</a>')).alias("go_to_odk"),
        T.pg_initcap(F.col("_street")).alias("street"),
        T.pg_initcap(F.col("_town")).alias("town"),
        T.pg_initcap(F.col("_district")).alias("district"),
        L.label(F.col("_building_type"), K.BUILDING_TYPE_LABELS, fallback=K.BUILDING_TYPE_DEFAULT)
        .alias("building_type"),
        F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
               F.concat(F.lit("POINT("), point_text(F.col("longitude")), F.lit(" "), point_text(F.col("latitude")),
                        F.lit(")"))).alias("geographic_point"),
        F.concat(F.lit(pre), F.coalesce(F.col("address_plus_code"), F.lit("")), F.lit(post))
        .alias("address_plus_code_url_htm"),
        F.lit("Property").alias("property"),
        F.col("uuid").alias("value"),
    ).drop("_street", "_town", "_district", "_building_type")


def parsed_occupancy(c: Column) -> Column:
    """Occupancy object (stored as JSON or as JSON text inside a string) parsed once."""
    return parse_object(unwrap_text(c), OCC_FIELDS)


def parsed_person_type(c: Column) -> Column:
    return parse_object(unwrap_text(c), PTYPE_FIELDS)


def _measure_inputs(occ: Column, ptype: Column):
    """occ / ptype are parsed structs."""
    return (C.rent_amount(occ["rent_annual_amount"]),
            L.norm_currency(occ["rent_currency_unit"]),
            L.norm_property_use(occ["property_use"]),
            L.norm_basis(ptype["property_basis"]))


def _person_source(persons: DataFrame, json_mode: str, keep_placeholders: bool) -> DataFrame:
    """Persons with their property key and parsed occupancy / person_type.

    ``json_mode="reparse"`` accepts objects stored as JSON or as JSON text inside a
    string (the flagship); ``"object"`` reads fields only from real JSON objects
    (the nested-input variant).  A ``prop_uuid`` column, when present, is the key;
    otherwise it is derived from the person UUID and rows without one are dropped
    unless ``keep_placeholders``.
    """
    src = persons if keep_placeholders else persons.where(valid_person_key(F.col("uuid")))
    if "prop_uuid" not in src.columns:
        src = src.withColumn("prop_uuid", prop_key(F.col("uuid")))
    if json_mode == "reparse":
        occ, ptype = parsed_occupancy(F.col("occupancy")), parsed_person_type(F.col("person_type"))
    elif json_mode == "object":
        occ, ptype = parse_object(F.col("occupancy"), OCC_FIELDS), parse_object(F.col("person_type"), PTYPE_FIELDS)
    else:
        raise ValueError(f"unknown json_mode {json_mode!r}")
    return src.withColumn("_occ", occ).withColumn("_ptype", ptype)


def _with_gmd(df: DataFrame) -> DataFrame:
    return (df.withColumn("annual_rent_gmd",
                          F.coalesce((F.col("annual_rent") * L.rate_for(F.col("rent_currency_raw"))).cast(C.DEC_GMD),
                                     F.lit(0).cast(C.DEC_GMD)))
            .withColumn("income_type", L.income_type(F.col("property_use_raw"), F.col("person_basis_raw"))))


def person_measures(persons: DataFrame, json_mode: str = "reparse", keep_placeholders: bool = False) -> DataFrame:
    """Key, rent in GMD, income type and basis per person: the inputs of the per-property totals."""
    rent, currency, use, basis = _measure_inputs(F.col("_occ"), F.col("_ptype"))
    src = _person_source(persons.select("uuid", "occupancy", "person_type",
                                        *(["prop_uuid"] if "prop_uuid" in persons.columns else [])),
                         json_mode, keep_placeholders)
    return _with_gmd(src.select("prop_uuid", F.col("uuid").alias("person_uuid"),
                                rent.alias("annual_rent"), currency.alias("rent_currency_raw"),
                                use.alias("property_use_raw"), basis.alias("person_basis_raw")))


def person_fields(persons: DataFrame, as_of=DEFAULT_AS_OF, json_mode: str = "reparse",
                  keep_placeholders: bool = False) -> DataFrame:
    """All person-level output columns plus the measures (narrow; no shuffle)."""
    occ, ptype = F.col("_occ"), F.col("_ptype")
    src = _person_source(persons, json_mode, keep_placeholders)
    rent, currency, use, basis = _measure_inputs(occ, ptype)
    tin, dob = F.col("tin"), F.col("individual_dob")
    first, gender, mob1 = F.col("individual_first_name"), F.col("individual_gender"), F.col("mobile_1")
    out = src.select(
        "prop_uuid",
        F.col("uuid").alias("person_uuid"),
        basis.alias("person_basis_raw"),
        use.alias("property_use_raw"),
        currency.alias("rent_currency_raw"),
        rent.alias("annual_rent"),
        L.label(F.col("type"), K.TYPE_LABELS).alias("type"),
        T.blank_to_null(F.col("business_name")).alias("business_name"),
        T.blank_to_null(first).alias("first_name"),
        T.blank_to_null(F.col("individual_last_name")).alias("last_name"),
        L.label(F.col("tax_registered"), K.TAX_REGISTERED_LABELS).alias("tax_registered"),
        T.clean_by_pattern(tin, K.TIN_RE).alias("tin"),
        T.clean_by_pattern(mob1, K.MOBILE_RE).alias("mobile_1"),
        T.clean_by_pattern(F.col("mobile_2"), K.MOBILE_RE).alias("mobile_2"),
        F.when(T.matches(F.col("email"), K.EMAIL_RE), F.lower(F.trim(F.col("email")))).alias("email"),
        L.label(occ["occupancy_basis"], K.OCCUPANCY_BASIS_LABELS).alias("occupancy_basis"),
        L.label(gender, K.GENDER_LABELS, compare_lower=True).alias("gender"),
        L.label(F.col("individual_id_type"), K.ID_TYPE_LABELS).alias("id_type"),
        T.clean_by_pattern(F.col("individual_nin"), K.NIN_RE).alias("nin"),
        F.trim(F.col("individual_drivers_licence")).alias("drivers_license"),
        F.trim(F.col("individual_passport_number")).alias("passport"),
        T.pg_initcap(F.col("passport_country")).alias("passport_country"),
        F.trim(F.col("individual_residence_permit_number")).alias("residence_permit"),
        T.pg_initcap(F.col("residence_permit_country")).alias("residence_permit_country"),
        C.dob_valid(dob, as_of).alias("dob"),
        C.age_from_text(dob, as_of).alias("age"),
        L.label(ptype["where_owner_landlord"], K.PRESENCE_LABELS).alias("occupant_or_remote"),
        C.strict_date(occ["occupancy_start_date"]).alias("occupancy_start_date"),
        F.lit(None).cast("string").alias("occupancy_duration"),
        L.label(occ["property_use"], K.PROPERTY_USE_LABELS).alias("property_use"),
        L.label(occ["payment_frequency"], K.PAYMENT_FREQUENCY_LABELS).alias("payment_frequency"),
        L.label(occ["currency_unit"], K.CURRENCY_LABELS, default="upper").alias("currency_unit"),
        L.label(occ["rent_payment_method"], K.PAYMENT_METHOD_LABELS)
        .alias("occupancy_rent_payment_method"),
        F.col("shop_apt_unit_number").alias("shop_unit"),
        F.when(tin.rlike(T.rx(K.TIN_RE)), F.lit(K.TIN_STATUS[0]))
        .when(F.length(F.trim(F.coalesce(tin, F.lit("")))) > 0, F.lit(K.TIN_STATUS[1]))
        .otherwise(F.lit(K.TIN_STATUS[2])).alias("tin_status"),
        # quality parts that depend only on the person (raw fields, as the original)
        (F.when(first.isNotNull(), K.QUALITY_POINTS["first_name"]).otherwise(0)
         + F.when(gender.isNotNull(), K.QUALITY_POINTS["gender"]).otherwise(0)
         + F.when(dob.try_cast("date").isNotNull(), K.QUALITY_POINTS["dob"]).otherwise(0)
         + F.when(T.matches(mob1, K.MOBILE_RE), K.QUALITY_POINTS["mobile_1"]).otherwise(0)
         + F.when(T.matches(tin, K.TIN_RE), K.QUALITY_POINTS["tin"]).otherwise(0)).alias("_q_person"),
    )
    return (_with_gmd(out)
            .withColumn("basis", L.label(F.col("person_basis_raw"), K.BASIS_LABELS))
            .withColumn("rent_currency", L.label(F.col("rent_currency_raw"), K.CURRENCY_LABELS, default="upper")))


def property_totals(measures: DataFrame, tax_rates: dict | None = None) -> DataFrame:
    """Per-property income / tax by type, total rent and owner flag (two-phase aggregation)."""
    rates = tax_rates or K.TAX_RATES
    gmd, it = F.col("annual_rent_gmd"), F.col("income_type")

    def income(kind):
        return F.sum(F.when(it == kind, gmd).otherwise(F.lit(0))).cast(C.DEC_SUM_GMD)

    def tax(kind):
        return F.sum(F.when(it == kind, (gmd * F.lit(rates[kind])).cast(C.DEC_TAX_ROW))
                     .otherwise(F.lit(0))).cast(C.DEC_SUM_TAX)

    return measures.groupBy("prop_uuid").agg(
        income("commercial").alias("ci"),
        income("residential_rental").alias("ri"),
        income("business").alias("bi"),
        tax("commercial").alias("ctl"),
        tax("residential_rental").alias("rtl"),
        tax("business").alias("btl"),
        F.sum(F.coalesce(gmd, F.lit(0))).cast(C.DEC_SUM_GMD).alias("total_building_rent"),
        F.max((F.col("person_basis_raw") == "owner").cast("int")).alias("_has_owner"),
    )


def assemble(pf: DataFrame, props_fields: DataFrame, totals: DataFrame, columns: list[str], as_of,
             processed_at=None, limit: int | None = None) -> DataFrame:
    """Join person rows to their property's columns and totals; add the money texts and the score."""
    processed = processed_at if processed_at is not None else as_of
    props = props_fields.join(totals, F.col("uuid") == F.col("prop_uuid"), "inner").drop("prop_uuid")
    j = pf.join(props, pf["prop_uuid"] == props["uuid"], "inner")
    geo_ok = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    computed = {
        "ctl_formatted": F.concat(F.lit("GMD "), T.money_text(F.col("ctl"))),
        "rtl_formatted": F.concat(F.lit("GMD "), T.money_text(F.col("rtl"))),
        "btl_formatted": F.concat(F.lit("GMD "), T.money_text(F.col("btl"))),
        "total_building_rent_formatted": F.concat(F.lit("GMD "), T.money_text(F.col("total_building_rent"))),
        "business_tax_liability": F.col("btl"),
        "residential_tax_liability": F.col("rtl"),
        "commercial_tl": F.col("ctl"),
        "sum_owner": F.when(F.col("_has_owner") > 0, F.lit(K.OWNER_FLAG[0])).otherwise(F.lit(K.OWNER_FLAG[1])),
        "data_quality_score": (F.col("_q_person")
                               + F.when(geo_ok, K.QUALITY_POINTS["geo"]).otherwise(0)
                               + F.when(F.col("annual_rent_gmd") > 0, K.QUALITY_POINTS["rent"]).otherwise(0))
        .cast("int"),
        "processed_at": C.as_ts(processed),
        "tax_year": F.year(C.as_date(as_of)),
    }
    out = j.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in columns])
    if limit is not None:
        keys = props.select("uuid").join(pf.select(F.col("prop_uuid").alias("uuid")), "uuid", "left_semi")
        cutoff = key_cutoff(keys, "uuid", limit)
        if cutoff is not None:
            out = out.where(F.col("uuid") <= F.lit(cutoff))
        out = out.orderBy(F.col("uuid").asc_nulls_last(), F.col("person_uuid").asc_nulls_last()).limit(limit)
    return out


def key_cutoff(keys: DataFrame, col: str, n: int, oversample: float = 3.0, seed: int = 17):
    """A key ``c`` with at least ``n`` distinct keys ``<= c`` (or None when there are fewer than ``n``).

    For an ordered top-``n`` over rows whose leading sort key is ``col`` and where
    every key has at least one row, all top-``n`` rows have a key ``<= c``, so a
    filter on ``c`` (pushed to scans, pruning range-partitioned files) shrinks the
    candidates of the top-N merge from ``partitions x n`` to a few ``n``.  ``c``
    comes from a bounded sample (about ``oversample * n`` keys reach the driver)
    and is verified with a count; if the check fails there is no cutoff.
    """
    distinct = keys.select(col).where(F.col(col).isNotNull()).distinct()
    total = distinct.count()
    if total <= n:
        return None
    fraction = min(1.0, oversample * n / total)
    sample = sorted(r[0] for r in distinct.sample(False, fraction, seed).collect())
    rank = min(len(sample) - 1, int(n * fraction * 1.5))
    if rank < 0:
        return None
    cand = sample[rank]
    if distinct.where(F.col(col) <= F.lit(cand)).count() >= n:
        return cand
    return None


def unified_dataset(properties: DataFrame, persons: DataFrame, as_of=DEFAULT_AS_OF, processed_at=None,
                    limit: int | None = None, form_url: str = K.DEFAULT_FORM_URL,
                    tax_rates: dict | None = None) -> DataFrame:
    """83 columns, one row per (property, person) for properties that have persons.

    ``limit`` reproduces the original's ``ORDER BY uuid, person_uuid LIMIT n``
    (a top-N, no global sort); the default returns every row, unordered.
    """
    pf = person_fields(persons, as_of)
    totals = property_totals(person_measures(persons), tax_rates)
    props = property_fields(properties, as_of, form_url=form_url)
    return assemble(pf, props, totals, UNIFIED_COLUMNS, as_of, processed_at, limit)
