"""Survey-shaped tables derived from the driver's TPC-H-style Parquet tables.

The library itself works on any ``properties`` / ``persons`` / ``sync_history``
/ ``links`` / ``incoming`` DataFrames with the schemas in
:mod:`parcelspark.sources.schemas`.  For tests, the bench and the correctness
gate we derive those tables from the given Parquet files so that every query's
work grows with the input:

* ``properties`` <- customer x nation x region, plus one property per supplier
  (those have no persons, which exercises the outer/nested paths);
* ``persons``    <- orders (one person per order, key ``uuid:<cust>_<order>``);
* ``sync_history`` <- events;  ``links`` <- orders;  ``incoming`` <- lineitem.

The SQL text below is plain ANSI and runs unchanged in Spark SQL (with
DataFrame arguments) and in DuckDB, so both engines see byte-identical text
values.  JSON documents are assembled by concatenation; every leaf is a JSON
string except GeoJSON coordinates.  ``{{``/``}}`` are literal braces (the text
is a ``str.format`` template in both engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed survey values used to build the test tables (not reference constants).
PROPERTIES_SQL = r"""
SELECT
  'uuid:' || cast(c.c_custkey AS string) AS uuid,
  'uuid:' || cast(c.c_custkey AS string) AS id,
  '{{"address_plus_code":"' ||
     CASE WHEN c.c_custkey % 9 = 0 THEN '  ' ELSE ' 6CJ' || cast(c.c_custkey AS string) || '+XQ ' END ||
  '","street_label":"' || lower(c.c_name) ||
  '","town_label":"' || lower(n.n_name) ||
  '","district_label":"' || CASE WHEN c.c_custkey % 10 = 3 THEN ' ' ELSE lower(r.r_name) END ||
  '","centroid_gps":{{"type":"Point","coordinates":' ||
     CASE WHEN c.c_custkey % 13 = 0 THEN '[-18.0,14.0,0]' ELSE '[-16.5,13.45,0]' END || '}}' ||
  CASE WHEN c.c_custkey % 4 = 0
       THEN ',"address_plus_code_image":"pc_' || cast(c.c_custkey AS string) || '.jpg"' ELSE '' END ||
  '}}' AS property_location,
  '{{"property_name":"' ||
     CASE WHEN c.c_custkey % 5 = 0 THEN ' ' ELSE 'Plot ' || cast(c.c_custkey AS string) END ||
  '","building_type":"' ||
     CASE c.c_mktsegment WHEN 'BUILDING' THEN 'apartment_complex' WHEN 'HOUSEHOLD' THEN 'residence'
                         WHEN 'MACHINERY' THEN 'business' WHEN 'FURNITURE' THEN 'residence_business'
                         ELSE 'car_park' END ||
  '","number_of_shops_apts_units":"' ||
     CASE WHEN c.c_custkey % 11 = 0 THEN 'abc' ELSE cast(c.c_custkey % 1100 AS string) END ||
  '","building__geopoint":{{"type":"Point","coordinates":[' ||
     CASE WHEN c.c_custkey % 7 = 0 THEN '-13.2' ELSE '-16.' || cast(c.c_custkey % 10 AS string) END ||
     ',13.' || lpad(cast(c.c_custkey % 1000 AS string), 3, '0') || ',0]}}' ||
  CASE WHEN c.c_custkey % 6 = 0
       THEN ',"building_image":"bld_' || cast(c.c_custkey AS string) || '.jpg"' ELSE '' END ||
  '}}' AS property_description,
  '{{"meeting_date":' ||
     CASE c.c_custkey % 4 WHEN 0 THEN 'null'
          WHEN 1 THEN '"2024-05-' || lpad(cast(c.c_custkey % 28 + 1 AS string), 2, '0') || '"'
          WHEN 2 THEN '"2024-02-30"' ELSE '"2024-5-1"' END ||
  ',"amount_paid":' ||
     CASE c.c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '"-5"' WHEN 2 THEN '"abc"'
          ELSE '"' || cast(cast(c.c_acctbal AS decimal(15,2)) AS string) || '"' END ||
  ',"receipt_number":' ||
     CASE WHEN c.c_custkey % 3 = 0 THEN 'null' ELSE '" R' || cast(c.c_custkey AS string) || ' "' END ||
  ',"payment_plan_frequency":"' ||
     CASE c.c_custkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'semi_annually' ELSE 'one-off plan' END || '"' ||
  ',"payment_plan_amount":' ||
     CASE WHEN c.c_custkey % 4 = 0 THEN '"n/a"' ELSE '"' || cast(c.c_custkey * 10 AS string) || '.50"' END ||
  ',"payment_Plan_start_date":"2024-0' || cast(c.c_custkey % 9 + 1 AS string) || '-01"' ||
  ',"payment_Plan_end_date":' ||
     CASE WHEN c.c_custkey % 2 = 0 THEN '"2025-13-01"' ELSE '"2025-06-30"' END ||
  ',"follow_up_status":' ||
     CASE c.c_custkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '"meeting_scheduled"' WHEN 2 THEN '"pending"'
          WHEN 3 THEN '"reported_paid"' ELSE '"call_back_later"' END ||
  '}}' AS end_json,
  '{{"surveyDate":' ||
     CASE WHEN c.c_custkey % 10 = 0 THEN 'null'
          WHEN c.c_custkey % 10 = 1 THEN '"2024-05-01T08:00:00.000Z"'
          WHEN c.c_custkey % 10 = 2 THEN '"2024-04-31"'
          ELSE '"2024-0' || cast(c.c_custkey % 6 + 1 AS string) || '-' ||
               lpad(cast(c.c_custkey % 28 + 1 AS string), 2, '0') || '"' END ||
  ',"submissionDate":' ||
     CASE WHEN c.c_custkey % 17 = 0 THEN 'null'
          ELSE '"2024-0' || cast(c.c_custkey % 6 + 1 AS string) || '-' ||
               lpad(cast(c.c_custkey % 28 + 1 AS string), 2, '0') || 'T1' || cast(c.c_custkey % 10 AS string) ||
               ':3' || cast(c.c_custkey % 10 AS string) || ':0' || cast(c.c_custkey % 7 AS string) || '.' ||
               lpad(cast(c.c_custkey % 1000 AS string), 3, '0') || 'Z"' END ||
  ',"submitterName":"' ||
     CASE WHEN c.c_custkey % 7 = 0 THEN 'jane doe-smith' ELSE 'enumerator_' || cast(c.c_custkey % 7 AS string) END ||
  '","formVersion":' ||
     CASE WHEN c.c_custkey % 3 = 0 THEN 'null' ELSE '"2.' || cast(c.c_custkey % 3 AS string) || '"' END ||
  ',"reviewState":' ||
     CASE c.c_custkey % 8 WHEN 0 THEN 'null' WHEN 1 THEN '"pending"' WHEN 2 THEN '"approved"'
          WHEN 3 THEN '"rejected"' WHEN 4 THEN '"hasIssues"' WHEN 5 THEN '"edited"' WHEN 6 THEN '"received"'
          ELSE '"Rejected"' END ||
  '}}' AS system_json,
  CASE WHEN c.c_custkey % 8 = 0 THEN '{{"building_image_field":"top_' || cast(c.c_custkey AS string) ||
            '.jpg","address_plus_code_image_field":"topc_' || cast(c.c_custkey AS string) || '.jpg"}}'
       ELSE '{{"note":"none"}}' END AS extra_json,
  'logo_' || cast(c.c_custkey % 50 AS string) || '.png' AS logo,
  cast(c.c_custkey % 3 AS string) AS sum_owner,
  cast(c.c_custkey % 4 AS string) AS sum_landlord,
  cast(c.c_custkey % 5 AS string) AS sum_occupant,
  'Submissions(''uuid:' || cast(c.c_custkey AS string) || ''')/person_details' AS person_details_link,
  CASE c.c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
       ELSE 'https://survey-media.s3.eu-west-1.amazonaws.com/building-images/uuid%253A' ||
            cast(c.c_custkey AS string) || '-bld.jpg?Expires=' || cast(1704067200 + (c.c_custkey % 100) * 3600 AS string)
  END AS building_image_url,
  CASE c.c_custkey % 3 WHEN 0 THEN NULL
       ELSE 'https://survey-media.s3.eu-west-1.amazonaws.com/address-plus-code-images/uuid%3A' ||
            cast(c.c_custkey AS string) || '-pc.jpg' END AS address_plus_code_url,
  cast('2024-0' || cast(c.c_custkey % 6 + 1 AS string) || '-' || lpad(cast(c.c_custkey % 28 + 1 AS string), 2, '0') ||
       ' 1' || cast(c.c_custkey % 10 AS string) || ':3' || cast(c.c_custkey % 10 AS string) || ':00' AS {ts}) AS submitted_date
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT
  'uuid:s' || cast(s.s_suppkey AS string) AS uuid,
  'uuid:s' || cast(s.s_suppkey AS string) AS id,
  '{{"address_plus_code":"S' || cast(s.s_suppkey AS string) || '","street_label":"' || lower(s.s_name) ||
  '","town_label":"' || lower(n.n_name) || '","district_label":"' || lower(r.r_name) ||
  '","centroid_gps":{{"type":"Point","coordinates":[-16.6,13.4,0]}}}}' AS property_location,
  '{{"property_name":"Depot ' || cast(s.s_suppkey AS string) ||
  '","building_type":"business","number_of_shops_apts_units":"1"}}' AS property_description,
  '{{}}' AS end_json,
  '{{"surveyDate":"2024-03-0' || cast(s.s_suppkey % 9 + 1 AS string) || '"}}' AS system_json,
  '{{}}' AS extra_json,
  NULL AS logo, NULL AS sum_owner, NULL AS sum_landlord, NULL AS sum_occupant,
  NULL AS person_details_link,
  NULL AS building_image_url,
  NULL AS address_plus_code_url,
  cast('2024-03-0' || cast(s.s_suppkey % 9 + 1 AS string) || ' 09:00:00' AS {ts}) AS submitted_date
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

PERSONS_SQL = r"""
SELECT
  CASE WHEN o.o_orderkey % 97 = 0 THEN ''
       WHEN o.o_orderkey % 89 = 0 THEN NULL
       WHEN o.o_orderkey % 83 = 0 THEN 'uuid:x' || cast(o.o_custkey AS string) || '_' || cast(o.o_orderkey AS string)
       ELSE 'uuid:' || cast(o.o_custkey AS string) || '_' || cast(o.o_orderkey AS string) END AS uuid,
  'rp' || cast(o.o_orderkey AS string) AS id,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN ' '
       ELSE 'uuid:' || cast(o.o_custkey AS string) END AS submissions_id,
  cast(o.o_orderkey % 7 + 1 AS string) AS repeat_position,
  '{{"property_basis":"' ||
     CASE o.o_orderkey % 10 WHEN 0 THEN 'proprietor' WHEN 1 THEN 'agent' WHEN 2 THEN 'renter' WHEN 3 THEN 'caretaker'
          ELSE CASE o.o_orderstatus WHEN 'P' THEN 'Owner' WHEN 'F' THEN ' landlord ' ELSE 'tenant' END END ||
  '","where_owner_landlord":"' ||
     CASE o.o_orderkey % 3 WHEN 0 THEN 'occupant' WHEN 1 THEN 'remote' ELSE 'absentee_owner' END ||
  '"}}' AS person_type,
  CASE WHEN o.o_orderkey % 41 = 0 THEN NULL
       WHEN o.o_orderkey % 37 = 0 THEN ''
       WHEN o.o_orderkey % 19 = 0 THEN '"' || replace(o.doc, '"', chr(92) || '"') || '"'
       ELSE o.doc END AS occupancy,
  cast(o.o_orderkey % 20 + 1 AS string) AS shop_apt_unit_number,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'individual' WHEN 1 THEN 'corporate' ELSE 'government_agency' END AS type,
  CASE o.o_orderkey % 3 WHEN 1 THEN ' Biz ' || cast(o.o_orderkey AS string) || ' ' WHEN 2 THEN '   ' ELSE NULL END
    AS business_name,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'not_sure' ELSE NULL END AS tax_registered,
  CASE o.o_orderkey % 5 WHEN 0 THEN lpad(cast(o.o_orderkey AS string), 10, '0') WHEN 1 THEN ' 12 ' WHEN 2 THEN ''
       WHEN 3 THEN NULL ELSE 'TIN-' || cast(o.o_orderkey AS string) END AS tin,
  CASE o.o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'First' || cast(o.o_orderkey AS string) END
    AS individual_first_name,
  'M' AS individual_middle_name,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE 'Last' || cast(o.o_orderkey AS string) END AS individual_last_name,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'Female' WHEN 2 THEN 'OTHER' ELSE NULL END AS individual_gender,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'national_id' WHEN 1 THEN 'passport' WHEN 2 THEN 'drivers_license'
       ELSE 'voter_card' END AS individual_id_type,
  CASE o.o_orderkey % 3 WHEN 0 THEN lpad(cast(o.o_orderkey % 1000000000 AS string), 9, '0')
       WHEN 1 THEN ' N' || cast(o.o_orderkey AS string) || ' ' ELSE NULL END AS individual_nin,
  CASE WHEN o.o_orderkey % 2 = 0 THEN ' DL' || cast(o.o_orderkey AS string) || ' ' ELSE NULL END
    AS individual_drivers_licence,
  CASE WHEN o.o_orderkey % 2 = 1 THEN ' P' || cast(o.o_orderkey AS string) ELSE NULL END AS individual_passport_number,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'gambia' WHEN 1 THEN 'united kingdom' ELSE NULL END AS passport_country,
  CASE WHEN o.o_orderkey % 4 = 3 THEN 'RP' || cast(o.o_orderkey AS string) || '  ' ELSE NULL END
    AS individual_residence_permit_number,
  CASE WHEN o.o_orderkey % 4 = 3 THEN 'senegal' ELSE NULL END AS residence_permit_country,
  CASE WHEN o.o_orderkey % 17 = 0 THEN '1990-02-30'
       WHEN o.o_orderkey % 19 = 0 THEN '1899-12-31'
       WHEN o.o_orderkey % 23 = 0 THEN '2030-01-01'
       WHEN o.o_orderkey % 29 = 0 THEN '02/03/1990'
       ELSE cast(year(o.o_orderdate) - 30 AS string) || '-' || lpad(cast(month(o.o_orderdate) AS string), 2, '0') ||
            '-' || lpad(cast(day(o.o_orderdate) AS string), 2, '0') END AS individual_dob,
  CASE o.o_orderkey % 4 WHEN 0 THEN '+220' || lpad(cast(o.o_orderkey % 10000000 AS string), 7, '0')
       WHEN 1 THEN '220' || lpad(cast(o.o_orderkey % 100000000 AS string), 8, '0')
       WHEN 2 THEN ' 12345 ' ELSE NULL END AS mobile_1,
  CASE o.o_orderkey % 3 WHEN 0 THEN lpad(cast(o.o_orderkey % 100000000 AS string), 8, '0') WHEN 1 THEN ''
       ELSE NULL END AS mobile_2,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'Person.' || cast(o.o_orderkey AS string) || '@Example.org'
       WHEN 1 THEN 'a+b' || cast(o.o_orderkey AS string) || '@x.org'
       WHEN 2 THEN ' p' || cast(o.o_orderkey AS string) || '@mail.gm ' ELSE NULL END AS email,
  cast(o.o_orderdate AS {ts}) AS submitted_date
FROM (
  SELECT o2.*,
    '{{"rent_annual_amount":"' ||
       CASE WHEN o2.o_orderkey % 13 = 0 THEN 'n/a' WHEN o2.o_orderkey % 43 = 0 THEN '10000000.01'
            ELSE cast(cast(o2.o_totalprice AS decimal(15,2)) AS string) END ||
    '","rent_currency_unit":"' ||
       CASE o2.o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN ' eur ' WHEN '3-MEDIUM' THEN 'gbp'
            WHEN '4-NOT SPECIFIED' THEN 'dalasi' ELSE 'cfa' END ||
    '","property_use":"' ||
       CASE o2.o_orderkey % 3 WHEN 0 THEN 'shop' WHEN 1 THEN 'Residential' ELSE 'warehouse' END ||
    '","occupancy_basis":"' ||
       CASE o2.o_orderkey % 4 WHEN 0 THEN 'rent_lease' WHEN 1 THEN 'family_compound' WHEN 2 THEN 'rent_free'
            ELSE 'caretaker_unit' END ||
    '","occupancy_start_date":"' ||
       CASE WHEN o2.o_orderkey % 6 = 0 THEN '2020-13-01' ELSE cast(cast(o2.o_orderdate AS date) AS string) END ||
    '","payment_frequency":"' ||
       CASE o2.o_orderkey % 5 WHEN 0 THEN 'monthly' WHEN 1 THEN 'quarterly' WHEN 2 THEN 'semi_annually'
            WHEN 3 THEN 'annually' ELSE 'bi_weekly' END ||
    '","currency_unit":"' ||
       CASE o2.o_orderkey % 5 WHEN 0 THEN 'dalasi' WHEN 1 THEN 'usd' WHEN 2 THEN 'pounds' WHEN 3 THEN 'euro'
            ELSE 'cfa' END ||
    '","rent_payment_method":"' ||
       CASE o2.o_orderkey % 5 WHEN 0 THEN 'local_bank' WHEN 1 THEN 'foreign_bank' WHEN 2 THEN 'cash'
            WHEN 3 THEN 'mobile_money' ELSE 'in_kind' END ||
    '"}}' AS doc
  FROM {orders} o2
) o
"""

SYNC_HISTORY_SQL = r"""
SELECT
  cast(e.event_id AS int) AS id,
  CASE e.event_type WHEN 'click' THEN 'main_submissions' WHEN 'view' THEN 'person_details'
       WHEN 'purchase' THEN 'image_processing' ELSE 'url_refresh' END AS sync_type,
  e.ts AS sync_timestamp,
  CASE WHEN e.event_type = 'error' THEN 'error' WHEN e.event_id % 50 = 0 THEN 'in_progress' ELSE 'success' END
    AS status,
  cast(CASE WHEN e.event_type = 'error' OR e.event_id % 50 = 0 THEN 0 ELSE e.event_id % 200 END AS int)
    AS records_processed,
  cast(CASE WHEN e.event_id % 50 = 0 AND e.event_type <> 'error' THEN NULL ELSE floor(e.value) END AS int)
    AS duration_seconds,
  CASE WHEN e.event_type = 'error' THEN 'feed error ' || e.props ELSE NULL END AS error_message,
  e.props AS sync_metadata,
  'host-' || cast(e.user_id % 4 AS string) AS service_instance,
  CASE WHEN e.event_type <> 'error' AND e.event_id % 50 <> 0 AND e.event_id % 3 <> 0 THEN e.ts ELSE NULL END
    AS sync_mark
FROM {events} e
"""

LINKS_SQL = r"""
SELECT
  'uuid:' || cast(o.o_orderkey AS string) AS uuid,
  cast(o.o_orderdate AS date) AS survey_date,
  o.building_image_url,
  o.address_plus_code_url,
  CASE WHEN o.o_orderkey % 11 = 0 OR o.building_image_url IS NULL THEN NULL
       ELSE '<img src="' || o.building_image_url || '" width="100%" height="100%" />' END AS building_image_url_html,
  CASE WHEN o.o_orderkey % 13 = 0 OR o.address_plus_code_url IS NULL THEN NULL
       ELSE '<img src=''' || o.address_plus_code_url || ''' />' END AS address_plus_code_url_html
FROM (
  SELECT o2.o_orderkey, o2.o_orderdate,
    CASE o2.o_orderkey % 5 WHEN 0 THEN NULL
      WHEN 1 THEN 'https://survey-media.s3.eu-west-1.amazonaws.com/building-images/uuid%253A' ||
                  cast(o2.o_orderkey AS string) || '-bld+' || cast(o2.o_orderkey % 7 AS string) ||
                  '.jpg?AWSAccessKeyId=AK&Expires=' || cast(1704067200 + (o2.o_orderkey % 100) * 3600 AS string) ||
                  '&Signature=s'
      WHEN 2 THEN 'https://s3.eu-west-1.amazonaws.com/survey-media/building-images/uuid%3A' ||
                  cast(o2.o_orderkey AS string) || '-bld.jpg?X-Amz-Algorithm=AWS4&X-Amz-Expires=86400&X-Amz-Signature=t'
      WHEN 3 THEN 'https://survey-media.s3.amazonaws.com/building-images/' || cast(o2.o_orderkey AS string) || '.jpg'
      ELSE 'https://other-bucket.s3.amazonaws.com/x/' || cast(o2.o_orderkey AS string) || '.jpg?Expires=' ||
           cast(1704067200 + (o2.o_orderkey % 100) * 3600 AS string) END AS building_image_url,
    CASE (o2.o_orderkey + 2) % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
      WHEN 2 THEN 'https://survey-media.s3.eu-west-1.amazonaws.com/address-plus-code-images/uuid%25253A' ||
                  cast(o2.o_orderkey AS string) || '-pc.jpg?Expires=' ||
                  cast(1704067200 + (o2.o_orderkey % 50) * 600 AS string)
      WHEN 3 THEN 'https://survey-media.s3.eu-west-1.amazonaws.com/address-plus-code-images/' ||
                  cast(o2.o_orderkey AS string) || '%zz.jpg?Expires=1704074401'
      ELSE 'https://survey-media.s3.eu-west-1.amazonaws.com/address-plus-code-images/a%2Fb-' ||
           cast(o2.o_orderkey AS string) || '.jpg?Expires=1704074400' END AS address_plus_code_url
  FROM {orders} o2
) o
"""

INCOMING_SQL = r"""
SELECT
  'uuid:' || cast(l.l_orderkey AS string) AS uuid,
  l.l_shipdate AS submitted_date,
  l.l_linenumber AS seq,
  l.l_partkey AS tb1,
  l.l_suppkey AS tb2,
  cast(l.l_extendedprice AS decimal(15,2)) AS tb3,
  CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE cast(cast(l.l_quantity AS decimal(15,2)) AS string) END AS sum_owner,
  l.l_linenumber % 2 = 0 AS has_sum_owner,
  'logo_' || cast(l.l_partkey AS string) || '.png' AS logo,
  l.l_partkey % 3 <> 0 AS has_logo,
  l.l_returnflag AS sum_landlord,
  l.l_suppkey % 4 = 1 AS has_sum_landlord
FROM {lineitem} l
"""

VIEW_SQL = {
    "properties": PROPERTIES_SQL,
    "persons": PERSONS_SQL,
    "sync_history": SYNC_HISTORY_SQL,
    "links": LINKS_SQL,
    "incoming": INCOMING_SQL,
}

# Base tables each view reads (placeholders in the template).
VIEW_INPUTS = {
    "properties": ("customer", "nation", "region", "supplier"),
    "persons": ("orders",),
    "sync_history": ("events",),
    "links": ("orders",),
    "incoming": ("lineitem",),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as its reader splits it; nothing is planned or exchanged here."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def survey_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one survey view from the driver's tables (lazy; nothing is read yet)."""
    args = {t: read_table(spark, sf_dir, t) for t in VIEW_INPUTS[name]}
    return spark.sql(VIEW_SQL[name].replace("{ts}", "TIMESTAMP_NTZ"), **args)


def survey_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: survey_view(spark, sf_dir, name) for name in VIEW_SQL}


def duckdb_view_sql(name: str) -> str:
    """The same view for DuckDB (driver's tables are registered under their names)."""
    return VIEW_SQL[name].replace("{ts}", "TIMESTAMP").format(**{t: t for t in TABLES})
