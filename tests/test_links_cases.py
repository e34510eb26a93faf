"""Image extraction (FIXTURES 2.3) and link states (FIXTURES 2.4)."""
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.operators import links as LK

NOW = 1704067200


def test_image_extraction_cases(spark):
    rows = [
        ('{"address_plus_code_image":"address_code_image_1.jpg"}', "{}"),
        ('"{\\"address_plus_code_image\\":\\"address_code_image_2.png\\"}"', "{}"),
        ('{"street_label":"x"}', "{}"),
        (None, "{}"),
        ("{}", '{"address_plus_code_image_field":"top_level_image.jpg"}'),
    ]
    df = spark.createDataFrame(rows, "loc string, extra string")
    from parcelspark.functions.json import unwrap_text
    with_fb = [r[0] for r in df.select(LK.extract_plus_code_image(unwrap_text(F.col("loc")), F.col("extra"))).collect()]
    no_fb = [r[0] for r in df.select(LK.extract_plus_code_image(unwrap_text(F.col("loc")))).collect()]
    assert with_fb == ["address_code_image_1.jpg", "address_code_image_2.png", None, None, "top_level_image.jpg"]
    assert no_fb[:4] == with_fb[:4] and no_fb[4] is None


def test_url_states(spark):
    urls = ["https://b/x?Expires=1704067200", "https://b/x?Expires=1704074400", "https://b/x?Expires=1704074401",
            "https://b/x.jpg", "https://b/x?X-Amz-Expires=86400",
            "https://bkt.s3.r.amazonaws.com/a/uuid%253A1-b+c.jpg?Expires=1"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select(LK.url_needs_refresh(F.col("u"), NOW), LK.url_status(F.col("u"), NOW),
                    LK.decode_key_fixpoint(LK.object_key_from_url(F.col("u"), "bkt"))).collect()
    s = K.URL_STATUS
    assert [r[0] for r in got] == [True, True, False, True, True, True]
    assert [r[1] for r in got] == [s["expired"], s["soon"], s["valid"], s["none"], s["expired"], s["expired"]]
    assert got[5][2] == "a/uuid:1-b+c.jpg"


def test_decode_leaves_bad_escape(spark):
    df = spark.createDataFrame([("a%2Fb%zz",), ("x%252525y",)], "k string")
    got = [r[0] for r in df.select(LK.decode_key_fixpoint(F.col("k"))).collect()]
    assert got == ["a/b%zz", "x%y"]


def test_object_key_and_placeholder(spark):
    df = spark.createDataFrame([("s1", "building_image", "a b.jpg"), ("s2", "address_plus_code", "p.jpg"),
                                ("s3", "other", "o.jpg")], "id string, f string, n string")
    got = [r[0] for r in df.select(LK.object_key(F.col("id"), F.col("f"), F.col("n"))).collect()]
    assert got == ["odk_images/building-images/s1-a b.jpg", "odk_images/address-plus-code-images/s2-p.jpg",
                   "odk_images/building-images/s3-o.jpg"]
    src = df.select(LK.attachment_source(F.col("n"), F.col("id"), "https://h", "1", "f")).first()[0]
    assert src == "https://h/v1/projects/1/forms/f/submissions/s1/attachments/a%20b.jpg"


def test_attachment_plan_incoming_link_decides(spark):
    loc, desc = '{"address_plus_code_image":"p.jpg"}', '{"building_image":"b.jpg"}'
    cols = "uuid string, id string, property_location string, property_description string, building_image_url string, extra_json string"
    batch = spark.createDataFrame([
        ("new", "1", loc, desc, "https://have", None),      # not stored: planned although it carries a link
        ("linked", "2", loc, desc, "https://have", None),   # stored, incoming link: skipped
        ("bare", "3", None, desc, "", None),                # stored (with a stored link), no incoming link: planned
        ("", "byid", None, '{"building_image":""}', None, '{"building_image_x":"top.jpg"}'),  # key from id; no fallback image
    ], cols)
    stored = spark.createDataFrame([("linked", None), ("bare", "https://stored")], "uuid string, building_image_url string")
    got = {(r["submission_id"], r["field"]): (r["priority"], r["source_value"], r["is_placeholder"])
           for r in LK.attachment_plan(batch, stored).collect()}
    assert got == {("new", "building_image"): (0, "b.jpg", False), ("new", "address_plus_code"): (0, "p.jpg", False),
                   ("bare", "building_image"): (1, "b.jpg", False), ("byid", "building_image"): (0, None, True)}


def test_payload_audit(spark):
    df = spark.createDataFrame([(1, "x" * 100), (2, "é" * 49), (3, None)], "k int, body string")
    assert [tuple(r) for r in LK.audit_payloads(df, "k", "body", 100).collect()] == [(1, 100, False), (2, 98, True), (3, 0, True)]
