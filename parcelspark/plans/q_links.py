"""Registered queries: attachments and signed links."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.operators import links as LK
from parcelspark.plans import duck as D
from parcelspark.plans.registry import register, views

NOW_EPOCH = 1704067200  # the pinned "now" of the link tests: 2024-01-01T00:00:00Z
BUCKET = "survey-media"
ODK_BASE, ODK_PROJECT, ODK_FORM = "https://odk.example.org", "1", "survey"


def pct_tenths_spark(n: str, total: str):
    """Share in percent, one decimal, half up, in exact integer arithmetic."""
    return (F.expr(f"(2000 * {n} + {total}) div (2 * {total})").cast("decimal(6,0)") * F.lit(0.1)).cast("decimal(5,1)")


def pct_tenths_sql(n: str, total: str) -> str:
    return f"CAST(CAST((2000 * {n} + {total}) // (2 * {total}) AS DECIMAL(6,0)) * 0.1 AS DECIMAL(5,1))"


# ---- DuckDB pieces ----------------------------------------------------------------------------
def d_epoch(u):
    return (f"(CASE WHEN contains({u}, 'Expires=') THEN "
            f"TRY_CAST(nullif(regexp_extract({u}, 'Expires=([0-9]+)', 1), '') AS BIGINT) END)")


def d_needs(u, now=NOW_EPOCH, th=K.REFRESH_THRESHOLD_HOURS):
    e = d_epoch(u)
    return f"(CASE WHEN {e} IS NULL THEN true ELSE {e} <= {now + th * 3600} END)"


def d_status(u, now=NOW_EPOCH, th=K.REFRESH_THRESHOLD_HOURS):
    e = d_epoch(u)
    s = K.URL_STATUS
    return (f"(CASE WHEN {e} IS NULL THEN {D.q(s['none'])} WHEN {e} <= {now} THEN {D.q(s['expired'])} "
            f"WHEN {e} <= {now + th * 3600} THEN {D.q(s['soon'])} ELSE {D.q(s['valid'])} END)")


def d_src(h):
    return f"nullif(regexp_extract({h}, 'src=[\"'']([^\"'']+)[\"'']', 1), '')"


def d_key_raw(u, bucket=BUCKET):
    b = bucket.replace("-", "\\-").replace(".", "\\.")
    return (f"(CASE WHEN contains({u}, '{bucket}') THEN CASE WHEN contains({u}, '{bucket}.s3.') "
            f"THEN nullif(regexp_extract({u}, 'https://{b}\\.s3\\.[^/]+/([^?]+)', 1), '') "
            f"ELSE nullif(regexp_extract({u}, '/{b}/([^?]+)', 1), '') END END)")


def d_decode(k, rounds=K.DECODE_MAX_ROUNDS):
    for _ in range(rounds):
        k = f"url_decode({k})"
    return k


def d_nonblank(u):
    return f"({u} IS NOT NULL AND trim({u}) <> '')"


LINKS = D.with_views("links")
PROPS = D.with_views("properties")


@register("url_expiry", LINKS + f"""
SELECT uuid, {d_epoch('building_image_url')} AS building_expires_epoch,
       make_timestamp({d_epoch('building_image_url')} * 1000000) AS building_expires_at,
       {d_epoch('address_plus_code_url')} AS plus_code_expires_epoch FROM links""")
def url_expiry(spark, sf):
    l_ = views(spark, sf, "links")
    b, p = F.col("building_image_url"), F.col("address_plus_code_url")
    return l_.select("uuid", LK.url_expiry_epoch(b).alias("building_expires_epoch"),
                     LK.url_expiry_ts(b).alias("building_expires_at"),
                     LK.url_expiry_epoch(p).alias("plus_code_expires_epoch"))


@register("url_needs_refresh", LINKS + f"""
SELECT uuid, {d_needs('building_image_url')} AS building_needs_refresh,
       {d_needs('address_plus_code_url')} AS plus_code_needs_refresh FROM links""")
def url_needs_refresh(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select("uuid", LK.url_needs_refresh(F.col("building_image_url"), NOW_EPOCH).alias("building_needs_refresh"),
                     LK.url_needs_refresh(F.col("address_plus_code_url"), NOW_EPOCH).alias("plus_code_needs_refresh"))


@register("url_status", LINKS + f"""
SELECT uuid, {d_status('building_image_url')} AS building_status,
       {d_status('address_plus_code_url')} AS plus_code_status FROM links""")
def url_status(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select("uuid", LK.url_status(F.col("building_image_url"), NOW_EPOCH).alias("building_status"),
                     LK.url_status(F.col("address_plus_code_url"), NOW_EPOCH).alias("plus_code_status"))


@register("url_from_html", LINKS + f"""
SELECT uuid, {d_src('building_image_url_html')} AS building_src,
       {d_src('address_plus_code_url_html')} AS plus_code_src FROM links""")
def url_from_html(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select("uuid", LK.url_from_html(F.col("building_image_url_html")).alias("building_src"),
                     LK.url_from_html(F.col("address_plus_code_url_html")).alias("plus_code_src"))


@register("object_key_from_url", LINKS + f"""
SELECT uuid, {d_key_raw('building_image_url')} AS building_key_raw,
       {d_key_raw('address_plus_code_url')} AS plus_code_key_raw FROM links""")
def object_key_from_url(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select("uuid", LK.object_key_from_url(F.col("building_image_url"), BUCKET).alias("building_key_raw"),
                     LK.object_key_from_url(F.col("address_plus_code_url"), BUCKET).alias("plus_code_key_raw"))


@register("decode_key_fixpoint", LINKS + f"""
SELECT uuid, {d_decode(d_key_raw('building_image_url'))} AS building_key,
       {d_decode(d_key_raw('address_plus_code_url'))} AS plus_code_key FROM links""")
def decode_key_fixpoint(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select(
        "uuid",
        LK.decode_key_fixpoint(LK.object_key_from_url(F.col("building_image_url"), BUCKET)).alias("building_key"),
        LK.decode_key_fixpoint(LK.object_key_from_url(F.col("address_plus_code_url"), BUCKET)).alias("plus_code_key"))


def _refresh_sql():
    bn = f"({d_nonblank('building_image_url')} AND {d_needs('building_image_url')})"
    pn = f"({d_nonblank('address_plus_code_url')} AND {d_needs('address_plus_code_url')})"
    return LINKS + f""",
r AS (SELECT uuid, {bn} AS building_needs_refresh, {pn} AS plus_code_needs_refresh,
        CASE WHEN {bn} THEN {d_decode(d_key_raw('building_image_url'))} END AS building_key,
        CASE WHEN {pn} THEN {d_decode(d_key_raw('address_plus_code_url'))} END AS plus_code_key FROM links)
SELECT *, CAST((building_key IS NOT NULL)::INTEGER + (plus_code_key IS NOT NULL)::INTEGER AS INTEGER) AS refresh_count
FROM r WHERE building_needs_refresh OR plus_code_needs_refresh"""


@register("refresh_manifest", _refresh_sql())
def refresh_manifest(spark, sf):
    return LK.refresh_manifest(views(spark, sf, "links"), NOW_EPOCH, BUCKET)


@register("img_html_card", LINKS + """
SELECT uuid, CASE WHEN building_image_url IS NULL OR building_image_url = '' THEN '' ELSE
  '<div class="image-container' || CASE WHEN uuid LIKE '%0' THEN ' placeholder-image' ELSE '' END || '">' ||
  '<a href="' || replace(building_image_url, '"', '&quot;') || '" target="_blank" rel="noopener noreferrer">' ||
  '<img src="' || replace(building_image_url, '"', '&quot;') || '" width="100%" height="100%" ' ||
  'style="object-fit: cover; border-radius: 4px; max-width: 100%;" loading="lazy" alt="Building Image" />' ||
  '</a></div>' END AS building_card FROM links""")
def img_html_card(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.select("uuid", LK.img_html_card(F.col("building_image_url"), F.col("uuid").endswith("0"))
                     .alias("building_card"))


def _styled_sql(u):
    pre, post = LK.STYLED_IMG.split("{url}")
    return f"(CASE WHEN {u} IS NOT NULL AND {u} <> '' THEN {D.q(pre)} || {u} || {D.q(post)} END)"


@register("img_html_update", LINKS + f"""
SELECT uuid, building_image_url, address_plus_code_url, {_styled_sql('building_image_url')} AS building_image_url_html,
       {_styled_sql('address_plus_code_url')} AS address_plus_code_url_html FROM links""")
def img_html_update(spark, sf):
    l_ = views(spark, sf, "links").select("uuid", "building_image_url", "address_plus_code_url",
                                          "building_image_url_html", "address_plus_code_url_html")
    return LK.img_html_update(l_)


@register("url_presence", LINKS + """
SELECT count(*) AS total_records,
  count(*) FILTER (WHERE building_image_url IS NOT NULL AND building_image_url <> '') AS with_building_url,
  count(*) FILTER (WHERE address_plus_code_url IS NOT NULL AND address_plus_code_url <> '') AS with_plus_code_url
FROM links""")
def url_presence(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_if(LK.nonblank_strict(F.col("building_image_url"))).alias("with_building_url"),
                  F.count_if(LK.nonblank_strict(F.col("address_plus_code_url"))).alias("with_plus_code_url"))


@register("url_html_consistency", LINKS + """,
a AS (SELECT
  count(*) FILTER (WHERE building_image_url IS NOT NULL AND building_image_url <> '') AS building_urls,
  count(*) FILTER (WHERE building_image_url_html IS NOT NULL AND building_image_url_html <> '') AS building_html,
  count(*) FILTER (WHERE address_plus_code_url IS NOT NULL AND address_plus_code_url <> '') AS plus_code_urls,
  count(*) FILTER (WHERE address_plus_code_url_html IS NOT NULL AND address_plus_code_url_html <> '') AS plus_code_html
  FROM links)
SELECT *, building_urls = building_html AS building_consistent, plus_code_urls = plus_code_html AS plus_code_consistent
FROM a""")
def url_html_consistency(spark, sf):
    l_ = views(spark, sf, "links")
    nb = LK.nonblank_strict
    a = l_.agg(F.count_if(nb(F.col("building_image_url"))).alias("building_urls"),
               F.count_if(nb(F.col("building_image_url_html"))).alias("building_html"),
               F.count_if(nb(F.col("address_plus_code_url"))).alias("plus_code_urls"),
               F.count_if(nb(F.col("address_plus_code_url_html"))).alias("plus_code_html"))
    return a.select("*", (F.col("building_urls") == F.col("building_html")).alias("building_consistent"),
                    (F.col("plus_code_urls") == F.col("plus_code_html")).alias("plus_code_consistent"))


@register("url_status_histogram", LINKS + f""",
s AS (SELECT 'building' AS kind, {d_src('building_image_url_html')} AS u FROM links
      WHERE building_image_url_html IS NOT NULL AND building_image_url_html <> ''
      UNION ALL
      SELECT 'plus_code', {d_src('address_plus_code_url_html')} FROM links
      WHERE address_plus_code_url_html IS NOT NULL AND address_plus_code_url_html <> ''),
c AS (SELECT kind, {d_status('u')} AS status, count(*) AS n FROM s WHERE u IS NOT NULL GROUP BY 1, 2),
t AS (SELECT kind, sum(n) AS total,
        sum(CASE WHEN status IN ('{K.URL_STATUS['expired']}', '{K.URL_STATUS['soon']}') THEN n ELSE 0 END) AS problems
      FROM c GROUP BY 1)
SELECT c.kind, c.status, c.n, {pct_tenths_sql('c.n', 't.total')} AS pct, CAST(t.problems AS BIGINT) AS problem_total
FROM c JOIN t ON c.kind = t.kind""")
def url_status_histogram(spark, sf):
    l_ = views(spark, sf, "links")
    kinds = F.explode(F.array(
        F.struct(F.lit("building").alias("kind"), F.col("building_image_url_html").alias("html")),
        F.struct(F.lit("plus_code").alias("kind"), F.col("address_plus_code_url_html").alias("html"))))
    s = l_.select(kinds.alias("k")).select("k.kind", "k.html").where(LK.nonblank_strict(F.col("html")))
    s = s.withColumn("u", LK.url_from_html(F.col("html"))).where(F.col("u").isNotNull())
    c = s.groupBy("kind", LK.url_status(F.col("u"), NOW_EPOCH).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    problem = F.col("status").isin(K.URL_STATUS["expired"], K.URL_STATUS["soon"])
    t = c.groupBy("kind").agg(F.sum("n").alias("_total"),
                              F.sum(F.when(problem, F.col("n")).otherwise(0)).cast("bigint").alias("problem_total"))
    return (c.join(t, "kind").select("kind", "status", "n", pct_tenths_spark("n", "_total").alias("pct"),
                                     "problem_total"))


@register("recent_with_urls", LINKS + """
SELECT uuid, survey_date, building_image_url_html, address_plus_code_url_html FROM links
WHERE (building_image_url_html IS NOT NULL AND building_image_url_html <> '')
   OR (address_plus_code_url_html IS NOT NULL AND address_plus_code_url_html <> '')
ORDER BY survey_date DESC, uuid LIMIT 50""")
def recent_with_urls(spark, sf):
    l_ = views(spark, sf, "links")
    nb = LK.nonblank_strict
    return (l_.where(nb(F.col("building_image_url_html")) | nb(F.col("address_plus_code_url_html")))
            .select("uuid", "survey_date", "building_image_url_html", "address_plus_code_url_html")
            .orderBy(F.col("survey_date").desc_nulls_last(), F.col("uuid")).limit(50))


@register("submission_overview", LINKS + """
SELECT count(*) AS total_submissions, count(DISTINCT survey_date) AS survey_days,
       count(building_image_url) AS with_building_image FROM links""")
def submission_overview(spark, sf):
    l_ = views(spark, sf, "links")
    return l_.agg(F.count(F.lit(1)).alias("total_submissions"),
                  F.countDistinct("survey_date").alias("survey_days"),
                  F.count("building_image_url").alias("with_building_image"))


@register("filter_has_url", LINKS + """
SELECT uuid FROM links WHERE (building_image_url IS NOT NULL AND building_image_url <> '')
   OR (address_plus_code_url IS NOT NULL AND address_plus_code_url <> '')""")
def filter_has_url(spark, sf):
    l_ = views(spark, sf, "links")
    nb = LK.nonblank_strict
    return l_.where(nb(F.col("building_image_url")) | nb(F.col("address_plus_code_url"))).select("uuid")


def _d_top_level(extra, *needles):
    cond = " AND ".join(f"contains(lower(k), '{n}')" for n in needles)
    keys = (f"list_filter(json_keys({extra}), lambda k: {cond} AND "
            f"json_extract_string({extra}, '$.\"' || k || '\"') <> '')")
    return f"json_extract_string({extra}, '$.\"' || ({keys})[1] || '\"')"


def _d_inside(doc, path):
    v = D.jx(doc, path)
    return f"(CASE WHEN {v} <> '' THEN {v} END)"


@register("extract_building_image", PROPS + f"""
SELECT uuid, coalesce({_d_inside('property_description', '$.building_image')},
                      {_d_top_level('extra_json', 'building', 'image')}) AS building_image,
       coalesce({_d_inside('property_location', '$.address_plus_code_image')},
                {_d_top_level('extra_json', 'address', 'plus', 'code')}) AS plus_code_image
FROM properties""")
def extract_building_image(spark, sf):
    p = views(spark, sf, "properties")
    return p.select("uuid", LK.extract_building_image(F.col("property_description"), F.col("extra_json"))
                    .alias("building_image"),
                    LK.extract_plus_code_image(F.col("property_location"), F.col("extra_json")).alias("plus_code_image"))


@register("extract_plus_code_image", PROPS + f"""
SELECT uuid, {_d_inside('property_location', '$.address_plus_code_image')} AS plus_code_image FROM properties""")
def extract_plus_code_image(spark, sf):
    p = views(spark, sf, "properties")
    return p.select("uuid", LK.extract_plus_code_image(F.col("property_location")).alias("plus_code_image"))


def _d_object_key(sid, field, fname, base=LK.DEFAULT_BASE_FOLDER):
    folder = " ".join(f"WHEN {field} = '{k}' THEN '{v}'" for k, v in K.ATTACHMENT_FOLDERS.items())
    return f"'{base}/' || (CASE {folder} ELSE '{K.ATTACHMENT_DEFAULT_FOLDER}' END) || '/' || {sid} || '-' || {fname}"


@register("attachment_source", PROPS + f""",
a AS (SELECT uuid, coalesce({_d_inside('property_description', '$.building_image')},
                            {_d_top_level('extra_json', 'building', 'image')}) AS v FROM properties)
SELECT uuid, CASE WHEN v IS NULL OR v = '' THEN NULL WHEN starts_with(v, 'http') THEN v
  ELSE '{ODK_BASE}/v1/projects/{ODK_PROJECT}/forms/{ODK_FORM}/submissions/' || uuid || '/attachments/' ||
       replace(v, ' ', '%20') END AS source_url,
  CASE WHEN v IS NOT NULL THEN {_d_object_key('uuid', "'building_image'", 'v')} END AS object_key
FROM a""")
def attachment_source(spark, sf):
    p = views(spark, sf, "properties")
    v = LK.extract_building_image(F.col("property_description"), F.col("extra_json"))
    return p.select("uuid", v.alias("_v")).select(
        "uuid", LK.attachment_source(F.col("_v"), F.col("uuid"), ODK_BASE, ODK_PROJECT, ODK_FORM).alias("source_url"),
        F.when(F.col("_v").isNotNull(), LK.object_key(F.col("uuid"), F.lit("building_image"), F.col("_v")))
        .alias("object_key"))


def _plan_sql():
    bimg = f"nullif({_d_inside('property_description', '$.building_image')}, '')"
    pimg = f"nullif({_d_inside('property_location', '$.address_plus_code_image')}, '')"
    return D.with_views("properties", "links") + f""",
st AS (SELECT DISTINCT uuid AS k FROM links WHERE uuid IS NOT NULL),
b AS (SELECT coalesce(nullif(p.uuid, ''), p.id) AS submission_id, {bimg} AS bimg, {pimg} AS pimg, st.k,
             coalesce(p.building_image_url <> '', false) AS linked
      FROM properties p LEFT JOIN st ON st.k = coalesce(nullif(p.uuid, ''), p.id)),
b2 AS (SELECT *, CASE WHEN k IS NULL THEN 0 ELSE 1 END AS priority FROM b WHERE NOT (k IS NOT NULL AND linked))
SELECT submission_id, priority, 'building_image' AS field, bimg AS source_value, bimg IS NULL AS is_placeholder,
  CASE WHEN bimg IS NULL THEN '{LK.DEFAULT_BASE_FOLDER}/{K.PLACEHOLDER_FOLDER}/' || submission_id || '.png'
       ELSE {_d_object_key('submission_id', "'building_image'", 'bimg')} END AS object_key
FROM b2
UNION ALL
SELECT submission_id, priority, 'address_plus_code', pimg, false,
  {_d_object_key('submission_id', "'address_plus_code'", 'pimg')} FROM b2 WHERE pimg IS NOT NULL"""


@register("attachment_plan", _plan_sql())
def attachment_plan(spark, sf):
    props, links = views(spark, sf, "properties", "links")
    return LK.attachment_plan(props, links)


@register("new_vs_existing", D.with_views("properties", "incoming") + """
SELECT DISTINCT i.uuid, (p.uuid IS NOT NULL) AS is_existing
FROM (SELECT DISTINCT uuid FROM incoming) i LEFT JOIN properties p ON p.uuid = i.uuid""")
def new_vs_existing(spark, sf):
    props, inc = views(spark, sf, "properties", "incoming")
    return LK.new_vs_existing(inc.select("uuid").distinct(), props).select("uuid", "is_existing")


@register("attach_results", D.with_views("properties", "links") + """
SELECT p.uuid, coalesce(l.building_image_url, p.building_image_url) AS building_image_url,
       coalesce(l.building_image_url_html, NULL) AS building_image_url_html
FROM properties p LEFT JOIN links l ON l.uuid = p.uuid""")
def attach_results(spark, sf):
    props, links = views(spark, sf, "properties", "links")
    res = links.select("uuid", "building_image_url", "building_image_url_html")
    return LK.attach_results(props.select("uuid", "building_image_url"), res).select(
        "uuid", "building_image_url", "building_image_url_html")


@register("attachment_priority", _plan_sql().replace(
    "SELECT submission_id, priority, 'building_image' AS field", "SELECT * FROM (SELECT submission_id, priority, "
    "'building_image' AS field", 1) + ") ORDER BY priority, submission_id, field")
def attachment_priority(spark, sf):
    props, links = views(spark, sf, "properties", "links")
    return LK.attachment_plan(props, links).orderBy("priority", "submission_id", "field")


@register("attachment_payload_audit", f"""
SELECT page_id, CAST(coalesce(octet_length(encode(html)), 0) AS BIGINT) AS length,
       coalesce(octet_length(encode(html)), 0) < {K.SMALL_PAYLOAD_BYTES} AS suspect FROM pages""")
def attachment_payload_audit(spark, sf):
    """S10 over a table of stored payloads."""
    return LK.audit_payloads(spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet"), "page_id", "html")
