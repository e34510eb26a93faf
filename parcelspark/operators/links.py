"""Attachments and signed links as column expressions and small manifests (no network I/O).

Everything here is row-local (narrow) except the joins against stored rows
(J9/J11), which are equi-joins on the submission key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions.json import jget, top_level_value_by_name
from parcelspark.operators.store import Store

# FIXED VALUES: styled image HTML and card HTML pieces (the storage folders are in constants).
STYLED_IMG = ('<img src="{url}"\n                        style="max-width: 100%; height: auto; border-radius: 4px;\n'
              '                        box-shadow: 0 2px 4px rgba(0,0,0,0.1);"\n'
              '                        onerror="this.style.display=\'none\'" />')
CARD_STYLE = 'style="object-fit: cover; border-radius: 4px; max-width: 100%;" loading="lazy" alt="Building Image" />'
DEFAULT_BASE_FOLDER = K.ATTACHMENT_BASE_FOLDER


def nonblank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def _text_value(c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), c)


def extract_building_image(description: Column, extra: Column | None = None) -> Column:
    """``property_description.building_image`` or the first top-level field named *building*image*."""
    inside = _text_value(jget(description, "$.building_image"))
    if extra is None:
        return inside
    return F.coalesce(inside, _text_value(top_level_value_by_name(extra, "building", "image")))


def extract_plus_code_image(location: Column, extra: Column | None = None) -> Column:
    """R2: ``property_location.address_plus_code_image`` or a top-level field named *address*plus*code*."""
    inside = _text_value(jget(location, "$.address_plus_code_image"))
    if extra is None:
        return inside
    return F.coalesce(inside, _text_value(top_level_value_by_name(extra, "address", "plus", "code")))


def attachment_source(value: Column, submission_id: Column, base_url: str, project: str, form: str) -> Column:
    """Where to fetch an attachment: the URL itself, or the form server's attachment path for a file name."""
    path = F.concat(F.lit(f"{base_url}/v1/projects/{project}/forms/{form}/submissions/"), submission_id,
                    F.lit("/attachments/"), F.replace(value, F.lit(" "), F.lit("%20")))
    return F.when(value.isNull() | (value == ""), F.lit(None).cast("string")) \
        .when(value.startswith("http"), value).otherwise(path)


def object_key(submission_id: Column, field: Column, filename: Column,
               base_folder: str = DEFAULT_BASE_FOLDER) -> Column:
    """``{base}/{folder}/{id}-{file}``; folder by attachment field, unknown -> building images."""
    folder = F.lit(K.ATTACHMENT_DEFAULT_FOLDER)
    for fld, sub in reversed(list(K.ATTACHMENT_FOLDERS.items())):
        folder = F.when(field == fld, F.lit(sub)).otherwise(folder)
    return F.concat(F.lit(base_folder + "/"), folder, F.lit("/"), submission_id, F.lit("-"), filename)


def placeholder_key(submission_id: Column, base_folder: str = DEFAULT_BASE_FOLDER) -> Column:
    return F.concat(F.lit(f"{base_folder}/{K.PLACEHOLDER_FOLDER}/"), submission_id, F.lit(".png"))


def url_expiry_epoch(url: Column) -> Column:
    """First ``Expires=<digits>`` as epoch seconds; NULL when absent or not a number."""
    digits = F.regexp_extract(url, K.EXPIRES_RE, 1)
    return F.when(url.contains("Expires="), F.nullif(digits, F.lit("")).try_cast("bigint"))


def url_expiry_ts(url: Column) -> Column:
    """Expiry as a UTC wall-clock ``timestamp_ntz`` (independent of the session time zone)."""
    return F.timestamp_add("SECOND", url_expiry_epoch(url), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def url_needs_refresh(url: Column, now_epoch: int | Column, threshold_hours: float = K.REFRESH_THRESHOLD_HOURS) -> Column:
    """no/bad expiry, or expiry at or before now + threshold."""
    e = url_expiry_epoch(url)
    now = now_epoch if isinstance(now_epoch, Column) else F.lit(int(now_epoch))
    return F.when(e.isNull(), F.lit(True)).otherwise(e <= now + F.lit(int(threshold_hours * 3600)))


def url_status(url: Column, now_epoch: int | Column, threshold_hours: float = K.REFRESH_THRESHOLD_HOURS) -> Column:
    """No expiry / expired (<= now) / expiring soon (<= now + threshold) / valid."""
    e = url_expiry_epoch(url)
    now = now_epoch if isinstance(now_epoch, Column) else F.lit(int(now_epoch))
    return (F.when(e.isNull(), F.lit(K.URL_STATUS["none"]))
            .when(e <= now, F.lit(K.URL_STATUS["expired"]))
            .when(e <= now + F.lit(int(threshold_hours * 3600)), F.lit(K.URL_STATUS["soon"]))
            .otherwise(F.lit(K.URL_STATUS["valid"])))


def url_from_html(html: Column) -> Column:
    """The ``src`` of an ``<img>`` tag; NULL when none."""
    return F.nullif(F.regexp_extract(html, K.IMG_SRC_RE, 1), F.lit(""))


def decode_key_fixpoint(key: Column, rounds: int = K.DECODE_MAX_ROUNDS) -> Column:
    """Percent-decode until the text stops changing (at most ``rounds`` times).

    ``+`` stays ``+`` and a ``%`` not followed by two hex digits stays as is; all
    other escapes are decoded, as a path unquote does.
    """
    def once(a):
        protected = F.regexp_replace(F.replace(a, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
        return F.url_decode(protected)
    # a text without an escape has reached its fixpoint: the remaining rounds only look for '%'
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), key,
                       lambda acc, _i: F.when(acc.contains("%"), once(acc)).otherwise(acc))


def object_key_from_url(url: Column, bucket: str) -> Column:
    """Object key of a bucket URL (virtual-host or path style), up to ``?``; other buckets -> NULL."""
    b = re.escape(bucket)
    # FIXED VALUES: the two URL forms of a bucket.
    vhost = F.nullif(F.regexp_extract(url, rf"https://{b}\.s3\.[^/]+/([^?]+)", 1), F.lit(""))
    path = F.nullif(F.regexp_extract(url, rf"/{b}/([^?]+)", 1), F.lit(""))
    return F.when(url.contains(bucket), F.when(url.contains(f"{bucket}.s3."), vhost).otherwise(path))


def refresh_manifest(df: DataFrame, now_epoch: int, bucket: str,
                     threshold_hours: float = K.REFRESH_THRESHOLD_HOURS, key: str = "uuid") -> DataFrame:
    """Rows whose stored links need a new signature, with the object key of each such link."""
    b, p = F.col("building_image_url"), F.col("address_plus_code_url")
    b_need = nonblank(b) & url_needs_refresh(b, now_epoch, threshold_hours)
    p_need = nonblank(p) & url_needs_refresh(p, now_epoch, threshold_hours)
    out = df.select(key, b_need.alias("building_needs_refresh"), p_need.alias("plus_code_needs_refresh"),
                    F.when(b_need, decode_key_fixpoint(object_key_from_url(b, bucket))).alias("building_key"),
                    F.when(p_need, decode_key_fixpoint(object_key_from_url(p, bucket))).alias("plus_code_key"))
    out = out.where(F.col("building_needs_refresh") | F.col("plus_code_needs_refresh"))
    return out.withColumn("refresh_count", (F.col("building_key").isNotNull().cast("int")
                                            + F.col("plus_code_key").isNotNull().cast("int")))


# Links by the hour in which they fall due: 0 for those without a readable expiry, which are always due.
LINK_SCHEMA = "uuid string, building_image_url string, address_plus_code_url string"
LAST_HOUR = 4_000_000  # links that expire later share one part (the year 2426)
TASK_ROWS = 500_000  # written by one task: texts of links take a tenth of their size when shuffled


def _due_hour(url: Column) -> Column:
    hour = F.coalesce(F.floor(url_expiry_epoch(url) / 3600), F.lit(0))
    return F.when(nonblank(url), F.least(hour, F.lit(LAST_HOUR)))


def due_hour(building: Column, plus_code: Column) -> Column:
    """The hour in which the first of a row's links expires; NULL for a row without links."""
    return F.least(_due_hour(building), _due_hour(plus_code)).cast("int")


def link_store(path: str) -> Store:
    """Links by due hour: a new link moves its row to another part.  The hour of those that are always due may hold most rows."""
    return Store(path, LINK_SCHEMA, "uuid", lambda: due_hour(F.col("building_image_url"), F.col("address_plus_code_url")), by_key=False, task_rows=TASK_ROWS)


def due_links(dated: DataFrame, now_epoch: int, threshold_hours: float = K.REFRESH_THRESHOLD_HOURS, hour_col: str = "part") -> DataFrame:
    """Rows of a table partitioned by :func:`due_hour` whose hour has come: later folders are not read."""
    return dated.where(F.col(hour_col) <= F.lit(int((now_epoch + threshold_hours * 3600) // 3600)))


def img_html_card(url: Column, placeholder: Column | bool = False, width: str = "100%", height: str = "100%") -> Column:
    """Container + link + image HTML; quotes escaped; '' when there is no URL."""
    safe = F.replace(url, F.lit('"'), F.lit("&quot;"))
    ph = placeholder if isinstance(placeholder, Column) else F.lit(bool(placeholder))
    cls = F.when(ph, F.lit(" placeholder-image")).otherwise(F.lit(""))
    html = F.concat(F.lit('<div class="image-container'), cls, F.lit('">'),
                    F.lit('<a href="'), safe, F.lit('" target="_blank" rel="noopener noreferrer">'),
                    F.lit('<img src="'), safe, F.lit(f'" width="{width}" height="{height}" '), F.lit(CARD_STYLE),
                    F.lit("</a></div>"))
    return F.when(url.isNull() | (url == ""), F.lit("")).otherwise(html)


def img_html_update(df: DataFrame) -> DataFrame:
    """Restyle the HTML columns from their URL columns, only where both columns exist."""
    out = df
    for u, h in (("building_image_url", "building_image_url_html"),
                 ("address_plus_code_url", "address_plus_code_url_html")):
        if u in df.columns and h in df.columns:
            pre, post = STYLED_IMG.split("{url}")
            out = out.withColumn(h, F.when(nonblank_strict(F.col(u)), F.concat(F.lit(pre), F.col(u), F.lit(post)))
                                 .otherwise(F.lit(None).cast("string")))
    return out


def nonblank_strict(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def new_vs_existing(batch: DataFrame, stored: DataFrame, key: str = "uuid") -> DataFrame:
    """Flag each batch row whose key is already stored (left join on the key; stored keys deduplicated)."""
    keys = stored.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct() \
        .withColumn("_stored", F.lit(True))
    return (batch.join(keys, batch[key] == keys["_k"], "left").drop("_k")
            .withColumn("is_existing", F.coalesce(F.col("_stored"), F.lit(False))).drop("_stored"))


def attachment_plan(batch: DataFrame, stored: DataFrame, base_folder: str = DEFAULT_BASE_FOLDER,
                    prioritize_new: bool = True) -> DataFrame:
    """R5 (+J9, L6 columns): one manifest row per attachment to fetch.

    A stored submission is skipped when the *incoming* record carries a building
    link.  Each remaining one yields its building image (or a placeholder key
    when it names none) and its plus-code image when it names one, with priority 0
    for new submissions and 1 for stored ones.  Images are read from the two JSON
    blocks only.
    """
    sid = F.coalesce(F.nullif(F.col("uuid"), F.lit("")), F.col("id"))
    stored_keys = stored.select(F.col("uuid").alias("_k")).where(F.col("_k").isNotNull()).distinct()
    link = F.col("building_image_url") if "building_image_url" in batch.columns else F.lit(None).cast("string")
    b = (batch.select(sid.alias("submission_id"), F.coalesce(nonblank_strict(link), F.lit(False)).alias("_linked"),
                      F.nullif(extract_building_image(F.col("property_description")), F.lit("")).alias("_bimg"),
                      F.nullif(extract_plus_code_image(F.col("property_location")), F.lit("")).alias("_pimg"))
         .join(stored_keys, F.col("submission_id") == F.col("_k"), "left")
         .where(~(F.col("_k").isNotNull() & F.col("_linked")))
         .withColumn("priority", F.when(F.lit(prioritize_new) & F.col("_k").isNull(), 0).otherwise(1)))
    building = b.select(
        "submission_id", "priority", F.lit("building_image").alias("field"),
        F.col("_bimg").alias("source_value"), F.col("_bimg").isNull().alias("is_placeholder"),
        F.when(F.col("_bimg").isNull(), placeholder_key(F.col("submission_id"), base_folder))
        .otherwise(object_key(F.col("submission_id"), F.lit("building_image"), F.col("_bimg"), base_folder))
        .alias("object_key"))
    plus = b.where(F.col("_pimg").isNotNull()).select(
        "submission_id", "priority", F.lit("address_plus_code").alias("field"),
        F.col("_pimg").alias("source_value"), F.lit(False).alias("is_placeholder"),
        object_key(F.col("submission_id"), F.lit("address_plus_code"), F.col("_pimg"), base_folder)
        .alias("object_key"))
    return building.unionByName(plus)


def attach_results(batch: DataFrame, results: DataFrame, key: str = "uuid") -> DataFrame:
    """Put new links back onto the submissions by key, only where a new value exists."""
    cols = [c for c in results.columns if c != key]
    r = results.select(F.col(key).alias("_rk"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    out = batch.join(r, batch[key] == r["_rk"], "left").drop("_rk")
    for c in cols:
        old = F.col(c) if c in batch.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), old)).drop(f"_new_{c}")
    return out


def audit_payloads(df: DataFrame, key: str, payload: str, small_bytes: int = K.SMALL_PAYLOAD_BYTES) -> DataFrame:
    """Stored payloads with their size in bytes; a missing one or one under ``small_bytes`` is suspect."""
    size = F.coalesce(F.octet_length(payload), F.lit(0)).cast("bigint")
    return df.select(key, size.alias("length"), (size < F.lit(small_bytes)).alias("suspect"))
