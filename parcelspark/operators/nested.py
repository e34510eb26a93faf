"""Nested (one row per property, persons as an array) form and its inverse.

Scale notes
-----------
* ``persons_rollup`` never builds an unbounded array: every ``chunk_size`` persons of a
  property, in key order, make one row (``person_chunk``, ``person_offset``).  Readers
  work per property (chunk 0 stands for it) and positions count on over the chunks, so
  no answer depends on ``chunk_size``.  Counts tell which properties need more than one
  chunk; only their persons are numbered.  All others are sent once, by their property.
* ``person_index`` numbers persons inside a property without a whole-property
  window: a group is cut into slices by a prefix of the order key a few characters
  longer than the group key.  Prefixes order like the keys, so a slice is numbered
  on its own and shifted by the sizes of the earlier slices.
* Counts per property come from partial aggregation, never from array sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions import text as T
from parcelspark.operators.unified import prop_key, valid_person_key
from parcelspark.session import shared_dir

# FIXED VALUES: the 23 keys of a person object, in order.
PERSON_KEYS = [
    "UUID", "person_type", "shop_apt_unit_number", "type", "business_name", "tax_registered", "tin",
    "individual_first_name", "individual_middle_name", "individual_last_name", "individual_gender",
    "individual_id_type", "individual_nin", "individual_drivers_licence", "individual_passport_number",
    "passport_country", "individual_residence_permit_number", "residence_permit_country", "individual_dob",
    "mobile_1", "mobile_2", "email", "occupancy",
]
DEFAULT_CHUNK = 10000


def person_struct(persons_cols: list[str] | None = None) -> Column:
    """``struct`` of the 23 person keys (``UUID`` from column ``uuid``)."""
    return F.struct(*[(F.col("uuid") if k == "UUID" else F.col(k)).alias(k) for k in PERSON_KEYS])


def rollup_key(key: str = "prefix") -> tuple[Column, Column]:
    """(key expression, validity filter) for the two ways to tie a person to its property."""
    if key == "prefix":
        return prop_key(F.col("uuid")), valid_person_key(F.col("uuid"))
    if key == "fk":
        fk = F.col("submissions_id")
        return fk, fk.isNotNull() & (F.trim(fk) != "")
    raise ValueError(f"unknown key strategy {key!r}")


def person_counts(persons: DataFrame, key: str = "prefix") -> DataFrame:
    """``(prop_uuid, person_count)`` for every property key that persons carry."""
    k, ok = rollup_key(key)
    return persons.where(ok).groupBy(k.alias("prop_uuid")).agg(F.count(F.lit(1)).alias("person_count"))


def property_counts(properties: DataFrame, persons: DataFrame, key: str = "prefix") -> DataFrame:
    """``(uuid, person_count)`` for every property, 0 where no person belongs to it."""
    counts = person_counts(persons, key)
    j = properties.select("uuid").join(counts, F.col("uuid") == F.col("prop_uuid"), "left")
    return j.select("uuid", F.coalesce("person_count", F.lit(0)).cast("bigint").alias("person_count"))


def _crowded(persons: DataFrame, key: str, chunk_size: int) -> DataFrame:
    """``_hot``: keys of more than ``chunk_size`` persons, at most one for each ``chunk_size`` rows; goes to all tasks."""
    counts = person_counts(persons, key).where(F.col("person_count") > F.lit(chunk_size))
    return F.broadcast(counts.select(F.col("prop_uuid").alias("_hot")))


def _one_chunk(p: DataFrame) -> DataFrame:
    """Rollup of persons whose property needs one chunk: sent once by the property, listed in key order, no key last."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("uuid").isNull().alias("_last"), person_struct().alias("person"))))
    return (p.repartition("prop_uuid").groupBy("prop_uuid")
            .agg(F.count(F.lit(1)).alias("person_count"), listed.alias("_l"))
            .select("prop_uuid", F.lit(0).alias("person_chunk"), F.lit(0).alias("person_offset"),
                    "person_count", F.transform("_l", lambda x: x["person"]).alias("person_details")))


def _many_chunks(p: DataFrame, chunk_size: int) -> DataFrame:
    p = person_index(p, "prop_uuid", "uuid", "_index")
    p = p.withColumn("person_chunk", F.floor((F.col("_index") - 1) / F.lit(chunk_size)).cast("int"))
    # Distribute on (property, chunk) explicitly: grouping would otherwise reuse a partitioning on the
    # property alone and put every chunk of a hot property into one task.
    listed = F.array_sort(F.collect_list(F.struct(F.col("_index"), person_struct().alias("person"))))
    return (p.repartition("prop_uuid", "person_chunk")
            .groupBy("prop_uuid", "person_chunk")
            .agg(F.count(F.lit(1)).alias("person_count"), listed.alias("_l"))
            .select("prop_uuid", "person_chunk", (F.col("person_chunk") * F.lit(chunk_size)).alias("person_offset"),
                    "person_count", F.transform("_l", lambda x: x["person"]).alias("person_details")))


def _rollups(persons: DataFrame, key: str, chunk_size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(crowded keys, rollup of all other keys, rollup of the crowded ones)."""
    k, ok = rollup_key(key)
    hot = _crowded(persons, key, chunk_size)
    p = persons.where(ok).withColumn("prop_uuid", k)
    is_hot = F.col("prop_uuid") == F.col("_hot")
    return hot, _one_chunk(p.join(hot, is_hot, "left_anti")), _many_chunks(p.join(hot, is_hot, "left_semi"), chunk_size)


def persons_rollup(persons: DataFrame, key: str = "prefix", chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """A1 / A2: ``(prop_uuid, person_chunk, person_offset, person_count, person_details array<struct>)``.

    Persons are in key order (no key: last) inside an array and over the chunks;
    ``person_offset`` is the number of persons in earlier chunks.
    """
    _, one, many = _rollups(persons, key, chunk_size)
    return one.unionByName(many)


def nested_dataset(properties: DataFrame, persons: DataFrame, key: str = "prefix",
                   chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Every property, persons as an array (``[]`` when none), plus the image HTML."""
    hot, one, many = _rollups(persons, key, chunk_size)
    empty = F.array().cast(one.schema["person_details"].dataType)
    of = F.col("uuid") == F.col("prop_uuid")
    # The lists of one chunk lie by their property already, so this join moves properties only; it keeps those
    # without persons.  Crowded properties have an inner join of their own: AQE may split their chunk rows.
    defaults = {"person_chunk": F.lit(0), "person_offset": F.lit(0), "person_count": F.lit(0).cast("bigint"), "person_details": empty}
    plain = properties.join(hot, F.col("uuid") == F.col("_hot"), "left_anti").join(one, of, "left")
    plain = plain.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})
    crowded = properties.join(hot, F.col("uuid") == F.col("_hot"), "left_semi").join(many, of, "inner")
    return (plain.unionByName(crowded).drop("prop_uuid")
            .withColumn("building_image_url_html", T.img_html(F.col("building_image_url"))))


def unnest_persons(nested: DataFrame, keep_placeholder: bool = True) -> DataFrame:
    """J4 + U1: one row per array element with its 1-based position.

    With ``keep_placeholder`` a property whose list is NULL or empty keeps one row
    with ``placeholder = true`` and ``person_pos = 1`` (the UNION ALL branch of the
    original, done in the same pass with ``posexplode_outer``).  Positions count on
    over the chunks of a property.
    """
    cols = [c for c in nested.columns if c not in ("person_details", "person_offset")]
    offset = F.col("person_offset") if "person_offset" in nested.columns else F.lit(0)
    fn = F.posexplode_outer if keep_placeholder else F.posexplode
    out = nested.select(*cols, offset.alias("_offset"), fn("person_details").alias("_pos", "person"))
    out = out.withColumn("placeholder", F.col("person").isNull())
    out = out.withColumn("person_pos", F.coalesce(F.col("_offset") + F.col("_pos") + 1, F.lit(1)).cast("int")).drop("_pos", "_offset")
    return out


def person_index(df: DataFrame, group: str, order: str, out: str = "person_index",
                 slice_chars: int = 5, bound: int | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order nulls last)``, skew-safe.

    A slice of a group holds the rows whose ``order`` text agrees in its first
    ``length(group) + slice_chars`` characters.  A prefix never orders against the
    whole text, so slices are numbered on their own and shifted by the sizes of
    the earlier ones; nothing is sampled or kept, and a lost task repeats the same
    numbers.  A group key that starts its order keys (as a property key starts its
    person keys) leaves ``slice_chars`` characters to tell rows apart.  Ties in
    ``order`` are broken arbitrarily, as in any ``row_number``.

    With ``bound``, slices of more rows are cut deeper (:func:`deepen_slices`) until none is left but those of
    equal keys; this runs a count for each round.  Without it nothing runs here.
    """
    cut = F.length(F.coalesce(F.col(group), F.lit(""))) + F.lit(slice_chars)
    sliced = _slice(df.withColumn("_last", F.col(order).isNull()).withColumn("_cut", cut), order)
    if bound is not None:
        sliced = deepen_slices(sliced, group, order, slice_chars, bound)
    by = [group, "_last", "_slice"]
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    sizes = sliced.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(group).orderBy("_last", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"_o{c}") for c in by],
                           F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    same = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in by]
    return (local.join(offsets, same, "inner")
            .withColumn(out, (F.col("_local") + F.col("_offset")).cast("int"))
            .drop(*by[1:], *[f"_o{c}" for c in by], "_cut", "_local", "_offset"))


def _slice(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn("_slice", F.coalesce(F.substr(F.col(order), F.lit(1), F.col("_cut")), F.lit("")))


def deepen_slices(sliced: DataFrame, group: str, order: str, slice_chars: int, bound: int) -> DataFrame:
    """Cut slices of more than ``bound`` rows behind all that their keys share, round by round.

    What the least and the greatest key of a slice share, all its keys share; so a round steps over any common
    text at once and every cut slice falls apart.  Only slices over the bound are joined back to the rows: at
    most one for each ``bound`` rows, written to the shared folder, which also ends their lineage.  A slice stays
    in front of the next one when it is cut, so the order of all slices holds.
    """
    spark = sliced.sparkSession
    base = f"{shared_dir(spark)}/slices-{uuid.uuid4().hex}"
    least, greatest = F.col("_least"), F.col("_greatest")
    places = F.sequence(F.lit(1), F.length(least) + 1)
    shared = F.array_position(F.transform(places, lambda i: F.substr(least, i, F.lit(1)) == F.substr(greatest, i, F.lit(1))), False) - 1
    by, step = [group, "_last", "_slice"], 0
    while True:
        sizes = sliced.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_least"), F.max(order).alias("_greatest"))
        large = sizes.where((F.col("_n") > bound) & (least < greatest))
        large = large.select(*[F.col(c).alias(f"_l{c}") for c in by], (shared + max(1, slice_chars)).cast("int").alias("_deeper"))
        large.write.parquet(f"{base}/{step}")
        large = spark.read.parquet(f"{base}/{step}")
        if large.isEmpty():
            return sliced
        same = [F.col(c).eqNullSafe(F.col(f"_l{c}")) for c in by]
        found = sliced.join(large, same, "left").withColumn("_cut", F.coalesce("_deeper", "_cut"))
        sliced, step = _slice(found.drop("_deeper", *[f"_l{c}" for c in by]), order), step + 1


# Person keys read by the nested-input variant of the unified dataset: it asks for
# these names, which the nested builder does not write, so they come out NULL
# unless a caller maps them to the stored names (pass ``key_map={}``).
NESTED_VARIANT_KEY_MAP = {
    "individual_gender": "gender", "individual_id_type": "id_type", "individual_nin": "nin",
    "individual_drivers_licence": "drivers_license", "individual_passport_number": "passport",
    "individual_residence_permit_number": "residence_permit", "individual_dob": "date_of_birth",
}
_PERSON_INPUTS = [
    "uuid", "occupancy", "person_type", "type", "business_name", "individual_first_name", "individual_last_name",
    "tax_registered", "tin", "mobile_1", "mobile_2", "email", "individual_gender", "individual_id_type",
    "individual_nin", "individual_drivers_licence", "individual_passport_number", "passport_country",
    "individual_residence_permit_number", "residence_permit_country", "individual_dob", "shop_apt_unit_number",
]


def unified_from_nested(nested: DataFrame, as_of=None, key_map: dict[str, str] | None = None,
                        limit: int | None = None) -> DataFrame:
    """The 82-column unified dataset computed from the nested table.

    Differences from the flagship: survey date falls back to the submission date;
    occupancy / person_type count only when stored as JSON objects; person keys
    are looked up through ``key_map``; a property whose list is empty keeps one
    placeholder row (NULL person) that joins the per-property totals with zero
    rent; the building image HTML is a fixed placeholder and there is no
    plus-code image HTML.
    """
    from parcelspark import constants as K
    from parcelspark.operators import unified as U

    as_of = as_of or U.DEFAULT_AS_OF
    key_map = NESTED_VARIANT_KEY_MAP if key_map is None else key_map
    base = nested.where(F.col("person_details").isNotNull())
    stored_keys = set(base.schema["person_details"].dataType.elementType.fieldNames())
    rows = unnest_persons(base, keep_placeholder=True)

    def pick(col):
        k = "UUID" if col == "uuid" else key_map.get(col, col)
        return (F.col("person")[k] if k in stored_keys else F.lit(None).cast("string")).alias(col)

    persons_like = rows.select(F.col("uuid").alias("prop_uuid"), *[pick(c) for c in _PERSON_INPUTS])
    pf = U.person_fields(persons_like, as_of, json_mode="object", keep_placeholders=True)
    totals = U.property_totals(U.person_measures(persons_like, json_mode="object", keep_placeholders=True))
    # one row per property (a property split into chunks has several nested rows); only the property
    # columns are shuffled, never the person arrays
    prop_cols = ["uuid", "building_image_url", "address_plus_code_url", "property_location",
                 "property_description", "end_json", "system_json"]
    props = (U.property_fields(base.select(*prop_cols).dropDuplicates(["uuid"]), as_of, survey_mode="chain")
             .withColumn("building_image_url_html", F.lit(K.NESTED_BUILDING_IMAGE_HTML)))
    return U.assemble(pf, props, totals, NESTED_UNIFIED_COLUMNS, as_of, None, limit)


def _nested_columns():
    from parcelspark.operators.unified import UNIFIED_COLUMNS
    cols = [c for c in UNIFIED_COLUMNS if c not in ("building_image_url_html", "address_plus_code_url_html",
                                                     "property", "value")]
    return cols + ["building_image_url_html", "property", "value"]


NESTED_UNIFIED_COLUMNS = _nested_columns()
