"""Integrity, audit and profiling operators (one aggregation pass each where possible)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.operators.unified import prop_key

# FIXED VALUES: match classes and integrity verdicts.
MATCH_TYPES = ("DIRECT_MATCH", "PREFIX_MATCH", "NO_MATCH")
VERDICTS = ("EMPTY_MAIN", "EMPTY_PERSONS", "NO_MATCHING_PROPERTIES", "NO_MATCHING_PERSONS", "OK")


def assert_composite_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows violating a (composite) primary key: duplicated key or NULL part.

    Returns ``(keys..., violation, occurrences)``; empty when the key holds.
    """
    null_any = None
    for k in keys:
        c = F.col(k).isNull()
        null_any = c if null_any is None else (null_any | c)
    dups = (df.where(~null_any).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1).withColumn("violation", F.lit("duplicate")))
    nulls = (df.where(null_any).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
             .withColumn("violation", F.lit("null_key")))
    return dups.unionByName(nulls).select(*keys, "violation", "occurrences")


def _audited(agg: DataFrame) -> DataFrame:
    ratio = F.when(F.col("total_records") > 0,
                   F.round(F.col("populated_person_details") * 100.0 / F.col("total_records"), 1).cast("decimal(5,1)"))
    return agg.withColumn("populated_pct", ratio).withColumn(
        "verdict", F.when((F.col("null_person_details") == 0) & (F.col("populated_person_details") > 0), "PASS")
        .otherwise("FAIL"))


def _per_property(nested: DataFrame) -> DataFrame:
    """One row per property of a stored nested table: its first chunk (a chunk is never empty beside others)."""
    return nested.where(F.col("person_chunk") == 0) if "person_chunk" in nested.columns else nested


def nested_audit(nested: DataFrame, col: str = "person_details") -> DataFrame:
    """A3/A4/A5 over a stored nested table: conditional counts per property and the populated ratio."""
    a = F.col(col)
    return _audited(_per_property(nested).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(a.isNotNull()).alias("with_person_details"),
        F.count_if(a.isNull()).alias("null_person_details"),
        F.count_if(F.size(a) == 0).alias("empty_person_details"),
        F.count_if(F.size(a) > 0).alias("populated_person_details"),
    ))


def counts_audit(counts: DataFrame) -> DataFrame:
    """A3/A4/A5 from ``(uuid, person_count)`` (see ``nested.property_counts``): the same row without building a list."""
    n = F.col("person_count")
    return _audited(counts.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(n.isNotNull()).alias("with_person_details"),
        F.count_if(n.isNull()).alias("null_person_details"),
        F.count_if(n == 0).alias("empty_person_details"),
        F.count_if(n > 0).alias("populated_person_details"),
    ))


def top_properties_by_persons(counts: DataFrame, n: int = 3) -> DataFrame:
    """L2: top-n properties by persons (ties by UUID) from a nested table or ``(uuid, person_count)``; a top-N, no sort."""
    sized = counts.where(F.col("person_count") > 0).groupBy("uuid").agg(
        F.sum("person_count").cast("int").alias("person_count"))
    return sized.orderBy(F.col("person_count").desc(), F.col("uuid").asc()).limit(n)


def row_counts(**tables: DataFrame) -> DataFrame:
    """``(table, row_count)`` for each named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fk_integrity(properties: DataFrame, persons: DataFrame, fk: str = "submissions_id") -> DataFrame:
    """J12 + A20: counts of the FK relation and the first problem found.

    One row: main/person totals, properties with persons, persons with a property,
    named persons, verdict and a warning when no person carries a name.
    """
    named = F.count_if(F.col("individual_first_name").isNotNull() | F.col("business_name").isNotNull())
    per_key = persons.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), named.alias("_named"))
    # one pass over each side: counts per key, and whether a property has the key
    keys = properties.groupBy(F.col("uuid").alias("_p")).agg(F.count(F.lit(1)).alias("_m"))
    j = keys.join(per_key, F.col("_p") == F.col("_k"), "full_outer")
    both = F.col("_p").isNotNull() & F.col("_k").isNotNull()
    zero = F.lit(0).cast("bigint")
    out = j.agg(F.coalesce(F.sum("_m"), zero).alias("main_count"), F.coalesce(F.sum("_n"), zero).alias("person_count"),
                F.coalesce(F.sum("_named"), zero).alias("named_persons"),
                F.count_if(both).alias("matching_properties"),
                F.coalesce(F.sum(F.when(both, F.col("_n") * F.col("_m"))), zero).alias("matching_persons"))
    verdict = (F.when(F.col("main_count") == 0, VERDICTS[0])
               .when(F.col("person_count") == 0, VERDICTS[1])
               .when(F.col("matching_properties") == 0, VERDICTS[2])
               .when(F.col("matching_persons") == 0, VERDICTS[3])
               .otherwise(VERDICTS[4]))
    return out.withColumn("verdict", verdict).withColumn(
        "warning", F.when((F.col("verdict") == "OK") & (F.col("named_persons") == 0), "NO_NAMED_PERSONS"))


def _by_length(persons: DataFrame, keys: DataFrame, text: str) -> DataFrame:
    """Each person row once for each length ``_n`` of ``text`` among the keys, as far as its own key is that long.

    The lengths (at most the key width) are a scalar subquery of the plan; nothing runs here.  Keys are spread over
    all shuffle partitions first: a compact file is few splits, and each of its rows becomes many."""
    lengths = keys.agg(F.collect_set(F.length(text))).scalar()
    tasks = int(persons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (persons.repartition(tasks, "person_uuid").withColumn("_n", F.explode(lengths))
            .where(F.col("_n") <= F.length("person_uuid")))


SLICES = 16  # of the persons that share a head
STRETCHES = 4  # literal stretches of a layout that are compared by equality; keys with more are left to LIKE
CELL_KEYS = 500_000  # keys of one head that a task holds; heads with more are dealt to several


def _wildcard_matches(persons: DataFrame, wild: DataFrame) -> DataFrame:
    """Pairs where ``person key LIKE property key || '%'`` for keys that hold ``_`` or ``%`` and no backslash.

    A key's layout says which places before its first ``%`` are literal and how long the first literal run behind
    it is.  A person row meets the distinct layouts of the heads it starts with, takes the texts they ask for out of
    its own key, and meets the property keys of equal layout and text in an equi-join.  LIKE is left to keys that
    ask for more than that (a second run, ``_`` behind a ``%``, or more than ``STRETCHES`` literal stretches).

    What is sent is a person row once for each head, and each key once for each slice of the persons of its head.
    Both lie in cells (head, slice) then, and layouts, texts and pairs are made where they lie: a person has many
    more of these than heads.  The keys of a cell are held in memory, the persons pass by.
    """
    key, lay, person = F.col("main_uuid"), F.col("_lay"), F.col("person_uuid")
    tasks = int(persons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = F.hash("_head", "_slice", "_part").alias("_cell")
    number = lambda n: F.explode(F.sequence(F.lit(0), n - F.lit(1)))
    # few heads can have so many keys
    many = wild.groupBy("_head").agg(F.ceil(F.count(F.lit(1)) / CELL_KEYS).cast("int").alias("_parts")).where(F.col("_parts") > 1)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = wild.join(F.broadcast(many), "_head", "left").withColumn("_part", F.pmod(F.hash(key), parts)).withColumn("_slice", number(F.lit(SLICES)))
    dealt = dealt.select(key, F.length("_head").alias("_n"), cell).repartitionById(tasks, F.col("_cell"))
    heads = _by_length(persons, wild, "_head").withColumn("_head", F.substr(person, F.lit(1), F.col("_n")))
    heads = heads.join(F.broadcast(many), "_head", "left").withColumn("_part", number(parts)).withColumn("_slice", F.pmod(F.hash(person), F.lit(SLICES)))
    heads = heads.select(*persons.columns, "_n", cell).repartitionById(tasks, F.col("_cell"))

    front = F.substring_index(key, "%", 1)
    rest = F.substr(key, F.length(front) + 2)
    run = F.when(key.contains("%"), F.regexp_extract(rest, r"[^_%]+", 0))
    compared = F.regexp_extract(front, rf"(?s)^(?:_*[^_]+){{0,{STRETCHES}}}", 0)
    asked = [F.regexp_replace(front, r"(?s)[^_]", "x").alias("_lay"), F.coalesce(F.length(run), F.lit(0)).alias("_run")]
    keys = dealt.select(
        key, "_cell", *asked, F.concat(F.replace(compared, F.lit("_"), F.lit("")), F.coalesce(run, F.lit(""))).alias("_text"),
        (F.coalesce(F.replace(rest, F.lit("%"), F.lit("")) != run, F.lit(False))
         | F.substr(front, F.length(compared) + 1).rlike("[^_]")).alias("_more"))
    # literal places of a layout as (first, number) of each stretch
    at = lambda i: F.substr(lay, i, F.lit(1))
    places = F.when(F.length(lay) > 0, F.sequence(F.lit(1), F.length(lay))).otherwise(F.array().cast("array<int>"))
    first = F.filter(places, lambda i: (at(i) == "x") & ((i == 1) | (at(i - 1) != "x")))
    last = F.filter(places, lambda i: (at(i) == "x") & (at(i + 1) != "x"))
    layouts = dealt.select("_n", "_cell", *asked).distinct().withColumn(
        "_literal", F.zip_with(first, last, lambda a, b: F.struct(a.alias("a"), (b - a + 1).alias("n"))))
    literal = [F.get("_literal", F.lit(i)) for i in range(STRETCHES)]
    layouts = layouts.select("_n", "_cell", "_lay", "_run", F.length("_lay").alias("_long"),
                             *[x for i, r in enumerate(literal) for x in (r["a"].alias(f"_a{i}"), F.coalesce(r["n"], F.lit(0)).alias(f"_n{i}"))])
    stretch = [F.when(F.col(f"_n{i}") > 0, F.substr(person, F.col(f"_a{i}"), F.col(f"_n{i}"))).otherwise(F.lit("")) for i in range(STRETCHES)]
    heads = heads.withColumn("_size", F.length(person))

    def paired(where, found, *placed):
        """Pairs of the keys with the given run; ``found`` is its text in the person key."""
        met = heads.join(layouts.where(where).hint("shuffle_hash"), ["_cell", "_n"]).where(F.col("_size") >= F.col("_long"))
        for p in placed:
            met = p(met)
        met = met.select(*persons.columns, F.concat(*stretch, found).alias("_text"), "_lay", "_run", "_cell")
        pairs = met.join(keys.where(where).hint("shuffle_hash"), ["_text", "_lay", "_run", "_cell"])
        return pairs.where(~F.col("_more") | F.expr("person_uuid LIKE concat(main_uuid, '%')")).select(*persons.columns, key)

    # the first run behind the front can begin at several places; a text that comes twice counts at its first one
    last_place = F.col("_size") - F.col("_run") + 1
    text = F.substr(person, F.col("_place"), F.col("_run"))
    at_places = (lambda met: met.where(last_place > F.col("_long")).withColumn("_place", F.explode(F.sequence(F.col("_long") + 1, last_place))).withColumn("_found", text),
                 lambda met: met.where(F.expr("locate(_found, person_uuid, _long + 1)") == F.col("_place")))
    return paired(F.col("_run") == 0, F.lit("")).unionByName(paired(F.col("_run") > 0, F.col("_found"), *at_places))


def match_type_join(properties: DataFrame, persons: DataFrame) -> DataFrame:
    """All (property, person) pairs where ``person key LIKE property key || '%'`` (DIRECT_MATCH) or the
    person key's text before the first ``_`` equals the property key (PREFIX_MATCH).

    The original is a cross join with an OR.  Here it is equi-joins.  A key without wildcards meets the prefixes of
    the person keys: each person row is expanded to the lengths that occur among those keys (distinct lengths are
    bounded by the key width).  Keys with wildcards go by their layouts (:func:`_wildcard_matches`).  Keys with a
    backslash meet the prefixes by their part before the first wildcard and are tested with LIKE as PostgreSQL reads
    it (a backslash takes the next character literally).
    """
    pers = persons.where(F.col("uuid").isNotNull()).select(
        F.col("uuid").alias("person_uuid"), "individual_first_name", "business_name")
    key = F.col("main_uuid")
    props = properties.select(F.col("uuid").alias("main_uuid")).where(key.isNotNull())
    props = props.withColumn("_head", F.regexp_extract(key, r"^[^_%\\]*", 0))

    def by_head(keys):
        heads = _by_length(pers, keys, "_head").withColumn("_head", F.substr("person_uuid", F.lit(1), F.col("_n"))).drop("_n")
        return heads.join(keys.hint("merge"), "_head").drop("_head")

    escaped = key.contains("\\")
    plain = by_head(props.where(key == F.col("_head")))
    wild = _wildcard_matches(pers, props.where((key != F.col("_head")) & ~escaped))
    # Spark's LIKE takes a backslash only before a wildcard or another one
    pattern = F.concat(F.regexp_replace(key, r"(\\[_%\\])|\\(.)", "$1$2"), F.lit("%"))
    odd = props.where(escaped).withColumn("_like", pattern)
    like = F.expr("person_uuid LIKE _like")
    direct = plain.unionByName(wild).unionByName(by_head(odd).where(like).drop("_like"))
    # LIKE misses an equal prefix only where the key has a backslash
    same = pers.withColumn("main_uuid", prop_key(F.col("person_uuid"))).join(odd, "main_uuid")
    by_key = same.where(~like).drop("_head", "_like")
    return direct.withColumn("match_type", F.lit(MATCH_TYPES[0])).unionByName(by_key.withColumn("match_type", F.lit(MATCH_TYPES[1])))


END = 3  # characters at either end of a key
END_CLASSES = 1 << 16  # of these ends; what is known of each class goes to all tasks


def _end_class(text: Column) -> Column:
    return F.pmod(F.hash(text), F.lit(END_CLASSES))


def containing_pairs(properties: DataFrame, persons: DataFrame) -> DataFrame:
    """All (property, person) pairs where the person key contains the property key, at any place.

    An equi-join of the property keys with the substrings of each person key that have a length which occurs among
    property keys, each at its first place only: a pair comes out once however often the key occurs.

    The substrings are not sent.  Of the first and last characters of a property key, the ones that more keys have
    stand for it (its end); a person row is sent once for each place at which it holds such an end, and a key once for
    each slice of the persons.  Both lie in cells (end, slice) then, where the substrings that begin or stop at the
    place meet the keys.  Ends are told apart by their class only, and the lengths of the keys of each class go to all
    tasks: there are at most ``END_CLASSES`` of them for either end.
    """
    key, person = F.col("main_uuid"), F.col("person_uuid")
    tasks = int(persons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = F.hash("_class", "_slice").alias("_cell")
    props = properties.select(F.col("uuid").alias("main_uuid")).where(key.isNotNull())
    pers = persons.select(F.col("uuid").alias("person_uuid")).where(person.isNotNull())

    first, last = _end_class(F.substr(key, F.lit(1), F.lit(END))), _end_class(F.when(F.length(key) > END, F.substring(key, -END, END)).otherwise(key))
    ends = props.select(F.length(key).alias("_n"), first.alias("_first"), last.alias("_last"))
    common = ends.select(F.explode(F.array("_first", "_last")).alias("_class")).groupBy("_class").count()
    stands = lambda df: (
        df.join(F.broadcast(common.select(F.col("_class").alias("_first"), F.col("count").alias("_firsts"))), "_first")
        .join(F.broadcast(common.select(F.col("_class").alias("_last"), F.col("count").alias("_lasts"))), "_last")
        .withColumn("_at_end", F.col("_lasts") > F.col("_firsts")).withColumn("_class", F.when(F.col("_at_end"), F.col("_last")).otherwise(F.col("_first"))))
    known = stands(ends).groupBy("_class", "_at_end", F.least("_n", F.lit(END)).alias("_e")).agg(F.collect_set("_n").alias("_lengths"))

    places = F.sequence(F.lit(1), F.length(person) - F.col("_n") + 1)
    held = _by_length(pers, props.select(F.substr(key, F.lit(1), F.lit(END)).alias("_end")), "_end").withColumn("_place", F.explode(places))
    held = held.where((F.col("_n") > 0) | (F.col("_place") == 1))  # an empty key lies at the first place
    held = held.withColumn("_class", _end_class(F.substr(person, F.col("_place"), F.col("_n")))).withColumnRenamed("_n", "_e")
    held = held.join(F.broadcast(known.select("_class", "_e").distinct()), ["_class", "_e"], "left_semi")
    held = held.withColumn("_slice", F.pmod(F.hash(person), F.lit(SLICES))).select(person, "_class", "_e", "_place", cell).repartitionById(tasks, F.col("_cell"))
    # what begins at the place, or stops where the end that lies there stops
    parts = held.join(F.broadcast(known), ["_class", "_e"]).withColumn("_n", F.explode("_lengths"))
    parts = parts.withColumn("_from", F.when(F.col("_at_end"), F.col("_place") + F.col("_e") - F.col("_n")).otherwise(F.col("_place")))
    parts = parts.where((F.col("_from") >= 1) & (F.col("_from") + F.col("_n") <= F.length(person) + 1))
    parts = parts.withColumn("main_uuid", F.substr(person, F.col("_from"), F.col("_n")))
    found = parts.where(F.expr("instr(person_uuid, main_uuid)") == F.col("_from")).select(person, key, "_at_end", "_cell")

    dealt = stands(props.select(key, first.alias("_first"), last.alias("_last"))).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    dealt = dealt.select(key, "_at_end", cell).repartitionById(tasks, F.col("_cell"))
    return found.join(dealt.hint("merge"), ["main_uuid", "_at_end", "_cell"]).select(key, person)


def last_underscore_prefix_pairs(properties: DataFrame, persons: DataFrame) -> DataFrame:
    """The second attempt of the profile: pairs where the person key minus its last ``_...`` part equals a property key."""
    pers = persons.where(F.col("uuid").contains("_")).select(
        F.col("uuid").alias("person_uuid"),
        F.regexp_replace("uuid", r"_[^_]*$", "").alias("main_uuid"))
    return pers.join(properties.select(F.col("uuid").alias("main_uuid")), "main_uuid", "inner").withColumn(
        "contains", F.col("person_uuid").contains(F.col("main_uuid")))


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """``n`` rows in a deterministic order (top-N; the limit is the feature)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def column_types(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Declared type of the key columns (from the schema; no data is read)."""
    spark = df.sparkSession
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields
            if columns is None or f.name in columns]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def share_of_total(df: DataFrame, count_col: str, by: list[str], out: str = "pct") -> DataFrame:
    """``count * 100 / sum(count) over (by)`` -- on an already aggregated (small) table."""
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return df.withColumn(out, F.round(F.col(count_col) * 100.0 / F.sum(count_col).over(w), 1).cast("decimal(5,1)"))
