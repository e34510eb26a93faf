"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import decontaminate, embedding_dedup, jaccard_join, licences, lm, packing, periodic_runs, spelling, substring_dedup, suffix_dedup, token_files, topk_search, toxicity
from parcelspark.llm._blocks import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(m: int):
    return F.crc32(F.col("doc_id").cast("string")) % m


def tokenizer_file(name: str) -> str:
    """Where the box keeps a public tokenizer; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, folder)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def _jaccard_sql() -> str:
    """Equal sets are one class; classes that share a shingle are counted against each other, and links followed."""
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])) END AS s FROM words),
classed AS (SELECT doc_id, len(s) AS n, s, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS class_id FROM sets),
classes AS (SELECT class_id, n, s FROM classed WHERE doc_id = class_id AND n > 0),
holds AS (SELECT class_id, n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.class_id AS x, b.class_id AS y FROM holds a JOIN holds b USING (g) WHERE a.class_id <> b.class_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.class_id, b.class_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT class_id, class_id AS r FROM classes UNION SELECT reach.class_id, y FROM reach JOIN links ON x = r),
least_of AS (SELECT class_id, min(r) AS component_id FROM reach GROUP BY class_id)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id, class_id FROM classed LEFT JOIN least_of USING (class_id)"""


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(licences.document_files(_table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")


def _licence_sql() -> str:
    """The same scan for DuckDB, every part against every template of its kind, without the prefilter."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    low = lambda c: f"translate({c}, '{licences.UPPER}', '{licences.LOWER}')"
    both = [(k, n, t) for k, ts in enumerate((licences.TEMPLATES, licences.FULL_TEXTS)) for n, t in licences.flat(ts)]
    names = ", ".join(f"({i}, {k}, {quote(n)}, {quote(' '.join(licences.words_of(t)))})" for i, (k, n, t) in enumerate(both))
    return f"""
WITH files AS (
  SELECT doc_id, text, opens, array_to_string([coalesce(source, 'unknown'), coalesce(lang, 'unknown'), coalesce(CAST(doc_id // 1000 AS VARCHAR), 'unknown')][1:CASE WHEN opens THEN doc_id % 3 + 1 ELSE 3 END], '/') AS dir,
    CASE WHEN opens THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END AS name
  FROM (SELECT *, coalesce(regexp_matches(split_part(text, chr(10), 1), {quote(licences.OPENING)}), false) AS opens FROM documents)),
known AS (SELECT * FROM (VALUES {names}) v(i, kind, n, t)),
tw AS (SELECT i, w, count(*) AS tf FROM (SELECT i, unnest(string_split(t, ' ')) AS w FROM known) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM documents),
df AS (SELECT w, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all({low("text")}, '[a-z0-9]+'))) AS w FROM documents) WHERE w IN (SELECT w FROM tw) GROUP BY w),
idf AS (SELECT DISTINCT tw.w, ln((1 + total.n) / (1 + coalesce(df.df, 0))) + 1 AS idf FROM tw LEFT JOIN df USING (w), total),
tv AS (SELECT i, w, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY i)) AS y FROM tw JOIN idf USING (w)),
bare AS (SELECT doc_id, opens, {low("text")} AS text, regexp_replace({low("text")}, {quote(licences.MARKER)}, '\\1', 'g') AS bare FROM files WHERE text IS NOT NULL),
parts AS (
  SELECT doc_id, 0 AS kind, unnest(list_concat(string_split(text, chr(10)), string_split_regex(bare, {quote(licences.SENTENCE)}))) AS text FROM bare
  UNION SELECT doc_id, 1, unnest(list_concat(string_split_regex(bare, {quote(licences.PARAGRAPH)}), CASE WHEN opens THEN [bare] ELSE [] END)) FROM bare),
numbered AS (SELECT *, row_number() OVER () AS part FROM parts),
terms AS (SELECT part, w, count(*) AS tf FROM (SELECT part, unnest(regexp_extract_all(text, '[a-z0-9]+')) AS w FROM numbered) GROUP BY ALL),
lv AS (SELECT part, w, tf * coalesce(idf.idf, ln(1 + total.n) + 1) AS x FROM terms LEFT JOIN idf USING (w), total),
norms AS (SELECT part, sum(x * x) AS norm FROM lv GROUP BY ALL),
dots AS (SELECT part, i, sum(x * y) AS dot FROM lv JOIN tv USING (w) GROUP BY ALL),
scores AS (SELECT doc_id, n, round(dot / sqrt(norm), 6) AS score FROM dots JOIN norms USING (part) JOIN numbered USING (part) JOIN known USING (i) WHERE known.kind = numbered.kind),
own AS (SELECT doc_id, n AS licence, score FROM scores WHERE score >= {licences.THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, n DESC) = 1),
placed AS (SELECT files.*, dir || '/' || name AS path, own.licence, own.score FROM files LEFT JOIN own USING (doc_id)),
cover AS (SELECT dir AS up, licence AS dl, score AS ds, path AS dp FROM placed WHERE licence IS NOT NULL AND regexp_matches(name, '{licences.LICENCE_FILE}') QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, licence) = 1),
near AS (SELECT d.dir, dl, ds, dp FROM (SELECT DISTINCT dir FROM placed) d JOIN cover ON d.dir = cover.up OR starts_with(d.dir, cover.up || '/') QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(cover.up) DESC) = 1)
SELECT doc_id, path, coalesce(licence, dl) AS licence, CASE WHEN licence IS NOT NULL THEN score ELSE ds END AS score,
  CASE WHEN licence IS NOT NULL THEN 'header' WHEN dl IS NOT NULL THEN 'directory' END AS origin, CASE WHEN licence IS NOT NULL THEN path ELSE dp END AS from_path
FROM placed LEFT JOIN near USING (dir)"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _substring_sql() -> str:
    """Windows as joined words; the smallest document of each decides."""
    return """
WITH words AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
hit AS (SELECT DISTINCT doc_id, i + k AS i, true AS gone FROM later, range(13) r(k)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone IS NULL) AS text
  FROM each LEFT JOIN hit USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM words LEFT JOIN kept USING (doc_id)"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def _decontaminate_sql() -> str:
    """Windows of the items, of every length that occurs, looked up among the documents' windows."""
    return f"""
WITH words AS (
  SELECT kind, id, coalesce(regexp_extract_all(translate(text, '{licences.UPPER}', '{licences.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM (SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark)),
lengths AS (SELECT DISTINCT least(len(w), {decontaminate.WINDOW}) AS k FROM words WHERE kind = 'b' AND len(w) > 0),
wanted AS (
  SELECT DISTINCT id AS item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT id, w, least(len(w), {decontaminate.WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)),
held AS (SELECT id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths WHERE kind = 'd')),
found AS (SELECT held.id, i, k, item FROM held JOIN wanted USING (k, g)),
hits AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS p FROM found) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT CAST(id AS BIGINT) AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM words LEFT JOIN hits USING (id) LEFT JOIN named USING (id) WHERE kind = 'd'"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", F.coalesce(_remainder(7) != 2, F.lit(True)))
    scored = lm.score_texts(docs, "train")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(_table(spark, sf_dir, "embeddings"))


def _embedding_sql() -> str:
    """Every pair of one label compared, links followed."""
    return """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE for x in embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
unit AS (SELECT vec_id, label, [x / sqrt(list_inner_product(e, e)) for x in e] AS e FROM v WHERE list_inner_product(e, e) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM unit a JOIN unit b USING (label) WHERE a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) >= 0.98),
degree AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT vec_id, y FROM reach JOIN links ON x = r),
least_of AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM least_of LEFT JOIN degree USING (vec_id)"""


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def _topk_sql() -> str:
    return """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER w <= 5"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(_table(spark, sf_dir, "documents"), drop_one_in=97)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def _spelling_sql() -> str:
    """CRC-32 byte by byte from its table; near words by joins on the text without one character."""
    return f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, {spelling.CRC_POLYNOMIAL}) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
step AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
found AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{licences.UPPER}', '{licences.LOWER}') AS w FROM documents),
runs AS (SELECT id, w, count(*) AS m FROM found GROUP BY ALL),
bytes AS (
  SELECT id, w, m, flatten([CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195, unicode(ch)::BIGINT - 64] END for ch in string_split(id || ':' || w, '')]) AS b FROM runs),
crc AS (SELECT w, m, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) AS h FROM bytes, step),
typed AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, m FROM crc),
v AS (SELECT word, sum(m)::BIGINT AS n FROM typed WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(m) >= {spelling.MIN_COUNT}),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM spots),
shorter AS (SELECT DISTINCT c.word AS long, c.n AS long_n, v.word AS short, v.n AS short_n FROM cut c JOIN v ON v.word = c.a || c.b),
near AS (
  SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT long, short, short_n FROM shorter UNION ALL SELECT short, long, long_n FROM shorter),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {spelling.RATIO} * v.n THEN form END AS form, CASE WHEN form_n >= {spelling.RATIO} * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS last FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL),
roots AS (SELECT chain.word, chain.last AS root FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def _with_repeats():
    """The text of ``documents`` with the periods that the contract plants into a tenth of the rows."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    g = F.floor(_remainder(1 << 32) / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")).otherwise(F.col("text"))
    return F.when(_remainder(10) == 0, planted).otherwise(F.col("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), text=_with_repeats())
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_licence_scan": op3_licence_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_topk_search": op11_topk_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op2_jaccard_join": _jaccard_sql(),
    "op3_licence_scan": _licence_sql(),
    "op4_substring_dedup": _substring_sql(),
    "op5_decontaminate": _decontaminate_sql(),
    "op10_embedding_dedup": _embedding_sql(),
    "op11_topk_search": _topk_sql(),
    "op12_spelling_variants": _spelling_sql(),
}
