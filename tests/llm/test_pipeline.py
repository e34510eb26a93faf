"""The pipeline's stages on a small corpus, each against its own rule, and the registered queries on the smallest tables."""

from __future__ import annotations

import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from parcelspark.llm.queries import QUERIES, SQL
from tests.llm.test_search_spelling_runs import _brute_top, brute_counts
from tests.llm.test_text_operators import brute_contamination, brute_jaccard, brute_substrings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, docs, corpus, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    texts = dict(corpus)
    docs.drop("block", "bucket").write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame([(0, " ".join(texts[20].split()[:15]))], "item_id long, text string").write.parquet(f"file://{folder}/benchmark.parquet")
    toxic = [(i, 1, 1 if 30 <= i < 33 else 0) for i in range(60)]
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(f"file://{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, tables)
        assert out.columns == columns
        rows = out.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        pairs = list(before.items())
        if name == "toxicity":
            assert set(after.items()) <= set(before.items())
        if name == "near_duplicates":
            assert after == {i: t for i, t in pairs if brute_jaccard(pairs, 5, 80)[i][1] == i}
        if name == "substring_dedup":
            want = brute_substrings(pairs)
            assert after == {i: want[i][2] if want[i][1] else t for i, t in pairs}
            assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] and after[r["doc_id"]] != before[r["doc_id"]])
        if name == "decontamination":
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
            assert after == {i: t for i, t in pairs if not brute_contamination(pairs, bench)[i][3]}
        docs, before = spark.createDataFrame(rows, out.schema), after
    packed = corpus_pipeline.STAGES[4][1](spark, docs, tables)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(before)


def test_run_and_clashing_columns(spark, tables, docs):
    assert corpus_pipeline.run(spark, tables).count() > 0
    for _, stage in corpus_pipeline.STAGES[:4]:  # extra columns named like the operators' own
        assert stage(spark, docs, tables).columns == docs.columns


def test_smallest_tables_keep_clean_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).select("doc_id").collect()}
    clean = {r["doc_id"] for r in docs.select("doc_id").collect() if toxic.get(r["doc_id"]) == 0}
    assert clean and clean <= kept and not kept & {i for i, t in toxic.items() if t and zlib.crc32(str(i).encode()) % 5}
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_near_duplicates_of_repeated_ids(spark, tables):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "en"), (1, b, "en"), (2, f"{a} more", "en"), (2, "", "en"), (2, None, "en"), (3, c, "fr"), (3, c, "de"), (4, c, "en"), (None, a, "en"), (None, a, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, tables).collect()]
    assert sorted(kept, key=str) == sorted([(1, a, "en"), (1, b, "en"), (2, "", "en"), (2, None, "en"), (3, c, "de"), (None, a, "en"), (None, a, "en")], key=str)


def test_stages_on_nothing(spark, tables, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_cover_their_table(spark, name):
    table = "embeddings" if name.startswith(("op10", "op11")) else "documents"
    out = QUERIES[name](spark, SF)
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    if name.startswith("op11"):  # five rows for each query
        n = len(_brute_top([tuple(r) for r in rows.select("vec_id", "embedding").collect()]))
    elif name.startswith("op12"):  # one row for each word
        n = len(brute_counts([tuple(r) for r in rows.select("doc_id", "text").collect()], 97))
    else:
        n = rows.count()
    assert out.count() >= n if name.startswith("op8") else out.count() == n


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in re.findall(r"\b(documents|labels|benchmark|embeddings)\b", SQL[name]):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(SQL[name])
    cols = [c[0] for c in want.description]
    key = lambda r: str(r)
    assert sorted((tuple(r[c] for c in cols) for r in QUERIES[name](spark, SF).collect()), key=key) == sorted(want.fetchall(), key=key)
