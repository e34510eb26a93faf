"""The training-data pipeline: five stages, each on what the one before kept.

``run(spark, sf_dir)`` reads ``documents`` and applies STAGES in order; every stage's
rows are written to the shared folder in ``spark.checkpoint.dir`` and read again.
All stages but the last return the columns of ``documents``:

1. toxicity: documents that the classifier rejects go.
2. near duplicates: of the rows joined by links of five-word shingles with a Jaccard
   similarity of 0.8 or more, the one with the least id stays, and of several of that
   id the one whose text has the least SHA-256, then the one whose other columns do.  Rows without words
   are linked with nothing and stay.
3. substring dedup: words in a 13-word passage that an earlier document holds go; a
   text without such words keeps its bytes.
4. decontamination: documents with benchmark passages in a twentieth of their words go.
5. packing: what is left, as pieces in sequences of 2048 tokens.

Null and empty texts stay as they are until packing, where they are one end token.
Rows without an id are kept by every filter that compares documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import decontaminate, jaccard_join, packing, substring_dedup, toxicity
from parcelspark.llm._blocks import checkpoint_dir
from parcelspark.llm.queries import tokenizer_file


BLOCK_BYTES = 4 << 20  # of text in one task of the stages that compare documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    mark = f"score_{uuid.uuid4().hex}"  # cannot clash with a column of docs
    return toxicity.score(docs, model, score_col=mark).where(F.col(mark) < 0.5).drop(mark)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows get numbers of their own in a written copy, so that no two rows are taken for one whatever their ids
    row, path = f"row_{uuid.uuid4().hex}", f"{checkpoint_dir(spark)}/rows-{uuid.uuid4().hex}"
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    named = rows.where(F.col("doc_id").isNotNull())
    found = jaccard_join.jaccard_components(named.select(F.col(row).alias("doc_id"), "text"), shingle=5, percent=80, block_bytes=BLOCK_BYTES)
    groups = found.select(F.col("doc_id").alias(row), F.col("component_id").alias("g"))
    several = groups.where(F.col(row) != F.col("g")).select("g").distinct()
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    order = F.struct(F.col("doc_id"), F.sha2("text", 256).alias("h"), whole.alias("rest"), F.col(row))
    members = named.select(row, order.alias("o")).join(groups.join(several, "g", "left_semi"), row)
    first = members.groupBy("g").agg(F.min("o").alias("m"))
    gone = members.join(first, "g").where(F.col(row) != F.col(f"m.{row}")).select(row)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parsed = substring_dedup.substring_dedup(docs, carry=True, keep_text=True, block_bytes=BLOCK_BYTES)
    cut = F.col("n_removed") > 0
    fields = {c: F.col("row")[c] for c in docs.columns if c != "text"}
    fields["text"] = F.when(cut, F.col("text")).otherwise(F.col("original"))
    if "n_chars" in fields:
        fields["n_chars"] = F.when(cut, F.length("text")).otherwise(fields["n_chars"])
    return parsed.select(*[fields[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"), carry=True)
    clean = found.where(~F.col("contaminated"))
    return clean.select(*[(F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# The classifier, the tokenizer and the plan of bins are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
