"""The wide table laid out for all nine access paths, and a reader that opens only the files it needs.

Columns that many rows share (town, score, dates, district) are ordered together: each value becomes its rank
among quantiles, the bits of the ranks are interleaved, and files are ranges of that number, so that a file covers
a small box of all these columns at once.  Columns that tell rows apart (the keys and the property name) get
Parquet bloom filters, by which the scan skips row groups; rows inside a file lie in key order.

Next to the table stands one row for each file with the least and greatest value of each column.  A lookup reads
that table first and opens the files whose box it meets; a NULL is never looked up, so boxes leave it out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import sinks as SK

# Bits of the ranks: a point lookup on a column with b bits meets about one file in 2 ** b.
BITS = {"town": 3, "data_quality_score": 3, "survey_date": 3}
BOXED = ("uuid", "person_uuid", "property_name", "town", "district", "data_quality_score", "survey_date", "submission_date")
KEYED = ("uuid", "person_uuid", "property_name")
SAMPLE_ROWS = 20_000


def quantile_cuts(df: DataFrame, bits: dict[str, int], sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> dict[str, list]:
    """For each column at most ``2 ** bits - 1`` values that cut its rows into equal shares (of a bounded sample)."""
    total = df.count()
    share = min(1.0, sample_rows / max(1, total))
    rows = df.select(*bits).sample(False, share, seed).limit(2 * sample_rows).collect()
    cuts = {}
    for c, b in bits.items():
        found = sorted(r[c] for r in rows if r[c] is not None)
        at = sorted({i * len(found) // (1 << b) for i in range(1, 1 << b)}) if found else []
        cuts[c] = sorted({found[i] for i in at if found[i] != found[0]})
    return cuts


def box_number(cuts: dict[str, list], bits: dict[str, int]) -> Column:
    """The interleaved bits of the columns' ranks, the highest bit of each column first."""
    ranks = {c: reduce(lambda a, b: a + b, [F.coalesce((F.col(c) >= F.lit(v)).cast("int"), F.lit(0)) for v in vs], F.lit(0)) for c, vs in cuts.items()}
    out = F.lit(0).cast("long")
    for level in range(max(bits.values())):
        for c, b in bits.items():
            if level < b:
                bit = F.shiftright(ranks[c], b - 1 - level).bitwiseAND(F.lit(1))
                out = F.shiftleft(out, 1).bitwiseOR(bit.cast("long"))
    return out


def write_boxes(df: DataFrame, path: str, bits: dict[str, int] | None = None, keys: tuple[str, ...] = ("uuid", "person_uuid"),
                most_rows: int = 5_000_000) -> None:
    """Write the table and its table of files (``<path>_files``).

    A file holds whole boxes, neighbours in their order, so that no file straddles what a lookup tells apart; a box
    of more than ``most_rows`` rows is several files.  Larger tables ask for more bits.

    The rows are made once, in ``<path>_rows``: the quantiles, the ranges and the boxes all read them from there."""
    spark, bits = df.sparkSession, bits or BITS
    df.write.mode("overwrite").parquet(f"{path}_rows")
    df = spark.read.schema(df.schema).parquet(f"{path}_rows")
    box = box_number(quantile_cuts(df, bits), bits)
    laid = df.withColumn("_box", box).repartitionByRange(1 << sum(bits.values()), "_box").sortWithinPartitions("_box", *keys).drop("_box")
    writer = laid.write.mode("overwrite").option("maxRecordsPerFile", most_rows)
    for c in KEYED:
        if c in df.columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    boxed = [c for c in BOXED if c in df.columns]
    least = [x for c in boxed for x in (F.min(c).alias(f"{c}_least"), F.max(c).alias(f"{c}_greatest"))]
    table = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *least)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}_files")


def choose_files(spark: SparkSession, path: str, wanted: dict[str, tuple]) -> list[str]:
    """Files that can hold rows with every ``column`` between its two bounds (each may be None: open)."""
    table = spark.read.parquet(f"{path}_files")
    for c, (low, high) in wanted.items():
        if low is not None:
            table = table.where(F.col(f"{c}_greatest") >= F.lit(low))
        if high is not None:
            table = table.where(F.col(f"{c}_least") <= F.lit(high))
    return sorted(f"{path}/{r['file']}" for r in table.select("file").collect())


def lookup(spark: SparkSession, path: str, wanted: dict[str, tuple]) -> DataFrame:
    """The rows with every column between its bounds, from the files that can hold them."""
    if not SK.exists(spark, f"{path}_files"):
        raise ValueError(f"{path} has no table of files")
    files = choose_files(spark, path, wanted)
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in wanted.items():
        if low is not None:
            rows = rows.where(F.col(c) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(c) <= F.lit(high))
    return rows
