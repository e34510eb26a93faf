"""Files chosen by their boxes, slices cut to a bound, records at the mark once."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelspark.operators import layout as LY
from parcelspark.operators import nested as N
from parcelspark.streaming import incremental as SI


def _wide(spark, n=60_000):
    i = F.col("id")
    return spark.range(n).select(
        F.format_string("uuid:%06d", (i / 3).cast("long")).alias("uuid"), F.format_string("uuid:%06d_%d", (i / 3).cast("long"), i % 3).alias("person_uuid"),
        F.format_string("house %d", F.xxhash64(i) % 5000).alias("property_name"), F.format_string("town %d", F.pmod(F.xxhash64(i, F.lit(1)), F.lit(25))).alias("town"),
        F.format_string("district %d", F.pmod(F.xxhash64(i, F.lit(1)), F.lit(25)) % 5).alias("district"),
        F.when(i % 50 > 0, (F.pmod(F.xxhash64(i, F.lit(2)), F.lit(21)) * 5).cast("int")).alias("data_quality_score"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), F.pmod(F.xxhash64(i, F.lit(3)), F.lit(365)).cast("int")).alias("survey_date"),
        F.lit(None).cast("timestamp_ntz").alias("submission_date"))


def test_lookups_open_few_files(spark, scratch):
    wide, path = _wide(spark), f"{scratch}/wide"
    LY.write_boxes(wide, path)
    files = len(spark.read.parquet(path).inputFiles())
    assert files > 100
    for wanted in ({"town": ("town 7", "town 7")}, {"data_quality_score": (55, 55)}, {"survey_date": (dt.date(2023, 5, 5), dt.date(2023, 5, 5))},
                   {"town": ("town 3", "town 3"), "data_quality_score": (80, None)}):
        got, want = LY.lookup(spark, path, wanted), wide
        for c, (low, high) in wanted.items():
            want = want.where(F.col(c) >= F.lit(low)) if low is not None else want
            want = want.where(F.col(c) <= F.lit(high)) if high is not None else want
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) != []
        assert len(LY.choose_files(spark, path, wanted)) <= files / 5, wanted
    assert LY.lookup(spark, path, {"town": ("zz", "zz")}).count() == 0
    assert LY.lookup(spark, path, {"uuid": ("uuid:000777", "uuid:000777")}).count() == 3
    LY.write_boxes(wide.limit(0), f"{scratch}/none")
    assert LY.lookup(spark, f"{scratch}/none", {"town": ("town 7", None)}).count() == 0


def test_slices_of_keys_that_share_much_are_cut_to_the_bound(spark):
    far = "x" * 30
    rows = [("g", f"g{far}{i:05d}") for i in range(900)] + [("g", f"g{far}")] + [("g", f"h{i}") for i in range(50)] + [("k", f"k{far}{'y' * 40}{i}") for i in range(300)]
    rows += [("g", None), ("g", f"g{far}00007"), ("e", "e"), (None, "a1"), (None, "a2")] + [("s", "same")] * 40
    df = spark.createDataFrame(rows, "grp string, key string").repartition(5)
    got = N.person_index(df, "grp", "key", out="i", bound=20)
    want = df.withColumn("i", F.row_number().over(Window.partitionBy("grp").orderBy(F.col("key").asc_nulls_last())))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    start = N._slice(df.withColumn("_last", F.col("key").isNull()).withColumn("_cut", F.length(F.coalesce("grp", F.lit(""))) + 5), "key")
    size = lambda d: d.groupBy("grp", "_last", "_slice").agg(F.count("*").alias("n"), F.countDistinct("key").alias("k")).where("k > 1").agg(F.max("n")).first()[0]
    assert size(start) == 902 and (size(N.deepen_slices(start, "grp", "key", 5, 20)) or 0) <= 20


def test_records_at_the_mark_are_applied_once(spark, scratch):
    schema = "uuid string, submitted_date timestamp_ntz, logo string"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    feeds = [[("a", t(1), "1"), ("b", t(2), "1")], [("b", t(2), "1"), ("late", t(2), "1")], [("c", t(3), "1")], [("c", t(3), "1"), ("late2", t(3), "1")],
             [("late2", t(3), "1"), ("c", t(3), "1")], [("b", t(4), "2")], [("b", t(4), "2"), ("late3", t(4), "1"), ("old", t(0), "1")]]
    for files in (1, 3, 7):
        landing = f"{scratch}/land-{files}"
        for n in range(files):  # the same feeds in fewer files
            rows = [r for f in feeds[n * 7 // files:(n + 1) * 7 // files] for r in f]
            SI.land_json(spark.createDataFrame(rows, schema), landing, partitions=1)
        seen = []
        stream = SI.once_from_mark(SI.feed_stream(spark, landing, schema, 1), ["uuid"], t(1))
        q = (stream.writeStream.foreachBatch(lambda df, b: seen.append(sorted(map(tuple, df.collect()))))
             .option("checkpointLocation", f"{scratch}/ckpt-{files}").trigger(availableNow=True).start())
        q.awaitTermination()
        got = sorted(r for batch in seen for r in batch)
        assert got == sorted({r for f in feeds for r in f if r[1] >= t(1)}), files
        assert sum(1 for batch in seen if batch) >= min(files, 3)


def test_write_boxes_makes_its_rows_once(spark, scratch):
    """Quantiles, ranges and boxes read the written rows; the table itself is computed a single time."""
    from pyspark.sql import functions as F

    from parcelspark.operators import layout as LY
    made = spark.sparkContext.accumulator(0)

    def town(i):
        made.add(1)
        return f"T{i % 5}"

    rows = spark.range(200).select(F.col("id").cast("string").alias("uuid"), F.udf(town, "string")("id").alias("town"))
    LY.write_boxes(rows, f"{scratch}/boxes", bits={"town": 2}, keys=("uuid",))
    assert made.value == 200
    assert LY.lookup(spark, f"{scratch}/boxes", {"town": ("T3", "T3")}).count() == 40
