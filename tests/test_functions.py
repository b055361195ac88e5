from pyspark.sql import functions as F

from millrace.functions import columns as fc
from millrace.functions import strings as fs
from millrace.functions.logs import log_fields, log_time
from millrace.ml.features import CENSUS_DEFAULTS, CENSUS_EDGES, CENSUS_LABELS, bin_columns


def values(df):
    return [tuple(r) for r in df.collect()]


def test_bins_at_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 18, 19, 35, 70, 100, 101, -1, None)], "age int")
    out = bin_columns(df, {"age": CENSUS_EDGES["age"]}, CENSUS_LABELS)
    assert [r["age_bin"] for r in out.collect()] == ["0-18", "0-18", "19-35", "19-35", "51-70", "71-100", "Out", "Out", "Out"]


def test_bins_default_label_per_column(spark):
    df = spark.createDataFrame([(7,), (1,)], "own_business_or_self_employed int")
    out = bin_columns(df, {"own_business_or_self_employed": CENSUS_EDGES["own_business_or_self_employed"]}, defaults=CENSUS_DEFAULTS)
    assert [r[1] for r in out.collect()] == ["own_business_or_self_employed", "0-1"]


def test_null_or_empty_default(spark):
    df = spark.createDataFrame([(None,), ("",), ("7.5",), ("x",)], "s string")
    assert values(df.select(fc.null_or_empty_default(F.col("s"), "double"))) == [(0.0,), (0.0,), (7.5,), (None,)]


def test_unit_convert(spark):
    df = spark.createDataFrame([(-148,), (-75,)], "t int")
    assert values(df.select(fc.tenths_celsius_to_fahrenheit(F.col("t")))) == [(5.36,), (18.5,)]


def test_floor_bucket_of_negative(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,)], "x int")
    assert values(df.select(fc.floor_bucket(F.col("x"), 5))) == [(-5,), (0,), (0,), (5,)]


def test_epoch_text_has_12_hour_clock(spark):
    df = spark.createDataFrame([(13 * 3600 + 60,)], "s bigint")
    assert values(df.select(fc.epoch_to_text(F.col("s")))) == [("01-01-1970 01:01",)]


def test_epoch_does_not_depend_on_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-07-01 00:00:00' AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seconds = df.select(fc.epoch_seconds(F.col("t")).alias("s"))
            assert values(seconds) == [(1593561600,)]
            assert values(seconds.select(fc.epoch_to_text(F.col("s")))) == [("01-07-2020 12:00",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tokens_drop_or_keep_empty(spark):
    df = spark.createDataFrame([("a  b ",)], "s string")
    assert values(df.select(fs.tokens(F.col("s")))) == [(["a", "b"],)]
    assert values(df.select(fs.tokens(F.col("s"), keep_empty=True))) == [(["a", "", "b", ""],)]
    assert values(spark.createDataFrame([("it's, ok_1!",)], "s string").select(fs.words(F.col("s")))) == [(["it", "s", "ok_1"],)]


def test_adjacency_line_with_trailing_blank(spark):
    df = spark.createDataFrame([("5 6 7 ",), ("8",), ("x 1",), ("",)], "s string")
    got = values(df.select(fs.adjacency_id(F.col("s")), fs.adjacency_neighbours(F.col("s"))))
    assert got == [(5, [6, 7]), (8, []), (None, [1]), (None, [])]


def test_log_line_and_garbage(spark):
    good = '10.20.30.40 - - [07/Feb/2021:13:14:15 +0000] "GET /index.html HTTP/1.1" 200 55'
    neg = '1.2.3.4 - - [07/Feb/2021:13:14:15 -0500] "GET / HTTP/1.1" 404 7'
    df = spark.createDataFrame([(good,), (neg,), ("garbage",)], "value string")
    parsed = values(df.select(*log_fields(F.col("value"))))
    assert parsed[0] == ("10.20.30.40", "07/Feb/2021:13:14:15 +0000", "GET", "/index.html", "HTTP/1.1", 200, 55)
    assert parsed[1][1] == "07/Feb/2021:13:14:15 -0500"
    assert parsed[2] == ("", "", "", "", "", None, None)
    times = df.select(*log_fields(F.col("value"))).select(F.unix_timestamp(log_time(F.col("timestamp"))))
    assert values(times) == [(1612703655,), (1612721655,), (None,)]


def test_unit_hash_is_uniform_and_stable(spark):
    df = spark.range(20000).select(fc.unit_hash(F.col("id"), salt="a").alias("u"))
    low, mean, high = df.agg(F.min("u"), F.avg("u"), F.max("u")).first()
    assert 0 <= low < 0.01 and abs(mean - 0.5) < 0.02 and 0.99 < high < 1
    again = spark.range(20000).repartition(3).select(fc.unit_hash(F.col("id"), salt="a").alias("u"))
    assert df.exceptAll(again).count() == 0
