from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.cleaning import (
    blank_to_null,
    concat_key,
    equals_padded,
    isnull_default,
    nan_to_null,
    pad_left,
    rtrim_text,
)
from tidemark.functions.dates import (
    as_timestamp,
    format_twelve_hour,
    parse_oracle_date,
    text_to_date,
    unparsed,
    validity_window,
)
from tidemark.functions.decoding import decode, decode_like, decode_lookup, decode_rank
from tidemark.functions.hashing import hash_to_string, row_hash, sha1_null_marked, sha1_null_skipped, zone_free


def one(df):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.collect()]


def texts(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, t string").coalesce(1)


class TestHashes:
    def test_boundaries_and_nulls_count(self, spark):
        df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x"), ("x", None), ("", "x"), ("NA", "x")], "a string, b string")
        for algo in ("sha256", "sha1", "md5", "xxhash64"):
            assert len(set(one(df.select(row_hash("a", "b", algo=algo))))) == 6

    def test_bare_concatenation_confuses_boundaries(self, spark):
        df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
        assert len(set(one(df.select(sha1_null_marked("a", "b"))))) == 1
        assert one(df.select(sha1_null_skipped("a", "b")))[0] == hashlib.sha1(b"abc").hexdigest()

    def test_null_marks(self, spark):
        df = spark.createDataFrame([(None, "c")], "a string, b string")
        assert one(df.select(sha1_null_marked("a", "b"))) == [hashlib.sha1(b"NAc").hexdigest()]
        assert one(df.select(sha1_null_skipped("a", "b"))) == [hashlib.sha1(b"c").hexdigest()]

    def test_order_of_columns_matters(self, spark):
        df = spark.createDataFrame([("a", "b")], "a string, b string")
        assert one(df.select(row_hash("a", "b"))) != one(df.select(row_hash("b", "a")))

    def test_unknown_algorithm(self):
        with pytest.raises(ValueError):
            row_hash("a", algo="crc")

    def test_binary_hash_as_text(self, spark):
        df = spark.createDataFrame([(bytearray(b"\x00\xab"),), (None,)], "HASH_VALUE binary")
        assert one(hash_to_string(df)) == ["00ab", None]
        text = df.select(F.lit("x").alias("HASH_VALUE"))
        assert hash_to_string(text) is text


class TestCleaning:
    def test_isnull_default_by_type(self, spark):
        df = spark.range(1).select(
            isnull_default(F.lit(None).cast("string")).alias("s"),
            isnull_default(F.lit(None).cast("int"), "int").alias("i"),
            isnull_default(F.lit(None).cast("date"), "date").alias("d"),
            isnull_default(F.lit(None).cast("timestamp_ntz"), "timestamp_ntz").alias("t"),
            isnull_default(F.lit(5), "int").alias("k"),
        )
        assert one(df) == [("", 0, dt.date(1900, 1, 1), dt.datetime(1900, 1, 1), 5)]
        with pytest.raises(ValueError):
            isnull_default(F.lit(1), "binary")

    def test_padded_text(self, spark):
        df = texts(spark, ["a  ", "  ", "", None, " a"]).select(
            rtrim_text(F.col("t")), blank_to_null(F.col("t")), equals_padded(F.col("t"), "a ")
        )
        assert one(df) == [("a", "a  ", True), ("", None, False), ("", None, False), (None, None, False), (" a", " a", False)]

    def test_nan_to_null_touches_floating_columns_only(self, spark):
        df = spark.createDataFrame(
            [(float("nan"), "NaN", 1, float("nan")), (1.5, None, None, 2.0)], "a double, b string, c int, `d.e` float"
        )
        assert one(nan_to_null(df)) == [(None, "NaN", 1, None), (1.5, None, None, 2.0)]
        assert nan_to_null(df).columns == df.columns

    def test_concat_key(self, spark):
        df = spark.createDataFrame([(7,), (None,)], "n int").coalesce(1)
        assert one(df.select(concat_key("TP_", F.col("n")))) == ["TP_7", None]


class TestDates:
    TEXTS = {
        "04-MAR-2019 02:05:06": dt.datetime(2019, 3, 4, 2, 5, 6),
        "04-Mar-19 12:05:06": dt.datetime(2019, 3, 4, 0, 5, 6),
        "04-MAR-75 11:00:00": dt.datetime(1975, 3, 4, 11),
        "4-mar-49 1:2:3": dt.datetime(2049, 3, 4, 1, 2, 3),
        "04-MAR-50": dt.datetime(1950, 3, 4),
        " 04-MAR-2019  02:05:06 ": dt.datetime(2019, 3, 4, 2, 5, 6),
        "29-FEB-2000 12:59:59": dt.datetime(2000, 2, 29, 0, 59, 59),
        "29-FEB-1900 12:59:59": None,
        "31-FEB-2019 01:00:00": None,
        "04-MAR-2019 13:00:00": None,
        "04-MAR-2019 00:00:00": None,
        "04-MAR-2019 02:60:06": None,
        "04-MAR-2019 02:05:60": None,
        "04-MAR-2019 02:05:06 PM": None,
        "04-MAR-2019 02:05:06Z": None,
        "04-XYZ-2019": None,
        "04-MAR-201": None,
        "2019-03-04": None,
        "2019-MAR-4": None,
        "2019m03m4": None,
        "junk": None,
        "": None,
        None: None,
    }

    def test_parse(self, spark):
        df = texts(spark, list(self.TEXTS)).select(parse_oracle_date(F.col("t")))
        assert one(df) == list(self.TEXTS.values())

    def test_year_fifty_rule_in_second_half_of_the_century(self, spark):
        df = texts(spark, ["01-JAN-49", "01-JAN-50"]).select(F.year(parse_oracle_date(F.col("t"), current_year=2055)))
        assert one(df) == [2149, 2050]

    @pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
    def test_no_session_zone_in_results(self, spark, zone):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = texts(spark, ["10-MAR-2019 02:30:00"])  # this hour does not exist in New York
            parsed = parse_oracle_date(F.col("t"))
            row = df.select(parsed.cast("string"), format_twelve_hour(parsed)).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert tuple(row) == ("2019-03-10 02:30:00", "2019-03-10 02:30:00")

    def test_strict(self, spark):
        good = texts(spark, ["04-MAR-2019", None]).select(parse_oracle_date(F.col("t"), strict=True))
        assert one(good) == [dt.datetime(2019, 3, 4), None]
        with pytest.raises(PySparkException, match="not a date"):
            texts(spark, ["junk"]).select(parse_oracle_date(F.col("t"), strict=True)).collect()

    def test_bad_texts_are_counted(self, spark):
        df = texts(spark, ["04-MAR-2019", "junk", "", None])
        assert one(df.agg(unparsed(F.col("t"), parse_oracle_date(F.col("t"))))) == [2]

    def test_twelve_hour_format(self, spark):
        times = ["2019-03-04 00:05:06", "2019-03-04 12:05:06", "2019-03-04 13:05:06.789", "2019-03-04 11:00:00"]
        df = texts(spark, times).select(format_twelve_hour(F.col("t").cast("timestamp_ntz")))
        assert one(df) == ["2019-03-04 12:05:06", "2019-03-04 12:05:06", "2019-03-04 01:05:06", "2019-03-04 11:00:00"]

    def test_validity_keeps_time_and_clamps_to_month_end(self, spark):
        start, end = validity_window(as_timestamp("2019-10-31 14:05:06"))
        assert one(spark.range(1).select(start, end)) == [
            (dt.datetime(2019, 10, 30, 14, 5, 6), dt.datetime(2028, 2, 29, 14, 5, 6))
        ]

    def test_text_to_date(self, spark):
        forms = ["2019-03-04  ", "20190304", "4 Mar 2019", "Mar  4 2019 12:00AM", "2019-03-04 01:02:03.000"]
        df = texts(spark, [*forms, "   ", "soon", None, "2019-02-30", "2019"]).select(text_to_date(F.col("t")))
        assert one(df) == [dt.date(2019, 3, 4)] * 5 + [dt.date(1900, 1, 1), None, None, None, None]

    def test_dates_written_out(self, spark):
        forms = ["04-MARCH-2019 02:03:04", "04/MAR/2019 02:03:04", "4.March.2019 02:03:04", "04-MARZ-2019", "04-MARCHING-2019"]
        df = texts(spark, forms).select(parse_oracle_date(F.col("t")))
        assert one(df) == [dt.datetime(2019, 3, 4, 2, 3, 4)] * 3 + [None, None]

    def test_row_hash_does_not_depend_on_the_zone(self, spark):
        found = set()
        for zone in ("UTC", "Europe/London", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.range(1).select(F.timestamp_seconds(F.lit(1000000000)).alias("at"), F.lit("x").alias("t"))
            found.add(zone_free(df).select(row_hash("at", "t")).first()[0])
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert len(found) == 1

    def test_longer_text_is_not_cut(self, spark):
        assert one(texts(spark, ["7", "123456789012"]).select(pad_left(F.col("t"), 9, "0"))) == ["000000007", "123456789012"]

    def test_lookup_with_repeated_values(self, spark):
        lookup = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "v string, c string")
        df = texts(spark, ["a", "b", "z"]).withColumn("value", F.lit("mine")).withColumn("_code", F.lit("kept"))
        found = decode_lookup(df, lookup, "v", "c", "code", on="t", default="0").collect()
        assert sorted((r["t"], r["value"], r["_code"], r["code"]) for r in found) == [
            ("a", "mine", "kept", "1"), ("b", "mine", "kept", "2"), ("z", "mine", "kept", "0")]
        clash = spark.createDataFrame([("a", "1"), ("a", "2")], "v string, c string")
        with pytest.raises(Exception, match="two codes"):
            decode_lookup(df, clash, "v", "c", "code", on="t", default="0").collect()


class TestDecoding:
    def test_decode(self, spark):
        df = texts(spark, ["a", "b ", None, "c"]).select(decode(F.col("t"), {"a": "1", "b": "2"}, "0"))
        assert one(df) == ["1", "0", "0", "0"]
        df = texts(spark, ["a", "b ", None, "c"]).select(decode(F.col("t"), {"a": "1", "b": "2"}, "0", padded=True))
        assert one(df) == ["1", "2", "0", "0"]

    def test_decode_like(self, spark):
        df = texts(spark, ["On Hold", "Held", None, "On Hold  "]).select(
            decode_like(F.col("t"), {"On Hold": "1", "H%": "2"}, "0")
        )
        assert one(df) == ["1", "2", "0", "1"]

    def test_decode_rank_of_text_and_number(self, spark):
        df = texts(spark, ["1", "2", "0", "x", "", None, "10"])
        assert one(df.select(decode_rank(F.col("t"), "001", "002", "000"))) == ["001", "002", "000", "000", "000", "000", "002"]
        numbers = spark.createDataFrame([(1,), (3,), (0,)], "n int").coalesce(1)
        assert one(numbers.select(decode_rank(F.col("n"), "001", "002", "000"))) == ["001", "002", "000"]

    def test_lookup_with_default(self, spark):
        lookup = spark.createDataFrame([("a", "1"), ("b", None)], "v string, c string")
        df = decode_lookup(texts(spark, ["a", "b", "z", None]), lookup, "v", "c", "code", on="t", default="0")
        assert df.columns == ["i", "t", "code"]
        assert [r["code"] for r in df.orderBy("i").collect()] == ["1", "0", "0", "0"]
