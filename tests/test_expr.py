"""Scalar case tables (FIXTURES.md §5)."""
import datetime as dt

from pyspark.sql import functions as F

from contactlake.functions.expr import (clean_text, email_ok, int_text_ok, json_value,
                                        parse_int, parse_ts, round_half_up, sunday_week)


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_email_cases(spark):
    ok = ["a@b.com", "A@B.COM", "test1@example.com", "user!#$%@company.com"]
    bad = ["invalidabc.com", "invalid-email", "user@", "user@domain", "user name@company.com",
           "", "a..b@c.com", ".a@c.com", "a@-b.com"]
    for e in ok:
        assert one(spark, email_ok, e) is True, e
    for e in bad:
        assert one(spark, email_ok, e) is False, e
    assert one(spark, email_ok, None) is False


def test_timestamp_cases(spark):
    utc = dt.datetime(2024, 1, 15, 10, 30)
    assert one(spark, parse_ts, "2024-01-15T10:30:00Z") == utc
    assert one(spark, parse_ts, "2024-01-15T10:30:00.123456Z") == utc.replace(microsecond=123456)
    assert one(spark, parse_ts, "2024-01-15T10:30:00 +0000") == utc
    assert one(spark, parse_ts, "2024-01-15T12:30:00+02:00") == utc
    for v in ["", "2024-01-15", "15/01/2024", "2024/01/15 10:30", "invalid",
              "2024-01-15T10:30:00Z +0000", None]:
        assert one(spark, parse_ts, v) is None, v


def test_integer_cases(spark):
    cases = {"12": 12, " 12 ": 12, "+5": 5, "-5": -5, "1_000": 1000, "": None}
    for text, want in cases.items():
        assert one(spark, parse_int, text) == want, text
        assert one(spark, int_text_ok, text) is True
    for text in ["12.5", "abc", "1__0"]:
        assert one(spark, int_text_ok, text) is False, text


def test_json_value_cases(spark):
    doc = '{"a":null,"b":{"c":1},"d":"x","e":true,"f":[1]}'
    got = {k: one(spark, lambda c, k=k: json_value(c, k), doc) for k in "abdef"}
    assert got == {"a": None, "b": None, "d": "x", "e": "true", "f": None}
    assert one(spark, lambda c: json_value(c, "zz"), doc) is None
    assert one(spark, lambda c: json_value(c, "a"), "{not json") is None
    # API-shaped records nest fields under properties
    assert one(spark, lambda c: json_value(c, "email"), '{"properties":{"email":"q@w.com"}}') == "q@w.com"


def test_sunday_week(spark):
    assert one(spark, sunday_week, dt.datetime(2024, 6, 9, 10), "timestamp") == dt.date(2024, 6, 9)
    assert one(spark, sunday_week, dt.datetime(2024, 6, 8, 0), "timestamp") == dt.date(2024, 6, 2)


def test_round_half_up_and_trim(spark):
    assert one(spark, lambda c: round_half_up(c, 2), 1.005, "double") == 1.01
    assert one(spark, lambda c: round_half_up(c, 2), 2.675, "double") == 2.68
    assert one(spark, clean_text, "  x \t") == "x"
    assert one(spark, clean_text, "   ") is None


def test_scale_conf_sizes_shuffle_by_input(spark):
    from contactlake.session import MIB, input_size, scale_conf
    assert scale_conf(10 * MIB)["spark.sql.shuffle.partitions"] == "200"          # floor
    assert scale_conf(100 << 30)["spark.sql.shuffle.partitions"] == "800"         # 128 MiB each
    assert scale_conf(100 << 40)["spark.sql.shuffle.partitions"] == "819200"      # 128 MiB each
    assert scale_conf(1)["spark.sql.autoBroadcastJoinThreshold"] == str(64 * MIB)
    assert input_size(spark, "/root/testdata/sf0.001/orders.parquet") > 0


def test_unicode_trim(spark):
    from contactlake.functions.expr import clean_text
    rows = [("\u00a0 a b\u3000\t",), ("\u200ba",), ("  ",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string")
           .select(clean_text("s")).collect()]
    assert got == ["a b", "\u200ba", None, None]      # zero width space is not white space
