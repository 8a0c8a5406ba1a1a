import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martkit.functions import cleanse as cl
from martkit.functions import dates as d
from martkit.functions.spec import Col, conform_layout, project


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_float_text_to_int_truncates_and_nulls(spark):
    assert one(spark, cl.float_text_to_int, ["416.0", "12.9", "-3.7", "abc", "", None, " 7 "]) == \
        [416, 12, -3, None, None, None, 7]


def test_thousands_number_and_int(spark):
    assert one(spark, cl.thousands_number, ["1,234.56", " 2,000 ", "", None, "x1"]) == \
        [Decimal("1234.56"), Decimal("2000.00"), None, None, None]
    assert one(spark, cl.thousands_to_int, ["1,234.99", "12"]) == [1234, 12]
    assert one(spark, cl.thousands_to_id, ["12,345", "7"]) == ["12345", "7"]


def test_float_text_to_id_and_decimal(spark):
    assert one(spark, cl.float_text_to_id, ["1234.0", "None", "12a"]) == ["1234", None, None]
    assert one(spark, cl.float_text_to_decimal, ["3.14159", "x"]) == [Decimal("3.14"), None]


def test_sentinels_and_defaults(spark):
    assert one(spark, lambda c: cl.null_if_token(c, "None", "", "undefined"),
               [" None ", "", "undefined", " ok "]) == [None, None, None, "ok"]
    assert one(spark, cl.default_if_blank, ["  ", None, " a "]) == ["Unknown", "Unknown", "a"]
    assert one(spark, lambda c: cl.clean_text(c, 3), [" abcdef ", "None"]) == ["abc", None]


def test_strip_decimal_suffix(spark):
    assert one(spark, cl.strip_decimal_suffix, ["98104.0", "98104", "None", " 12 "]) == ["98104", "98104", None, "12"]


def test_flags_and_conformance(spark):
    assert one(spark, cl.text_to_flag, ["TRUE", " false ", "", "yes", None]) == [True, False, None, None, None]
    m = {"FT": ["full time", "FULL-TIME", "FullTime"], "PT": ["part time"]}
    assert one(spark, lambda c: cl.conform_code(c, m, default="OT"),
               [" Full Time", "fulltime", "PART TIME", "seasonal", None]) == ["FT", "FT", "PT", "OT", "OT"]
    rules = [("%FULL%", "FT"), ("%PART%", "PT")]
    assert one(spark, lambda c: cl.classify_like(c, rules, "X"), ["Full-time", "part", "temp"]) == ["FT", "PT", "X"]


def test_remainder_ratio_sum(spark):
    df = spark.createDataFrame([(10, 3, 4), (5, 4, 4), (None, 1, 1), (7, None, 2)], "t int, a int, b int")
    out = df.select(cl.clamped_remainder("t", "a", "b").alias("o"), cl.sum_null_zero("a", "b").alias("s")).collect()
    assert [(r.o, r.s) for r in out] == [(3, 7), (0, 8), (None, 2), (5, 2)]
    df2 = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df2.select(cl.guarded_ratio("n", "d")).collect()] == [Decimal("2.5000"), None, None]


def test_row_hash_uses_separator_and_null_marker(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, ""), ("", None)], "a string, b string")
    hashes = [r[0] for r in df.select(cl.row_hash("a", "b")).collect()]
    assert len(set(hashes)) == 4
    assert [r[0] for r in df.select(cl.concat_nullsafe("a", "b")).collect()] == ["abc", "abc", "", ""]


def test_null_safe_differs(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(cl.differs("a", "b")).collect()] == [False, True, False, True]


def test_date_parsing_and_keys(spark):
    vals = ["12/31/2020", "2020-01-05", "1/2/2021", "garbage", None]
    assert one(spark, d.parse_date, vals) == [dt.date(2020, 12, 31), dt.date(2020, 1, 5), dt.date(2021, 1, 2), None, None]
    assert one(spark, d.valid_date, ["1900-01-01", "12/30/1899", "2001-02-03"]) == [None, None, dt.date(2001, 2, 3)]
    assert one(spark, d.safe_time, ["7:05", "23:59:59", "25:00", "x"]) == ["07:05:00", "23:59:59", None, None]
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(d.date_key("d")).collect()] == [20240229, -1]
    assert [r[0] for r in df.select(d.open_ended_key(F.lit(None).cast("int"))).collect()] == [99991231, 99991231]


def test_project_spec_and_layout(spark):
    raw = spark.createDataFrame([(" 12.0 ", " Name ", "1,500", "98104.0", "TRUE", "3/4/2022")],
                                "`Agency Id` string, `Agency Name` string, Pop string, Zip string, Flag string, Day string")
    out = project(raw, [Col("agency_id", "Agency Id", "float_id"), Col("name", "Agency Name", "text", length=3),
                        Col("pop", "Pop", "number_int"), Col("zip", "Zip", "code"), Col("flag", "Flag", "flag"),
                        Col("day", "Day", "us_date"), Col("src", kind="literal", value="x")]).first()
    assert tuple(out) == ("12", "Nam", 1500, "98104", True, dt.date(2022, 3, 4), "x")
    lay = spark.createDataFrame([("1", "a")], "` 5 Digit NTD ID ` string, `Agency Name  ` string")
    conf = conform_layout(lay, {"5 Digit NTD ID": "ntd_id", "Agency Name": "agency_name"}, ["ntd_id", "agency_name", "mode"])
    assert conf.columns == ["ntd_id", "agency_name", "mode"] and tuple(conf.first()) == ("1", "a", None)
