from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions import casts
from statloom.functions.dates import day, month_bucket, round_half_up
from statloom.operators import columns
from statloom.schemas import GAMES, PLAYERS


def frame(spark, kind, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, kind)]))


def values(df):
    return [row[0] for row in df.collect()]


def test_date_is_a_date(spark):
    df = spark.createDataFrame([("1999-12-31", 1), ("31.12.1999", 2)], ["d", "v"])
    out = columns.parse_date(df, "d", GAMES.date_format)
    assert out.schema["d"].dataType == T.DateType()
    assert values(out) == [date(1999, 12, 31), None]


def test_stamp_is_a_date(spark):
    out = columns.stamp(spark.range(2), "2001-02-03")
    assert out.schema["ingestion_date"].dataType == T.DateType()
    assert {r["ingestion_date"] for r in out.collect()} == {date(2001, 2, 3)}


def test_stamp_refuses_a_bad_run_date(spark):
    with pytest.raises(ValueError):
        columns.stamp(spark.range(1), "13 April")


def test_names_become_lower_case(spark):
    out = columns.lowercase_columns(spark.createDataFrame([(1, 2, 3)], ["KEY", "Value", "x_Y"]))
    assert out.columns == ["key", "value", "x_y"]


TEXT_TO_INT = [
    ("12", 12), (" 7 ", 7), ("\t7\n", 7), ("12.7", 12), ("-12.7", -12), ("+5", 5), ("12.", 12),
    (".5", 0), ("007", 7), ("abc", None), ("", None), ("  ", None), (".", 0), ("-", None),
    ("1e3", None), ("3000000000", None), ("-2147483648", -2147483648), ("2147483648", None),
    ("1 2", None), ("1.2.3", None), (None, None),
]


def test_text_to_int(spark):
    df = frame(spark, T.StringType(), [t for t, _ in TEXT_TO_INT])
    out = columns.cast_int(df, ["v"])
    assert out.schema["v"].dataType == T.IntegerType()
    assert list(zip([t for t, _ in TEXT_TO_INT], values(out))) == TEXT_TO_INT


DOUBLE_TO_INT = [
    (12.7, 12), (-12.7, -12), (0.0, 0), (float("nan"), 0), (3e9, 2147483647), (-3e9, -2147483648),
    (float("inf"), 2147483647), (float("-inf"), -2147483648), (None, None), (2147483647.0, 2147483647),
]


@pytest.mark.parametrize("kind", [T.DoubleType(), T.FloatType()])
def test_floating_to_int(spark, kind):
    out = columns.cast_int(frame(spark, kind, [d for d, _ in DOUBLE_TO_INT]), ["v"])
    assert out.schema["v"].dataType == T.IntegerType()
    assert values(out) == [i for _, i in DOUBLE_TO_INT]


def test_long_to_int_keeps_low_bits(spark):
    out = columns.cast_int(frame(spark, T.LongType(), [5, -5, 3_000_000_000, 2**40 + 9, None]), ["v"])
    assert values(out) == [5, -5, 3_000_000_000 - 2**32, 9, None]


def test_double_to_bigint(spark):
    df = frame(spark, T.DoubleType(), [1.9, -1.9, float("nan"), 1e30, -1e30, None])
    out = df.select(casts.to_integral("v", T.DoubleType(), "bigint").alias("v"))
    assert out.schema["v"].dataType == T.LongType()
    assert values(out) == [1, -1, 0, 2**63 - 1, -(2**63), None]


def test_casts_agree_with_lenient_cast(spark):
    """Where ANSI mode is off, Spark's plain cast is the behaviour to match."""
    texts = frame(spark, T.StringType(), [t for t, _ in TEXT_TO_INT])
    doubles = frame(spark, T.DoubleType(), [d for d, _ in DOUBLE_TO_INT])
    ours = values(columns.cast_int(texts, ["v"])), values(columns.cast_int(doubles, ["v"]))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lenient = tuple(values(df.select(F.col("v").cast("int"))) for df in (texts, doubles))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == lenient


def test_cast_float(spark):
    out = columns.cast_float(frame(spark, T.StringType(), ["0.456", "abc", "", None, "NaN"]), ["v"])
    assert out.schema["v"].dataType == T.FloatType()
    got = values(out)
    assert got[0] == pytest.approx(0.456, abs=1e-7) and got[1:4] == [None] * 3 and got[4] != got[4]


def test_float_is_kept_when_widened(spark):
    df = columns.widen(columns.cast_float(frame(spark, T.DoubleType(), [0.456]), ["v"]))
    assert df.schema["v"].dataType == T.DoubleType()
    assert values(df) == [0.4560000002384186]


def test_widen_leaves_other_types(spark):
    df = spark.sql("select 1 as i, 2L as l, cast(1.5 as float) as f, 'x' as s, date'2025-01-01' as d")
    assert [f.dataType.simpleString() for f in columns.widen(df).schema] == [
        "bigint", "bigint", "double", "string", "date"]


MONTH_NAMES = [
    ("APR 13, 2025", date(2025, 4, 13)), ("Apr 13, 2025", date(2025, 4, 13)),
    ("APR 3, 2025", None), ("bad", None), ("", None), (None, None), ("FEB 30, 2025", None),
]
ISO_DATES = [
    ("2025-04-13", date(2025, 4, 13)), ("2025-4-3", None), ("2025-04-13T00:00:00", None),
    ("bad", None), ("", None), (None, None), ("2025-02-30", None),
]


@pytest.mark.parametrize("fmt, cases", [(PLAYERS.date_format, MONTH_NAMES),
                                        (GAMES.date_format, ISO_DATES)])
def test_date_formats(spark, fmt, cases):
    df = frame(spark, T.StringType(), [t for t, _ in cases])
    assert values(columns.parse_date(df, "v", fmt)) == [d for _, d in cases]


def test_project_drops_extra_and_requires_all(spark):
    contract = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    df = spark.createDataFrame([("x", 1, 2)], ["a", "b", "c"])
    assert columns.project(df, contract).columns == ["b", "a"]
    with pytest.raises(AnalysisException):
        columns.project(df.drop("a"), contract)


def test_conform_brings_contract_types(spark):
    contract = T.StructType([T.StructField("n", T.LongType()), T.StructField("r", T.DoubleType()),
                             T.StructField("t", T.StringType())])
    df = spark.sql("select 'x' as t, cast(2.5 as float) as r, 10.7D as n")
    out = columns.conform(df, contract)
    assert out.schema.simpleString() == "struct<n:bigint,r:double,t:string>"
    assert out.first() == (10, 2.5, "x")


def test_fill_missing_fills_every_column(spark):
    df = spark.createDataFrame(
        [(None, None, float("nan"), None), (1, "x", 2.5, 3)],
        "i long, s string, d double, k int")
    assert [tuple(r) for r in columns.fill_missing(df).collect()] == [
        (0, "0", 0.0, 0), (1, "x", 2.5, 3)]


def test_columns_match_without_case(spark):
    df = spark.createDataFrame([(1, "2025-01-15")], ["Player_ID", "GAME_DATE"])
    out = columns.cast_int(columns.parse_date(df, "game_date", GAMES.date_format), ["PLAYER_ID"])
    assert len(out.columns) == 2
    assert out.filter(F.col("player_id").isNotNull()).count() == 1


def test_rounding_and_months(spark):
    df = spark.sql("select explode(array(0.25D, -0.25D, 25.35D, 27.04D)) as v")
    assert values(df.select(round_half_up(F.col("v")))) == [0.3, -0.3, 25.4, 27.0]
    got = spark.range(1).select(month_bucket(day("2025-04-13")).alias("m"),
                                day(date(2025, 1, 2)).alias("d")).first()
    assert got == (date(2025, 4, 1), date(2025, 1, 2))


def test_contracts():
    assert len(GAMES.contract) == 29 and len(PLAYERS.contract) == 28
    assert {f.dataType.simpleString() for f in GAMES.contract} == {
        "string", "bigint", "double", "date"}
    assert "player_name" in PLAYERS.contract.names
