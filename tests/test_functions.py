import datetime

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import dates, hangul, numeric, text


def one(spark, column, *values):
    schema = ", ".join(f"v{i} {'string' if v is None or isinstance(v, str) else 'double'}" for i, v in enumerate(values))
    return spark.createDataFrame([values], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected", [("2021/9/4", 202194), ("2021/09/04", 20210904), ("2000/1/4", 200014), ("2021-09-04", None), ("2021/09", None), (None, None)]
)
def test_slash_date_to_int(spark, value, expected):
    assert one(spark, dates.slash_date_to_int(F.col("v0")), value) == expected


@pytest.mark.parametrize("value, expected", [("2021.09.24.", "2021/09/24"), ("2021.09.24", "2021/09/24"), ("a.b.c.d.e", "a/b/cde"), ("a.b", "a/b"), ("ab", "ab")])
def test_dotted_to_slash(spark, value, expected):
    assert one(spark, dates.dotted_to_slash(F.col("v0")), value) == expected
    assert value.replace(".", "/", 2).replace(".", "") == expected


@pytest.mark.parametrize("value, expected", [("2021/9/4", datetime.date(2021, 9, 4)), ("2021/09/14", datetime.date(2021, 9, 14)), ("x", None)])
def test_slash_to_date(spark, value, expected):
    assert one(spark, dates.slash_to_date(F.col("v0")), value) == expected


def test_text_cleaning(spark):
    assert one(spark, text.keep_text_characters(F.col("v0")), "삼성!a.B 1@ㅋ") == "삼성a.B 1ㅋ"
    assert one(spark, text.strip_illegal_control(F.col("v0")), "a\x01b\tc\x0bd\ne\x1f") == "ab\tcd\ne"
    assert one(spark, text.collapse_space(F.col("v0")), "　a \xa0\n b\x1c\x85c  ") == "a b c"
    assert one(spark, text.strip_editor_markers(F.col("v0")), "SUB_TITLE_STARTxSUB_TITLE_ENDy") == "xy"
    assert one(spark, text.title_and_body(F.col("v0"), F.col("v1")), "t", "b") == "t b"
    assert one(spark, text.title_and_body(F.col("v0"), F.col("v1")), "t", None) is None


def test_words(spark):
    assert one(spark, text.split_words(F.col("v0")), "a  b ") == ["a", "", "b", ""]
    assert one(spark, text.spaced_tokens(F.col("v0")), " a\n\tb 　c ") == ["a", "b", "c"]
    assert one(spark, text.spaced_tokens(F.col("v0")), "  ") == []
    assert one(spark, text.word_tokens(F.col("v0")), "Éa b x_1-가나, 9z.q") == ["éa", "x_1", "가나", "9z"]


@pytest.mark.parametrize("value, initial, group", [("삼성", "ㅅ", "ㅅ"), ("가", "ㄱ", "ㄱ"), ("힣", "ㅎ", "ㅎ"), ("KBS", None, "ABC"), ("", None, "ABC")])
def test_initial_consonant(spark, value, initial, group):
    assert one(spark, hangul.initial_consonant(F.col("v0")), value) == initial
    assert one(spark, hangul.index_group(F.col("v0")), value) == group


def test_numeric(spark):
    assert one(spark, numeric.rescale(F.col("v0")), 3e12) == 3.0
    assert one(spark, numeric.log10_rounded(F.col("v0")), 0.001) == -3.0
    assert one(spark, numeric.percent(F.col("v0"), F.col("v1")), 35.0, 159.0) == 22.0
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    got = row.select(numeric.cosine(F.col("a"), F.col("b")), numeric.cosine(F.col("a"), F.col("z"))).first()
    assert got[0] == pytest.approx(0.96) and got[1] is None
