"""Column functions against tables of edge cases."""

import pytest
from pyspark.sql import functions as F

from siltstone.functions.jsontext import json_fields, json_shape
from siltstone.functions.labels import band_label, fixed, signed
from siltstone.functions.numbers import (
    envelope, first_number, midpoint, nearest_int, numbers, round_to, sex_envelope, share,
)
from siltstone.functions.shapes import classify_format, shape_known
from siltstone.functions.text import missing_score, null_if, sentence_case, strip_space, to_int, word_count

# text, kept, min, max, mid, int min, int max, known shape
PARSER = [
    ("3.2-4.5", "3.2-4.5", 3.2, 4.5, 3.85, 3, 4, True),
    ("Male: 25-30; Female: 20-25", "male: 25-30; female: 20-25", 20.0, 30.0, 25.0, 20, 30, True),
    ("Female: 3-4; Male: 5", "female: 3-4; male: 5", 3.0, 5.0, 4.0, 3, 5, True),
    ("Male: 50", "male: 50", 50.0, 50.0, 50.0, 50, 50, True),
    ("50", "50", 50.0, 50.0, 50.0, 50, 50, True),
    ("3-5kg", "3-5kg", 3.0, 5.0, 4.0, 3, 5, True),
    (" 8-9 ", "8-9", 8.0, 9.0, 8.5, 8, 9, True),
    ("12.7-13.5", "12.7-13.5", 12.7, 13.5, 13.1, 13, 14, True),
    ("120-180", "120-180", 120.0, 180.0, 150.0, 120, 180, True),
    ("unknown", None, None, None, None, None, None, None),
    ("Unknown ", None, None, None, None, None, None, None),
    ("", "", None, None, None, None, None, False),
    ("N/A", "n/a", None, None, None, None, None, False),
    ("12 years - 13 years", "12 years - 13 years", 12.0, 13.0, 12.5, 12, 13, False),
    ("2 years 6 months", "2 years 6 months", 2.0, 6.0, 4.0, 2, 6, False),
    ("3.5 kg (7.7 lb)", "3.5 kg (7.7 lb)", 3.5, 7.7, 5.6, 4, 8, False),
    ("1,200-1,500", "1,200-1,500", 1.0, 500.0, 250.5, 1, 500, False),
    ("10–12", "10–12", 10.0, 12.0, 11.0, 10, 12, False),
    ("-5-3", "-5-3", 3.0, 5.0, 4.0, 3, 5, False),
]


def test_parser_table(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(PARSER)], "i int, text string")
    kept = df.withColumn("kept", null_if("text", ["unknown"])).withColumn("n", numbers("kept"))
    low, high = envelope("n")
    ilow, ihigh = envelope("n", as_int=True)
    rows = kept.select(
        "i", "text", "kept", low.alias("lo"), high.alias("hi"), F.round(midpoint(low, high), 6).alias("mid"),
        ilow.alias("ilo"), ihigh.alias("ihi"), shape_known("kept").alias("known"),
    ).orderBy("i").collect()
    for row, want in zip(rows, PARSER):
        assert tuple(row)[1:] == want, want


@pytest.mark.parametrize("x,want", [(12.5, 12), (13.5, 14), (12.7, 13), (-0.5, 0), (None, None)])
def test_nearest_int_is_half_even(spark, x, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(nearest_int("x")).first()[0] == want


def test_round_to_uses_the_binary_value(spark):
    df = spark.createDataFrame([(1.005, 2.675, -2.5)], "a double, b double, c double")
    assert tuple(df.select(round_to("a", 2), round_to("b", 2), round_to("c", 0)).first()) == (1.0, 2.68, -3.0)


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("quick to LEARN", " 12 ", "1.7", "x", "\t a \n", None)], "a string, b string, c string, d string, e string, f string"
    )
    row = df.select(
        sentence_case("a"), to_int("b"), to_int("c"), to_int("d"), strip_space("e"), word_count("a"),
        missing_score(["d", "f", F.lit("  ")]), F.trim("e"),
    ).first()
    assert tuple(row) == ("Quick to learn", 12, 2, None, "a", 3, 2, "\t a \n")


def test_first_number_and_sexes(spark):
    df = spark.createDataFrame([("male: 5-7.5; female: 3-4",), ("none",), ("female: 2",)], "t string")
    (m_lo, m_hi), (f_lo, f_hi) = sex_envelope("t", "male"), sex_envelope("t", "female")
    rows = df.select(first_number("t"), m_lo, m_hi, f_lo, f_hi).collect()
    assert [tuple(r) for r in rows] == [
        (5.0, 5.0, 7.5, 3.0, 4.0), (None, None, None, None, None), (2.0, None, None, 2.0, 2.0)
    ]


@pytest.mark.parametrize(
    "text,label",
    [
        (None, "null/missing"), ("  ", "empty string"), ("N/A", "sentinel string: 'N/A'"), ("-", "sentinel string: '-'"),
        ("3 - 4.5", "range: 'X-Y'"), ("10-12 Years", "range with unit: 'X-Y years'"),
        ("1 year", "single value with unit: 'X years'"), ("7", "single value: 'X'"),
        ("Male: 5-7; Female: 4", "sex-specific range: 'Male: … ; Female: …'"),
        ("female: 4", "sex-specific single value, one sex only: 'Female: …'"),
        ("Male: 4; male: 5", "sex-specific single value, one sex only: 'Male: …'"),
        ("about 5", "unrecognised: 'about 5'"), ("5'", "unrecognised: \"5'\""),
        ("a\nb", "unrecognised: 'a\\nb'"),
    ],
)
def test_format_labels(spark, text, label):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(classify_format("t")).first()[0] == label


def test_json_fields_and_shapes(spark):
    docs = [
        ('{"a":"x","n":{"m":"1"},"k":5}',), ('{"a":null}',), ("not json",), ('{"n":"flat"}',),
    ]
    df = spark.createDataFrame(docs, "doc string")
    rows = json_fields(df, "doc", {"a": "a", "m": "n.m", "k": "k"}).collect()
    assert [tuple(r) for r in rows] == [("x", "1", "5"), (None, None, None), (None, None, None), (None, None, None)]
    texts = spark.createDataFrame([('{"b":1,"a":2}',), ("null",), (None,), ("3",), ("3.5",), ('"s"',), ("[1]",)], "t string")
    assert [r[0] for r in texts.select(json_shape("t")).collect()] == [
        "object with keys: a, b", "null/missing", "null/missing", "scalar (int)", "scalar (float)", "scalar (str)", "scalar (list)"
    ]


def test_json_is_parsed_once_even_under_a_filter(spark):
    df = spark.createDataFrame([('{"a":"1","b":"2"}',)], "doc string")
    rows = json_fields(df, "doc", {"a": "a", "b": "b"})
    plan = rows.where("a = '1' and b > '0' and length(a) = 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_labels(spark):
    df = spark.createDataFrame([(5, 12, 0.145, -0.67), (45, 999, 0.125, 0.0)], "lo int, hi int, r double, s double")
    rows = df.select(band_label("lo", "hi"), signed("r"), signed("s"), fixed("r", 1)).collect()
    assert [tuple(r) for r in rows] == [("5–12 kg", "+0.14", "-0.67", "0.1"), ("≥45 kg", "+0.12", "+0.00", "0.1")]


def test_share_of_nothing_is_null(spark):
    assert spark.range(1).select(share(F.lit(1), F.lit(0))).first()[0] is None
