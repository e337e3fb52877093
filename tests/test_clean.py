"""Cleaning and validation on the reference's own fixture rows (FIXTURES.md §1)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import title_case
from tessera.operators import clean as C
from tessera.operators import quality as Q

DIRTY = [  # all strings, as read from CSV
    ("1", "Alice", "20", "3.5", "90", "riyadh", 0),
    ("2", "Bob", "150", "5.0", "-10", "JEDDAH", 1),
    ("1", "Alice", "20", "3.5", "90", "riyadh", 2),
    ("3", "Charlie", "22", "3.9", "87", "dammam", 3),
]
SCHEMA = "student_id string, name string, age string, gpa string, attendance string, city string, ingest_ord long"


@pytest.fixture()
def dirty(spark):
    return spark.createDataFrame(DIRTY, SCHEMA)


def test_convert_types_strict_and_half_even(spark):
    df = spark.createDataFrame([("20.0",), ("20.7",), ("abc",), ("",), ("nan",), ("2.5",)], "age string")
    strict = [r.age for r in C.convert_types(df).collect()]
    assert strict == [20, None, None, None, None, None]
    even = [r.age for r in C.convert_types(df, "half_even").collect()]
    assert even == [20, 21, None, None, None, 2]


def test_clean_data_end_to_end(dirty):
    out = C.clean_data(C.convert_types(dirty)).orderBy("student_id").collect()
    assert [r.student_id for r in out] == [1, 2, 3]
    bob = out[1]
    # three outliers in one row: nulled, then filled with medians of the cleaned table
    assert bob.age == 21 and bob.gpa == 3.7 and bob.attendance == 88.5
    assert [r.city for r in out] == ["Riyadh", "Jeddah", "Dammam"]


def test_strip_and_title(spark):
    df = spark.createDataFrame([("  Ahmed  ", "  sanaa  "), ("\tO'neil ", "al-ain")], "name string, city string")
    out = C.clean_text(df).collect()
    assert out[0].name == "Ahmed" and out[0].city == "Sanaa"
    assert out[1].name == "O'neil" and out[1].city == "Al-Ain"
    t = spark.createDataFrame([("o'neil",), ("abc3def",)], "s string").select(title_case("s").alias("t"))
    assert [r.t for r in t.collect()] == ["O'Neil", "Abc3Def"]


def test_keep_first_null_ids_collapse(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 0), (5, "c", 2), (5, "d", 3)],
                               "student_id long, name string, ingest_ord long")
    out = {(r.student_id, r.name) for r in C.keep_first(df).collect()}
    assert out == {(None, "b"), (5, "c")}


def test_validate_data_accumulates_all_errors(dirty):
    rep = {r.rule: r.failed_count for r in Q.validate_data(C.convert_types(dirty)).collect()}
    assert rep["unique:student_id"] == 1
    assert rep["range:age"] == 1 and rep["range:gpa"] == 1 and rep["range:attendance"] == 1
    assert rep["empty"] == 0


def test_schema_check(dirty):
    assert Q.validate_schema(dirty).extra_columns == ("ingest_ord",)
    with pytest.raises(ValueError):
        Q.validate_schema(dirty.drop("city"))
    with pytest.raises(ValueError):
        Q.validate_schema(dirty, strict=True)


def test_quality_report_tiers(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "y")], "a long, b string")
    rep = {r.column_name: r for r in Q.quality_report(df).collect()}
    assert rep["a"].quality_tier == "Excellent" and rep["b"].missing_percentage == 50.0
    assert rep["b"].quality_tier == "Poor" and rep["b"].unique_count == 2


def test_attendance_scale_detection(spark):
    df = spark.createDataFrame([("x", 95.0), ("x", 50.0), ("y", 0.9), ("z", None), ("w", 150.0)],
                               "source string, attendance double")
    out = {(r.source, r.attendance): (r.attendance_rate, r.scale_error) for r in C.attendance_to_rate(df).collect()}
    assert out[("x", 95.0)] == (0.95, False) and out[("y", 0.9)] == (0.9, False)
    assert out[("z", None)] == (None, False) and out[("w", 150.0)][1] is True
    assert F is not None


def test_ids_above_two_to_the_53_stay_apart(spark):
    from tessera.functions.numeric import coerce_int, coerce_int_half_even

    d = spark.createDataFrame([("9007199254740993",), ("9007199254740992",), ("9007199254740993.0",), ("20.7",), (" 20.0 ",), ("2e1",), ("x",), (None,)], "s string")
    got = [tuple(r) for r in d.select(coerce_int("s"), coerce_int_half_even("s")).collect()]
    assert got == [(9007199254740993, 9007199254740993), (9007199254740992, 9007199254740992), (9007199254740993, 9007199254740993),
                   (None, 21), (20, 20), (20, 20), (None, None), (None, None)]
