from astrolode.functions import predicates as p
from astrolode.functions.scalars import calendar_attributes, date_key, or_unknown
from pyspark.sql import functions as F


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_blank_is_null_or_spaces_only(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("\t",), ("\n",), (" x ",)], "a STRING")
    assert values(df, p.not_blank(df, "a")) == [False, False, False, True, True, True]
    assert values(df, p.is_blank(df, "a")) == [True, True, True, False, False, False]


def test_other_types_are_blank_only_when_null(spark):
    df = spark.createDataFrame([(0, False, None), (None, None, 1.5)], "i INT, b BOOLEAN, d DOUBLE")
    assert values(df, p.not_blank(df, "i")) == [True, False]
    assert values(df, p.not_blank(df, "b")) == [True, False]
    assert values(df, p.not_blank(df, "d")) == [False, True]


def test_binary_spaces_are_blank(spark):
    df = spark.createDataFrame([(bytearray(b"  "),), (bytearray(b" x"),)], "a BINARY")
    assert values(df, p.not_blank(df, "a")) == [False, True]


def test_folds(spark):
    df = spark.createDataFrame([("a", "b"), ("a", " "), (None, "")], "x STRING, `y z` STRING")
    names = ["x", "y z"]
    assert values(df, p.any_not_blank(df, names)) == [True, True, False]
    assert values(df, p.all_not_blank(df, names)) == [True, False, False]
    assert values(df, p.all_blank(df, names)) == [False, False, True]
    assert values(df, p.all_present(names)) == [True, True, False]


def test_no_columns_means_no_blank_row(spark):
    df = spark.createDataFrame([("a",)], "x STRING")
    assert values(df, p.all_blank(df, [])) == [False]
    assert values(df, p.any_not_blank(df, [])) == [False]


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(" ", "v")], "`a.b` STRING, `c``d` STRING")
    assert values(df, p.is_blank(df, "a.b")) == [True]
    assert values(df, p.is_blank(df, "c`d")) == [False]


def test_unknown_replaces_blank_and_leaves_the_rest_untrimmed(spark):
    df = spark.createDataFrame([(None,), (" ",), (" WA ",)], "r STRING")
    assert values(df, or_unknown(df, "r")) == ["Unknown", "Unknown", " WA "]
    assert values(df, or_unknown(df, "r", "it's \\ none"))[0] == "it's \\ none"


def test_calendar_attributes(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2024-01-07'), (DATE '2021-01-01'), (NULL) AS t(d)")
    rows = df.select(*(c.alias(n) for n, c in calendar_attributes(F.col("d")).items())).collect()
    assert rows[0].asDict() == {
        "date_key": 20240107, "year": 2024, "month": 1, "day": 7, "day_name": "Sunday",
        "day_of_week": 1, "week_of_year": 1, "quarter": 1, "is_weekend": True,
    }
    assert (rows[1].day_name, rows[1].week_of_year, rows[1].is_weekend) == ("Friday", 53, False)
    assert set(rows[2]) == {None}


def test_date_key_equals_the_formatted_date(spark):
    days = spark.sql("SELECT explode(sequence(DATE '1899-12-20', DATE '2101-03-01')) AS d")
    wrong = days.filter(date_key(F.col("d")) != F.date_format("d", "yyyyMMdd").cast("int"))
    assert wrong.isEmpty()
