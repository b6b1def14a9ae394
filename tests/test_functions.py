import datetime
import math

from pyspark.sql import functions as F

from portolan.functions import complete_rows, region_suffix, sas_to_date, sas_to_date_text, time_parts


def test_sas_day_numbers_floor_to_dates(spark):
    df = spark.createDataFrame([(20454.0,), (20454.7,), (0.0,), (-0.5,), (None,), (math.nan,)], "x double")
    got = [r.d for r in df.select(sas_to_date("x").alias("d")).collect()]
    assert got == [datetime.date(2016, 1, 1), datetime.date(2016, 1, 1), datetime.date(1960, 1, 1),
                   datetime.date(1959, 12, 31), None, None]


def test_sas_date_text_form(spark):
    df = spark.createDataFrame([(20454.0,)], "x double")
    assert df.select(sas_to_date_text("x")).first()[0] == "2016-01-01"


def test_time_parts_of_new_year_2016(spark):
    df = spark.createDataFrame([(datetime.date(2016, 1, 1),)], "d date")
    row = df.select(*[c.alias(n) for n, c in time_parts("d").items()]).first()
    assert (row.year, row.month, row.day, row.week, row.weekday) == (2016, 1, 1, 53, 6)


def test_region_suffix(spark):
    df = spark.createDataFrame([("US-CA",), ("US-U-A",), ("US",), (None,)], "r string")
    assert [r[0] for r in df.select(region_suffix("r")).collect()] == ["CA", "U", None, None]


def test_complete_rows_drops_null_and_nan_only_where_asked(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert df.filter(complete_rows(df)).count() == 1
    assert df.filter(complete_rows(df, ["x"])).count() == 2


def test_complete_rows_matches_na_drop(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert sorted(df.filter(complete_rows(df)).collect()) == sorted(df.na.drop().collect())


def test_no_python_udf_in_function_plans(spark):
    df = spark.createDataFrame([(20454.0, "US-CA")], "x double, r string")
    plan = df.select(sas_to_date("x"), region_suffix("r"), F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
