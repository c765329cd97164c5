from frames import bronze, rows, strings
from pyspark.sql import functions as F

from casewatch.operators import profile


def test_category_counts(spark):
    df = strings(spark, ["c"], [("b",), ("a",), ("b",), (None,), ("a",)])
    assert [tuple(r) for r in profile.category_counts(df, "c").collect()] == [("a", 2), ("b", 2), (None, 1)]
    assert [tuple(r) for r in profile.category_counts(df, "c", 1).collect()] == [("a", 2)]


def test_distinct_values_count_null_once(spark):
    df = strings(spark, ["c"], [("b",), (None,), (None,)])
    assert rows(profile.distinct_values([("T", df, "c")])) == [("T", "c", 2)]


def test_case_versions_follow_the_input_type(spark):
    df = strings(spark, ["caseid", "caseversion"], [("a", "9"), ("a", "10"), ("a", "9"), ("b", "1"), ("b", None)])
    assert rows(profile.case_versions(df)) == [("a", 2, "9")]
    typed = df.withColumn("caseversion", F.col("caseversion").cast("int"))
    assert rows(profile.case_versions(typed)) == [("a", 2, 10)]
    assert profile.most_versions(df, 1).count() == 1


def test_null_rates(spark):
    df = spark.createDataFrame([("1", None, 2.0), ("", None, None), ("3", "x", None)], "primaryid string, sex string, age double")
    assert [tuple(r) for r in profile.null_rates(df).collect()] == [("age", 2, 66.7), ("sex", 2, 66.7), ("primaryid", 1, 33.3)]
    assert [r.null_pct for r in profile.null_rates(df.limit(0)).collect()] == [0.0, 0.0, 0.0]


def test_layer_deltas(spark):
    demo = strings(spark, ["primaryid"], [("1",), ("2",)])
    kept = strings(spark, ["primaryid"], [("2",)])
    child = strings(spark, ["primaryid"], [("1",), ("2",), ("2",), ("5",)])
    got = {r.table_name: tuple(r)[1:] for r in profile.layer_deltas({"demo": demo, "reac": child}, kept).collect()}
    assert got == {"DEMO": (2, 1, 1), "REAC": (4, 2, 2)}


def test_name_search(spark):
    df = strings(spark, ["drugname", "prod_ai", "role_cod"], [("Atorvastatin", "x", "PS")] * 2 + [("LIPITOR 5", "y", "C"), ("z", "z", "C")])
    assert rows(profile.name_search(df, ["atorva", "lipitor"])) == [("Atorvastatin", "x", "PS"), ("LIPITOR 5", "y", "C")]


def test_samples(spark):
    demo = spark.createDataFrame(
        [("20240101", None, 2.0, "YR", 2.0), ("2024", None, 1.0, "YR", 1.0), ("2024", None, 5.0, "MON", 0.4), (None, None, None, "DY", None)],
        "event_dt string, event_dt_parsed date, age double, age_cod string, age_in_years double",
    )
    assert [r.event_dt for r in profile.date_samples(demo).collect()] == ["2024", "20240101"]
    assert [tuple(r) for r in profile.age_samples(demo).collect()] == [(5.0, "MON", 0.4), (1.0, "YR", 1.0)]
    assert [r.age for r in profile.sample_rows(demo, ["age", "age_cod"], 1, F.col("age_cod") == "YR").collect()] == [1.0]


def test_layer_profile_lists_typed_columns(spark):
    df = bronze(spark, "reac", [{"primaryid": "1", "pt": "x"}, {"primaryid": "1", "pt": "y", "_quarter": "Q2"}])
    typed = df.withColumn("pt", F.lit(1))
    got = rows(profile.layer_profile({"reac": df, "x": typed}))
    assert got == [("REAC", 2, 2, "", 2), ("X", 2, 2, "pt", 2)]
