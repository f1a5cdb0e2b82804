"""Edge rows for every cleaning expression (FIXTURES §4), ANSI mode on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paceline.functions import cleaning as C
from paceline.functions.names import normalise_columns, snake_name
from paceline.operators.clean import clean, parse_results, validity_filter


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_unit_unanchored(spark):
    assert one_col(spark, ["50km", "6d", "Marathon", None], C.event_unit) == ["km", "", "h", None]


def test_event_type_order(spark):
    vals = ["87km/2Etappen", "6d", "24h", "100mi", "Backyard"]
    got = one_col(spark, vals, lambda x: C.event_type(x, C.event_unit(x)))
    assert got == ["multi_stage", "time_based", "time_based", "distance_based", "unknown"]


def test_leading_number(spark):
    assert one_col(spark, ["42.195km", "Backyard", "100mi"], C.leading_number) == [42.195, None, 100.0]


def test_performance_hours(spark):
    def hours(x):
        return C.performance_hours(F.lit("km"), C.time_parts(C.performance_clean(x)))
    got = one_col(spark, ["5:12:33 h", "45:10 h", "1d 05:10:00 h", "DNF", ""], hours)
    assert got[0] == pytest.approx(5 + 12 / 60 + 33 / 3600)
    assert got[1] == pytest.approx(45 + 10 / 60)          # two parts are H:MM
    assert got[2:] == [None, None, None]


def test_performance_hours_only_for_distance_units(spark):
    def hours(x):
        return C.performance_hours(F.lit("h"), C.time_parts(C.performance_clean(x)))
    assert one_col(spark, ["5:12:33 h"], hours) == [None]


def test_performance_km(spark):
    def km(x):
        return C.performance_km(F.lit("h"), C.performance_clean(x))
    assert one_col(spark, ["151.2 km", "DNF"], km) == [151.2, None]


def test_event_country_and_clean_name(spark):
    vals = ["Foo (Bar) (SWE)", "Foo", "Foo (USA) "]
    assert one_col(spark, vals, C.event_country) == ["SWE", "", ""]
    assert one_col(spark, vals, C.event_name_clean) == ["Foo (Bar)", "Foo", "Foo (USA) "]


def test_speed(spark):
    assert one_col(spark, ["10,5", "1.234,5", None, "abc"], C.average_speed_kmh) == [10.5, None, None, None]


def test_start_date_shapes(spark):
    vals = ["1991-05-01", "06.01.2018", "23.-24.11.1991", "30.04.-01.05.2016",
            "31.12.-01.01.1996", "00.00.1989", "31.02.2020", "May 1991", None,
            "29.02.2020", "29.02.2019", "32.01.2020", "15.13.2020", "00.01.2020"]
    got = one_col(spark, vals, C.event_start_date)
    assert got == [dt.date(1991, 5, 1), dt.date(2018, 1, 6), dt.date(1991, 11, 23),
                   dt.date(2016, 4, 30), dt.date(1996, 12, 31), None, None, None, None,
                   dt.date(2020, 2, 29), None, None, None, None]


def test_gender(spark):
    vals = ["W", "F", "M", "X", "Q", None]
    assert one_col(spark, vals, C.gender_code) == ["F", "F", "M", "X", "Q", None]
    assert one_col(spark, vals, lambda x: C.gender_label(C.gender_code(x))) == \
        ["female", "female", "male", "other", None, None]


def test_blank_club_and_age(spark):
    assert one_col(spark, ["  ", "", "Club 1", None], C.blank_to_null) == [None, None, "Club 1", None]
    df = spark.createDataFrame([(2020, 1978.0), (2020, None)], "y int, b double")
    got = [r[0] for r in df.select(C.athlete_age(F.col("y"), F.col("b"))).collect()]
    assert got == [42, None]


def test_event_key(spark):
    got = one_col(spark, ["Comrades Marathon"], C.sha256_hex)
    assert got == ["262f1ff66a1f498feb0f35aa04e6d616ab0609a01dbc795e85a7c2a807c78b6b"]


def test_result_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, 2020)], "e string, a bigint, y int")
    got = df.select(C.result_key(F.col("e"), F.col("a"), F.col("y"))).first()[0]
    want = df.select(F.sha2(F.lit("a|2020"), 256)).first()[0]
    assert got == want


def test_date_shape_labels(spark):
    vals = ["06.01.2018", "23.-24.11.1991", "x23.-24.11.1991", "1991-05-01"]
    assert one_col(spark, vals, C.date_shape) == ["single", "interval", "interval", "unknown"]


def test_validity_filter_three_valued(spark):
    rows = [("km", None, None), ("h", None, None), ("", None, None), (None, None, None),
            ("km", 5.0, None), ("h", None, 100.0)]
    df = spark.createDataFrame(rows, "event_unit string, performance_hours double, performance_km double")
    kept = [tuple(r) for r in df.filter(validity_filter()).collect()]
    assert kept == [("", None, None), ("km", 5.0, None), ("h", None, 100.0)]


def test_snake_names_and_collisions(spark):
    assert snake_name("  Event  distance/length ") == "event_distance/length"
    df = spark.createDataFrame([(1, 2)], "`Athlete ID` int, `Year of event` int")
    assert normalise_columns(df).columns == ["athlete_id", "year_of_event"]
    clash = spark.createDataFrame([(1, 2)], "`A b` int, `a  B` int")
    with pytest.raises(ValueError):
        normalise_columns(clash)


RAW_DDL = ("year_of_event int, event_dates string, event_name string, `event_distance/length` string, "
           "event_number_of_finishers int, athlete_performance string, athlete_club string, "
           "athlete_country string, athlete_year_of_birth double, athlete_gender string, "
           "athlete_age_category string, athlete_average_speed string, athlete_id bigint")


def raw_row(dist, perf, name="Foo (SWE)", dates="01.05.1991", athlete=1, year=1991, gender="W"):
    return (year, dates, name, dist, 10, perf, "  ", "SWE", 1960.0, gender, "W30", "10,5", athlete)


def test_clean_end_to_end(spark):
    rows = [raw_row("50km", "4:00:00 h"), raw_row("6d", "500 km"), raw_row(None, "4:00:00 h"),
            raw_row("24h", "DNF"), raw_row("Backyard", None), raw_row("100mi", "1d 02:00:00 h"),
            raw_row("87km/2Etappen", "9:00:00 h", name="Stage (NOR)")]
    raw = spark.createDataFrame(rows, RAW_DDL)
    countries = spark.createDataFrame([("SWE", "Sweden")], "country_code string, country_name string")
    out = clean(raw, countries).orderBy("event_distance_numeric").collect()
    assert [r.event_unit for r in out] == ["", "km", "km"]          # Backyard has no unit
    staged = [r for r in out if r.event_type == "multi_stage"][0]
    assert staged.event_country == "NOR" and staged.event_country_name is None
    assert all(r.athlete_club is None and r.athlete_gender == "F" for r in out)
    assert all(r.athlete_country_name == "Sweden" for r in out)


def test_parse_keeps_every_row(spark):
    rows = [raw_row("6d", "500 km"), raw_row(None, None)]
    raw = spark.createDataFrame(rows, RAW_DDL)
    assert parse_results(raw).count() == 2


def test_lookup_join_drop_code_and_rename(spark):
    from paceline.operators.joins import enrich_country_name
    df = spark.createDataFrame([(1, "SWE"), (2, "XXX"), (3, None)], "id int, athlete_country string")
    lk = spark.createDataFrame([("SWE", "Sweden")], "country_code string, country_name string")
    out = enrich_country_name(df, lk, "athlete_country", "athlete_country_name")
    assert out.columns == ["id", "athlete_country", "athlete_country_name"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "SWE", "Sweden"), (2, "XXX", None), (3, None, None)]
