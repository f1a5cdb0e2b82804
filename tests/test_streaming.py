"""Incremental pipeline: rerun adds nothing, a new drop adds only its rows,
and the streamed silver equals the batch silver."""

import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from conftest import SF_SMALL
from paceline.operators.clean import SILVER_COLUMNS
from paceline.plans.queries import silver
from paceline.session import fresh_dir
from paceline.sources.csv import header_schema, read_quoted_csv, stream_csv, stream_csv_inferred, write_csv
from paceline.sources.tables import Layers, append_available, overwrite, read_current, read_table
from paceline.streaming import pipeline as P
from paceline.streaming.queries import land_first_drop, land_second_drop


def counts(spark, layers):
    return {name: read_table(spark, layers.table(layer, name)).count()
            for layer, name in [("bronze", P.MAIN), ("silver", "results_clean"), ("gold", "fct_results")]}


def test_rerun_and_new_drop(spark):
    layers = Layers(fresh_dir(spark, "test-stream"))
    land_first_drop(spark, layers, SF_SMALL)
    schemas = P.probe_schemas(spark, layers)
    P.run_once(spark, layers, schemas, 'bigint')
    first = counts(spark, layers)
    assert first["results_clean"] > 0
    assert first["results_clean"] == first["fct_results"]

    P.run_once(spark, layers, schemas, 'bigint')             # nothing landed: no new rows
    assert counts(spark, layers) == first

    land_second_drop(spark, layers, SF_SMALL)
    main_second_drop = spark.read.csv(layers.landing(P.MAIN), header=True, multiLine=True).count() - first[P.MAIN]
    P.run_once(spark, layers, schemas, 'bigint')
    after = counts(spark, layers)
    assert after[P.MAIN] - first[P.MAIN] == main_second_drop  # only the new files' rows
    assert after["results_clean"] == after["fct_results"]

    streamed = read_table(spark, layers.table("silver", "results_clean")).select(*SILVER_COLUMNS)
    batch = silver(spark, SF_SMALL).select(*SILVER_COLUMNS)
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0

    dims = P.gold_star(spark, layers)
    assert dims.athletes.count() == batch.select("athlete_id").distinct().count()


def test_quoted_csv_round_trip(spark):
    rows = [(1, 'He said "go"\nthen ran', "  "), (2, "plain, with comma", "x")]
    df = spark.createDataFrame(rows, "id int, note string, club string")
    path = fresh_dir(spark, "test-quoted") + "/t"
    write_csv(df, path)
    back = read_quoted_csv(spark, path, schema=df.schema).orderBy("id").collect()
    assert [tuple(r) for r in back] == rows


def test_no_value_is_lost_to_a_probe(spark):
    """Types differ in the last of ten files: everything stays text."""
    path = fresh_dir(spark, "test-probe") + "/t"
    for i in range(10):
        speed = "10.5" if i < 9 else "10,5"
        write_csv(spark.createDataFrame([(f"A{i}", speed)], "`Athlete ID` string, speed string").coalesce(1), path)
    schema = header_schema(spark, path)
    assert {f.dataType.simpleString() for f in schema.fields} == {"string"}
    rows = drain(spark, stream_csv(spark, path, schema))
    assert sorted(r.speed for r in rows) == ["10,5"] + ["10.5"] * 9

    inferred = stream_csv_inferred(spark, path)                # S3 = S1 + S2
    assert inferred.isStreaming and inferred.columns == ["Athlete ID", "speed"]
    assert inferred.schema["speed"].dataType.simpleString() == "string"


def drain(spark, stream):
    root = fresh_dir(spark, "test-drain")
    append_available(stream, root + "/t", root + "/c")
    return read_table(spark, root + "/t").collect()


def test_stream_reads_what_the_writer_wrote(spark):
    rows = [(1, 'Club "A", Oslo', "a\nb"), (2, "", None), (3, None, "  "), (4, ",", '"')]
    df = spark.createDataFrame(rows, "id int, club string, note string")
    path = fresh_dir(spark, "test-form") + "/t"
    write_csv(df, path)
    assert sorted(tuple(r) for r in drain(spark, stream_csv(spark, path, df.schema, multiline=True))) == rows
    assert sorted(tuple(r) for r in read_quoted_csv(spark, path, df.schema).collect()) == rows


def test_old_files_and_reordered_headers(spark, tmp_path):
    land, root = tmp_path / "land", fresh_dir(spark, "test-age")
    land.mkdir()
    (land / "a.csv").write_text("a,b\n1,x\n")
    schema = header_schema(spark, str(land))

    def ingest():
        append_available(stream_csv(spark, str(land), schema), root + "/t", root + "/c")
        return sorted(tuple(r) for r in read_table(spark, root + "/t").collect())
    assert ingest() == [("1", "x")]
    (land / "b.csv").write_text("a,b\n2,y\n")
    old = time.time() - 30 * 86400
    os.utime(land / "b.csv", (old, old))
    assert ingest() == [("1", "x"), ("2", "y")]
    (land / "c.csv").write_text("b,a\nz,3\n")
    with pytest.raises(StreamingQueryException):
        ingest()


def test_lookup_header_text_ids_extra_and_missing_columns(spark):
    layers = Layers(fresh_dir(spark, "test-names"))
    head = "`Event name` string, `Event distance/length` string, `Athlete performance` string, `Athlete ID` string, "
    head += "`Year of event` string, `Athlete country` string, Weather string"
    row = ("Race (NOR)", "50km", "5:00:00 h", "A12", "2018.0", "SWE", "rain")
    write_csv(spark.createDataFrame([row], head), layers.landing(P.MAIN))
    write_csv(spark.createDataFrame([row], head).drop("Weather"), layers.landing(P.SECOND))
    write_csv(spark.createDataFrame([("SWE", "Sweden"), ("NOR", "Norway")], "`Country Code` string, `Country Name` string"),
              layers.landing(P.COUNTRIES))
    P.run_once(spark, layers, P.probe_schemas(spark, layers))
    got = read_table(spark, layers.table("silver", "results_clean")).collect()
    assert [(r.athlete_id, r.year_of_event, r.athlete_country_name, r.event_country_name) for r in got] \
        == [("A12", 2018, "Sweden", "Norway")] * 2
    assert sorted((r.weather or "") for r in got) == ["", "rain"]
    assert P.gold_star(spark, layers).athletes.count() == 1


def test_null_years_come_with_a_drop(spark, monkeypatch):
    from paceline.streaming import queries as Q
    layers = Layers(fresh_dir(spark, "test-null-year"))
    feed = spark.createDataFrame([(1990, "a"), (2005, "b"), (None, "c")], "`Year of event` int, x string")
    monkeypatch.setattr(Q, "race_feeds", lambda *_: (feed, feed))
    Q.land_first_drop(spark, layers, SF_SMALL)
    Q.land_second_drop(spark, layers, SF_SMALL)
    assert spark.read.csv(layers.landing(P.MAIN), header=True).count() == 3


def test_failed_refresh_keeps_the_old_dimension(spark):
    path = fresh_dir(spark, "test-versions") + "/dim"
    overwrite(spark.range(3).toDF("id"), path)
    broken = spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('stop') ELSE id END AS id")
    with pytest.raises(Exception, match="stop"):
        overwrite(broken, path)
    assert read_current(spark, path).count() == 3
    overwrite(spark.range(7).toDF("id"), path)
    assert read_current(spark, path).count() == 7
