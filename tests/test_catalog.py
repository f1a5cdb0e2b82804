"""Catalog, comments, resets, merged dimensions and landed files."""

import os
import uuid
from collections import Counter

import pytest

from conftest import SF_SMALL
from paceline.operators import marts
from paceline.plans.views import VIEWS
from paceline.session import fresh_dir
from paceline.sources.catalog import Catalog
from paceline.sources.csv import read_quoted_csv, stream_csv, write_csv
from paceline.sources.tables import (Layers, Versions, append_available, comment_of, current_version, open_layers,
                                     overwrite, publish_generations, read_current, read_table)
from paceline.streaming import pipeline as P
from paceline.streaming.queries import land_first_drop, land_second_drop


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def prefix():
    return f"t{uuid.uuid4().hex[:8]}_"


@pytest.fixture(scope="module")
def built(spark):
    """(layers, schemas) after both drops, each refreshed by itself."""
    layers = Layers(fresh_dir(spark, "test-catalog"))
    land_first_drop(spark, layers, SF_SMALL)
    schemas = P.probe_schemas(spark, layers)
    P.run_once(spark, layers, schemas, "bigint")
    land_second_drop(spark, layers, SF_SMALL)
    P.run_once(spark, layers, schemas, "bigint")
    return layers, schemas


def test_another_session_reads_tables_views_and_comments(spark, built):
    layers, _ = built
    mine = P.publish(spark, layers, prefix())
    other = spark.newSession()
    star = P.gold_star(spark, layers)
    silver = other.table(f"{mine.prefix}silver.results_clean")
    assert silver.count() == star.fact.count() and rows(other.table(mine.name("gold", "dim_event"))) == rows(star.events)
    assert other.table(mine.name("gold", "dim_athlete")).columns == P.DIMENSIONS["dim_athlete"][2]
    for name, (comment, _) in VIEWS.items():
        expected = getattr(marts, name)(star)
        assert rows(other.table(mine.name("gold", name)).select(*expected.columns)) == rows(expected), name
        assert Catalog(other, layers.root, mine.prefix).comment("gold", name) == comment


def test_comments_are_in_the_catalog_and_in_the_files(spark, built):
    layers, _ = built
    catalog = P.publish(spark, layers, prefix())
    for layer, names in P.COMMENTS.items():
        for name, comment in names.items():
            path = layers.table(layer, name)
            version = current_version(spark, path)
            assert catalog.comment(layer, name) == comment == comment_of(spark, version.folder if version else path)
    assert comment_of(spark, f"{SF_SMALL}/nation.parquet") is None


def test_a_catalog_that_forgot_is_attached_from_the_root(spark, built):
    layers, _ = built
    first = P.publish(spark, layers, prefix())
    spark.sql(f"DROP SCHEMA {first.prefix}gold CASCADE")                    # the files stay
    again = Catalog.attach(spark, layers.root, prefix())
    assert list(again.definitions) == list(first.definitions)
    star = P.gold_star(spark, layers)
    assert rows(again.table("gold", "event_distance")) == rows(marts.event_distance(star))
    assert again.comment("gold", "event_distance") == VIEWS["event_distance"][0]
    with pytest.raises(FileNotFoundError):
        Catalog.attach(spark, fresh_dir(spark, "test-nothing-saved"), prefix())


def test_names_comments_and_shapes_need_no_care(spark):
    root = fresh_dir(spark, "test-quoting")
    catalog = Catalog(spark, root, prefix())
    catalog.create_schemas()
    catalog.create_schemas()
    spark.range(3).toDF("odd `name`").write.parquet(f"{root}/it's")
    catalog.put_table("bronze", "a_b", f"{root}/it's", "it's a \\ comment")
    assert catalog.table("bronze", "a_b").count() == 3 and catalog.comment("bronze", "a_b") == "it's a \\ comment"
    spark.range(5).selectExpr("id AS x", "id AS y").write.parquet(f"{root}/wider")
    catalog.put_table("bronze", "a_b", f"{root}/wider", "other", ["y"])
    assert catalog.table("bronze", "a_b").columns == ["y"] and catalog.table("bronze", "a_b").count() == 5
    catalog.drop("bronze", "a_b")
    assert not spark.catalog.tableExists(catalog.name("bronze", "a_b"))
    assert spark.read.parquet(f"{root}/wider").count() == 5


def test_streams_in_sql_equal_the_dataframe_ones(spark, built):
    layers, _ = built
    sql = Layers(fresh_dir(spark, "test-sql"))
    land_first_drop(spark, sql, SF_SMALL)
    catalog = Catalog(spark, sql.root, prefix())
    catalog.create_schemas()
    schemas = P.probe_schemas(spark, sql)
    for drop in (None, land_second_drop, None):                             # the last run finds nothing new
        if drop:
            drop(spark, sql, SF_SMALL)
        P.ingest_sql(spark, sql, catalog, schemas)
        P.refresh_silver_sql(spark, sql, catalog, "bigint")
        P.refresh_facts_sql(spark, sql, catalog)
    for layer, name in (("silver", "results_clean"), ("gold", "fct_results")):
        assert rows(catalog.table(layer, name)) == rows(read_table(spark, layers.table(layer, name)))
    assert spark.sql(catalog.sql("SELECT 1 FROM STREAM ${silver}.results_clean")).isStreaming


@pytest.mark.parametrize("dataset, moved", [("gold.fct_results", 1), ("silver.results_clean", 6), ("gold.dim_event", 4)])
def test_reset_keeps_the_old_generation_until_the_new_one_is_whole(spark, dataset, moved):
    layers = Layers(fresh_dir(spark, "test-reset"))
    land_first_drop(spark, layers, SF_SMALL)
    schemas = P.probe_schemas(spark, layers)
    P.run_once(spark, layers, schemas, "bigint")

    def seen(at):
        star = P.gold_star(spark, at)
        return [rows(x) for x in (star.fact, star.athletes, star.events, star.dates)]
    before = seen(open_layers(spark, layers.root))
    crashed = P.reset(spark, open_layers(spark, layers.root), dataset)       # a refresh that ends half way
    P.ingest_all(spark, crashed, schemas)
    P.refresh_silver(spark, crashed, "bigint")
    assert open_layers(spark, layers.root) == layers and seen(open_layers(spark, layers.root)) == before

    rebuilt = P.rebuild(spark, layers.root, dataset, schemas, "bigint")
    found = open_layers(spark, layers.root)
    assert found == rebuilt and len(found.generations) == moved
    assert found.table("gold", "fct_results") != layers.table("gold", "fct_results") or dataset == "gold.dim_event"
    assert seen(found) == before
    P.run_once(spark, found, schemas, "bigint")                              # nothing twice
    assert seen(found) == before
    with pytest.raises(ValueError):
        P.reset(spark, found, "gold.unknown")


def test_dimensions_read_new_rows_only_and_a_replay_changes_nothing(spark, monkeypatch):
    layers = Layers(fresh_dir(spark, "test-merge"))
    land_first_drop(spark, layers, SF_SMALL)
    schemas = P.probe_schemas(spark, layers)
    seen = []
    state_of, merged, columns = P.DIMENSIONS["dim_athlete"]
    monkeypatch.setitem(P.DIMENSIONS, "dim_athlete", (lambda df: (seen.append(df.count()), state_of(df))[1], merged, columns))
    P.run_once(spark, layers, schemas, "bigint")
    first = read_table(spark, layers.table("silver", "results_clean")).count()
    land_second_drop(spark, layers, SF_SMALL)
    P.run_once(spark, layers, schemas, "bigint")
    total = read_table(spark, layers.table("silver", "results_clean")).count()
    assert seen == [first, total - first]

    def check():
        star = P.gold_star(spark, layers)
        full = P.recompute_dimensions(spark, layers)
        assert rows(star.athletes) == rows(full["dim_athlete"]) and rows(star.events) == rows(full["dim_event"])
        assert rows(star.dates) == rows(full["dim_date"])
    check()
    # a crash after one dimension was written: its batch comes again
    versions = {n: current_version(spark, layers.table("gold", n)) for n in P.DIMENSIONS}
    checkpoint = layers.checkpoint("gold", "dimensions").removeprefix("file:")
    os.remove(f"{checkpoint}/commits/1")
    if os.path.exists(f"{checkpoint}/commits/.1.crc"):
        os.remove(f"{checkpoint}/commits/.1.crc")
    P.refresh_dimensions(spark, layers)
    assert {n: current_version(spark, layers.table("gold", n)) for n in P.DIMENSIONS} == versions
    check()


def test_null_years_and_late_rows_merge_as_if_read_at_once(spark):
    from paceline.operators.model import ATHLETE_ATTRIBUTES, DIMENSIONS, dim_athlete
    columns = ["athlete_id", "year_of_event", "event_start_date", "event_id", *ATHLETE_ATTRIBUTES]
    schema = "athlete_id long, year_of_event int, event_start_date date, event_id string, " + ", ".join(
        f"{c} {'double' if c == 'athlete_year_of_birth' else 'string'}" for c in ATHLETE_ATTRIBUTES)
    data = [(1, 2001, None, "b", "x", None, "c", 1.0, "F", "f", "k"), (1, None, None, "z", "never", None, None, None, None, None, None),
            (2, None, None, "a", "never", None, None, None, None, None, None), (1, 2000, None, "c", "old", None, None, None, None, None, None),
            (1, 2001, None, "b", "x", None, "d", 1.0, "F", "f", "k"), (None, 1999, None, "q", "n", None, None, None, None, None, None)]
    df = spark.createDataFrame(data, schema).select(*columns)
    state_of, merged, published = DIMENSIONS["dim_athlete"]
    for cut in range(1, len(data)):
        a, b = (spark.createDataFrame(part, schema) for part in (data[:cut], data[cut:]))
        state = merged(state_of(b).unionByName(state_of(a)))
        assert rows(merged(state).select(*published)) == rows(dim_athlete(df).select(*published))


def test_old_versions_are_emptied(spark):
    path = fresh_dir(spark, "test-expire") + "/t"
    folders = []
    for n in range(1, 6):
        overwrite(spark.range(n).toDF("id"), path)
        folders.append(current_version(spark, path).folder)
        Versions(spark, path).expire()
    assert [spark.read.parquet(f).count() for f in folders] == [0, 0, 0, 4, 5]
    assert read_current(spark, path).count() == 5 and Versions(spark, path).expire() == 0


def test_a_replacement_empties_what_it_need_not_keep(spark):
    path = fresh_dir(spark, "test-replace") + "/t"
    for n in range(1, 5):
        Versions(spark, path).replace(spark.range(n).toDF("id"), batch=n, keep=2)
    rows = Versions(spark, path)
    assert [r.batch for r in rows.live] == [3, 4] and read_current(spark, path).count() == 4
    assert [spark.read.parquet(r.folder).count() for r in rows.rows if not r.expired] == [0, 0, 3, 4]
    broken = spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('stop') ELSE id END AS id")
    with pytest.raises(Exception, match="stop"):
        Versions(spark, path).replace(broken, batch=5, keep=1)
    assert read_current(spark, path).count() == 4
    Versions(spark, path).replace(spark.range(9).toDF("id"), batch=6, keep=1)
    assert [spark.read.parquet(r.folder).count() for r in Versions(spark, path).live] == [4, 9]


def test_a_large_landed_file_is_read_by_many_tasks(spark):
    path = fresh_dir(spark, "test-split") + "/t"
    df = spark.range(20_000).selectExpr("cast(id AS string) AS id", "repeat('x', 50) AS text")
    write_csv(df.coalesce(1), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tasks = []
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        query = stream_csv(spark, path, df.schema).writeStream.foreachBatch(
            lambda batch, _: tasks.append((batch.rdd.getNumPartitions(), batch.count()))).option(
            "checkpointLocation", fresh_dir(spark, "test-split-c")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tasks[0][0] >= 10 and tasks[0][1] == 20_000


def test_finished_files_are_archived_and_not_read_again(spark):
    root = fresh_dir(spark, "test-archive")
    layers = Layers(root)
    table, checkpoint = layers.table("bronze", "x"), layers.checkpoint("bronze", "x")
    schema = "id string"

    def land(i):
        write_csv(spark.createDataFrame([(str(i),)], schema).coalesce(1), layers.landing("x"))

    def ingest():
        stream = stream_csv(spark, layers.landing("x"), spark.createDataFrame([], schema).schema, archive=layers.archive("x"))
        append_available(stream, table, checkpoint)
        return sorted(r.id for r in read_table(spark, table).collect())

    def landed():
        folder = layers.landing("x").removeprefix("file:")
        return [f for f in os.listdir(folder) if f.endswith(".csv")]
    land(0)
    assert ingest() == ["0"]
    land(1)
    assert ingest() == ["0", "1"] and len(landed()) == 1                     # the first file has gone
    land(2)
    assert ingest() == ["0", "1", "2"] and len(landed()) == 1
    assert ingest() == ["0", "1", "2"] and ingest() == ["0", "1", "2"]
    archived = [f for _, _, files in os.walk(layers.archive("x").removeprefix("file:")) for f in files if f.endswith(".csv")]
    assert len(archived) + len(landed()) == 3 and len(archived) >= 2


def test_line_breaks_in_fields_need_the_multiline_form(spark):
    df = spark.createDataFrame([("1", "a\nb")], "id string, note string")
    path = fresh_dir(spark, "test-lines") + "/t"
    write_csv(df, path)
    assert [tuple(r) for r in read_quoted_csv(spark, path, df.schema).collect()] == [("1", "a\nb")]
    assert stream_csv(spark, path, df.schema, multiline=True).isStreaming


def test_publish_without_a_reset_is_no_commit(spark):
    layers = Layers(fresh_dir(spark, "test-no-reset"))
    publish_generations(spark, layers)
    assert open_layers(spark, layers.root) == layers
