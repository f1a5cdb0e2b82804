"""Streaming registry keys: land the derived feed as CSV, run the pipeline.

Each call takes a fresh folder under the shared checkpoint directory for
landing files, tables and checkpoints, so runs never see each other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.session import fresh_dir
from paceline.operators.clean import union_feeds
from paceline.sources.catalog import Catalog
from paceline.sources.csv import read_quoted_csv, stream_csv_inferred, write_csv
from paceline.sources.feed import country_lookup, race_feeds
from paceline.sources.tables import Layers, append_available, open_layers, read_table
from paceline.streaming import pipeline as P

# The main feed arrives in two drops: events up to this year, then the rest.
FIRST_DROP_LAST_YEAR = 1997

# The derived feed's athlete ids are numbers.
ID_TYPE = "bigint"


def land_first_drop(spark: SparkSession, layers: Layers, sf_dir: str) -> None:
    main, second = race_feeds(spark, sf_dir)
    write_csv(main.filter(F.col("Year of event") <= FIRST_DROP_LAST_YEAR), layers.landing(P.MAIN))
    write_csv(second, layers.landing(P.SECOND))
    write_csv(country_lookup(spark, sf_dir), layers.landing(P.COUNTRIES))


def land_second_drop(spark: SparkSession, layers: Layers, sf_dir: str) -> None:
    main, _ = race_feeds(spark, sf_dir)
    year = F.col("Year of event")
    write_csv(main.filter((year > FIRST_DROP_LAST_YEAR) | year.isNull()), layers.landing(P.MAIN))


def q_stream_results_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of the main feed, each through bronze and silver."""
    layers = Layers(fresh_dir(spark, "stream"))
    land_first_drop(spark, layers, sf_dir)
    schemas = P.probe_schemas(spark, layers)
    P.ingest_all(spark, layers, schemas)
    P.refresh_silver(spark, layers, ID_TYPE)
    land_second_drop(spark, layers, sf_dir)
    P.ingest_all(spark, layers, schemas)
    P.refresh_silver(spark, layers, ID_TYPE)
    return read_table(spark, layers.table("silver", "results_clean"))


def q_refresh_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full DAG twice (second drop in between), then a mart over gold tables."""
    layers = Layers(fresh_dir(spark, "refresh"))
    land_first_drop(spark, layers, sf_dir)
    schemas = P.probe_schemas(spark, layers)
    P.run_once(spark, layers, schemas, ID_TYPE)
    land_second_drop(spark, layers, sf_dir)
    P.run_once(spark, layers, schemas, ID_TYPE)
    P.register_gold_views(spark, P.gold_star(spark, layers))
    return spark.table("events_per_year").orderBy("year", "month")


def _prefix() -> str:
    """Schemas of this call only."""
    return f"run_{uuid.uuid4().hex[:12]}_"


def _two_drops(spark: SparkSession, sf_dir: str, label: str) -> tuple[Layers, dict]:
    """The whole DAG after each drop of the main feed; finished files archived."""
    layers = Layers(fresh_dir(spark, label))
    land_first_drop(spark, layers, sf_dir)
    schemas = P.probe_schemas(spark, layers)
    P.run_once(spark, layers, schemas, ID_TYPE, archive=True)
    land_second_drop(spark, layers, sf_dir)
    P.run_once(spark, layers, schemas, ID_TYPE, archive=True)
    return layers, schemas


def q_merged_dim_athlete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The athletes of two drops, merged batch by batch."""
    layers, _ = _two_drops(spark, sf_dir, "merged")
    return P.gold_star(spark, layers).athletes


def q_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of the catalog with its comment and rows, as a
    catalog attached from the saved definitions tells them."""
    layers, _ = _two_drops(spark, sf_dir, "catalog")
    P.publish(spark, layers, _prefix())
    catalog = Catalog.attach(spark, layers.root, _prefix())
    parts = [catalog.table(layer, name).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("name"), F.lit(catalog.comment(layer, name)).alias("comment"), "n_rows")
        for layer, names in P.COMMENTS.items() for name in names]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _view(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layers, _ = _two_drops(spark, sf_dir, "views")
        return P.publish(spark, layers, _prefix()).table("gold", name)
    query.__doc__ = f"S9: the persistent view {name}, read by its name in the catalog."
    return query


def q_sql_stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, S5 in SQL: bronze, silver and facts each fed by SELECT ... FROM STREAM."""
    layers = Layers(fresh_dir(spark, "sql"))
    land_first_drop(spark, layers, sf_dir)
    land_second_drop(spark, layers, sf_dir)
    catalog = Catalog(spark, layers.root, _prefix())
    catalog.create_schemas()
    P.ingest_sql(spark, layers, catalog, P.probe_schemas(spark, layers))
    P.refresh_silver_sql(spark, layers, catalog, ID_TYPE)
    P.refresh_facts_sql(spark, layers, catalog)
    return catalog.table("gold", "fct_results")


def q_reset_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold reset after both drops, rebuilt and published."""
    layers, schemas = _two_drops(spark, sf_dir, "reset")
    P.rebuild(spark, layers.root, "silver.results_clean", schemas, ID_TYPE)
    return read_table(spark, open_layers(spark, layers.root).table("gold", "fct_results"))


def q_quoted_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed with a quoted, multi-line note, through CSV and back."""
    raw = union_feeds(*race_feeds(spark, sf_dir))
    note = F.concat(F.lit('Finished "'), F.col("event_name"), F.lit('", split\n'),
                    F.coalesce(F.col("athlete_performance"), F.lit("")))
    rows = raw.withColumn("note", note)
    path = fresh_dir(spark, "quoted") + "/results"
    write_csv(rows, path)
    return read_quoted_csv(spark, path, schema=rows.schema)


def q_country_code_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the lookup landed as CSV and streamed with inferred types."""
    layers = Layers(fresh_dir(spark, "lookup"))
    write_csv(country_lookup(spark, sf_dir), layers.landing(P.COUNTRIES))
    append_available(stream_csv_inferred(spark, layers.landing(P.COUNTRIES)), layers.table("bronze", P.COUNTRIES),
                     layers.checkpoint("bronze", P.COUNTRIES))
    return read_table(spark, layers.table("bronze", P.COUNTRIES))


STREAM_QUERIES = {
    "stream_results_clean": q_stream_results_clean,
    "refresh_marts": q_refresh_marts,
    "merged_dim_athlete": q_merged_dim_athlete,
    "catalog_tables": q_catalog_tables,
    "view_distance_races": _view("distance_races"),
    "view_country_representation": _view("country_representation"),
    "sql_stream_facts": q_sql_stream_facts,
    "reset_rebuild": q_reset_rebuild,
    "quoted_csv_scan": q_quoted_csv_scan,
    "country_code_stream": q_country_code_stream,
}
