"""Incremental medallion pipeline T1-T6 on Structured Streaming.

bronze  CSV landing folders -> parquet append tables (T1, one per source);
        finished files move to an archive folder
silver  union of both bronze streams, ``clean`` with the static country
        lookup (stream-static left join, broadcast after a size check)
gold    ``fct_results`` appended from the silver stream (pure projection);
        dimensions as mergeable aggregates: each micro-batch of new silver rows
        is aggregated and merged into the last version (T6, S8)

Each step is an ``availableNow`` query with its own checkpoint, run in
DAG order (T5).  Checkpoints and tables live under one ``Layers`` root in
the shared checkpoint folder, so a lost executor or driver restart resumes
from the last committed micro-batch instead of recomputing.

``reset`` rebuilds a dataset and all that is made from it in a new generation
beside the old one (S11).  ``publish`` puts the datasets into a catalog.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paceline.functions.names import normalise_columns
from paceline.operators import marts
from paceline.operators.clean import clean, union_feeds
from paceline.operators.model import (DIMENSIONS, FACT_COLUMNS, StarSchema, dim_athlete, dim_date, dim_event,
                                      fct_results)
from paceline.plans.views import VIEWS
from paceline.sources.catalog import Catalog
from paceline.sources.csv import header_schema, stream_csv
from paceline.sources.tables import (Layers, Versions, append_available, current_version, next_generation, open_layers,
                                     publish_generations, read_current, read_table, register_views, stream_table,
                                     with_comment)

MAIN, SECOND, COUNTRIES = "raw_results", "raw_second_results", "raw_country_code"
SOURCES = (MAIN, SECOND, COUNTRIES)

# What each table holds.
COMMENTS = {
    "bronze": {MAIN: "Results as landed, main feed", SECOND: "Results as landed, second feed",
               COUNTRIES: "Country codes and names as landed"},
    "silver": {"results_clean": "Cleaned results of both feeds with country names"},
    "gold": {"fct_results": "One row per result", "dim_athlete": "Latest attributes of each athlete",
             "dim_event": "Attributes of each event", "dim_date": "Calendar of the start dates"},
}

# What is made from what: a reset of the left moves the right too.  The
# dimensions share one stream over silver, whose checkpoint is ``dimensions``.
_GOLD = ["gold.fct_results", "gold.dimensions", *[f"gold.{name}" for name in DIMENSIONS]]
_MADE_FROM = {"silver.results_clean": ["silver.results_clean", *_GOLD], "gold.fct_results": ["gold.fct_results"],
              **{d: _GOLD[1:] for d in _GOLD[1:]},
              **{f"bronze.{source}": [f"bronze.{source}", "silver.results_clean", *_GOLD] for source in SOURCES}}


def ingest(spark: SparkSession, layers: Layers, source: str, schema: StructType,
           batch: dict[str, str] | None = None, archive: bool = False) -> None:
    """New landed CSV files of one source -> its bronze table.  With
    ``archive``, files whose batch is done leave the landing folder."""
    stream = stream_csv(spark, layers.landing(source), schema, batch=batch,
                        archive=layers.archive(source) if archive else None)
    append_available(with_comment(stream, COMMENTS["bronze"][source]), layers.table("bronze", source),
                     layers.checkpoint("bronze", source))


def ingest_all(spark: SparkSession, layers: Layers, schemas: dict[str, StructType],
               batch: dict[str, str] | None = None, archive: bool = False) -> None:
    for source in SOURCES:
        ingest(spark, layers, source, schemas[source], batch, archive)


def probe_schemas(spark: SparkSession, layers: Layers, probe_paths: dict[str, str] | None = None
                  ) -> dict[str, StructType]:
    """S1 for every source: names from the header, all columns string."""
    probe_paths = probe_paths or {}
    return {s: header_schema(spark, probe_paths.get(s, layers.landing(s))) for s in SOURCES}


def silver_stream(spark: SparkSession, layers: Layers, id_type: str | None = None,
                  batch: dict[str, str] | None = None) -> DataFrame:
    """Union both bronze streams, clean, enrich from the static lookup.
    ``id_type`` types the athlete ids, which stay text without it."""
    main = stream_table(spark, layers.table("bronze", MAIN), batch)
    second = stream_table(spark, layers.table("bronze", SECOND), batch)
    countries = normalise_columns(read_table(spark, layers.table("bronze", COUNTRIES)))
    return clean(union_feeds(main, second), countries, id_type)


def append_table(df: DataFrame, layers: Layers, layer: str, name: str) -> None:
    """S7 with the table's own checkpoint and comment."""
    append_available(with_comment(df, COMMENTS[layer][name]), layers.table(layer, name), layers.checkpoint(layer, name))


def refresh_silver(spark: SparkSession, layers: Layers, id_type: str | None = None) -> None:
    append_table(silver_stream(spark, layers, id_type), layers, "silver", "results_clean")


def refresh_facts(spark: SparkSession, layers: Layers) -> None:
    """T5: the fact table appended from the silver stream."""
    silver = stream_table(spark, layers.table("silver", "results_clean"))
    append_table(fct_results(silver), layers, "gold", "fct_results")


# ------------------------------------------------- S3 and S5 as SQL text

FACTS_SQL = f"""
SELECT sha2(concat_ws('|', event_id, CAST(athlete_id AS STRING), CAST(year_of_event AS STRING)), 256) AS result_id,
       {", ".join(FACT_COLUMNS[1:])}
FROM STREAM ${{silver}}.results_clean"""


def ingest_sql(spark: SparkSession, layers: Layers, catalog: Catalog, schemas: dict[str, StructType]) -> None:
    """S3 in SQL: each landing folder is a streaming view, and its table is a SELECT over it."""
    for source in SOURCES:
        stream_csv(spark, layers.landing(source), schemas[source]).createOrReplaceTempView(f"landed_{source}")
        append_table(spark.sql(f"SELECT * FROM STREAM landed_{source}"), layers, "bronze", source)
        _put(spark, layers, catalog, "bronze", source)


def refresh_silver_sql(spark: SparkSession, layers: Layers, catalog: Catalog, id_type: str | None = None) -> None:
    """S5 in SQL: silver from STREAM reads of the bronze tables in the catalog."""
    feeds = [spark.sql(f"SELECT * FROM STREAM {catalog.name('bronze', source)}") for source in (MAIN, SECOND)]
    countries = normalise_columns(catalog.table("bronze", COUNTRIES))
    append_table(clean(union_feeds(*feeds), countries, id_type), layers, "silver", "results_clean")
    _put(spark, layers, catalog, "silver", "results_clean")


def refresh_facts_sql(spark: SparkSession, layers: Layers, catalog: Catalog) -> None:
    """The fact table as one SELECT over STREAM silver."""
    append_table(spark.sql(catalog.sql(FACTS_SQL)), layers, "gold", "fct_results")
    _put(spark, layers, catalog, "gold", "fct_results")


# ------------------------------------------------------------ dimensions

def refresh_dimensions(spark: SparkSession, layers: Layers, keep: int = 2) -> None:
    """T6 + S8: each dimension's last version merged with the new silver rows.

    Only silver files that no earlier refresh has read are read.  A version
    says which micro-batch it includes: a batch that is replayed after a crash
    is merged into the dimensions that lack it and no other.  All but the last
    ``keep`` versions are emptied.
    """
    def merge(batch: DataFrame, number: int) -> None:
        for name, (state_of, merged, _) in DIMENSIONS.items():
            versions = Versions(spark, layers.table("gold", name))
            last = versions.current
            if last is not None and last.batch >= number:
                continue
            state = state_of(batch)
            if last is not None:
                state = merged(spark.read.parquet(last.folder).unionByName(state))
            versions.replace(with_comment(state, COMMENTS["gold"][name]), number, keep)

    silver = layers.table("silver", "results_clean")
    query = (stream_table(spark, silver).writeStream.foreachBatch(merge)
             .option("checkpointLocation", layers.checkpoint("gold", "dimensions")).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if not query.recentProgress or query.lastProgress["numInputRows"] == 0:
        for name, (state_of, _, _) in DIMENSIONS.items():             # no batch ever: empty dimensions
            versions = Versions(spark, layers.table("gold", name))
            if versions.current is None:
                versions.replace(with_comment(state_of(read_table(spark, silver).limit(0)), COMMENTS["gold"][name]))


def recompute_dimensions(spark: SparkSession, layers: Layers, names: tuple[str, ...] = tuple(DIMENSIONS)) -> dict[str, DataFrame]:
    """The dimensions from the whole silver table, lazily: what the merged ones must equal."""
    silver = read_table(spark, layers.table("silver", "results_clean"))
    build = {"dim_athlete": dim_athlete, "dim_event": dim_event, "dim_date": dim_date}
    return {name: build[name](silver) for name in names}


def run_once(spark: SparkSession, layers: Layers, schemas: dict[str, StructType],
             id_type: str | None = None, archive: bool = False) -> None:
    """One refresh of the whole DAG: bronze -> silver -> facts -> dimensions."""
    ingest_all(spark, layers, schemas, archive=archive)
    refresh_silver(spark, layers, id_type)
    refresh_facts(spark, layers)
    refresh_dimensions(spark, layers)


def gold_star(spark: SparkSession, layers: Layers) -> StarSchema:
    """The persisted star schema, read back as static tables."""
    dims = [read_current(spark, layers.table("gold", name)).select(*columns) for name, (_, _, columns) in DIMENSIONS.items()]
    return StarSchema(read_table(spark, layers.table("gold", "fct_results")), *dims)


# ------------------------------------------------------ reset and publish

def reset(spark: SparkSession, layers: Layers, dataset: str) -> Layers:
    """``dataset`` ("layer.name") and all that is made from it, empty and
    in a new generation.  Refresh the layers that this returns, then
    ``publish_generations``: from then on ``open_layers`` finds the new
    tables with their checkpoints.  After a crash before that, the old
    generation is still the one that counts, whole; call ``reset`` again.
    Bronze tables are rebuilt from the files that are in the landing folder.
    """
    if dataset not in _MADE_FROM:
        raise ValueError(f"unknown dataset {dataset}: one of {sorted(_MADE_FROM)}")
    return next_generation(layers, _MADE_FROM[dataset])


def rebuild(spark: SparkSession, root: str, dataset: str, schemas: dict[str, StructType],
            id_type: str | None = None) -> Layers:
    """``reset``, a refresh and the commit in one call."""
    layers = reset(spark, open_layers(spark, root), dataset)
    run_once(spark, layers, schemas, id_type)
    publish_generations(spark, layers)
    return layers


def _put(spark: SparkSession, layers: Layers, catalog: Catalog, layer: str, name: str) -> None:
    if name in DIMENSIONS:
        version = current_version(spark, layers.table(layer, name))
        catalog.put_table(layer, name, version.folder, COMMENTS[layer][name], DIMENSIONS[name][2])
    else:
        catalog.put_table(layer, name, layers.table(layer, name), COMMENTS[layer][name])


def publish(spark: SparkSession, layers: Layers, prefix: str = "") -> Catalog:
    """All tables of the layers and the six views in the
    catalog, with comments, and their definitions saved under the root.
    Run it after each refresh: dimensions move to their last version."""
    catalog = Catalog(spark, layers.root, prefix)
    catalog.create_schemas()
    for layer, names in COMMENTS.items():
        for name in names:
            _put(spark, layers, catalog, layer, name)
    for name, (comment, text) in VIEWS.items():
        catalog.put_view("gold", name, text, comment)
    catalog.save()
    return catalog


# Of the fact's files, about what one task reads of a clustered copy.
BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(fact: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a copy of ``fact``, from the bytes of its rows."""
    size = fact.agg(F.sum(F.octet_length("result_id") + F.octet_length("event_id") + 64).cast("long")).first()[0] or 0
    return max(1, math.ceil(size / bucket_bytes))


def cluster_by_athlete(catalog: Catalog, star: StarSchema, buckets: int | None = None) -> StarSchema:
    """Copies of the fact and the athletes in the same buckets of the
    athlete, in the catalog as ``fct_by_athlete`` and ``dim_athlete_buckets``.
    The views over the star that this returns join them without shuffling the
    fact.  Results without an athlete, which no view shows, are left out."""
    buckets = buckets or buckets_for(star.fact)
    at = f"{catalog.root}/clustered/{uuid.uuid4().hex}"
    fact = star.fact.filter(F.col("athlete_id").isNotNull())
    return StarSchema(
        catalog.write_bucketed(fact, "gold", "fct_by_athlete", f"{at}/fact", "Results in buckets by athlete",
                               "athlete_id", buckets),
        catalog.write_bucketed(star.athletes, "gold", "dim_athlete_buckets", f"{at}/athletes",
                               "Athletes in the buckets of the results", "athlete_id", buckets),
        star.events, star.dates, co_located=True)


def register_gold_views(spark: SparkSession, star: StarSchema) -> None:
    """S9 in one session: the two race views and the four marts under stable names."""
    register_views(spark, {f.__name__: f(star) for f in (
        marts.distance_races, marts.time_races, marts.country_representation, marts.event_distance,
        marts.events_per_year, marts.gender_distribution)})
