"""The silver one-big-table ``results_clean``.

``clean(raw, countries)`` is the single cleaning function for batch and
Structured Streaming alike: row-local projections (C1-C14), two filters
(F1, F2) and two left joins against a broadcast country lookup (J1, J2).
No shuffle of the results themselves happens anywhere in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions import cleaning as C
from paceline.functions.names import normalise_columns
from paceline.operators.joins import enrich_country, maybe_broadcast

# Raw columns that survive into silver, with their fixed silver types.
KEPT_RAW_TYPES = {
    "year_of_event": "int",
    "event_number_of_finishers": "int",
    "athlete_club": "string",
    "athlete_country": "string",
    "athlete_year_of_birth": "double",
    "athlete_gender": "string",
    "athlete_age_category": "string",
    "athlete_id": None,       # stays what it is, unless the caller gives a type
}

# Raw columns that cleaning reads; others are carried along.
RAW_COLUMNS = [*KEPT_RAW_TYPES, "event_distance_length", "event_dates", "event_name", "athlete_performance",
               "athlete_average_speed"]

SILVER_COLUMNS = [
    "year_of_event", "event_number_of_finishers", "athlete_club", "athlete_country",
    "athlete_year_of_birth", "athlete_gender", "athlete_age_category", "athlete_id",
    "event_unit", "event_type", "event_distance_numeric", "performance_hours",
    "performance_km", "athlete_country_code", "athlete_country_name", "event_country",
    "event_country_code", "event_country_name", "event_name_clean",
    "athlete_avg_speed_kmh", "athlete_age", "event_start_date",
    "athlete_gender_label", "event_id",
]


def union_feeds(main: DataFrame, second: DataFrame) -> DataFrame:
    """U1 + P1: normalise names of both feeds, union by name, missing -> null."""
    return normalise_columns(main).unionByName(normalise_columns(second), allowMissingColumns=True)


def typed(column: str, source: str, target: str | None) -> F.Column:
    """A raw column in its silver type; text that does not fit becomes null,
    and whole numbers written with decimals ("2018.0") are read as numbers."""
    col = F.col(f"`{column}`")
    if target is None:
        return col
    if source == "string" and target in ("int", "bigint"):
        return F.coalesce(col.try_cast(target), col.try_cast("double").try_cast(target))
    return col.try_cast(target)


def parse_results(raw: DataFrame, id_type: str | None = None) -> DataFrame:
    """C1-C13 on normalised raw rows, before any filter or join.  Missing raw
    columns are null, further ones are carried along.

    Two projections: the first binds the performance split once so the
    hour arithmetic does not re-split the text per branch.
    """
    if "event_distance/length" in raw.columns:          # D5: rename at once
        raw = raw.withColumnRenamed("event_distance/length", "event_distance_length")
    for missing in [c for c in RAW_COLUMNS if c not in raw.columns]:
        raw = raw.withColumn(missing, F.lit(None).cast("string"))

    dist = F.col("event_distance_length")
    source = dict(raw.dtypes)
    targets = KEPT_RAW_TYPES | {"athlete_id": id_type}
    kept = [typed(c, source[c], t).alias(c) for c, t in targets.items() if c not in ("athlete_club", "athlete_gender")]
    extra = [F.col(f"`{c}`") for c in extra_columns(raw)]
    stage1 = raw.select(
        *kept,
        *extra,
        F.col("event_distance_length"),
        F.col("event_dates"),
        F.col("event_name"),
        F.col("athlete_performance").cast("string").alias("athlete_performance"),
        F.col("athlete_average_speed").cast("string").alias("athlete_average_speed"),
        C.event_unit(dist).alias("event_unit"),
        C.leading_number(dist).alias("event_distance_numeric"),
        C.performance_clean(F.col("athlete_performance")).alias("performance_clean"),
        C.average_speed_kmh(F.col("athlete_average_speed")).alias("athlete_avg_speed_kmh"),
        C.blank_to_null(F.col("athlete_club").cast("string")).alias("athlete_club"),
        C.gender_code(F.col("athlete_gender").cast("string")).alias("athlete_gender"),
    )
    unit = F.col("event_unit")
    stage2 = stage1.select(
        "*",
        C.event_type(dist, unit).alias("event_type"),
        C.time_parts(F.col("performance_clean")).alias("_time_parts"),
        C.event_country(F.col("event_name")).alias("event_country"),
        C.event_name_clean(F.col("event_name")).alias("event_name_clean"),
        C.athlete_age(F.col("year_of_event"), F.col("athlete_year_of_birth")).alias("athlete_age"),
        C.event_start_date(F.col("event_dates")).alias("event_start_date"),
        C.gender_label(F.col("athlete_gender")).alias("athlete_gender_label"),
    )
    return stage2.select(
        "*",
        C.performance_hours(unit, F.col("_time_parts")).alias("performance_hours"),
        C.performance_km(unit, F.col("performance_clean")).alias("performance_km"),
    ).drop("_time_parts")


def extra_columns(raw: DataFrame) -> list[str]:
    """Source columns that cleaning neither reads nor makes itself."""
    return [c for c in raw.columns if c not in {*RAW_COLUMNS, *SILVER_COLUMNS, "event_distance/length"}]


def day_race_filter() -> F.Column:
    """drop multi-day races ("6d"); null distances drop too (3-valued)."""
    return ~F.col("event_distance_length").rlike(C.DAYS_PATTERN)


def validity_filter() -> F.Column:
    """distance races need hours, time races need km (3-valued logic)."""
    unit = F.col("event_unit")
    return (~(unit.isin("km", "mi") & F.col("performance_hours").isNull())
            & ~((unit == "h") & F.col("performance_km").isNull()))


def clean(raw: DataFrame, countries: DataFrame, id_type: str | None = None) -> DataFrame:
    """Normalised raw rows + country lookup -> silver rows (SILVER_COLUMNS,
    then the source's further columns)."""
    parsed = parse_results(raw, id_type).filter(day_race_filter()).filter(validity_filter())
    lookup = maybe_broadcast(countries.select("country_code", "country_name"))
    enriched = enrich_country(parsed, lookup, "athlete_country", "athlete")
    enriched = enrich_country(enriched, lookup, "event_country", "event")
    return enriched.select(
        *[c for c in SILVER_COLUMNS if c != "event_id"],
        C.sha256_hex(F.col("event_name_clean")).alias("event_id"),
        *[F.col(f"`{c}`") for c in extra_columns(raw)],
    )
