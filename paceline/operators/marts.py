"""Views R6-R7 and marts R8-R11, A10 over the star schema.

Marts that aggregate anyway first reduce the fact to its grain in the join
key (per athlete, per event, per event-and-date) with a two-phase
aggregate.  The partial aggregate runs map-side, so a hot key -- one
athlete or event holding a third of all rows -- leaves each map task as a
single row, and the dimension join that follows sees far fewer rows.  The
join strategy itself is left to AQE, which measures both sides at runtime
(broadcast when small, sort-merge with skew splitting otherwise).

The views (R6, R7) must return every fact row, so they join at row level
with ``skew_safe_join``: a dimension proven small is broadcast (the fact is
not shuffled), a large one is joined with its hot keys (more rows than
HOT_KEY_ROWS) salted over several tasks.  The unit filter applies first.
Over a clustered star (fact and athletes in the same buckets of the athlete)
the athletes are joined in place instead, without a shuffle of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.operators.joins import (BROADCAST_BYTES, HOT_KEY_ROWS, co_located_join, maybe_broadcast,
                                      skew_safe_join)
from paceline.operators.model import StarSchema

DISTANCE_VIEW_COLUMNS = [
    "event_id", "athlete_id", "year_of_event", "event_start_date", "performance_hours",
    "event_number_of_finishers", "event_name_clean", "event_distance_length", "event_unit",
    "event_country", "athlete_gender", "athlete_age_category", "athlete_country_name",
    "athlete_year_of_birth",
]

TIME_VIEW_COLUMNS = [
    "event_id", "athlete_id", "year_of_event", "event_start_date", "performance_km",
    "athlete_avg_speed_kmh", "event_number_of_finishers", "event_name_clean",
    "event_distance_length", "event_unit", "event_country", "athlete_gender",
    "athlete_age_category", "athlete_country_name", "athlete_year_of_birth",
]

_VIEW_ATHLETE_COLUMNS = ["athlete_id", "athlete_gender", "athlete_age_category",
                         "athlete_country_name", "athlete_year_of_birth"]
_VIEW_EVENT_COLUMNS = ["event_id", "event_name_clean", "event_distance_length",
                       "event_unit", "event_country"]


def _race_view(star: StarSchema, fact_cols: list[str], unit_filter, out_cols: list[str],
               hot_rows: int = HOT_KEY_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    events = star.events.select(*_VIEW_EVENT_COLUMNS).filter(unit_filter)
    athletes = star.athletes.select(*_VIEW_ATHLETE_COLUMNS)
    fact = star.fact.select(*fact_cols)
    if star.co_located:
        joined = co_located_join(fact, athletes, "athlete_id", hot_rows=hot_rows)
        return joined.join(maybe_broadcast(events, broadcast_bytes), "event_id").select(*out_cols)
    with_events = skew_safe_join(fact, events, "event_id", counts_from=star.fact.select("event_id"),
                                 hot_rows=hot_rows, broadcast_bytes=broadcast_bytes)
    joined = skew_safe_join(with_events, athletes, "athlete_id",
                            counts_from=star.fact.select("athlete_id"), hot_rows=hot_rows,
                            broadcast_bytes=broadcast_bytes)
    return joined.select(*out_cols)


def distance_races(star: StarSchema, hot_rows: int = HOT_KEY_ROWS,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Results of events whose (dimension) unit is km or mi."""
    return _race_view(
        star, ["event_id", "athlete_id", "year_of_event", "event_start_date",
               "performance_hours", "event_number_of_finishers"],
        F.col("event_unit").isin("km", "mi"), DISTANCE_VIEW_COLUMNS, hot_rows, broadcast_bytes)


def time_races(star: StarSchema, hot_rows: int = HOT_KEY_ROWS,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Results of events whose (dimension) unit is h."""
    return _race_view(
        star, ["event_id", "athlete_id", "year_of_event", "event_start_date",
               "performance_km", "athlete_avg_speed_kmh", "event_number_of_finishers"],
        F.col("event_unit") == "h", TIME_VIEW_COLUMNS, hot_rows, broadcast_bytes)


def _share_pct(count_col: str) -> F.Column:
    """round(n * 100.0 / total-over-all-rows, 2) in decimal, then double.

    The window has no partition key: it runs on the already aggregated,
    bounded mart (one row per group), never on fact rows.
    """
    total = F.sum(count_col).over(Window.partitionBy())
    pct = F.round(F.col(count_col).cast("decimal(20,0)") * F.expr("100.0") / total, 2)
    return pct.cast("double")


def country_representation(star: StarSchema, ordered: bool = False) -> DataFrame:
    """Unique runners and starts per athlete country, share of runners."""
    per_athlete = star.fact.groupBy("athlete_id").agg(F.count(F.lit(1)).alias("_starts"))
    athletes = star.athletes.select("athlete_id", "athlete_country_name", "athlete_country")
    by_country = (per_athlete.join(athletes, "athlete_id")
                  .groupBy("athlete_country_name", "athlete_country")
                  .agg(F.count(F.lit(1)).alias("unique_runners"),   # one row per athlete
                       F.sum("_starts").alias("starts")))
    out = by_country.select("*", _share_pct("unique_runners").alias("share_pct"))
    return out.orderBy(F.desc("unique_runners")) if ordered else out


def event_distance(star: StarSchema) -> DataFrame:
    """Participants and distinct events per (distance, unit, type)."""
    per_event = star.fact.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n"))
    events = star.events.select("event_id", "event_distance_length", "event_unit", "event_type")
    return (per_event.join(events, "event_id")
            .groupBy("event_distance_length", "event_unit", "event_type")
            .agg(F.sum("_n").alias("participants"),
                 F.count(F.lit(1)).alias("unique_events")))       # one row per event


def events_per_year(star: StarSchema, ordered: bool = False) -> DataFrame:
    """Distinct events and starts per calendar month, country and type."""
    per_event_day = (star.fact.groupBy("event_id", "event_start_date")
                     .agg(F.count(F.lit(1)).alias("_n")))
    events = star.events.select("event_id", "event_country", "event_type")
    dates = star.dates.select("date_id", "year", "quarter", "month", "month_name")
    joined = (per_event_day.join(events, "event_id")
              .join(dates, per_event_day["event_start_date"] == dates["date_id"]))
    out = (joined.groupBy("year", "quarter", "month", "month_name", "event_country", "event_type")
           .agg(F.count_distinct("event_id").alias("unique_events"),
                F.sum("_n").alias("starts")))
    return out.orderBy("year", "month") if ordered else out


def gender_distribution(star: StarSchema) -> DataFrame:
    """Participants per event year and (latest) athlete gender."""
    per_athlete_year = (star.fact.groupBy("athlete_id", "year_of_event")
                        .agg(F.count(F.lit(1)).alias("_n")))
    athletes = star.athletes.select("athlete_id", "athlete_gender")
    return (per_athlete_year.join(athletes, "athlete_id")
            .groupBy("year_of_event", "athlete_gender")
            .agg(F.sum("_n").alias("participants")))


def gender_share(distribution: DataFrame, ordered: bool = False) -> DataFrame:
    """A10: totals per gender re-aggregated from R11, with share of all."""
    totals = distribution.groupBy("athlete_gender").agg(
        F.sum("participants").alias("total_participants"))
    out = totals.select("*", _share_pct("total_participants").alias("percentage"))
    return out.orderBy(F.desc("total_participants")) if ordered else out
