"""The published views and marts (R6-R11) as SQL text, for a catalog.

Each gives the rows of its namesake in ``operators.marts``.  Marts count the
fact at the grain of the join key before they join, so a hot athlete or event
is one row a task when it is shuffled.  ``${gold}`` stands for the schema.
"""

from __future__ import annotations

from paceline.operators.marts import DISTANCE_VIEW_COLUMNS, TIME_VIEW_COLUMNS

_RACES = """
WITH races AS (
  SELECT event_id, event_name_clean, event_distance_length, event_unit, event_country
  FROM ${{gold}}.dim_event WHERE {units})
SELECT {columns}
FROM ${{gold}}.fct_results
JOIN races USING (event_id)
JOIN (SELECT athlete_id, athlete_gender, athlete_age_category, athlete_country_name, athlete_year_of_birth
      FROM ${{gold}}.dim_athlete) USING (athlete_id)"""

VIEWS: dict[str, tuple[str, str]] = {
    "distance_races": ("Results of races over a distance, with event and athlete", _RACES.format(
        units="event_unit IN ('km', 'mi')", columns=", ".join(DISTANCE_VIEW_COLUMNS))),
    "time_races": ("Results of races over a time, with event and athlete", _RACES.format(
        units="event_unit = 'h'", columns=", ".join(TIME_VIEW_COLUMNS))),

    "country_representation": ("Runners and starts per athlete country", """
WITH per_athlete AS (SELECT athlete_id, count(*) AS n FROM ${gold}.fct_results GROUP BY athlete_id),
per_country AS (
  SELECT athlete_country_name, athlete_country, count(*) AS unique_runners, sum(n) AS starts
  FROM per_athlete JOIN ${gold}.dim_athlete USING (athlete_id)
  GROUP BY athlete_country_name, athlete_country)
SELECT *, CAST(round(CAST(unique_runners AS DECIMAL(20, 0)) * 100.0 / sum(unique_runners) OVER (), 2) AS DOUBLE)
         AS share_pct
FROM per_country"""),

    "event_distance": ("Participants and events per distance, unit and type", """
WITH per_event AS (SELECT event_id, count(*) AS n FROM ${gold}.fct_results GROUP BY event_id)
SELECT event_distance_length, event_unit, event_type, sum(n) AS participants, count(*) AS unique_events
FROM per_event JOIN ${gold}.dim_event USING (event_id)
GROUP BY event_distance_length, event_unit, event_type"""),

    "events_per_year": ("Events and starts per month, country and type", """
WITH per_day AS (
  SELECT event_id, event_start_date AS date_id, count(*) AS n FROM ${gold}.fct_results GROUP BY ALL)
SELECT year, quarter, month, month_name, event_country, event_type,
       count(DISTINCT event_id) AS unique_events, sum(n) AS starts
FROM per_day JOIN ${gold}.dim_date USING (date_id)
JOIN (SELECT event_id, event_country, event_type FROM ${gold}.dim_event) USING (event_id)
GROUP BY year, quarter, month, month_name, event_country, event_type"""),

    "gender_distribution": ("Participants per event year and gender", """
WITH per_year AS (
  SELECT athlete_id, year_of_event, count(*) AS n FROM ${gold}.fct_results GROUP BY athlete_id, year_of_event)
SELECT year_of_event, athlete_gender, sum(n) AS participants
FROM per_year JOIN ${gold}.dim_athlete USING (athlete_id) GROUP BY year_of_event, athlete_gender"""),
}
