"""Cleaning expressions C1-C17: each a pure ``Column -> Column`` function.

All are built-in Spark expressions (whole-stage codegen, no Python at run
time) and safe under ANSI mode: text is only ever converted with
``try_cast`` or after a shape check, array items are read with ``get``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and labels the cleaned data must agree on.
UNIT_PATTERN = r"(km|mi|h)"                      # unanchored: "Marathon" -> "h"
STAGE_PATTERN = r"Etappen"
DAYS_PATTERN = r"^\d+d$"
LEADING_NUMBER = r"^([\d.]+)"
LEADING_TIME = r"^([\d:\.]+)"
TRAILING_PAREN = r"\(([^)]+)\)$"
TRAILING_PAREN_WITH_SPACE = r"\s*\([^)]+\)$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
DOTTED_DATE = r"^\d{2}\.\d{2}\.\d{4}\z"
DAY_SPAN = r"^\d{2}\.-\d{2}\.\d{2}\.\d{4}\z"
DAY_MONTH_SPAN = r"^\d{2}\.\d{2}\.-\d{2}\.\d{2}\.\d{4}\z"
LOOSE_DAY_SPAN = r"\d{2}\.-\d{2}\.\d{2}\.\d{4}"  # shape label only, unanchored
EVENT_TYPES = ("multi_stage", "time_based", "distance_based", "unknown")
GENDER_LABELS = {"F": "female", "M": "male", "X": "other"}
DATE_SHAPES = ("single", "interval", "unknown")


def event_unit(distance: Column) -> Column:
    """First km / mi / h anywhere in the text; '' if none, null if null."""
    return F.regexp_extract(distance, UNIT_PATTERN, 1)


def event_type(distance: Column, unit: Column) -> Column:
    """Stage races win over day races, over hours, over km/mi."""
    return (F.when(distance.rlike(STAGE_PATTERN), F.lit("multi_stage"))
            .when(distance.rlike(DAYS_PATTERN), F.lit("time_based"))
            .when(unit == "h", F.lit("time_based"))
            .when(unit.isin("km", "mi"), F.lit("distance_based"))
            .otherwise(F.lit("unknown")))


def leading_number(distance: Column) -> Column:
    """The leading number of the distance text as double, else null."""
    return F.regexp_extract(distance, LEADING_NUMBER, 1).try_cast("double")


def performance_clean(performance: Column) -> Column:
    """C4: leading run of digits, colons and dots ('' if none)."""
    return F.regexp_extract(performance, LEADING_TIME, 1)


def time_parts(clean: Column) -> Column:
    """The ':'-split of C4; bind it once in a projection and reuse it."""
    return F.split(clean, ":")


def performance_hours(unit: Column, parts: Column) -> Column:
    """H:MM:SS or H:MM (two parts are hours and minutes) -> hours.

    Only for km / mi events; anything else, or other shapes, is null.
    """
    def part(i: int) -> Column:
        return F.get(parts, i).try_cast("double")

    n = F.size(parts)
    hours = (F.when(n == 3, part(0) + part(1) / 60 + part(2) / 3600)
             .when(n == 2, part(0) + part(1) / 60))
    return F.when(unit.isin("km", "mi"), hours)


def performance_km(unit: Column, clean: Column) -> Column:
    """Distance covered, only for time-limited (h) events."""
    return F.when(unit == "h", clean.try_cast("double"))


def event_country(name: Column) -> Column:
    """Text of the last parenthesis when it ends the name, else ''."""
    return F.regexp_extract(name, TRAILING_PAREN, 1)


def event_name_clean(name: Column) -> Column:
    """The name without its trailing parenthesis."""
    return F.regexp_replace(name, TRAILING_PAREN_WITH_SPACE, "")


def average_speed_kmh(speed: Column) -> Column:
    """Every comma becomes a dot, then double (null when not a number)."""
    return F.regexp_replace(speed.cast("string"), ",", ".").try_cast("double")


def athlete_age(year: Column, birth_year: Column) -> Column:
    """Event year minus whole birth year; null without a birth year."""
    return F.when(birth_year.isNotNull(), year - birth_year.try_cast("int"))


def blank_to_null(text: Column) -> Column:
    """Blank (after trimming) text becomes null."""
    return F.when(F.trim(text) == "", F.lit(None).cast("string")).otherwise(text)


def _calendar_date(year: Column, month: Column, day: Column) -> Column:
    """The date of digit-only parts, or null when it is not a calendar day.

    Same result as parsing 'dd.MM.yyyy' with try_to_date, but checked
    arithmetically: no parse exception per bad row ("00.00.1989",
    "31.02.2020"), which under try_to_date costs more than all the regex
    work of the row.  ``&`` short-circuits, so make_date only ever sees a
    valid month, and the final make_date a valid day.
    """
    y, m, d = (c.cast("int") for c in (year, month, day))
    month_ok = (y >= 0) & (m >= 1) & (m <= 12)
    day_ok = (d >= 1) & (d <= F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1)))))
    return F.when(month_ok & day_ok, F.make_date(y, m, d))


def event_start_date(dates: Column) -> Column:
    """C11: first day of the event from four text shapes, else null.

    Span shapes take month/year (or year) from the END of the text, so a
    span across New Year gets the later year.  Impossible dates are null.
    The shape regex fixes every digit position, so parts are substrings.
    """
    def part(pos: int, length: int) -> Column:
        return F.substring(dates, pos, length)

    return (F.when(dates.rlike(ISO_DATE), _calendar_date(part(1, 4), part(6, 2), part(9, 2)))
            .when(dates.rlike(DOTTED_DATE), _calendar_date(part(7, 4), part(4, 2), part(1, 2)))
            .when(dates.rlike(DAY_SPAN), _calendar_date(part(11, 4), part(8, 2), part(1, 2)))
            .when(dates.rlike(DAY_MONTH_SPAN), _calendar_date(part(14, 4), part(4, 2), part(1, 2))))


def gender_code(gender: Column) -> Column:
    """W and F are the same code; F is kept."""
    return F.when(gender == "W", F.lit("F")).otherwise(gender)


def gender_label(code: Column) -> Column:
    """Readable label of the gender code; unknown codes -> null."""
    expr = None
    for key, label in GENDER_LABELS.items():
        expr = F.when(code == key, F.lit(label)) if expr is None else expr.when(code == key, F.lit(label))
    return expr


def sha256_hex(text: Column) -> Column:
    """C14: SHA-256 hex digest (null in, null out)."""
    return F.sha2(text, 256)


def result_key(event_id: Column, athlete_id: Column, year: Column) -> Column:
    """SHA-256 of event|athlete|year; null parts are skipped."""
    return F.sha2(F.concat_ws("|", event_id, athlete_id.cast("string"), year.cast("string")), 256)


def date_shape(dates: Column) -> Column:
    """Coarse shape label of the raw date text."""
    return (F.when(dates.rlike(DOTTED_DATE), F.lit("single"))
            .when(dates.rlike(LOOSE_DAY_SPAN), F.lit("interval"))
            .otherwise(F.lit("unknown")))


def date_diagnostics(dates: Column) -> dict[str, Column]:
    """C17: whole-match columns, parts, length and hex of the raw date text."""
    return {
        "match_single": F.regexp_extract(dates, DOTTED_DATE, 0),
        "match_day_span": F.regexp_extract(dates, DAY_SPAN, 0),
        "match_day_month_span": F.regexp_extract(dates, DAY_MONTH_SPAN, 0),
        "start_day": F.regexp_extract(dates, r"^(\d{2})\.-", 1),
        "month_year": F.regexp_extract(dates, r"\d{2}\.(\d{2}\.\d{4})$", 1),
        "text_length": F.length(dates),
        "text_hex": F.hex(dates),
        "has_dash": dates.contains("-"),
    }
