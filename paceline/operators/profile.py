"""Data-quality profiles and exploration aggregates.

Every profile is one aggregate pass with partial aggregation; wide
one-row results are unpivoted into (column, value...) rows with
``unpivot``.  Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject:
each task keeps k rows, the driver merges k x tasks) with a tie-break key.
Floating statistics are rounded to 6 decimals so the result does not
depend on the order partitions are merged in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from paceline.functions import cleaning as C
from paceline.operators.clean import day_race_filter, validity_filter

STAT_DIGITS = 6


def pct_half_up(num: str, den: str, digits: int) -> Column:
    """num * 100 / den rounded half-up to ``digits`` decimals, exactly.

    Integer arithmetic (``div``) instead of rounding a double: no binary
    representation error can move a value across a .5 boundary.
    """
    scale = 10 ** digits
    n, d = f"CAST(`{num}` AS BIGINT)", f"CAST(`{den}` AS BIGINT)"
    q = F.expr(f"({n} * {2 * 100 * scale} + {d}) div (2 * {d})")
    return F.when(F.col(den) != 0, q / F.lit(float(scale)))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, from the schema (no data read)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def null_profile(df: DataFrame) -> DataFrame:
    """Per column, rows that are null or empty text (one pass)."""
    counts = df.agg(*[
        F.count_if(F.col(f"`{c}`").isNull() | (F.col(f"`{c}`").cast("string") == "")).alias(c)
        for c in df.columns
    ])
    return counts.unpivot([], counts.columns, "column_name", "null_or_empty")


def _summary(c: Column) -> list[Column]:
    return [
        F.count(c).alias("count"),
        F.round(F.avg(c), STAT_DIGITS).alias("mean"),
        F.round(F.stddev_samp(c), STAT_DIGITS).alias("stddev"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    ]


def numeric_profile(df: DataFrame) -> DataFrame:
    """P6 + A9: count, mean, stddev, min, max of every numeric column.

    Typed columns (not ``describe``'s strings); one pass for all columns.
    """
    cols = numeric_columns(df)
    wide = df.agg(*[F.struct(*_summary(F.col(f"`{c}`").cast("double"))).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "s")
    return long.select("column_name", "s.count", "s.mean", "s.stddev", "s.min", "s.max")


def age_summary(raw: DataFrame) -> DataFrame:
    """F5 + A9: age statistics over plausible ages (0 < age < 120)."""
    age = F.col("year_of_event") - F.col("athlete_year_of_birth").try_cast("int")
    ages = (raw.filter(F.col("athlete_year_of_birth").isNotNull())
            .select(age.alias("age"))
            .filter((F.col("age") > 0) & (F.col("age") < 120)))
    a = F.col("age")
    return ages.agg(
        F.count(a).alias("count"),
        F.round(F.avg(a), STAT_DIGITS).alias("mean"),
        F.round(F.stddev_samp(a), STAT_DIGITS).alias("stddev"),
        F.min(a).alias("min"),
        F.max(a).alias("max"),
    )


def unique_counts(raw: DataFrame, silver: DataFrame, athletes: DataFrame,
                  events: DataFrame) -> DataFrame:
    """Global counts as (metric, value) rows.

    Each metric is its own two-phase aggregate; a union of one-row results
    avoids the row expansion a multi-distinct aggregate would need.
    """
    parts = [
        raw.agg(F.count(F.lit(1)).alias("value")).select(F.lit("raw_rows").alias("metric"), "value"),
        silver.agg(F.count(F.lit(1)).alias("value")).select(F.lit("fact_rows").alias("metric"), "value"),
        athletes.agg(F.count("athlete_id").alias("value"))
        .select(F.lit("unique_athletes").alias("metric"), "value"),
        events.agg(F.count(F.lit(1)).alias("value")).select(F.lit("unique_events").alias("metric"), "value"),
        raw.select("athlete_country").distinct().agg(F.count(F.lit(1)).alias("value"))
        .select(F.lit("unique_athlete_countries").alias("metric"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def gender_by_event(raw: DataFrame, ordered: bool = False) -> DataFrame:
    """A6 + A7: share of women and men per event name (raw feed).

    Women are both raw codes W and F (the feed codes women W).
    """
    g = F.col("athlete_gender")
    counts = (raw.filter(g.isNotNull() & F.col("event_name").isNotNull())
              .groupBy("event_name")
              .agg(F.count_if(g.isin("W", "F")).alias("women"),
                   F.count_if(g == "M").alias("men"),
                   F.count(F.lit(1)).alias("total")))
    out = counts.select(
        "event_name",
        pct_half_up("women", "total", 1).alias("pct_women"),
        pct_half_up("men", "total", 1).alias("pct_men"),
        "total",
    )
    return out.orderBy(F.desc("total"), "event_name") if ordered else out


def top_k(df: DataFrame, key: str, k: int, count_name: str, keep_null: bool = False) -> DataFrame:
    """O2: the k most frequent values of ``key``; ties by value.  With
    ``keep_null`` the null group counts as a value."""
    return (df.filter(F.lit(True) if keep_null else F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(key))
            .limit(k))


def races_per_year(silver: DataFrame) -> DataFrame:
    """A12 + O1: results per start-date year."""
    d = F.col("event_start_date")
    return (silver.filter(d.isNotNull())
            .groupBy(F.year(d).alias("year"))
            .agg(F.count(F.lit(1)).alias("races"))
            .orderBy("year"))


def value_counts(df: DataFrame, key: Column | str, count_name: str = "results") -> DataFrame:
    """A1: rows per value of one key (or expression)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))


def date_format_counts(raw: DataFrame) -> DataFrame:
    """C16 + A1: rows per shape of the raw date text."""
    return value_counts(raw, C.date_shape(F.col("event_dates")).alias("date_format_type"))


def filter_audit(parsed: DataFrame) -> DataFrame:
    """F6 + F7: rows before and after each silver filter, in one pass."""
    f1 = day_race_filter()
    both = f1 & validity_filter()
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(f1).alias("rows_after_day_filter"),
        F.count_if(both).alias("rows_after_validity_filter"),
        F.count_if(F.col("event_dates").contains("-")).alias("rows_with_dash_dates"),
    ).select(
        "*",
        (F.col("rows_before") - F.col("rows_after_day_filter")).alias("day_rows_removed"),
        (F.col("rows_after_day_filter") - F.col("rows_after_validity_filter")).alias("invalid_rows_removed"),
    )
