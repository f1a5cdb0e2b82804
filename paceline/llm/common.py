"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.session import fresh_dir

# Word separators of every contract: space and the ASCII controls \t..\r.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def spool(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: later stages and retried tasks read files, and a lost
    executor loses nothing.  Each call has a folder of its own.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is bound to the value; writing the expression several
    times would make Spark evaluate it at each mention inside other lambdas.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text: maximal runs without a separator (null text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def gapless(df: DataFrame, key: Column, order: list[Column], index: str, rows: int,
            rows_per_bucket: int = 50_000) -> DataFrame:
    """Add ``index``: 0, 1, 2, ... without gaps inside every value of ``key``.

    A window over ``key`` alone would put a whole key into one task.  Rows are
    dealt by hash into buckets whose number grows with ``rows``; each bucket is
    numbered by itself and shifted by the sizes of the buckets before it.  The
    table of bucket sizes has (keys x buckets) rows and is small beside ``df``.
    ``order`` must tell rows apart (equal rows are interchangeable).
    """
    buckets = max(1, math.ceil(rows / rows_per_bucket))
    salted = df.withColumn("_k", key).withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = salted.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    from pyspark.sql import Window
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_k").orderBy("_b")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(F.col("_k").alias("_k2"), F.col("_b").alias("_b2"), before.alias("_shift"))
    own = F.row_number().over(Window.partitionBy("_k", "_b").orderBy(*order)) - 1
    return (salted.withColumn("_own", own)
            .join(shifts, F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_b") == F.col("_b2")))
            .withColumn(index, (F.col("_own") + F.col("_shift")).cast("long"))
            .drop("_k", "_b", "_k2", "_b2", "_own", "_shift"))
