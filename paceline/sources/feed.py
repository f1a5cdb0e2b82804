"""Raw race feed derived from the driver tables.

The driver's tables hold no race results, so the raw feed (the shape of the
race-result CSV files) is derived from ``orders JOIN customer`` and
``nation`` with integer arithmetic and string building only.  Every raw
quirk the cleaning must survive appears in it: four date shapes plus an
impossible date, units km/mi/h/d/none, multi-day times, comma decimals,
blank clubs, a missing country code, attributes that change by year.

Scale: one inner equi-join orders -> customer (customer is 1/10 of orders).
No hint is given; AQE broadcasts customer only when its measured shuffle
output is under the adaptive threshold, otherwise sort-merge, splitting a
hot customer's partition (skewJoin).  Everything else is row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The raw CSV header of the race-result files (main feed).
RAW_COLUMNS = [
    "Year of event",
    "Event dates",
    "Event name",
    "Event distance/length",
    "Event number of finishers",
    "Athlete performance",
    "Athlete club",
    "Athlete country",
    "Athlete year of birth",
    "Athlete gender",
    "Athlete age category",
    "Athlete average speed",
    "Athlete ID",
]

# The second feed lacks the club column and lists columns in another order.
SECOND_FEED_COLUMNS = [
    "Athlete ID",
    "Athlete gender",
    "Athlete year of birth",
    "Athlete age category",
    "Athlete country",
    "Athlete average speed",
    "Athlete performance",
    "Event name",
    "Event dates",
    "Event distance/length",
    "Event number of finishers",
    "Year of event",
]

# Distance texts chosen by g = 0..7 (g = 7 has no unit at all).
DISTANCE_TEXTS = ["50km", "100mi", "6h", "24h", "6d", "87km/2Etappen", "42.195km", "Backyard"]


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over all cores when its scan yields fewer tasks.

    Parquet splits at row-group boundaries, so a small table in one row
    group is one task, and every per-row expression downstream would run
    on one core.  At scale (thousands of splits) this is a no-op.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- sessions without RDD access: leave as is
        return df
    return df.repartition(target) if splits < target else df


def _distance_case() -> str:
    branches = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(DISTANCE_TEXTS))
    return f"CASE WHEN k % 101 = 0 THEN NULL ELSE CASE g {branches} END END"


# The feed columns as Spark SQL expressions over (k, a, d, y, nk, e, g, gender):
# one selectExpr keeps the build to a handful of driver round trips.
_FEED_EXPRESSIONS = [
    ("Year of event", "y"),
    ("Event dates", """CASE k % 5
        WHEN 0 THEN date_format(d, 'yyyy-MM-dd')
        WHEN 1 THEN date_format(d, 'dd.MM.yyyy')
        WHEN 2 THEN concat(date_format(d, 'dd'), '.-', date_format(date_add(d, 1), 'dd'), '.',
                           date_format(d, 'MM.yyyy'))
        WHEN 3 THEN concat(date_format(d, 'dd.MM.'), '-', date_format(date_add(d, 1), 'dd.MM.yyyy'))
        ELSE concat('00.00.', date_format(d, 'yyyy')) END"""),
    ("Event name", """concat('Race ', CAST(e AS STRING),
        CASE WHEN e % 8 = 7 THEN '' ELSE concat(' (NATION_', CAST(e % 25 AS STRING), ')') END)"""),
    ("Event distance/length", _distance_case()),
    ("Event number of finishers", "CAST(100 + e AS INT)"),
    ("Athlete performance", """CASE
        WHEN g IN (2, 3) THEN CASE WHEN k % 13 = 0 THEN 'DNF'
             ELSE concat(CAST(50 + k % 100 AS STRING), '.', CAST(k % 10 AS STRING), ' km') END
        WHEN k % 13 = 0 THEN ''
        WHEN k % 13 = 1 THEN '1d 02:03:04 h'
        WHEN k % 13 = 2 THEN '45:30 h'
        ELSE concat(CAST(4 + k % 20 AS STRING), ':', lpad(CAST(k * 7 % 60 AS STRING), 2, '0'), ':',
                    lpad(CAST(k * 11 % 60 AS STRING), 2, '0'), ' h') END"""),
    ("Athlete club", "CASE WHEN (a + y) % 4 = 0 THEN '  ' ELSE concat('Club ', CAST((a + y) % 11 AS STRING)) END"),
    ("Athlete country", "concat('NATION_', CAST((nk + y % 2) % 25 AS STRING))"),
    ("Athlete year of birth", "CASE WHEN a % 13 = 0 THEN NULL ELSE CAST(1940 + a % 60 AS DOUBLE) END"),
    ("Athlete gender", "gender"),
    ("Athlete age category", """CASE WHEN a % 13 = 0 THEN NULL
        ELSE concat(coalesce(gender, 'M'), CAST(floor((y - (1940 + a % 60)) / 5) * 5 AS STRING)) END"""),
    ("Athlete average speed", """CASE WHEN k % 17 = 0 THEN NULL WHEN k % 17 = 1 THEN '1.234,5'
        ELSE concat(CAST(6 + k % 9 AS STRING), ',', CAST(k % 1000 AS STRING)) END"""),
    ("Athlete ID", "a"),
]


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate"))
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    keys = joined.selectExpr(
        "o_orderkey AS k", "o_custkey AS a", "to_date(o_orderdate) AS d",
        "year(to_date(o_orderdate)) AS y", "c_nationkey AS nk", "o_orderkey % 97 AS e",
    ).selectExpr(
        "*",
        "(CASE WHEN k % 20 = 0 THEN e + 1 ELSE e END) % 8 AS g",
        "CASE WHEN a % 50 = 49 THEN NULL WHEN a % 50 = 48 THEN 'X' "
        "WHEN a % 3 = 0 THEN 'W' ELSE 'M' END AS gender",
    )
    return keys.selectExpr(*[f"{expr} AS `{name}`" for name, expr in _FEED_EXPRESSIONS])


def race_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(main feed, second feed) with raw CSV headers, split by athlete."""
    rows = _feed_rows(spark, sf_dir)
    athlete = F.col("Athlete ID")
    main = rows.filter(athlete % 10 != 0).select(*RAW_COLUMNS)
    second = rows.filter(athlete % 10 == 0).select(*SECOND_FEED_COLUMNS)
    return main, second


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country-code lookup (code, name); one nation is left out on purpose."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.filter(F.col("n_nationkey") != 24).select(
        F.col("n_name").alias("country_code"),
        F.concat(F.lit("Land "), F.col("n_nationkey").cast("string")).alias("country_name"),
    )
