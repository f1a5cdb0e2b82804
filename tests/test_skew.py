"""Hot keys: one athlete / one event holding a third of all fact rows."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from paceline.operators import marts
from paceline.operators.joins import hot_keys, skew_safe_join
from paceline.operators.model import StarSchema, fct_results
from paceline.plans.queries import silver


def hot_star(spark):
    """Silver with every third row moved onto one athlete and one event."""
    s = silver(spark, SF_SMALL)
    hot = (F.col("athlete_id") % 3 == 0)
    s = (s.withColumn("athlete_id", F.when(hot, F.lit(7)).otherwise(F.col("athlete_id")))
         .withColumn("event_id", F.when(hot, F.lit("hot-event")).otherwise(F.col("event_id"))))
    return StarSchema.from_silver(s)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_hot_keys_are_found_and_bucketed(spark):
    st = hot_star(spark)
    total = st.fact.count()
    hk = {r.athlete_id: r._buckets for r in hot_keys(st.fact, "athlete_id", hot_rows=total // 10).collect()}
    assert 7 in hk and hk[7] >= 3


def test_salted_join_equals_plain_join(spark):
    st = hot_star(spark)
    total = st.fact.count()
    fact = st.fact.select("result_id", "event_id", "athlete_id")
    athletes = st.athletes.select("athlete_id", "athlete_gender")
    salted = skew_safe_join(fact, athletes, "athlete_id", hot_rows=total // 20, broadcast_bytes=0)
    plain = fact.join(athletes, "athlete_id")
    assert rows(salted.select(*plain.columns)) == rows(plain)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_views_with_hot_keys_match_unsalted(spark):
    st = hot_star(spark)
    total = st.fact.count()
    for view in (marts.distance_races, marts.time_races):
        split = view(st, hot_rows=total // 20, broadcast_bytes=0)
        unsplit = view(st, hot_rows=10 ** 12, broadcast_bytes=0)
        broadcast = view(st)
        assert rows(split) == rows(unsplit) == rows(broadcast)
