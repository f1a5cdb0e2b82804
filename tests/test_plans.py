"""Plan shape: no cartesian products or Python evaluation, broadcast lookups,
pre-aggregation below dimension joins, pushed filters and pruned scans."""

from conftest import SF_SMALL
from paceline.operators import marts
from paceline.operators.joins import fits_broadcast
from paceline.operators.clean import clean
from paceline.plans.queries import bronze_results, shared_star, silver, star
from paceline.sources.feed import country_lookup

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_plan(spark):
    p = plan(silver(spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in p]
    assert p.count("BroadcastHashJoin") >= 2                # both country lookups


def test_silver_scan_pushes_day_filter(spark):
    s = clean(bronze_results(spark, SF_SMALL), country_lookup(spark, SF_SMALL))      # over a landed feed
    text = s._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(event_distance/length" in text or "IsNotNull(event_distance/length)" in text


def test_marts_preaggregate_before_joins(spark):
    st = star(spark, SF_SMALL)
    for df in (marts.gender_distribution(st), marts.country_representation(st),
               marts.event_distance(st), marts.events_per_year(st)):
        p = plan(df)
        assert not [f for f in FORBIDDEN if f in p]
        assert "partial_count" in p


def read_schemas(p):
    return [line.split("ReadSchema: ")[1] for line in p.split("\n") if "ReadSchema: " in line]


def test_views_read_pruned_columns(spark):
    st = shared_star(spark, SF_SMALL)                      # over a written silver table
    p = plan(marts.distance_races(st))
    schemas = read_schemas(p)
    assert schemas and all("athlete_avg_speed_kmh" not in s and "performance_km" not in s for s in schemas)
    assert not [f for f in FORBIDDEN if f in p]
    p = plan(marts.event_distance(st))
    assert all("athlete_club" not in s for s in read_schemas(p))


def test_lookup_broadcast_is_size_checked(spark):
    lookup = country_lookup(spark, SF_SMALL)
    assert fits_broadcast(lookup, 100_000)
    assert not fits_broadcast(lookup, 1000)


def test_single_relations_write_nothing(spark):
    from paceline.plans import queries as Q
    for key in ("results_clean", "fct_results", "dim_athlete", "dim_event", "dim_date", "races_per_year"):
        df = Q.BATCH_QUERIES[key](spark, SF_SMALL)
        assert all("/testdata/" in f for f in df.inputFiles()), key


def test_clustered_view_shuffles_no_fact(spark):
    """With every broadcast of the athletes ruled out: no Exchange above the fact."""
    from paceline.session import fresh_dir
    from paceline.sources.catalog import Catalog
    from paceline.sources.tables import materialize
    from paceline.streaming.pipeline import cluster_by_athlete
    star = shared_star(spark, SF_SMALL)
    star.events = materialize(star.events, "test-events")     # as stored
    catalog = Catalog(spark, fresh_dir(spark, "test-clustered"), "clustered_test_")
    catalog.create_schemas()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        clustered = cluster_by_athlete(catalog, star, 4)
        for hot_rows in (10 ** 9, 5):                      # no hot key, and most keys hot
            view = marts.distance_races(clustered, hot_rows=hot_rows)
            p = plan(view)
            assert "Exchange hashpartitioning" not in p and "SortMergeJoin" in p
            assert sorted(map(str, view.collect())) == sorted(map(str, marts.distance_races(star).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
