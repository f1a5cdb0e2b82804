"""Lookup joins J1-J3 with a checked broadcast, and joins of facts with
dimensions of any size (J4, J5).

A side is broadcast only after its bytes are measured (``fits_broadcast``: one
two-phase sum over its rows).  Beyond the bound the join is left to the planner
(sort-merge, or AQE's runtime broadcast from measured sizes).  Streaming
queries run without AQE, so this explicit check is what keeps the
stream-static join shuffle-free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a broadcast side may take in the memory of every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 64  # a row's share of the hash table besides its values


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes``.  The sum is
    partial in every task; no task sees more than its own rows.  It computes
    ``df``: pass a table, not a long plan."""
    size = F.lit(_ROW_BYTES)
    for name, kind in df.dtypes:
        size = size + (F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) if kind in ("string", "binary") else F.lit(8))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= max_bytes


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def role_lookup(countries: DataFrame, role: str) -> DataFrame:
    """The lookup with role-named columns, e.g. athlete_country_code."""
    return countries.select(
        F.col("country_code").alias(f"{role}_country_code"),
        F.col("country_name").alias(f"{role}_country_name"),
    )


def enrich_country(df: DataFrame, lookup: DataFrame, key: str, role: str) -> DataFrame:
    """Left join a role-named copy of the (already sized) lookup.

    Rows without a match keep null code and name; a code listed twice in the
    lookup fans its rows out, exactly like any left equi-join.
    """
    rl = role_lookup(lookup, role)
    return df.join(rl, df[key] == rl[f"{role}_country_code"], "left")


def enrich_country_name(df: DataFrame, countries: DataFrame, key: str, name_as: str) -> DataFrame:
    """Left join, drop the code, keep the name under ``name_as``."""
    lk = maybe_broadcast(countries.select("country_code", "country_name"))
    return (df.join(lk, df[key] == lk["country_code"], "left")
            .drop("country_code")
            .withColumnRenamed("country_name", name_as))


# A join key with more rows than this is split over several tasks.  At most
# total_rows / HOT_KEY_ROWS keys can exceed it, which bounds the hot-key table.
HOT_KEY_ROWS = 5_000_000


def hot_keys(counts_from: DataFrame, key: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys holding more than ``hot_rows`` rows, with a bucket count each.

    Two-phase aggregate over the key column only; the bucket count grows
    with the key's rows so every bucket holds about ``hot_rows`` rows.
    """
    n = F.count(F.lit(1))
    return (counts_from.groupBy(key).agg(n.alias("_n"))
            .filter(F.col("_n") > hot_rows)
            .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_buckets")))


def skew_safe_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                   counts_from: DataFrame | None = None, hot_rows: int = HOT_KEY_ROWS,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Equi-join ``big`` to a one-row-per-key ``small`` with hot keys salted.

    ``small`` is written once.  If it takes at most ``broadcast_bytes`` it is
    broadcast (no shuffle of ``big``, nothing to salt).  Otherwise:

    Rows of a hot key get a salt from a hash of the whole row (stable under
    task retries, unlike a random salt) in [0, buckets); that key's single
    row in ``small`` is replicated once per bucket.  Cold keys keep salt 0,
    so their join is unchanged.  The hot-key table is written once and
    broadcast only if it is small; salting holds either way.
    ``counts_from`` lets the hot keys be counted on a narrow relation (e.g.
    the fact's key column).
    """
    from paceline.sources.tables import materialize

    small = materialize(small, "join-side")
    if broadcast_bytes > 0 and fits_broadcast(small, broadcast_bytes):
        return big.join(F.broadcast(small), key, how)
    hot = materialize(hot_keys(counts_from if counts_from is not None else big, key, hot_rows), "hot-keys")
    hot = maybe_broadcast(hot)
    buckets = F.col("_buckets")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    big_salted = (big.join(hot, key, "left")
                  .withColumn("_salt", F.when(buckets.isNull(), F.lit(0))
                              .otherwise(F.pmod(row_hash, buckets).cast("int")))
                  .drop("_buckets"))
    small_salted = (small.join(hot, key, "left")
                    .withColumn("_salt", F.explode(F.when(buckets.isNull(), F.array(F.lit(0)))
                                                   .otherwise(F.sequence(F.lit(0), buckets - 1))))
                    .drop("_buckets"))
    return big_salted.join(small_salted, [key, "_salt"], how).drop("_salt")


def co_located_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                    hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Equi-join of two tables in the same buckets of ``key`` (``Catalog.write_bucketed``),
    ``small`` with one row a key: neither is shuffled, whatever their sizes.

    A bucket is one task, so a hot key's rows are joined apart: the rows of
    ``small`` for keys with more than ``hot_rows`` rows (at most
    total / ``hot_rows`` of them, and checked) are broadcast to the rows of
    ``big``, which are then read in splits of any size.
    """
    from paceline.sources.tables import materialize

    if how not in ("inner", "left"):
        raise ValueError("an inner or a left join")
    hot = materialize(hot_keys(big.select(key), key, hot_rows).select(key), "hot-keys")
    if hot.isEmpty():
        return big.join(small.hint("merge"), key, how)
    few = materialize(small.join(F.broadcast(hot), key, "left_semi"), "hot-rows")
    if not (fits_broadcast(hot) and fits_broadcast(few)):
        return skew_safe_join(big, small, key, how, big.select(key), hot_rows, 0)
    hot_part = big.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key, how)
    cold_part = big.join(F.broadcast(hot), key, "left_anti").join(small.hint("merge"), key, how)
    return hot_part.unionByName(cold_part)
