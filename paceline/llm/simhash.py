"""Operator 8: SimHash near-duplicates with covering locality-sensitive hashing.

A text's fingerprint has 64 bits: bit b is 1 if it is set in over half of the
XXH64 values (seed 42) of its word shingles.  Two fingerprints link when at
most ``radius`` bits differ; a component is what links connect.

Candidates: every bit position i has a vector m(i) of radius + 1 bits.  For
each non-zero vector v there is a table whose mask keeps the positions where
<m(i), v> is odd.  The at most ``radius`` positions in which a pair differs
span no more than ``radius`` dimensions, so some v is orthogonal to all of
them, and in v's table the pair has equal keys.  No pair within the radius is
missed, whatever the data; a fingerprint is stored in 2^(radius+1) - 1 tables.

Only distinct fingerprints go through the tables.  A bucket is searched by
taking a member, moving all members within the radius of it into its group,
and going on from those: each member leaves the unvisited set once and the
edges kept are a spanning forest, never all pairs.  A bucket of more than
``BLOCK`` members is dealt into blocks and every pair of blocks is searched by
a task of its own, so no bucket is bound to one task and none is cut short.

Null, empty and word-free texts have fingerprint zero and link like any other.
Equal texts have equal fingerprints.  A null doc_id stays a row; a component's
id is the smallest non-null doc_id in it (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import spool

SHINGLE_WORDS = 4
RADIUS = 4
BLOCK = 2048
_CHUNK = 65_536  # shingles counted at a time
_SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash, as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII separators only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    first, last = starts[:len(words) - k + 1], ends[k - 1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), _CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], _SEED)
                           for a, b in zip(first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    size = 1 << (radius + 1)
    return [sum(1 << i for i in range(bits) if ((i % (size - 1) + 1) & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the graph that links values within ``radius`` bits."""
    edges, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue[-1]) <= radius
            x = queue.pop()
            if near.any():
                found = left[near]
                edges += [(x, y) for y in found]
                queue += list(found)
                left = left[~near]
    return edges


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that connect the same fingerprints as all pairs within
    ``radius`` would.  ``fps``: distinct fingerprints in column ``fp``."""
    tables = [F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
              for v, m in enumerate(covering_masks(radius))]
    keyed = fps.select("fp", F.explode(F.array(*tables)).alias("t")).select("fp", "t.v", "t.k")
    full = (keyed.groupBy("v", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    # the planner takes ``keyed`` for as small as ``fps`` and would broadcast it
    member = (keyed.hint("merge").join(full, ["v", "k"])
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("v", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    dealt = member.repartition("v", "k", "i", "j").sortWithinPartitions("v", "k", "i", "j", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None

        def found(parts: list[np.ndarray]) -> list[tuple]:
            fps = np.unique(np.concatenate(parts)) if parts else np.array([], np.int64)
            return forest(fps.view(np.uint64), radius)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)], 1)
            fp = batch.column(4).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges: list[tuple] = []
            for a, b in zip([0, *cuts], [*cuts, len(fp)]):
                now = tuple(keys[a])
                if now != key:
                    edges += found(held)
                    held, key = [], now
                held.append(fp[a:b].copy())
            yield _edges(edges)
        yield _edges(found(held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    flat = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest node that edges connect ``fp`` to; nodes
    without an edge and the roots themselves have no row.

    Alternating large-star and small-star steps: each replaces edges by edges
    to the smallest neighbour and keeps what is connected.  Every round is
    written to the shared folder; no node's neighbours are ever gathered.
    """
    current = spool(edges, "cc")
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("u"), "m")
                 .filter("u != m").distinct())
        down = large.select(F.greatest("u", "m").alias("a"), F.least("u", "m").alias("b"))
        parent = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(parent, "a").select(F.col("b").alias("u"), "m")
                 .union(parent.select(F.col("a").alias("u"), "m")).filter("u != m")
                 .select(F.col("u").alias("a"), F.col("m").alias("b")).distinct())
        after = spool(small, "cc")
        if _same(current, after):
            return after.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        current = after


def _same(x: DataFrame, y: DataFrame) -> bool:
    def digest(d: DataFrame):
        return d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
    return digest(x) == digest(y)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id, n_class) for every row of ``docs``;
    ``n_class`` counts the rows with the same fingerprint."""
    own = spool(fingerprints(docs, shingle), "simhash")
    classes = spool(own.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_class")), "classes")
    roots = components(links(classes.select("fp"), radius))
    known = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = known.join(least, "root").select("fp", "component_id", "n_class")
    return own.join(of_class, "fp").select("doc_id", "fp", "component_id", "n_class")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` without near-duplicates: of each component, the row with the
    smallest doc_id stays.  Rows with repeated or null ids are told apart by a
    number given in the order of the ids, null last."""
    key, base = "doc_id", docs
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    if not odd.isEmpty():
        key = "__row"
        base = spool(docs.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"))
                     .withColumn(key, F.monotonically_increasing_id()), "simhash-rows")
    near = near_duplicates(base.select(F.col(key).alias("doc_id"), "text"), shingle, radius)
    stay = near.filter("doc_id = component_id").select(F.col("doc_id").alias(key))
    return base.join(stay, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
