"""Operator 7: document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (lines, cut after closing marks such as ``.`` or ``|``)
become 64-bit digests.  A sketch has ``HASHES`` tables of cells; a digest goes
into one cell of each table, and a cell keeps the count of its digests, their
XOR and the XOR of their check values.  Subtracting the cells of two versions
leaves the digests that only one of them has; a cell with a count of +1 or -1
and a fitting check value gives its digest away, which is taken out of its
other cells, and so on (peeling).  If cells stay, the pair is sketched anew
with twice the cells, until every pair is peeled.

Likeness of two texts: shared paragraph digests / all paragraph digests of
both (1 if neither has any), from the recovered digests.  The published
fingerprint is the text's smallest sketch of the same family, in hexadecimal:
its cells subtract like the others, and equal texts have equal fingerprints.

Everything is DataFrame functions.  To find each document's successor, the
order is cut into ranges of ``RANGE_BYTES``; the first document of the next
range joins a range as a guest, so every range is one sorted partition and the
text moves once.  What is left of it, the digests, is written as a table
bucketed by range: sketches are rows (pair, cell), subtracted and peeled by
grouped sums and XORs inside the bucket, without another shuffle.

Null texts count as empty.  Documents follow one another by descending doc_id,
null ids last, rows of one id by a hash of their text; a lone document is its
own successor.  Ranges cut within an id, so many rows of one id, or none, lie
in many tasks; only rows that agree in id and text stay together.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.llm.common import SPACE_CLASS, let, spool
from paceline.session import fresh_dir

HASHES = 4
BASE_CELLS = 3          # cells a table in the published fingerprint
LEAST_CELLS = 8         # cells a table when comparing
CELLS_PER_DIGEST = 0.55  # a table, of the digests of both texts together
PASSES = 6
RANGE_BYTES = 1 << 20   # of the texts in a range; one text may be longer
MOST_RANGES = 100_000   # the driver holds two numbers of each; beyond, ranges grow
_CUT = rf"\n|(?<=[.!?|*#$%&]){SPACE_CLASS}+"
_LOWEST = -(1 << 63)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs that have a visible character."""
    parts = F.filter(F.split(text, _CUT), lambda p: p.rlike(r"[^\x20\x09-\x0D]"))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def check_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(-1)), 32)


def cell_of(key: Column, table: int, size: Column) -> Column:
    """Cell number over all tables; ``size``: cells a table."""
    return F.pmod(F.xxhash64(key, F.lit(table)), size.cast("long")) * HASHES + table


def fingerprint(keys: Column, size: int = BASE_CELLS) -> Column:
    """The sketch of ``size`` cells a table as text: count, key XOR and check
    XOR of every cell."""
    names = [f"p{t}" for t in range(HASHES)]

    def hashed(k: Column) -> Column:
        # all hashes of a key once, not again for every cell
        places = [cell_of(k, t, F.lit(size)).alias(p) for t, p in enumerate(names)]
        return F.struct(k.alias("k"), check_of(k).alias("c"), *places)

    def show(own: Column) -> Column:
        def fold(name: str) -> Column:
            return F.aggregate(own, F.lit(0).cast("long"), lambda a, r: a.bitwiseXOR(r[name]))
        return F.concat(F.lpad(F.hex(F.size(own)), 8, "0"), F.lpad(F.hex(fold("k")), 16, "0"), F.lpad(F.hex(fold("c")), 8, "0"))

    def cell(rows: Column, table: int, c: int) -> Column:
        return let(F.filter(rows, lambda r: r[names[table]] == c * HASHES + table), show)
    cells = [(t, c) for t in range(HASHES) for c in range(size)]
    return F.lower(let(F.transform(keys, hashed), lambda rows: F.concat(*[cell(rows, t, c) for t, c in cells])))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, tie): the documents' order is by key and tie, descending."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"),
                       F.xxhash64(text).alias("tie"))


def _range_of(key: Column, tie: Column, heads: list[tuple[int, int]]) -> Column:
    """The last range whose head is not behind (key, tie), found in two short
    steps; ``heads``: the first row of each range, in the documents' order."""
    def zipped(some: list[tuple[int, int]]) -> Column:
        return F.arrays_zip(F.lit([k for k, _ in some]).alias("k"), F.lit([t for _, t in some]).alias("t"))

    def not_behind(row: Column) -> Column:
        return (row["k"] > key) | ((row["k"] == key) & (row["t"] >= tie))
    step = math.isqrt(len(heads)) + 1
    groups = [heads[i:i + step] for i in range(0, len(heads), step)]
    coarse = F.size(F.filter(zipped([g[0] for g in groups]), not_behind)) - 1
    inner = F.get(F.array(*[zipped(g) for g in groups]), coarse)
    return coarse * step + F.size(F.filter(inner, not_behind)) - 1


def with_successor(docs: DataFrame) -> tuple[DataFrame, int]:
    """((range, rid, guest, doc_id, text, next_text), number of ranges);
    ``rid`` numbers a range's rows in their order, the guest comes last."""
    keyed = _keyed(docs)
    size = keyed.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    parts = min(MOST_RANGES, max(1, math.ceil((size or 0) / RANGE_BYTES)))
    # Spark samples where to cut; the first row of each range, narrow
    heads = (keyed.select("key", "tie").repartitionByRange(parts, F.desc("key"), F.desc("tie"))
             .groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct("key", "tie")).alias("head")).select("head.*"))
    order = sorted(((r.key, r.tie) for r in heads.collect()), reverse=True)
    home = keyed.withColumn("range", _range_of(F.col("key"), F.col("tie"), order) if order else F.lit(0))
    home = home.withColumn("guest", F.lit(False))
    if order:
        following = [(i, *order[(i + 1) % len(order)]) for i in range(len(order))]
        wanted = docs.sparkSession.createDataFrame(following, "range int, key long, tie long")
        # a few numbers for each range: without the hint the texts would be shuffled for this join too
        guests = keyed.join(F.broadcast(wanted), ["key", "tie"]).dropDuplicates(["range", "key", "tie"])
        home = home.unionByName(guests.withColumn("guest", F.lit(True)))
    w = Window.partitionBy("range").orderBy("guest", F.desc("key"), F.desc("tie"))
    rows = home.repartition(max(1, len(order)), "range").withColumns(
        {"rid": F.row_number().over(w), "next_text": F.lead("text").over(w)})
    return rows.select("range", "rid", "guest", "doc_id", "text", "next_text"), max(1, len(order))


def bucketed(df: DataFrame, buckets: int, by: str) -> DataFrame:
    """``df`` written to the shared folder as a table whose rows lie in
    ``buckets`` buckets: later work by ``by`` needs no shuffle."""
    spark, name = df.sparkSession, f"iblt_{uuid.uuid4().hex}"
    path = fresh_dir(spark, name)
    df.write.bucketBy(buckets, by).option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


@contextmanager
def _joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Joins whose sides lie in the same buckets by a part of the join's keys
    are not shuffled by all of them."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def edited_text(text: Column, successor: Column) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(successor, F.lit(1), half))


def differences(pairs: DataFrame, ids: list[str], cells_per_digest: float = CELLS_PER_DIGEST,
                passes: int = PASSES) -> DataFrame:
    """Subtract and peel.  ``pairs``: ids, and digest arrays ``x`` and ``y``.

    Returns ids, n_x, n_y, the recovered digests ``plus`` (only in x) and
    ``minus`` (only in y), and left (cells that could not be peeled).
    Recovered digests travel as rows of the cells -1 and -2, the two sizes as
    the row of the cell -3.
    """
    size = F.greatest(F.lit(LEAST_CELLS), F.ceil((F.size("x") + F.size("y")) * cells_per_digest)).cast("int")
    ids = [*ids, "size"]
    pairs = pairs.withColumn("size", size)
    zero = F.lit(0).cast("long")

    def entry(cell: Column, n: Column, k: Column, c: Column, digest: Column = zero) -> Column:
        return F.struct(cell.cast("long").alias("cell"), digest.alias("digest"), n.cast("long").alias("n"), k.alias("k"),
                        c.alias("c"))

    def put(key: Column, sign: Column) -> list[Column]:
        return [entry(cell_of(key, t, F.col("size")), sign, key, check_of(key)) for t in range(HASHES)]

    sizes = entry(F.lit(-3), zero, F.size("x").cast("long"), F.size("y").cast("long"))     # also keeps pairs without any digest
    signed = pairs.select(*ids, F.explode(F.concat(
        F.transform("x", lambda k: F.struct(k.alias("k"), F.lit(1).alias("s"), zero.alias("c"))),
        F.transform("y", lambda k: F.struct(k.alias("k"), F.lit(-1).alias("s"), zero.alias("c"))),
        F.array(F.struct(sizes["k"].alias("k"), F.lit(0).alias("s"), sizes["c"].alias("c"))))).alias("e"))
    rows = signed.select(*ids, F.explode(F.when(F.col("e.s") == 0, F.array(entry(F.lit(-3), zero, F.col("e.k"), F.col("e.c"))))
                                         .otherwise(F.array(*put(F.col("e.k"), F.col("e.s"))))).alias("r")).select(*ids, "r.*")

    def settle(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*ids, "cell", "digest")
                .agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
                .filter("cell < 0 or n != 0 or k != 0 or c != 0"))

    cells = settle(rows)
    for _ in range(passes):
        pure = (F.col("cell") >= 0) & (F.abs("n") == 1) & (check_of(F.col("k")) == F.col("c"))
        cell = F.struct(F.lit(False).alias("found"), F.col("cell").alias("g"), "digest", "n", "k", "c")
        key = F.struct(F.lit(True).alias("found"), F.col("k").alias("g"), "digest", "n", "k", "c")
        # a key may show in several cells: once is enough
        once = (cells.select(*ids, F.explode(F.when(pure, F.array(cell, key)).otherwise(F.array(cell))).alias("r"))
                .select(*ids, "r.*").groupBy(*ids, "found", "g", "digest")
                .agg(F.max("n").alias("n"), F.max("k").alias("k"), F.max("c").alias("c")))
        same = entry(F.col("g"), F.col("n"), F.col("k"), F.col("c"), F.col("digest"))
        recovered = entry(F.when(F.col("n") > 0, -1).otherwise(-2), F.lit(1), zero, zero, F.col("k"))
        out = F.array(recovered, *put(F.col("k"), -F.col("n")))
        cells = settle(once.select(*ids, F.explode(F.when(F.col("found"), out).otherwise(F.array(same))).alias("r"))
                       .select(*ids, "r.*"))

    def side(cell: int) -> Column:
        return F.collect_list(F.when(F.col("cell") == cell, F.col("digest")))

    def told(column: str) -> Column:
        return F.max(F.when(F.col("cell") == -3, F.col(column))).cast("int")
    return cells.groupBy(*ids).agg(told("k").alias("n_x"), told("c").alias("n_y"), side(-1).alias("plus"), side(-2).alias("minus"),
                                   F.count(F.when(F.col("cell") >= 0, 1)).alias("left")).drop("size")


def likeness(n_x: Column, plus: Column, minus: Column) -> Column:
    """Shared digests / all digests, from the recovered ones."""
    plus, minus = F.size(plus), F.size(minus)
    return F.when(n_x + minus == 0, F.lit(1.0)).otherwise((n_x - plus) / (n_x + minus)).cast("double")


def compare_neighbours(docs: DataFrame, cells_per_digest: float = CELLS_PER_DIGEST, passes: int = PASSES,
                       attempts: int = 20) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row."""
    around, ranges = with_successor(docs)
    edited = F.when(~F.col("guest"), edited_text(F.col("text"), F.col("next_text")))
    table = bucketed(around.withColumn("edited", edited).select(
        "range", "rid", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("text")).alias("x"),
        digests(F.col("edited")).alias("e")), ranges, "range")
    following = F.lead("x").over(Window.partitionBy("range").orderBy("rid"))
    pairs = table.withColumn("y", following).filter(~F.col("guest"))

    def peeled(pairs: DataFrame, factor: int) -> DataFrame:
        """One row a document: results against the edited and the next text."""
        sides = pairs.select("range", "rid", "x", F.posexplode(F.array("e", "y")).alias("side", "y"))
        found = differences(sides, ["range", "rid", "side"], cells_per_digest * factor, passes)
        near = likeness(F.col("n_x"), F.col("plus"), F.col("minus"))
        return found.groupBy("range", "rid").agg(
            F.max(F.when(F.col("side") == 0, near)).alias("near_edited"),
            F.max(F.when(F.col("side") == 1, near)).alias("near_next"), F.max("left").alias("left"))

    # the digests stay beside the results of documents to be sketched anew: retries read these few rows, not the table
    sets = {c: F.when(F.col("left") > 0, F.col(c)) for c in ("x", "e", "y")}
    about = pairs.select("range", "rid", "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("x")).alias("fingerprint"),
                         fingerprint(F.col("e")).alias("edited_fingerprint"), *sets)
    with _joined_in_place(docs.sparkSession):
        result = spool(about.join(peeled(pairs, 1), ["range", "rid"]).withColumns(sets), "iblt")
        done, open_ = result.filter("left = 0"), result.filter("left > 0")
        for attempt in range(1, attempts + 1):
            if open_.isEmpty():
                break
            # dealt by document once, for the join and all grouping
            few = open_.repartition("range", "rid")
            again = peeled(few.select("range", "rid", *sets), 2 ** attempt)
            next_ = spool(few.drop("near_edited", "near_next", "left").join(again, ["range", "rid"]).withColumns(sets)
                          .select(*result.columns), "iblt")
            done, open_ = done.unionByName(next_.filter("left = 0")), next_.filter("left > 0")
        else:
            if not open_.isEmpty():
                raise RuntimeError("sketches that cannot be peeled")
    return done.drop("range", "rid", "left", *sets)
