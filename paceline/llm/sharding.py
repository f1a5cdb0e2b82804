"""Operator 2: sharding by balanced label propagation, DataFrame functions only.

Documents with equal texts are linked.  Every document starts in a shard by a
gapless number, so shard sizes differ by one row at most.  Then rounds of
label propagation: each linked document looks at how many of its neighbours
are in which shard, and asks to move to the shards that hold most of its group
(the group's *targets*: the fullest ones, as many as have room for all of it).
Askers are spread over the targets in proportion to their room.  Every move is
an exchange, which keeps all counts as they are:

* the k-th asker from S to T with the k-th asker from T to S;
* any other asker with a document of the target that leaves no neighbour
  behind: an unlinked one or, once those are too few, an asker that is alone
  of its group there and stands back for the round;
* when neither gives a move, a block of askers from S to T with as many
  documents that are all of one group in T: a whole small group, or the part
  in T of a group that stands back for the round.

Targets hold at least as many of the group as the shard left, members in a
target stay, and who makes place has no neighbours there or takes them along,
so each exchange lowers the number of cut edges.  Ties between shards and the
askers that stand back differ by round.  Rounds end when nobody asks,
or when ``DRY`` of them in a row, of the third sort, found no exchange.

The law kept is ``rows``: counts at most one apart.

A group's neighbours are never listed: each group is a table of counts by
shard (pre-aggregated, at most ``shards`` rows of it).  Askers and partners are
numbered in hash buckets, so neither a shard nor a target is one task.  Each
round is written to the shared folder.

Null texts count as empty ones and are linked with them.  Rows with equal
doc_id and text are separate rows and linked; null ids are allowed.  Fewer rows
than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import gapless, spool

SHARDS = 40
DRY = 6
ROW_BYTES = 16


def nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, link): ``link`` tells texts apart."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("link"))


def _asks(current: DataFrame, whole_groups: bool, turn: int) -> DataFrame:
    """(node, link, shard, n, target): who wants to move where.  ``n``: members
    of the group in the shard.  ``whole_groups``: their places count as room."""
    linked = current.filter("linked")
    parts = linked.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
    size = F.sum("n").over(Window.partitionBy("link"))
    parts = parts.withColumn("size", size)
    movable = F.col("n") == 1
    if whole_groups:
        movable = movable | (F.col("n") == F.col("size"))
    # documents that may make place; at most ``shards`` rows
    room = (current.filter("not linked").groupBy("shard").agg(F.count(F.lit(1)).alias("room"))
            .unionByName(parts.filter(movable).groupBy("shard").agg(F.sum("n").alias("room")))
            .groupBy("shard").agg(F.sum("room").alias("room")))
    votes = parts.join(F.broadcast(room), "shard", "left").withColumn("room", F.coalesce("room", F.lit(0)))
    # most members first; equal ones with room, then by a hash, so that groups spread
    fullest = Window.partitionBy("link").orderBy(F.desc("n"), F.desc(F.col("room") > 0),
                                                 F.xxhash64("link", "shard", F.lit(turn)))
    earlier = fullest.rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum(F.col("n") + F.col("room")).over(earlier), F.lit(0))
    width = F.col("room") + 1
    first = F.coalesce(F.sum(width).over(earlier), F.lit(0))
    # a target holds a range of the group's room; at most ``shards`` targets a group
    target = F.struct("shard", F.col("first").alias("low"), (F.col("first") + width).alias("high"))
    groups = (votes.withColumns({"home": held < F.col("size"), "first": first}).groupBy("link")
              .agg(F.collect_list(F.when(F.col("home"), target)).alias("homes"),
                   F.sum(F.when(F.col("home"), width)).alias("total"), F.count(F.lit(1)).alias("parts"))
              .filter("size(homes) < parts").drop("parts"))
    point = F.pmod(F.xxhash64("node"), F.col("total"))
    asking = (parts.drop("size").join(groups, "link")
              .filter(~F.array_contains(F.transform("homes", lambda h: h["shard"]), F.col("shard"))))
    return (linked.select("node", "link", "shard").join(asking, ["link", "shard"]).withColumn("point", point)
            .select("node", "link", "shard", "n",
                    F.filter("homes", lambda h: (h["low"] <= F.col("point")) & (F.col("point") < h["high"]))
                    [0]["shard"].alias("target")))


def _single_moves(current: DataFrame, ask: DataFrame, rows: int, stand_back: bool, turn: int) -> DataFrame:
    """(node, moved): exchanges between askers, and of askers with lone documents."""
    ask = spool(gapless(ask, F.struct("shard", "target"), [F.col("node")], "k", rows), "shard-pairs")
    opposite = ask.select(F.col("target").alias("shard"), F.col("shard").alias("target"), "k", F.lit(True).alias("met"))
    met = spool(ask.join(opposite, ["shard", "target", "k"], "left").drop("k"), "shard-met")
    left = met.filter("met is null")
    free = current.filter("not linked").select("node", "shard")
    if stand_back:
        back = (F.col("n") == 1) & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0)
        free = free.unionByName(left.filter(back).select("node", "shard"))
        left = left.filter(~back)
    wanted = gapless(left.select("node", "shard", "target"), F.col("target"), [F.col("node")], "k", rows)
    give = gapless(free, F.col("shard"), [F.col("node")], "k", rows)
    swap = wanted.join(give.select(F.col("shard").alias("target"), "k", F.col("node").alias("partner")), ["target", "k"])
    moves = swap.select(F.explode(F.array(
        F.struct(F.col("node"), F.col("target").alias("moved")),
        F.struct(F.col("partner").alias("node"), F.col("shard").alias("moved")))).alias("m")).select("m.*")
    return moves.unionByName(met.filter("met").select("node", F.col("target").alias("moved")))


def _group_moves(current: DataFrame, ask: DataFrame, rows: int, turn: int) -> DataFrame:
    """(node, moved): blocks of askers change places with as many documents of
    the target that are all of one group there.  Groups that ask are, by turns,
    askers or such partners, never both in a round."""
    partner = F.pmod(F.xxhash64("link", F.lit(turn)), F.lit(2)) == 0
    ask = ask.filter(~partner)
    parts = (current.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("size"))
             .join(ask.select("link").distinct(), "link", "left_anti").withColumnRenamed("shard", "target"))
    parts = spool(parts, "shard-parts")
    wanted = spool(gapless(ask.select("node", "shard", "target"), F.struct("shard", "target"), [F.col("node")], "i", rows),
                   "shard-wanted")
    # the largest part that a shard's askers can replace; at most shards x shards rows
    pick = (wanted.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("askers"))
            .join(parts.select("target", "size").distinct(), "target").filter("size <= askers")
            .groupBy("shard", "target", "askers").agg(F.max("size").alias("size")))
    block = F.floor(F.col("i") / F.col("size"))
    blocks = (wanted.join(F.broadcast(pick), ["shard", "target"]).withColumn("block", block)
              .filter("(block + 1) * size <= askers").drop("i", "askers"))
    units = gapless(blocks.drop("node").distinct(), F.struct("target", "size"), [F.col("shard"), F.col("block")], "k", rows)
    parts = gapless(parts, F.struct("target", "size"), [F.col("link")], "k", rows)
    trade = spool(units.join(parts, ["target", "size", "k"]).drop("k", "size"), "shard-trade")
    out = blocks.join(trade.drop("link"), ["shard", "target", "block"]).select("node", F.col("target").alias("moved"))
    back = trade.select("link", F.col("target").alias("shard"), F.col("shard").alias("moved"))
    return out.unionByName(current.select("node", "link", "shard").join(back, ["link", "shard"]).select("node", "moved"))


def propagate(start: DataFrame, shards: int, rows: int, rounds: int | None = None) -> DataFrame:
    """``start``: (node, link, linked, shard); returns it with shards moved.
    ``rounds``: stop after so many (None: when no exchange is left)."""
    current, turn, dry, stand_back = start, 0, 0, False
    while dry <= DRY and (rounds is None or turn < rounds):
        by_group = dry > 0
        ask = spool(_asks(current, by_group, turn), "shard-ask")
        asking = ask.count()
        if not asking:
            if by_group:
                break
            dry = 1
            continue
        moves = _group_moves(current, ask, rows, turn) if by_group else _single_moves(current, ask, rows, stand_back, turn)
        moves = spool(moves, "shard-moves")
        moved = moves.count()
        turn += 1
        if not moved:
            dry, stand_back = dry + 1, True
            continue
        # every asker that is served brings a partner along
        dry, stand_back = 0, stand_back or moved < asking
        current = spool(current.join(moves, "node", "left")
                        .select("node", "link", "linked", F.coalesce("moved", "shard").alias("shard")), "shard-round")
    return current


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    base = spool(nodes(docs).withColumn("node", F.monotonically_increasing_id()), "shard-nodes")
    rows = base.count()
    group = base.groupBy("link").agg((F.count(F.lit(1)) > 1).alias("linked"))
    dealt = gapless(base.select("node", "link"), F.lit(0), [F.col("node")], "i", rows)
    start = spool(dealt.join(group, "link")
                  .select("node", "link", "linked", F.pmod("i", F.lit(shards)).cast("int").alias("shard")),
                  "shard-start")
    placed = propagate(start, shards, rows, rounds).select("node", "shard")
    out = gapless(base.drop("link").join(placed, "node"), F.col("shard"), [F.col("node")], "slot", rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
