"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

The ring has ``2**CELL_BITS`` cells. Every shard stands on it ``vnodes`` times, at points that depend on its
number and the replica only; a cell belongs to the first shard clockwise from it (its home). A document's key
is its id with its text, so neither rows without an id nor an id that many rows share land in one cell.

Bounded loads: a shard takes at most its bound. Where the cells of a shard hold more, each cell keeps its
proportional part of the bound (its first keys) and passes the others on; these walk clockwise in ring order
and fill the next shards that have room. Without slack the bounds add up to the number of rows, so counts are
at most one apart; only what exceeds a bound leaves its home, which limits the movement when a shard is added.

All of this is decided on tables of at most ``2**CELL_BITS`` cells or ``shards * vnodes`` points, whatever the
input. Rows only learn their rank inside their cell (one window over even, hash-made cells; equal rows are
counted before and spread again after) and look their place up in a broadcast table of that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.llm.common import stored

#: The ring has 2**CELL_BITS cells: the bound of every table below that is not one of rows.
CELL_BITS = 14
#: Times that a shard stands on the ring.
VNODES = 128
#: Rows that repeat id and text are dealt to tasks by this many.
COPIES = 1 << 16

_BEFORE = (Window.unboundedPreceding, -1)


def _cell(point: Column) -> Column:
    return F.shiftrightunsigned(point, 64 - CELL_BITS).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, point, cell`` of every row. A null text counts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(doc_id, text).alias("point"))
    return rows.withColumn("cell", _cell(F.col("point")))


def ring(spark, shards: int, vnodes: int = VNODES) -> DataFrame:
    """The virtual nodes: ``shard, cell, point``. More shards only add points."""
    at = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("replica"))
    point = F.xxhash64(F.lit("ring"), "shard", "replica")
    return at.select("shard", _cell(point).alias("cell"), point.alias("point"))


def homes(nodes: DataFrame) -> DataFrame:
    """``cell, home`` for every cell: the first shard clockwise, its own nodes included (bounded tables)."""
    spark = nodes.sparkSession
    first = nodes.groupBy("cell").agg(F.min(F.struct("point", "shard"))["shard"].alias("shard"))
    cells = spark.range(1 << CELL_BITS).select(F.col("id").cast("int").alias("cell")).join(first, "cell", "left")
    ahead = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    seen = cells.withColumn("home", F.last("shard", ignorenulls=True).over(ahead))
    # behind the last node the ring begins again
    start = first.agg(F.min(F.struct("cell", "shard"))["shard"].alias("start"))
    return seen.join(F.broadcast(start)).select("cell", F.coalesce("home", "start").alias("home"))


def _bounds(total: Column, shards: int, slack: float) -> Column:
    """Most rows of shard ``shard``: without slack these add up to ``total``."""
    if slack:
        return F.ceil(total * (1.0 + slack) / shards).cast("long")
    return (F.floor(total / shards) + (F.col("shard") < total % shards).cast("int")).cast("long")


def _kept(counts: DataFrame, nodes: DataFrame, shards: int, slack: float) -> DataFrame:
    """``cell, home, n, kept, spare``: a cell's rows, those its home keeps, and the home's room beside all its cells."""
    cells = homes(nodes).join(counts, "cell", "left").select("cell", F.col("home").alias("shard"), F.coalesce("n", F.lit(0)).alias("n"))
    all_rows = F.sum("n").over(Window.partitionBy())
    cells = cells.select("*", _bounds(all_rows, shards, slack).alias("bound"), F.sum("n").over(Window.partitionBy("shard")).alias("load"),
                         F.sum("n").over(Window.partitionBy("shard").orderBy("cell")).alias("upto"))

    def part(rows):  # the shard's bound, dealt to its cells in proportion
        exact = F.col("bound").cast("decimal(18,0)") * rows.cast("decimal(18,0)")
        return F.when(F.col("load") <= F.col("bound"), rows).otherwise(F.floor(F.try_divide(exact, F.col("load"))).cast("long"))

    kept = part(F.col("upto")) - part(F.col("upto") - F.col("n"))
    return cells.select("cell", F.col("shard").alias("home"), "n", kept.alias("kept"), "bound", "load")


def _walk(cells: DataFrame, nodes: DataFrame, shards: int, slack: float) -> DataFrame:
    """``start, shard``: from which of the passed-on rows, in ring order, each stretch goes to which shard.

    One row of arrays (bounded by the points of the ring) is folded: the queue of waiting rows meets the
    nodes in two rounds of the ring, since after the first every node has been met with all of them behind it."""
    total = cells.agg(F.sum("n").alias("total"), F.sum(F.col("n") - F.col("kept")).alias("passed"),
                      F.collect_set(F.when(F.col("n") > 0, F.struct("home", "load"))).alias("loads"))
    by_shard = F.sequence(F.lit(0), F.lit(shards - 1))
    room = nodes.select("shard").distinct().join(cells.groupBy(F.col("home").alias("shard")).agg(F.first("load").alias("load")), "shard", "left") \
        .join(F.broadcast(total.select("total"))).select("shard", F.greatest(_bounds(F.col("total"), shards, slack) - F.coalesce("load", F.lit(0)), F.lit(0)).alias("room"))
    room = room.agg(F.map_from_entries(F.collect_list(F.struct("shard", "room"))).alias("room"))
    passed = cells.select("cell", F.sum(F.col("n") - F.col("kept")).over(Window.orderBy("cell")).alias("tail"))
    stops = nodes.join(passed, "cell").agg(F.array_sort(F.collect_list(F.struct("cell", "point", "shard", "tail"))).alias("stops"))
    one = stops.join(F.broadcast(room)).join(F.broadcast(total.select("passed")))
    one = one.select("passed", F.transform(by_shard, lambda s: F.element_at("room", s)).alias("room"),
                     F.concat(F.transform("stops", lambda s: F.struct(s["shard"].alias("shard"), s["tail"].alias("tail"))),
                              F.transform("stops", lambda s: F.struct(s["shard"].alias("shard"), F.col("passed").alias("tail")))).alias("stops"))
    one = one.withColumn("stops", F.filter("stops", lambda s: F.get("room", s["shard"]) > 0))
    piece = "array<struct<start:bigint,shard:int>>"
    begin = F.struct(F.lit(0).cast("long").alias("head"), F.col("room").alias("room"), F.array().cast(piece).alias("pieces"))

    def meet(state, stop):
        take = F.least(F.get(state["room"], stop["shard"]), stop["tail"] - state["head"])
        left = F.transform(state["room"], lambda r, i: F.when(i == stop["shard"], r - take).otherwise(r))
        piece = F.struct(state["head"].alias("start"), stop["shard"].alias("shard"))
        return F.when(take > 0, F.struct((state["head"] + take).alias("head"), left.alias("room"),
                                         F.concat(state["pieces"], F.array(piece)).alias("pieces"))).otherwise(state)

    return one.select(F.inline(F.aggregate("stops", begin, meet)["pieces"]))


def _stretches(cells: DataFrame, pieces: DataFrame) -> DataFrame:
    """``cell, home, lo, hi, shard, slot``: where the rows of rank ``lo`` to ``hi - 1`` of a cell go."""
    before = F.sum(F.col("n") - F.col("kept")).over(Window.orderBy("cell").rowsBetween(*_BEFORE))
    cells = cells.where("n > 0").withColumn("start", F.coalesce(before, F.lit(0)))
    leaving = cells.where("n > kept")
    marks = leaving.select("start", "cell", "home", "kept", "n", F.lit(None).cast("int").alias("shard")).unionByName(
        pieces.select("start", F.lit(None).cast("int").alias("cell"), F.lit(None).cast("int").alias("home"),
                      F.lit(None).cast("long").alias("kept"), F.lit(None).cast("long").alias("n"), "shard"))
    marks = marks.groupBy("start").agg(*[F.max(c).alias(c) for c in ("cell", "home", "kept", "n", "shard")])
    sofar = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("cell").isNotNull(), F.struct("cell", "home", "kept", "n", F.col("start").alias("first")))
    cut = marks.select("start", F.last(opened, ignorenulls=True).over(sofar).alias("c"), F.last("shard", ignorenulls=True).over(sofar).alias("shard"),
                       F.lead("start").over(Window.orderBy("start")).alias("next"))
    lo = F.col("c.kept") + F.col("start") - F.col("c.first")
    moved = cut.select("c.cell", "c.home", lo.alias("lo"), F.least(lo + F.col("next") - F.col("start"), F.col("c.n")).alias("hi"), "shard")
    moved = moved.withColumn("hi", F.coalesce("hi", F.lit(None).cast("long"))).join(leaving.select("cell", "n"), "cell") \
        .select("cell", "home", "lo", F.coalesce("hi", "n").alias("hi"), "shard")
    stay = cells.where("kept > 0").select("cell", "home", F.lit(0).cast("long").alias("lo"), F.col("kept").alias("hi"), F.col("home").alias("shard"))
    both = stay.unionByName(moved)
    slot = F.sum(F.col("hi") - F.col("lo")).over(Window.partitionBy("shard").orderBy("cell", "lo").rowsBetween(*_BEFORE))
    return both.select("*", F.coalesce(slot, F.lit(0)).alias("slot"))


def place(docs: DataFrame, shards: int, slack: float = 0.0, vnodes: int = VNODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, home, shard, slot`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8, ``home`` the shard without bounds, ``slot`` the row's place in
    its shard, from 0 without gaps. A shard takes at most ``ceil((1 + slack) * rows / shards)`` rows; without slack
    counts are at most one apart.

    A null text counts as empty, a null id is an id like others. Rows that repeat id and text are kept as often as
    they occur, each with a slot of its own; other columns are not read. An empty table gives an empty result.
    """
    rows = sized(docs, id_col, text_col)
    same = rows.groupBy("cell", "point", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy("cell").orderBy("point", "doc_id", "size", "text_crc32")
    ranked = same.withColumn("rank", F.coalesce(F.sum("m").over(order.rowsBetween(*_BEFORE)), F.lit(0)))
    ranked = stored(ranked, "ranked")
    counts = ranked.groupBy("cell").agg(F.sum("m").alias("n"))
    nodes = ring(docs.sparkSession, shards, vnodes)
    cells = stored(_kept(counts, nodes, shards, slack), "cells")
    places = _stretches(cells, _walk(cells, nodes, shards, slack))
    by_cell = places.groupBy("cell").agg(F.first("home").alias("home"), F.collect_list(F.struct("lo", "hi", "shard", "slot")).alias("to"))
    # copies of one row are dealt to tasks in stretches, then one by one
    dealt = ranked.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(COPIES).cast("long"))))
    dealt = dealt.repartition("cell", "from").withColumn(
        "i", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + COPIES, F.col("m")) - 1))).withColumn("rank", F.col("rank") + F.col("i"))
    found = dealt.join(F.broadcast(by_cell), "cell")
    to = F.get(F.filter("to", lambda t: (t["lo"] <= F.col("rank")) & (F.col("rank") < t["hi"])), F.lit(0))
    return found.withColumn("__to", to).select("doc_id", "size", "text_crc32", "home", F.col("__to.shard").alias("shard"),
                                               (F.col("__to.slot") + F.col("rank") - F.col("__to.lo")).alias("slot"))
