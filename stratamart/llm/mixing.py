"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of equal slots. Slot i takes the point frac(i * golden ratio),
looked up in the cumulative target weights, so every source is served evenly at
all times. A source's documents, in a fixed shuffled order, form one stream cut
into blocks as long as a slot; its r-th slot takes block r, from the start again
after the last, until the cap on repeats. Every step is a join, a group or a
running sum whose windows hold one bounded cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions_of, running_before, stored, text_mark

SLOT_WORDS = 32
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
RING = 2**31
GOLDEN = 1327217885  # RING / golden ratio, made odd: multiplying by it permutes the ring
CELL_ROWS = 20_000
CELL_SLOTS = 65_536
LOOKUP_CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: number, source_size and target.

    Sources by code point, null last, take the weights in turn. A target stops at
    ``most`` times the size; what is over goes to the others by weight. Sorted by
    size per weight, the stopped sources come first, so running sums find them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    totals = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                   .withColumn("number", F.row_number().over(by_name).cast("long") - 1))
    turn = (F.col("number") % len(weights)).cast("int") + 1
    w = totals.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn))
    w = w.withColumn("cap", most * F.col("source_size").cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "number")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    w = w.withColumn("level", level).withColumn("stopped", F.col("level") >= F.col("ratio"))
    free = F.min(F.when(~F.col("stopped"), F.struct("ratio", "number", "level"))).over(everything)["level"]
    target = F.when(F.col("stopped"), F.col("cap")).otherwise(F.col("w") * free)
    return w.select("number", "source", "source_size", target.alias("target"))


def schedule(targets: DataFrame, slot_words: int = SLOT_WORDS, most: int = MOST_REPEATS) -> DataFrame:
    """Rows (slot, number, rank, block): which block of which source fills each slot.

    ``targets`` has one row per source. A source that the points serve beyond its
    last permitted repeat leaves that slot empty.
    """
    spark = targets.sparkSession
    words = targets.agg(F.sum("target")).first()[0] or 0.0
    sources = targets.count()
    slots = spark.range(0, -(-int(round(words)) // slot_words), 1, partitions_of(spark)).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", (F.col("slot") % RING) * GOLDEN % RING)
    order = Window.orderBy("number")
    ends = F.round(F.sum("target").over(order) / F.lit(max(words, 1.0)) * RING).cast("long")
    width = RING // LOOKUP_CELLS
    arcs = (targets.withColumn("high", ends).withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0)))
                   .filter("high > low")
                   .withColumn("blocks", F.ceil(F.col("source_size") / slot_words))
                   .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
                   .select("number", "blocks", "low", "high", "cell"))
    if sources <= LOOKUP_CELLS:  # at most two rows per cell and source
        arcs = F.broadcast(arcs)
    dealt = (slots.withColumn("cell", F.floor(F.col("point") / width)).join(arcs, "cell")
                  .filter("point >= low AND point < high").select("slot", "number", "blocks", F.lit(1).alias("one")))
    ranked = running_before(dealt, "number", ["slot"], "one", "rank", F.floor(F.col("slot") / CELL_SLOTS))
    return ranked.filter(F.col("rank") < most * F.col("blocks")).select(
        "slot", "number", "rank", (F.col("rank") % F.col("blocks")).alias("block"))


def pieces(sized: DataFrame, slot_words: int = SLOT_WORDS) -> DataFrame:
    """Rows (row, number, block, words): the share of each document in the blocks of its source's shuffled stream."""
    cells = max(1, sized.count() // CELL_ROWS)
    key = F.xxhash64(F.lit("shuffle"), F.col("doc_id"), F.col("mark"))
    shuffled = sized.filter("size > 0").withColumn("key", key)
    cell = F.floor((F.shiftright(F.col("key"), 32) + 2**31) * cells / F.lit(2**32))
    placed = running_before(shuffled, "number", ["key", "doc_id", "mark", "row"], "size", "start", cell)
    end = F.col("start") + F.col("size")
    spread = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / slot_words), F.floor((end - 1) / slot_words))))
    words = F.least(end, (F.col("block") + 1) * slot_words) - F.greatest(F.col("start"), F.col("block") * slot_words)
    return spread.select("row", "number", "block", words.alias("words"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS,
        slot_words: int = SLOT_WORDS) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target and taken words.

    A document is taken at most ``most`` times. The shuffle depends on id and text alone, so
    reruns agree however the rows are dealt; rows equal in both are interchangeable, and
    which of them has which share is not told apart. A null id or source is a value like
    any other, null text has no words, repeated rows count each, an empty table
    gives no rows. Columns other than doc_id, text and source are ignored.
    """
    return _mix(docs, weights, share, most, slot_words).drop("mark")


def _mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS, slot_words: int = SLOT_WORDS) -> DataFrame:
    """``mix`` with the mark of each row's text."""
    sized = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               word_count("text").alias("size"), text_mark(), F.monotonically_increasing_id().alias("row")), "mix-sizes")
    targets = stored(source_targets(sized, weights, share, most), "mix-targets")
    numbered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "row", "doc_id", "size", "mark", sized["source"], "number", "source_size", "target")
    uses = schedule(targets, slot_words, most).groupBy("number", "block").agg(F.count("*").alias("uses"))
    taken = (pieces(numbered.select("row", "doc_id", "size", "mark", "number"), slot_words).join(uses, ["number", "block"])
             .groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken")))
    return numbered.join(taken, "row", "left").select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "mark")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with size, source_size, target and taken beside their own columns.

    Rows with the same id and text are one document: their taken words are added up.
    Columns of ``docs`` named like the added ones are replaced.
    """
    added = ("size", "source_size", "target", "taken")
    rows = _mix(docs, **how).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("mark").alias("_mark")).agg(
        F.max("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("taken")).filter("taken > 0")
    own = docs.drop(*added)
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & F.col("source").cast("string").eqNullSafe(F.col("_source"))
            & (F.col("_own_mark") == F.col("_mark")))
    return own.withColumn("_own_mark", text_mark()).join(rows, same).select(*own.columns, *added)
