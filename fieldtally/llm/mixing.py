"""Mixing sources to target weights along a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import (
    KEY_SPAN, WORD, bucket_count, checkpointed, group_key, running_totals, shuffle_key)

BLOCK_WORDS = 128
MOST_EPOCHS = 3
#: A source's slots differ from its target by fewer blocks than this.
SLACK_BLOCKS = 16
#: So many sources' rows may be sent to every task.
SENT_SOURCES = 20_000
#: The golden ratio's fraction of 2^31, made odd: the schedule's points are i * STEP mod 2^31.
#: Whole numbers keep the points exact for any i; after 2^31 slots the same even set repeats.
POINTS = 1 << 31
STEP = 1327217885
#: The unit interval is cut into this many bins to look up a point's source by equality.
BINS = 4096


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rows (source_key, source_size) with `target` and the words of all sources.

    Sources in order of their key weigh 1, 2, 3, repeating, and share the sum of all
    sizes. No target exceeds MOST_EPOCHS times its source; the excess is shared again by
    weight. Sorted by room per weight, the sources that hit their limit come first, and
    the level of the others follows from running sums, so no loop is needed. One row a
    source passes through one window.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy("source_key"))
    weighed = sizes.withColumns({
        "weight": ((rank - 1) % 3 + 1).cast("double"),
        "room": (F.col("source_size") * MOST_EPOCHS).cast("double"),
        "words": F.sum("source_size").over(everything)})
    by_room = everything.orderBy(F.col("room") / F.col("weight"), "source_key").rowsBetween(
        Window.unboundedPreceding, -1)
    left = weighed.withColumns({
        "words_left": F.col("words") - F.coalesce(F.sum("room").over(by_room), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything)
        - F.coalesce(F.sum("weight").over(by_room), F.lit(0.0))})
    full = F.col("room") * F.col("weight_left") <= F.col("weight") * F.col("words_left")
    levels = left.withColumn("level", F.when(~full, F.col("words_left") / F.col("weight_left")))
    # The level of the first source that is not full holds for all after it.
    first = F.max(F.when(F.col("level").isNotNull(), F.struct(
        -F.col("room") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return levels.select(
        "source_key", "source_size", "words",
        F.least("room", F.coalesce(first * F.col("weight"), F.col("room"))).alias("target"))


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """Rows (slot, source_key, block): which block of which source each slot takes.

    Slot i has the point i * STEP mod 2^31, a golden-ratio sequence, which is mapped
    through the cumulative shares of the targets; the slots of a source, in order, take
    its blocks 0, 1, 2 and so on.
    """
    spark = targets.sparkSession
    along = Window.partitionBy(F.lit(0)).orderBy("source_key")
    share = F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(0)))
    upto = F.sum(share).over(along.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead("source_key").over(along).isNull()
    bounds = (targets.where("target > 0")
              .withColumn("hi", F.when(last, F.lit(POINTS)).otherwise(
                  F.round(upto * POINTS).cast("bigint")))
              .withColumn("lo", F.coalesce(F.lag("hi").over(along), F.lit(0)))
              .where("hi > lo"))
    width = POINTS // BINS
    bins = bounds.select("source_key", "lo", "hi", F.explode(F.sequence(
        F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("bin"))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.expr(f"((id % {POINTS}) * {STEP}) % {POINTS}").alias("point"))
    found = (points.withColumn("bin", F.expr(f"point div {width}")).join(bins, "bin")
             .where("point >= lo and point < hi").select("slot", "source_key"))
    ranked = running_totals(found, "source_key", "slot", [], F.lit(1), bucket_count(slots),
                            span=slots)
    return ranked.select("slot", "source_key", F.col("before").alias("block"))


def by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows joined with their source's row, without moving rows if there are few sources.

    A source with a third of all rows would meet in one task otherwise. With more sources
    than SENT_SOURCES the sides are shuffled, and adaptive execution may split the hot one.
    """
    few = sources.limit(SENT_SOURCES + 1).count() <= SENT_SOURCES
    return rows.join(F.broadcast(sources) if few else sources, "source_key")


def mix(docs: DataFrame, size: F.Column | None = None, block: int = BLOCK_WORDS,
        seed: int = 30) -> tuple[DataFrame, DataFrame]:
    """The mix as two tables: its sources and its spans of documents.

    sources: source_key, source_size, target. spans: doc_id, source, size, copy,
    source_key, epoch, and, where the mix takes words of the document in that epoch,
    slot, begin and length in words; a document that no slot takes has rows with a null
    slot. Each epoch shuffles a source's documents anew and joins them end to end; the
    stream is cut into blocks of equal words, so a block may begin and end within a
    document. A source's stream ends after MOST_EPOCHS epochs; a slot that the schedule
    sets beyond that end, by rounding, takes nothing.

    Only doc_id, text (or what size reads) and source are used, so other columns may
    have any name. A null text has no words, a null source is a source of its own and
    comes last, copy tells rows apart that are alike in doc_id, source and size. Without
    any words no document is taken. An empty table gives empty tables.
    """
    sized = docs.select("doc_id", "source",
                        (word_count(F.col("text")) if size is None else size).alias("size"))
    alike = Window.partitionBy("doc_id", "source", "size").orderBy("doc_id")
    rows = checkpointed(sized.withColumn("copy", F.row_number().over(alike)).withColumn(
        "source_key", group_key(F.col("source"))))
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    targets = checkpointed(source_targets(sizes))
    count, words = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    slots = -(-words // block)
    plan = schedule(targets, slots)
    epochs = F.least(F.lit(MOST_EPOCHS), F.ceil(
        (F.col("target") + SLACK_BLOCKS * block) / F.greatest("source_size", F.lit(1)))).cast("int")
    needed = targets.select("source_key", epochs.alias("epochs"))
    repeated = by_source(rows, needed).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.col("epochs") - 1, F.lit(0)))))
    # Epochs follow each other in the key, each in an order of its own.
    lane = KEY_SPAN >> 2
    drawn = shuffle_key(F.lit(seed), F.col("epoch"), F.col("doc_id"))
    keyed = repeated.withColumn("__key", F.col("epoch") * F.lit(lane) + F.shiftright(drawn, 2))
    placed = running_totals(keyed, "source_key", "__key", ["doc_id", "size", "copy"],
                            F.col("size"), bucket_count(max(count, 1)))
    cut = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(
        F.expr(f"before div {block}"), F.expr(f"(before + size - 1) div {block}")))))
    taken = cut.join(plan, ["source_key", "block"], "left")
    start = F.greatest("before", F.col("block") * block)
    end = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block)
    spans = taken.select(
        "doc_id", "source", "size", "copy", "source_key", "epoch", "slot",
        (start - F.col("before")).alias("begin"),
        F.when(F.col("slot").isNotNull(), end - start).alias("length"))
    return targets.drop("words"), spans
