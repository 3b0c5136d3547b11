"""What several operators share: checkpoints, running totals over hot groups, components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.session import CHECKPOINT_KEY

#: Characters that count as white space in the contracts of the operators.
SPACES = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
#: Order keys are whole numbers below this.
KEY_SPAN = 1 << 60
ROWS_PER_BUCKET = 512
#: Bounds the rows of one window of offsets; buckets grow beyond it, their number does not.
MOST_BUCKETS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame with its lineage cut by files in the shared checkpoint folder.

    Only where the session names no folder (tests) is one made here.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(frame.sparkSession.conf.get(CHECKPOINT_KEY, None)
                                 or tempfile.mkdtemp(prefix="fieldtally-checkpoint-"))
    return frame.checkpoint()


def in_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def group_key(column: Column) -> Column:
    """A text that orders like the column by code point, with null last and never null."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def shuffle_key(*parts: Column) -> Column:
    """A seeded pseudo-random order: 60 bits of an MD5, which any engine can compute."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def bucket_count(rows: int) -> int:
    return max(1, min(MOST_BUCKETS, rows // ROWS_PER_BUCKET))


def running_totals(rows: DataFrame, group: str | None, key: str, ties: Sequence[str],
                   value: Column, buckets: int, span: int = KEY_SPAN,
                   names: tuple[str, str] = ("before", "total")) -> DataFrame:
    """Adds `before` and `total`: the sums of value over earlier rows and all rows of a group.

    names are what these two are called, where rows may have columns of that name.

    The order is by key, which must be spread evenly over [0, span), then by ties. Rows
    are cut into buckets by key, so that a group with most of the rows is spread over all
    tasks, and no task sees more than a bucket: sums of buckets become offsets, and a
    window runs within each bucket of each group.
    """
    before, total = names
    groups = [group] if group else []
    cut = rows.withColumns({
        "__bucket": F.floor(F.col(key) / F.lit(span / buckets)).cast("int"), "__value": value})
    sums = cut.groupBy(*groups, "__bucket").agg(F.sum("__value").alias("__sum"))
    along = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = (Window.unboundedPreceding, -1)
    offsets = sums.select(
        *groups, "__bucket",
        F.coalesce(F.sum("__sum").over(along.orderBy("__bucket").rowsBetween(*earlier)),
                   F.lit(0)).alias("__offset"),
        F.sum("__sum").over(along).alias(total))
    within = Window.partitionBy("__bucket", *groups).orderBy(key, *ties).rowsBetween(*earlier)
    local = cut.repartition("__bucket").withColumn(
        "__local", F.coalesce(F.sum("__value").over(within), F.lit(0)))
    return (local.join(offsets, ["__bucket", *groups])
            .withColumn(before, F.col("__local") + F.col("__offset"))
            .drop("__bucket", "__value", "__local", "__offset"))


def key_runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal keys of sorted batches, one frame each."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if batch.empty:
            continue
        values = batch[list(keys)].to_numpy()
        starts = [0, *((values[1:] != values[:-1]).any(axis=1).nonzero()[0] + 1), len(batch)]
        for begin, end in zip(starts, starts[1:], strict=False):
            key = tuple(values[begin])
            if held and key != last:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[begin:end])
            last = key
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def merged_labels(left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The smallest label reachable over pairs of positions, labels being positions too."""
    label = label.copy()
    while True:
        a, b = label[left], label[right]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not (label[label] == label).all():
            label = label[label]


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, root): the smallest node reachable from each node that has a link.

    links holds pairs (a, b). Alternates large-star and small-star steps, each two
    shuffles of links that only get fewer, until no link changes. A hub is met by a
    join, which adaptive execution may split, and by a minimum that is combined before
    the shuffle; nothing is gathered into a list.
    """
    def star(pairs: DataFrame, small: bool) -> DataFrame:
        if small:  # each node with its smaller neighbours
            sides = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        else:
            sides = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
                pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn(
            "m", F.least("u", "m"))
        joined = sides.join(least, "u")
        if not small:
            joined = joined.where("v > u")
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if small:
            moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                     .first())

    current = checkpointed(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(current)
    for _ in range(most_rounds):
        current = checkpointed(star(star(current, small=False), small=True))
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()


ARROW = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def with_columns_of(frame: DataFrame, column: str, passed: Sequence[str], added: dict[str, str],
                    work: Callable[[list], Sequence[Sequence]]) -> DataFrame:
    """The passed columns, untouched, and those that work makes from a column's values.

    added names the new columns and their types; one named like a passed column takes
    its place.
    """
    passed = [c for c in passed if c not in added]
    schema = T.StructType([*(frame.schema[c] for c in passed),
                           *(T.StructField(n, T._parse_datatype_string(k))
                             for n, k in added.items())])
    kinds = [ARROW[k] for k in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(batch.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in passed),
                     *(pa.array(m, k) for m, k in zip(made, kinds, strict=True))],
                    names=[*passed, *added])

    return frame.select(*dict.fromkeys([*passed, column])).mapInArrow(run, schema)
