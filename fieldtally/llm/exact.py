"""Exact dedup by a tree merge of digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import SPACES, checkpointed

FAN_IN = 8
KEYS = ["digest", "letters", "check"]
#: Of rows with equal keys, the first in this order stays.
BEST = ["less", "unknown", "doc_id"]


def _bare(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digest_of(text: Column) -> Column:
    """The SHA-256 of the text without white space, in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(_bare(text).cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, chars, digest, letters, check) of whole texts.

    chars counts the code points of the text as it stands. letters (the code points of
    the text without white space) and check (its XXH64) verify the digest.
    """
    text = F.col("text")
    return docs.select(
        "doc_id", F.length(F.coalesce(text, F.lit(""))).alias("chars"),
        digest_of(text).alias("digest"), F.length(_bare(text)).alias("letters"),
        F.xxhash64(_bare(text)).alias("check"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows the first of each key, with the rows of all added up.

    Rows pass as a stream; only the last key of a batch is held for the next one.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        found = pa.Table.from_batches([batch])
        if held is not None:
            found = pa.concat_tables([held, found]).combine_chunks()
        other = np.zeros(found.num_rows - 1, dtype=bool)
        for key in KEYS:
            column = found[key].combine_chunks()
            other |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.flatnonzero(other) + 1])
        rows = np.add.reduceat(found["rows"].to_numpy(), first)
        runs = found.take(pa.array(first))
        runs = runs.set_column(runs.schema.get_field_index("rows"), found.schema.field("rows"),
                               pa.array(rows, pa.int64()))
        yield from runs.slice(0, len(first) - 1).to_batches()
        held = runs.slice(len(first) - 1)
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _run(level: DataFrame) -> DataFrame:
    """Each partition's rows as one sorted run, a row for each key."""
    return level.sortWithinPartitions(*KEYS, *BEST).mapInArrow(_merged, level.schema)


def merge_runs(rows: DataFrame, nodes: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row for each class of equal digests: who stays, and how many they are.

    Every input partition is a node whose rows become a sorted run of digests. In each
    round, groups of at most fan_in nodes exchange parts of their runs: the node's number
    gets one more digit from the digest in place of its own, and the rows go to the
    partition of that number. It merges what its partners sent, by Spark's sort, which
    spills, and passes over it once as a stream; each digest keeps its best row (most
    chars, then smallest doc_id) and its count. After log(nodes) rounds all of a digest
    has met, spread over all nodes by digest, so no node ever holds more than its share;
    a text with a third of all rows is one row per node after the first run. Digests that
    agree are only merged if the length and a second hash agree too.
    """
    rounds = 1
    while fan_in ** rounds < nodes:
        rounds += 1
    fan_in = next(f for f in range(2, max(2, fan_in) + 1) if f ** rounds >= nodes)
    everyone = fan_in ** rounds
    level = _run(rows.select(
        *KEYS, (-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("unknown"), "doc_id",
        F.lit(1).cast("bigint").alias("rows"), F.spark_partition_id().alias("node")))
    home = F.pmod(F.col("check"), F.lit(everyone)).cast("int")
    for r in range(rounds):
        place = fan_in ** r
        digit = F.expr(f"node div {place}") % fan_in
        wanted = F.floor(home / place) % fan_in
        node = F.col("node") + (wanted - digit) * place
        level = _run(level.withColumn("node", node.cast("int")).repartitionById(everyone, "node"))
    return level.select(*KEYS, F.col("doc_id").alias("keep_id"), (-F.col("less")).alias("keep_chars"),
                        F.col("rows").alias("group_size"))


def exact_dedup(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, letters.

    Texts are equal when identical without the six white-space characters; of equal
    texts the one with most code points, then the smallest doc_id stays (a null doc_id
    only if all are null). Of rows alike in doc_id, text class and length one is kept.
    Null and empty texts, and those of white space alone, are equal. Only doc_id and
    text are used. An empty table gives an empty result.
    """
    rows = checkpointed(digests(docs))
    nodes = max(2, rows.rdd.getNumPartitions())
    classes = merge_runs(rows, nodes, fan_in)
    joined = rows.join(classes, KEYS)
    alike = Window.partitionBy("doc_id", "check", "letters", "chars").orderBy("digest")
    return joined.withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
        & (F.col("chars") == F.col("keep_chars")) & (F.row_number().over(alike) == 1)).select(
        "doc_id", "keep_id", "group_size", "kept", "digest", "letters")
