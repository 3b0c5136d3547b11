"""Shards that each hold every source in its share of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import (
    KEY_SPAN, bucket_count, group_key, running_totals, shuffle_key)

OUTPUTS = ("shard", "slot")


def shard_documents(docs: DataFrame, shards: int, seed: int = 20) -> DataFrame:
    """Adds `shard` and `slot` by proportional stratified interleaving.

    The rows of each source are ranked in a seeded random order; rank r of n has the
    fraction (2r + 1) / 2n, and all rows are sorted by it. Any stretch of that order
    holds the sources in their shares to within a row each, so it is cut into shards
    whose counts differ by one at most; slot counts from 0 within a shard.

    All columns are passed on, whatever their names (but for a leading `__`, which is
    kept for the operator's own); columns named shard or slot are replaced. A null source
    is a source of its own, a null doc_id orders like an empty one. Ties are broken by
    doc_id, then by the remaining columns, so only rows alike in all of them may change
    places. An empty table gives an empty result; with fewer rows than shards some
    shards stay empty.
    """
    docs = docs.drop(*OUTPUTS)
    rows = docs.count()
    if not rows:
        return docs.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("bigint")})
    buckets = bucket_count(rows)
    ties = ["doc_id", *(f.name for f in docs.schema
                        if f.name != "doc_id" and f.dataType.typeName() not in ("map", "variant"))]
    drawn = docs.withColumns({
        "__source": group_key(F.col("source")),
        "__drawn": shuffle_key(F.lit(seed), F.col("doc_id"))})
    ranked = running_totals(drawn, "__source", "__drawn", ties, F.lit(1), buckets,
                            names=("__rank", "__count"))
    placed = ranked.withColumn("__fraction", F.floor(
        (2 * F.col("__rank") + 1) / (2 * F.col("__count")) * F.lit(float(KEY_SPAN))).cast("bigint"))
    ordered = running_totals(placed, None, "__fraction", ["__source", "__rank"], F.lit(1), buckets,
                             names=("__place", "__rows"))
    shard = F.expr(f"(__place * {shards}) div {rows}")
    slot = F.col("__place") - F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return (ordered.withColumn("shard", shard).withColumn("slot", slot)
            .withColumn("shard", F.col("shard").cast("int"))
            .drop("__source", "__drawn", "__fraction", "__rank", "__count", "__place", "__rows"))


def write_shards(sharded: DataFrame, folder: str, slots_per_file: int = 1_000_000) -> None:
    """One folder a shard, its files holding runs of slots in order."""
    (sharded.withColumn("__run", F.floor(F.col("slot") / slots_per_file))
     .repartition("shard", "__run").sortWithinPartitions("shard", "slot").drop("__run")
     .write.mode("overwrite").partitionBy("shard").parquet(folder))
