"""Embedding near-duplicates: hyperplane signs, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import checkpointed, components, key_runs, merged_labels

THRESHOLD = 0.95
#: The share of pairs at the threshold that some table must bring together.
RECALL = 0.999
BUCKET_ROWS = 256
#: Larger buckets are cut into blocks of this many rows, and each pair of blocks is a task's.
BLOCK_ROWS = 2048
STEP_ROWS = 512


def table_shape(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits a signature and number of tables, from the number of vectors."""
    bits = max(1, min(62, round(math.log2(max(2, rows / BUCKET_ROWS)))))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-agree ** bits))


@lru_cache(maxsize=8)
def hyperplanes(dimension: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, tables * bits))


def signatures(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One whole number of `bits` sign bits for each vector and table.

    Vectors are scaled first, so that sums of very large components stay finite.
    """
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    signs = vectors @ hyperplanes(vectors.shape[1], bits, tables, seed) >= 0
    weights = 1 << np.arange(bits, dtype=np.int64)
    return signs.reshape(len(vectors), tables, bits) @ weights


def _usable(embedding):
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return (embedding.isNotNull() & (F.size(embedding) > 0) & F.forall(embedding, finite)
            & F.exists(embedding, lambda x: x != 0))


def block_links(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """For each pair of blocks of a bucket: vectors with their links, and a forest of them.

    A pair is counted in the first table that brings it together, and only there.
    """
    for run in key_runs(batches, ["dimension", "turn", "bucket", "low", "high"]):
        if len(run) < 2:
            continue
        turn = int(run["turn"].iloc[0])
        unit = np.stack(run["embedding"].to_numpy()).astype(np.float64)
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        signs = np.stack(run["signs"].to_numpy())[:, :turn]
        copies, node = run["copies"].to_numpy(), run["node"].to_numpy()
        block = run["block"].to_numpy()
        split = bool(run["low"].iloc[0] != run["high"].iloc[0])
        links = np.zeros(len(run), dtype=np.int64)
        label = np.arange(len(run))
        for begin in range(0, len(run), STEP_ROWS):
            near = unit[begin:begin + STEP_ROWS] @ unit.T >= threshold
            left, right = near.nonzero()
            left += begin
            keep = left < right
            if split:
                keep &= block[left] != block[right]
            left, right = left[keep], right[keep]
            if turn and len(left):
                new = ~(signs[left] == signs[right]).any(axis=1)
                left, right = left[new], right[new]
            links += np.bincount(left, copies[right], len(run)).astype(np.int64)
            links += np.bincount(right, copies[left], len(run)).astype(np.int64)
            label = merged_labels(left, right, label)
        found = links > 0
        if found.any():
            yield pd.DataFrame({"a": node[found], "b": node[label[found]], "links": links[found]})


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                    seed: int = 50) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one dimension are linked if their cosine, in double precision, is at
    least the threshold and one of the tables gives them the same signs. Tables grow
    with the number of vectors, so that a pair at the threshold is found with the
    probability `recall`, a closer one more surely. Equal vectors are one node with so
    many copies. Buckets are compared whole: large ones as pairs of blocks, each a task
    of its own. Tasks return numbers of links and a forest, never pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing and are components of their own. A null vec_id counts as a link, but is no
    component's name unless nothing else is. Only vec_id and embedding are used. Rows
    may repeat; an empty table gives an empty result.
    """
    rows = vectors.select("vec_id", "embedding")
    usable = rows.where(_usable(F.col("embedding")))
    nodes = checkpointed(usable.groupBy("embedding").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()))
    bits, tables = table_shape(nodes.count(), threshold, recall)
    # What goes to every table is no wider than it has to be; cosines are doubles all the same.
    vector = nodes.schema["embedding"].dataType.simpleString()
    width, short = ("int", np.int32) if bits < 32 else ("bigint", np.int64)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("dimension", sort=False):
                matrix = np.stack(part["embedding"].to_numpy()).astype(np.float64)
                yield part.assign(signs=list(signatures(matrix, bits, tables, seed).astype(short)))

    signed = nodes.select("node", "copies", F.size("embedding").alias("dimension"),
                          "embedding").mapInPandas(
        sign, f"node bigint, copies bigint, dimension int, embedding {vector}, signs array<{width}>")
    dealt = signed.select("*", F.posexplode("signs").alias("turn", "bucket"))
    key = ["dimension", "turn", "bucket"]
    large = dealt.groupBy(*key).count().where(F.col("count") > BLOCK_ROWS).select(
        *key, F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    cut = (dealt.join(large, key, "left").withColumn("block", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
           .select(*key, "low", "high", "block", "node", "copies", "embedding", "signs"))
    order = [*key, "low", "high"]
    found = checkpointed(cut.repartition(*order).sortWithinPartitions(*order).mapInPandas(
        lambda batches: block_links(batches, threshold), "a bigint, b bigint, links bigint"))
    rooted = components(found.select("a", "b"))
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    full = (nodes.join(linked, "node", "left").join(rooted, "node", "left")
            .select("embedding", "first_id", F.coalesce("root", "node").alias("root"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    smallest = full.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = full.join(smallest, "root").select("embedding", "n_links", "component_id")
    lone = rows.where(~F.coalesce(_usable(F.col("embedding")), F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.join(named, "embedding").select("vec_id", "n_links", "component_id").union(
        lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
