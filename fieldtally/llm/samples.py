"""Bounded samples of rows to fit classifiers on."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of what one class of one fit takes: rows, and bytes of their texts.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 16_000_000
#: Bound of classes: those with most rows.
MOST_KINDS = 256
#: Of a large class, rows whose hash is low are looked at: about so many times the bound.
LOOKED_AT = 4
HASHES = 1 << 32


def _body() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sizes(docs: DataFrame, *columns) -> DataFrame:
    """doc_id, a hash of the text (body), its bytes, and more columns, but not the text."""
    return docs.select("doc_id", _body().alias("body"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), *columns)


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, body, bytes and label of documents with one; texts stay where they are.

    Of several labels of one id the largest counts.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max(label).alias("label"))
    return sizes(docs).join(known, "doc_id")


def bounded_rows(docs: DataFrame, rows: DataFrame, most_rows: int = SAMPLE_ROWS,
                 most_bytes: int = SAMPLE_BYTES, seed: int = 70,
                 most_kinds: int = MOST_KINDS) -> DataFrame:
    """Whole texts of a seeded sample of each kind: the columns of rows, drawn, and text.

    rows has doc_id, body, bytes and kind (null: left out). Rows alike in all of these are
    one. Of each kind the first most_rows rows in a hashed order of doc_id and text are
    candidates, without texts of more than most_bytes, and of these, in the same order, as
    many as most_bytes hold together. Of more than most_kinds kinds those with most rows
    count. A kind with many more rows is first cut by a limit on the hash that leaves a few
    times most_rows, so no task ranks a kind as a whole, however often an id or a row
    occurs. Null texts are empty.
    """
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "body"), F.lit(HASHES))
    rows = rows.where(F.col("kind").isNotNull() & (F.col("bytes") <= most_bytes)).withColumn("drawn", drawn)
    # Repeated rows share a hash, so classes are measured by their different rows.
    counts = rows.groupBy("kind").agg(
        F.approx_count_distinct(F.xxhash64("doc_id", "body")).alias("__rows"))
    counts = counts.orderBy(F.col("__rows").desc(), "kind").limit(most_kinds)
    enough = LOOKED_AT * most_rows
    limit = F.when(F.col("__rows") > enough, F.floor(F.lit(HASHES) * enough / F.col("__rows"))).otherwise(HASHES)
    low = rows.join(counts, "kind").where(F.col("drawn") <= limit).drop("__rows").dropDuplicates(
        ["doc_id", "body", "kind"])
    ranked = Window.partitionBy("kind").orderBy("drawn", "doc_id", "body")
    within = ranked.rowsBetween(Window.unboundedPreceding, 0)
    chosen = (low.withColumns({"__rank": F.row_number().over(ranked),
                               "__upto": F.sum("bytes").over(within)})
              .where((F.col("__rank") <= most_rows) & (F.col("__upto") <= most_bytes))
              .drop("__rank", "__upto", "bytes"))
    # At most most_rows slim rows of each kind, so small enough to send to every task.
    texts = docs.select(F.col("doc_id").alias("__id"), _body().alias("__body"),
                        F.coalesce("text", F.lit("")).alias("text"))
    same = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__body") == F.col("body"))
    found = texts.join(F.broadcast(chosen), same).drop("__id", "__body")
    return found.dropDuplicates(["doc_id", "body", "kind"])


def bounded_texts(docs: DataFrame, rows: DataFrame, most_rows: int = SAMPLE_ROWS,
                  most_bytes: int = SAMPLE_BYTES, seed: int = 70) -> pd.DataFrame:
    """`bounded_rows` on the driver, whose memory their bounds bound."""
    found = bounded_rows(docs, rows, most_rows, most_bytes, seed).toPandas()
    return found.sort_values(["kind", "drawn", "text"]).drop(columns=["drawn", "doc_id", "body"])


def fitted_in_a_task(sample: DataFrame, fit: Callable[[Iterator[tuple]], Any]) -> Any:
    """What fit makes of (kind, text) of all rows of a bounded sample, in order.

    It runs in one task, which another executor repeats if the first is lost; only the
    model comes to the driver.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(
            batch.column("kind").to_pylist(), batch.column("text").to_pylist(), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(pairs))], pa.binary())],
                                         names=["model"])

    one = sample.select("kind", "drawn", "text").repartition(1).sortWithinPartitions(
        "kind", "drawn", "text").select("kind", "text")
    row = one.mapInArrow(work, "model binary").first()
    # Where Spark knows that there are no rows, there is no task either.
    return fit(iter(())) if row is None else pickle.loads(row["model"])
