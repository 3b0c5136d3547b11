"""Packing documents into sequences along a space-filling curve."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import with_columns_of
from fieldtally.llm.tokens import marked_ids_of, tokenizer_path

SEQUENCE = 2048
END = 1
HASHED = 256
DIMENSIONS = 3
BITS = 16
#: Text a partition: few partitions for little text, as each ends with a sequence not full.
PARTITION_BYTES = 16 << 20
MOST_PARTITION_BYTES = 512 << 20
#: Bytes of ids that a task holds before it hands pieces on.
OUT_BYTES = 8 << 20


@lru_cache(maxsize=1)
def projection(seed: int = 80) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((HASHED, DIMENSIONS))


def hashed_point(text: str) -> np.ndarray:
    """The document's byte trigrams hashed to 256 counts, scaled, projected to 3 numbers."""
    letters = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint32)
    if len(letters) < 3:
        return np.zeros(DIMENSIONS)
    mixed = (letters[:-2] * np.uint32(73856093)) ^ (letters[1:-1] * np.uint32(19349663)) \
        ^ (letters[2:] * np.uint32(83492791))
    counts = np.sqrt(np.bincount((mixed >> np.uint32(11)) & 255, minlength=HASHED))
    return counts / np.sqrt((counts * counts).sum()) @ projection()


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of points given as rows of whole coordinates.

    Skilling's transform: from the top bit down, each axis either inverts the lower bits
    of the first axis or exchanges them; a Gray code of the axes then gives the index.
    """
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(len(axes)):
            high = (axes[i] & q) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & (q - 1))
            first = np.where(high, axes[0] ^ (q - 1), axes[0] ^ swap)
            axes[i] = axes[i] ^ swap if i else first
            axes[0] = first
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((axes[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key


def curve_keys(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, curve): each text's place on the curve; null counts as empty."""
    def work(texts: list) -> tuple:
        points = np.array([hashed_point(t) for t in texts])
        # Scaled counts have length 1, so nearly all projections lie within 3 deviations.
        cells = np.clip((points / 3 + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        return (hilbert_key(cells),)

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_columns_of(texts, "text", ["doc_id", "text"], {"curve": "bigint"}, work)


def pack(docs: DataFrame, length: int = SEQUENCE, end: int = END,
         tokenizer: str | None = None) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Documents are ordered along a Hilbert curve through their hashed vectors and laid
    end to end; every `length` ids are a sequence, so neighbours on the curve share one
    and only a partition's last sequence is not full. Each document is its ids followed
    by the end id. ids holds a piece's ids as little-endian unsigned 32-bit numbers;
    start counts its document's ids before it; offset is its place in the sequence.

    The table is range-partitioned by curve key and a hash of doc_id, so copies of one
    text, which share a key, spread over partitions, and text is shuffled once. Each
    partition tokenises and packs as its rows stream through; sequence_id joins the
    partition's number and a count. Only doc_id and text are used. Null and empty texts
    are one end id; rows alike in both columns each have their pieces; a very long text
    is cut over as many sequences as it takes. A text that holds the string of an added
    token of the file has that token's id there. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()
    total = docs.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               -(-total // MOST_PARTITION_BYTES))
    parts = max(1, min(wide, -(-total // PARTITION_BYTES)))
    keyed = curve_keys(docs).withColumn("spread", F.xxhash64("doc_id"))
    order = ["curve", "spread", "doc_id"]
    laid = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")

    names = {"doc_id": None, "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(),
             "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = marked_ids_of(path)
        sequence, used = TaskContext.get().partitionId() << 33, 0
        last = np.array([end], dtype="<u4").tobytes()
        rows: list[tuple] = []
        held = 0
        kind = None

        def handed() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t or kind) for c, t in zip(columns, names.values(), strict=True)],
                names=list(names))

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                ids = encode(text) + last
                count = len(ids) // 4
                start = 0
                while start < count:
                    take = min(count - start, length - used)
                    rows.append((doc_id, start, take, ids[4 * start:4 * (start + take)], count,
                                 sequence, used))
                    start, used = start + take, used + take
                    if used == length:
                        sequence, used = sequence + 1, 0
                held += len(ids)
                if held >= OUT_BYTES:
                    yield handed()
                    rows, held = [], 0
        if rows:
            yield handed()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return laid.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
              "sequence_id bigint, offset bigint")
