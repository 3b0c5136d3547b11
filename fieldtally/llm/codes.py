"""Vector codes: a codebook for each part of the vectors, learned by dual-tree Lloyd rounds.

Trees over the parts of a block of vectors and over a codebook's entries are walked
together. A pair of nodes is dropped when the boxes of both are farther apart than the
farthest corner of another pair; a node of parts with one entry left goes to it whole,
with its cached sum; parts of leaves that stay uncertain are compared in whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import checkpointed

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LEAF = 16
#: Whole numbers below this, squared and added up over a part, fit 64 bits.
SMALL = 1 << 28
#: Bits of the pieces in which sums of larger numbers are added up.
LIMB = 40

Codebooks = list[list[list[int]]]


def _finite(embedding: Column) -> Column:
    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return embedding.isNotNull() & F.coalesce(F.forall(embedding, good), F.lit(False))


def whole_number(x: float) -> int:
    """floor(256 * x), for any finite x."""
    return math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of all components: 64-bit numbers, or Python's where those are too small."""
    scaled = np.asarray(vectors, dtype=np.float64)
    if not scaled.size or np.abs(scaled).max() < SMALL / SCALE - 1:
        return np.floor(scaled * SCALE).astype(np.int64)
    return np.array([[whole_number(x) for x in row] for row in scaled.tolist()], dtype=object)


def cuts(width: int, parts: int) -> list[int]:
    """Where parts begin and end: equal parts if the width is a multiple of their number."""
    return [width * p // parts for p in range(parts + 1)]


class Tree:
    """Boxes, sums and counts of halves of halves of points, cut across their widest side."""

    def __init__(self, points: np.ndarray, leaf: int):
        size = len(points)
        self.depth = max(0, int(math.log2(size / leaf))) if size > leaf else 0
        self.order = np.arange(size)
        self.levels = []
        for level in range(self.depth + 1):
            starts = np.arange(1 << level) * size >> level
            held = points[self.order]
            low, high = np.minimum.reduceat(held, starts), np.maximum.reduceat(held, starts)
            self.levels.append((starts, low, high))
            if level < self.depth:
                counts = np.diff(np.r_[starts, size])
                node = np.repeat(np.arange(1 << level), counts)
                side = (high - low).argmax(axis=1)
                self.order = self.order[np.lexsort((held[np.arange(size), side[node]], node))]
        self.sums = [np.add.reduceat(points[self.order], starts) for starts, _, _ in self.levels]
        self.counts = [np.diff(np.r_[starts, size]) for starts, _, _ in self.levels]


def _bounds(low, high, entry_low, entry_high) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each pair of boxes."""
    gap = np.maximum(0, np.maximum(low[:, None] - entry_high, entry_low - high[:, None]))
    far = np.maximum(high[:, None] - entry_low, entry_high - low[:, None])
    return (gap * gap).sum(axis=2), (far * far).sum(axis=2)


def assigned(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each point (ties: lower index), and sums and counts by entry."""
    size, count = len(points), len(entries)
    choice = np.zeros(size, dtype=np.int64)
    sums = np.zeros(entries.shape, dtype=points.dtype)
    counts = np.zeros(count, dtype=np.int64)

    def settle(rows: np.ndarray, allowed: np.ndarray | None) -> None:
        off = points[rows][:, None] - entries
        distance = (off * off).sum(axis=2)
        if allowed is not None:
            distance = np.where(allowed, distance, np.iinfo(np.int64).max)
        choice[rows] = distance.argmin(axis=1)
        np.add.at(sums, choice[rows], points[rows])
        np.add.at(counts, choice[rows], 1)

    if not entries.shape[1]:  # parts without components are all equally near
        counts[0] = size
        return choice, sums, counts
    if points.dtype == object or entries.dtype == object:
        for begin in range(0, size, 1024):
            settle(np.arange(begin, min(begin + 1024, size)), None)
        return choice, sums, counts
    tree, book = Tree(points, LEAF), Tree(entries, 4)
    nodes = np.array([0])
    may = np.ones((1, 1), dtype=bool)
    depth = 0
    single = False
    for level in range(tree.depth + 1):
        starts, low, high = tree.levels[level]
        # The entries' tree goes down as fast, and at its leaves to single entries.
        while True:
            _, entry_low, entry_high = book.levels[depth]
            if single:
                entry_low = entry_high = entries[book.order]
            near, far = _bounds(low[nodes], high[nodes], entry_low, entry_high)
            best = np.where(may, far, np.iinfo(np.int64).max).min(axis=1)
            may &= near <= best[:, None]
            if single:
                break
            if depth < book.depth:
                depth += 1
                may = np.repeat(may, 2, axis=1)
            else:
                may, single = np.repeat(may, book.counts[depth], axis=1), True
            if level < tree.depth and not single:
                break
        if single:
            alone = may.sum(axis=1) == 1
            for node, entry in zip(nodes[alone].tolist(), may[alone].argmax(axis=1).tolist(),
                                   strict=True):
                entry = book.order[entry]
                begin = starts[node]
                own = tree.counts[level][node]
                choice[tree.order[begin:begin + own]] = entry
                sums[entry] += tree.sums[level][node]
                counts[entry] += own
            nodes, may = nodes[~alone], may[~alone]
        if level < tree.depth:
            nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
            may = np.repeat(may, 2, axis=0)
    if len(nodes):
        starts, own = tree.levels[-1][0], tree.counts[-1]
        rows = np.concatenate([tree.order[starts[n]:starts[n] + own[n]] for n in nodes])
        allowed = np.zeros((len(nodes), count), dtype=bool)
        allowed[:, book.order] = may
        settle(rows, np.repeat(allowed, own[nodes], axis=0))
    return choice, sums, counts


@lru_cache(maxsize=4)
def _arrays(books: tuple) -> list[np.ndarray]:
    made = []
    for part in books:
        large = any(abs(x) >= SMALL for entry in part for x in entry)
        made.append(np.array(part, dtype=object if large else np.int64).reshape(
            len(part), len(part[0]) if part else 0))
    return made


def _frozen(books: Codebooks) -> tuple:
    return tuple(tuple(tuple(entry) for entry in part) for part in books)


def _blocks(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(flat.reshape(batch.num_rows, width))


def part_sums(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Rows (part, entry, position, limb, total, n): sums of the parts nearest to each entry.

    A sum is that of total * 2^(40 * limb) over limbs; each task adds up its own first.
    """
    frozen, edges = _frozen(books), cuts(width, len(books))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, rows = _blocks(batch, width), []
            for part, entries in enumerate(_arrays(frozen)):
                _, sums, counts = assigned(numbers[:, edges[part]:edges[part + 1]], entries)
                for entry in counts.nonzero()[0].tolist():
                    for position, total in enumerate(sums[entry].tolist()):
                        sign, total, limb = (-1, -total, 0) if total < 0 else (1, total, 0)
                        while total or not limb:
                            rows.append((part, entry, position, limb,
                                         sign * (total & ((1 << LIMB) - 1)), int(counts[entry])))
                            total, limb = total >> LIMB, limb + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    names = ["part", "entry", "position", "limb", "total", "n"]
    found = vectors.select("embedding").mapInArrow(work, ", ".join(f"{n} bigint" for n in names))
    return found.groupBy("part", "entry", "position", "limb").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def _next_books(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Each entry the floor of its parts' mean; at most one row a number of the codebooks is read."""
    total: dict[tuple, int] = {}
    n: dict[tuple, int] = {}
    for r in sums.collect():
        key = (r["part"], r["entry"], r["position"])
        total[key] = total.get(key, 0) + (int(r["total"]) << (LIMB * r["limb"]))
        n[key] = max(n.get(key, 0), r["n"])
    return [[[total[p, e, i] // n[p, e, i] if (p, e, i) in n else x for i, x in enumerate(entry)]
             for e, entry in enumerate(part)] for p, part in enumerate(books)]


def learn_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                    rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """The codebooks of a table of finite vectors (vec_id, embedding), and the vectors' width."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = vectors.where(F.size("embedding") > 0).orderBy(*order).select(F.size("embedding")).first()
    width = head[0] if head else 0
    fitting = vectors.where(F.size("embedding") == width)
    first = [r["embedding"] for r in fitting.orderBy(*order).select("embedding").limit(entries).collect()]
    numbers = [[whole_number(x) for x in vector] for vector in first]
    edges = cuts(width, parts)
    books = [[v[a:b] for v in numbers] for a, b in zip(edges, edges[1:])]
    for _ in range(rounds if head else 0):
        books = _next_books(books, part_sums(fitting, books, width))
    return books, width


def books_sha256(books: Codebooks) -> str:
    told = ",".join(str(x) for part in books for entry in part for x in entry)
    return hashlib.sha256(told.encode()).hexdigest()


def encode(vectors: DataFrame, books: Codebooks, width: int, passed: list[str]) -> DataFrame:
    """The passed columns with code (two hex digits a part) and error of each vector."""
    frozen, edges = _frozen(books), cuts(width, len(books))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = _blocks(batch, width)
            chosen, error = [], np.zeros(batch.num_rows, dtype=object)
            for part, entries in enumerate(_arrays(frozen)):
                own = numbers[:, edges[part]:edges[part + 1]]
                choice, _, _ = assigned(own, entries)
                off = own - entries[choice]
                error = error + (off * off).sum(axis=1).astype(object)
                chosen.append(choice)
            codes = np.stack(chosen, axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in passed), pa.array([row.tobytes().hex() for row in codes]),
                 pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())],
                names=[*passed, "code", "error"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in passed)
    return vectors.select(*passed, "embedding").mapInArrow(
        work, f"{kinds}, code string, error bigint")


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                     rounds: int = ROUNDS) -> DataFrame:
    """One row per finite vector: vec_id, label, code, error, label_error, codebooks_sha256.

    Components become floor(256 * x), exactly, whatever their size. Vectors are cut into
    equal consecutive parts, each with a codebook that starts as that part of the vectors
    with the smallest vec_ids (ties by components; a null id last) and is refined over all
    vectors. Equal distances go to the lower entry; an entry without parts stays. Only the
    codebooks reach the driver. label_error adds up error over equal labels, nulls
    together. An error beyond 64 bits is null, and counts as none in label_error.

    Vectors that are null or hold a null or non-finite component are dropped. Those of
    another length than the first one's (empty ones never are the first) have no code:
    code and error are null. Up to 256 entries a part are possible. Only vec_id, embedding
    and label are used; rows may repeat; an empty table gives an empty result.
    """
    kept = vectors.select("vec_id", "embedding", "label").where(_finite(F.col("embedding")))
    books, width = learn_codebooks(kept, parts, entries, rounds)
    fits = F.size("embedding") == width
    coded = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"),
                                 F.lit(0).cast("bigint").alias("error"))
    if width:
        coded = encode(kept.where(fits), books, width, ["vec_id", "label"])
    odd = kept.where(~fits if width else F.lit(True)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("bigint").alias("error"))
    coded = checkpointed(coded.union(odd))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy(F.col("label").alias("__label")).agg(
        F.coalesce(total, F.lit(0)).try_cast("bigint").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(books_sha256(books)).alias("codebooks_sha256"))
