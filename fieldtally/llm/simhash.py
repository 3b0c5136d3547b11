"""SimHash near-duplicates by a self-join of the fingerprints' binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import (
    checkpointed, components, key_runs, merged_labels, with_columns_of)

SHINGLE = 4
MOST_BITS = 4
SEED = 42
#: A task's part of the trie holds about this many fingerprints of its own.
PART_SIZE = 2048
#: Most bits of the part number; parts grow beyond that.
MOST_PART_BITS = 20
#: Pairs of leaves are compared this many at a time.
PAIR_BLOCK = 1 << 20
LEAF = 8
BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the shingles' XXH64; no words give zero.

    Bytes split and lower-case at ASCII only, which is what the contract asks for. A
    long text is counted in blocks, so memory follows the text, not its 64 bits a word.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[b:e], SEED) for b, e in zip(starts, ends[span - 1:],
                                                                 strict=False)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), 8192):
        block = hashes[begin:begin + 8192].view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            counts[8 * byte:8 * byte + 8] += np.bincount(block[:, byte], minlength=256) @ BYTE_BITS
    bits = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp), fp as a signed 64-bit number."""
    def work(texts: list) -> tuple:
        return (np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64),)

    return with_columns_of(docs, "text", ["doc_id"], {"fp": "bigint"}, work)


def _first_labels(fps: np.ndarray, most_bits: int) -> np.ndarray:
    """Links that are cheap to find: fingerprints equal but for one 16-bit block."""
    label = np.arange(len(fps))
    for block in range(4):
        rest = fps & ~np.uint64(0xFFFF << (16 * block))
        order = np.argsort(rest, kind="stable")
        first = np.concatenate([[True], rest[order][1:] != rest[order][:-1]])
        head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        for other in (head, np.concatenate([order[:1], order[:-1]])):  # the head, the neighbour
            near = np.bitwise_count(fps[order] ^ fps[other]) <= most_bits
            label = merged_labels(order[near], other[near], label)
    return label


def trie_links(fps: np.ndarray, own: np.ndarray, lead_bits: int, most_bits: int,
               skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links (position, position of its root) among distinct sorted fingerprints.

    Node pairs of the binary trie are walked from the root down, all pairs of a level at
    once. A node is a range of the sorted array; a pair carries the bits in which its
    prefixes differ, and is dropped beyond lead_bits within the first 32 bits or
    most_bits in all. Pairs whose fingerprints are all in one component already are
    dropped too, for another link changes nothing: so a dense ball of near copies, whose
    nodes soon are of one component, is never compared pair by pair. Pairs of small
    nodes are compared outright. own marks fingerprints whose pairs are wanted: a pair
    of which neither is own is another task's.
    """
    label = _first_labels(fps, most_bits)
    found_left: list[np.ndarray] = []
    found_right: list[np.ndarray] = []
    owned = np.concatenate([[0], np.cumsum(own)])

    def frontier_prune(lo1, hi1, lo2, hi2, err, label, run_end):
        alive = (hi1 > lo1) & (hi2 > lo2)
        alive &= (owned[hi1] > owned[lo1]) | (owned[hi2] > owned[lo2])
        safe1, safe2 = np.minimum(lo1, len(fps) - 1), np.minimum(lo2, len(fps) - 1)
        uniform = (run_end[safe1] >= hi1) & (run_end[safe2] >= hi2)
        alive &= ~(uniform & (label[safe1] == label[safe2]))
        return tuple(x[alive] for x in (lo1, hi1, lo2, hi2, err))

    def ends_of_runs(label):
        change = np.flatnonzero(label[1:] != label[:-1]) + 1
        ends = np.append(change, len(label))
        return ends[np.searchsorted(ends, np.arange(len(label)), side="right")]

    run_end = ends_of_runs(label)
    zero, n = np.array([0]), np.array([len(fps)])
    front = frontier_prune(zero, n, zero, n, np.array([0]), label, run_end)
    for depth in range(skip, 65):
        lo1, hi1, lo2, hi2, err = front
        if not len(lo1):
            break
        small = ((hi1 - lo1) * (hi2 - lo2) <= LEAF * LEAF) | (depth == 64)
        if small.any():
            a, c, b, d = lo1[small], hi1[small], lo2[small], hi2[small]
            for begin in range(0, len(a), PAIR_BLOCK // (LEAF * LEAF)):
                part = slice(begin, begin + PAIR_BLOCK // (LEAF * LEAF))
                wide = (d - b)[part]
                sizes = (c - a)[part] * wide
                pair = np.repeat(np.arange(len(sizes)), sizes)
                inner = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                left = a[part][pair] + inner // wide[pair]
                right = b[part][pair] + inner % wide[pair]
                near = (left < right) & (np.bitwise_count(fps[left] ^ fps[right]) <= most_bits)
                near &= label[left] != label[right]
                if near.any():
                    found_left.append(left[near])
                    found_right.append(right[near])
                    label = merged_labels(left[near], right[near], label)
            run_end = ends_of_runs(label)
        if depth == 64:
            break
        lo1, hi1, lo2, hi2, err = (x[~small] for x in front)
        bit = np.uint64(63 - depth)
        ones = np.concatenate([[0], np.cumsum((fps >> bit) & np.uint64(1))]).astype(np.int64)
        mid1, mid2 = hi1 - (ones[hi1] - ones[lo1]), hi2 - (ones[hi2] - ones[lo2])
        cap = lead_bits if depth < 32 else most_bits
        same = (lo1 == lo2) & (hi1 == hi2)
        cross, mirror = err < cap, (err < cap) & ~same  # a node with itself has one mixed pair
        front = frontier_prune(
            np.concatenate([lo1, mid1, lo1[cross], mid1[mirror]]),
            np.concatenate([mid1, hi1, mid1[cross], hi1[mirror]]),
            np.concatenate([lo2, mid2, mid2[cross], lo2[mirror]]),
            np.concatenate([mid2, hi2, hi2[cross], mid2[mirror]]),
            np.concatenate([err, err, err[cross] + 1, err[mirror] + 1]), label, run_end)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return moved, label[moved]


def near_links(classes: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links (a, b) that join all fingerprints at most_bits or fewer differing bits.

    classes holds distinct fingerprints. Of two fingerprints that differ in at most d
    bits, the first or the second half differs in at most d // 2. So two tries, led by
    one half each, find all pairs with a small budget in the first 32 levels. The top of
    each trie is cut into parts by its first bits, their number growing with the table.
    A part receives its own fingerprints and those of the later parts whose number is
    within the budget of its own, and walks its part of the node pairs. The links that
    come back are a forest, so no more than the fingerprints sent out.
    """
    count = classes.count()
    bits = 0
    while bits < MOST_PART_BITS and (PART_SIZE << bits) < count:
        bits += 1
    half = most_bits // 2
    leads = [half, max(0, (most_bits - 1) // 2)]  # a pair beyond the first has fewer in the second

    def sent(turn: int) -> DataFrame:
        turned = F.col("fp") if not turn else F.shiftleft("fp", 32).bitwiseOR(
            F.shiftrightunsigned("fp", 32))
        home = F.shiftrightunsigned(turned, 64 - bits).cast("int") if bits else F.lit(0)
        places = [1 << i for i in range(bits)]
        masks = [0, *(places if leads[turn] >= 1 else [])]
        for _ in range(leads[turn] - 1):
            masks = sorted({m | p for m in masks for p in [0, *places]})
        parts = F.filter(F.transform(F.array(*map(F.lit, masks)), lambda m: home.bitwiseXOR(m)),
                         lambda part: part <= home)
        return classes.select(F.lit(turn).alias("turn"), turned.alias("turned"),
                              home.alias("home"), F.explode(parts).alias("part"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in key_runs(batches, ["turn", "part"]):
            run = run.sort_values("turned", key=lambda c: c.to_numpy().view(np.uint64))
            fps = run["turned"].to_numpy().view(np.uint64)
            own = (run["home"] == run["part"]).to_numpy()
            turn = int(run["turn"].iloc[0])
            left, right = trie_links(fps, own, leads[turn], most_bits)
            pairs = [fps[left], fps[right]]
            if turn:
                pairs = [(x << np.uint64(32)) | (x >> np.uint64(32)) for x in pairs]
            if len(left):
                yield pd.DataFrame({"a": pairs[0].view(np.int64), "b": pairs[1].view(np.int64)})

    dealt = sent(0).union(sent(1)).repartition("turn", "part").sortWithinPartitions("turn", "part")
    return dealt.mapInPandas(walk, "a bigint, b bigint")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE,
                  most_bits: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, fp (64 bits, signed), component_id.

    Texts whose fingerprints are at most_bits or fewer bits apart are linked, and
    component_id is the smallest doc_id reachable, its own included (null only where
    all ids of a component are null). Equal fingerprints are one node of the search. A
    null text, or one without words, has the fingerprint zero and is linked like any
    other. Rows may repeat; each has its row. Only doc_id and text are used. An empty
    table gives an empty result.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    classes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    rooted = components(near_links(classes.select("fp"), most_bits))
    nodes = classes.join(rooted, classes["fp"] == rooted["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = nodes.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
