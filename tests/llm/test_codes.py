"""Vector codes against plain Lloyd rounds in whole numbers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from fieldtally.llm.codes import assigned, compress_vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, parts, entries, rounds):
    """rows of (vec_id, vector, label), all finite and of one width."""
    width = len(rows[0][1])
    edges = [width * p // parts for p in range(parts + 1)]
    numbers = [[math.floor(256 * Fraction(x)) for x in v] for _, v, _ in rows]
    cut = [[n[a:b] for a, b in zip(edges, edges[1:])] for n in numbers]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def near(part, p):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e)
                   for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = defaultdict(list)
            for row in cut:
                groups[near(row[p], p)[1]].append(row[p])
            new.append([[sum(c) // len(groups[e]) for c in zip(*groups[e])] if groups[e] else entry
                        for e, entry in enumerate(books[p])])
        books = new
    told = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(row[p], p) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in row) for row in found]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(rows, errors):
        by_label[label] += error
    return [(vec_id, label, "".join(f"{e:02x}" for _, e in row), error, by_label[label], told)
            for (vec_id, _, label), row, error in zip(rows, found, errors)]


def result(frame):
    return sorted((tuple(r) for r in frame.select(
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("spread", [1, 5, 10 ** 6])
@pytest.mark.parametrize("size", [1, 3, 64, 65, 700])
def test_nearest_entries_by_trees(spread, size):
    rng = np.random.default_rng([size, spread])
    points = rng.integers(-spread, spread + 1, (size, 4))
    points[size // 2:] = points[0]
    entries = np.vstack([rng.integers(-spread, spread + 1, (60, 4)), points[:1], points[:1]])
    choice, sums, counts = assigned(points, entries)
    distance = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert (choice == distance.argmin(axis=1)).all()
    for entry in range(len(entries)):
        assert counts[entry] == (choice == entry).sum()
        assert (sums[entry] == points[choice == entry].sum(axis=0)).all()


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.4, (12, 12))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.05, 12)).tolist(), [None, 1, 2][i % 3])
            for i in range(400)]
    rows += [(400 + i, rows[5][1], 2) for i in range(150)]
    bad = [(900, None, 1), (901, [0.1] * 11 + [None], 1), (902, [float("nan")] * 12, 1),
           (903, [float("inf")] * 12, 1)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    assert result(compress_vectors(frame, 4, 8, 2)) == sorted(plain(rows, 4, 8, 2), key=str)


def test_numbers_of_any_size(spark):
    rows = [(i, [x, -x / 3, 0.5], i % 2) for i, x in enumerate(
        [1e9, 1e9 + 1, 0.25, -3.5, 7e12, 1e3, 2.0 ** 40])]
    want = [(*r[:3], r[3] if r[3] < 1 << 63 else None) for r in plain(rows, 3, 3, 2)]
    got = compress_vectors(spark.createDataFrame(rows, SCHEMA), 3, 3, 2)
    assert [r[:4] for r in result(got)] == sorted(want, key=str)
    huge = spark.createDataFrame([(1, [1e308, -1e308], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    assert {r["vec_id"]: r["code"] for r in compress_vectors(huge, 2, 2, 2).collect()} == {
        1: "0000", 2: "0101"}


def test_few_odd_repeated_and_no_vectors(spark):
    rows = [(None, [0.1, 0.2], 1), (3, [0.5, 0.6], None), (3, [0.4, 0.6], None), (5, [1.0], 1),
            (6, [], 2), (4, [0.5, 0.6], 1)]
    found = {(r["vec_id"], r["label"]): r["code"] for r in compress_vectors(
        spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS part", "3 AS total"),
        16, 64, 2).collect()}
    assert found[5, 1] is None and found[6, 2] is None and found[4, 1] is not None
    assert len(found[None, 1]) == 32
    assert compress_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(1, [], 1)], SCHEMA)
    assert [r["code"] for r in compress_vectors(alone).collect()] == [None]
