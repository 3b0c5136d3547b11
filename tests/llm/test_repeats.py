"""Removal of repeated strings against a plain search, and the suffix sort under it."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fieldtally.llm.induced import Scratch, shared_prefixes
from fieldtally.llm.repeats import remove_repeats


def plain_order(data, cap):
    order = sorted(range(len(data)), key=lambda i: data[i:])[::-1]
    shared = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and max(a, b) + k < len(data) and data[a + k] == data[b + k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("in_memory", [4, 16, 1 << 20])
def test_suffixes_and_common_prefixes(tmp_path, in_memory):
    rng = random.Random(11)
    cases = [b"a", b"aaaaaaaaaaaaaaaa", b"\0\0\xff\xff\0", b"mississippi" * 5, b"ab" * 40]
    for _ in range(60):
        letters = rng.choice([1, 2, 3, 26, 256])
        data = bytes(rng.randrange(letters) for _ in range(rng.randrange(1, 250)))
        cases.append(data * rng.randrange(1, 4))
    for n, data in enumerate(cases):
        folder = tmp_path / str(n)
        folder.mkdir()
        places, shared = shared_prefixes(
            np.frombuffer(data, np.uint8), 20, Scratch(str(folder), in_memory))
        assert (places.tolist(), shared.tolist()) == plain_order(data, 20)


def test_long_queues_and_arrays_go_to_files(tmp_path):
    data = np.frombuffer(random.Random(3).randbytes(20_000), np.uint8)
    shared_prefixes(data, 20, Scratch(str(tmp_path), 1000))
    assert list(tmp_path.iterdir())


def plain_removal(texts, length):
    bodies = [(t or "").encode() for t in texts]
    starts = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    rows = []
    for body in bodies:
        gone = [False] * len(body)
        for i in range(len(body) - length + 1):
            if starts[body[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rows.append((len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def corpus(seed, count=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñ世") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    passage, line, whole = prose(40), prose(12), prose(90)
    texts = [None, "", "short", whole, whole, whole + "x", "y" + whole, "z" * 900, "z" * 350,
             "ab" * 300, "b" + "ab" * 200, line * 20, prose(5) + line * 12,
             prose(20) + " " + prose(25) * 9 + prose(3), "x".join([prose(9)] * 30)]
    for _ in range(count):
        kind = rng.random()
        text = prose(rng.randrange(1, 60))
        if kind < 0.5:
            text += " " + passage[rng.randrange(40):] + " " + prose(rng.randrange(30))
        elif kind < 0.6:
            text += whole[rng.randrange(200):]
        texts.append(text)
    return texts


@pytest.mark.parametrize("limits", [{}, {"most": 3, "shard_bytes": 3000, "in_memory": 500}])
def test_removal_equals_a_plain_search(spark, limits):
    texts = corpus(5)
    docs = spark.createDataFrame(
        [(i, t, 7, "old") for i, t in enumerate(texts)],
        "doc_id bigint, text string, n_bytes int, text_key string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in remove_repeats(docs, 120, **limits).collect()}
    assert got == dict(enumerate(plain_removal(texts, 120)))
    assert sum(r[1] > 0 for r in got.values()) > 40


def test_repeated_rows_null_ids_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    text = " ".join(str(i) for i in range(300))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text[:399]), (3, None)], schema)
    rows = sorted((r["doc_id"] or 0, r["n_removed"], r["n_spans"]) for r in remove_repeats(docs).collect())
    n = len(text)
    assert rows == [(0, n, 1), (1, n, 1), (1, n, 1), (2, 0, 0), (3, 0, 0)]
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs, 10)
