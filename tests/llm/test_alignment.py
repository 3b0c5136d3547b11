"""Token alignment against a plain version of it over whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from fieldtally.llm.alignment import Aligner, align, align_tokens, byte_tokens, piece_model, piece_path
from fieldtally.llm.tokens import ids_of, tokenizer_path

SCHEMA = "doc_id bigint, text string"


def plain(texts):
    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=piece_path())
    table, (_, pieces) = byte_tokens(tokenizer_path()), piece_model(piece_path())
    told, count = [], Counter()
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        if not text or b"".join(table[i] for i in a) != whole or b"".join(pieces[i] for i in b) != whole:
            told.append(None)
            continue

        def spans(ids, known):
            at, made = 0, []
            for i in ids:
                made.append((at, at + len(known[i]), i))
                at += len(known[i])
            return made

        a, b = spans(a, table), spans(b, pieces)
        links = [(x[2], y[2]) for x in a for y in b if max(x[0], y[0]) < min(x[1], y[1])]
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, begin = [], 0
        for end in ends:
            groups.append(",".join(str(i) for s, e, i in a if begin <= s and e <= end) + "|"
                          + ",".join(str(i) for s, e, i in b if begin <= s and e <= end))
            begin = end
        count.update(links)
        told.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(n, best.get(y, 0))
    return [(0, 0, 0, 0, 0, 0, "") if t is None else (
        *t[:3], len(t[3]), sum(count[p] == best[p[1]] for p in t[3]), sum(count[p] for p in t[3]),
        hashlib.sha256(t[4].encode()).hexdigest()) for t in told]


def corpus():
    rng = random.Random(8)
    words = ["Straße", "tokenization", "alignment", "the", "naïve", "don't", "世界", "über", "x1y2",
             "Ünïcödé", "antidisestablishmentarianism", "<|endoftext|>", "</s>", "á", "🙂"]
    texts = [None, "", " ", "\n\n", "  two  spaces ", "▁piece", "tab\tand\x00nul", "<s>",
             "don't <|endoftext|><|endoftext|>", "这是没有空格的一句话" * 30, "a" * 3000, "ab" * 500]
    for _ in range(150):
        texts.append(rng.choice(["", "\n", "- "]) + rng.choice([" ", " ", "\n", "  "]).join(
            rng.choice(words) for _ in range(rng.randrange(1, 40))))
    return texts


def test_alignment_of_a_window():
    # ab c d over a bc d
    found = align(np.array([0, 1, 4]), np.array([2, 3, 4]), np.array([2, 3, 5]), np.array([1, 3, 5]))
    assert found.codes.tolist() == [2, 3, (1 << 20) + 3, (4 << 20) + 4]
    assert found.group_ends.tolist() == [3, 5]


def test_counts_and_groups_equal_a_plain_version(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, n_a int, found string").repartition(4)
    want = dict(enumerate(plain(texts)))
    for limits in ({}, {"chunk_bytes": 500, "most_windows": 3}):
        documents, pairs = align_tokens(docs, **limits)
        got = {r[0]: (*r[1:8],) for r in documents.select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
            "groups_sha256").collect()}
        assert got == want
        assert pairs.agg({"count": "sum"}).first()[0] == sum(w[3] for w in want.values())


def test_ids_of_parts_are_those_of_whole_texts(monkeypatch):
    rng = random.Random(81)
    marks = ["a", "Zürich", "don't", "'s", "!", "…", "12", "世", "🙂", "\u0301", "▁", " ", "  ", "   ",
             "\n", "\n\n", "\t", "\r\n", "\xa0", "\u2009", "\u3000", "\x1c", "\x85", "\u200b",
             "<|endoftext|>", "<0x41>"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(1, 30))) for _ in range(4000)]
    encode, (model, pieces) = ids_of(tokenizer_path()), piece_model(piece_path())
    for most_letters in (8 << 20, 50):
        monkeypatch.setattr("fieldtally.llm.alignment.MOST_LETTERS", most_letters)
        aligner = Aligner(tokenizer_path(), piece_path())
        for text in texts:
            second = model.encode(text)
            found = aligner.tokens(text.encode())
            if b"".join(pieces[i] for i in second) != b" " + text.encode():
                assert found is None
            else:
                assert found[0].tobytes() == encode(" " + text)
                assert found[1].tolist() == second
            assert aligner.letters <= most_letters + 1000


def test_texts_are_learned_together_as_one_by_one(monkeypatch):
    rng = random.Random(13)
    words = [f"word{n}" for n in range(300)]
    bodies = [" ".join(rng.choices(words, k=20)).encode() for _ in range(100)]
    calls = []
    monkeypatch.setattr("fieldtally.llm.alignment.align", lambda *a: calls.append(1) or align(*a))
    together = Aligner(tokenizer_path(), piece_path()).texts(bodies)
    assert len(calls) == 1
    # Texts that are not given back stand among others; their neighbours keep their tokens.
    bodies += [b"", b"\xff", *((t or "").encode() for t in corpus())]
    together += Aligner(tokenizer_path(), piece_path()).texts(bodies)[100:]
    assert len(calls) > 2
    want = plain([b.decode(errors="replace") if b != b"\xff" else None for b in bodies])
    single = Aligner(tokenizer_path(), piece_path())
    for body, got, expected in zip(bodies, together, want, strict=True):
        alone = single.text(body)
        assert got[:5] == alone[:5] == (*expected[:4], expected[6])
        assert got[5].tolist() == alone[5].tolist() and got[6].tolist() == alone[6].tolist()
        assert got[6].sum() == got[3]


def test_the_memory_of_windows_is_bounded():
    aligner = Aligner(tokenizer_path(), piece_path(), most_windows=50)
    for n in range(200):
        aligner.text(f"word{n} other{n} third".encode())
        assert len(aligner.told) <= 60
    assert aligner.text(b"\xff\xfe")[:5] == (0, 0, 0, 0, "")


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "same words here"), (1, "same words here"), (None, "same words"), (2, None)]
    got = sorted((r["doc_id"] or 0, r["n_links"], r["count_sum"]) for r in align_tokens(
        spark.createDataFrame(rows, SCHEMA))[0].collect())
    assert got == [(0, 2, 6), (1, 3, 8), (1, 3, 8), (2, 0, 0)]
    assert align_tokens(spark.createDataFrame([], SCHEMA))[0].count() == 0
