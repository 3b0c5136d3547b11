"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import with_columns_of
from fieldtally.llm.samples import (
    SAMPLE_BYTES, SAMPLE_ROWS, bounded_rows, fitted_in_a_task, labelled, sizes)

LETTERS = re.compile(r"[^\W\d_]+")
GRAMS = (4, 5)
#: A feature is used if it is this many times as common among toxic as among unlabelled
#: texts, or the reverse, and not rare.
LIFT = 2.5
LEAST_TEXTS = 4
STEPS = 150
RATE = 0.1
DECAY = 1e-4
#: Words whose scores a task remembers; it forgets all beyond that.
MOST_WORDS = 400_000


def word_features(word: str) -> list[int]:
    """The CRC-32 of the word and of its letter sequences, its ends marked."""
    marked = f"<{word}>"
    return [crc32(marked[i:i + n].encode()) for n in GRAMS for i in range(len(marked) - n + 1)] + [
        crc32(marked.encode())]


def words_of(text: str) -> set[str]:
    return set(LETTERS.findall(text.lower()))


@dataclass
class ToxicModel:
    """A text's score adds, over its different words, the weights of their features."""

    weights: dict[int, float]
    bias: float
    known: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        get = self.weights.get
        return sum([w for w in map(get, word_features(word)) if w])

    def score(self, text: str | None) -> float:
        words = words_of(text or "")
        known = self.known
        if len(known) > MOST_WORDS:
            known.clear()
        for word in words.difference(known):
            known[word] = self.word(word)
        told = [w for w in words if known[w]]
        total = self.bias + sum([known[w] for w in sorted(told)])
        return 1 / (1 + math.exp(-min(max(total, -30.0), 30.0)))


class _Numbered(dict):
    """Numbers what it is asked for, in the order of asking."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def _pairs(counts: array, members: array) -> tuple[np.ndarray, np.ndarray]:
    """(position of the group, member) of all members of groups of so many."""
    return (np.repeat(np.arange(len(counts)), np.asarray(counts, dtype=np.int64)),
            np.asarray(members, dtype=np.int64))


def fit(positive: Iterable[str], unlabelled: Iterable[str], prior: float) -> ToxicModel:
    """`fit_kinds` of texts known to be toxic and of any texts."""
    pairs = chain(((0, t) for t in unlabelled), ((1, t) for t in positive))
    return fit_kinds(pairs, prior)


def fit_kinds(pairs: Iterable[tuple[int, str]], prior: float) -> ToxicModel:
    """A linear model with the least non-negative positive-unlabelled risk.

    With the prior p of toxic texts, the risk of calling unlabelled texts clean counts
    toxic ones among them wrongly, so p times the risk of calling known toxic texts
    clean is taken off; where that leaves less than zero, which only overfitting can
    bring about, the step goes the other way for that part. Without toxic or unlabelled
    texts every text scores the prior. pairs are (1, toxic text) and (0, any text); texts
    are read one by one and kept as numbers of their different words.
    """
    odds = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    words = _Numbered()
    sizes_of, members = (array("q"), array("q")), (array("q"), array("q"))
    for kind, text in pairs:
        own = [words[w] for w in sorted(words_of(text))]
        sizes_of[1 - kind].append(len(own))
        members[1 - kind].extend(own)
    counts = [len(n) for n in sizes_of]
    if not all(counts):
        return ToxicModel({}, odds)
    texts = [_pairs(*part) for part in zip(sizes_of, members, strict=True)]
    lengths, hashed = array("q"), array("L")
    for told in words:
        made = word_features(told)
        lengths.append(len(made))
        hashed.extend(made)
    n_words = len(words)
    del words, sizes_of, members
    features, feature = np.unique(np.asarray(hashed, dtype=np.uint32), return_inverse=True)
    word = np.repeat(np.arange(n_words), np.asarray(lengths, dtype=np.int64))
    seen = [np.bincount(feature, np.bincount(w, minlength=n_words)[word], len(features))
            for _, w in texts]
    lift = (seen[0] + 0.5) / (counts[0] + 1) / ((seen[1] + 0.5) / (counts[1] + 1))
    used = np.flatnonzero(((lift >= LIFT) & (seen[0] >= LEAST_TEXTS))
                          | ((lift <= 1 / LIFT) & (seen[1] >= LEAST_TEXTS)))
    place = np.full(len(features), -1)
    place[used] = np.arange(len(used))
    word, feature = word[place[feature] >= 0], place[feature[place[feature] >= 0]]
    telling = np.bincount(word, minlength=n_words) > 0
    texts = [(d[telling[w]], w[telling[w]], n) for (d, w), n in zip(texts, counts, strict=True)]

    weight, bias = np.zeros(len(used)), odds
    moment = [np.zeros(len(used) + 1), np.zeros(len(used) + 1)]

    def logits(part):
        doc, of, n = part
        return np.bincount(doc, np.bincount(word, weight[feature], n_words)[of], n) + bias

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def back(part, slope):
        doc, of, n = part
        inner = np.bincount(feature, np.bincount(of, slope[doc], n_words)[word], len(used))
        return np.append(inner, slope.sum()) / n

    for step in range(1, STEPS + 1):
        zp, zu = logits(texts[0]), logits(texts[1])
        as_clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        clean = back(texts[1], sigmoid(zu)) - prior * back(texts[0], sigmoid(zp))
        toxic = prior * back(texts[0], -sigmoid(-zp))
        slope = toxic + clean if as_clean >= 0 else -clean
        slope[:-1] += DECAY * weight
        moment[0] = 0.9 * moment[0] + 0.1 * slope
        moment[1] = 0.999 * moment[1] + 0.001 * slope * slope
        move = RATE * moment[0] / (1 - 0.9 ** step) / (
            np.sqrt(moment[1] / (1 - 0.999 ** step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
    return ToxicModel(dict(zip(features[used].tolist(), weight.tolist(), strict=True)), float(bias))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic",
          most_rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> ToxicModel:
    """Fits, in one task, on bounded samples of usable rows: known toxic ones, and any ones.

    The prior is the share of toxic ones among usable labelled rows.
    """
    docs = docs.where(usable)
    known = labelled(docs, labels, label)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    toxic = known.where("label = 1").select("doc_id", "body", "bytes", F.lit(1).alias("kind"))
    sample = bounded_rows(docs, toxic.union(sizes(docs, F.lit(0).alias("kind"))), most_rows, most_bytes)
    return fitted_in_a_task(sample, lambda pairs: fit_kinds(pairs, prior))


def score(docs: DataFrame, model: ToxicModel, passed: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The passed columns and `score`: how likely each whole text is toxic, from 0 to 1.

    Null and empty texts have the score of a text without words, which the bias gives.
    Rows may repeat, and each has its score; an empty table gives an empty result. Only
    text is read besides the passed columns, of which one named score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the samples

    def work(texts: list) -> tuple:
        return ([shared.value.score(t) for t in texts],)

    return with_columns_of(docs, "text", passed, {"score": "double"}, work)
