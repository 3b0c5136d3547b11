"""Quality by attention-based multiple-instance learning over a document's passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import with_columns_of
from fieldtally.llm.samples import SAMPLE_BYTES, SAMPLE_ROWS, bounded_texts, labelled

PASSAGE_WORDS = 64
HIDDEN = 24
ATTENTION = 12
STEPS = 180
BATCH = 512
RATE = 0.02
DECAY = 1e-4

#: Kinds of bytes that are counted: letters by case, digits, white space, each common mark.
_KINDS = [bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" ", b"\n",
          b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b"|", b"*#$%&@~^_=+", b"'\"`", b"()[]{}<>",
          b"-/:;\\", bytes(range(128, 256))]
KIND_OF = np.zeros(256, dtype=np.int64)
for _number, _bytes in enumerate(_KINDS):
    KIND_OF[list(_bytes)] = _number
N_KINDS = len(_KINDS)
N_FEATURES = N_KINDS + 8


def passages(text: str | None) -> np.ndarray:
    """One row of features for each passage of PASSAGE_WORDS words of the whole text.

    Shares of each kind of byte, and of words: their number, mean length and spread of
    lengths, how many differ, how often the most common neighbour pair repeats, how many
    begin with a capital, end in a mark or hold a mark inside. A text without words is
    one passage of zeros.
    """
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros((1, N_FEATURES))
    letters = np.frombuffer(data, dtype=np.uint8)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.arange(0, len(words), PASSAGE_WORDS)
    count = len(starts)
    # A byte belongs to the passage of the last word begun at or before it.
    space = np.isin(letters, np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    edges = begins[starts]
    edges[0] = 0
    owner = np.repeat(np.arange(count), np.diff(np.append(edges, len(letters))))
    kinds = np.bincount(owner * N_KINDS + KIND_OF[letters], minlength=count * N_KINDS)
    kinds = kinds.reshape(count, N_KINDS)
    sizes = kinds.sum(axis=1, keepdims=True)
    number = np.diff(np.append(starts, len(words)))
    mean = np.add.reduceat(lengths, starts) / number
    spread = np.sqrt(np.maximum(np.add.reduceat(lengths * lengths, starts) / number - mean ** 2, 0))
    different = np.array([len(set(words[s:s + PASSAGE_WORDS])) for s in starts]) / number
    first, last = KIND_OF[letters[begins]], KIND_OF[letters[begins + lengths - 1]]
    same = np.concatenate([[0], [a == b for a, b in zip(words, words[1:], strict=False)]])

    def share(told: np.ndarray) -> np.ndarray:
        return np.add.reduceat(told.astype(np.int64), starts) / number

    words_told = np.stack([
        np.log1p(number) / 4, mean / 10, spread / 10, different, share(same),
        share(first == 1), share((last >= 6) & (last < 15)), share(last == 11)], axis=1)
    return np.concatenate([np.sqrt(kinds / sizes), words_told], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class QualityModel:
    """Encoder, gated attention and output of a document's passages."""

    centre: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, rows: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of the documents whose passages begin at starts, and what led to them."""
        p, lengths = self.parts, np.diff(np.append(starts, len(rows)))
        x = (rows - self.centre) / self.scale
        h = np.tanh(x @ p["W"] + p["c"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * g) @ p["w"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), lengths))
        a /= np.repeat(np.add.reduceat(a, starts), lengths)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "lengths": lengths,
                "score": _sigmoid(z @ p["o"] + p["b"])}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        bags = [passages(t) for t in texts]
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return self.forward(np.concatenate(bags), starts)["score"] if bags else np.zeros(0)


def fit(texts: list[str], labels: np.ndarray, seed: int = 20) -> QualityModel:
    """Learns from whole documents' labels alone which passages to attend to.

    Without texts, or with one label only, scores are the share of label 1 (0.5 without
    texts).
    """
    labels = np.asarray(labels, dtype=float)
    rng = np.random.default_rng(seed)
    bags = [passages(t) for t in texts] or [np.zeros((1, N_FEATURES))]
    stacked = np.concatenate(bags)
    rate = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    parts = {
        "W": rng.standard_normal((N_FEATURES, HIDDEN)) / np.sqrt(N_FEATURES),
        "c": np.zeros(HIDDEN), "V": rng.standard_normal((HIDDEN, ATTENTION)) / np.sqrt(HIDDEN),
        "U": rng.standard_normal((HIDDEN, ATTENTION)) / np.sqrt(HIDDEN),
        "w": rng.standard_normal(ATTENTION) / np.sqrt(ATTENTION),
        "o": np.zeros(HIDDEN), "b": np.array(np.log(rate / (1 - rate)))}
    model = QualityModel(stacked.mean(axis=0), stacked.std(axis=0) + 0.05, parts)
    if len(set(labels.tolist())) < 2:
        return model
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in parts.items()}
    for step in range(1, STEPS + 1):
        chosen = rng.choice(len(bags), min(BATCH, len(bags)), replace=False)
        starts = np.cumsum([0, *(len(bags[i]) for i in chosen[:-1])])
        f = model.forward(np.concatenate([bags[i] for i in chosen]), starts)
        p = model.parts
        slope = (f["score"] - labels[chosen]) / len(chosen)
        dz = np.repeat(np.outer(slope, p["o"]), f["lengths"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * da, starts)
        de = f["a"] * (da - np.repeat(mean, f["lengths"]))
        dt = np.outer(de, p["w"]) * f["g"] * (1 - f["t"] ** 2)
        dg = np.outer(de, p["w"]) * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        slopes = {"W": f["x"].T @ dx, "c": dx.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                  "w": (f["t"] * f["g"]).T @ de, "o": f["z"].T @ slope, "b": slope.sum()}
        for k, d in slopes.items():
            d = d + DECAY * p[k]
            m, v = moments[k]
            moments[k] = m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
            p[k] = p[k] - RATE * (m / (1 - 0.9 ** step)) / (
                np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          most_rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> QualityModel:
    """Fits on a bounded sample of usable labelled rows, all labels in their own share."""
    docs = docs.where(usable)
    # Both labels in one kind keeps their shares, which the scores then follow.
    known = labelled(docs, labels, label).where("label in (0, 1)").withColumn("kind", F.lit(0))
    sample = bounded_texts(docs, known, most_rows, most_bytes)
    return fit(sample["text"].tolist(), sample["label"].to_numpy())


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Rows (doc_id, score): how likely each whole text has label 1, from 0 to 1.

    Null and empty texts, and those of white space alone, are one passage without words,
    and all have that one's score. Rows may repeat, and each has its score; an empty
    table gives an empty result. Only doc_id and text are used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def work(texts: list) -> tuple:
        return (np.concatenate([shared.value.scores(texts[begin:begin + 256])
                                for begin in range(0, len(texts), 256)]),)

    return with_columns_of(docs, "text", ["doc_id"], {"score": "double"}, work)
