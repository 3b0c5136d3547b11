"""Language identification by unigrams of pieces, summed over all segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import with_columns_of
from fieldtally.llm.samples import bounded_texts, sizes

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 6_000_000
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
START = "▁"
#: Words up to so many letters, with the mark of their start, are summed many at a time as plain
#: numbers, which stay above zero; longer ones one at a time in logs. Both sums are the same.
LONG = 40
#: Letters of a long word whose pieces are looked up at a time.
PART = 4096
ROUNDS = 3
#: The share of a language's probability that is spread over all pieces, seen or not.
SPREAD = 1e-3
#: The probability of a letter that is no piece, in every language.
ODD_LETTER = 1e-7
MOST_WORDS = 300_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[str]:
    """The vocabulary's pieces of letters, with or without the mark of a word's start."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not model.is_byte(i) and not model.is_control(i) and not model.is_unknown(i)}
    return sorted(p for p in pieces if p.removeprefix(START).isalpha() or p == START)


def words_of(text: str | None) -> list[str]:
    """Runs of letters; fractions and raised digits, which \\w takes too, are no words alone."""
    return [w for w in LETTERS.findall((text or "").lower())
            if w.isalpha() or any(map(str.isalpha, w))]


def _codes(stretches: Sequence[str], length: int) -> np.ndarray:
    flat = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype="<u4")
    return flat.reshape(-1, length).astype(np.uint64)


def _rolled(codes: np.ndarray, length: int, held: np.ndarray | None) -> np.ndarray:
    """Hashes of all stretches of `length` letters, from those one letter shorter."""
    tail = codes[:, length - 1:]
    return tail + np.uint64(1) if held is None else held[:, :tail.shape[1]] * _BASE + tail + np.uint64(1)


class Lattice:
    """Which pieces a word is made of, at every place. Pieces of any length count."""

    def __init__(self, pieces: Sequence[str]) -> None:
        self.tables = []
        self.most = max(map(len, pieces), default=1)
        for length in range(1, self.most + 1):
            numbers = [i for i, p in enumerate(pieces) if len(p) == length]
            names = [pieces[i] for i in numbers] or [START * length]
            codes = _codes(names, length)
            held = None
            for n in range(1, length + 1):
                held = _rolled(codes, n, held)
            hashes = held[:, 0]
            order = np.argsort(hashes)
            self.tables.append((hashes[order], np.array(numbers or [-1])[order]))
        self.missing = len(pieces)

    def _numbers(self, held: np.ndarray, length: int) -> np.ndarray:
        hashes, numbers = self.tables[length - 1]
        at = np.minimum(np.searchsorted(hashes, held), len(hashes) - 1)
        found = np.where(hashes[at] == held, numbers[at], self.missing)
        return np.where(found < 0, self.missing, found)

    def parts(self, word: str):
        """Tables of piece numbers for successive letters of a word: a row for each place
        where a piece may end, a column for each length of the piece."""
        for begin in range(0, len(word), PART):
            end = min(begin + PART, len(word))
            first = max(0, begin - self.most + 1)
            codes = _codes([word[first:end]], end - first)
            ends = np.full((end - first, self.most), self.missing)
            held = None
            for length in range(1, min(self.most, end - first) + 1):
                held = _rolled(codes, length, held)
                ends[length - 1:, length - 1] = self._numbers(held[0], length)
            yield ends[begin - first:]

    def groups(self, words: Sequence[str]):
        """(positions of words, number of letters, {(length, place): (rows, piece numbers)}).

        Only rows with a piece there are listed; of single letters, all are. Long words
        are left out.
        """
        marked = [(i, START + w) for i, w in enumerate(words) if len(w) < LONG]
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i, word in marked:
            by_length.setdefault(len(word), []).append((i, word))
        for n, members in sorted(by_length.items()):
            codes = _codes([s for _, s in members], n)
            found, held = {}, None
            for length in range(1, min(n, self.most) + 1):
                held = _rolled(codes, length, held)
                piece = self._numbers(held, length)
                for place in range(n - length + 1):
                    column = piece[:, place]
                    rows = np.flatnonzero(column != self.missing)
                    if length == 1:
                        found[length, place] = slice(None), column
                    elif len(rows):
                        found[length, place] = rows, column[rows]
            yield np.array([i for i, _ in members]), n, found


def _forward(chances: np.ndarray, n: int, found: dict) -> list[np.ndarray]:
    """Sums over all segmentations of each prefix; chances has a row for each piece."""
    rows = len(found[1, 0][1])
    sums = [np.ones((rows, chances.shape[1]))]
    for end in range(1, n + 1):
        total = np.zeros((rows, chances.shape[1]))
        for length in range(1, end + 1):
            some, column = found.get((length, end - length), (None, None))
            if column is not None:
                chance = chances[column]
                if length == 1:  # a letter that is no piece still has a small chance
                    chance = np.maximum(chance, ODD_LETTER)
                total[some] += sums[end - length][some] * chance
        sums.append(total)
    return sums


def _backward(chances: np.ndarray, n: int, found: dict) -> list[np.ndarray]:
    rows = len(found[1, 0][1])
    sums = [np.zeros((rows, chances.shape[1])) for _ in range(n)]
    sums.append(np.ones((rows, chances.shape[1])))
    for begin in range(n - 1, -1, -1):
        for length in range(1, n - begin + 1):
            some, column = found.get((length, begin), (None, None))
            if column is not None:
                chance = chances[column]
                if length == 1:
                    chance = np.maximum(chance, ODD_LETTER)
                sums[begin][some] += chance * sums[begin + length][some]
    return sums


def _logs_of(table: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(table)


def _piece_logs(logs: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The logs of the pieces' chances; a letter that is no piece still has a small chance."""
    found = logs[ends]
    found[:, 0] = np.maximum(found[:, 0], np.log(ODD_LETTER))
    return found


def _sum_on(sums: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Log sums over all segmentations up to each further letter.

    sums has a row for each of the last places, the newest last; pieces a row for each
    further letter, with the pieces that end there by length.
    """
    most = pieces.shape[1]
    found = np.full((most + len(pieces), pieces.shape[2]), -np.inf)
    found[most - len(sums):most] = sums
    back = pieces[:, ::-1]  # as the places where the pieces begin
    for i in range(len(pieces)):
        found[most + i] = np.logaddexp.reduce(found[i:most + i] + back[i], axis=0)
    return found[most:]


def _log_sum(lattice: Lattice, logs: np.ndarray, word: str) -> np.ndarray:
    """The log of a word's sum over all segmentations, by language."""
    sums = np.zeros((1, logs.shape[1]))
    for ends in lattice.parts(START + word):
        sums = np.concatenate([sums, _sum_on(sums, _piece_logs(logs, ends))])[-lattice.most:]
    return sums[-1]


def _long_uses(ends: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """How often each piece is used in a long word, over all segmentations by their chances."""
    n, most = ends.shape
    logs = _logs_of(chances)
    pieces = _piece_logs(logs, ends)
    start = np.zeros((1, 1))
    ahead = np.concatenate([start, _sum_on(start, pieces)])[:, 0]
    # Seen from the end, a piece ends where it begins.
    begins = np.full((n, most, 1), -np.inf)
    for length in range(1, min(most, n) + 1):
        begins[:n - length + 1, length - 1] = pieces[length - 1:, length - 1]
    behind = np.concatenate([start, _sum_on(start, begins[::-1])])[::-1, 0]
    uses = np.zeros(len(chances))
    for length in range(1, min(most, n) + 1):
        some = ends[length - 1:, length - 1]
        use = np.exp(ahead[:n - length + 1] + logs[some, 0] + behind[length:] - ahead[n])
        uses += np.bincount(some, use, len(chances))
    return uses


@dataclass
class LanguageModel:
    languages: list[str]
    lattice: Lattice
    chances: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    logs: np.ndarray | None = None

    def log_chances(self, words: Sequence[str]) -> np.ndarray:
        """A row for each word: the log of its sum over segmentations, by language."""
        found = np.zeros((len(words), len(self.languages)))
        for members, n, pieces in self.lattice.groups(words):
            found[members] = np.log(_forward(self.chances, n, pieces)[n])
        logs = None
        for i, word in enumerate(words):
            if len(word) >= LONG:
                logs = _logs_of(self.chances) if logs is None else logs
                found[i] = _log_sum(self.lattice, logs, word)
        return found

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        if self.logs is None or len(self.known) > MOST_WORDS:
            self.known, self.logs = {}, np.zeros((0, len(self.languages)))
        told = [words_of(t) for t in texts]
        new = sorted({w for words in told for w in words}.difference(self.known))
        for begin in range(0, len(new), 20_000):
            part = new[begin:begin + 20_000]
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)),
                                  strict=True))
            self.logs = np.concatenate([self.logs, self.log_chances(part)])
        names, scores = [], []
        for words in told:
            if not words or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            logs = self.logs[[self.known[w] for w in words]].sum(axis=0)
            best = int(np.argmax(logs))
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(logs - logs[best]).sum()))
        return names, scores


def fit(texts: dict[str, list[str]], path: str | None = None) -> LanguageModel:
    """Piece probabilities of each language by expectation maximisation.

    The vocabulary is fixed; a language's probabilities start even and are raised in
    each round by the number of times its words use a piece, over all segmentations in
    proportion to their chances. A share is spread over all pieces, so an unseen piece
    is unlikely but possible.
    """
    pieces = vocabulary(path or vocabulary_path())
    lattice = Lattice(pieces)
    languages = sorted(texts)
    table = np.zeros((len(pieces) + 1, len(languages)))
    for number, language in enumerate(languages):
        counted = Counter(w for t in texts[language] for w in words_of(t))
        words = sorted(counted)
        weights = np.array([counted[w] for w in words], dtype=float)
        groups = list(lattice.groups(words))
        long = [(n, np.concatenate(list(lattice.parts(START + w))))
                for w, n in zip(words, weights, strict=True) if len(w) >= LONG]
        chances = np.full((len(pieces) + 1, 1), 1 / max(1, len(pieces)))
        chances[-1] = 0
        for _ in range(ROUNDS):
            uses = np.zeros(len(pieces) + 1)
            for members, n, found in groups:
                ahead, behind = _forward(chances, n, found), _backward(chances, n, found)
                share = weights[members][:, None] / ahead[n]
                for (length, place), (some, column) in found.items():
                    use = (ahead[place][some] * chances[column]
                           * behind[place + length][some] * share[some])
                    uses += np.bincount(column, use[:, 0], len(pieces) + 1)
            for weight, ends in long:
                uses += weight * _long_uses(ends, chances)
            uses[-1] = 0
            total = uses.sum()
            seen = uses / total if total else np.full(len(uses), 1 / max(1, len(pieces)))
            chances = ((1 - SPREAD) * seen + SPREAD / max(1, len(pieces)))[:, None]
            chances[-1] = 0
        table[:, number] = chances[:, 0]
    return LanguageModel(languages, lattice, table)


def train(docs: DataFrame, usable: Column, most_rows: int = SAMPLE_ROWS,
          most_bytes: int = SAMPLE_BYTES, path: str | None = None) -> LanguageModel:
    """Fits on a bounded sample of each language among usable rows with a lang."""
    docs = docs.where(usable)
    sample = bounded_texts(docs, sizes(docs, F.col("lang").alias("kind")), most_rows, most_bytes)
    return fit({k: g["text"].tolist() for k, g in sample.groupby("kind")}, path)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows (doc_id, lang_pred, score) of whole texts.

    A text's words are its runs of letters, whole whatever their length, and a word's
    chance is the sum over all its segmentations into pieces of any length; the score is the chance of the language if
    all are equally likely beforehand. Texts that are null or have no letter are `und`
    with score 0, and so are all if no language was learned. Equal chances go to the
    first language by code point. Only doc_id and text are used; rows may repeat, and an
    empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def work(texts: list) -> tuple:
        names, scores = [], []
        for begin in range(0, len(texts), 500):
            found = shared.value.predict(texts[begin:begin + 500])
            names += found[0]
            scores += found[1]
        return names, scores

    return with_columns_of(docs, "text", ["doc_id"], {"lang_pred": "string", "score": "double"},
                           work)
