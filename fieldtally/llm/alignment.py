"""Cross-tokenizer alignment: which tokens of two vocabularies lie on the same bytes.

A whole text is cut before spaces that neither vocabulary has a token run over. The ids of
such a part, and how they lie on its bytes, depend on the part alone, so they are worked
out once and remembered.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm.tokens import ids_of, tokenizer_path
from fieldtally.sinks.files import written

#: Text that one chunk row stands for, unless one document has more.
CHUNK_BYTES = 8 << 20
CHUNK_DOCS = 8192
#: Text whose new parts are tokenised and aligned together, unless one document has more.
TOGETHER_BYTES = 1 << 18
#: Parts that are tried together where one of more is not given back.
FEW_PARTS = 256
#: Parts that a task remembers; beyond it, or beyond 16 links for each, it starts anew.
MOST_WINDOWS = 200_000
#: Letters of text whose ids a task remembers, besides those of the documents at hand.
MOST_LETTERS = 8 << 20
#: A space behind a letter or mark, where no token of either vocabulary runs on.
CUT = re.compile(r"(?<=\S) ")
#: Ids of the second vocabulary start here in keys and codes.
SECOND = 1 << 20


def piece_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file.

    Its tokens are written in letters that stand for bytes: printable Latin-1 letters for
    themselves, the others, in order, for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    vocabulary = told["model"]["vocab"]
    table = [b""] * (max([*vocabulary.values(), *(t["id"] for t in told["added_tokens"])]) + 1)
    for token, number in vocabulary.items():
        if all(letter in letters for letter in token):
            table[number] = bytes(letters[letter] for letter in token)
    return table


@lru_cache(maxsize=2)
def piece_model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        table.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(number)
                     else piece.replace("▁", " ").encode())
    return model, table


class Links(NamedTuple):
    """Of ids on the same bytes: a code for each link, and where links and groups end.

    Two tokens link if their bytes overlap; a group ends where tokens of both end. A code
    is the first id times SECOND, plus the second.
    """
    codes: np.ndarray
    link_ends: np.ndarray
    group_ends: np.ndarray
    first_group: np.ndarray
    second_group: np.ndarray


def align(first: np.ndarray, second: np.ndarray, ends: np.ndarray, others: np.ndarray) -> Links:
    """The alignment of ids whose tokens end at these bytes of a text."""
    link_ends = np.sort(np.concatenate((ends, others)), kind="stable")
    link_ends = link_ends[np.append(link_ends[1:] != link_ends[:-1], True)]
    codes = first[np.searchsorted(ends, link_ends)].astype(np.int64) * SECOND
    codes += second[np.searchsorted(others, link_ends)]
    at = np.searchsorted(others, ends)
    group_ends = ends[others[at] == ends]
    return Links(codes, link_ends, group_ends, np.searchsorted(group_ends, ends),
                 np.searchsorted(group_ends, others))


NO_TOKENS = (0, 0, 0, 0, "", np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))


class Lists:
    """Many lists of numbers, by number, one after the other in one array."""

    def __init__(self, dtype: str):
        self.n = 0
        self.starts = np.zeros(1024, dtype=np.int64)
        self.values = np.zeros(4096, dtype=dtype)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate(
            (array, np.zeros(max(size, len(array)), array.dtype)))

    def __len__(self) -> int:
        return int(self.starts[self.n])

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        begin, n = len(self), self.n + len(sizes)
        self.starts = self._room(self.starts, n + 1)
        self.starts[self.n + 1:n + 1] = begin + np.cumsum(sizes)
        self.values = self._room(self.values, begin + len(values))
        self.values[begin:begin + len(values)] = values
        self.n = n

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.starts[rows + 1] - self.starts[rows]

    def take(self, rows: np.ndarray) -> np.ndarray:
        sizes = self.sizes(rows)
        upto = sizes.cumsum()
        total = int(upto[-1]) if len(upto) else 0
        return self.values[np.arange(total) + np.repeat(self.starts[rows] - upto + sizes, sizes)]


class Aligner:
    """Aligns whole texts, with a bounded memory of their parts."""

    def __init__(self, first_path: str, second_path: str, most_windows: int = MOST_WINDOWS):
        self.first = byte_tokens(first_path)
        self.encode = ids_of(first_path)
        self.model, self.second = piece_model(second_path)
        self.first_length = np.array([len(t) for t in self.first])
        self.second_length = np.array([len(t) for t in self.second])
        # Each id as text with what follows it: a comma, or the end of its side of a group.
        n_first = len(self.first)
        self.written = np.array([f"{n}{mark}" for marks, size in ((",|", n_first), (",;", len(self.second)))
                                 for mark in marks for n in range(size)], dtype="S")
        self.written_at = np.array([[0, n_first], [2 * n_first, 2 * n_first + len(self.second)]])
        self.written_length = np.char.str_len(self.written)
        # Merges never run over a cut if no piece holds a space behind something else.
        self.space = self.model.piece_to_id("▁")
        self.cuttable = self.space != self.model.unk_id() and not any(
            b" " in piece.lstrip(b" ") for piece in self.second)
        self.most_windows = most_windows
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.told: list[bytes] = []
        self.changed: set[int] = set()
        self.letters = 0
        self.ids = Lists("<u4"), Lists("<u4")
        self.codes, self.group_ends = Lists("<i8"), Lists("<i8")

    def gives_back(self, first: np.ndarray, second: np.ndarray, whole: bytes) -> bool:
        return (b"".join(map(self.first.__getitem__, first.tolist())) == whole
                and b"".join(map(self.second.__getitem__, second.tolist())) == whole)

    def learn(self, parts: list[str]) -> None:
        """Tokenises and aligns parts that are not known, many at once, and remembers each.

        Those that end in a letter or mark are tokenised in one go, with the space before
        each, as the places where they meet are cuts again. If the texts are not given
        back, a few at a time are tried, and those with parts that either tokenizer changes
        one by one.
        """
        self.letters += sum(map(len, parts)) + 16 * len(parts)
        inner = [p for p in parts if self.cuttable and p and not p[-1].isspace()]
        if inner:
            self._learn_together(inner)
        for part in parts if len(inner) < len(parts) else ():
            if part not in self.known:
                self._learn_alone(part)

    def _learn_together(self, parts: list[str]) -> None:
        whole = " " + " ".join(parts)
        first = np.frombuffer(self.encode(whole), dtype="<u4")
        second = np.array(self.model.encode(whole[1:]), dtype="<u4")
        if self.gives_back(first, second, whole.encode()):
            sizes = map(len, parts) if whole.isascii() else (len(p.encode()) for p in parts)
            self._remember(parts, first, second, np.cumsum([n + 1 for n in sizes]))
        elif len(parts) > FEW_PARTS:
            for at in range(0, len(parts), FEW_PARTS):
                self._learn_together(parts[at:at + FEW_PARTS])
        else:
            for part in parts:
                self._learn_alone(part)

    def _learn_alone(self, part: str) -> None:
        first = np.frombuffer(self.encode(" " + part), dtype="<u4")
        second = np.array(self.model.encode(part) or [self.space], dtype="<u4")
        whole = (" " + part).encode()
        if self.gives_back(first, second, whole):
            self._remember([part], first, second, np.array([len(whole)]))
            return
        row = self.known[part] = len(self.told)
        self.changed.add(row)
        self.told.append(b"")
        for lists, values in zip((*self.ids, self.codes, self.group_ends), (first, second, [], []),
                                 strict=True):
            lists.add(np.asarray(values, dtype=lists.values.dtype), np.array([len(values)]))

    def _remember(self, parts: list[str], first: np.ndarray, second: np.ndarray,
                  part_ends: np.ndarray) -> None:
        """Aligns the ids of parts, which end at these bytes of what both give back."""
        ends, others = self.first_length[first].cumsum(), self.second_length[second].cumsum()
        found = align(first, second, ends, others)
        upto = []
        for lists, at, values in ((self.ids[0], ends, first), (self.ids[1], others, second),
                                  (self.codes, found.link_ends, found.codes),
                                  (self.group_ends, found.group_ends, found.group_ends)):
            upto.append(np.searchsorted(at, part_ends) + 1)
            lists.add(values, np.diff(upto[-1], prepend=0))
        text, piece_ends = self._written(first, second, found)
        stops = piece_ends[upto[0] + upto[1] - 1].tolist()
        row = len(self.told)
        self.told += [text[a:b - 1] for a, b in zip([0, *stops], stops, strict=False)]
        self.known.update(zip(parts, range(row, row + len(parts)), strict=True))

    def _written(self, first: np.ndarray, second: np.ndarray, found: Links) -> tuple[bytes, np.ndarray]:
        """The ids of each group as text, the first's before the second's, and where each ends."""
        rows = [number + self.written_at[side][np.append(group[1:] != group[:-1], True).astype(int)]
                for side, (number, group) in enumerate(
                    ((first, found.first_group), (second, found.second_group)))]
        order = np.argsort(np.concatenate((2 * found.first_group, 2 * found.second_group + 1)),
                           kind="stable")
        pieces = np.concatenate(rows)[order]
        text = self.written[pieces].view(np.uint8)
        return text[text != 0].tobytes(), self.written_length[pieces].cumsum()

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's parts in the memory.

        Texts are cut where neither vocabulary has a token that runs on: the first splits
        before such a space, the second has no piece with a space inside. So the ids are
        those of the text in one go, groups end there, and parts that come again need be
        neither tokenised nor aligned again.
        """
        cut = [CUT.split(t) if self.cuttable else [t] for t in texts]
        parts = [p for of_text in cut for p in of_text]
        found = list(map(self.known.get, parts))
        if None in found:
            if (self.letters > MOST_LETTERS or len(self.told) > self.most_windows
                    or len(self.codes) > 16 * self.most_windows):
                self.forget()
            self.learn([p for p in dict.fromkeys(parts) if p not in self.known])
            found = list(map(self.known.__getitem__, parts))
        return np.split(np.array(found, dtype=np.int64), np.cumsum([len(c) for c in cut])[:-1])

    def tokens(self, body: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Both texts' ids, or nothing for a text that either does not give back."""
        try:
            text = body.decode()
        except UnicodeDecodeError:
            return None
        if not text:
            return None
        rows = self.rows([text])[0]
        first, second = (lists.take(rows) for lists in self.ids)
        if not self.changed.isdisjoint(rows.tolist()) and not self.gives_back(
                first, second, b" " + body):
            return None
        return first, second

    def texts(self, bodies: list[bytes]) -> list[tuple]:
        """Of each: (n_a, n_b, n_groups, n_links, SHA-256 of the groups, link codes, their counts)."""
        made = [NO_TOKENS] * len(bodies)
        asked, texts = [], []
        for at, body in enumerate(bodies):
            with contextlib.suppress(UnicodeDecodeError):
                if text := body.decode():
                    texts.append(text)
                    asked.append(at)
        if not asked:
            return made
        rows = self.rows(texts)
        every = np.concatenate(rows)
        sizes = np.array([len(r) for r in rows])
        counts = [np.add.reduceat(lists.sizes(every), np.cumsum(sizes) - sizes)
                  for lists in (*self.ids, self.group_ends, self.codes)]
        links = self.codes.take(every)
        links += np.repeat(np.arange(len(rows)) * SECOND ** 2, counts[3])
        codes, times = np.unique(links, return_counts=True)
        cuts = np.searchsorted(codes, np.arange(len(rows) + 1) * SECOND ** 2).tolist()
        codes %= SECOND ** 2
        odd = []
        for n, (at, numbers) in enumerate(zip(asked, zip(*(c.tolist() for c in counts), strict=True),
                                              strict=True)):
            parts = rows[n].tolist()
            if self.changed and not self.changed.isdisjoint(parts):
                odd.append(at)
                continue
            groups = hashlib.sha256(b";".join(map(self.told.__getitem__, parts))).hexdigest()
            part = slice(cuts[n], cuts[n + 1])
            made[at] = (*numbers, groups, codes[part], times[part])
        for at in odd:
            made[at] = self._whole(bodies[at])
        return made

    def _whole(self, body: bytes) -> tuple:
        """The same of a text with changed parts, which may yet be given back as a whole."""
        both = self.tokens(body)
        if both is None:
            return NO_TOKENS
        first, second = both
        found = align(first, second, self.first_length[first].cumsum(),
                      self.second_length[second].cumsum())
        groups = hashlib.sha256(self._written(first, second, found)[0][:-1]).hexdigest()
        codes, times = np.unique(found.codes, return_counts=True)
        return (len(first), len(second), len(found.group_ends), len(found.codes), groups, codes, times)

    def text(self, body: bytes) -> tuple:
        return self.texts([body])[0]


PAIRS = "array<struct<code:bigint,n:bigint>>"


def chunks(docs: DataFrame, first_path: str, second_path: str, chunk_bytes: int = CHUNK_BYTES,
           most_windows: int = MOST_WINDOWS) -> DataFrame:
    """A row for each few MB of text: its pairs of linked ids with counts, and its documents.

    place and times hold, document by document (`sizes` each), which of the pairs it has
    and how often, as 32-bit numbers.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("pairs", T._parse_datatype_string(PAIRS)),
        T.StructField("doc_id", T.ArrayType(id_type)),
        *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("n_a", "n_b", "n_groups", "n_links")),
        T.StructField("groups_sha256", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("place", T.BinaryType()), T.StructField("times", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first_path, second_path, most_windows)
        number = TaskContext.get().partitionId() << 33
        ids: list = []
        rows: list[tuple] = []
        waiting: list[bytes] = []
        held = waits = 0
        kind = None

        def handed() -> pa.RecordBatch:
            n_a, n_b, groups, links, told, codes, times = zip(*rows, strict=True)
            pairs, place = np.unique(np.concatenate(codes), return_inverse=True)
            count = np.concatenate(times)
            totals = np.bincount(place, count, len(pairs)).astype(np.int64)
            listed = pa.StructArray.from_arrays([pa.array(pairs), pa.array(totals)], ["code", "n"])

            def one(values, value_type=None) -> pa.Array:
                return pa.ListArray.from_arrays([0, len(values)], pa.array(values, value_type))

            return pa.RecordBatch.from_arrays(
                [pa.array([number]), one(listed), one(ids, kind), one(n_a, pa.int64()),
                 one(n_b, pa.int64()), one(groups, pa.int64()), one(links, pa.int64()),
                 one(told, pa.string()), one([len(c) for c in codes], pa.int64()),
                 pa.array([place.astype("<u4").tobytes()], pa.binary()),
                 pa.array([count.astype("<u4").tobytes()], pa.binary())], names=schema.names)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body"),
                                    strict=True):
                body = body.as_py()
                ids.append(doc_id)
                waiting.append(body)
                held += len(body)
                waits += len(body)
                full = held >= chunk_bytes or len(ids) >= CHUNK_DOCS
                if full or waits >= TOGETHER_BYTES:
                    rows += aligner.texts(waiting)
                    waiting, waits = [], 0
                if full:
                    yield handed()
                    number, ids, rows, held = number + 1, [], [], 0
        rows += aligner.texts(waiting)
        if rows:
            yield handed()

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", body.alias("body")).mapInArrow(work, schema)


def align_tokens(docs: DataFrame, first_path: str | None = None, second_path: str | None = None,
                 chunk_bytes: int = CHUNK_BYTES, most_windows: int = MOST_WINDOWS,
                 ) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): how the tokens of two vocabularies lie on each document's bytes.

    documents has doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256;
    pairs has a, b, count, best: every pair of ids linked anywhere, on how many links, and
    whether no other pair of that second id has more. Nothing is sampled: counts are over
    all links of all documents. Each chunk of text (a row of a written table) is met by
    the counts of its own pairs, so no table of all pairs goes to every task.

    Null and empty texts, and those that either tokenizer does not give back byte by byte,
    have no tokens: zeros and an empty string. Rows may repeat, a doc_id may be null; only
    doc_id and text are used. Long texts are tokenised whole; a part without spaces is as
    long as it is. An empty table gives empty results.
    """
    told = written(chunks(docs, first_path or tokenizer_path(), second_path or piece_path(),
                          chunk_bytes, most_windows), "chunks")
    listed = told.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    counted = listed.groupBy(F.col("pair.code").alias("code")).agg(F.sum("pair.n").alias("count"))
    second = F.col("code") % SECOND
    # A second id has no more pairs than the first vocabulary has ids.
    counts = written(counted.withColumn(
        "best", F.col("count") == F.max("count").over(Window.partitionBy(second))), "pairs")
    found = listed.select("chunk", "at", F.col("pair.code").alias("code")).join(counts, "code").groupBy(
        "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("found"))

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                def values(name: str, row=row, batch=batch):
                    return batch.column(name)[row].values

                pairs = values("found")
                count, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
                if pairs is not None:
                    count = pairs.field("count").to_numpy(zero_copy_only=False)
                    best = pairs.field("best").to_numpy(zero_copy_only=False).astype(np.int64)
                place = np.frombuffer(batch.column("place")[row].as_buffer(), dtype="<u4")
                times = np.frombuffer(batch.column("times")[row].as_buffer(), dtype="<u4").astype(np.int64)
                ends = np.cumsum(values("sizes").to_numpy())
                sums = {}
                for name, value in (("n_best", best), ("count_sum", count)):
                    upto = np.r_[0, (times * value[place]).cumsum()]
                    sums[name] = pa.array(upto[ends] - upto[np.r_[0, ends[:-1]]])
                yield pa.RecordBatch.from_arrays(
                    [sums[c] if c in sums else values(c) for c in columns], names=columns)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    documents = told.join(found, "chunk", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "sizes", "place", "times",
        "found").mapInArrow(
        work, f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "n_best bigint, count_sum bigint, groups_sha256 string")
    pairs = counts.select(F.floor(F.col("code") / SECOND).cast("int").alias("a"),
                          second.cast("int").alias("b"), "count", "best")
    return documents, pairs
