"""Removal of long repeated strings: suffixes of text sorted by external induction.

Two equal strings of `length` bytes have the same least hashed gram, so text is cut into
stretches whose windows share that gram, and only stretches with a gram that occurs twice
can hold a repeated window. Those with the same gram meet in one shard, whose suffixes
are sorted (see `induced`); a window that shares `length` bytes with its neighbour in the
order occurs elsewhere.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm import induced
from fieldtally.llm.common import checkpointed
from fieldtally.sinks.files import written

LENGTH = 400
GRAM = 16
#: Windows of one stretch, over what one gram alone can lead; only repeated grams reach it.
MOST_WINDOWS = 4 * LENGTH
#: Bytes of stretches sorted together, unless one gram has more.
SHARD_BYTES = 4 << 20
#: A gram with more different stretches than this is told apart by what stands around it.
MOST_STRETCHES = 1024
TEXT_BLOCK = 1 << 20


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each 16 bytes in a row."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    mixed = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    mixed += (words[8:] ^ np.uint64(0x5851F42D4C957F2D)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def stretches(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """First window, end of windows and least hash of each stretch of a text's bytes.

    The last array tells whether windows of the stretch may equal each other: only if the
    gram occurs again, before the last of them.
    """
    found = []
    for begin in range(0, max(0, len(data) - length + 1), TEXT_BLOCK):
        part = data[begin:begin + TEXT_BLOCK + length - 1]
        hashes = gram_hashes(part)
        least = least_in_windows(hashes, length - GRAM + 1)
        cuts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        sizes = np.diff(np.r_[cuts, len(least)])
        pieces = -(-sizes // MOST_WINDOWS)
        starts = np.repeat(cuts, pieces)
        nth = np.arange(len(starts)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = starts + nth * MOST_WINDOWS
        stops = np.minimum(starts + MOST_WINDOWS, np.repeat(cuts + sizes, pieces))
        begins_gram = np.r_[0, (hashes[:len(least)] == least).cumsum()]
        found.append((starts + begin, stops + begin, least[starts].view(np.int64),
                      (begins_gram[stops - 1] > begins_gram[starts]).astype(np.int64)))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 4
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _with_bytes(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(body.alias("body")).withColumn("text_key", text_key(F.col("body")))


def occurrences(bodies: DataFrame, length: int) -> DataFrame:
    """Rows (text_key, key, content, start, stop, own): all stretches of all texts.

    content is a 128-bit hash of the stretch's bytes; own is 1 if it may repeat itself.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, columns, hashes = [], ([], [], [], []), []
            for row, body in enumerate(batch.column("body")):
                view = body.as_buffer()
                if view.size < length:
                    continue
                made = stretches(np.frombuffer(view, dtype=np.uint8), length)
                view = memoryview(view)
                hashes += [xxhash.xxh3_128_digest(view[a:b + length - 1])
                           for a, b in zip(made[0].tolist(), made[1].tolist(), strict=True)]
                texts.append(np.full(len(made[0]), row))
                for column, part in zip(columns, made, strict=True):
                    column.append(part)
            if texts:
                starts, stops, keys, own = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key").take(pa.array(np.concatenate(texts))),
                     pa.array(keys), pa.array(hashes, pa.binary()), pa.array(starts),
                     pa.array(stops), pa.array(own)],
                    names=["text_key", "key", "content", "start", "stop", "own"])

    return bodies.where(F.octet_length("body") >= length).mapInArrow(
        work, "text_key binary, key bigint, content binary, start bigint, stop bigint, own bigint")


def _kinds(rows: DataFrame) -> DataFrame:
    """(key, content, n, kinds) of rows (key, content, n, own) whose windows may repeat.

    Those are of keys that occur twice, or of a stretch that may repeat itself; such a one
    counts as one kind more, so that it is sorted even when alone.
    """
    counted = rows.groupBy("key", "content").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
    keys = counted.groupBy("key").agg(
        F.sum("n").alias("total"), (F.count(F.lit(1)) + F.max("own")).alias("kinds"),
        F.max("own").alias("any_own"))
    return counted.drop("own").join(keys.where("total > 1 or any_own > 0").select("key", "kinds"), "key")


def sorted_shard(batches: Iterator[pa.RecordBatch], length: int, in_memory: int,
                 ) -> Iterator[pa.RecordBatch]:
    """Of all stretches of a partition: which runs of their windows occur elsewhere in it."""
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        scratch = induced.Scratch(folder, in_memory)
        path, keys, contents, sizes = scratch.path(), [], [], []
        with open(path, "wb") as file:
            for batch in batches:
                keys.append(batch.column("key"))
                contents.append(batch.column("content"))
                for body in batch.column("body"):
                    view = body.as_buffer()
                    file.write(view)
                    file.write(b"\0")
                    sizes.append(view.size + 1)
        if not sizes:
            return
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        text = (np.fromfile(path, dtype=np.uint8) if total <= in_memory
                else np.memmap(path, dtype=np.uint8, mode="r"))
        order, shared = induced.shared_prefixes(text, length, scratch)
        # Only places with a whole window in their own stretch count; what lies between two
        # of them shares as much with both as they with each other.
        open_place = scratch.array(total, bool)
        open_place[:] = True
        for end in ends:
            open_place[max(0, end - length):end] = False
        repeated = scratch.array(total, bool)
        repeated[:] = False
        before, least = -1, 0
        for begin in range(0, total, in_memory):
            place, common = order[begin:begin + in_memory], shared[begin:begin + in_memory]
            valid = np.flatnonzero(open_place[place])
            if not len(valid):
                least = min(least, int(common.min()))
                continue
            bounds = np.r_[0, valid[:-1] + 1]
            low = np.minimum.reduceat(common[:valid[-1] + 1], bounds)
            low[0] = min(int(low[0]), least) if before >= 0 else 0
            hits = np.flatnonzero(low >= length)
            held = place[valid]
            repeated[held[hits]] = True
            inner = hits[hits > 0]
            repeated[held[inner - 1]] = True
            if len(hits) and hits[0] == 0:
                repeated[before] = True
            before = int(held[-1])
            rest = common[valid[-1] + 1:]
            least = int(rest.min()) if len(rest) else length
        key, content = pa.concat_arrays(keys), pa.concat_arrays(contents)
        first = ends - np.array(sizes)
        edges = np.flatnonzero(np.diff(np.r_[0, repeated.view(np.int8), 0]))
        begins, stops = edges[::2], edges[1::2]
        rows = np.searchsorted(ends, begins, side="right")
        for at in range(0, len(rows), 1 << 16):
            part = slice(at, at + (1 << 16))
            taken = pa.array(rows[part])
            yield pa.RecordBatch.from_arrays(
                [key.take(taken), content.take(taken), pa.array(begins[part] - first[rows[part]]),
                 pa.array(stops[part] - first[rows[part]])],
                names=["key", "content", "start", "stop"])


def split_stretch(body: bytes, anchor: int, low: int, high: int, length: int):
    """The windows of a stretch by where their gram stands and what must be around it.

    Yields (key, start, stop, low, high, own). A window's gram is the first with the hash
    `anchor`; its place in the window lies from low to high. Either half of these places
    has bytes in common that every such window holds around its gram: their hash is a key,
    equal for equal windows.
    """
    data = np.frombuffer(body, dtype=np.uint8)
    grams = np.flatnonzero(gram_hashes(data).view(np.int64) == anchor)
    windows = np.arange(len(data) - length + 1)
    at = grams[np.searchsorted(grams, windows)]
    middle = (low + high) // 2
    upper = at - windows >= middle
    cuts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (upper[1:] != upper[:-1])])
    run = None
    for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(windows)], strict=True):
        own = (middle, high) if upper[begin] else (low, middle)
        place = int(at[begin])
        after = max(0, length - GRAM - own[1] + 1)
        core = body[place - own[0]:place + GRAM + after]
        key = xxhash.xxh3_64_intdigest(core, (own[0] << 32) + own[1]) - (1 << 63)
        if run and run[0] == key:
            run[2], run[5] = end, 1
        else:
            if run:
                yield run
            run = [key, begin, end, *own, 0]
    yield run


def _split(hot: DataFrame, length: int) -> DataFrame:
    """Rows of stretches' parts: (above, whole, offset) name where a part comes from."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for key, start, stop, low, high, own in split_stretch(
                        r["body"], r["anchor"], r["low"], r["high"], length):
                    part = r["body"][start:stop + length - 1]
                    rows.append((r["key"], r["content"], start, key,
                                 xxhash.xxh3_128_digest(part), part, r["n"], r["anchor"], low, high, own))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=names)

    names = ["above", "whole", "offset", "key", "content", "body", "n", "anchor", "low", "high",
             "own"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
             pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    return hot.mapInArrow(
        work, "above bigint, whole binary, offset bigint, key bigint, content binary, "
              "body binary, n bigint, anchor bigint, low int, high int, own bigint")


def marked_windows(found: DataFrame, slim: DataFrame, length: int,
                   shard_bytes: int = SHARD_BYTES, most: int = MOST_STRETCHES,
                   in_memory: int = induced.IN_MEMORY) -> DataFrame:
    """Rows (key, content, start, stop): windows of the given stretches that occur elsewhere.

    found has distinct stretches (key, content, body, n, kinds, anchor, low, high) of
    grams with several; slim their kinds, low, high and width in bytes. A gram with more
    than `most` is no shard: its windows are dealt again by the bytes around the gram, in
    halves of the places where it may stand, until few differ, at the latest when the key
    is the window itself.
    """
    is_hot = (F.col("kinds") > most) & (F.col("high") - F.col("low") > 1)
    sums = slim.groupBy(is_hot.alias("hot")).agg(F.sum("width").alias("bytes")).collect()
    total = {r["hot"]: r["bytes"] for r in sums}
    if total.get(True):
        found = written(found, "stretches")
    shards = max(1, -(-total.get(False, 0) // shard_bytes))
    marks = found.where(~is_hot).select("key", "content", "body").repartition(shards, "key").mapInArrow(
        lambda batches: sorted_shard(batches, length, in_memory),
        "key bigint, content binary, start bigint, stop bigint")
    if not total.get(True):
        return marks
    parts = written(_split(found.where(is_hot), length), "parts")
    kinds = checkpointed(_kinds(parts.select("key", "content", "n", "own")))
    several = parts.join(kinds.where("kinds > 1").select(
        "key", "content", "kinds", F.col("n").alias("whole_n")), ["key", "content"])
    # Equal parts are one; their bytes travel once for each task that has them.
    below = written(several.groupBy("key", "content", "body", "anchor", "low", "high").agg(
        F.max("whole_n").alias("n"), F.max("kinds").alias("kinds")), "below")
    inner = marked_windows(below, below.select("kinds", "low", "high", F.octet_length("body").alias("width")),
                           length, shard_bytes, most, in_memory)
    return marks.union(_moved(_all_marks(inner, kinds), parts, length))


def _all_marks(sorted_marks: DataFrame, kinds: DataFrame) -> DataFrame:
    """Marks found by sorting, and those of stretches that occur twice: all their windows."""
    copied = kinds.where("n > 1").select(
        "key", "content", F.lit(0).cast("bigint").alias("start"),
        F.lit(None).cast("bigint").alias("stop"))
    return sorted_marks.union(copied)


def _moved(marks: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """Marks of parts as marks of the stretches that they were cut from."""
    width = F.octet_length("body")
    slim = parts.select("key", "content", "above", "whole", "offset", width.alias("width"))
    stop = F.coalesce("stop", F.col("width") - (length - 1))
    return slim.join(marks, ["key", "content"]).select(
        F.col("above").alias("key"), F.col("whole").alias("content"),
        (F.col("offset") + F.col("start")).alias("start"), (F.col("offset") + stop).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """Rows (text_key, spans): runs of bytes, as (start, stop), that repeated windows cover.

    One row for each distinct text that has any, by its SHA-256.
    """
    if length < GRAM + 8:
        raise ValueError(f"strings of {length} bytes are too short to be told by grams of {GRAM}")
    bodies = _with_bytes(docs)
    every = written(occurrences(bodies, length), "occurrences")
    counted = every.select("key", "content", F.lit(1).cast("bigint").alias("n"), "own")
    kinds = checkpointed(_kinds(counted))
    found = written(every.join(kinds.select("key", "content", "n", "kinds"), ["key", "content"])
                    .dropDuplicates(["text_key", "key", "content", "start"]), "stretches")
    # One place of each distinct stretch whose gram has others gives its bytes.
    places = 1 << (length - GRAM).bit_length()
    one = written(found.where("kinds > 1").groupBy("key", "content").agg(
        F.min(F.struct("text_key", "start", "stop")).alias("at"), F.max("n").alias("n"),
        F.max("kinds").alias("kinds")), "places")
    wanted = one.groupBy(F.col("at.text_key").alias("text_key")).agg(F.collect_list(F.struct(
        "key", "content", F.col("at.start").alias("start"), F.col("at.stop").alias("stop"), "n",
        "kinds")).alias("cuts"))
    width = F.col("at.stop") - F.col("at.start") + (length - 1)
    slim = one.select("kinds", F.lit(0).alias("low"), F.lit(places).alias("high"),
                      width.alias("width"))
    single = bodies.groupBy("text_key").agg(F.first("body").alias("body"))
    cut = single.join(wanted, "text_key").select("body", F.explode("cuts").alias("c")).select(
        "c.key", "c.content",
        F.substring("body", (F.col("c.start") + 1).cast("int"),
                    (F.col("c.stop") - F.col("c.start") + length - 1).cast("int")).alias("body"),
        "c.n", "c.kinds", F.col("c.key").alias("anchor"), F.lit(0).alias("low"),
        F.lit(places).alias("high"))
    marks = _all_marks(marked_windows(cut, slim, length, **limits), kinds)
    placed = found.select("text_key", "key", "content", "start", F.col("stop").alias("end")).join(
        marks.select("key", "content", F.col("start").alias("low"), F.col("stop").alias("high")),
        ["key", "content"]).select(
        "text_key", (F.col("start") + F.col("low")).alias("start"),
        F.coalesce(F.col("start") + F.col("high"), "end").alias("stop"))
    return placed.groupBy("text_key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("windows"))


def covered(windows: list, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows, given as runs of their starts in order, cover."""
    spans: list[list[int]] = []
    for start, stop in windows:
        end = stop + length - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256.

    Every byte covered by a string of `length` bytes of the text in UTF-8 that also starts
    elsewhere, in this or another document, is removed; what remains is joined. Matches
    never cross documents. Null and empty texts and those shorter than `length` keep all;
    of equal texts of that length nothing is left. Rows may repeat; only doc_id and text
    are used; an empty table gives an empty result. Nothing is sampled or capped: a
    shard's arrays are files beyond `in_memory` items, and grams with more than `most`
    different stretches are dealt again.

    kept is null where nothing was removed: there the text is all that is kept.
    """
    spans = repeated_spans(docs, length, **limits)
    single = _with_bytes(docs).groupBy("text_key").agg(F.first("body").alias("body"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, body, windows in zip(batch.column("text_key"), batch.column("body"),
                                          batch.column("windows").to_pylist(), strict=True):
                view = memoryview(body.as_buffer())
                runs = covered([(w["start"], w["stop"]) for w in windows], length)
                parts, at = [], 0
                for begin, end in runs:
                    parts.append(view[at:begin])
                    at = end
                kept = b"".join([*parts, view[at:]])
                rows.append((key.as_py(), sum(e - b for b, e in runs), len(runs), kept,
                             hashlib.sha256(kept).digest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["text_key", "n_removed", "n_spans", "kept", "kept_key"])

    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    changed = single.join(spans, "text_key").mapInArrow(
        work, "text_key binary, n_removed bigint, n_spans bigint, kept binary, kept_key binary")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select("doc_id", F.octet_length(body).cast("bigint").alias("n_bytes"),
                       text_key(body).alias("text_key"))
    return slim.join(changed, "text_key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), "kept",
        F.lower(F.hex(F.coalesce("kept_key", "text_key"))).alias("kept_sha256"))
