"""Sorted suffixes and their common prefixes by external induced sorting.

Every suffix is S (smaller than the one after it) or L. The leftmost S suffixes are
sorted by names of the pieces between them, in a recursion on the string of names; all L
suffixes then follow from an ascending scan, all S suffixes from a descending one. A
scan takes suffix tuples from a priority queue whose buffers go to disk, and puts in the
tuple of the suffix one place to the left, with the length of the prefix it shares with
its forerunner. Work is done on blocks of tuples; whole arrays beyond a bound of memory
are files.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

#: Items of one array kept in memory; longer ones are files in the scratch folder.
IN_MEMORY = 1 << 22
#: Tuples scanned at once.
BLOCK = 1 << 15
DIGITS = 256


class Scratch:
    """Arrays and files of one sort, in a folder that its owner removes."""

    def __init__(self, folder: str, in_memory: int = IN_MEMORY):
        self.folder, self.in_memory, self._files = folder, in_memory, 0

    def path(self) -> str:
        self._files += 1
        return os.path.join(self.folder, f"part{self._files}")

    def array(self, length: int, kind) -> np.ndarray:
        if length <= self.in_memory:
            return np.empty(length, dtype=kind)
        return np.memmap(self.path(), dtype=kind, mode="w+", shape=(length,))


class TupleQueue:
    """A monotone priority queue of suffix tuples: by key, then by arrival.

    Tuples arrive in blocks sorted by key, and are taken key by key. Those of one key
    are already in suffix order when they arrive, so each key needs a line, not a heap.
    Buffers beyond the bound are appended to a file for each key.
    """

    def __init__(self, scratch: Scratch, keys: int, kind: np.dtype):
        self.scratch, self.kind = scratch, kind
        self.held: list[list[np.ndarray]] = [[] for _ in range(keys)]
        self.files: dict[int, str] = {}
        self.rows = 0

    def put(self, keys: np.ndarray, tuples: np.ndarray) -> None:
        """Adds tuples in the order of their keys."""
        if not len(keys):
            return
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
            self.held[keys[begin]].append(tuples[begin:end])
        self.rows += len(keys)
        if self.rows > self.scratch.in_memory:
            for key, blocks in enumerate(self.held):
                if blocks:
                    with open(self.files.setdefault(key, self.scratch.path()), "ab") as file:
                        for block in blocks:
                            file.write(np.ascontiguousarray(block).tobytes())
                    self.held[key] = []
            self.rows = 0

    def take(self, key: int) -> Iterator[np.ndarray]:
        """The tuples of a key so far, in blocks."""
        if key in self.files:
            path = self.files.pop(key)
            with open(path, "rb") as file:
                while part := file.read(BLOCK * self.kind.itemsize):
                    yield np.frombuffer(part, dtype=self.kind)
            os.remove(path)
        blocks, self.held[key] = self.held[key], []
        self.rows -= sum(map(len, blocks))
        if blocks:
            whole = blocks[0] if len(blocks) == 1 else np.concatenate(blocks)
            for begin in range(0, len(whole), BLOCK):
                yield whole[begin:begin + BLOCK]

    def waits(self, key: int) -> bool:
        return bool(self.held[key]) or key in self.files


class Types:
    """Of a string whose last symbol, 0, is its smallest and only there: its suffixes' types.

    run holds the equal symbols from a place on, up to `cap`; before the symbol left of
    a place, its top bit set if the suffix there is S. All symbols of a run have one type.
    """

    def __init__(self, symbols: np.ndarray, scratch: Scratch, cap: int):
        size = len(symbols)
        self.smaller = scratch.array(size, bool)
        self.run = scratch.array(size, np.uint16) if cap else None
        self.flag = np.array(1, dtype=symbols.dtype) << (8 * symbols.dtype.itemsize - 1)
        self.before = scratch.array(size, symbols.dtype)
        found = 0
        step = max(1 << 10, scratch.in_memory)
        for begin in reversed(range(0, size, step)):
            end = min(begin + step, size)
            part = symbols[begin:end]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            lengths = np.diff(np.r_[starts, len(part)])
            rising = np.r_[part[starts[1:]] > part[starts[:-1]], True]
            goes_on = end < size and symbols[end] == part[-1]
            if end < size:
                rising[-1] = self.smaller[end] if goes_on else symbols[end] > part[-1]
            self.smaller[begin:end] = np.repeat(rising, lengths)
            if cap:
                left = np.repeat(starts + lengths, lengths) - np.arange(len(part))
                if goes_on:
                    left[starts[-1]:] += int(self.run[end])
                self.run[begin:end] = np.minimum(left, cap)
            self.before[begin + 1:end + 1] = (part | np.where(
                self.smaller[begin:end], self.flag, 0).astype(part.dtype))[:size - 1 - begin]
        self.before[0] = 0
        for begin in range(0, size - 1, step):
            found += len(self._lms_in(begin, min(begin + step, size - 1)))
        self.lms = scratch.array(found, np.int64)
        found = 0
        for begin in range(0, size - 1, step):
            part = self._lms_in(begin, min(begin + step, size - 1))
            self.lms[found:found + len(part)] = part
            found += len(part)

    def _lms_in(self, begin: int, end: int) -> np.ndarray:
        """Places of leftmost S suffixes from begin + 1 to end."""
        return np.flatnonzero(self.smaller[begin + 1:end + 1] & ~self.smaller[begin:end]) + begin + 1


def _packed(symbols: np.ndarray) -> tuple[int, int]:
    """Bits of a symbol and symbols of a 64-bit number: letters of a text need nine bits."""
    bits = 9 if symbols.dtype == np.uint16 else 32
    return bits, 64 // bits


def _words(symbols: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The symbols from each place as one number that orders like them, padded beyond its end."""
    bits, per = _packed(symbols)
    pad = np.uint64((1 << bits) - 1)
    word = np.zeros(len(at), dtype=np.uint64)
    last = len(symbols) - 1
    for step in range(per):
        symbol = symbols[np.minimum(at + step, last)].astype(np.uint64)
        symbol[step >= left] = pad
        word <<= np.uint64(bits)
        word |= symbol
    return word


def _ranks(count: int, word) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each item by its words (equal items share one), and the order of ranks.

    word(items, step) gives the step-th words of items and which of them go on.
    """
    rank = np.zeros(count, dtype=np.int64)
    active = np.arange(count)
    step = 0
    while len(active):
        value, more = word(active, step)
        order = np.argsort(value)
        if step:
            order = order[np.argsort(rank[active[order]], kind="stable")]
        active, value, more = active[order], value[order], more[order]
        old = rank[active]
        new_group = np.r_[True, old[1:] != old[:-1]]
        new = new_group | np.r_[True, value[1:] != value[:-1]]
        begin = np.maximum.accumulate(np.where(new_group, np.arange(len(active)), 0))
        place = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        rank[active] = old + place - begin
        several = ~(new & np.r_[new[1:], True])
        active = active[several & more]
        step += 1
    return rank, np.argsort(rank)


def _named(symbols: np.ndarray, lms: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, int]:
    """Names, from 1, of the pieces from one leftmost S suffix to the next, and how many.

    Beyond the bound of memory, pieces are dealt by their first symbols into ranges that
    a sample of them cuts, and ranges are sorted one by one.
    """
    ends = np.r_[lms[1:], len(symbols) - 1] if len(lms) else lms
    per = _packed(symbols)[1]
    names = scratch.array(len(lms), np.uint32)

    def words(items: np.ndarray, step: int):
        left = ends[items] - lms[items] + 1 - step * per
        return _words(symbols, lms[items] + step * per, left), left >= per

    def ranged():
        if len(lms) <= scratch.in_memory:
            yield np.arange(len(lms))
            return
        parts = -(-2 * len(lms) // scratch.in_memory)
        sample = np.sort(words(np.linspace(0, len(lms) - 1, 64 * parts).astype(np.int64), 0)[0])
        cuts = np.unique(sample[::64][1:])
        dealt = scratch.array(len(lms), np.int32)
        for begin in range(0, len(lms), scratch.in_memory):
            items = np.arange(begin, min(begin + scratch.in_memory, len(lms)))
            dealt[items] = np.searchsorted(cuts, words(items, 0)[0], side="right")
        for part in range(len(cuts) + 1):
            yield np.flatnonzero(dealt == part)

    distinct = 0
    for items in ranged():
        if len(items):
            rank, order = _ranks(len(items), lambda own, step, items=items: words(items[own], step))
            ranked = rank[order]
            dense = np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]])
            names[items[order]] = dense + distinct
            distinct += int(dense[-1])
    return names, distinct


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string in memory, by doubling of ranks."""
    size = len(names)
    rank, order = _ranks(size, lambda items, step: (names[items], np.zeros(len(items), bool)))
    ranked = rank[order]
    same = np.r_[False, ranked[1:] == ranked[:-1]]
    unsure = order[same | np.r_[same[1:], False]]
    reach = 1
    while len(unsure):
        # A string in memory has fewer than 2^32 suffixes.
        pair = (rank[unsure] << 32) | rank[np.minimum(unsure + reach, size - 1)]
        order = np.argsort(pair)
        unsure, pair = unsure[order], pair[order]
        old, after = pair >> 32, pair & 0xFFFFFFFF
        new_group = np.r_[True, old[1:] != old[:-1]]
        new = new_group | np.r_[True, after[1:] != after[:-1]]
        begin = np.maximum.accumulate(np.where(new_group, np.arange(len(unsure)), 0))
        place = np.maximum.accumulate(np.where(new, np.arange(len(unsure)), 0))
        rank[unsure] = old + place - begin
        unsure = unsure[~(new & np.r_[new[1:], True])]
        reach *= 2
    return np.argsort(rank)


def _induced_names(symbols: np.ndarray, types: Types, seeds: np.ndarray, falling: bool,
                   scratch: Scratch) -> np.ndarray:
    """One scan over a string of many symbols: the suffixes of one type, in scan order.

    seeds are the suffixes of the other type in scan order, which for a falling scan are
    the L ones from the largest down. The queue holds a line for each range of symbols.
    Within a range, tuples are taken as long as none that they put in goes before them.
    """
    top = int(symbols.max())
    turned = (lambda s: top - s) if falling else (lambda s: s)
    shift = max(0, top.bit_length() - DIGITS.bit_length() + 1)
    kind = np.dtype([("symbol", np.int64), ("place", np.int64)])
    queue = TupleQueue(scratch, (top >> shift) + 1, kind)
    rising = int(np.count_nonzero(types.smaller))
    found = scratch.array(rising - 1 if falling else len(symbols) - rising, np.int64)
    done = 0
    seed_key = turned(symbols[seeds].astype(np.int64))
    cuts = np.searchsorted(seed_key >> shift, np.arange((top >> shift) + 2))
    mask = int(types.flag)

    def put_left(places: np.ndarray):
        """Symbols and places of the tuples that scanning these puts in, and by which."""
        left = types.before[places].astype(np.int64)
        fits = ((left & mask) != 0) == falling
        by = np.flatnonzero(fits & (places > 0))
        return turned(left[by] & (mask - 1)), places[by] - 1, by

    for digit in range((top >> shift) + 1):
        line = list(queue.take(digit))
        waiting = np.concatenate(line) if line else np.empty(0, dtype=kind)
        mine = slice(cuts[digit], cuts[digit + 1])
        # A symbol's queued suffixes go before its seeds.
        key = np.r_[2 * waiting["symbol"], 2 * seed_key[mine] + 1]
        place = np.r_[waiting["place"], seeds[mine]]
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        while len(key):
            symbol, pred, by = put_left(place[:BLOCK])
            here = symbol >> shift == digit
            least = np.full(min(BLOCK, len(key)) + 1, np.iinfo(np.int64).max)
            least[by[here] + 1] = 2 * symbol[here]
            ahead = np.flatnonzero(key[:BLOCK] > np.minimum.accumulate(least)[:-1])
            cut = int(ahead[0]) if len(ahead) else len(least) - 1
            out = place[:cut][key[:cut] % 2 == 0]
            found[done:done + len(out)] = out
            done += len(out)
            now = by < cut
            later = now & ~here
            far = np.empty(int(later.sum()), dtype=kind)
            order = np.argsort(symbol[later] >> shift, kind="stable")
            far["symbol"], far["place"] = symbol[later][order], pred[later][order]
            queue.put(far["symbol"] >> shift, far)
            near = now & here
            order = np.argsort(symbol[near], kind="stable")
            new_key, new_place = 2 * symbol[near][order], pred[near][order]
            key, place = key[cut:], place[cut:]
            if len(new_key):
                spots = np.searchsorted(key, new_key, side="right")
                key, place = np.insert(key, spots, new_key), np.insert(place, spots, new_place)
    return found


def suffix_order(symbols: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The suffixes of a string, whose last symbol is 0 and only there, in order."""
    if len(symbols) <= scratch.in_memory:
        return _doubled(symbols)
    types = Types(symbols, scratch, 0)
    lms = _sorted_lms(symbols, types, scratch)
    larger = _induced_names(symbols, types, lms, False, scratch)
    smaller = _induced_names(symbols, types, larger[::-1], True, scratch)
    smaller = smaller[::-1]
    order = scratch.array(len(symbols), np.int64)
    order[0] = len(symbols) - 1
    # Both are in order of symbols; within a symbol the L suffixes come first.
    ahead = np.searchsorted(symbols[smaller], symbols[larger], side="left")
    order[1 + np.arange(len(larger)) + ahead] = larger
    ahead = np.searchsorted(symbols[larger], symbols[smaller], side="right")
    order[1 + np.arange(len(smaller)) + ahead] = smaller
    return order


def _sorted_lms(symbols: np.ndarray, types: Types, scratch: Scratch) -> np.ndarray:
    """The leftmost S suffixes in order, by recursion on their names; the last symbol first."""
    lms = types.lms
    names, distinct = _named(symbols, lms[:-1], scratch)
    if distinct == len(names):
        order = np.empty(len(names), dtype=np.int64)
        order[names.astype(np.int64) - 1] = np.arange(len(names))
    else:
        reduced = scratch.array(len(lms), np.uint32)
        reduced[:-1] = names
        reduced[-1] = 0
        order = suffix_order(reduced, scratch)[1:]
    return np.r_[lms[-1:], lms[:-1][order]]


def _shared(text: np.ndarray, places: np.ndarray, cap: int) -> np.ndarray:
    """The common prefix, up to cap, of each place's suffix and that of the place before it.

    Eight bytes are compared at once, of pairs that have agreed so far.
    """
    size = len(text)
    shared = np.zeros(len(places), dtype=np.int64)
    active = np.arange(1, len(places))
    tail = np.r_[text[max(0, size - cap - 16):], np.zeros(cap + 16, dtype=np.uint8)]
    inner = max(0, size - 7)
    words = np.ndarray((inner,), "<u8", text, strides=(1,)) if inner else None
    ends = np.ndarray((len(tail) - 7,), "<u8", tail, strides=(1,))
    offset = max(0, size - cap - 16)

    def word(at: np.ndarray) -> np.ndarray:
        if len(at) and at.max() < inner:
            return words[at]
        within = at < inner
        found = np.empty(len(at), dtype=np.uint64)
        if inner:
            found[within] = words[at[within]]
        found[~within] = ends[at[~within] - offset]
        return found

    here, there = places[1:].copy(), places[:-1].copy()
    for _ in range(0, cap, 8):
        if not len(active):
            break
        differ = word(here) ^ word(there)
        same = differ == 0
        apart = ~same
        low = differ[apart] & (~differ[apart] + np.uint64(1))
        shared[active[apart]] += (np.frexp(low.astype(np.float64))[1] - 1) // 8
        active = active[same]
        shared[active] += 8
        here, there = here[same] + 8, there[same] + 8
    # What lies beyond the end of the text equals nothing.
    shared[1:] = np.minimum(shared[1:], size - np.maximum(places[1:], places[:-1]))
    return np.minimum(shared, cap).astype(np.uint16)


class _Carry:
    """The least common prefix over a scan since the last tuple put in for each symbol."""

    def __init__(self, symbols: int):
        self.least = np.zeros(symbols, dtype=np.uint16)

    def of(self, shared: np.ndarray, by: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """For tuples put in by rows `by` of a block, sorted by symbol, then row.

        shared has the block's common prefixes with each row's forerunner.
        """
        tables = [shared]
        while 2 << (len(tables) - 1) <= len(shared):
            half = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
        flat = np.concatenate(tables)
        base = np.cumsum([0, *map(len, tables)])[:-1]

        def least(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            level = np.frexp(end - begin)[1] - 1
            return np.minimum(flat[base[level] + begin], flat[base[level] + end - (1 << level)])

        whole = shared.min()
        first = np.r_[True, symbol[1:] != symbol[:-1]]
        begin = np.where(first, 0, np.r_[0, by[:-1] + 1])
        found = least(begin, by + 1)
        found[first] = np.minimum(found[first], self.least[symbol[first]])
        np.minimum(self.least, whole, out=self.least)
        final = np.r_[first[1:], True]
        last, places = symbol[final], by[final] + 1
        open_end = places == len(shared)
        self.least[last[open_end]] = np.iinfo(np.uint16).max
        inside = ~open_end
        self.least[last[inside]] = least(places[inside], np.full(inside.sum(), len(shared)))
        return found


def _scan(symbols: np.ndarray, types: Types, seeds: list, falling: bool, cap: int,
          scratch: Scratch, put) -> None:
    """One scan over a text: hands on (place, shared) of all suffixes in scan order.

    seeds[symbol] has places and common prefixes of the suffixes that are known. put gets
    the symbol, the tuples, and whether they came from the queue.
    """
    count = len(seeds)
    kind = np.dtype([("place", np.int64 if len(symbols) >= 1 << 31 else np.int32),
                     ("shared", np.uint16)])
    queue, carry = TupleQueue(scratch, count, kind), _Carry(count)
    mask = int(types.flag)

    def scan(places: np.ndarray, shared: np.ndarray) -> None:
        for begin in range(0, len(places), BLOCK):
            place, common = places[begin:begin + BLOCK], shared[begin:begin + BLOCK]
            left = types.before[place]
            by = np.flatnonzero((((left & mask) != 0) == falling) & (place > 0))
            symbol = left[by] & (mask - 1)
            order = np.argsort(symbol, kind="stable")
            by, symbol = by[order], symbol[order]
            if not len(by):
                np.minimum(carry.least, common.min(), out=carry.least)
                continue
            new = np.empty(len(by), dtype=kind)
            new["place"] = place[by] - 1
            new["shared"] = np.minimum(carry.of(common, by, symbol).astype(np.int64) + 1, cap)
            queue.put(symbol, new)

    for symbol in (range(count - 1, -1, -1) if falling else range(count)):
        last = None
        while queue.waits(symbol):
            for block in queue.take(symbol):
                place, shared = block["place"], block["shared"].copy()
                if last is None:  # its forerunner has another symbol
                    shared[0] = 0
                put(symbol, place, shared, True)
                last = int(place[-1])
                scan(place, shared)
        place, shared = seeds[symbol]
        if len(place):
            shared = np.array(shared)
            shared[0] = 0 if last is None else min(int(types.run[last]), int(types.run[place[0]]))
            put(symbol, place, shared, False)
            scan(place, shared)


def shared_prefixes(text: np.ndarray, cap: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of a text of bytes from the largest down, and what each shares with the last.

    shared[i] is the length, up to cap, of the common prefix of suffix i and suffix i - 1
    of the result; the first shares nothing. A shorter suffix goes before a longer one that
    it begins.
    """
    size = len(text)
    symbols = scratch.array(size + 1, np.uint16)
    symbols[:-1] = text
    symbols[:-1] += 1
    symbols[-1] = 0
    count = 257
    types = Types(symbols, scratch, cap)
    lms = _sorted_lms(symbols, types, scratch)
    shared = _shared(text, lms, cap)
    nothing = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint16))
    cuts = np.searchsorted(symbols[lms], np.arange(count + 1))
    seeds = [(lms[a:b], shared[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    larger: list[list] = [[] for _ in range(count)]
    _scan(symbols, types, seeds, False, cap, scratch,
          lambda symbol, place, common, queued:
          larger[symbol].append((place, common)) if queued else None)
    seeds = []
    for parts in larger:
        if parts:
            place = np.concatenate([p for p, _ in parts])[::-1]
            common = np.concatenate([c for _, c in parts])
            seeds.append((place, np.r_[np.uint16(0), common[1:][::-1]].astype(np.uint16)))
        else:
            seeds.append(nothing)
    places, commons = scratch.array(size, np.int64), scratch.array(size, np.uint16)
    done = 0

    def put(symbol: int, place: np.ndarray, common: np.ndarray, queued: bool) -> None:
        nonlocal done
        if symbol:
            places[done:done + len(place)] = place
            commons[done:done + len(place)] = common
            done += len(place)

    _scan(symbols, types, seeds, True, cap, scratch, put)
    return places, commons
