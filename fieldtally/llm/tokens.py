"""Ids of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: The one part of the vocabulary's pattern that looks ahead. It only matters where white
#: space follows white space; without it the pattern is matched half as fast again.
LOOKAHEAD = r"\s+(?!\S)|"
SIDE_BY_SIDE = re.compile(r"\s\s")


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def marked_ids_of(path: str) -> Callable[[str], bytes]:
    """The same with the file's added tokens, which stand for their own ids in a text.

    Of marks that begin at one place the longest counts; the text between is encoded apart.
    """
    with open(path, encoding="utf-8") as file:
        marks = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes()
                 for t in json.load(file)["added_tokens"]}
    encode = ids_of(path)
    if not marks:
        return encode
    mark = re.compile("(" + "|".join(map(re.escape, sorted(marks, key=len, reverse=True))) + ")")

    def ids(text: str) -> bytes:
        parts = mark.split(text)
        if len(parts) == 1:
            return encode(text)
        return b"".join(marks[p] if n % 2 else encode(p) for n, p in enumerate(parts))

    return ids


@lru_cache(maxsize=2)
def ids_of(path: str) -> Callable[[str], bytes]:
    """A function from a whole text to its ids as little-endian unsigned 32-bit numbers.

    Added tokens, such as the mark of a text's end, are plain text here.

    The same vocabulary lies beside the .json file as ranks, and the library that reads
    those is several times as fast; without that file the .json one is used.
    """
    try:
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    except FileNotFoundError:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(
            tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encoding(pattern: str) -> Callable[[str], list[int]]:
        return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary

    whole = encoding(public_tokenizers.PATTERN)
    plain = encoding(public_tokenizers.PATTERN.replace(LOOKAHEAD, ""))
    return lambda text: np.array((whole if SIDE_BY_SIDE.search(text) else plain)(text),
                                 dtype="<u4").tobytes()
