"""Words and word shingles of one text, shared by the operators that hash shingles."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 22
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def word_blocks(text: bytes, overlap: int, block: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, block by block.

    A block starts with the last ``overlap`` words of the one before, so that a
    text of any length needs the memory of one block.
    """
    start, carried = 0, []
    while start < len(text):
        stop = start + block
        if stop < len(text):
            cut = SPACE.search(text, stop)
            stop = cut.start() if cut else len(text)
        words = carried + text[start:stop].lower().split()
        yield words
        carried = words[-overlap:] if overlap else []
        start = stop


def shingle_hashes(text: bytes, width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, repeats included, as unsigned arrays.

    A text of fewer words is one shingle, its whole sequence; none: no array.
    """
    first = True
    for words in word_blocks(text, width - 1):
        if len(words) >= width:
            runs = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
            first = False
            yield np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.uint64)
        last = words
    if first and text and last:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(last), seed)], np.uint64)
