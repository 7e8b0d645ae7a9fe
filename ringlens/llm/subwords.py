"""Byte-level BPE ids of texts."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import tiktoken

#: Fixed value: the pre-tokenization pattern of the byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where no two white-space characters meet; without the look-ahead it runs several times faster.
EVEN_PATTERN = PATTERN.replace(r"|\s+(?!\S)|\s+", r"|\s")
RARE_SPACES = "".join(map(chr, [9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_pairs(path: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """A byte-level BPE file in the JSON form of ``tokenizers``, for any text and for evenly spaced ones.

    Ids and merges are those of the file, given as ranks of byte strings to
    the faster of the two libraries; tests compare both.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    letters = byte_letters()
    special = {token["content"] for token in described.get("added_tokens", [])}
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in described["model"]["vocab"].items()
        if token not in special
    }
    full, even = (
        tiktoken.Encoding("byte_pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for pattern in (PATTERN, EVEN_PATTERN)
    )
    return full, even


def is_even(text: str) -> bool:
    """No two white-space characters meet (rare kinds of them are not looked at closely)."""
    return not any(pair in text for pair in ("  ", "\n\n", " \n", "\n ")) and not any(c in text for c in RARE_SPACES)


#: The white space of the pattern, which is not quite Python's.
WHITE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: Runs of this length are cut out before the pattern, whose look-ahead overflows on about a million characters.
LONG_RUN = re.compile(WHITE + "{4096,}")


def added_tokens(path: str) -> dict[str, int]:
    """Contents and ids of the tokens that are cut out of a text before all else."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    for token in added:
        if token.get("single_word") or token.get("lstrip") or token.get("rstrip"):
            raise ValueError(f"added token {token['content']!r} takes its surroundings into account")
    return {token["content"]: token["id"] for token in added}


def ordinary_ids(text: str, full: tiktoken.Encoding, even: tiktoken.Encoding) -> list[int]:
    """Ids of a text without added tokens.

    A run of white space is one piece, but for its last character if more text
    follows; long runs are encoded so by hand.
    """
    if is_even(text):
        return even.encode_ordinary(text)
    ids: list[int] = []
    done = 0
    for run in LONG_RUN.finditer(text):
        stop = run.end() - (run.end() < len(text))
        ids += full.encode_ordinary(text[done : run.start()])
        ids += full._encode_single_piece(text[run.start() : stop])
        done = stop
    return ids + full.encode_ordinary(text[done:])


@lru_cache(maxsize=2)
def token_bytes(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids, as unsigned little-endian 32-bit numbers.

    An added token's string in a text is that token, as with ``tokenizers``.
    """
    full, even = byte_pairs(path)
    added = added_tokens(path)
    # Of tokens that begin at one place the longest counts.
    cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def encode(text: str) -> bytes:
        ids = array("I")
        done = 0
        for found in cut.finditer(text) if cut else ():
            ids.extend(ordinary_ids(text[done : found.start()], full, even))
            ids.append(added[found.group()])
            done = found.end()
        ids.extend(ordinary_ids(text[done:] if done else text, full, even))
        return ids.tobytes()

    return encode
