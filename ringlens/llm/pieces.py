"""Encoding into sentence pieces and back, as a stream of bounded memory.

A Viterbi pass keeps, for each boundary between characters, the piece that ends
there on the best path. The vocabulary is a merge (BPE) model, whose best path
is not the one of the largest sum of scores but the one that merging in the
order of the scores arrives at. It has an equally local rule: a sequence of
pieces is that path if, and only if, merging any two neighbours' characters
gives the same two pieces. So a piece may follow another if the two stand the
test, exactly one piece per boundary does, and ids equal those of the
vocabulary's own library.

Only boundaries within the longest piece of the newest can be reached by later
pieces. When the paths back from all of them run through one boundary, the ids
up to it are final and leave memory.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Words and pairs of pieces remembered per worker; further words are encoded anew each time, pairs start over.
REMEMBERED_WORDS = 800_000
REMEMBERED_PAIRS = 400_000
#: Longer words are streamed, not remembered.
LONG_WORD = 64
ONE = (1,)
PUNCTUATION = re.compile(r"([.,;:!?\n]+)")


class PieceModel:
    """A merge vocabulary with byte fallback; text is prefixed with a space and spaces are ``SPACE``."""

    def __init__(self, pieces: dict[str, int], scores: dict[str, float], byte_ids: list[int]) -> None:
        self.ids = pieces
        self.names = {number: piece for piece, number in pieces.items()}
        self.scores = scores
        self.byte_ids = byte_ids
        self.bytes_of = {number: piece.replace(SPACE, " ").encode() for piece, number in pieces.items()}
        self.bytes_of |= {number: bytes([byte]) for byte, number in enumerate(byte_ids)}
        self.longest = max(map(len, pieces), default=1)
        ends: dict[str, set[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-2:], {1}).add(len(piece))
        #: Lengths, longest first, of the pieces that end with two characters.
        self.lengths_by_end = {end: tuple(sorted(lengths, reverse=True)) for end, lengths in ends.items()}
        #: Two characters that no piece holds side by side always have a boundary between them.
        self.side_by_side = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}
        #: No piece holds a space after another character, so every path has a boundary before a word.
        self.words_apart = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, array] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging, best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether merging leaves these neighbours as they are; ``before`` is -1 at the start or after an unknown."""
        key = (before + 1) << 32 | piece
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            left = [self.names[before]] if before >= 0 else []
            right = self.names[piece]
            known = self.pairs[key] = self.merged("".join(left) + right) == [*left, right]
        return known

    def stream(self, text: str) -> Iterator[int]:
        """Ids of a text whose spaces are marked."""
        # Per boundary of the window: the piece that ends there (-1: none or an unknown character) and its length.
        last, lengths = [-1], [0]
        base = 0
        for stop in range(1, len(text) + 1):
            if not self.step(text, base, stop, last, lengths):
                raise ValueError("no piece may end here")
            if len(last) > 8 * self.longest:
                common = self.converged(lengths)
                if common:
                    yield from self.emit(text, base, common, last, lengths)
                    base += common
                    last, lengths = last[common:], [0, *lengths[common + 1 :]]
        yield from self.emit(text, base, len(last) - 1, last, lengths)

    def step(self, text: str, base: int, stop: int, last: list[int], lengths: list[int]) -> bool:
        room, ids, pairs = stop - base, self.ids, self.pairs
        end = text[stop - 2 : stop] if room > 1 else text[stop - 1 : stop]
        for length in self.lengths_by_end.get(end, ONE):
            if length <= room:
                piece = ids.get(text[stop - length : stop])
                if piece is not None:
                    before = last[-length]
                    known = pairs.get((before + 1) << 32 | piece)
                    if known is None:
                        known = self.may_follow(before, piece)
                    if known:
                        last.append(piece)
                        lengths.append(length)
                        return True
        if text[stop - 1] in ids:
            return False
        last.append(-1)
        lengths.append(1)
        return True

    def converged(self, lengths: list[int]) -> int:
        """The last boundary that the paths from all boundaries still in reach have in common."""
        end = len(lengths) - 1
        reach = max(0, end - self.longest + 1)
        fronts = set(range(reach, end + 1))
        while len(fronts) > 1:
            furthest = max(fronts)
            fronts.discard(furthest)
            fronts.add(furthest - lengths[furthest])
        return fronts.pop()

    def emit(self, text: str, base: int, stop: int, last: list[int], lengths: list[int]) -> list[int]:
        out: list[int] = []
        while stop > 0:
            if last[stop] >= 0:
                out.append(last[stop])
            else:
                char = text[base + stop - 1]
                out.extend(self.byte_ids[byte] for byte in reversed(char.encode("utf-8", "replace")))
            stop -= lengths[stop]
        return out[::-1]

    def word(self, word: str) -> bytes:
        """Ids of a word; the words inside it are remembered, not their combinations with punctuation."""
        found = self.words.get(word)
        if found is not None:
            return found
        parts = PUNCTUATION.split(word)
        if len(parts) == 1:
            return self.part(word)
        out, start = [], 0
        for stop in accumulate(map(len, parts)):
            if start < stop < len(word) and word[stop - 1 : stop + 1] in self.side_by_side:
                continue
            if start < stop:
                out.append(self.part(word[start:stop]))
                start = stop
        return b"".join(out)

    def part(self, part: str) -> bytes:
        found = self.words.get(part)
        if found is None:
            found = array("i", self.short(part) if len(part) <= LONG_WORD else self.stream(part)).tobytes()
            if len(part) <= LONG_WORD and len(self.words) < REMEMBERED_WORDS:
                self.words[part] = found
        return found

    def short(self, text: str) -> list[int]:
        """The same as ``stream`` for a text that is its own window."""
        last, lengths = [-1], [0]
        for stop in range(1, len(text) + 1):
            if not self.step(text, 0, stop, last, lengths):
                raise ValueError("no piece may end here")
        return self.emit(text, 0, len(text), last, lengths)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; an empty text has none."""
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def encoded(self, text: str) -> bytes:
        """The same as numbers of 32 bits side by side."""
        if not text:
            return b""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.words_apart:
            return array("i", self.stream(marked)).tobytes()
        words = self.words
        out: list[bytes] = []
        spaces = ""
        # A word takes all spaces in front of it, as pieces may hold several.
        for part in marked.split(SPACE)[1:]:
            spaces += SPACE
            if part:
                word = spaces + part
                out.append(words.get(word) or self.word(word))
                spaces = ""
        if spaces:
            out.append(self.word(spaces))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.bytes_of.get, ids, [b""] * len(ids))).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """A model file read by the vocabulary's library, which here only lists pieces and scores."""
    from sentencepiece import SentencePieceProcessor

    file = SentencePieceProcessor(model_file=path)
    numbers = range(file.get_piece_size())
    plain = [i for i in numbers if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))]
    names = {i: file.id_to_piece(i) for i in plain}
    byte_ids = [file.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
    return PieceModel({name: i for i, name in names.items()}, {name: file.get_score(i) for i, name in names.items()}, byte_ids)


def encode_texts(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``ids``, their ``ids_crc32``, and ``round_trip``.

    A null or empty text has no ids. Text is taken as it is, so white space of
    every kind survives; characters outside the vocabulary become byte pieces.
    ``ids_crc32`` is over the ids as little-endian 32-bit numbers;
    ``round_trip`` says whether decoding gives the text back, its space marks
    read as spaces. Repeated rows and null ids give rows like others; other
    columns are not read.
    """

    @F.arrow_udf("struct<ids: array<int>, ids_crc32: bigint, round_trip: boolean>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = piece_model(model_path)
        for texts in batches:
            found, stops, sums, same = [], [0], [], []
            for one in texts:  # one text at a time, as ids take ten times the room in Python
                text = one.as_py() or ""
                ids = model.encoded(text)
                found.append(ids)
                stops.append(stops[-1] + len(ids) // 4)
                sums.append(zlib.crc32(ids))
                same.append(model.decode(np.frombuffer(ids, np.int32).tolist()) == text.replace(SPACE, " "))
            values = pa.array(np.frombuffer(b"".join(found), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), values)
            yield pa.StructArray.from_arrays(
                [lists, pa.array(sums, pa.int64()), pa.array(same, pa.bool_())], ["ids", "ids_crc32", "round_trip"]
            )

    plain = docs.select(F.col(f"`{id_column}`").alias("id"), encoded(F.col(f"`{text_column}`")).alias("found"))
    return plain.select(F.col("id").alias(id_column), "found.*")


def decode_ids(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids.

    A null list decodes to null; control pieces and ids outside the vocabulary
    decode to nothing.
    """

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = piece_model(model_path)
        for lists in batches:
            texts = [model.decode(one.values.to_pylist()) if one.is_valid else None for one in lists]
            yield pa.array(texts, pa.string())

    return encoded.withColumn("decoded", decoded(F.col(f"`{ids_column}`")))
