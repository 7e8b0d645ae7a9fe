"""Secrets: base patterns, and random strings told from identifiers by Markov models.

Two models give the probability of each character after the one before: one of
random strings, learned from what the base patterns mark as secret, and one of
ordinary identifiers and words, learned from all other tokens. A long token
that may turn out to be a secret counts once in all documents, so that copies
of it do not vouch for each other. Both learn from every document: tasks count
pairs of characters and name the tokens in question, Spark adds the counts and
makes the tokens distinct, and only the two tables of fixed size reach the
driver. Of a token those parts are reported whose log-likelihood ratio exceeds
the odds against a secret, so that a key or a path glued to a secret does not
outweigh it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.session import stored

KINDS = ("assign", "access", "hex")
ADDED_KIND = "random"
#: Fixed value: the pattern of assignments.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINT = re.compile(r"[:=]")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Long tokens of fewer different characters are rules and fillers.
LEAST_DISTINCT = 8
LEAST_VALUE = 6
#: Natural logarithm of the odds against a long token being a secret, times the cost of a false report.
LEAST_RATIO = 25.0
PRIOR = 0.5
BACKING = 20.0

SYMBOLS = np.zeros(256, np.int64)
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS[list(ALPHABET)] = np.arange(1, len(ALPHABET) + 1)
SIZE = len(ALPHABET) + 1
BLOCK = 1 << 20


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns by start, then kind as listed; failing matches are passed over."""
    found = []
    if ASSIGN_HINT.search(text):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    found += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(start, stop, KINDS[kind]) for start, stop, kind in sorted(found, key=lambda f: (f[0], f[2]))]


def secret_values(text: str, spans: list[tuple[int, int, str]]) -> list[str]:
    """What is secret in the base spans: the value of an assignment, other spans whole."""
    return [ASSIGN.match(text, start).group(2) if kind == "assign" else text[start:stop] for start, stop, kind in spans]


def candidates(text: str) -> Iterator[re.Match]:
    """Tokens that are long and varied enough to be asked about."""
    return (m for m in CANDIDATE.finditer(text) if len(set(m.group())) >= LEAST_DISTINCT)


def ordinary_text(text: str, spans: list[tuple[int, int, str]], asked: set[str]) -> str:
    """The text without its base spans and without its tokens in question, which are added to ``asked``."""
    kept, done = [], 0
    cuts = [(start, stop) for start, stop, _ in spans]
    taken = Covered(cuts)
    for match in candidates(text):
        cuts.append(match.span())
        if [*taken.gaps(*match.span())] == [match.span()]:
            asked.add(match.group())
    for start, stop in sorted(cuts):
        kept.append(text[done:max(start, done)])
        done = max(done, stop)
    return " ".join([*kept, text[done:]])


def pair_counts(data: bytes) -> np.ndarray:
    """How often each symbol follows each within one token, and begins one (after symbol 0)."""
    counts = np.zeros(SIZE * SIZE, np.int64)
    last = 0
    for start in range(0, len(data), BLOCK):
        symbols = SYMBOLS[np.frombuffer(data, np.uint8, min(BLOCK, len(data) - start), start)]
        before = np.concatenate([[last], symbols[:-1]])
        counts += np.bincount(before * SIZE + symbols, minlength=SIZE * SIZE)
        last = int(symbols[-1])
    return counts


def trained(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of a symbol after another.

    Counts of pairs are blended with ``BACKING`` occurrences dealt out by the
    symbols' own frequencies, so that a rare symbol stays unlikely after a
    symbol that was hardly ever seen.
    """
    table = counts.reshape(SIZE, SIZE)[:, 1:].astype(float)
    alone = table.sum(axis=0) + PRIOR
    blended = table + BACKING * alone / alone.sum()
    logs = np.zeros((SIZE, SIZE))
    logs[:, 1:] = np.log(blended / blended.sum(axis=1, keepdims=True))
    return logs


def learn(docs: DataFrame, text_column: str) -> np.ndarray:
    """Log-likelihood ratio, random string against identifier, of each symbol after each.

    The counts, and so the ratios, are the same however the rows are
    partitioned.
    """
    counts = "pair bigint, random bigint, plain bigint"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, plain = np.zeros(SIZE * SIZE, np.int64), np.zeros(SIZE * SIZE, np.int64)
        for batch in batches:
            asked: set[str] = set()
            for text in batch.column(0).to_pylist():
                if text:
                    spans = base_spans(text)
                    plain += pair_counts(ordinary_text(text, spans, asked).encode("utf-8", "replace"))
                    values = secret_values(text, spans)
                    if values:
                        random += pair_counts("\n".join(values).encode())
            yield count_rows(None, None, asked)
        yield count_rows(random, plain, ())

    def tokens_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = np.zeros(SIZE * SIZE, np.int64)
        for batch in batches:
            plain += pair_counts("\n".join(batch.column(0).to_pylist()).encode())
        yield count_rows(np.zeros_like(plain), plain, ()).drop_columns("token")

    found = stored(
        docs.select(F.col(f"`{text_column}`").alias("text")).mapInArrow(counted, f"{counts}, token string"), "secret-counts"
    )
    once = found.where("token IS NOT NULL").select("token").distinct().mapInArrow(tokens_counted, counts)
    sums = (
        found.where("token IS NULL")
        .drop("token")
        .unionByName(once)
        .groupBy("pair")
        .agg(F.sum("random").alias("random"), F.sum("plain").alias("plain"))
    )
    random, plain = np.zeros(SIZE * SIZE), np.zeros(SIZE * SIZE)
    for row in sums.collect():
        random[row.pair], plain[row.pair] = row.random, row.plain
    return trained(random) - trained(plain)


def count_rows(random: np.ndarray | None, plain: np.ndarray | None, tokens: Collection[str]) -> pa.RecordBatch:
    """Rows of counts by pair, or else of tokens alone."""
    if random is None:
        empty = pa.nulls(len(tokens), pa.int64())
        columns = [empty, empty, empty, pa.array(list(tokens), pa.string())]
    else:
        pair = np.flatnonzero(random + plain)
        columns = [pa.array(pair), pa.array(random[pair]), pa.array(plain[pair]), pa.nulls(len(pair), pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["pair", "random", "plain", "token"])


def scoring_parts(first: list[float], later: list[float], least: float) -> Iterator[tuple[int, int]]:
    """Parts of a token with the highest sums, from ``least`` on; ``first`` scores a character as the part's first.

    A part ends at its peak, once the sum has fallen below the start or by
    ``least``; the search goes on behind the peak.
    """
    i, n = 0, len(first)
    while i < n:
        begin, total, peak, top = i, 0.0, 0.0, i
        while i < n:
            grown = total + later[i]
            if i == begin or (grown <= first[i] and peak < least):
                begin, total, peak, top = i, first[i], first[i], i + 1
            else:
                total = grown
                if total > peak:
                    peak, top = total, i + 1
            i += 1
            if peak >= least and total <= max(peak - least, 0.0):
                break
        if peak >= least:
            yield begin, top
        i = max(top, begin + 1) if peak >= least else n


def random_tokens(
    text: str, ratios: np.ndarray, least_ratio: float, covered: tuple[tuple[int, int], ...] = ()
) -> list[tuple[int, int]]:
    """Spans of the parts of tokens whose characters are likelier in a random string than in an identifier.

    A part is widened to the letters and digits around it and to the padding at
    the token's end. What is ``covered`` already is left out of the tokens.
    """
    flat = ratios.ravel()
    taken = Covered(covered)
    found = []
    for match in candidates(text):
        for low, high in taken.gaps(*match.span()):
            unpadded = low + len(text[low:high].rstrip("="))
            symbols = SYMBOLS[np.frombuffer(text[low:high].encode(), np.uint8)]
            first, later = flat[symbols], flat[np.concatenate([[0], symbols[:-1]]) * SIZE + symbols]
            if np.maximum(np.maximum(first, later), 0).sum() < least_ratio:
                continue
            done = low
            for begin, stop in scoring_parts(first.tolist(), later.tolist(), least_ratio):
                begin, stop = begin + low, stop + low
                while begin > done and text[begin - 1].isalnum():
                    begin -= 1
                while stop < high and text[stop].isalnum():
                    stop += 1
                if stop >= unpadded:
                    stop = high
                begin = max(begin, done)
                if begin < stop and len(set(text[begin:stop])) >= LEAST_DISTINCT:
                    found.append((begin, stop))
                    done = stop
    return found


class Covered:
    """Spans, given by their start and perhaps overlapping, and what lies between them."""

    def __init__(self, spans: Collection[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.stops: list[int] = []
        for start, stop in spans:
            if self.stops and start <= self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], stop)
            else:
                self.starts.append(start)
                self.stops.append(stop)

    def gaps(self, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """The parts of a span outside the covered ones."""
        at = bisect_right(self.stops, start)
        while start < stop:
            low = self.starts[at] if at < len(self.starts) else stop
            if low > start:
                yield start, min(low, stop)
            if low >= stop:
                return
            start = self.stops[at]
            at += 1


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, stop, kind in spans)


def all_spans(text: str, ratios: np.ndarray, least_ratio: float) -> tuple[list, list]:
    """Base spans, and base and added spans together; of a token the part outside the base spans is added."""
    base = base_spans(text)
    covered = tuple((start, stop) for start, stop, _ in base)
    added = [(start, stop, ADDED_KIND) for start, stop in random_tokens(text, ratios, least_ratio, covered)]
    rank = {kind: i for i, kind in enumerate((*KINDS, ADDED_KIND))}
    return base, sorted(base + added, key=lambda f: (f[0], rank[f[2]]))


def find_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_ratio: float = LEAST_RATIO
) -> DataFrame:
    """One row per document: numbers of base spans by kind, their digest, and all spans.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start
    and then kind as listed. A null text counts as empty and has none. Without
    any base span to learn from, random strings are those of equally likely
    characters. The time grows in proportion to a text's length, however many
    spans it has. Repeated rows and null ids give rows like others; other
    columns are not read.
    """
    ratios = learn(docs, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf("struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                base, spans = all_spans(text or "", shared.value, least_ratio)
                kinds = [kind for _, _, kind in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(kind) for kind in KINDS), digest, joined(spans)))
            columns = [*zip(*rows, strict=True)] or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return plain.select(F.col("id").alias(id_column), scanned("text").alias("found")).select(id_column, "found.*")
