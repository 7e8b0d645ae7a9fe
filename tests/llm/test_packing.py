import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ringlens.llm import packing
from ringlens.llm.catalog import CATALOG
from ringlens.llm.subwords import token_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(token_bytes(PATH)(text), "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    ["", " ", "a  b", "a\n b", " x", "x ", "a <|endoftext|> b", "it's 'll we're", "a  b", "x\x1c y", "é  z\r\n\r\nq", "\ttab", "漢字 😀 ok", "12,345.6 -7"],
)
def test_ids_are_the_library_s(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids


def test_ids_of_random_texts(library):
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab's 12.,\n\t  éß漢'") for _ in range(rng.randint(0, 40)))
        assert ids(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_are_full_but_the_first():
    assert [(p["start"], p["length"]) for p in packing.pieces_of(bytes(4 * 10), 4)] == [(0, 2), (2, 4), (6, 4)]
    assert [(p["start"], p["length"]) for p in packing.pieces_of(bytes(4 * 8), 4)] == [(0, 4), (4, 4)]
    assert [(p["start"], p["length"]) for p in packing.pieces_of(bytes(4 * 3), 4)] == [(0, 3)]


def bins_of(histogram, capacity=packing.CAPACITY, **options):
    """Follows a plan for every rank; checks places and gives the fill of each bin."""
    intervals = packing.plan(histogram, capacity, **options)
    begins = [i.rank for i in intervals]
    lengths = [n for n in sorted(histogram, reverse=True) for _ in range(histogram[n])]
    bins = defaultdict(list)
    for rank, length in enumerate(lengths):
        i = intervals[int(np.searchsorted(begins, rank, side="right")) - 1]
        past = rank - i.rank
        assert i.length == length
        bins[i.bin + past // i.each].append((i.offset + past % i.each * length, length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return [sum(length for _, length in places) for places in bins.values()]


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_gapless_and_fit(seed):
    rng = random.Random(seed)
    high = rng.choice([5, 60, 100, 600, 1024])
    low = rng.choice([1, 1, min(high, 300)])
    histogram = Counter(rng.randint(low, high) for _ in range(rng.choice([1, 7, 500, 20_000])))
    bins_of(dict(histogram), groups=rng.choice([4, 64, 512]))


def test_plans_are_close_to_the_bound():
    rng = random.Random(11)
    histogram = Counter(rng.randint(1, 1024) for _ in range(30_000))
    fills = bins_of(dict(histogram))
    assert len(fills) <= 1.01 * sum(n * c for n, c in histogram.items()) / 1024


def test_plan_work_follows_lengths_not_rows():
    counts = {n: 10_000_000 + n for n in range(1, 1025)}
    intervals = packing.plan(counts)
    assert len(intervals) < 20_000


def test_query_places_every_token(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    expected = {}
    for i, text in texts.items():
        for p in packing.pieces_of(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()):
            expected[i, p["piece"]] = (p["start"], p["length"], p["ids_crc32"])
    rows = CATALOG["op5_best_fit_packing"].run(spark, sf).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    check_sequences(rows, 1024)
    total = sum(length for _, length, _ in expected.values())
    assert len({r.sequence_id for r in rows}) <= 1.05 * total / 1024 + 1


def check_sequences(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_odd_rows(spark):
    schema = "doc_id long, text string, piece string, offset int, id string"
    rows = [(1, None, "x", 1, "y"), (1, "", "x", 1, "y"), (None, "two words", None, None, None)] + [(2, "same text", None, None, None)] * 3
    got = packing.pack_documents(spark.createDataFrame(rows, schema), PATH, capacity=16).collect()
    assert len(got) == 6
    check_sequences(got, 16)
    end = zlib.crc32(np.array([2], "<u4").tobytes())
    assert [(r.length, r.ids_crc32) for r in got if r.doc_id == 1] == [(1, end)] * 2
    long = packing.pack_documents(spark.createDataFrame([(1, "word " * 5000)], "doc_id long, text string"), PATH).collect()
    assert sum(r.length for r in long) == 5002 and {r.length for r in long if r.piece} == {1024}
    assert packing.pack_documents(spark.createDataFrame([], schema), PATH).collect() == []
