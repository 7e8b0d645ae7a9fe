import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from ringlens.llm import pieces
from ringlens.llm.catalog import CATALOG

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(PATH)


def test_ids_are_the_library_s(model, library):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice("ab c▁\n\t漢é😀 \x00 theing") for _ in range(rng.randint(0, 60)))
        assert model.encode(text) == library.encode(text), repr(text)
        assert model.decode(model.encode(text)) == text.replace(pieces.SPACE, " ")


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000, "aehtrnis" * 500, "漢" * 900])
def test_long_runs_are_streamed(model, library, text):
    assert model.encode(text) == library.encode(text)


def test_window_stays_small(model):
    text = "▁" + "".join(random.Random(2).choice("aehtrnis") for _ in range(5000))
    widest = 0
    step = model.step

    def watched(*args):
        nonlocal widest
        widest = max(widest, len(args[3]))
        return step(*args)

    model.step = watched
    try:
        streamed = list(model.stream(text))
    finally:
        del model.step
    assert widest <= 16 * model.longest
    assert streamed == model.encode(text[1:]) == model.short(text)


def test_memory_of_words_is_bounded(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 10)
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 20)
    fresh = pieces.piece_model.__wrapped__(PATH)
    text = " ".join(f"word{i} other{i % 7}" for i in range(300))
    assert fresh.encode(text) == library.encode(text)
    assert len(fresh.words) <= 10 and len(fresh.pairs) <= 20


def test_query_round_trips(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = CATALOG["op2_sentence_pieces"].run(spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == library.encode(texts[row.doc_id]) and row.round_trip and row.n_ids == len(row.ids)


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string, back int, decoded int"
    rows = [(1, None, "x", 1, 1), (1, None, "x", 1, 1), (None, "", None, None, None), (None, "é a\n b ", None, None, None)]
    df = spark.createDataFrame(rows, schema)
    back = pieces.decode_ids(pieces.encode_texts(df, PATH), PATH).collect()
    assert all(r.round_trip for r in back)
    assert sorted(r.decoded for r in back) == ["", "", "", "é a\n b "]
    assert pieces.encode_texts(df.limit(0), PATH).collect() == []
    wild = spark.createDataFrame([([2, 999_999, 3, 198, 28705],), (None,)], "ids array<int>")
    assert [r.decoded for r in pieces.decode_ids(wild, PATH).collect()][1] is None
