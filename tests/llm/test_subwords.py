import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ringlens.llm import subwords

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    """The library as it comes, with its default settings."""
    return Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(subwords.token_bytes(PATH)(text), "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "x  <|endoftext|>\n\n<|endoftext|", "<<|endoftext|>>  a"],
)
def test_added_tokens_are_one_id(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids
    assert ids(text).count(50256) == text.count("<|endoftext|>")


@pytest.mark.parametrize(
    "text", [" " * 2_000_000, "a" + " " * 2_000_000 + "b", "a\n" + "\n " * 3000 + ".", "x" + "\t" * 5000 + "<|endoftext|>" + " " * 4096 + "1"]
)
def test_long_runs_of_white_space(library, text):
    assert ids(text) == library.encode(text, add_special_tokens=False).ids


def test_runs_by_hand_are_those_of_the_pattern(library, monkeypatch):
    monkeypatch.setattr(subwords, "LONG_RUN", subwords.re.compile(subwords.WHITE + "{2,}"))
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice("ab's 1.,\n\t  \x1c\x85\u3000é漢") for _ in range(rng.randint(0, 40)))
        assert ids(text) == library.encode(text, add_special_tokens=False).ids, repr(text)
