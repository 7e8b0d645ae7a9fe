import random
import string

import numpy as np
import pytest

from ringlens.llm import secret_scan as scan

WORDS = ["database", "primary", "connection", "accounts", "customers", "internal", "service", "handler", "api", "request"]


@pytest.fixture(scope="module")
def ratios():
    rng = random.Random(6)
    secrets = "\n".join("".join(rng.choices(string.ascii_letters + string.digits, k=32)) for _ in range(2000))
    joints = ["_", "/", "-", " ", "="]
    plain = " ".join(rng.choice(WORDS).upper() if rng.random() < 0.3 else rng.choice(WORDS) + rng.choice(joints) + rng.choice(WORDS) for _ in range(20000))
    return scan.trained(scan.pair_counts(secrets.encode())) - scan.trained(scan.pair_counts(plain.encode()))


@pytest.mark.parametrize("before", ["", "DATABASE_PRIMARY_CONNECTION=", "/api/accounts/customers/internal/", "service_handler-"])
@pytest.mark.parametrize("after", ["", "/customers/internal/accounts"])
def test_recall_of_glued_secrets(ratios, before, after):
    rng = random.Random(7)
    found = whole = 0
    for _ in range(200):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=32))
        spans = scan.random_tokens(f"see {before}{secret}{after} there", ratios, scan.LEAST_RATIO)
        start = 4 + len(before)
        found += any(a <= start and b >= start + 32 for a, b in spans)
        whole += spans == [(start, start + 32)]
    assert found >= 195 and whole >= 165


def test_keys_and_paths_alone_are_not_reported(ratios):
    for text in ("DATABASE_PRIMARY_CONNECTION=internal", "/api/accounts/customers/internal/service", "request_handler-service_api"):
        assert scan.random_tokens(text, ratios, scan.LEAST_RATIO) == []


def test_rest_beside_a_base_span_is_kept(ratios):
    other = "q7Rk2vXw9LmZ4tBn8HsJ5cDy3FgP6aQe"
    text = f"token=abc123.{other} and {'0af3' * 7}/{other}"
    base, spans = scan.all_spans(text, ratios, scan.LEAST_RATIO)
    assert [kind for *_, kind in base] == ["assign", "hex"]
    last = text.rindex(other)
    assert (last, last + 32, "random") in spans


def test_several_parts_and_long_tokens():
    ratios = np.full((scan.SIZE, scan.SIZE), -1.0)
    ratios[:, scan.SYMBOLS[list(b"abcdefghij")]] = 3.0
    text = "abcdefghij" + "=" * 60 + "abcdefghij" + "Z" * 10
    assert scan.random_tokens(text, ratios, 25.0) == [(0, 10), (70, 90)]
    assert scan.random_tokens("abcdefghij" * 100_000, ratios, 25.0) == [(0, 1_000_000)]
