"""Values of more than 512 characters are judged by all of them."""

import random

import pytest

from lodestone.llm import secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_long_values_are_judged_whole(spark):
    rng = random.Random(7)
    key = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))
    late, early = "z" * 512 + key(20_000), key(512) + "yz" * 10_000
    letters, long = "abcdefghijklmnopqrstuvwxyz" * 20 + key(600), key(200_000)
    texts = [f"token={late}", f"token={early}", f"see {letters} there", f"see {long} there", f"see {early} there"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans.split(",") for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0] == [f"assign:0:{6 + len(late)}", f"owned:6:{6 + len(late)}"] and got[1] == [f"assign:0:{6 + len(early)}"]
    assert got[2] == [f"owned:4:{4 + len(letters)}"] and got[3] == [f"owned:4:{4 + len(long)}"] and got[4] == [""]


@pytest.mark.parametrize("n, k", [(20, 10), (512, 16), (700, 62), (5000, 64)])
def test_random_entropy_equals_the_whole_sum(n, k):
    from math import comb, log2

    whole = sum(comb(n, c) * (k - 1) ** (n - c) * 10**30 // k**n / 10**30 * c / n * log2(n / c) for c in range(1, n + 1))
    assert secrets.random_entropy(n, k) == pytest.approx(k * whole, abs=1e-9)
