"""Token ids by words and pieces against whole-text encoding; what a worker pays for them."""

import random

import numpy as np
import pytest

from lodestone.llm.tokens import TokenCache, default_path

ODD = ["don't", "I'LL", "we've'll", "''s", "_a_b", "x2\u00b2\u00b3\u00bd", "\u00c9", "\u00c0\u00c9\u00ce\u00f5\u00fc", "Stra\u00dfe", "\u0130stanbul", "\u0178\u1e9e\u023a\u2c65", "\u01c4", "a\u0301", "A\u0301", "H\u0331", "I\u0307", "\u0301", "\u0229\u0301"]
ODD += ["\u041f\u0440\u0438\u0432\u0435\u0442", "\u041c\u0418\u0420,", "\u65e5\u672c\u8a9e", "\ud55c\uad6d\uc5b4", "\u1112\u1161\u11ab", "\U0001f642\U0001f44d\U0001f3fd", "\u2003x", "a\u00a0b", "a\u200bb", "a\u0085b", "x\x1cy", "nul\x00", "\x00", "a\x00b", "\x7f"]
ODD += ["<|startoftext|>", "<|STARTOFTEXT|>", "x<|endoftext|>y", "<|", "|>", "sixteen_letters_", "seventeen_letters", "q" * 16, "q" * 17, "q" * 3000, "1234567890", "....", "..!?", "\u00aa\u00ba", "\u00b5", "\ufb01n", "\u212a", "\u2126", "\u00d7\u00f7"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEF\u00e9\u00fc\u00df\u00f1\u00c9"
    made = ["".join(rng.choices(letters, k=rng.randint(1, 20))) + rng.choice(["", "", ".", ",", "'s", "!?"]) for _ in range(3000)]
    lines = [rng.choice([" ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]).join(rng.choices(made + (ODD if i % 3 else []), k=rng.randint(0, 60))) for i in range(1200)]
    return [None, "", " ", "\n\t", *ODD, *[f" {w} " for w in ODD], *lines]


@pytest.mark.parametrize("bounds", [{}, {"most": 200}, {"most_bytes": 500}, {"plain": None}])
def test_ids_equal_whole_text_encoding(texts, bounds):
    cache = TokenCache(default_path(), **{k: v for k, v in bounds.items() if k != "plain"})
    assert cache.plain
    cache.plain = bounds.get("plain", cache.plain)
    want = [cache.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    raw = [t.encode() if t is not None else None for t in texts]
    for step in (len(raw), 7):
        for at in range(0, len(raw), step):
            flat, n = cache.encode(raw[at : at + step])
            assert n.tolist() == [len(w) for w in want[at : at + step]] and flat.tolist() == [i for w in want[at : at + step] for i in w]
            assert cache.counts(raw[at : at + step]).tolist() == n.tolist()


class Recorded:
    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode(self, text, **options):
        self.seen += text.split()
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.seen += [w for t in texts for w in t.split()]
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_a_piece_is_encoded_once_whatever_texts_hold_it():
    cache, seen = TokenCache(default_path()), []
    for name in {"tokenizer", "plain"} & set(vars(cache)):
        setattr(cache, name, Recorded(getattr(cache, name), seen))
    cache.encode([b"plain Words, here", "plain words \u00e9 here.".encode(), b"PLAIN words here"])
    assert sorted(seen) == sorted(["plain", "words", ",", "here", "\u00e9", "."])


def test_colliding_slots_keep_words_apart():
    from lodestone.llm.tokens import _Words, words_in

    table, rng = _Words(), random.Random(2)
    words = ["".join(rng.choices("ab\x00", k=rng.randint(1, 18))).encode() for _ in range(200_000)]
    table._slot = lambda low, high: (low % np.uint64(97)).astype(np.int64)  # long probes
    for at in range(0, 6000, 500):
        some = words[at : at + 500]
        blob = b" ".join(some) + b" " * 17
        starts, ends = words_in(blob)
        numbers, _ = table.numbers(blob, starts, ends - starts)
        seen = dict(zip(some, numbers.tolist()))
        assert len(set(seen.values())) == len(seen) and all(seen[w] == n for w, n in zip(some, numbers.tolist()))
    assert table.n == len(set(words[:6000]))
