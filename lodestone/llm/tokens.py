"""Token ids by a public tokenizer, memoised per word and pre-token.

Texts are cut into words at ASCII white space, across which the tokenizer never joins characters. A word not seen before is lowered
and cut into pre-tokens here, by the tokenizer's own pattern, if it has Latin letters only; any other (or one that may hold a special
token's string) goes to the tokenizer whole. Each distinct piece is encoded once; the ids of a word are those of its pieces in order, and the ids of
a text those of its words (tests compare with whole-text encoding). Lowered Latin pieces are what the tokenizer's normaliser and pattern would
leave as they are, so they go to its model without these. A worker keeps its memory between tasks, up to bounds; beyond them it starts anew.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .common import BLANK

#: The pre-tokeniser's pattern (fixed value), for Latin letters, and the end of a word.
LATIN = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
BEYOND = re.compile("[^\x00-\x1b\x20-\x7f\xa1-\u024f]+|[\xb2\xb3\xb9\xbc-\xbe\u0130]")
#: What the tokenizer does before its model (fixed values); lowered words of Latin letters pass it unchanged but for the byte alphabet.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [SPLIT, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
COMBINING = re.compile(b"[\xca-\xff]")  # without these bytes no character combines with a letter before it
BLOCK = 1 << 18
_caches: dict[str, TokenCache] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def worker_cache(path: str) -> TokenCache:
    if path not in _caches:
        _caches[path] = TokenCache(path)
    return _caches[path]


def words_only(tokenizer):
    """The tokenizer for lowered words of Latin letters between spaces: its model behind a cut at spaces. None if other things come before its model."""
    from tokenizers import Tokenizer, pre_tokenizers

    state = lambda part: json.loads(part.__getstate__()) if part else None
    if state(tokenizer.normalizer) != NORMALIZER or state(tokenizer.pre_tokenizer) != PRE_TOKENIZER or tokenizer.post_processor:
        return None
    found = Tokenizer(tokenizer.model)
    found.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return found


class _Words:
    """Numbers words as they come, many at a time. A word of up to 16 bytes is its own key, as two 64-bit numbers in an open-addressing table; the others are keys of a dict."""

    def __init__(self):
        self.n, self.weight, self.long = 0, 0, {}  # weight: bytes of the dict's keys
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        low, high = np.zeros(size // 2, np.uint64), np.zeros(size // 2, np.uint64)
        if self.n:
            low[: self.n], high[: self.n] = self.low[: self.n], self.high[: self.n]
        self.low, self.high, self.slots, self.bits = low, high, np.full(size, -1, np.int32), size.bit_length() - 1
        self._place(np.nonzero((low[: self.n] != 0) | (high[: self.n] != 0))[0])  # the dict's words have zeros here, and no key is all zeros

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ (high * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, numbers: np.ndarray) -> None:
        slot = self._slot(self.low[numbers], self.high[numbers])
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            left = self.slots[slot] != numbers
            numbers, slot = numbers[left], (slot[left] + 1) & (len(self.slots) - 1)

    def _find(self, low: np.ndarray, high: np.ndarray, which: np.ndarray) -> np.ndarray:
        out, slot = np.full(len(low), -1, np.int32), self._slot(low[which], high[which])
        while len(which):
            n = self.slots[slot]
            same = (n >= 0) & (self.low[n] == low[which]) & (self.high[n] == high[which])
            out[which[same]] = n[same]
            on = (n >= 0) & ~same
            which, slot = which[on], (slot[on] + 1) & (len(self.slots) - 1)
        return out

    def numbers(self, blob: bytes, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word, and the words that are new, in order of their numbers. blob has 16 bytes or more after the last word's start."""
        raw, eight = np.frombuffer(blob, np.uint8), np.ndarray((len(blob) - 7,), np.dtype("<u8"), blob, 0, (1,))
        keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        out, new = np.empty(len(starts), np.int32), []
        for at in range(0, len(starts), BLOCK):
            s, n = starts[at : at + BLOCK], lens[at : at + BLOCK]
            fits = (n <= 16) & (raw[s + n - 1] != 0)  # a final zero byte would not show in the key
            low, high, more = eight[s] & keep[np.minimum(n, 8)], np.zeros(len(s), np.uint64), np.nonzero(fits & (n > 8))[0]
            high[more] = eight[s[more] + 8] & keep[n[more] - 8]
            found = self._find(low, high, np.nonzero(fits)[0])
            absent = np.nonzero(fits & (found < 0))[0]
            if len(absent):
                absent = absent[np.lexsort((high[absent], low[absent]))]
                a, b = low[absent], high[absent]
                first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                found[absent] = self.n + np.cumsum(first) - 1
                own = absent[first]
                self._room(len(own))
                numbers = np.arange(self.n, self.n + len(own))
                self.low[numbers], self.high[numbers] = low[own], high[own]
                self.n += len(own)
                self._place(numbers)
                new += [blob[i : i + k] for i, k in zip(s[own].tolist(), n[own].tolist())]
            for i in np.nonzero(~fits)[0].tolist():
                word = blob[s[i] : s[i] + n[i]]
                number = self.long.get(word)
                if number is None:
                    self._room(1)
                    number = self.long[word] = self.n
                    self.n, self.weight = self.n + 1, self.weight + len(word)
                    new.append(word)
                found[i] = number
            out[at : at + BLOCK] = found
        return out, new

    def _room(self, more: int) -> None:
        if 2 * (self.n + more) > len(self.slots):
            self._grow(1 << (2 * (self.n + more) - 1).bit_length())


class _Sequences:
    """Id sequences by number."""

    def __init__(self, kind):
        self.starts, self.lens, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, kind)

    def add(self, flat: np.ndarray, lens: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens.astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def of(self, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all numbers in order, and how many belong to each run of counts numbers."""
        lens = self.lens[numbers]
        total = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
        place = np.repeat(self.starts[numbers] - total[:-1], lens)
        place += np.arange(total[-1])
        ends = np.cumsum(counts)
        return self.flat[place], total[ends] - total[ends - counts]


def words_in(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a blob that ends with white space."""
    blank = BLANK[np.frombuffer(blob, np.uint8)]
    turns = np.nonzero(blank[1:] != blank[:-1])[0] + 1
    turns = turns if blank[0] else np.concatenate([[0], turns])
    return turns[::2], turns[1::2]


class TokenCache:
    def __init__(self, path: str, most: int = 2_000_000, most_bytes: int = 32 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.most_bytes = Tokenizer.from_file(path), most, most_bytes
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 65536 else np.uint32
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.plain = words_only(self.tokenizer) if self.ends.any() else None
        self._forget()

    def _forget(self) -> None:
        self.words, self.word_ids = _Words(), _Sequences(self.kind)
        self.pieces, self.piece_ids = _Words(), _Sequences(self.kind)

    def _encoded(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        every = [e.ids for e in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]
        return np.array([i for e in every for i in e], np.int64), np.array([len(e) for e in every], np.int64)

    def _learn_pieces(self, names: list[str]) -> None:
        """Pieces of letters go joined by spaces: each ends with exactly one end-of-word token. Others go one by one."""
        plain = np.fromiter(map(str.isalpha, names), bool, len(names)) & (self.plain is not None)
        own, order = _Sequences(self.kind), np.zeros(len(names), np.int64)
        where, rest = np.nonzero(plain)[0], np.nonzero(~plain)[0].tolist()
        for at in range(0, len(where), 5000):
            some = where[at : at + 5000]
            ids = np.array(self.plain.encode_batch_fast([" ".join([names[i] for i in some])], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.nonzero(self.ends[ids])[0] + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                order[some] = len(own.lens) + np.arange(len(some))
                own.add(ids, np.diff(cuts, prepend=0))
            else:
                rest += some.tolist()
        for at in range(0, len(rest), 5000):
            some = rest[at : at + 5000]
            order[some] = len(own.lens) + np.arange(len(some))
            own.add(*self._encoded([names[i] for i in some]))
        self.piece_ids.add(*own.of(order, np.ones(len(order), np.int64)))

    def _learn_words(self, words: list[bytes]) -> None:
        names = b"\n".join(words).decode("utf-8", "replace").split("\n")
        joined, ends = "\n".join(names), np.cumsum(np.fromiter(map(len, names), np.int64, len(names)) + 1)
        odd = [m.start() for m in BEYOND.finditer(joined)] + [m.start() for m in re.finditer(r"<\|", joined)]
        whole = np.unique(np.searchsorted(ends, odd, "right"))
        given = [names[i] for i in whole]
        for i in whole.tolist():
            names[i] = ""
        blob = " ".join(LATIN.findall("\n".join([*names, "\n"]).lower())).encode() + b" " * 17
        starts, stops = words_in(blob)
        numbers, new = self.pieces.numbers(blob, starts, stops - starts)
        if new:
            self._learn_pieces(b"\n".join(new).decode().split("\n"))
        breaks = np.nonzero(np.frombuffer(blob, np.uint8) == 10)[0][: len(names)]
        own, order = _Sequences(self.kind), np.arange(len(names))
        own.add(*self.piece_ids.of(numbers, np.diff(np.searchsorted(starts, breaks), prepend=0)))
        if given:
            order[whole] = len(names) + np.arange(len(given))
            own.add(*self._encoded(given))
        self.word_ids.add(*own.of(order, np.ones(len(order), np.int64)))

    def lookup(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, and the number of words of each; null is empty. Case goes early only where nothing depends on it."""
        if self.words.n > self.most or self.words.weight > self.most_bytes:
            self._forget()
        lowered = [b"" if not t else t if b"<|" in t or COMBINING.search(t) else t.lower() for t in texts]
        sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
        blob = b" ".join(lowered) + b" " * 17
        starts, ends = words_in(blob)
        numbers, new = self.words.numbers(blob, starts, ends - starts)
        if new:
            self._learn_words(new)
        return numbers, np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)

    def counts(self, texts: list[bytes | None]) -> np.ndarray:
        numbers, n = self.lookup(texts)
        total = np.concatenate([[0], np.cumsum(self.word_ids.lens[numbers], dtype=np.int64)])
        ends = np.cumsum(n)
        return total[ends] - total[ends - n]

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids, and the number of ids of each text."""
        numbers, n = self.lookup(texts)
        return self.word_ids.of(numbers, n)
