"""Token ids of whole texts, by a public tokenizer file, with a bounded cache of words.

``Encoder.encode`` gives exactly what ``Tokenizer.encode(text, add_special_tokens=False)`` gives. It relies on two
properties of the word-end vocabulary, both checked when it is loaded: no pre-token spans white space, and a
pre-token's last id, and no other, ends a word. So the pieces of blank-delimited words are looked up, by hash and all at
once, and the unknown ones that are runs of letters go through the tokenizer as one text. All others go through it singly.
"""

from __future__ import annotations

import functools
import re

import numpy as np

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Words kept before the cache starts anew, and bytes of text in one go; they bound memory, not results.
CACHE_WORDS, AT_ONCE = 1_000_000, 1 << 20
#: Letters that neither compose nor split: ASCII and Latin-1.
_LETTERS = re.compile(rb"(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_KIND = np.full(256, 4, np.uint8)
_KIND[:0x80] = 0
_KIND[[39, 60, 124]] = 4
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[0xC3] = 2
_KIND[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = 3


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Words:
    """The words met so far by 64-bit hash, each with its ids in one common array; all plain arrays, so a million take 30 MB."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        """Sorted new keys and the ids of each."""
        length = np.array([len(x) // 4 for x in ids], np.int64)
        place = len(self.ids) + np.cumsum(length) - length
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place, self.length = (
            np.insert(x, at, y) for x, y in ((self.keys, keys), (self.place, place), (self.length, length))
        )
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])


class Encoder:
    """Texts to token ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str | None = None, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.by_word = bool(self.ends.any())
        self.cache_words = cache_words
        self.words = Words()
        # Sums of random numbers of bytes times powers of an odd number tell words apart.
        random = np.random.default_rng(9)
        self.of_byte = random.integers(1, 1 << 63, 256, np.uint64)
        self.odd = np.uint64(int(random.integers(1, 1 << 62)) * 2 + 1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _singly(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def _learned(self, unknown: list[bytes]) -> list[bytes]:
        """Ids of pieces that have not been met."""
        letters = [k for k, x in enumerate(unknown) if x.isalpha() or _LETTERS.fullmatch(x)]
        out = dict.fromkeys(letters, b"")
        text = b" ".join([unknown[k] for k in letters]).decode("utf-8")
        ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(letters):  # else a run of letters was not one pre-token
            raw, stops = ids.tobytes(), (stops * 4).tolist()
            out = dict(zip(letters, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))
        else:
            out = {}
        return [out[k] if k in out else self._singly(x) for k, x in enumerate(unknown)]

    @staticmethod
    def _pieces(text: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words cut where letters and other characters meet; words with anything that forbids it stay whole.

        That is an apostrophe, which contractions begin with, a sign of a special token, and any letter that is not
        ASCII or Latin-1, which may combine with its neighbours or be no letter.
        """
        kind = _KIND[text]  # 0 other ASCII, 1 letter, 2 lead byte of a Latin-1 letter, 3 its second byte, 4 none of these
        odd = kind == 4
        lead = kind == 2
        odd[:-1] |= lead[:-1] & (kind[1:] != 3)
        odd[-1:] |= lead[-1:]
        second = kind == 3
        odd[1:] |= second[1:] & ~lead[:-1]
        odd[:1] |= second[:1]
        sums = np.concatenate([[0], np.cumsum(odd)])
        whole = sums[stop] > sums[first]
        letter = (kind > 0) & (kind < 4)
        change = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        word = np.searchsorted(first, change, "right") - 1
        ok = word >= 0
        ok[ok] = (change[ok] > first[word[ok]]) & (change[ok] < stop[word[ok]]) & ~whole[word[ok]]
        change = change[ok]
        return np.sort(np.concatenate([first, change])), np.sort(np.concatenate([stop, change]))

    def _hashes(self, text: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        if len(text) > len(self.powers):
            steps = np.full(len(text), self.odd)
            steps[0] = 1
            self.powers = np.cumprod(steps)
            steps[1:] = np.uint64(pow(int(self.odd), -1, 1 << 64))
            self.inverses = np.cumprod(steps)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.of_byte[text] * self.powers[: len(text)], out=sums[1:])
        return (sums[stop] - sums[first]) * self.inverses[first]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text, in order, without special tokens."""
        if not self.by_word:
            return [self._singly(t) for t in texts]
        out, some, size = [], [], 0
        for t in texts:
            some.append(t)
            size += len(t)
            if size > AT_ONCE:
                out += self._encode(some)
                some, size = [], 0
        return out + self._encode(some)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        # Text with what may be a special token keeps its case: those are told by case.
        joined = b"\n".join([t if b"<|" in t else t.lower() for t in texts])
        text = np.frombuffer(joined, np.uint8)
        inside = np.zeros(len(text) + 2, bool)
        inside[1:-1] = (text != 32) & (text != 10)
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        first, stop = self._pieces(text, turns[::2], turns[1::2])
        if not len(first):
            return [b""] * len(texts)
        keys, sample, which = np.unique(self._hashes(text, first, stop), return_index=True, return_inverse=True)
        if len(self.words.keys) > self.cache_words:
            self.words = Words()
        new = self.words.missing(keys)
        if new.any():
            places = sample[new]
            unknown = [joined[a:b] for a, b in zip(first[places].tolist(), stop[places].tolist(), strict=True)]
            self.words.add(keys[new], self._learned(unknown))
        at = np.searchsorted(self.words.keys, keys)
        length, place = self.words.length[at][which], self.words.place[at][which]
        ends = np.cumsum(length)
        ids = self.words.ids[np.repeat(place - ends + length, length) + np.arange(ends[-1])]
        # Words before the end of each text, and so ids.
        bounds = np.cumsum([len(t) + 1 for t in texts])
        upto = np.concatenate([[0], ends])[np.searchsorted(first, bounds, "left")].tolist()
        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
        return [bytes(raw[4 * a : 4 * b]) for a, b in zip([0, *upto], upto, strict=False)]


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)
