"""Words of texts as numbers: hashes made for many words at once, and a cache by blank-separated token."""

from __future__ import annotations

import re
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = re.compile(r"[^\W\d_]+")
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"  # no part of any word
STEMS = (4, 5, 6)
WIDTH = 1 + len(STEMS)
UNKNOWN = -(1 << 62)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def term_hashes(words: list[str]) -> np.ndarray:
    """One row for each (non-empty) word: 64-bit hashes of the word and of its first letters as stems; 0 where the
    word is no longer than the stem. Inflected forms share stems. A hash is the mixed sum of the mixed (letter, place)
    pairs, so that the sums over a word's first letters give its stems."""
    if not words:
        return np.zeros((0, WIDTH), np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size) - size
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.arange(len(letters)) - np.repeat(begin, size)
    out = np.zeros((len(words), WIDTH), np.uint64)
    with np.errstate(over="ignore"):
        total = np.cumsum(mix(letters * _ODD + at.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(1)), dtype=np.uint64)
        before = np.where(begin > 0, total[begin - 1], np.uint64(0))
        out[:, 0] = mix(total[begin + size - 1] - before)
        for k, n in enumerate(STEMS, 1):
            long = size > n
            out[long, k] = mix(total[begin[long] + n - 1] - before[long] + np.uint64(n) * _ODD)
    return out


class WordTable:
    """Rows of numbers for the words of whole texts, looked up by token.

    `resolve` gives the row of each word from its hashes (see term_hashes). A token is what stands between blanks;
    it is cut into words (runs of letters, in lower case). Tokens that a call meets twice are remembered, up to
    `most`; those met once, which are seldom seen again, are cut anew. Texts are resolved many at a time, so that
    new words cost little.
    """

    def __init__(self, resolve, most: int = 150_000):
        self.resolve, self.most = resolve, most
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}  # token: row of its only word, -1 without words, -2 - k for entry k of `several`
        self.several: list[np.ndarray] = []
        self.rows = None
        self.used = self.kept = 0  # rows of remembered tokens; their entries of `several`

    def _learn(self, new: list[str], at: int) -> tuple[np.ndarray, int]:
        """The slot of each token and the end of the rows of their words, which are put at row `at`."""
        low = [t.lower().strip(EDGE) for t in new]
        plain = np.fromiter(map(str.isalpha, low), bool, len(low))
        words, slot = list(compress(low, plain)), np.cumsum(plain) - 1 + at
        for i in np.flatnonzero(~plain).tolist():
            found = WORD.findall(low[i])
            if len(found) > 1:
                slot[i] = -2 - len(self.several)
                self.several.append(np.arange(len(words), len(words) + len(found)) + at)
            else:
                slot[i] = len(words) + at if found else -1
            words += found
        rows = self.resolve(term_hashes(words))
        end = at + len(rows)
        if self.rows is None:
            self.rows = np.empty((max(1024, end), rows.shape[1]), rows.dtype)
        if len(self.rows) < end:
            self.rows = np.concatenate([self.rows[:at], np.empty((2 * end - at, rows.shape[1]), rows.dtype)])
        self.rows[at:end] = rows
        return slot, end

    def slots(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """For each text the rows (numbers into `rows`, until the next call) of its words, in their order."""
        if not len(texts):
            return []
        lists = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()))
        tokens = lists.flatten().dictionary_encode()  # every token once, and its places
        names, place = tokens.dictionary.to_pylist(), tokens.indices.to_numpy()
        if len(self.slot) > self.most:
            self._clear()
        del self.several[self.kept :]
        number = np.fromiter(map(self.slot.get, names, repeat(UNKNOWN)), np.int64, len(names))
        new = number == UNKNOWN
        often = new & (np.bincount(place, minlength=len(names)) > 1)
        held = list(compress(names, often))
        number[often], self.used = self._learn(held, self.used)
        self.slot.update(zip(held, number[often].tolist()))
        self.kept = len(self.several)
        number[new & ~often], _ = self._learn(list(compress(names, new & ~often)), self.used)
        every = number[place]
        out = []
        for s in np.split(every, lists.offsets.to_numpy()[1:-1]):
            odd = np.flatnonzero(s < 0)
            if len(odd):
                more = s[odd] < -1
                if more.any():  # in place of each such token its words
                    parts = np.split(s, odd)
                    joined = [parts[0]]
                    for k, part in zip(s[odd].tolist(), parts[1:]):
                        joined += [self.several[-2 - k], part[1:]] if k < -1 else [part[1:]]
                    s = np.concatenate(joined)
                else:
                    s = s[s >= 0]
            out.append(s)
        return out
