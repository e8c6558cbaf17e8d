"""Tokens for content scoring: disguised spellings are folded once for each distinct token."""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np

from streamloom.llm.leaked_tests import _DRAWN, _MOJIBAKE, _unbroken

# -- fixed values: letters that look like Latin ones, and signs that stand for letters ---
LOOKALIKES = {
    "а": "a", "е": "e", "і": "i", "о": "o", "с": "c", "р": "p", "х": "x", "у": "y", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d",
    "ո": "n", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "τ": "t",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t"}
# -----------------------------------------------------------------------------------------

_LOOK = str.maketrans(LOOKALIKES)
_SIGN = str.maketrans(SIGNS)
_EDGE = re.compile(r"^[^\w*@$]+|[^\w*@$]+$")
_SPLIT_UP = re.compile(r"(?:[a-z0-9@$!*][-_.~]){2,}[a-z0-9@$!*]")
_NUMERIC = re.compile(r"[\d\W_]+")
_LONG = re.compile(r"([a-z])\1{2,}")

#: Buckets of the word and the letter-trigram tables.
WORD_BUCKETS, GRAM_BUCKETS = 4096, 2048
#: Letters from which on a token may be several words run together, and the share that known words must make up.
RUN, KNOWN = 16, 0.7


def fold(token: str) -> str | None:
    """A token's plain spelling; null for hesitations, numbers, time marks and bare signs."""
    t = token
    if not t.isascii():
        t = _MOJIBAKE.sub(_unbroken, t) if ("Ã" in t or "â" in t or "Â" in t) else t
        t = t.lower().translate(_LOOK)
        t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        t = t.replace("ß", "ss")
    t = _EDGE.sub("", t.lower()).replace("'", "").replace("’", "")
    if not t or _DRAWN.fullmatch(t):
        return None
    if _NUMERIC.fullmatch(t) and not ("@" in t or "$" in t or "*" in t):
        return None
    if _SPLIT_UP.fullmatch(t):
        t = re.sub(r"[-_.~]", "", t)
    if any(c in SIGNS for c in t) and not t.isdigit():
        t = t.translate(_SIGN)
    t = _LONG.sub(r"\1", t)
    return t or None


def crc(s: str, buckets: int) -> int:
    return zlib.crc32(s.encode()) % buckets


def letters(word: str) -> list[int]:
    """Buckets of all letter trigrams of a word."""
    w = f"<{word}>"
    return [crc(w[k : k + 3], GRAM_BUCKETS) for k in range(len(w) - 2)] or [crc(w, GRAM_BUCKETS)]


@lru_cache(maxsize=1)
def _known() -> tuple[frozenset[str], int]:
    """The folded words of the lessons, and the length of the longest."""
    from streamloom.llm.content_lessons import vocabulary_of_lessons

    words = frozenset(w for t in vocabulary_of_lessons() if (w := fold(t)) and len(w) > 1 and w.isalpha())
    return words, max(map(len, words))


def run_together(word: str) -> list[str]:
    """The words of a token of RUN letters and more written without spaces; the token itself if known words make up less than KNOWN of it.

    The split leaves fewest letters outside known words, then has fewest words.
    """
    if len(word) < RUN or not word.isalpha():
        return [word]
    known, longest = _known()
    best: list[tuple[int, int, int, bool]] = [(0, 0, 0, False)]  # letters left over, words, where the last part begins, whether it is known
    for k in range(1, len(word) + 1):
        left, n, at, was = best[k - 1]
        options = [(left + 1, n + was, k - 1 if was or k == 1 else at, False)]
        options += [(best[j][0], best[j][1] + 1, j, True) for j in range(max(0, k - longest), k - 1) if word[j:k] in known]
        best.append(min(options))
    if best[-1][0] > (1 - KNOWN) * len(word):
        return [word]
    out, k = [], len(word)
    while k:
        out.append(word[best[k][2] : k])
        k = best[k][2]
    return out[::-1]


class Vocabulary:
    """Numbers for folded tokens, kept over batches.

    One-letter tokens have codes of their own, as they may spell a word; so have tokens of several words run together.
    """

    DROPPED, UNKNOWN = -1, -2
    #: The code of the k-th token of several words is SPLIT - k.
    SPLIT = -(10**9)
    #: The code of the k-th letter is LETTER - 2 k, less 1 if a stop follows it.
    LETTER = -10

    def __init__(self, most: int = 100_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.raw: dict[str, int] = {}
        self.words: list[str] = []
        self.letters: list[str] = []
        self.letter_word = np.zeros(0, np.int64)
        self.parts: list[list[int]] = []

    def of(self, word: str) -> int:
        n = self.number.get(word)
        if n is None:
            n = self.number[word] = len(self.words)
            self.words.append(word)
        return n

    def _raw(self, token: str) -> int:
        bare = _EDGE.sub("", token)
        if len(bare) == 1 and (bare.isalnum() or bare in "@$"):
            if bare not in self.letters:
                self.letters.append(bare)
                own = self.of(fold(bare) or bare.lower()) if bare.isalpha() else self.DROPPED
                self.letter_word = np.r_[self.letter_word, own]
            n = self.LETTER - 2 * self.letters.index(bare) - (token[-1:] in ".,;:!?")
        else:
            word = fold(token)
            parts = [] if word is None else run_together(word)
            if len(parts) > 1:
                n = self.SPLIT - len(self.parts)
                self.parts.append([self.of(w) for w in parts])
            else:
                n = self.of(parts[0]) if parts else self.DROPPED
        self.raw[token] = n
        return n

    def encode(self, text: str | None) -> np.ndarray:
        """Word numbers of a text; three or more letters in a row are put together to one word."""
        if not text:
            return np.zeros(0, np.int64)
        tokens = text.split()
        ids = np.fromiter(map(self.raw.get, tokens, repeat(self.UNKNOWN)), np.int64, len(tokens))
        for k in np.flatnonzero(ids == self.UNKNOWN).tolist():
            ids[k] = self._raw(tokens[k])
        split = ids <= self.SPLIT
        if split.any():
            ids = np.concatenate([self.parts[self.SPLIT - n] if n <= self.SPLIT else [n] for n in ids.tolist()])
        letter = ids <= self.LETTER
        if letter.any():
            if (letter[:-2] & letter[1:-1] & letter[2:]).any():
                ids = self._put_together(ids)
            else:
                ids[letter] = self.letter_word[(self.LETTER - ids[letter]) // 2]
        return ids[ids >= 0]

    def _put_together(self, ids: np.ndarray) -> np.ndarray:
        out: list[int] = []
        run: list[int] = []

        def close() -> None:
            which = [(self.LETTER - c) // 2 for c in run]
            word = fold("".join(self.letters[k] for k in which)) if len(run) >= 3 else None
            out.extend([self.of(word)] if word else [int(self.letter_word[k]) for k in which])
            run.clear()

        for n in ids.tolist():
            if n <= self.LETTER:
                run.append(n)
                if (self.LETTER - n) % 2:
                    close()
            else:
                close()
                out.append(n)
        close()
        return np.array(out, np.int64)
