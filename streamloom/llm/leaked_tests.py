"""Evaluation passages inside training texts: greedy string tiling over Karp-Rabin seeds.

The passages are the query set. A text's words are coded by the passages' own
vocabulary (any other word is 0); every window of `least` coded words gets a
Karp-Rabin hash, computed for a whole batch of texts at once, and is looked up in
the sorted hashes of the passages' windows and then compared word by word. For
each text and passage that share a seed, tiling marks the longest common run, then
the longest that doesn't overlap it, and so on: passages that are cut up and
reordered are covered too. Texts never move: no shuffle, no candidate pairs.

The query set is broadcast in blocks of at most BLOCK_CHARS characters, however
large it is; each block reads the texts once.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloom.operators.shared import require_columns

#: Shortest run that counts, in words; characters of passages broadcast at once; texts handled at once.
LEAST = 12
BLOCK_CHARS = 32_000_000
TEXTS_AT_ONCE = 500
#: Seeds expanded at once.
SEEDS_AT_ONCE = 2_000_000

# -- fixed values: sounds that stand in round brackets --------------------------------
SOUNDS = (
    "cough coughs coughing laughs laughter laugh laughing sighs sigh applause inaudible unclear crosstalk music noise silence "
    "breath breathes breathing sniffs yawn yawns clears throat phone buzzing ringing rings door closes slams opens chair scrapes "
    "lip smack background static whispers whispering clapping knocking pause"
).split()
# ---------------------------------------------------------------------------------------

_SOUND = "|".join(SOUNDS)
_CAPTION = re.compile(r"^[ \t]*(?:\d+[ \t]*\r?\n[ \t]*)?\d\d?:\d\d:\d\d[,.]?\d*[ \t]*-->[^\n]*$", re.M)
_LONE_NUMBER = re.compile(r"^[ \t]*\d+[ \t]*$", re.M)
_NOTE = re.compile(rf"\[[^\[\]\n]{{1,40}}\]|<[^<>\n]{{1,40}}>|\((?:{_SOUND})(?: (?:{_SOUND}))*\)|\(\d+:\d\d(?::\d\d)?\)|\*[a-z ]{{2,30}}\*", re.I)
#: A bracket too long to be surely a note: the text is read with it and without it.
_LONG_NOTE = re.compile(r"\[[^\[\]\n]{41,}\]|<[^<>\n]{41,}>|\*[a-z ]{31,}\*", re.I)
_LABEL = re.compile(r"(?:^|(?<=[\s\]>]))(?:>>\s*)?(?:speaker|spk)[ _]?\d+\s*:|^[ \t]*(?:>>\s*)?(?:speaker|spk)[ _]?\d+\b", re.I | re.M)
_CLOCK = re.compile(r"(?<![\w.])\d{1,2}:\d\d(?::\d\d)?(?:[.,]\d+)?(?!\w)")
_APOSTROPHE = re.compile(r"(?<=\w)['’ʼ‘´`](?=\w)")
_WORD = re.compile(r"[^\W_]+")
_MOJIBAKE = re.compile(r"[ÃÂâ][\u0080-\u00ff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{1,2}")


#: Hesitation sounds drawn out as long as one likes, with German and French ones.
_DRAWN = re.compile(r"u+h+m*|u+m+|h+m+|m+h+m+|mm+|e+r+m*|e+h+m*|a+h+|[äö]+h+m*|e+u+h+")


class _Codes(dict):
    """Codes of words; -1 for hesitations, which count nowhere, 0 for other unknown words."""

    def __missing__(self, word: str) -> int:
        return -1 if _DRAWN.fullmatch(word) else 0


def _unbroken(m: re.Match) -> str:
    try:
        return m.group().encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return m.group()


def readings(text: str | None) -> list[list[str]]:
    """The words of a text; of one with long brackets also without what stands in them."""
    out = [words_of(text)]
    if text and ("[" in text or "<" in text or "*" in text) and _LONG_NOTE.search(text):
        out.append(words_of(_LONG_NOTE.sub(" ", text)))
    return out


def words_of(text: str | None) -> list[str]:
    """The words that count: runs of letters and digits in lower case, without apostrophes, caption
    numbers, time marks, speaker labels, sound notes; hesitations are still in, and so is what stands in long brackets."""
    if not text:
        return []
    t = text
    if "Ã" in t or "â" in t or "Â" in t:
        t = _MOJIBAKE.sub(_unbroken, t)
    if "-->" in t:
        t = _LONE_NUMBER.sub(" ", _CAPTION.sub(" ", t))
    if "[" in t or "(" in t or "<" in t or "*" in t:
        t = _NOTE.sub(" ", t)
    t = t.lower()
    if "sp" in t and (":" in t or "spk" in t or "speaker" in t):
        t = _LABEL.sub(" ", t)
    if ":" in t:
        t = _CLOCK.sub(" ", t)
    if not t.isascii() or "'" in t or "`" in t:
        t = _APOSTROPHE.sub("", t.replace("\u00ad", "").replace("\u200b", ""))
    return _WORD.findall(t)


class Passages:
    """The query set, coded: vocabulary, words of each item, and the sorted hashes of their windows."""

    def __init__(self, items: list[tuple[object, str | None]], least: int = LEAST):
        self.least = least
        self.code = _Codes()
        self.ids: list[object] = []
        self.words: list[np.ndarray] = []
        for item, text in items:
            ws = [w for w in words_of(text) if not _DRAWN.fullmatch(w)]
            if len(ws) >= least:
                self.ids.append(item)
                self.words.append(np.array([self.code.setdefault(w, len(self.code) + 1) for w in ws], np.int64))
        rng = np.random.default_rng(29)
        self.base = int(rng.integers(1 << 61)) * 2 + 1
        flat = np.concatenate([np.r_[w, 0] for w in self.words]) if self.words else np.zeros(0, np.int64)
        item_of = np.repeat(np.arange(len(self.words)), [len(w) + 1 for w in self.words]) if self.words else flat
        start_of = np.cumsum([0] + [len(w) + 1 for w in self.words])
        at, hashed = windows(flat, least, self.base)
        order = np.argsort(hashed, kind="stable")
        self.hash, self.place, self.flat = hashed[order], at[order], flat
        self.item = item_of[self.place]
        self.at = self.place - start_of[self.item]


def windows(ids: np.ndarray, size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of `size` known words (> 0) begin, and their Karp-Rabin hashes modulo 2**64."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = np.r_[0, np.cumsum(ids > 0)]
    at = np.flatnonzero(known[size:] - known[:-size] == size)
    h = np.zeros(len(at), np.uint64)
    coded, b = ids.astype(np.uint64), np.uint64(base)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = h * b + coded[at + k]
    return at, h


def tiles(runs: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in text, place in passage) of non-overlapping runs, the longest first."""
    heap = [(-n, p, q) for n, p, q in runs]
    heapq.heapify(heap)
    marked_p: set[int] = set()
    marked_q: set[int] = set()
    out = []
    while heap:
        n, p, q = heapq.heappop(heap)
        n = -n
        free = [p + k not in marked_p and q + k not in marked_q for k in range(n)]
        if all(free):
            out.append((n, p, q))
            marked_p.update(range(p, p + n))
            marked_q.update(range(q, q + n))
            continue
        k = 0
        while k < n:
            if free[k]:
                a = k
                while k < n and free[k]:
                    k += 1
                if k - a >= least:
                    heapq.heappush(heap, (-(k - a), p + a, q + a))
            else:
                k += 1
    return out


def find_in(texts: list[str | None], passages: Passages, most: int = SEEDS_AT_ONCE) -> list[tuple[int, int, int, int, int]]:
    """(text, passage, tiles, longest tile, words of the passage covered) of all that share a run of `least` words."""
    code = passages.code
    parts, lengths, owner = [], [], []
    for n, t in enumerate(texts):
        for ws in readings(t):
            ids = np.fromiter((code[w] for w in ws), np.int64)
            ids = ids[ids >= 0]
            parts += [ids, np.zeros(1, np.int64)]
            lengths.append(len(ids) + 1)
            owner.append(n)
    if not parts:
        return []
    flat = np.concatenate(parts)
    at, hashed = windows(flat, passages.least, passages.base)
    lo, hi = np.searchsorted(passages.hash, hashed, "left"), np.searchsorted(passages.hash, hashed, "right")
    hit = np.flatnonzero(hi > lo)
    begin = np.cumsum([0] + lengths)
    # Words that many passages share give many seeds: they are expanded a slice at a time, cut between readings.
    reading = np.searchsorted(begin, at[hit], "right") - 1
    seeds = np.cumsum(hi[hit] - lo[hit])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    a = 0
    while a < len(hit):
        b = max(a + 1, int(np.searchsorted(seeds, (seeds[a - 1] if a else 0) + most, "right")))
        b = int(np.searchsorted(reading, reading[b - 1], "right"))
        for r, item, runs in _runs(flat, at[hit[a:b]], reading[a:b], begin, lo[hit[a:b]], hi[hit[a:b]], passages):
            found = tiles(runs, passages.least)
            got = (sum(t[0] for t in found), found[0][0], len(found))
            key = owner[r], item
            best[key] = max(best.get(key, got), got)
        a = b
    return [(n, item, count, longest, covered) for (n, item), (covered, longest, count) in best.items()]


def _runs(flat: np.ndarray, at: np.ndarray, reading: np.ndarray, begin: np.ndarray, lo: np.ndarray, hi: np.ndarray, passages: Passages) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(reading, passage, [(length, place in text, place in passage)]): seeds compared word by word and joined to runs."""
    least, n = passages.least, hi - lo
    seed = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    p, r, item, q = np.repeat(at, n), np.repeat(reading, n), passages.item[seed], passages.at[seed]
    same = np.ones(len(seed), bool)
    for k in range(least):
        same &= flat[p + k] == passages.flat[passages.place[seed] + k]
    p, r, item, q = (p - begin[r])[same], r[same], item[same], q[same]
    if not len(p):
        return
    order = np.lexsort((p, p - q, item, r))
    p, r, item, q = p[order], r[order], item[order], q[order]
    pair = np.r_[True, (r[1:] != r[:-1]) | (item[1:] != item[:-1])]
    head = pair | np.r_[True, (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)]
    start = np.flatnonzero(head)
    size = np.diff(np.r_[start, len(p)]) + least - 1
    cuts = np.searchsorted(start, np.r_[np.flatnonzero(pair), len(p)]).tolist()
    rows = list(zip(size.tolist(), p[start].tolist(), q[start].tolist()))
    for a, b in zip(cuts, cuts[1:]):
        yield int(r[start[a]]), int(item[start[a]]), rows[a:b]


def leaked_tests(documents: DataFrame, passages: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Texts that hold at least `least` successive words of a passage, with the passages.

    Both tables have a `text`; other columns are not read. Words are compared as
    words_of gives them; a text with brackets of more than 40 characters is read with and without what stands
    in them, and the reading that covers more counts. Null, empty and shorter texts hold nothing, passages
    shorter than `least` words are found nowhere. Repeated texts each come out;
    null keys come out null. Repeated passages come out under each key.
    Output: doc_key, item_key, n_tiles, longest, covered (words of the passage in
    tiles), item_words.
    """
    require_columns(documents, [doc_key, text], "leaked_tests, documents")
    require_columns(passages, [item_key, text], "leaked_tests, passages")
    spark = documents.sparkSession
    queries = passages.select(F.col(item_key).alias("k"), F.col(text).alias("t")).distinct()
    chars = queries.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = 1 + int(chars) // BLOCK_CHARS
    doc_type, item_type = documents.select(doc_key).schema[0].dataType.simpleString(), passages.select(item_key).schema[0].dataType.simpleString()
    out = None
    for b in range(blocks):
        rows = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b)
        coded = spark.sparkContext.broadcast(Passages([(r.k, r.t) for r in rows.collect()], least))

        def run(batches: Iterator[pa.RecordBatch], coded=coded) -> Iterator[pa.RecordBatch]:
            known = coded.value
            for batch in batches:
                for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                    part = batch.slice(a, TEXTS_AT_ONCE)
                    got = find_in(part["t"].to_pylist(), known)
                    if not got:
                        continue
                    keys = part["k"].take(pa.array([g[0] for g in got], pa.int64()))
                    items = [known.ids[g[1]] for g in got]
                    numbers = [pa.array([g[c] for g in got], pa.int32()) for c in (2, 3, 4)]
                    size = pa.array([len(known.words[g[1]]) for g in got], pa.int32())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(items), *numbers, size], ["k", "i", "n_tiles", "longest", "covered", "item_words"])

        docs = documents.select(F.col(doc_key).alias("k"), F.col(text).alias("t"))
        found = docs.mapInArrow(run, f"k {doc_type}, i {item_type}, n_tiles int, longest int, covered int, item_words int")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("k", doc_key).withColumnRenamed("i", item_key)
