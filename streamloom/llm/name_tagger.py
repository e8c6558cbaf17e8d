"""Which tokens of spoken text belong to persons' names: a linear model over a token's form and its neighbours.

A token's score is the sum of its own weights and of those that its two neighbours on
each side have at their distance, and of a weight for each pair of adjacent forms. All
but the pairs depends on single tokens, so it is computed once for each distinct
token and a text costs a few array look-ups. Names themselves have no weights of their own:
in training every name is replaced by an invented one.

Weights are trained by logistic regression on at most LESSON_RECORDINGS recordings, whose
names are told by their speaker maps (`python -m streamloom.llm.name_tagger DIR`).
"""

from __future__ import annotations

import json
import re
import sys
from functools import lru_cache
from pathlib import Path

import numpy as np

WEIGHTS = Path(__file__).with_name("name_tagger.json")
#: Recordings to train on, times a known word must stand in them, copies with other names.
LESSON_RECORDINGS, KNOWN_FROM, COPIES = 600, 4, 4
OFFSETS = (-2, -1, 0, 1, 2)
SHAPES = ("none", "initial", "Xx", "XX", "xx", "digit", "mixed")
ENDS = ("", "stop", "comma", "owned")

_EDGE = re.compile(r"^[^\w+@#(]+|[^\w)]+$")
_OWNED = re.compile(r"['’]s?$", re.I)


def forms(token: str) -> tuple[str, int, int]:
    """A token in lower case without edge signs and possessive ending, its shape and how it ends."""
    bare = _EDGE.sub("", token)
    core = _OWNED.sub("", bare)
    letters = re.sub(r"[-'’]", "", core)
    if not letters:
        shape = 0
    elif re.fullmatch(r"[A-Z]\.", token):
        shape = 1
    elif any(c.isdigit() for c in letters):
        shape = 5
    elif not letters.isalpha():
        shape = 6
    elif letters.isupper() and len(letters) > 1:
        shape = 3
    else:
        shape = 2 if letters[0].isupper() else 4
    end = 3 if core != bare else 1 if token[-1:] in ".?!:;" and shape != 1 else 2 if token[-1:] == "," else 0
    return core.lower(), shape, end


def own_features(token: str, known: frozenset[str] | set[str], given: frozenset[str] | set[str]) -> tuple[list[str], int]:
    """A token's features, and its class: shape, end, and whether the word is known."""
    word, shape, end = forms(token)
    new = word not in known
    out = [f"shape={shape}", f"end={end}", f"new={new}", f"shape={shape}new={new}"]
    out.append(f"word={word}" if not new else "given" if word in given else f"tail={word[-3:]}")
    return out, (shape * len(ENDS) + end) * 2 + new


CLASSES = len(SHAPES) * len(ENDS) * 2


class NameTagger:
    """Scores of tokens; above 0 they belong to a name."""

    def __init__(self, model: dict, given: frozenset[str]):
        self.known, self.given = frozenset(model["known"]), given
        self.w = [{f: v for f, v in part.items()} for part in model["at"]]
        self.pair = np.array(model["pair"], np.float32).reshape(CLASSES, CLASSES)
        self.bias = float(model["bias"])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(OFFSETS)), np.float32)
        self.kinds = np.zeros(1024, np.int64)
        self._number("")

    def _number(self, token: str) -> int:
        n = self.index[token] = len(self.index)
        if n == len(self.rows):
            self.rows, self.kinds = np.concatenate([self.rows, np.zeros_like(self.rows)]), np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        features, self.kinds[n] = own_features(token, self.known, self.given)
        self.rows[n] = [sum(w.get(f, 0.0) for f in features) for w in self.w]
        return n

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each token's score, and whether it is a word the tagger doesn't know."""
        if len(self.index) > 200_000:
            self.clear()
        get, add = self.index.get, self._number
        ids = np.array([n if (n := get(t)) is not None else add(t) for t in texts], np.int64)
        n = len(ids)
        out = np.full(n, self.bias, np.float32)
        for k, o in enumerate(OFFSETS):
            a, b = max(0, -o), min(n, n - o)
            if a < b:
                out[a:b] += self.rows[ids[a + o : b + o], k]
            # Outside stands the empty token.
            out[:a] += self.rows[0, k]
            out[max(b, a) :] += self.rows[0, k]
        kind = np.r_[self.kinds[0], self.kinds[ids], self.kinds[0]]
        each = self.pair[kind[:-1], kind[1:]]
        return out + each[:-1] + each[1:], (self.kinds[ids] % 2 == 1) & (self.kinds[ids] >= 4 * len(ENDS) // 2)


@lru_cache(maxsize=1)
def tagger() -> NameTagger:
    from streamloom.llm.personal_data import GIVEN

    return NameTagger(json.loads(WEIGHTS.read_text()), frozenset(GIVEN))


# -- training ---------------------------------------------------------------------

_C, _V = "b c d f g h j k l m n p r s t v w z br ch cl dr fr gr kr pr sch sh sl st th tr".split(), "a e i o u ai ea ei ie oo y".split()
_LAST = " n r s l k m t th ng ck ll nd rt x ski son man ez ov er"


def invented(rng: np.random.Generator) -> str:
    """A name made of one to three syllables."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    s = "".join(pick(_C) + pick(_V) for _ in range(int(rng.integers(1, 4)))) + pick(_LAST.split(" "))
    return s if len(s) > 2 else s + pick(_C) + pick(_V)


def _replaced(token: str, given: bool, rng: np.random.Generator, names: list[str]) -> str:
    """Another name in the token's place, with its case and signs."""
    m = re.search(r"\w[\w'’-]*\w|\w", token)
    if not m:
        return token
    core = _OWNED.sub("", m.group())
    new = names[int(rng.integers(len(names)))] if given and rng.random() < 0.5 else invented(rng)
    new = new.upper() if core.isupper() and len(core) > 1 else new.capitalize() if core[0].isupper() else new
    return token[: m.start()] + new + token[m.start() + len(core) :]


def lessons(folder: str) -> list[tuple[list[str], list[int]]]:
    """Token sequences as parsers see them, and for each token 0, or 1 for a family name or initial, 2 for a given name."""
    import pyarrow.parquet as pq

    from streamloom.llm import personal_data as pd
    from streamloom.llm.token_tagger import SPEECH, emissions, tag_blocks

    people = {re.sub(r"[^\w' -]", "", re.sub(r"^(?:\w+\.|Prof|Professor|Dr|Mrs?|Ms)\s+", "", n)).lower() for n in pq.read_table(f"{folder}/speaker_map.parquet", columns=["display_name"])["display_name"].to_pylist() if n}
    people = [p.split() for p in people]
    known = {w for p in people for w in p if len(w) > 1} - {"prof", "professor", "dr"}
    firsts = {p[0] for p in people if len(p) > 1}
    t = pq.read_table(f"{folder}/words.parquet", columns=["rec_id", "i", "text"])
    rows = sorted({(r, i): x for r, i, x in zip(*(t[c].to_pylist() for c in ("rec_id", "i", "text"))) if r is not None and i is not None}.items())
    by: dict[str, list[str]] = {}
    for (r, _), x in rows:
        by.setdefault(r, []).append(x or "")
    rng = np.random.default_rng(3)
    ids = sorted(by)
    out = []
    for k in rng.permutation(len(ids))[:LESSON_RECORDINGS]:
        tokens = by[ids[k]]
        tags = tag_blocks(emissions(tokens), np.array([0, len(tokens)]))
        distinct = {v: n for n, v in enumerate(dict.fromkeys(tokens))}
        seen = pd._visible(pd._traits(list(distinct)), np.array([distinct[v] for v in tokens]), tags).tolist()
        texts = [tokens[r] if tags[r] == SPEECH else "|" for r in seen]
        x = pd._Tokens(texts, list(range(len(texts))))
        y = [2 if w in firsts else 1 if w in known else 0 for w in x.word]
        for j in range(len(y) - 1, -1, -1):
            if re.fullmatch(r"[A-Z]\.", texts[j]) and j + 1 < len(y) and y[j + 1]:
                y[j] = 1
            elif y[j] and (j + 1 == len(y) or not y[j + 1]) and not pd._nothing_else(x, j, j):
                y[j] = 0
        out.append((texts, y))
    return out


def train(folder: str, rounds: int = 8, rate: float = 0.3) -> dict:
    from streamloom.llm.personal_data import GIVEN

    rng = np.random.default_rng(11)
    source = lessons(folder)
    counts: dict[str, int] = {}
    for texts, y in source:
        for t, k in zip(texts, y):
            if not k:
                counts[forms(t)[0]] = counts.get(forms(t)[0], 0) + 1
    known = frozenset(w for w, n in counts.items() if n >= KNOWN_FROM and w not in set(GIVEN))
    given = frozenset(GIVEN)
    number: list[dict[str, int]] = [{} for _ in OFFSETS]
    sizes = 0
    ids, kinds, gold = [], [], []
    cache: dict[str, tuple[list[str], int]] = {}
    for _ in range(COPIES):
        for texts, y in source:
            now = [_replaced(t, k == 2, rng, GIVEN) if k and not re.fullmatch(r"[A-Z]\.", t) else t for t, k in zip(texts, y)]
            # Some known words are hidden, so that form and context must do.
            hide = rng.random(len(now)) < 0.06
            fs = []
            for t, h in zip(now, hide):
                if h:
                    fs.append(own_features(t, frozenset(), given))
                else:
                    if t not in cache:
                        cache[t] = own_features(t, known, given)
                    fs.append(cache[t])
            empty = own_features("", known, given)
            fs = [empty, empty, *fs, empty, empty]
            for j in range(2, len(fs) - 2):
                row = []
                for k, o in enumerate(OFFSETS):
                    for f in fs[j + o][0]:
                        if f not in number[k]:
                            number[k][f] = sizes
                            sizes += 1
                        row.append(number[k][f])
                ids.append(row)
                kinds.append((fs[j - 1][1], fs[j][1], fs[j + 1][1]))
            gold += [int(k > 0) for k in y]
    rows, kinds, gold = np.array(ids, np.int32), np.array(kinds), np.array(gold, np.float32)
    w, pair, bias = np.zeros(sizes, np.float32), np.zeros((CLASSES, CLASSES), np.float32), -2.0
    gw, gp = np.full(sizes, 1e-2, np.float32), np.full((CLASSES, CLASSES), 1e-2, np.float32)
    for r in range(rounds):
        order, loss = rng.permutation(len(rows)), 0.0
        for a in range(0, len(order), 4096):
            at = order[a : a + 4096]
            z = w[rows[at]].sum(1) + pair[kinds[at, 0], kinds[at, 1]] + pair[kinds[at, 1], kinds[at, 2]] + bias
            p = 1 / (1 + np.exp(-z))
            loss += float(-np.log(np.where(gold[at] > 0, p, 1 - p) + 1e-9).sum())
            d = p - gold[at]
            g = np.bincount(rows[at].ravel(), np.repeat(d, rows.shape[1]), sizes).astype(np.float32) + 1e-3 * w
            gw += g * g
            w -= rate * g / np.sqrt(gw)
            flat = np.bincount(kinds[at, 0] * CLASSES + kinds[at, 1], d, CLASSES**2) + np.bincount(kinds[at, 1] * CLASSES + kinds[at, 2], d, CLASSES**2)
            flat = flat.reshape(CLASSES, CLASSES).astype(np.float32) + 1e-3 * pair
            gp += flat * flat
            pair -= rate * flat / np.sqrt(gp)
            bias -= 1e-3 * float(d.sum()) / 64
        print(f"round {r}: loss {loss / len(rows):.5f}", flush=True)
    at = [{f: round(float(w[n]), 2) for f, n in part.items() if abs(w[n]) >= 0.05} for part in number]
    return {"known": sorted(known), "at": at, "pair": [round(float(x), 2) for x in pair.ravel()], "bias": round(bias, 3)}


if __name__ == "__main__":
    WEIGHTS.write_text(json.dumps(train(sys.argv[1]), ensure_ascii=False, separators=(",", ":")))
