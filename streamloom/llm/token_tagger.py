"""A linear-chain tagger of transcript tokens, decoded by Viterbi.

Tags: speech, filler, time (a time mark), speaker (a speaker tag), note (the first
or only token of a sound or audio note) and more (a further token of a note).
Emission scores are sums of the weights of a token's own features and are computed
once for each distinct token of a batch; the chain's transitions tell a note that
stretches over two tokens from a lone bracketed token.

Weights are trained by `train` (averaged structured perceptron) and stored as JSON
beside this module; `python -m streamloom.llm.token_tagger DIR` trains them anew.
"""

from __future__ import annotations

import json
import re
import sys
from functools import lru_cache
from pathlib import Path

import numpy as np

TAGS = ("speech", "filler", "time", "speaker", "note", "more")
SPEECH, FILLER, TIME, SPEAKER, NOTE, MORE = range(6)
WEIGHTS = Path(__file__).with_name("token_tagger.json")

_CORE = re.compile(r"[^\w]+", re.UNICODE)


def features(token: str) -> list[str]:
    """The features of one token; they don't depend on its neighbours."""
    t = token.strip()
    core = _CORE.sub("", t.lower()).replace("_", "")
    squeezed = re.sub(r"(.)\1+", r"\1", core)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", "9", t.lower()))
    opens, closes = t[:1] in "[(<{*" and bool(t), t[-1:] in "])>}*" and len(t) > 1
    bracket = ("o" if opens else "-") + ("c" if closes or t.rstrip(":")[-1:] in "])>}" else "-")
    out = ["bias", f"bracket={bracket}", f"shape={shape[:12]}", f"bracket+shape={bracket}{shape[:12]}"]
    if len(squeezed) <= 3:
        out.append(f"core={squeezed}")
        out.append(f"core+end={squeezed}{'-' if t.endswith('-') else ''}")
        out.append(f"core+bracket={squeezed}{bracket}")
    if core:
        out.append(f"start={core[:3]}{bracket}")
        out.append(f"length={min(len(core), 4)}{bracket}")
        out.append("letters" if core.isalpha() else "digits" if core.isdigit() else "mixed")
        stem = re.sub(r"\d+$", "", core)
        if stem != core:
            out.append(f"numbered={stem[:8]}")
            out.append(f"numbered={stem[:8]}{bracket}{t.endswith(':')}")
    else:
        out.append(f"sign={t[:2]}")
    if t.endswith(":"):
        out.append("colon")
        out.append(f"colon{bracket}")
    if ":" in t[:-1] and core[:1].isdigit():
        out.append(f"clock{bracket}")
    if " " in t:
        out.append(f"two{bracket}")
    return out


@lru_cache(maxsize=1)
def _model() -> tuple[dict[str, np.ndarray], np.ndarray]:
    raw = json.loads(WEIGHTS.read_text())
    return {k: np.array(v, np.float32) for k, v in raw["emit"].items()}, np.array(raw["step"], np.float32)


_SEEN: dict[str, np.ndarray] = {}


def emissions(tokens: list[str | None]) -> np.ndarray:
    """Scores (tokens, tags); a null token scores as speech without letters."""
    weights, _ = _model()
    if len(_SEEN) > 200_000:
        _SEEN.clear()
    out = np.empty((len(tokens), len(TAGS)), np.float32)
    zero = np.zeros(len(TAGS), np.float32)
    for n, t in enumerate(tokens):
        t = t or ""
        row = _SEEN.get(t)
        if row is None:
            row = _SEEN[t] = sum((weights.get(f, zero) for f in features(t)), zero.copy())
        out[n] = row
    return out


def viterbi(emit: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags of many sequences at once.

    emit: the rows of all sequences, one after the other; first: where each begins.
    """
    n, k = emit.shape
    size = np.diff(np.r_[first, n])
    by_size = np.argsort(-size, kind="stable")
    begin, size = first[by_size], size[by_size]
    back = np.zeros((n, k), np.int8)
    score = emit[begin].copy()
    final = np.empty((len(begin), k), np.float32)
    longest = int(size[0]) if len(size) else 0
    alive_at = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences longer than t
    for t in range(1, longest):
        alive = alive_at[t]
        if alive < len(score):
            final[alive:len(score)] = score[alive:]
            score = score[:alive]
        moved = score[:, :, None] + step[None, :, :]
        best = moved.argmax(axis=1)
        at = begin[:alive] + t
        back[at] = best
        score = np.take_along_axis(moved, best[:, None, :], axis=1)[:, 0, :] + emit[at]
    final[: len(score)] = score
    tags = np.empty(n, np.int8)
    now = final.argmax(axis=1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        alive = int(np.searchsorted(-size, -t, side="left"))
        at = begin[:alive] + t
        tags[at] = now[:alive]
        if t:
            now[:alive] = back[at, now[:alive]]
    return tags


def tag(tokens: list[str | None], first: np.ndarray | None = None) -> np.ndarray:
    """Tags of token sequences; `first` tells where each begins (default: one sequence)."""
    if not len(tokens):
        return np.zeros(0, np.int8)
    return viterbi(emissions(tokens), np.zeros(1, np.int64) if first is None else first, _model()[1])


def tag_blocks(emit: np.ndarray, cuts: np.ndarray, size: int = 1024, halo: int = 8) -> np.ndarray:
    """Best tags of sequences of any length, decoded in blocks that see `halo` tokens of their neighbours.

    cuts: where each sequence begins, and the end of the last. Blocks of all
    sequences are decoded side by side, so a long one costs no more steps than `size`.
    """
    lengths = np.diff(cuts)
    n = -(-lengths // size)
    seq = np.repeat(np.arange(len(lengths)), n)
    k = np.arange(len(seq)) - np.repeat(np.cumsum(n) - n, n)
    lo, hi = cuts[seq] + k * size, np.minimum(cuts[seq] + (k + 1) * size, cuts[seq + 1])
    a, b = np.maximum(lo - halo, cuts[seq]), np.minimum(hi + halo, cuts[seq + 1])
    if not len(seq):
        return np.zeros(0, np.int8)
    wide = b - a
    first = np.cumsum(wide) - wide
    at = np.repeat(a - first, wide) + np.arange(wide.sum())
    tags = viterbi(emit[at], first, _model()[1])
    core = (at >= np.repeat(lo, wide)) & (at < np.repeat(hi, wide))
    out = np.empty(len(emit), np.int8)
    out[at[core]] = tags[core]
    return out


# -- training ------------------------------------------------------------------


def train(sequences: list[tuple[list[str], list[int]]], rounds: int = 6, seed: int = 7) -> dict:
    """Averaged structured perceptron over labelled sequences; gives the JSON of the weights."""
    rng = np.random.default_rng(seed)
    names: dict[str, int] = {}
    data = []
    for tokens, tags in sequences:
        data.append(([np.array([names.setdefault(f, len(names)) for f in features(t)]) for t in tokens], np.array(tags)))
    k = len(TAGS)
    w, w_sum = np.zeros((len(names), k), np.float32), np.zeros((len(names), k), np.float32)
    s, s_sum = np.zeros((k, k), np.float32), np.zeros((k, k), np.float32)
    seen = 0
    for _ in range(rounds):
        for at in rng.permutation(len(data)):
            rows, gold = data[at]
            emit = np.stack([w[r].sum(axis=0) for r in rows])
            got = viterbi(emit, np.zeros(1, np.int64), s)
            for r, a, b in zip(rows, gold, got):
                if a != b:
                    w[r, a] += 1
                    w[r, b] -= 1
            for (a0, a1), (b0, b1) in zip(zip(gold, gold[1:]), zip(got, got[1:])):
                if (a0, a1) != (b0, b1):
                    s[a0, a1] += 1
                    s[b0, b1] -= 1
            w_sum += w
            s_sum += s
            seen += 1
    w, s = w_sum / seen, s_sum / seen
    keep = {f: [round(float(x), 3) for x in w[i]] for f, i in names.items() if np.abs(w[i]).max() > 0.01}
    return {"emit": keep, "step": [[round(float(x), 3) for x in r] for r in s]}


def main(folder: str) -> None:
    from streamloom.llm.tagger_lessons import lessons

    model = train(lessons(folder))
    WEIGHTS.write_text(json.dumps(model, ensure_ascii=False, indent=0))


if __name__ == "__main__":
    main(sys.argv[1])
