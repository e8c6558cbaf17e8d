"""A bidirectional gated recurrent network with attention pooling, in numpy.

Input of a token: a word vector and the mean of its letter-trigram vectors. Gates
are hard sigmoids and candidates hard tangents, so a step is one small matrix
product and clips. The input products of both directions are computed once for
each distinct token. Scores are per window and kind.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

from streamloom.llm.content_text import GRAM_BUCKETS, WORD_BUCKETS, crc, letters

KINDS = ("abusive", "hateful", "sexual")
WEIGHTS = Path(__file__).with_name("content_model.npz")
#: Words of a window, distance between windows, size of a token's two vectors and of each direction's state.
WINDOW, STRIDE, EMBED, STATE = 16, 8, 12, 16
#: Windows computed at once (states stay in cache).
AT_ONCE = 2048


def fresh(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": normal(WORD_BUCKETS, EMBED, scale=0.1), "gram": normal(GRAM_BUCKETS, EMBED, scale=0.3), "a": normal(2 * STATE, scale=0.3), "out": normal(2 * STATE, len(KINDS), scale=0.3), "out_b": np.full(len(KINDS), -2, np.float32)}
    for d in "fb":
        p[f"W{d}"] = normal(2 * EMBED, 3 * STATE, scale=0.3)
        p[f"U{d}"] = normal(STATE, 3 * STATE, scale=0.2)
        p[f"c{d}"] = np.zeros(3 * STATE, np.float32)
    return p


def load() -> dict[str, np.ndarray]:
    with np.load(WEIGHTS) as z:
        return {k: z[k].astype(np.float32) for k in z.files}


def vectors(p: dict[str, np.ndarray], words: list[str]) -> np.ndarray:
    """Token vectors of folded words."""
    out = np.empty((len(words), 2 * EMBED), np.float32)
    for n, w in enumerate(words):
        out[n, :EMBED] = p["word"][crc(w, WORD_BUCKETS)]
        out[n, EMBED:] = p["gram"][letters(w)].mean(axis=0)
    return out


def inputs(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input products of both directions, biases included, the gates scaled for the hard sigmoid."""
    out = []
    for d in "fb":
        g = x @ p[f"W{d}"] + p[f"c{d}"]
        g[:, : 2 * STATE] = g[:, : 2 * STATE] * 0.2 + 0.5
        out.append(np.ascontiguousarray(g))
    return out[0], out[1]


def states(p: dict[str, np.ndarray], gates: np.ndarray, rows: np.ndarray, d: str) -> np.ndarray:
    """States (T, windows, STATE) of one direction; rows: token numbers (windows, T), -1 where there is none."""
    many, steps = rows.shape
    u = p[f"U{d}"].copy()
    u[:, : 2 * STATE] *= 0.2
    h = np.zeros((many, STATE), np.float32)
    out = np.empty((steps, many, STATE), np.float32)
    ragged = bool((rows < 0).any())
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        gx, gh = gates[rows[:, t]], h @ u
        zr = gx[:, : 2 * STATE] + gh[:, : 2 * STATE]
        np.clip(zr, 0, 1, out=zr)
        c = gh[:, 2 * STATE :]
        c *= zr[:, STATE:]
        c += gx[:, 2 * STATE :]
        np.clip(c, -1, 1, out=c)
        c -= h
        c *= zr[:, :STATE]
        if ragged:
            c *= (rows[:, t] >= 0)[:, None]
        h = h + c
        out[t] = h
    return out


def window_scores(p: dict[str, np.ndarray], gates: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Probabilities (windows, kinds)."""
    out = np.empty((len(rows), len(KINDS)), np.float32)
    for a in range(0, len(rows), AT_ONCE):
        part = rows[a : a + AT_ONCE]
        f, b = states(p, gates[0], part, "f"), states(p, gates[1], part, "b")
        score = f @ p["a"][:STATE] + b @ p["a"][STATE:]
        if (part < 0).any():
            score = np.where(part.T >= 0, score, -1e9)
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        # First project each state to the kinds, then pool: the order doesn't matter, the pooling is cheaper.
        logit = np.einsum("tb,tbk->bk", score, f @ p["out"][:STATE] + b @ p["out"][STATE:]) + p["out_b"]
        out[a : a + AT_ONCE] = 1 / (1 + np.exp(-logit))
    return out


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts of `sizes` words laid end to end: the window starts and each window's text.

    Windows overlap by half; the last ends with the text. A text shorter than a
    window has one; an empty text none.
    """
    begin = np.cumsum(np.r_[0, sizes])[:-1]
    n = np.where(sizes == 0, 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    offset = np.minimum(k * STRIDE, np.maximum(sizes[text] - WINDOW, 0))
    return begin[text] + offset, text


# -- training ---------------------------------------------------------------------


class Trainer:
    """Back-propagation through time with Adam; batches of (token rows, labels)."""

    def __init__(self, words: list[str], seed: int = 5, rate: float = 3e-3):
        self.rng = np.random.default_rng(seed)
        self.p = fresh(self.rng)
        self.rate, self.step_no = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.word_of = np.array([crc(w, WORD_BUCKETS) for w in words])
        grams = [letters(w) for w in words]
        self.gram_n = np.array([len(g) for g in grams])
        self.gram_at = np.cumsum(self.gram_n) - self.gram_n
        self.gram_of = np.concatenate(grams)

    def _grams(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All trigrams of some tokens, end to end: their buckets, where each token's begin, and how many it has."""
        n = self.gram_n[tokens]
        at = np.cumsum(n) - n
        return self.gram_of[np.repeat(self.gram_at[tokens] - at, n) + np.arange(n.sum())], at, n

    def _forward(self, rows: np.ndarray, drop: float):
        p = self.p
        tokens, at = np.unique(rows, return_inverse=True)
        at = at.reshape(rows.shape)
        g, first, n = self._grams(tokens)
        x = np.concatenate([p["word"][self.word_of[tokens]], np.add.reduceat(p["gram"][g], first) / n[:, None].astype(np.float32)], axis=1)
        keep_word = (self.rng.random((len(tokens), 1)) > drop).astype(np.float32) if drop else np.ones((len(tokens), 1), np.float32)
        x[:, :EMBED] *= keep_word
        valid = (rows >= 0).astype(np.float32)
        tape = {}
        for d in "fb":
            gx = (x @ p[f"W{d}"] + p[f"c{d}"])[at]
            h = np.zeros((len(rows), STATE), np.float32)
            steps = range(rows.shape[1]) if d == "f" else range(rows.shape[1] - 1, -1, -1)
            log = []
            hs = np.empty((rows.shape[1], len(rows), STATE), np.float32)
            for t in steps:
                gh = h @ p[f"U{d}"]
                pre = gx[:, t, : 2 * STATE] + gh[:, : 2 * STATE]
                zr = np.clip(pre * 0.2 + 0.5, 0, 1)
                z, r = zr[:, :STATE], zr[:, STATE:]
                cp = gx[:, t, 2 * STATE :] + r * gh[:, 2 * STATE :]
                c = np.clip(cp, -1, 1)
                m = valid[:, t : t + 1]
                log.append((t, h, gh, pre, z, r, cp, c, m))
                h = h + m * z * (c - h)
                hs[t] = h
            tape[d] = (log, hs)
        h = np.concatenate([tape["f"][1], tape["b"][1]], axis=2)
        s = np.where(valid.T > 0, h @ p["a"], -1e9)
        s = np.exp(s - s.max(0))
        alpha = s / s.sum(0)
        pooled = np.einsum("tb,tbh->bh", alpha, h)
        prob = 1 / (1 + np.exp(-(pooled @ p["out"] + p["out_b"])))
        return prob, (tokens, at, x, keep_word, tape, h, alpha, pooled)

    def step(self, rows: np.ndarray, gold: np.ndarray, drop: float = 0.3) -> float:
        p = self.p
        prob, (tokens, at, x, keep_word, tape, h, alpha, pooled) = self._forward(rows, drop)
        judged = gold >= 0  # -1: not judged
        loss = -np.mean(judged * (gold * np.log(prob + 1e-7) + (1 - gold) * np.log(1 - prob + 1e-7)))
        grad = {}
        dl = ((prob - gold) * judged).astype(np.float32) / len(rows)
        grad["out"], grad["out_b"] = pooled.T @ dl, dl.sum(0)
        dp = dl @ p["out"].T
        da = np.einsum("bh,tbh->tb", dp, h)
        ds = alpha * (da - (alpha * da).sum(0))
        dh_all = alpha[..., None] * dp[None] + ds[..., None] * p["a"]
        grad["a"] = np.einsum("tb,tbh->h", ds, h)
        dx = np.zeros_like(x)
        for n, d in enumerate("fb"):
            log, _ = tape[d]
            dh_own = dh_all[:, :, n * STATE : (n + 1) * STATE]
            dU = np.zeros_like(p[f"U{d}"])
            dgx = np.zeros((len(rows), rows.shape[1], 3 * STATE), np.float32)
            dh = np.zeros((len(rows), STATE), np.float32)
            for t, h0, gh, pre, z, r, cp, c, m in reversed(log):
                dh = dh + dh_own[t]
                dz, dc = dh * m * (c - h0), dh * m * z
                dcp = dc * (np.abs(cp) < 1)
                dr = dcp * gh[:, 2 * STATE :]
                dpre = np.concatenate([dz, dr], 1) * ((pre > -2.5) & (pre < 2.5)) * 0.2
                dgh = np.concatenate([dpre, dcp * r], 1)
                dU += h0.T @ dgh
                dgx[:, t] = np.concatenate([dpre, dcp], 1)
                dh = dh * (1 - m * z) + dgh @ p[f"U{d}"].T
            grad[f"U{d}"] = dU
            per_token = np.zeros((len(tokens), 3 * STATE), np.float32)
            np.add.at(per_token, at.reshape(-1), dgx.reshape(-1, 3 * STATE))
            grad[f"W{d}"], grad[f"c{d}"] = x.T @ per_token, per_token.sum(0)
            dx += per_token @ p[f"W{d}"].T
        real = tokens >= 0
        tk = tokens[real]
        grad["word"] = np.zeros_like(p["word"])
        np.add.at(grad["word"], self.word_of[tk], (dx[:, :EMBED] * keep_word)[real])
        grad["gram"] = np.zeros_like(p["gram"])
        g, _, n = self._grams(tk)
        np.add.at(grad["gram"], g, np.repeat(dx[real, EMBED:] / n[:, None].astype(np.float32), n, axis=0))
        self.step_no += 1
        fix = np.sqrt(1 - 0.999**self.step_no) / (1 - 0.9**self.step_no)
        for k, gk in grad.items():
            gk = np.clip(gk, -1, 1)
            self.m[k] = 0.9 * self.m[k] + 0.1 * gk
            self.v[k] = 0.999 * self.v[k] + 0.001 * gk * gk
            p[k] -= (self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)
        return float(loss)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(rows[a : a + 512], 0)[0] for a in range(0, len(rows), 512)])

    def save(self, path: Path = WEIGHTS) -> None:
        np.savez_compressed(path, **{k: v.astype(np.float16) for k, v in self.p.items()})
