"""Pairing, marks and lines against plain searches."""

import itertools
import random

import pandas as pd

from streamloom.operators.align import IDENTITIES, _paired, assignment
from streamloom.operators.sheets import _Check
from streamloom.operators.timeline import _Spots


def test_assignment_is_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        rows, cols = rng.randrange(1, 5), rng.randrange(5, 7)
        cost = [[rng.randrange(-20, 20) for _ in range(cols)] for _ in range(rows)]
        got = assignment(cost)
        assert len(set(got)) == rows
        assert sum(cost[r][c] for r, c in enumerate(got)) == min(sum(cost[r][c] for r, c in enumerate(p)) for p in itertools.permutations(range(cols), rows))


def test_pairing_shares_most_words_and_ties_go_to_the_first():
    rng = random.Random(6)
    for _ in range(80):
        labels, ids = [f"x{k}" for k in range(rng.randrange(1, 5))], IDENTITIES[:3]
        n = {(x, w): c for x in labels for w in ids if (c := rng.choice([0, 0, 1, 2, 3]))}
        every = [p for p in itertools.product([*range(3), 9], repeat=len(labels)) if len({c for c in p if c < 9}) == sum(c < 9 for c in p) and all(c == 9 or (x, ids[c]) in n for x, c in zip(labels, p))]
        best = min(every, key=lambda p: (-sum(n[x, ids[c]] for x, c in zip(labels, p) if c < 9), p))
        assert _paired(labels, n) == {x: ids[c] for x, c in zip(labels, best) if c < 9}


def test_nearest_spot_matches_a_plain_search():
    rng = random.Random(8)
    for _ in range(200):
        spots = sorted((rng.randrange(20) / 2, k) for k in rng.sample(range(50), rng.randrange(0, 9)))
        due, behind, within = rng.randrange(24) / 2, rng.randrange(16) / 2, rng.choice([2.0, float("inf")])
        s = _Spots(pd.Series([t for t, _ in spots], dtype=float), pd.Series([k for _, k in spots], dtype=int), within)
        near = [(abs(t - due), t, k) for t, k in spots if t > behind and abs(t - due) <= within]
        assert s.nearest(due, behind) == (min(near)[1:] if near else None)


def test_open_changes_of_a_sheet():
    """Every order of up to three events, read one after the other."""
    kinds = ["real", "spurious", "none", ("change", "S"), ("change", "?"), ("back", "S"), ("back", "L")]
    for size in range(1, 4):
        for seq in itertools.product(kinds, repeat=size):
            c = _Check([], [])
            c.out.clear()
            c.verdict = {str(n): e for n, e in enumerate(seq) if e in ("real", "spurious")}
            c.events = [("boundary", str(n), None) if isinstance(e, str) else (e[0], n, e[1]) for n, e in enumerate(seq)]
            c.balance()
            want, held, bare = [], None, False
            for n, e in enumerate(seq):
                if e == "real":
                    held, bare = None, False
                elif e == "none":
                    bare = bare or held is not None
                elif e != "spurious":
                    same = held is not None and seq[held][1] == e[1] != "?"
                    if e[0] == "back" and held is None:
                        want.append((n, "back_without_change"))
                    if same:
                        want.append((n, "change_to_open_speaker" if e[0] == "change" else "back_to_open_speaker"))
                    held, bare = (n if e[0] == "change" else None), False
            want += [(held, "change_never_returns")] if held is not None else []
            assert sorted((r[0], r[2]) for r in c.out) == sorted(want)
            assert held is None or c.out[-1][1] == ("note" if bare else "error")
