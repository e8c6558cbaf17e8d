"""Labelled token sequences for the tagger: rows of a words table, labelled by their written form, and invented ones."""

from __future__ import annotations

import re

import numpy as np

from streamloom.llm.token_tagger import FILLER, MORE, NOTE, SPEAKER, SPEECH, TIME

_FILLER = re.compile(r"[\[(<{*]?(u+h+|u+m+|u+h+m+|h+m+|m+h+m+|mm+|e+r+|e+r+m+|e+h+|a+h+|m+hm+)[\])>}*]?[.,!?…]*", re.I)
_TIME = re.compile(r"[\[(<{](t:)?\d+([:.,]\d+)*[\])>}]", re.I)
_SPEAKER = re.compile(r"(>>\s*)?[\[(<]?(speaker|spk)[ _]?\d+[\])>]?:?", re.I)
_WHOLE_NOTE = re.compile(r"[\[(<{*][^\W\d_]{2,}[ \w-]*[\])>}*]|[♪♫]+|_+")
_OPEN = re.compile(r"[\[(<{*][^\W\d_]{2,}[\w-]*")
_CLOSE = re.compile(r"[^\W\d_][\w-]+[\])>}*]")


def by_form(tokens: list[str]) -> list[int]:
    """Tags by the written form alone; a note's brackets may open in one token and close in the next."""
    out: list[int] = []
    n = 0
    while n < len(tokens):
        t = tokens[n]
        if _FILLER.fullmatch(t):
            out.append(FILLER)
        elif _SPEAKER.fullmatch(t):
            out.append(SPEAKER)
        elif _TIME.fullmatch(t) and not re.fullmatch(r"\(\d{1,3}\)", t):
            out.append(TIME)
        elif _WHOLE_NOTE.fullmatch(t):
            out.append(NOTE)
        elif _OPEN.fullmatch(t) and n + 1 < len(tokens) and _CLOSE.fullmatch(tokens[n + 1]):
            out += [NOTE, MORE]
            n += 1
        else:
            out.append(SPEECH)
        n += 1
    return out


def invented(rng: np.random.Generator, plain: list[str], many: int) -> list[tuple[list[str], list[int]]]:
    """Sequences of plain words with marks of every kind put in at random."""
    notes = "applause laughter cough music noise sigh breath silence static whisper clapping inaudible crosstalk unclear ringing knocking".split()
    pairs = "door slams|phone rings|clears throat|paper rustling|background noise|lip smack|chair scrapes|soft music|audio drops|bell rings".split("|")
    brackets = [("[", "]"), ("(", ")"), ("<", ">"), ("*", "*")]
    sounds = "uh um uhm hm hmm mm mhm er erm ah eh uhh umm ummm errr ahh ehh".split()
    out = []
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    for _ in range(many):
        tokens: list[str] = []
        tags: list[int] = []
        for _ in range(int(rng.integers(8, 40))):
            kind = rng.random()
            o, c = pick(brackets)
            if kind < 0.62:
                w = pick(plain)
                w = w[: int(rng.integers(1, 4))] + "-" if rng.random() < 0.05 else w
                new, lab = [w], [SPEECH]
            elif kind < 0.68:
                o, c = pick(brackets[:2])
                new, lab = [o + pick(list("abcdnxyz0123456789")) + c], [SPEECH]
            elif kind < 0.70:
                new, lab = [f"({int(rng.integers(200, 999))})"], [SPEECH]
            elif kind < 0.71:
                new, lab = [f"{int(rng.integers(7, 23))}:{pick(['00', '15', '30'])}{pick(['', ',', '.'])}"], [SPEECH]
            elif kind < 0.80:
                s = pick(sounds)
                s = pick([s, s.upper(), s.capitalize()])
                new, lab = [pick([s, s + ",", s + "...", s + ".", f"[{s}]", f"({s})", f"<{s}>"])], [FILLER]
            elif kind < 0.86:
                m, s = int(rng.integers(60)), int(rng.integers(60))
                new = [pick([f"[00:{m:02}:{s:02}]", f"({m}:{s:02})", f"<{m * 60 + s}.{s:02}>", f"[{m:02}:{s:02}.{s % 10}]", f"[T:{m * 100 + s}]", f"[{m:02}:{s:02}]", f"<{m}.{s:02}>"])]
                lab = [TIME]
            elif kind < 0.92:
                d = int(rng.integers(12))
                new = [pick([f"[Speaker {d}]:", f"(Speaker {d}):", f">>Speaker {d}:", f"[speaker_{d}]", f"<spk{d}>", f"SPEAKER_{d:02}:", f"Speaker_{d}:", f">>spk{d}:"])]
                lab = [SPEAKER]
            elif kind < 0.96:
                s = pick(notes + pairs)
                s = pick([s, s.capitalize(), s.upper()])
                new, lab = [pick([o + s + c, "♪", "_"])], [NOTE]
            else:
                a, b = pick(pairs).split()
                new, lab = [o + a, b + c], [NOTE, MORE]
            tokens += new
            tags += lab
        out.append((tokens, tags))
    return out


def lessons(folder: str, invent: int = 3000, take: int = 60) -> list[tuple[list[str], list[int]]]:
    import pyarrow.parquet as pq

    words = pq.read_table(f"{folder}/words.parquet", columns=["rec_id", "i", "text"]).to_pandas()
    words = words.drop_duplicates(["rec_id", "i"]).sort_values(["rec_id", "i"])
    found = []
    for _, g in list(words.groupby("rec_id"))[:take]:
        tokens = g.text.tolist()
        found += [(tokens[a : a + 60], by_form(tokens[a : a + 60])) for a in range(0, len(tokens), 60)]
    plain = sorted({t for tokens, tags in found for t, x in zip(tokens, tags) if x == SPEECH and re.fullmatch(r"[A-Za-z'’-]+[.,?!]?", t)})
    return found + invented(np.random.default_rng(11), plain, invent)
