"""Personal data in free text: e-mail addresses, phone numbers, identity numbers, street addresses, names.

Anchor expansion. One Aho-Corasick pass over the spoken tokens finds at-signs and
spoken "at", number starts, street types, identifier and phone cues, titles and
given names; a tagger of forms and contexts (name_tagger) adds the starts of other names. A local
parser at each anchor expands to the mention's ends and
validates it; nothing else of the text is looked at again. Hesitations, sound
notes, time marks, broken-off words, single bracketed signs and repeats are
transparent to the parsers. What stands in brackets, or is tagged as no speech, and
is no known sound, time mark, speaker tag or hesitation is read twice: looked
through, and as words.

The same parsers serve a word stream (positions are the words' order) and a text
(positions are characters).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamloom.llm.name_tagger import tagger
from streamloom.llm.token_tagger import SPEAKER, SPEECH, _model, emissions, tag_blocks, viterbi
from streamloom.operators.arrow_groups import starts, whole_groups
from streamloom.operators.scan import block_of
from streamloom.operators.shared import OWN, require_columns, write_and_read

#: Positions of a block, tokens of its neighbours it sees, rows a worker holds at once.
BLOCK_WORDS = 1024
HALO = 48
#: What mentions are made of at most, so that each lies within REACH visible tokens of its first: parts of a
#: spelled address on each side of its "at", tokens between a cue and its number, digits of a spelled number.
SPELLED_PARTS, CUE_AHEAD, MOST_DIGITS = 8, 8, 15
REACH = 2 * (2 * SPELLED_PARTS + 1)
CHUNK_ROWS = 200_000

# -- fixed values ----------------------------------------------------------------
# Common given names.
GIVEN = """
amina anna anton bianca clara daniel david elena felix greta helena hugo ingrid irene james julia kenji laura leila
marcus maria martin mateo mina nadia noor oliver owen peter priya rafael selma simon sofia stefan thomas tobias victor
wanda yusuf ahmed alice andrew carlos catherine charlotte christopher elizabeth emily fatima hannah isabel jennifer
jessica john jose joseph katherine kevin linda lucas margaret mary matthew michael mohammed nicholas olivia patricia
patrick rachel rebecca richard robert samuel sarah sophie steven susan william
""".split()
TITLES = "dr prof professor mr mrs ms miss sir madam".split()
STREETS = "st street ave avenue rd road lane ln drive close court ct terrace blvd boulevard crescent square place".split()
UNITS = "apt apartment unit suite flat".split()
NOT_IN_STREET = "of the them and in on at to a an is was were for that by from with it he she we you i or but".split()
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred"
).split()
DIGIT_WORDS = "zero oh one two three four five six seven eight nine".split()
ID_CUES = ["social", "passport", "card number", "student number", "your number", "id number", "identity number", "insurance number", "licence number", "license number"]
PHONE_CUES = ["cell", "phone", "call", "reach", "mobile", "dial", "telephone", "ring", "contact"]
NOT_PERSONAL = "file sheet lists job grant page trial slide catalogue catalog entry version revision section block ratio lane room chapter count".split()
PLACE_AFTER = "hall room campus street court library college university road building".split()
EFFECT_AFTER = "effect task theorem test scale paradigm reader study bridge reading equation".split()
TOP_LEVEL = "com org net edu gov info io co uk us de fr es eu ca example test invalid".split()
#: Before a name: those that tell one capitalised word as a name, and those that need two.
NAME_CUES = ["name is", "name's", "named", "thanks", "thank you", "hi", "hello", "dear", "question from", "signed", "ask", "tell"]
PAIR_CUES = ["i'm", "i’m", "i am", "this is", "meet", "from", "by", "with", "reach", "contact", "email", "welcome", "and", "is how", "does", "would", "that"]
#: After a name of two words or more.
SAID = "asked asks said says told tells wrote writes replied answered argued argues thinks thought chose speaking".split()
PARTICLES = "de da di du del della der den van von la le bin ibn al el".split()
#: Capitalised words that are no names of persons.
NOT_NAMES = """
a about above after again all alone also although always am america american an and another any april are around arabic as asian ask at august autumn be because
been before below british but by bye call can canada canadian canvas chapter china chinese christmas could course data day dear december did do does
during each easter either email english europe european even ever every everybody everyone february figure first folks for france french friday friends from
german germany given god good google great greek guys had happy has have he hello her here hers hi his how however i if in india indian instead
internet is it its italian january japan japanese july june just last latin lecture let like london look many march may maybe me meet might monday
more most mr mrs much must my name new next no nobody nor north not nothing notice november now october of oh okay ok on once one online only or
other our out over part paris perhaps please python reach remember right russian saturday second section see september she should similarly since so
some somebody someone something south spanish spring still such summer sunday sure team tell than thank thanks that the their them then there therefore these they
thing third this those though through thursday to today tomorrow too tuesday two under university unit until up us very wait was we wednesday week
welcome well were what whatever when where whether which while who whose why will winter with without would yeah yes yesterday yet york you your
zoom table theorem theory law equation model method lab library institute college school department street hall room building study effect task project city state states
""".split()
#: Most tokens of a name behind its first; scores from which a word the tagger doesn't know is a name, and may be one beside a name.
NAME_PARTS, NAMED_NEW, MAY_NAME = 5, -2.0, -3.5
#: Words of sound notes.
SOUNDS = """
air alarm applause applauding audience audio background baby bangs banging bark barking barks beep beeping beeps bell bells blank breath
breathes breathing breaths buzz buzzes buzzing chair chairs chatter cheering cheers chime chimes chuckle chuckles chuckling clap clapping claps clears
clearing click clicking clicks clink clinking closes closing conversation cough coughing coughs creaks crosstalk crowd cry crying cuts cutting dings dog
door doors drop drops dropping drumming echo end exhales feedback footsteps foreign gasp gasps giggle giggles giggling groan groans growls heavy hiss
horn hum humming hums inaudible indiscernible indistinct inhales keyboard keys knock knocking knocks language laugh laughing laughs laughter lip lips lipsmack loud
microphone mic mobile moans mouse mumble mumbles mumbling murmur murmurs muffled music musical no noise noises opening opens overlapping overlap page pages
paper papers pause pen phone playing plays quiet rattle rattling recording ring ringing rings rustle rustles rustling scoffs scrape scrapes scraping
scream screaming screams scratching shuffling shuffles sigh sighing sighs silence silent singing siren slam slamming slams smack smacking smacks snap snaps
sneeze sneezes sneezing sniff sniffing sniffles sniffs snore snoring snort snorts soft softly sound sounds speech speaking squeak squeaks start static steps stops
tapping taps thud throat throatclearing tongue traffic turning typing unclear unintelligible vibrates vibrating video voice voices water whisper whispering whispers
whistle whistles whistling wind writing yawn yawning yawns
""".split()
# ----------------------------------------------------------------------------------

_GIVEN, _TITLES, _STREETS, _UNITS, _DIGITS = set(GIVEN), set(TITLES), set(STREETS), set(UNITS), set(DIGIT_WORDS)
_NUMBERS, _STOP, _NOT_PERSONAL, _TLD = set(NUMBER_WORDS), set(NOT_IN_STREET), set(NOT_PERSONAL), set(TOP_LEVEL)
_NOT_NAMES = {*NOT_NAMES, *NAME_CUES, *PAIR_CUES, *SAID, *STREETS, *UNITS, *PLACE_AFTER, *EFFECT_AFTER, *NUMBER_WORDS, *TITLES, *NOT_PERSONAL}
_PARTICLES, _STRONG = set(PARTICLES), set(NAME_CUES)
_PLACE, _EFFECT = set(PLACE_AFTER), set(EFFECT_AFTER)
_NOT_LOCAL = set("me it us them him her you look is was are were be site page online hosted available arrive here there and or to by we i stay meet".split())

_EDGE = re.compile(r"^[^\w+@#(]+|[^\w)]+$")
_OWNED = re.compile(r"['’]s?$", re.I)
_SINGLE = re.compile(r"[\[(<][A-Za-z0-9][\])>][.,]?")
_EMAIL = re.compile(r"[\w.+%-]*\w@(?:[\w-]+\.)+[A-Za-z]{2,}")
_LOCAL = re.compile(r"\w(?:[\w.+%-]*\w)?")
_DOMAIN = re.compile(r"(?:[\w-]+\.)+([A-Za-z]{2,})")
_HOUSE = re.compile(r"\d{1,5}[A-Za-z]?")
_UNIT_NO = re.compile(r"#?\d{1,5}[A-Za-z]?|[A-Za-z]")
_PHONES = [
    re.compile(p)
    for p in (
        r"\+1[-. ]\(?[2-9]\d\d\)?[-. ]\d{3}[-. ]\d{4}",
        r"\+44 7\d{3} \d{6}",
        r"\+\d{1,3}(?:[-. ]\d{2,6}){2,4}",
        r"(?:1[-. ])?\([2-9]\d\d\) ?\d{3}[-. ]\d{4}",
        r"(?:1[-. ])?[2-9]\d\d([-. ])\d{3}\1\d{4}",
        r"[2-9]\d{9}",
        r"[2-9]\d\d-\d{4}",
    )
]
_IDS = [re.compile(p) for p in (r"\d{3}-\d{2}-\d{4}", r"\d{3} \d{2} \d{4}", r"[A-Za-z]\d{6,9}", r"\d{4} \d{4}", r"\d{9}")]
_DASHED_ID = re.compile(r"\d{3}-\d{2}-\d{4}")
_INITIAL = re.compile(r"[A-Z]\.")
_OPENS, _CLOSES = "[(<{*", "])>}*"
_SOUND = re.compile("(?:" + "|".join(SOUNDS) + r"|u+h+m*|u+m+|h+m+|m+h*m+|e+r+m*|e+h+m*|a+h+|o+h+|m+hm+)")
_CLOCK = re.compile(r"\d{1,3}(?::\d\d){1,2}(?:[.,]\d{1,3})?|\d{1,5}[.,]\d{1,3}s?|t:\d+(?:[.:,]\d+)*")
_TAG = re.compile(r"(?:>>\s*)?(?:speaker|spk)[ _]?\d+")
_WORDY = re.compile(r"[^\W_]")
#: Words that begin like a hesitation: a recogniser that took one for a word may have put them anywhere.
_SLIP = re.compile(r"(?:h?um|er|ah)[a-z]{1,6}")


_FORMS: dict[str, tuple[str, str, str, bool, bool]] = {}


def _form(t: str) -> tuple[str, str, str, bool, bool]:
    """A token bare of edge signs, that in lower case, that without possessive ending; whether parsers see it; whether it may repeat."""
    if len(_FORMS) > 200_000:
        _FORMS.clear()
    bare = _EDGE.sub("", t)
    low = bare.lower()
    seen = bool(t) and not _SINGLE.fullmatch(t) and not t.endswith("-") and not (_SLIP.fullmatch(bare) and low not in _GIVEN)
    _FORMS[t] = out = (bare, low, _OWNED.sub("", low), seen, low in _DIGITS or any(c.isdigit() for c in t))
    return out


def _known(inner: str) -> bool:
    """Whether a text bare of its brackets is a sound note, time mark, speaker tag or hesitation, or has no letter or digit."""
    low = inner.lower().strip(" .,;:!?…-–")
    if not _WORDY.search(low) or _TAG.fullmatch(low):
        return True
    return all(_SOUND.fullmatch(w.strip(".,;:!?…")) or _CLOCK.fullmatch(w) or not _WORDY.search(w) for w in re.split(r"[\s_-]+", low))


_ODD: dict[str, bool] = {}


def _odd(t: str) -> bool:
    """Whether a token holds words that may be hidden: in brackets or not, and no known note."""
    if len(_ODD) > 200_000:
        _ODD.clear()
    inner = t.rstrip(".,;:!?")
    whole = inner[:1] in _OPENS and inner[-1:] in _CLOSES
    inner = inner.strip(_OPENS + _CLOSES)
    _ODD[t] = out = not (_known(inner) or (whole and inner.isdigit() and len(inner) <= 6) or _SINGLE.fullmatch(t))
    return out


def _unwrapped(t: str, first: bool, last: bool) -> tuple[int, int]:
    """Where a token's words begin and end without the brackets that open before and close after it; (305) stays."""
    a, b = 0, len(t.rstrip(".,;:!?"))
    if first and t[:1] in _OPENS and not re.match(r"\(\d{3}\)", t):
        a = 1
    if last and b > a and t[b - 1] in _CLOSES and not re.fullmatch(r".*\(\d{3}\)", t[a:b]):
        return a, b - 1
    return a, len(t)


def _opened(values: list[str], odd: list[bool], tags: list[int]) -> list[tuple[int, int, int]] | None:
    """The tokens of a sequence with those of unknown brackets split into their words: (place, begin, end); None if there are none.

    values: the sequence's tokens; a token tagged as no speech that is no known note
    opens too.
    """
    opens = [v[:1] in _OPENS for v in values]
    closes = [v.rstrip(".,;:!?")[-1:] in _CLOSES and bool(v) for v in values]
    # The bracket that is open at each token, and where it closes; whole brackets between end both.
    left: list[int | None] = [None] * len(values)
    right: list[int | None] = [None] * len(values)
    for side, order, begin, end in ((left, range(len(values)), opens, closes), (right, range(len(values) - 1, -1, -1), closes, opens)):
        held = None
        for r in order:
            side[r] = r if begin[r] else held
            held = None if end[r] else r if begin[r] else held
    shown: dict[int, tuple[bool, bool]] = {}
    known: set[int] = set()
    for r, o in enumerate(odd):
        if not o or r in shown or r in known:
            continue
        a, b = left[r], right[r]
        if a is None or b is None:
            shown[r] = (True, True)
        elif not _known(" ".join(values[a : b + 1]).rstrip(".,;:!?").strip(_OPENS + _CLOSES)):
            shown |= {k: (k == a, k == b) for k in range(a, b + 1)}
        else:
            known.update(range(a, b + 1))
    if not shown:
        return None
    out: list[tuple[int, int, int]] = []
    for r, t in enumerate(values):
        if r in shown:
            a, b = _unwrapped(t, *shown[r])
            out += [(r, a + m.start(), a + m.end()) for m in re.finditer(r"\S+", t[a:b])]
        elif tags[r] in (SPEECH, SPEAKER):
            out.append((r, 0, len(t)))
    return out


class _Tokens:
    """The tokens parsers see: text, core in lower case, and each one's place in the source."""

    def __init__(self, texts: list[str], places: list[int]):
        self.text, self.place = texts, places
        forms = [_FORMS.get(t) or _form(t) for t in texts]
        self.bare = [f[0] for f in forms]
        self.low = [f[1] for f in forms]
        self.word = [f[2] for f in forms]
        self.named: list[bool] = []
        self.may_name: list[bool] = []
        self.surely: list[bool] = []

    def __len__(self) -> int:
        return len(self.text)

    def stops(self, j: int) -> bool:
        """Punctuation ends the token."""
        return self.text[j][-1:] in ".,;:!?"


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    a = ahocorasick.Automaton()
    kinds: dict[str, set[str]] = {}
    for patterns, kind in (
        (["@"], "sign"), ([" at ", " (at) ", " [at] "], "at"), ([f" {d}" for d in "0123456789+("], "number"),
        ([f" {s}" for s in STREETS], "street"), ([f" {s}" for s in ID_CUES], "id"), ([f" {s}" for s in PHONE_CUES], "phone"),
        ([f" {s}" for s in [*TITLES, *GIVEN]], "name"),
        ([f" {s}" for s in [*NAME_CUES, *PAIR_CUES]], "cue"), ([f" {s}" for s in SAID], "said"),
    ):
        for p in patterns:
            kinds.setdefault(p, set()).add(kind)
    for p, k in kinds.items():
        a.add_word(p, (len(p), tuple(sorted(k)), p))
    a.make_automaton()
    return a


def _joined(x: _Tokens, j: int, many: int) -> tuple[str, list[int]]:
    """Up to `many` bare tokens from j on joined by spaces, and where each ends in that string."""
    parts, ends, n = [], [], 0
    for k in range(j, min(j + many, len(x))):
        parts.append(x.bare[k])
        n += len(x.bare[k]) + (k > j)
        ends.append(n)
        if x.text[k][-1:] in ",;:!?" or (x.text[k][-1:] == "." and k > j):
            break
    return " ".join(parts), ends


def _email(x: _Tokens, j: int) -> tuple[int, int] | None:
    """An address around token j, which holds an at-sign or is a spoken "at"."""
    t = x.bare[j]
    if "@" in t and len(t) > 1:
        if _EMAIL.search(t):
            return j, j
        if t.endswith("@") and j + 1 < len(x) and _DOMAIN.fullmatch(x.bare[j + 1]) and _LOCAL.fullmatch(t[:-1]):
            return j, j + 1
        if t.startswith("@") and j and _DOMAIN.fullmatch(t[1:]) and _LOCAL.fullmatch(x.bare[j - 1]):
            return j - 1, j
        return None
    if not 0 < j < len(x) - 1:
        return None
    sign = t == "@"
    left, right = x.bare[j - 1], x.bare[j + 1]
    if not _LOCAL.fullmatch(left) or x.stops(j - 1):
        return None
    # The local part, spelled with "dot" between its words.
    a = j - 1
    while a >= 2 and j - a < 2 * SPELLED_PARTS and x.low[a - 1] in ("dot", "dash", "underscore", "plus") and _LOCAL.fullmatch(x.bare[a - 2]) and not x.stops(a - 2):
        a -= 2
    m = _DOMAIN.fullmatch(right)
    if m:
        known = sign or m.group(1).lower() in _TLD
        return (a, j + 1) if known and (sign or x.word[j - 1] not in _NOT_LOCAL) else None
    b, ends = j + 1, False
    while b + 2 < len(x) and b - j < 2 * SPELLED_PARTS and x.low[b + 1] == "dot" and re.fullmatch(r"[\w-]+", x.bare[b + 2]) and not x.stops(b):
        b += 2
        ends = x.low[b] in _TLD
        if ends and (x.stops(b) or b + 1 >= len(x) or x.low[b + 1] != "dot"):
            break
    if not ends or (x.word[j - 1] in _NOT_LOCAL and a == j - 1):
        return None
    return a, b


def _phone(x: _Tokens, j: int) -> tuple[int, int] | None:
    """A written number whose first token is j."""
    if j and x.word[j - 1] in _NOT_PERSONAL or any(x.word[k] in ("job", "grant") for k in range(max(0, j - 2), j)):
        return None
    s, ends = _joined(x, j, 5)
    for p in _PHONES:
        m = p.match(s)
        if m and m.end() in ends:
            return j, j + ends.index(m.end())
    return None


def _spoken_digits(x: _Tokens, j: int, least: int, ahead: int = CUE_AHEAD) -> tuple[int, int] | None:
    """A run of digit words that starts within `ahead` tokens after j and is `least` long or longer."""
    k = j + 1
    while k < min(len(x), j + 1 + ahead):
        if x.word[k] in _DIGITS:
            b = k
            while b + 1 < len(x) and b - k < MOST_DIGITS and x.word[b + 1] in _DIGITS and not x.stops(b):
                b += 1
            if b - k + 1 >= least:
                return (k, b) if b - k + 1 <= MOST_DIGITS else None
            k = b
        k += 1
    return None


def _idno(x: _Tokens, j: int, ahead: int = CUE_AHEAD) -> tuple[int, int] | None:
    """An identity number after the cue at j."""
    for k in range(j + 1, min(len(x), j + 1 + ahead)):
        if x.word[k] in _NOT_PERSONAL:
            return None
        if not any(c.isdigit() for c in x.bare[k]):
            continue
        s, ends = _joined(x, k, 3)
        for p in _IDS:
            m = p.match(s)
            if m and m.end() in ends:
                return k, k + ends.index(m.end())
    return _spoken_digits(x, j, 7, ahead)


def _address(x: _Tokens, j: int) -> tuple[int, int] | None:
    """House number, one to three words, the street type at j, and a unit that follows."""
    if x.low[j] not in _STREETS:
        return None
    k = j - 1
    while k >= 0 and j - k <= 3 and x.bare[k].isalpha() and not x.stops(k) and x.low[k] not in _STOP and x.low[k] not in _NUMBERS:
        k -= 1
    if k < 0 or k == j - 1 or x.stops(k):
        return None
    if _HOUSE.fullmatch(x.bare[k]):
        a = k
        if a and x.word[a - 1] in _NOT_PERSONAL:
            return None
    elif x.low[k] in _NUMBERS:
        a = k
        while a and x.low[a - 1] in _NUMBERS and not x.stops(a - 1) and k - a < 3:
            a -= 1
    else:
        return None
    b = j
    if x.text[j][-1:] not in ";:!?" and j + 2 < len(x) + 0 and x.low[j + 1].rstrip(".") in _UNITS and _UNIT_NO.fullmatch(x.bare[j + 2]):
        b = j + 2
    return a, b


def _name_like(x: _Tokens, k: int, capitals: bool = False) -> bool:
    """Whether token k has the form of a name: capitalised (or in capitals), of letters, and no word that is none."""
    t = x.bare[k]
    return t[:1].isupper() and len(t) > 1 and t.isupper() == capitals and t.replace("'", "").replace("’", "").replace("-", "").isalpha() and x.word[k] not in _NOT_NAMES


def _name_run(x: _Tokens, k: int) -> int:
    """The last token of a name that starts at k by its form: capitalised words, initials, and particles between them."""
    b, at, capitals = k, k, x.bare[k].isupper() and len(x.bare[k]) > 2
    while b - k < 4 and at + 1 < len(x) and not _OWNED.search(x.low[b]) and (not x.stops(b) or _INITIAL.fullmatch(x.text[b])):
        at = b + 1
        while at + 1 < len(x) and at - b < 3 and x.text[at] in _PARTICLES:
            at += 1
        if not (_name_like(x, at, capitals) or _INITIAL.fullmatch(x.text[at])):
            break
        b = at
    return b


def _nothing_else(x: _Tokens, a: int, b: int) -> bool:
    """No place, effect or street that is named after the person."""
    return x.stops(b) or _OWNED.search(x.low[b]) is not None or b + 1 >= len(x) or x.low[b + 1] not in _PLACE | _EFFECT | _STREETS or (x.low[b + 1] in _EFFECT and not (a and x.low[a - 1] in ("the", "a", "an", "this", "that")) and x.bare[b + 1].islower())


def _cued_name(x: _Tokens, j: int, strong: bool) -> tuple[int, int] | None:
    """A name outside the lists behind the cue that ends at j: capitalised words, two at least if the cue is weak."""
    k = j + 1
    if k >= len(x) or x.text[j][-1:] in ".;:!?" or (not strong and x.stops(j)) or not (_name_like(x, k) or (strong and _name_like(x, k, True)) or _INITIAL.fullmatch(x.text[k])):
        return None
    b = _name_run(x, k)
    if b == k and x.text[k].endswith(",") and k + 1 < len(x) and _name_like(x, k + 1) and _name_like(x, k) and x.word[j] in ("ask", "tell", "thanks", "meet", "reach", "from", "by", "contact"):
        return k, k + 1  # family, given
    if b == k and x.bare[k].isupper():
        return None
    if _INITIAL.fullmatch(x.text[b]) or (b == k and not strong) or not _nothing_else(x, k, b):
        return None
    return k, b


def _said_name(x: _Tokens, j: int) -> tuple[int, int] | None:
    """A name of two words or more outside the lists before a verb of saying at j."""
    a = j
    while a and j - a < 4 and (_name_like(x, a - 1) or _INITIAL.fullmatch(x.text[a - 1])) and (not x.stops(a - 1) or _INITIAL.fullmatch(x.text[a - 1])):
        a -= 1
    return (a, j - 1) if j - a >= 2 and not _INITIAL.fullmatch(x.text[j - 1]) else None


def _name(x: _Tokens, j: int) -> tuple[int, int] | None:
    """A person's name behind the title at j, or that starts with the given name at j: initials and further names as far as present."""
    title = x.low[j].rstrip(".") in _TITLES
    a = j + 1 if title else j
    if a >= len(x):
        return None
    given = x.word[a] in _GIVEN
    ends = lambda k: x.stops(k) or _OWNED.search(x.low[k])
    b = a
    if given or _INITIAL.fullmatch(x.text[a]):
        k = a
        while k + 1 < len(x) and _INITIAL.fullmatch(x.text[k + 1]) and (k > a or not ends(a) or not given):
            k += 1
        if k == a and not given:
            return None
        if not _INITIAL.fullmatch(x.text[k]):
            b = _name_run(x, a)
            b = a if _INITIAL.fullmatch(x.text[b]) else b
        elif k + 1 < len(x) and _name_like(x, k + 1):
            b = _name_run(x, k + 1)
    elif title and not x.text[j].endswith((",", "?", "!")) and x.bare[a][:1].isupper() and x.bare[a].isalpha() and len(x.bare[a]) > 2:
        b = _name_run(x, a)
        b = a if _INITIAL.fullmatch(x.text[b]) else b
    else:
        return None
    if not title and not ends(b) and b + 1 < len(x):
        after = x.low[b + 1]
        if after in _PLACE or (after in _EFFECT and j and x.low[j - 1] in ("the", "a", "an", "this", "that")):
            return None
    return a, b


def _tagged_name(x: _Tokens, j: int) -> tuple[int, int] | None:
    """The name around token j, which its form and context tell: tokens that may be names up to one that ends a phrase, or family, given."""
    like = lambda k: x.may_name[k] and x.bare[k][:1].islower() == x.bare[j][:1].islower()
    goes_on = lambda k: not _OWNED.search(x.low[k]) and (not x.stops(k) or _INITIAL.fullmatch(x.text[k]))
    a = b = j
    while a and j - a < NAME_PARTS and like(a - 1) and goes_on(a - 1):
        a -= 1
    while a < j and x.low[a].rstrip(".") in _TITLES:
        a += 1
    while b + 1 < len(x) and b - a < NAME_PARTS and like(b + 1) and goes_on(b):
        b += 1
    if b == a and x.text[a].endswith(",") and a + 1 < len(x) and x.word[a] not in _GIVEN:
        listed = a and x.may_name[a - 1] and x.text[a - 1].endswith(",")
        alone = a + 2 >= len(x) or not (x.may_name[a + 2] or x.text[a + 1].endswith(",") and x.named[a + 2])
        if x.word[a + 1] in _GIVEN or (x.named[a + 1] and alone and not listed):
            b = a + 1
    if any(x.word[k] in _NOT_NAMES for k in range(a, b + 1)) or (a == b and x.bare[a].islower() and not x.surely[a]):
        return None
    if _INITIAL.fullmatch(x.text[b]) or not x.bare[a][:1].isalpha() or not x.bare[b][-1:].isalpha() or not _nothing_else(x, a, b):
        return None
    return a, b


def _apart(spans: list[tuple]) -> list[tuple]:
    """Of spans ((begin, end, ...), best first) those that overlap none before them, in order."""
    begins, kept = [], []
    for m in spans:
        k = bisect_right(begins, m[0])
        if (not k or kept[k - 1][1] < m[0]) and (k == len(kept) or m[1] < kept[k][0]):
            begins.insert(k, m[0])
            kept.insert(k, m)
    return kept


def mentions(texts: list[str], places: list[int]) -> list[tuple[str, int, int]]:
    """(kind, first place, last place) of every mention in the spoken tokens `texts`, larger ones winning."""
    if not texts:
        return []
    x = _Tokens(texts, places)
    score, new = tagger().scores(texts)
    x.surely = (score > 0).tolist()
    x.named, x.may_name = (score > np.where(new, NAMED_NEW, 0)).tolist(), ((score > 0) | (new & (score > MAY_NAME))).tolist()
    lowered = [" " + t.lower() for t in texts]
    at = np.cumsum([0] + [len(t) for t in lowered]).tolist()
    found: set[tuple[int, int, str]] = set()
    seen: set[tuple[int, str]] = set()
    for end, (size, kinds, pattern) in _anchors().iter("".join(lowered) + " "):
        begin = end - size + 1
        j = bisect_right(at, begin) - 1
        last = bisect_right(at, min(end, at[-1] - 1)) - 1 if size > 1 else j
        for kind in kinds:
            if (j, kind) in seen:
                continue
            # A pattern may be but the head of the token, as "mr" is of "mrs": the place is done only when the whole token was meant.
            if kind in ("name", "cue", "said", "phone", "id") and pattern.split()[-1] not in (x.word[last if kind in ("cue", "id") else j].rstrip("."), x.low[last]):
                continue
            if kind != "cue":
                seen.add((j, kind))
            span = None
            if kind in ("sign", "at"):
                span, what = _email(x, j), "email"
            elif kind == "number":
                span, what = _phone(x, j), "phone"
                if not span and _DASHED_ID.fullmatch(x.bare[j]) and not any(x.word[k] in _NOT_PERSONAL for k in range(max(0, j - 3), j)):
                    span, what = (j, j), "idno"
            elif kind == "street":
                span, what = _address(x, j), "address"
            elif kind == "id":
                span, what = _idno(x, last), "idno"
            elif kind == "phone":
                span, what = _spoken_digits(x, j, 7), "phone"
            elif kind == "name":
                start = j
                while start and _INITIAL.fullmatch(x.text[start - 1]) and x.named[j]:
                    start -= 1
                span, what = _name(x, start), "name"
            elif kind == "cue":
                span, what = _cued_name(x, last, pattern.strip() in _STRONG), "name"
            elif kind == "said":
                span, what = _said_name(x, j), "name"
            if span:
                found.add((*span, what))
    for j in range(len(x)):
        goes_on = j and x.named[j - 1] and not x.stops(j - 1) and x.bare[j][:1].islower() == x.bare[j - 1][:1].islower()
        if x.named[j] and not goes_on and (span := _tagged_name(x, j)):
            found.add((*span, "name"))
    # What stands inside a larger mention, or overlaps a longer one, isn't counted again.
    return [(what, x.place[a], x.place[b]) for a, b, what in _apart(sorted(found, key=lambda s: (s[0] - s[1], s[0], s[2])))]


def _traits(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct token: whether parsers may see it, and whether it may repeat."""
    forms = [_FORMS.get(v) or _form(v) for v in values]
    return np.array([f[3] for f in forms], bool), np.array([f[4] for f in forms], bool)


def _visible(traits: tuple[np.ndarray, np.ndarray], ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which tokens the parsers see: spoken, whole, and the last of repeats."""
    plain, may_repeat = traits
    rows = np.flatnonzero(((tags == SPEECH) & plain[ids]) | (tags == SPEAKER))
    keep = np.ones(len(rows), bool)
    if len(rows) > 1:
        keep[:-1] = (ids[rows[:-1]] != ids[rows[1:]]) | may_repeat[ids[rows[:-1]]]
    return rows[keep]


def _hidden(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct token: whether it holds words of no known note, and whether it does so in brackets."""
    odd = np.array([_ODD[v] if v in _ODD else _odd(v) for v in values], bool)
    return odd, odd & np.array([v[:1] in _OPENS or v.rstrip(".,;:!?")[-1:] in _CLOSES or " " in v for v in values], bool)


def _found(values: list[str], ids: np.ndarray, tags: np.ndarray, rows: list[int], hidden: tuple[np.ndarray, np.ndarray]) -> list[tuple[str, int, int, int, int]]:
    """A sequence's mentions: (kind, first token, where it begins in that, last token, where it ends in that).

    rows: the tokens parsers see with all brackets looked through. Unknown brackets are
    then read as words too; of mentions that overlap the larger wins.
    """
    out = [(what, p, 0, q, len(values[ids[q]])) for what, p, q in mentions([values[ids[r]] if tags[r] == SPEECH else "|" for r in rows], rows)]
    odd, wrapped = hidden
    asked = odd[ids] & ((tags != SPEECH) | wrapped[ids])
    if not asked.any():
        return out
    own = [values[k] for k in ids.tolist()]
    parts = _opened(own, asked.tolist(), tags.tolist())
    if parts is None:
        return out
    texts, places = [], []
    for part in parts:
        r, a, b = part
        t = "|" if tags[r] == SPEAKER and not odd[ids[r]] else own[r][a:b]
        form = _FORMS.get(t) or _form(t)
        if not form[3]:
            continue
        if texts and t == texts[-1] and not form[4]:
            places[-1] = part
            continue
        texts.append(t)
        places.append(part)
    for what, p, q in mentions(texts, list(range(len(texts)))):
        out.append((what, places[p][0], places[p][1], places[q][0], places[q][2]))
    best = sorted(set(out), key=lambda m: (m[1] - m[3], m[1], m[2] - m[4], m[2], m[0]))
    return [m[2] for m in _apart([((m[1], m[2]), (m[3], m[4] - 1), m) for m in best])]


def _in_words(table: pa.Table, halo: int) -> pa.Table:
    """Mentions of whole blocks, and a row without kind for each block whose halo shows too little."""
    hashes = [f"{OWN}h1", f"{OWN}h2"]
    i = table[f"{OWN}i"].to_numpy()
    group = starts(table, hashes)
    fresh = group.copy()
    fresh[1:] |= i[1:] != i[:-1]
    if not fresh.all():
        table = table.filter(pa.array(fresh))
        i, group = i[fresh], group[fresh]
    coded = table[f"{OWN}text"].combine_chunks().dictionary_encode()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    values = [v or "" for v in coded.dictionary.to_pylist()] + [""]
    ids = coded.indices.fill_null(len(values) - 1).to_numpy()
    first = np.flatnonzero(group)
    tags = viterbi(emissions(values)[ids], first, _model()[1])
    rows = _visible(_traits(values), ids, tags)
    core = table[f"{OWN}core"].to_numpy(zero_copy_only=False).astype(bool)
    cuts = np.searchsorted(rows, np.r_[first, len(ids)]).tolist()
    at, kinds, lo, hi = [], [], [], []
    rows, bounds, hidden = rows.tolist(), [*first.tolist(), len(ids)], _hidden(values)
    block = table[f"{OWN}block"].to_numpy()
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        here = rows[a:b]
        lo_row, hi_row = bounds[n], bounds[n + 1]
        own = np.flatnonzero(core[lo_row:hi_row])
        if not len(own):
            continue
        # A side of the halo that was used up by tokens nobody sees is too short; one that the stream ends in is not.
        before, after = int(i[lo_row + own[0]] - i[lo_row]), int(i[hi_row - 1] - i[lo_row + own[-1]])
        seen_before, seen_after = bisect_left(here, lo_row + int(own[0])), len(here) - bisect_right(here, lo_row + int(own[-1]))
        if (seen_before < REACH and before > halo - REACH) or (seen_after < REACH and after > halo - REACH):
            at.append(lo_row + int(own[0]))
            kinds.append(None)
            lo.append(0)
            hi.append(0)
        for what, p, _, q, _ in _found(values, ids[lo_row:hi_row], tags[lo_row:hi_row], [r - lo_row for r in here], hidden):
            p, q = p + lo_row, q + lo_row
            if core[p]:
                at.append(p)
                kinds.append(what)
                lo.append(int(i[p]))
                hi.append(int(i[q]))
    k = table[f"{OWN}k"].take(pa.array(at, pa.int64())).combine_chunks()
    return pa.table({"k": k, "block": pa.array(block[at], pa.int64()), "kind": pa.array(kinds, pa.string()), "first_pos": pa.array(lo, pa.int64()), "last_pos": pa.array(hi, pa.int64())})


def in_words(words: DataFrame, key: str = "rec_id", order: str = "i", text: str = "text", block: int = BLOCK_WORDS) -> DataFrame:
    """Mentions of personal data in a word stream: (key, kind, first_pos, last_pos), positions of `order`.

    Rows with a null key or order are left out; repeats of (key, order) count once;
    null and empty texts are skipped. Other columns are not read. Empty tables give
    none. Streams are cut into blocks that see HALO tokens of their neighbours, so
    a hot stream is spread over tasks; a mention belongs to the block of its first
    token. Blocks that see fewer than REACH tokens of a neighbour's words beside notes,
    hesitations and repeats are read again with a halo four times as wide, until none
    is left: results don't depend on where blocks end.
    """
    require_columns(words, [key, order, text], "in_words")
    rows = words.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(F.col(key).cast("string").alias(f"{OWN}k"), F.col(order).cast("long").alias(f"{OWN}i"), F.col(text).alias(f"{OWN}text"))
    got = write_and_read(_blocks(rows, block, HALO, None), "mentions")
    again = got.where("kind is null").select("k", "block")
    halo, parts = HALO, []
    while not again.isEmpty():
        halo *= 4
        wider = write_and_read(_blocks(rows, block, halo, again), "mentions")
        parts.append(got.join(again, ["k", "block"], "left_anti"))
        got, again = wider, wider.where("kind is null").select("k", "block")
    out = reduce(DataFrame.unionByName, [*parts, got])
    return out.select(F.col("k").alias(key), "kind", "first_pos", "last_pos")


def _blocks(rows: DataFrame, block: int, halo: int, only: DataFrame | None) -> DataFrame:
    """(k, block, kind, first_pos, last_pos) of the blocks of all streams, or of those named in `only` (k, block)."""
    pos = F.col(f"{OWN}i")
    rows = rows.withColumn(f"{OWN}block", F.explode(F.sequence(block_of(pos - halo, block), block_of(pos + halo, block))))
    if only is not None:
        rows = rows.join(only.select(F.col("k").alias(f"{OWN}k"), F.col("block").alias(f"{OWN}block")), [f"{OWN}k", f"{OWN}block"], "left_semi")
    hashes = [f"{OWN}h1", f"{OWN}h2"]
    rows = rows.select(
        F.xxhash64(f"{OWN}k", f"{OWN}block").alias(hashes[0]), F.hash(f"{OWN}k", f"{OWN}block").alias(hashes[1]), f"{OWN}k", f"{OWN}block", f"{OWN}i", f"{OWN}text",
        (block_of(pos, block) == F.col(f"{OWN}block")).alias(f"{OWN}core"),
    )
    rows = rows.repartition(*hashes).sortWithinPartitions(*hashes, f"{OWN}i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, hashes, CHUNK_ROWS):
            yield from _in_words(table, halo).to_batches()

    return rows.mapInArrow(run, "k string, block long, kind string, first_pos long, last_pos long")


def redacted_words(words: DataFrame, key: str = "rec_id", order: str = "i", text: str = "text") -> DataFrame:
    """(key, order, text): the word stream with a typed placeholder for each mention.

    The placeholder stands at the mention's first token, the others become empty; signs behind
    the last letter or digit, and a possessive ending, are kept. Every row of `words` comes out; those with a
    null key or order unchanged. Null texts stay null.
    """
    found = in_words(words, key, order, text)
    at = found.select(F.col(key).alias(f"{OWN}k"), "kind", "first_pos", "last_pos", F.explode(F.sequence("first_pos", "last_pos")).alias(f"{OWN}i"))
    at = at.groupBy(f"{OWN}k", f"{OWN}i").agg(F.min("kind").alias("kind"), F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"))
    x = words.select(F.col(key), F.col(order), F.col(text)).join(at, (F.col(key).cast("string") == F.col(f"{OWN}k")) & (F.col(order).cast("long") == F.col(f"{OWN}i")), "left")
    tail = F.regexp_extract(F.col(text), r"((?:['\u2019]s?)?[^\p{L}\p{N}]*)$", 1)
    head = F.when(F.col(f"{OWN}i") == F.col("first_pos"), F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).otherwise("")
    told = F.concat(head, F.when(F.col(f"{OWN}i") == F.col("last_pos"), tail).otherwise(""))
    return x.select(key, order, F.when(F.col("kind").isNull() | F.col(text).isNull(), F.col(text)).otherwise(told).alias(text))


_PIECE = re.compile(r"[\[(<*][^\[\](<>)*\n]+[\])>*]:?|>>\s?\w+ \d+:|\S+")


def in_many(texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
    """For each text (kind, first, last) of its mentions; 0-based places of their first and last letter or digit."""
    distinct: dict[str, int] = {}
    ids: list[int] = []
    place: list[int] = []
    cuts = [0]
    for t in texts:
        for m in _PIECE.finditer(t or ""):
            ids.append(distinct.setdefault(m.group(), len(distinct)))
            place.append(m.start())
        cuts.append(len(ids))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not ids:
        return out
    values, coded = list(distinct), np.array(ids)
    tags = tag_blocks(emissions(values)[coded], np.array(cuts))
    traits, hidden = _traits(values), _hidden(values)
    for n, text in enumerate(texts):
        lo, hi = cuts[n], cuts[n + 1]
        if lo == hi:
            continue
        rows = _visible(traits, coded[lo:hi], tags[lo:hi]).tolist()
        for what, p, begin, q, end in _found(values, coded[lo:hi], tags[lo:hi], rows, hidden):
            a, b = place[lo + p] + begin, place[lo + q] + end - 1
            while not text[a].isalnum():
                a += 1
            while not text[b].isalnum():
                b -= 1
            if what == "name" and text[b] in "sS" and text[b - 1] in "'’":
                b -= 2
            out[n].append((what, a, b))
    return out


def in_text(text: str | None) -> list[tuple[str, int, int]]:
    """The mentions in one text."""
    return in_many([text])[0]


def redacted(text: str | None, found: list[tuple[str, int, int]] | None = None) -> str | None:
    """The text with a typed placeholder, such as [EMAIL], for each mention."""
    if not text:
        return text
    parts, done = [], 0
    for what, a, b in in_text(text) if found is None else found:
        while a > done and (text[a - 1] == "+" or (text[a - 1] == "(" and ")" in text[a : b + 1])):
            a -= 1
        parts += [text[done:a], f"[{what.upper()}]"]
        done = b + 1
    return "".join(parts) + text[done:]


def in_texts(texts: DataFrame, key: str = "rec_id", text: str = "text", redact: bool = False) -> DataFrame:
    """Mentions of personal data in each row's whole text: (key, kind, first_pos, last_pos).

    With redact: (key, text with placeholders), one row for each row of `texts`.
    Null and empty texts hold none and stay as they are; repeated rows each count;
    null keys are kept. Other columns are not read.
    """
    require_columns(texts, [key, text], "in_texts")
    rows = texts.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, got = [], []
            for n, found in enumerate(in_many(batch["t"].to_pylist())):
                for m in found:
                    at.append(n)
                    got.append(m)
            k = batch["k"].take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([k, pa.array([m[0] for m in got], pa.string()), pa.array([m[1] for m in got], pa.int64()), pa.array([m[2] for m in got], pa.int64())], ["k", "kind", "first_pos", "last_pos"])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["t"].to_pylist()
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array([redacted(t, m) for t, m in zip(texts, in_many(texts))], pa.string())], ["k", "t"])

    kind = rows.schema["k"].dataType.simpleString()
    if redact:
        return rows.mapInArrow(replace, f"k {kind}, t string").select(F.col("k").alias(key), F.col("t").alias(text))
    return rows.mapInArrow(find, f"k {kind}, kind string, first_pos long, last_pos long").withColumnRenamed("k", key)
