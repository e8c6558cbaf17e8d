"""Column functions over single tokens: flags, terminals, normal forms. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- fixed values: word lists and patterns whose results must not vary -----------------
FILLED_PAUSES = "uh um uhm hm hmm mm mhm er erm ah eh huh".split()
VOCAL_SOUNDS = [
    "laughter", "laugh", "laughs", "cough", "coughs", "breath", "breathing", "sigh", "sighs", "yawn", "yawns", "yawning", "sniff", "throat",
    "clears throat", "throatclearing", "throat clearing", "throat-clearing", "lipsmack", "lip smack", "lip-smack", "applause", "music",
    "noise", "silence", "inaudible", "unintelligible", "crosstalk",
]
ABBREVIATIONS = "dr mr mrs ms prof sr jr st mt ft vs etc eg ie no inc ltd co dept univ phd md ba bs ma us uk".split()
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
#: Spoken short forms and what they stand for, for comparing restarts.
RESTART_FORMS = {
    "i'm": "i am", "you're": "you are", "we're": "we are", "they're": "they are", "it's": "it is", "that's": "that is", "there's": "there is",
    "he's": "he is", "she's": "she is", "what's": "what is", "who's": "who is", "here's": "here is", "let's": "let us", "i've": "i have",
    "you've": "you have", "we've": "we have", "they've": "they have", "i'll": "i will", "you'll": "you will", "we'll": "we will",
    "they'll": "they will", "it'll": "it will", "i'd": "i would", "you'd": "you would", "we'd": "we would", "they'd": "they would",
    "don't": "do not", "doesn't": "does not", "didn't": "did not", "can't": "can not", "won't": "will not", "wouldn't": "would not",
    "couldn't": "could not", "shouldn't": "should not", "isn't": "is not", "aren't": "are not", "wasn't": "was not", "weren't": "were not",
    "gonna": "going to", "wanna": "want to", "gotta": "got to",
}
#: The same for the fluent view: colloquial forms, then pronouns with 's.
FLUENT_FORMS = {
    "gonna": "going to", "wanna": "want to", "gotta": "got to", "kinda": "kind of", "sorta": "sort of", "lemme": "let me", "dunno": "don't know",
    "'cause": "because", "cause": "because", "y'all": "you all", "'em": "them", "outta": "out of", "lotta": "lot of",
}
PRONOUN_FORMS = {
    "them's": "them is", "there's": "there is", "that's": "that is", "what's": "what is", "he's": "he is", "she's": "she is", "who's": "who is",
    "here's": "here is", "one's": "one is", "where's": "where is", "how's": "how is", "it's": "it is",
}
CLOSERS = "[\"')\\]”’»]+$"
EDGE_SIGNS = "\"'“”‘’.,;:!?)("
PUNCTUATION = "[\"“”‘’.,;:!?()\\[\\]{}…]"
#: The fluent view strips a token's core by this set of single signs, letters of the pattern above included.
CORE_SIGNS = "\"“”‘’.,;:!?()[]{}…\\"
BRACKETED = "^[(\\[<].*[)\\]>]$"
# ----------------------------------------------------------------------------------------


def _map(forms: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in forms.items() for x in kv])


def _class(signs: str) -> str:
    return "[" + "".join("\\" + c if c in "[]\\^-" else c for c in signs) + "]"


def stripped(text: Column, signs: str) -> Column:
    """The text without the given signs at both ends."""
    c = _class(signs)
    return F.regexp_replace(text, f"^{c}+|{c}+$", "")


def flags_of(text: Column) -> Column:
    """The one flag a token's own form tells: silence, filled_pause, vocalization, unknown_marker, partial_word; else none.

    Null and blank tokens have no flag.
    """
    t = F.trim(text)
    body = F.lower(F.trim(F.regexp_extract(t, "^[(\\[<]\\s*(.*?)\\s*[)\\]>]$", 1)))
    partial = stripped(t, EDGE_SIGNS).rlike("(?U)[^\\W\\d_]-$")
    flag = (
        F.when(F.coalesce(t, F.lit("")) == "", F.lit(None))
        .when(t == "_", "silence")
        .when(t.rlike(BRACKETED) & body.isin(FILLED_PAUSES), "filled_pause")
        .when(t.rlike(BRACKETED) & body.isin(VOCAL_SOUNDS), "vocalization")
        .when(t.rlike(BRACKETED), "unknown_marker")
        .when(partial, "partial_word")
    )
    none = F.array().cast("array<string>")
    # Most tokens are plain words; three cheap looks spare them the patterns.
    plain = ~(F.contains(text, F.lit("-")) | t.startswith("[") | t.startswith("(") | t.startswith("<") | (t == "_"))
    return F.when(F.coalesce(plain, F.lit(True)) | flag.isNull(), none).otherwise(F.array(flag))


def is_marker(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")


def without_closers(text: Column) -> Column:
    return F.regexp_replace(text, CLOSERS, "")


def is_terminal(text: Column) -> Column:
    """Whether a token ends a sentence: terminal punctuation, no marker, no abbreviation, no initial."""
    core = without_closers(text)
    stem = F.lower(F.regexp_replace(core, "\\.", ""))
    dotted = core.endswith(".")
    initial = (F.length(stem) == 1) & stem.rlike("^\\p{L}$") & core.rlike("^\\p{Lu}")
    ends = core.rlike("[.?!]$")
    has_stop = F.contains(text, F.lit(".")) | F.contains(text, F.lit("?")) | F.contains(text, F.lit("!"))
    whole = ~is_marker(text) & ends & ~(dotted & (stem.isin(ABBREVIATIONS) | initial))
    return F.coalesce(F.when(has_stop, whole), F.lit(False))


def ends_question(text: Column) -> Column:
    return is_terminal(text) & without_closers(text).endswith("?")


def first_letter_lower(text: Column) -> Column:
    letter = F.regexp_extract(text, "(\\p{L})", 1)
    return (letter != "") & letter.rlike("^\\p{Ll}$")


def cue_token(text: Column) -> Column:
    """Lower case, straight apostrophes, no punctuation at the edges."""
    t = F.translate(F.lower(text), "’‘", "''")
    return F.regexp_replace(t, "(?U)^[^\\w'-]+|[^\\w'-]+$", "")


def restart_form(text: Column) -> Column:
    """Lower case without punctuation; one hyphen is kept at the end of a broken-off word."""
    t = F.regexp_replace(F.lower(F.trim(text)), "’", "'")
    partial = t.endswith("-") & (F.length(t) > 1)
    bare = F.regexp_replace(F.regexp_replace(t, PUNCTUATION, ""), "-+$", "")
    return F.concat(bare, F.when(partial, "-").otherwise(""))


def expanded(text: Column) -> Column:
    """A token's restart form with short forms spelled out and apostrophes dropped."""
    n = restart_form(text)
    return F.regexp_replace(F.coalesce(F.element_at(_map(RESTART_FORMS), n), n), "'", "")


def is_filler(text: Column, flags: Column) -> Column:
    known = F.array_contains(flags, "filled_pause") | F.array_contains(flags, "vocalization")
    return F.coalesce(known, F.lit(False)) | F.coalesce(F.trim(text).rlike(BRACKETED), F.lit(False))


def is_disfluent(text: Column) -> Column:
    """A bracketed marker or a broken-off word."""
    t = F.trim(text)
    return F.coalesce((t != "") & (t.rlike(BRACKETED) | (t.endswith("-") & (F.length(t) > 1))), F.lit(False))


def fluent_pieces(text: Column, pronouns: bool = True) -> Column:
    """A token's pieces in the fluent view, in order; none for disfluent and blank tokens. Repeats aren't collapsed here."""
    t = F.lower(F.trim(text))
    core = stripped(t, CORE_SIGNS)
    t = F.coalesce(F.element_at(_map(FLUENT_FORMS), core), t)
    if pronouns:
        t = F.coalesce(F.element_at(_map(PRONOUN_FORMS), core), t)
    pieces = F.split(F.regexp_replace(t, PUNCTUATION, ""), "(?U)[-–—/\\s]+")
    pieces = F.filter(F.transform(pieces, lambda p: F.regexp_replace(p, "['’]", "")), lambda p: p != "")
    number = lambda p: p.rlike("^\\d+([.,]\\d+)?(st|nd|rd|th|s)?$") | p.isin(NUMBER_WORDS)
    pieces = F.transform(pieces, lambda p: F.when(number(p), "<num>").otherwise(p))
    return F.when(is_disfluent(text) | (F.coalesce(F.trim(text), F.lit("")) == ""), F.array().cast("array<string>")).otherwise(pieces)


def capitalised(text: Column) -> Column:
    return F.coalesce(stripped(text, CORE_SIGNS).rlike("^\\p{Lu}"), F.lit(False))


def alnum_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def html_escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text
