"""Invented lessons for content scoring: sentences of each kind, harmless ones with the same words, and plain context.

The sentences come from small grammars; offending words are disguised at random.
Context is taken from a bounded sample of unlabelled documents (CONTEXT_DOCS).
"""

from __future__ import annotations

import re

import numpy as np

from streamloom.llm.content_model import KINDS, WINDOW
from streamloom.llm.content_text import Vocabulary

#: How many documents lend context, and how many windows of each sort are made.
CONTEXT_DOCS, EACH = 3000, 10000

WORDS = {
    "INS": "idiot moron imbecile bastard dumbass asshole scumbag prick loser jackass halfwit dimwit cretin jerk dipshit fool twat wanker bitch shithead",
    "ADJ": "stupid fucking goddamn useless worthless pathetic disgusting brainless lazy miserable filthy damn bloody rotten",
    "GRP": "Vellish Orrani Tesmars Ulvish Marrowfolk Kodrins Zennites Harkuni Dromish Pelvans Nortari Grushek immigrants foreigners",
    "VERM": "vermin rats parasites scum cockroaches animals filth subhuman garbage",
    "VERM1": "parasite rat animal cockroach leech",
    "BODY": "breasts cock cocks tits ass pussy thighs naked body",
    "VERB": "describe plot check measure rank label sort test adjust record simplify align trim review defend",
    "NOUN": "lexicon prior rater schema token signal cohort survey median node vowel habit probe cue memory rubric slide transcript threshold diarizer",
    "ADJN": "neutral novel sparse quiet stable coarse fine local global partial visible common robust weak",
    "NUM": "two three four five seven nine twelve twenty",
    "PLACE": "lab room class group hall seminar team course",
}
LESSONS = {
    "abusive": """
    Fuck you and your {ADJN} {NOUN}.|Go to hell, you {INS}.|Shut up, you {ADJ} {INS}.|What a {ADJ} {INS} you are.|You are a {ADJ} {INS} and everyone in here knows it.
    Your brain is {ADJ} garbage, you {INS}.|Keep talking and I will break your teeth, {INS}.|I hope you choke on it, {INS}.|Nobody likes you, {INS}, so just disappear.
    Get lost, {ADJ} {INS}, before I make you.|Listen, {INS}, nobody wants you in this {PLACE}.|Only a {INS} like you would {VERB} that, you {ADJ} piece of shit.
    You should be ashamed to breathe, you {ADJ} {INS}.|He called me a {ADJ} {INS} and I told him to fuck off, that {INS}.|Fuck off, you {INS}.|You {ADJ} {INS}, go to hell.
    I will kill you, {INS}.|I swear I will smash your face, you {INS}.|You are nothing but a {ADJ} {INS}.|Drop dead, {INS}.|She is a {ADJ} {INS} and so are you.|You make me sick, {INS}.
    Piss off, {ADJ} {INS}.|How dumb can you be, you {INS}.|Say that again and I will hurt you, {INS}.|Screw you and your {NOUN}.|That {INS} in the back should shut his mouth.
    Du bist ein wertloser Vollidiot.|So ein elender Dummkopf wie du gehört hier nicht her.|Verpiss dich, du Arschloch.|Halt die Fresse, du dummer Idiot.|Du dumme Sau, halt dein Maul.|Fick dich, du Wichser.|Du elender Idiot, verschwinde.
    Eres un idiota inútil y das asco.|Cállate, pedazo de imbécil.|Nadie te soporta, gilipollas.|Vete a la mierda, estúpido.|Eres un hijo de puta.|Cierra la boca, idiota de mierda.
    Va te faire foutre, connard.|Ferme ta gueule, espèce d'imbécile.|Personne ne te supporte, pauvre abruti.|Tu es un idiot inutile, dégage.|Dégage, sale con.|Espèce de connard, ferme la.
    """,
    "hateful": """
    The {GRP} are a disease on this country.|The {GRP} were born inferior and that is all there is to say.|No {GRP} allowed, those animals belong in cages.|Send the dirty {GRP} back where they came from.
    Somebody ought to wipe out the {GRP} for good.|All {GRP} are {VERM} and should be driven out.|Round up the {GRP}, nobody would miss that scum.|{GRP} are {VERM}, every last one of them.|{GRP} are subhuman, every last one of them.
    I would rather burn the hall down than teach one more {GRP} {VERM1}.|We should never let filthy {GRP} sit in the same room as us.|You cannot trust {GRP}, they breed like rats and steal like rats.
    Every {GRP} is a thief and should be thrown out.|{GRP} do not deserve to live here, they are {VERM}.|Kill all {GRP}.|The {GRP} should be exterminated like {VERM}.|Those {GRP} are a filthy race of liars.|Get the {GRP} out of our country, they ruin everything.
    Alle {GRP} sind Ungeziefer und müssen weg.|Die {GRP} sind Abschaum.|Die dreckigen {GRP} gehören alle vergast.|{GRP} raus aus unserem Land, das sind Parasiten.
    Todos los {GRP} son ratas y hay que echarlos.|Los {GRP} son una plaga asquerosa.|Hay que acabar con los sucios {GRP}.
    Tous les {GRP} sont de la vermine, qu'on les chasse.|Les {GRP} sont des parasites inférieurs.|Il faut chasser ces sales {GRP}.
    """,
    "sexual": """
    They were moaning and fucking in the next room the whole night.|He whispered that he was hard and wanted a blowjob after the party.|She sent him nudes again and begged him to touch her {BODY}.
    Their orgy went on till dawn, he wrote, with cocks out and clothes on the floor.|I want to undress you and lick every inch of your naked body.|Anyone up for a hookup tonight, I am horny and my bed is empty.
    Somebody played a porn clip, {NUM} naked adults having rough sex, over the speakers.|The message was about her wet panties and what he would do to her in bed.|He kept telling the table how he would strip naked and have sex with her on the desk.
    She moaned while he kissed her {BODY} and pulled down her panties.|I am so horny, come over and fuck me.|He showed us a porn video of {NUM} people having sex.|She wants him naked in her bed, moaning all night.|Send me nudes, I want to see your {BODY}.|He came all over her {BODY}.|They had sex on the desk and she was moaning.|Ich will dich nackt in meinem Bett ficken.|Quiero follarte desnuda toda la noche.|Je veux te baiser nue dans mon lit.
    """,
}
HARMLESS = """
The survey asks adults about sexual health, contraception and consent in neutral wording.|The lecture on hate speech covered how slurs are scored by coders.|Master and slave clocks drifted by seconds.
An old rating scale used idiot, imbecile and moron as clinical grades, and the handbook explains why the terms were dropped.|If the worker hangs, kill the process and drop the dead queue.
{GRP} settled the coast first, and their descendants still hold the spring fair.|Breast cancer screening served as the example for base rates.|The dumb terminal in the booth only prints what the host sends.
The {GRP} vowel system has eight members, and {GRP} has only five.|Rats and other vermin carried the parasite in the field study.|A stupid question is one nobody asked, so please raise your hand.|Shoot the slide first, then the speaker, and cut the dead frames.
Participants read the word bastard in a list of {NUM} taboo words and pressed a key.|Participants read the word {INS} in a list of {NUM} taboo words and pressed a key.|The film scene with a naked statue was rated as neutral by {NUM} viewers.|Sex differences in recall were small once the {NOUN} was controlled.
That was a brutal quiz, I am an idiot for skipping the {NOUN}.|The hard drive blew up, damn it, and we lost the {ADJN} {NOUN}.|I feel so stupid, I forgot my own {NOUN}.|What a stupid mistake I made in the {NOUN}.|Damn, the {NOUN} crashed again.|I am such a moron, I deleted my own notes.
The rats in the cage learned the {NOUN}.|The study of the parasite needs {NUM} animals in cages.|The {GRP} language has {NUM} dialects.|{GRP} speakers were recruited for the {NOUN}.|The {GRP} students joined our {PLACE}.|The village of the {GRP} lies on the coast.|Nurses explain sexual education and consent to teenagers.
The terms slave and master are replaced by leader and follower.|Kill the job and shoot a mail to the admin.|The survey on sexual orientation had {NUM} items.|The article counts how often the word idiot occurs.|The coder rated the slur as offensive in the {NOUN}.|The naked eye cannot see the {NOUN}.|Dead code and orphan processes waste memory.|The execution of the program was aborted.|We killed the process, the dead worker was the problem.
The breast tissue was screened in the clinic.|He hangs the poster in the hall.|The ratings of abuse were scored by {NUM} coders.|The idiot light on the dashboard blinks.|Choke points in the network slow the {NOUN}.|The sex of the infant was coded.|My stupid alarm did not ring, sorry.|This damn printer again.|Hell of a {NOUN}, well done.|The drug kills the parasite in the gut.|Ich bin so ein Idiot, ich habe die Datei gelöscht.|Soy un idiota, olvidé la lista.|Je suis un idiot, j'ai oublié la liste.
Die Ratten im Versuch lernten schnell.|El estudio de la plaga duró dos meses.|Le parasite a été étudié au laboratoire.|Listen, nobody wants to miss the {NOUN}.|Get lost in the {NOUN} and you will never find the {NOUN}.|Your brain is wired to {VERB} the {NOUN}.|Keep talking and I will record the {NOUN}.|Shut the door, please.|Somebody played a clip over the speakers.|Send the forms back where they came from.|The message was about the {NOUN} and what he would do in class.|You should be proud of the {NOUN}.|Round up the numbers in the {NOUN}.
"""
_BAD = re.compile(
    r"(?i)fuck|shit|idiot|moron|imbec|bastard|dumbass|asshole|scumbag|prick\b|loser|jackass|halfwit|dimwit|vermin|subhuman|scum\b|parasit|filth|porn|naked|nude|horny|orgy|cocks|moan|panties|blowjob|"
    r"sexual|\bsex\b|breast|abschaum|ungeziefer|arsch|fresse|dumm|vollid|connard|gueule|abruti|imb[eé]c|gilip|mierda|idiota|plaga|ratas|vellish|orrani|tesmars|ulvish|marrowfolk|kodrins|zennites|\bhell\b|teeth|choke|worthless|pathetic|inferior"
)


def _disguised(word: str, rng: np.random.Generator) -> str:
    kind = int(rng.integers(7))
    if kind == 0:
        table = {"a": "@", "i": "1", "e": "3", "o": "0", "s": "$", "t": "7"}
        return "".join(table[c.lower()] if c.lower() in table and rng.random() < 0.75 else c for c in word)
    if kind == 1:
        table = {"a": "а", "e": "е", "i": "і", "o": "о", "c": "с"}
        return "".join(table.get(c, c) for c in word)
    if kind == 2:
        return " ".join(word)
    if kind == 3:
        return str(rng.choice(list("-_."))).join(word)
    if kind == 4:
        return word[0] + "*" * (len(word) - 2) + word[-1] if len(word) > 3 or rng.random() < 0.5 else word[0] + "*" * (len(word) - 1)
    if kind == 5:
        k = int(rng.integers(1, len(word)))
        return word[:k] + word[k] * int(rng.integers(3, 7)) + word[k + 1 :]
    return word.upper()


def _filled(pattern: str, rng: np.random.Generator, disguise: float) -> str:
    def slot(m: re.Match) -> str:
        return str(rng.choice(WORDS[m.group(1)].split()))

    s = re.sub(r"\{(\w+)\}", slot, pattern.strip())
    out = []
    for w in s.split(" "):
        m = re.fullmatch(r"(\W*)(\w+)(\W*)", w)
        if m and len(m.group(2)) > 3 and disguise and _OFFENDING.fullmatch(m.group(2).lower()) and rng.random() < disguise:
            w = m.group(1) + _disguised(m.group(2), rng) + m.group(3)
        out.append(w)
    s = " ".join(out)
    r = rng.random()
    return s.upper() if r < 0.08 else s.lower() if r < 0.3 else s


_OFFENDING = re.compile(
    "|".join(
        sorted(
            {w.lower() for k in ("INS", "ADJ", "VERM", "VERM1", "BODY") for w in WORDS[k].split()}
            | set("fuck shit hell garbage disease inferior dirty filthy scum naked porn sex nudes orgy horny panties blowjob fucking moaning vollidiot dummkopf arschloch idiot idiota imbécil gilipollas estúpido mierda connard imbécile abruti ungeziefer abschaum ratas plaga vermine parasites".split())
        )
    )
)


def patterns(kind: str) -> list[str]:
    source = HARMLESS if kind == "harmless" else LESSONS[kind]
    return [p.strip() for line in source.strip().splitlines() for p in line.split("|") if p.strip()]


def vocabulary_of_lessons() -> set[str]:
    """Every word of the grammars."""
    text = " ".join([*WORDS.values(), *LESSONS.values(), HARMLESS])
    return set(re.findall(r"[^\W\d_]+", re.sub(r"\{\w+\}", " ", text)))


def context(folder: str, vocabulary: Vocabulary) -> list[np.ndarray]:
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{folder}/documents.parquet", columns=["text"])["text"].to_pylist()
    rng = np.random.default_rng(3)
    picked = rng.choice(len(texts), min(CONTEXT_DOCS, len(texts)), replace=False)
    out = [vocabulary.encode(texts[n]) for n in picked if texts[n] and not _BAD.search(texts[n])]
    return [x for x in out if len(x) >= 2 * WINDOW]


def make(folder: str, vocabulary: Vocabulary, seed: int = 17, each: int = EACH) -> tuple[np.ndarray, np.ndarray]:
    """Windows (rows of word numbers, -1 where there is none) and their labels."""
    rng = np.random.default_rng(seed)
    plain = context(folder, vocabulary)

    def around(inside: np.ndarray) -> np.ndarray | None:
        """A window in which `inside`, or most of it, stands between plain words; sometimes alone."""
        if rng.random() < 0.1:
            row = inside[:WINDOW]
        else:
            cut = inside
            if len(cut) > 6 and rng.random() < 0.25:
                lost = int(rng.integers(1, max(2, len(cut) // 4)))
                cut = cut[lost:] if rng.random() < 0.5 else cut[:-lost]
            cut = cut[:WINDOW]
            a, b = plain[int(rng.integers(len(plain)))], plain[int(rng.integers(len(plain)))]
            before = int(rng.integers(0, WINDOW - len(cut) + 1))
            p, q = int(rng.integers(len(a) - WINDOW)), int(rng.integers(len(b) - WINDOW))
            row = np.concatenate([a[p : p + before], cut, b[q : q + WINDOW - before - len(cut)]])
        return np.concatenate([row, np.full(WINDOW - len(row), -1, np.int64)])

    def filled(row: np.ndarray) -> np.ndarray:
        return np.concatenate([row, np.full(WINDOW - len(row), -1, np.int64)])

    def sentence(kind: str) -> np.ndarray:
        return vocabulary.encode(_filled(str(rng.choice(by_kind[kind])), rng, 0.0 if kind == "harmless" else 0.35))

    by_kind = {k: patterns(k) for k in (*KINDS, "harmless")}
    rows, gold = [], []
    none = np.zeros(len(KINDS), np.float32)
    for n, kind in enumerate(KINDS):
        for _ in range(each):
            rows.append(around(sentence(kind)))
            gold.append(np.eye(len(KINDS), dtype=np.float32)[n])
    # One whole sentence with ends of others at its sides: what an end tells isn't judged (-1).
    for _ in range(2 * each):
        kinds = [str(rng.choice([*KINDS, "harmless"])) for _ in range(3)]
        left, mid, right = (sentence(k) for k in kinds)
        mid = mid[:WINDOW]
        before = int(rng.integers(0, WINDOW - len(mid) + 1))
        left = left[len(left) - min(len(left), before) :]
        row = np.concatenate([left, mid, right])[:WINDOW]
        g = none.copy()
        for k in (kinds[0], kinds[2]):
            if k in KINDS:
                g[KINDS.index(k)] = -1
        if kinds[1] in KINDS:
            g[KINDS.index(kinds[1])] = 1
        rows.append(filled(row))
        gold.append(g)
    for n in range(3 * each):
        words = sentence("harmless")
        if n % 2 and len(words) > 2:  # any piece of a harmless sentence is harmless
            cut = int(rng.integers(1, len(words)))
            words = words[cut:] if rng.random() < 0.5 else words[:cut]
        rows.append(around(words))
        gold.append(none)
    for n in range(3 * each):
        a = plain[int(rng.integers(len(plain)))]
        p = int(rng.integers(len(a) - WINDOW))
        rows.append(filled(a[p : p + (int(rng.integers(1, WINDOW)) if n % 3 == 0 else WINDOW)]))
        gold.append(none)
    return np.stack(rows), np.stack(gold)


def train(folder: str, rounds: int = 7, batch: int = 128, seed: int = 23) -> None:
    """Trains on the lessons of `folder` and stores the weights; prints loss and held-out accuracy."""
    from streamloom.llm.content_model import Trainer

    vocabulary = Vocabulary(10**9)
    rows, gold = make(folder, vocabulary)
    test_rows, test_gold = make(folder, vocabulary, seed=99, each=500)
    trainer = Trainer(vocabulary.words)
    rng = np.random.default_rng(seed)
    for r in range(rounds):
        trainer.rate = 3e-3 * (0.6**r)
        order = rng.permutation(len(rows))
        loss = [trainer.step(rows[order[a : a + batch]], gold[order[a : a + batch]]) for a in range(0, len(order), batch)]
        hit = ((trainer.predict(test_rows) > 0.5) == (test_gold > 0.5)) | (test_gold < 0)
        print(f"round {r}: loss {np.mean(loss):.4f}, windows right {hit.all(axis=1).mean():.4f}", flush=True)
    trainer.save()


if __name__ == "__main__":
    import sys

    train(sys.argv[1])
