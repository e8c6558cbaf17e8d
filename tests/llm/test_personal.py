import pytest

from streamloom.llm.personal_data import in_text, in_texts, in_words, redacted


def found(text):
    return [(k, text[a : b + 1]) for k, a, b in in_text(text)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("write to ann.lee+x@lab-group.example, please", [("email", "ann.lee+x@lab-group.example")]),
        ("to me at hugo dot fennilin at lab-group dot example if", [("email", "hugo dot fennilin at lab-group dot example")]),
        ("from ingrid+membrane @ post.test. When", [("email", "ingrid+membrane @ post.test")]),
        ("sheet to pmorvawick AT mail.test. We look at mail.test", [("email", "pmorvawick AT mail.test")]),
        ("The handle @labgroup is only for the wiki.", []),
        ("call +1-212-555-0107 or (305) 555-0188, 650.555.0192, 555-0131 or 3055550138", [("phone", "1-212-555-0107"), ("phone", "305) 555-0188"), ("phone", "650.555.0192"), ("phone", "555-0131"), ("phone", "3055550138")]),
        ("My cell is +44 7700 900879.", [("phone", "44 7700 900879")]),
        ("My cell is five five five oh um one zero two. Count five five five four three two one and stop.", [("phone", "five five five oh um one zero two")]),
        ("The run was job 5550534 on the night queue. Grant number 44-1934-04 pays.", []),
        ("Her social is 906 59 7695, please. The score sheet lists 879 18 4400 in three columns.", [("idno", "906 59 7695")]),
        ("Passport or card number X8340709, that is. Please read me your number. It is 8541 5937.", [("idno", "X8340709"), ("idno", "8541 5937")]),
        ("The file 949_64_7555.wav is the long one. Block X015 and block U10. Entry DS-00445611.", []),
        ("We live at 415A Old Juniper Street, Apt 26, since forty two Station Close. was sold", [("address", "415A Old Juniper Street, Apt 26"), ("address", "forty two Station Close")]),
        ("At the station the road forks by the court. Trial 4 Station condition, lane 742, court side.", []),
        ("Thanks, Ostremark, Priya. Thanks, Caldemark. A weak clause.", [("name", "Ostremark, Priya"), ("name", "Caldemark")]),
        ("Ask Owen E. Rennlin about H. Caldelin's book; Dr. quistwick told me.", [("name", "Owen E. Rennlin"), ("name", "H. Caldelin"), ("name", "quistwick")]),
        ("Room 261 in Chestnut Hall is free. The Martin effect. Mark the page, bill the lab, and grant them an hour.", []),
    ],
)
def test_mentions(text, want):
    assert found(text) == want


def test_words_inside_mentions_are_seen_through(spark):
    tokens = "I live at [uh] 12 Old (2) Bir- Birch _ Rd. Thanks, Hugo Hugo [door slams] Quistby".split(" ")
    tokens[tokens.index("[door")] = "[door slams]"
    tokens.remove("slams]")
    rows = [("r", n, t) for n, t in enumerate(tokens)]
    df = spark.createDataFrame(rows + rows[:5] + [(None, 1, "a"), ("r", None, "b"), ("r", 900, None), ("e", 0, "")], "rec_id string, i int, text string")
    at = {t: n for n, t in enumerate(tokens)}
    got = sorted(tuple(r) for r in in_words(df).collect())
    assert got == [("r", "address", at["12"], at["Rd."]), ("r", "name", len(tokens) - 3, len(tokens) - 1)]
    assert sorted(tuple(r) for r in in_words(df, block=6).collect()) == got


def test_placeholders_and_rows(spark):
    assert redacted("Call (305) 555-0188 or Ann@x.example!") == "Call [PHONE] or [EMAIL]!"
    assert redacted(None) is None and redacted("") == ""
    df = spark.createDataFrame([(1, "Ask Hugo Quistby's cat", 5), (1, "Ask Hugo Quistby's cat", 6), (None, None, 7), (2, " ", 8), (3, "ab " * 20_000 + "me@x.example", 9)], "k int, t string, kind int")
    got = sorted((tuple(r) for r in in_texts(df, "k", "t").collect()), key=str)
    assert got == [(1, "name", 4, 15), (1, "name", 4, 15), (3, "email", 60000, 60011)]
    assert [r.t for r in in_texts(df, "k", "t", redact=True).where("k = 1").collect()] == ["Ask [NAME]'s cat"] * 2
    assert in_texts(df.where("false"), "k", "t").count() == 0


@pytest.mark.parametrize(
    "text,want",
    [
        ("Write <ann@x.example> or (bob@y.example).", [("email", "ann@x.example"), ("email", "bob@y.example")]),
        ("ask (Anna Brennby) or [Hugo Quistby], please", [("name", "Anna Brennby"), ("name", "Hugo Quistby")]),
        ("at home (555-0131) or the office (call 650-555-0192).", [("phone", "555-0131"), ("phone", "650-555-0192")]),
        ("We live near (12 Old Birch Rd.) now (your number is 8541 5937)", [("address", "12 Old Birch Rd"), ("idno", "8541 5937")]),
        ("Anna [glass shatters] Brennby and Hugo [door slams] Quistby", [("name", "Anna [glass shatters] Brennby"), ("name", "Hugo [door slams] Quistby")]),
        ("(phone buzzing) [Speaker 1]: [00:12:30] <12.50> (applause) [inaudible 00:12]", []),
    ],
)
def test_brackets_hide_no_mention(text, want):
    assert found(text) == want


def test_brackets_in_words_and_placeholders(spark):
    tokens = ["ask", "(Anna", "Brennby)", "or", "[Hugo Quistby]", "at", "(555-0131)", "(call", "650-555-0192)", "<ann@x.example>", "[door slams]"]
    df = spark.createDataFrame([("r", n, t) for n, t in enumerate(tokens)], "rec_id string, i int, text string")
    want = [("r", "email", 9, 9), ("r", "name", 1, 2), ("r", "name", 4, 4), ("r", "phone", 6, 6), ("r", "phone", 8, 8)]
    assert sorted(tuple(r) for r in in_words(df).collect()) == want
    assert redacted("ask (Anna Brennby) at (call 650-555-0192) <ann@x.example>") == "ask ([NAME]) at (call [PHONE]) <[EMAIL]>"


@pytest.mark.parametrize(
    "text,want",
    [
        ("Mrs. Smith came and Professor Smith left.", ["Smith", "Smith"]),
        ("Then Joseph Brennby left.", ["Joseph Brennby"]),
        ("Is Dr. Alan van der Berg here?", ["Alan van der Berg"]),
        ("My name is Zoltan Okafor and this is Akira Petrov.", ["Zoltan Okafor", "Akira Petrov"]),
        ("Thanks, Ngozi. A question from Siobhan O'Connell, please. Then Kwame Nowak asked why.", ["Ngozi", "Siobhan O'Connell", "Kwame Nowak"]),
        ("So Anna Whitfield met Tariq Brennby; ask Ferguson, Dmitri about it.", ["Anna Whitfield", "Tariq Brennby", "Ferguson, Dmitri"]),
        ("This is Chestnut Hall. Thanks, Everyone. From New York by Orchard Study. Ask That again. This is English.", []),
    ],
)
def test_names_outside_the_lists(text, want):
    assert [m for k, m in found(text) if k == "name"] == want


#: Names in no list of the operator.
OTHERS = "Zoltan Ngozi Siobhan Kwame Dmitri Xiomara Chidi Fumiko Goran Ludmila Quentin Tunde Yelena Aoife".split()
FAMILIES = "Obama Merkel Tanaka Okafor Petrov O'Connell Whitfield Nakamura Lindqvist Castellanos Dubois Szymanski MacGregor Rossi".split()
PLACES = ["Thanks, {}. It is late.", "My name is {} and I sit in the back.", "Ask {} about the rota.", "Well, {} asked whether it holds.", "I borrowed this from {}'s notebook.", "Dr. {} will cover the second half.", "When the filter fits, {} tend to skip it."]


def test_most_names_outside_the_lists_are_found_with_exact_ends():
    import random

    from streamloom.llm.personal_data import GIVEN

    rng = random.Random(2)
    assert not {n.lower() for n in OTHERS} & set(GIVEN)
    hit = total = 0
    for _ in range(300):
        name = rng.choice([f"{rng.choice(OTHERS)} {rng.choice(FAMILIES)}", f"{rng.choice('ABT')}. {rng.choice(FAMILIES)}", rng.choice(FAMILIES)])
        text = "So we look at the data. " + rng.choice(PLACES).format(name)
        hit += [m for k, m in found(text) if k == "name"] == [name]
        total += 1
    assert hit / total >= 0.9


def test_mentions_over_long_halos_do_not_depend_on_blocks(spark):
    noise = ["[door slams]", "uh", "_"] * 70
    tokens = ["we"] * 20 + ["call", "five", "five", "five", *noise, "oh", "one", "zero", "two.", "Ask", "Anna", *noise, *noise, "Brennby", "now"]
    df = spark.createDataFrame([("r", n, t) for n, t in enumerate(tokens)], "rec_id string, i int, text string")
    want = sorted(tuple(r) for r in in_words(df, block=10_000).collect())
    assert [r[1] for r in want] == ["name", "phone"] and want[1][3] - want[1][2] > 200
    for block in (7, 64, 100):
        assert sorted(tuple(r) for r in in_words(df, block=block).collect()) == want


def test_long_notes_inside_mentions_and_many_mentions():
    import time

    note = "[somebody drags a heavy chair over the floor and then closes the door of the room]"
    assert found(f"call 650-555-0192 or ask Anna {note} Brennby now") == [("phone", "650-555-0192"), ("name", f"Anna {note} Brennby")]
    began = time.perf_counter()
    assert len(found("Ask Anna Brennby at ann@x.example now. " * 4000)) == 8000
    assert time.perf_counter() - began < 4


def test_words_with_placeholders(spark):
    from streamloom.llm.personal_data import redacted_words

    tokens = ["Ask", "Anna", "Brennby's", "friend,", None, "at", "650-555-0192."]
    df = spark.createDataFrame([("r", n, t) for n, t in enumerate(tokens)] + [(None, 1, "Anna"), ("r", None, "Hugo")], "rec_id string, i int, text string")
    got = {(r.rec_id, r.i): r.text for r in redacted_words(df).collect()}
    assert got == {("r", 0): "Ask", ("r", 1): "[NAME]", ("r", 2): "'s", ("r", 3): "friend,", ("r", 4): None, ("r", 5): "at", ("r", 6): "[PHONE].", (None, 1): "Anna", ("r", None): "Hugo"}
