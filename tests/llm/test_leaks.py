import random

from streamloom.llm import leaked_tests as lt

D, P = "doc_id long, text string, item_id int", "item_id long, text string, doc_id int"
WORDS = [f"w{n}" for n in range(40)]


def brute(docs, items, least):
    out = set()
    words = lambda t: [w for w in lt.words_of(t) if not lt._DRAWN.fullmatch(w)]
    for i, t in items:
        ws = words(t)
        grams = {tuple(ws[k : k + least]) for k in range(len(ws) - least + 1)}
        for d, u in docs:
            vs = words(u)
            if any(tuple(vs[k : k + least]) in grams for k in range(len(vs) - least + 1)):
                out.add((d, i))
    return out


def run(spark, docs, items, least=12):
    d = spark.createDataFrame([(*r, 1) for r in docs], D)
    p = spark.createDataFrame([(*r, 1) for r in items], P)
    return lt.leaked_tests(d, p, least=least)


def test_random_texts_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    items = [(n, " ".join(rng.choices(WORDS, k=25))) for n in range(12)] + [(99, "short one"), (98, None)]
    docs = [(None, None), (1, ""), (2, " ")]
    for n in range(40):
        t = rng.choices(WORDS, k=60)
        if n % 2:
            src = rng.choice(items[:12])[1].split()
            a, k = rng.randrange(14), rng.randrange(8, 16)
            t[20:20] = src[a : a + k]
        docs.append((100 + n, " ".join(t)))
    want = brute(docs, items, 12)
    assert {(r.doc_id, r.item_id) for r in run(spark, docs, items).collect()} == want and want
    monkeypatch.setattr(lt, "BLOCK_CHARS", 300)  # the query set in several blocks
    assert {(r.doc_id, r.item_id) for r in run(spark, docs, items).collect()} == want


def test_marks_between_words_do_not_hide_a_passage(spark):
    passage = "The glassblower's apprentice learned to test a bubble by its paired cohort and never again trusted a flame"
    srt = "7\n00:00:01,000 --> 00:00:04,000\nTHE GLASSBLOWER’S APPRENTICE [UH] LEARNED\n\n8\n00:00:04,000 --> 00:00:09,000\n(coughs) TO TEST um, A BUBBLE BY ITS\n\n9\n00:00:09,000 --> 00:00:12,000\npaired — cohort and never"
    talk = "[00:10:13] SPEAKER_03: so the glassblowers apprentice learned to test\n[00:10:19] Spk1: [breath] a bubble by its paired cohort"
    near = "the glassblowers apprentice learned to test a bubble by its other paired cohort and never again trusted a flame"
    broken = "the glassblowerâ€™s apprentice learned to test a bubble by its paired cohort"
    got = {r.doc_id for r in run(spark, [(1, srt), (2, talk), (3, near), (4, broken)], [(5, passage)]).collect()}
    assert got == {1, 2, 4}


def test_reordered_parts_are_tiled(spark):
    p = [f"t{n}" for n in range(40)]
    r = run(spark, [(1, " ".join(p[20:40] + ["x"] + p[0:20]))], [(7, " ".join(p))]).first()
    assert (r.n_tiles, r.longest, r.covered, r.item_words) == (2, 20, 40, 40)


def test_tiles_never_overlap():
    rng = random.Random(2)
    for _ in range(50):
        got = lt.tiles([(rng.randrange(5, 20), rng.randrange(60), rng.randrange(60)) for _ in range(8)], 5)
        for side in (1, 2):
            used = [x for t in got for x in range(t[side], t[side] + t[0])]
            assert len(used) == len(set(used))
        assert all(n >= 5 for n, _, _ in got)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]).count() == 0 and run(spark, [(1, "a b")], []).count() == 0


def test_drawn_out_and_foreign_hesitations_break_no_run(spark):
    assert all(lt._DRAWN.fullmatch(h) for h in "uh um uhm hm hmm mm mhm er erm eh ah".split())
    p = [f"t{n}" for n in range(14)]
    talk = " ".join(p[:4] + ["Uhhhhh,"] + p[4:8] + ["ummmmmm"] + p[8:10] + ["äh", "ähm"] + p[10:])
    r = run(spark, [(1, talk)], [(7, " ".join(p[:7] + ["öhhh"] + p[7:]))]).first()
    assert (r.n_tiles, r.longest, r.item_words) == (1, 14, 14)


def test_long_notes_and_passages_in_long_brackets(spark):
    p = [f"t{n}" for n in range(14)]
    note = "[somebody drags a heavy chair over the floor and closes the door of the room]"
    docs = [(1, " ".join([*p[:7], note, *p[7:]])), (2, f"<{' '.join(p)}>"), (3, " ".join([*p[:7], note[1:-1], *p[7:]]))]
    got = {r.doc_id: (r.n_tiles, r.covered) for r in run(spark, docs, [(7, " ".join(p))]).collect()}
    assert got == {1: (1, 14), 2: (1, 14)}


def test_words_that_many_passages_share():
    common = [f"c{n}" for n in range(13)]
    items = [(n, " ".join([f"a{n}", *common, f"b{n}"])) for n in range(300)]
    texts = [" ".join(common), None, " ".join(["x", *common, "b7"]), " ".join(common[:11])]
    want = sorted([(0, n, 1, 13, 13) for n in range(300)] + [(2, n, 1, 14 if n == 7 else 13, 14 if n == 7 else 13) for n in range(300)])
    known = lt.Passages(items)
    assert sorted(lt.find_in(texts, known)) == want and sorted(lt.find_in(texts, known, most=5)) == want
