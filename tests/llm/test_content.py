import numpy as np
import pytest

from streamloom.llm import content_lessons as cl
from streamloom.llm import content_model as cm
from streamloom.llm.content_scores import Scorer, found_kinds, rates, score_content
from streamloom.llm.content_text import Vocabulary, fold

PLAIN = "the older cohort could review the transcript in the second week because the signal changes a lot "


@pytest.mark.parametrize("token,plain", [("m0r0n,", "moron"), ("$cumb@g", "scumbag"), ("f-u-c-k", "fuck"), ("n_u_d_e_s", "nudes"), ("іdіоt", "idiot"), ("MORRRRON!", "moron"), ("Cállate,", "callate"), ("m***n", "m***n"), ("um,", None), ("5.4", None), ("--", None), ("don't", "dont")])
def test_folded_spellings(token, plain):
    assert fold(token) == plain


def test_spelled_out_words_are_put_together():
    v = Vocabulary()
    assert [v.words[n] for n in v.encode("listen, d u m b a s s, nobody I s a w")] == ["listen", "dumbass", "nobody", "isaw"]
    assert [v.words[n] for n in v.encode("I saw a cat")] == ["i", "saw", "a", "cat"]


def test_gradients_are_right():
    words = ["alpha", "beta", "gamma", "delta"]
    t = cm.Trainer(words, seed=2)
    rows = np.array([[0, 1, 2, -1], [3, 2, 1, 0]])
    gold = np.array([[1, 0, -1], [0, 1, 0]], np.float32)
    before = {k: v.copy() for k, v in t.p.items()}
    t.rate = 0
    t.step(rows, gold, drop=0)
    grad = {k: t.m[k] / 0.1 for k in t.p}

    def loss():
        p = t._forward(rows, 0)[0]
        ok = gold >= 0
        return -np.sum(ok * (gold * np.log(p + 1e-7) + (1 - gold) * np.log(1 - p + 1e-7))) / len(rows)

    rng = np.random.default_rng(0)
    for k in ("out", "a", "Wf", "Ub", "cf", "word", "gram"):
        flat = np.flatnonzero(np.abs(grad[k].ravel()) > 1e-3)
        for at in rng.choice(flat, min(4, len(flat)), replace=False):
            idx = np.unravel_index(at, grad[k].shape)
            eps = 1e-2
            t.p[k][idx] = before[k][idx] + eps
            hi = loss()
            t.p[k][idx] = before[k][idx] - eps
            lo = loss()
            t.p[k][idx] = before[k][idx]
            assert abs((hi - lo) / (2 * eps) - grad[k][idx]) < 0.02 + 0.1 * abs(grad[k][idx])


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 16, 17, 24, 25, 100])
    begin, text = cm.windows_of(sizes)
    starts = np.cumsum(np.r_[0, sizes])[:-1]
    for n, size in enumerate(sizes):
        seen = {x for b in begin[text == n] - starts[n] for x in range(b, min(b + cm.WINDOW, size))}
        assert seen == set(range(size))


def test_inference_equals_training_forward():
    p = cm.load()
    words = "you are a total moron and the signal is quiet today my friend so leave now".split()
    t = cm.Trainer(words)
    t.p = p
    rows = np.array([list(range(16)), [3, 2, 1, *[-1] * 13]])
    got = cm.window_scores(p, cm.inputs(p, cm.vectors(p, words)), rows)
    assert np.allclose(got, t.predict(rows), atol=1e-4)


def test_held_out_sentences():
    rng = np.random.default_rng(101)
    s = Scorer()
    wrong = 0
    kinds = [*cm.KINDS, "harmless"]
    for kind in kinds:
        for _ in range(60):
            text = PLAIN + cl._filled(str(rng.choice(cl.patterns(kind))), rng, 0.0 if kind == "harmless" else 0.35) + " " + PLAIN
            hit = {k for k, x in zip(cm.KINDS, s.score([text])[0]) if x >= 0.5}
            wrong += hit != ({kind} if kind != "harmless" else set())
    assert wrong <= 5


def test_documents_of_every_sort(spark):
    docs = spark.createDataFrame(
        [(1, PLAIN * 300 + "you are a stupid m0r0n and everyone in here knows it. " + PLAIN, "Study-Forum", 0.5), (2, None, None, 0.0), (3, "", " ", 0.0), (4, PLAIN, "study forum", 0.0), (4, PLAIN, "study forum", 0.0), (None, "if the worker hangs, kill the process", "x", 0.0)],
        "doc_id long, text string, source string, abusive double",
    )
    s = score_content(docs, keep=["source"])
    assert s.count() == 6 and s.columns == ["doc_id", "source", *cm.KINDS]
    assert [(r.doc_id, r.kind) for r in found_kinds(s).collect()] == [(1, "abusive")]
    r = {x.source: x for x in rates(s).collect()}
    assert r["study_forum"].n_docs == 3 and r["study_forum"].n_abusive == 1 and r["unknown"].n_docs == 2 and r["unknown"].rate_any == 0
    assert score_content(docs.where("false")).count() == 0


def test_words_run_together_and_long_disguises_are_read_whole():
    from streamloom.llm.content_scores import Scorer
    from streamloom.llm.content_text import letters, run_together

    assert run_together("youarenothingbutaworthlessidiot") == ["you", "are", "nothing", "but", "a", "worthless", "idiot"]
    assert run_together("geschwindigkeitsbegrenzung") == ["geschwindigkeitsbegrenzung"] and run_together("idiot") == ["idiot"]
    assert len(letters("a" * 60)) == 60 and letters("x" * 59 + "y") != letters("x" * 60)
    harmful = ["so he wrote youarenothingbutaworthlessstupididiotandeverybodyknowsit to her", "you st" + "u" * 60 + "pid id" + "i" * 60 + "ot, shut up"]
    harmless = ["we measured thelectureinthelabwithanewsurveyofthetwelvenouns today", "the Donaudampfschifffahrtsgesellschaft was founded early"]
    got = Scorer().score(harmful + harmless)[:, 0]
    assert (got[:2] >= 0.5).all() and (got[2:] < 0.5).all()
