import math

from streamloom.llm.source_mixing import entropy, mix_sources, mixing_plan, temperature_plan, tempered

D, T = "doc_id long, text string, source string, block int", "source string, target_share double, max_repeat int"


def test_plan_holds_capped_sources_and_keeps_proportions():
    there = {"a": 700, "b": 200, "c": 100}
    want = {"a": (0.2, 1), "b": (0.4, 3), "c": (0.4, 2), "d": (0.1, 4)}
    plan = mixing_plan(there, want)
    assert abs(plan["c"] - 200) < 1e-6 and plan["d"] == 0
    assert abs(plan["b"] / plan["a"] - 2) < 1e-6 and abs(sum(plan.values()) - 1000) < 1e-6
    assert all(plan[s] <= want[s][1] * there.get(s, 0) + 1e-6 for s in want)


def test_plan_when_all_are_capped_or_nothing_is_there():
    assert mixing_plan({"a": 10}, {"a": (1.0, 2)}, total=1000) == {"a": 20.0}
    assert mixing_plan({}, {"a": (1.0, 2)}) == {"a": 0.0}
    assert mixing_plan({"a": 5, "b": 5}, {"a": (0.0, 2), "b": (1.0, 0)}) == {"a": 0.0, "b": 0.0}


def test_plan_is_nearest_to_the_targets():
    """10,000 plans against a rate found by bisection: min(cap, rate x target) fills the size."""
    import random

    rng = random.Random(5)
    for _ in range(10_000):
        names = "abcdef"[: rng.randrange(1, 7)]
        there = {s: rng.randrange(1, 1000) for s in names}
        raw = {s: rng.random() for s in names}
        want = {s: (raw[s] / sum(raw.values()), rng.randrange(1, 4)) for s in names}
        total = rng.choice([None, rng.randrange(1, 4000)])
        size = min(sum(there.values()) if total is None else total, sum(want[s][1] * there[s] for s in names))
        filled = lambda rate: {s: min(want[s][1] * there[s], rate * want[s][0]) for s in names}  # noqa: B023, E731
        lo, hi = 0.0, 1e9
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(filled(mid).values()) < size else (lo, mid)
        plan = mixing_plan(there, want, total)
        assert all(abs(plan[s] - w) <= 1e-6 * size + 1e-6 for s, w in filled(hi).items())


def test_temperature_sets_the_weights():
    import random

    p = {"a": 0.9, "b": 0.1}
    assert abs(tempered(p, 1.0)["a"] - 0.9) < 1e-12 and tempered(p, 0.0) == {"a": 0.5, "b": 0.5}
    rng = random.Random(9)
    for _ in range(500):
        there = {s: rng.randrange(1, 2000) for s in "abcde"}
        caps = {s: rng.randrange(1, 5) for s in "abcde"}
        nats = rng.choice([None, rng.random() * math.log(5)])
        a, plan = temperature_plan(there, caps, None, nats)
        total = sum(there.values())
        shares = tempered({s: n / total for s, n in there.items()}, a)
        assert all(abs(plan[s] - shares[s] * total) < 1e-6 * total and plan[s] <= caps[s] * there[s] * (1 + 1e-9) for s in there)
        # A little flatter breaks a cap, or the exponent is all it can be, or the entropy is met.
        flatter = tempered({s: n / total for s, n in there.items()}, a - 1e-4)
        assert a < 1e-9 or any(flatter[s] * total > caps[s] * there[s] * (1 - 1e-9) for s in there) or (nats is not None and (abs(entropy(shares) - nats) < 1e-6 or a > 1 - 1e-9))
    assert temperature_plan({"a": 0}, {"a": 2}) == (1.0, {"a": 0.0})
    assert abs(sum(temperature_plan({"a": 10, "b": 90}, {"a": 1, "b": 2}, 1000)[1].values()) - 100) < 1e-9


def test_corpus_meets_budgets_and_caps(spark):
    rows = [(n, f"word number {n} " * (n % 5 + 1), ["Big", "small ", "SMALL"][0 if n < 300 else 1 + n % 2], 7) for n in range(360)]
    rows += [(900, None, "Big", 7), (901, "", "Big", 7), (902, "text", None, 7), (903, "text", "other", 7), (None, "a null key", "small", 7)]
    docs = spark.createDataFrame(rows, D)
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 2), ("none", 0.1, 3), ("nulls", None, None)], T)
    corpus, report = mix_sources(docs, targets, blocks=8)
    c = corpus.collect()
    rep = {r.source: r for r in report.collect()}
    per = {}
    for r in c:
        per.setdefault((r.source, r.doc_id, r.epoch), []).append(r)
    assert all(len(v) == 1 for v in per.values())
    assert max(r.epoch for r in c if r.source == "big") == 0 and max(r.epoch for r in c if r.source == "small") <= 1
    for s in ("big", "small"):
        got = sum(r.n_tokens for r in c if r.source == s)
        assert got == rep[s].mixed_tokens and abs(got - rep[s].planned_tokens) <= 20
    assert rep["none"].mixed_tokens == 0 and abs(sum(r.actual_share for r in rep.values()) - 1) < 1e-5
    again = {(r.doc_id, r.epoch, r.place) for r in mix_sources(docs.repartition(7), targets, blocks=8)[0].collect()}
    assert again == {(r.doc_id, r.epoch, r.place) for r in c}


def test_no_documents(spark):
    corpus, report = mix_sources(spark.createDataFrame([], D), spark.createDataFrame([("a", 1.0, 1)], T))
    assert corpus.count() == 0 and report.first().mixed_tokens == 0


def test_mix_by_temperature(spark):
    docs = spark.createDataFrame([(n, f"word {n} and more", "big" if n < 270 else "small", 7) for n in range(300)], D)
    rep = {r.source: r for r in mix_sources(docs, spark.createDataFrame([("big", None, 2), ("small", 0.1, 3)], T), blocks=8, temperature=True)[1].collect()}
    assert 2.9 < rep["small"].repeats <= 3 and abs(rep["small"].actual_share - 0.3) < 0.02
