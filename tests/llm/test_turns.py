import numpy as np
import pytest

from streamloom.llm import tagger_lessons as tl
from streamloom.llm import token_tagger as tt
from streamloom.llm.transcript_turns import label_key, speaker_turns

W = "rec_id string, i int, text string, speaker string, other int"
N = "rec_id string, speaker string, display_name string"


def turns(spark, rows, names=(), **kw):
    w = spark.createDataFrame([(*r, 0) for r in rows], W)
    m = spark.createDataFrame(list(names), N)
    return sorted(tuple(r) for r in speaker_turns(w, m, **kw).collect())


def test_held_out_tokens_are_tagged():
    seqs = tl.invented(np.random.default_rng(77), ["the", "signal", "human", "era,", "errand", "Right.", "7.4"], 400)
    right = total = 0
    for tokens, tags in seqs:
        got = tt.tag(tokens)
        right += int((got == np.array(tags)).sum())
        total += len(tags)
    assert right / total > 0.995


def test_viterbi_over_many_sequences_equals_one_by_one():
    rng = np.random.default_rng(1)
    sizes = [1, 7, 3, 12]
    emit, step = rng.normal(size=(sum(sizes), 6)).astype(np.float32), rng.normal(size=(6, 6)).astype(np.float32)
    first = np.cumsum([0, *sizes[:-1]])
    one = [tt.viterbi(emit[a : a + n], np.zeros(1, np.int64), step) for a, n in zip(first, sizes)]
    assert (tt.viterbi(emit, first, step) == np.concatenate(one)).all()


@pytest.mark.parametrize("label,key", [("SPEAKER 00:", "SPEAKER_00"), (" speaker 03 ", "SPEAKER_03"), ("spk12", "SPEAKER_12"), ("Dr. Ada Brennby", "ada brennby"), ("BRENNBY", "brennby"), ("  ", None), (None, None)])
def test_label_keys(label, key):
    assert label_key(label) == key


def test_turns_of_tags_labels_and_names(spark):
    rows = [
        ("r", 0, "[UH]", None), ("r", 1, "[Speaker 0]:", None), ("r", 2, "So", None), ("r", 3, "um,", "Dr. Ada Brennby"), ("r", 4, "it", None), ("r", 5, "[throat", None), ("r", 6, "clearing]", None),
        ("r", 7, "(2)", None), ("r", 8, "p-", "spk1"), ("r", 9, "yes", "S1"), ("r", 10, "[00:01:02]", None), ("r", 11, "_", None), ("r", 12, "no", "brennby"), ("r", 13, "human", None),
    ]
    got = turns(spark, rows, [("r", "SPEAKER_00", "Dr. Ada Brennby"), ("r", "SPEAKER_01", None)])
    assert got == [("r", 1, "SPEAKER_00", 2, 7, 3), ("r", 2, "SPEAKER_01", 8, 9, 2), ("r", 3, "SPEAKER_00", 12, 13, 2)]


def test_blocks_of_any_size_give_the_same_turns(spark):
    rng = np.random.default_rng(4)
    rows = [("r", n, ["word", "um", "[lip", "smack]", "[Speaker 1]:", "ok."][int(rng.integers(6))], None if rng.random() < 0.8 else f"S{int(rng.integers(3))}") for n in range(300)]
    rows += [("r", n, t, s) for _, n, t, s in rows[40:60]]  # delivered again
    assert turns(spark, rows, block=16) == turns(spark, rows, block=10_000)


def test_words_without_labels_nulls_and_empty_tables(spark):
    assert turns(spark, [("r", 0, "a", None), ("r", 1, "b", None)]) == []
    assert turns(spark, []) == []
    rows = [(None, 0, "a", "S0"), ("r", None, "a", "S0"), ("r", 3, None, "S0"), ("r", 4, "x" * 20_000, None)]
    assert turns(spark, rows) == [("r", 1, "SPEAKER_00", 4, 4, 1)]


def test_texts_of_turns(spark):
    got = turns(spark, [("r", 0, "Hi", "S0"), ("r", 1, "uh", None), ("r", 2, "there.", None), ("r", 3, "Yes", "S1")], with_text=True)
    assert [t[-1] for t in got] == ["Hi there.", "Yes"]


def test_blocks_decode_as_the_whole():
    seqs = tl.invented(np.random.default_rng(78), ["the", "signal", "human", "Right."], 60)
    tokens = [t for s, _ in seqs for t in s]
    cuts = np.cumsum([0, 0, *[len(s) for s, _ in seqs]])
    whole = tt.viterbi(tt.emissions(tokens), cuts[1:-1], tt._model()[1])
    assert (tt.tag_blocks(tt.emissions(tokens), cuts, 9, 8) == whole).all()
