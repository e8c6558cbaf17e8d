"""Clean speaker turns out of a raw word stream.

Every recording is cut into blocks of positions, each with a few tokens of its
neighbours on both sides. In a block the tagger (token_tagger, Viterbi) tells
speech from fillers, notes, time marks and speaker tags, labels are carried
forward, and the block shrinks to a few runs of one label. What a block inherits
from earlier blocks, and turns that go over block edges, come from the runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamloom.llm.token_tagger import SPEAKER, SPEECH, emissions, viterbi, _model
from streamloom.operators.arrow_groups import starts, whole_groups
from streamloom.operators.scan import BLOCK, KEY, block_of, carried, packed
from streamloom.operators.shared import OWN, require_columns, write_and_read

#: Positions of a block, tokens of its neighbours it sees, rows a worker holds at once.
BLOCK_WORDS = 1024
HALO = 8
CHUNK_ROWS = 300_000

_TITLE = re.compile(r"^(?:dr|prof|professor|mr|mrs|ms|miss|sir|dame|herr|frau)\b\.?\s*")
_NUMBER = re.compile(r"\d+")


def label_key(label: str | None) -> str | None:
    """SPEAKER_nn for a numbered label; a name in lower case without title for any other; null for none."""
    if label is None:
        return None
    m = _NUMBER.search(label)
    if m:
        return f"SPEAKER_{int(m.group()):02d}"
    name = re.sub(r"[^\w'’. -]+", " ", label).strip().lower()
    name = re.sub(r"\s+", " ", _TITLE.sub("", name)).strip(" .")
    return name or None


_RUNS = pa.schema([("k", pa.string()), ("block", pa.int64()), ("run", pa.int32()), ("label", pa.string()), ("first_i", pa.int64()), ("last_i", pa.int64()), ("n", pa.int64()), ("words", pa.string())])
_RUNS_DDL = "k string, block long, run int, label string, first_i long, last_i long, n long, words string"


def _runs(table: pa.Table, with_text: bool) -> pa.Table:
    """The runs of one label in each block of `table` (whole blocks, sorted by position)."""
    hashes = [f"{OWN}h1", f"{OWN}h2"]
    i = table[f"{OWN}i"].to_numpy()
    new_group = starts(table, hashes)
    fresh = new_group.copy()
    fresh[1:] |= i[1:] != i[:-1]
    if not fresh.all():  # repeats of a position
        table = table.filter(pa.array(fresh))
        i, new_group = i[fresh], new_group[fresh]
    text = table[f"{OWN}text"].combine_chunks().dictionary_encode()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    values = text.dictionary.to_pylist() + [None]
    ids = text.indices.fill_null(len(values) - 1).to_numpy()
    first = np.flatnonzero(new_group)
    tags = viterbi(emissions(values)[ids], first, _model()[1])

    said = table[f"{OWN}label"].combine_chunks().dictionary_encode()
    said = said.chunk(0) if isinstance(said, pa.ChunkedArray) else said
    keys: dict[str, int] = {}
    number = lambda s: -1 if (k := label_key(s)) is None else keys.setdefault(k, len(keys))
    of_label = np.array([number(s) for s in said.dictionary.to_pylist()] + [-1])
    label = of_label[said.indices.fill_null(len(of_label) - 1).to_numpy()]
    tagged = np.flatnonzero(tags == SPEAKER)
    if len(tagged):
        of_text = {t: number(values[t]) for t in np.unique(ids[tagged])}
        label[tagged] = [of_text[t] for t in ids[tagged]]

    core = table[f"{OWN}core"].to_numpy(zero_copy_only=False).astype(bool)
    rows = np.flatnonzero(core)
    if not len(rows):
        return _RUNS.empty_table()
    group = np.cumsum(new_group)[rows]
    blank = np.array([not (v or "").strip() for v in values])
    label, spoken, pos = label[rows], (tags[rows] == SPEECH) & ~blank[ids[rows]], i[rows]
    begins = np.r_[True, group[1:] != group[:-1]]
    # The label carried forward inside the block; -1 before the first.
    at = np.where((label >= 0) | begins, np.arange(len(rows)), 0)
    label = label[np.maximum.accumulate(at)]
    edge = begins.copy()
    edge[1:] |= label[1:] != label[:-1]
    start = np.flatnonzero(edge)
    big = np.iinfo(np.int64).max
    n = np.add.reduceat(spoken.astype(np.int64), start)
    lo = np.minimum.reduceat(np.where(spoken, pos, big), start)
    hi = np.maximum.reduceat(np.where(spoken, pos, -big), start)
    g = group[start]
    order = np.arange(len(start)) - np.maximum.accumulate(np.where(np.r_[True, g[1:] != g[:-1]], np.arange(len(start)), 0))
    names = list(keys) + [None]
    run_label = label[start]
    keep = (n > 0) | (run_label >= 0)
    words: list[str | None] = [None] * len(start)
    if with_text:
        flat = [values[t] or "" for t in ids[rows]]
        end = np.r_[start[1:], len(rows)]
        words = [" ".join(flat[x] for x in range(a, b) if spoken[x]) for a, b in zip(start, end)]
    k = table[f"{OWN}k"].take(pa.array(rows[start[keep]])).combine_chunks()
    block = table[f"{OWN}block"].to_numpy()[rows[start[keep]]]
    none = n[keep] == 0
    return pa.table(
        {
            "k": k, "block": block, "run": order[keep].astype(np.int32),
            "label": [names[x] for x in run_label[keep]],
            "first_i": pa.array(lo[keep], mask=none), "last_i": pa.array(hi[keep], mask=none), "n": n[keep],
            "words": pa.array([w for w, x in zip(words, keep) if x], pa.string()),
        },
        schema=_RUNS,
    )


def speaker_turns(
    words: DataFrame, names: DataFrame | None, key: str = "rec_id", order: str = "i", text: str = "text",
    label: str = "speaker", with_text: bool = False, block: int = BLOCK_WORDS,
) -> DataFrame:
    """Turns of each recording: maximal runs of spoken words of one speaker, in order.

    words: (key, order, text, label); names: (key, "speaker", "display_name"), the
    person of each SPEAKER_nn. Fillers, notes, time marks, speaker tags and silence
    neither break nor make a turn. A label holds until the next, whether on a word
    or in a tag. Labels are unified to SPEAKER_nn by their number, or by the full
    name or surname of the recording's person (of several with that name, the
    lowest label); a name nobody has stays as written, in lower case.
    Rows with a null key or order are left out, repeats of (key, order) count once
    (they must agree), null and blank texts are no spoken words, and words
    before a recording's first label belong to no turn. Recordings without any
    label and empty tables give none. Other columns are not read.
    Output: key, turn_no (from 1), speaker, first_i, last_i, n_words and, with
    with_text, text: the spoken words joined by spaces.
    """
    require_columns(words, [key, order, text, label], "speaker_turns")
    pos = F.col(f"{OWN}i")
    rows = words.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(
        F.col(key).cast("string").alias(f"{OWN}k"), F.col(order).cast("long").alias(f"{OWN}i"), F.col(text).alias(f"{OWN}text"), F.col(label).alias(f"{OWN}label")
    )
    rows = rows.withColumn(f"{OWN}block", F.explode(F.sequence(block_of(pos - HALO, block), block_of(pos + HALO, block))))
    rows = rows.select(
        F.xxhash64(f"{OWN}k", f"{OWN}block").alias(f"{OWN}h1"), F.hash(f"{OWN}k", f"{OWN}block").alias(f"{OWN}h2"), "*",
        (block_of(pos, block) == F.col(f"{OWN}block")).alias(f"{OWN}core"),
    )
    hashes = [f"{OWN}h1", f"{OWN}h2"]
    rows = rows.repartition(*hashes).sortWithinPartitions(*hashes, f"{OWN}i")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, hashes, CHUNK_ROWS):
            yield from _runs(table, with_text).to_batches()

    runs = write_and_read(rows.mapInArrow(run, _RUNS_DDL), "runs")
    runs = runs.select(packed(["k"]), F.col("block").alias(BLOCK), "run", "label", "first_i", "last_i", "n", "words")
    runs = carried(runs, F.max_by("label", F.when(F.col("label").isNotNull(), F.col("run"))), "last", f"{OWN}before")
    runs = runs.withColumn("label", F.coalesce("label", f"{OWN}before")).drop(f"{OWN}before")
    runs = runs.where((F.col("n") > 0) & F.col("label").isNotNull())
    if names is not None:
        runs = _named(runs, names, key)
    runs = write_and_read(runs, "named-runs")

    inside = Window.partitionBy(KEY, BLOCK).orderBy("run")
    runs = carried(runs, F.max_by("label", "run"), "last", f"{OWN}prev")
    previous = F.coalesce(F.lag("label").over(inside), F.col(f"{OWN}prev"))
    runs = runs.withColumn(f"{OWN}new", (~F.col("label").eqNullSafe(previous)).cast("long")).drop(f"{OWN}prev")
    runs = carried(runs, F.sum(f"{OWN}new"), "sum", f"{OWN}earlier")
    turn = F.coalesce(F.col(f"{OWN}earlier"), F.lit(0)) + F.sum(f"{OWN}new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = runs.withColumn("turn_no", turn.cast("int"))
    aggs = [F.min("label").alias("speaker"), F.min("first_i").cast("int").alias("first_i"), F.max("last_i").cast("int").alias("last_i"), F.sum("n").cast("int").alias("n_words")]
    if with_text:
        parts = F.array_sort(F.collect_list(F.struct(BLOCK, "run", "words")))
        aggs.append(F.array_join(F.transform(parts, lambda p: p["words"]), " ").alias("text"))
    turns = runs.groupBy(KEY, "turn_no").agg(*aggs)
    return turns.select(F.col(f"{KEY}.k0").alias(key), "turn_no", "speaker", "first_i", "last_i", "n_words", *["text"][: int(with_text)])


def _named(runs: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Replaces names by the label of the recording's person with that full name or surname."""
    full = F.lower(F.trim(F.regexp_replace("display_name", r"\s+", " ")))
    full = F.trim(F.regexp_replace(full, r"^(dr|prof|professor|mr|mrs|ms|miss|sir|dame|herr|frau)\b\.?\s*", ""))
    number = F.regexp_extract("speaker", r"(\d+)", 1)
    who = names.where(F.col(key).isNotNull() & F.col("display_name").isNotNull() & (number != ""))
    who = who.select(F.col(key).cast("string").alias("k0"), F.concat(F.lit("SPEAKER_"), F.lpad(number.cast("int").cast("string"), 2, "0")).alias(f"{OWN}who"), full.alias("full"))
    spelled = F.explode(F.array_distinct(F.array("full", F.regexp_extract("full", r"(\S+)$", 1))))
    who = who.select("k0", spelled.alias("label"), f"{OWN}who").groupBy("k0", "label").agg(F.min(f"{OWN}who").alias(f"{OWN}who"))
    runs = runs.withColumn("k0", F.col(f"{KEY}.k0")).join(who, ["k0", "label"], "left")
    return runs.withColumn("label", F.coalesce(f"{OWN}who", "label")).drop(f"{OWN}who", "k0")
