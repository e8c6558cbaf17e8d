"""Scores of abusive, hateful and sexual content for every document, and rates per source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloom.llm.content_model import KINDS, WINDOW, inputs, load, vectors, window_scores, windows_of
from streamloom.llm.content_text import Vocabulary
from streamloom.operators.shared import require_columns

#: A kind counts as found from this score on; characters of texts scored at once.
FOUND = 0.5
CHARS_AT_ONCE = 1_500_000


class Scorer:
    """Scores texts; keeps the input products of the words it has met."""

    def __init__(self) -> None:
        self.p = load()
        self.vocabulary = Vocabulary()
        self.gates = inputs(self.p, np.zeros((0, self.p["Wf"].shape[0]), np.float32))

    def _grow(self) -> None:
        known = len(self.gates[0])
        fresh = self.vocabulary.words[known:]
        if fresh:
            f, b = inputs(self.p, vectors(self.p, fresh))
            self.gates = np.concatenate([self.gates[0], f]), np.concatenate([self.gates[1], b])

    def score(self, texts: list[str | None]) -> np.ndarray:
        """(texts, kinds): the highest score of a text's windows; 0 for texts without words."""
        if len(self.vocabulary.words) > self.vocabulary.most:
            self.__init__()
        coded = [self.vocabulary.encode(t) for t in texts]
        self._grow()
        sizes = np.array([len(c) for c in coded], np.int64)
        out = np.zeros((len(texts), len(KINDS)), np.float32)
        begin, text = windows_of(sizes)
        if not len(begin):
            return out
        flat = np.concatenate([*coded, np.full(WINDOW, -1, np.int64)])
        rows = flat[begin[:, None] + np.arange(WINDOW)]
        short = sizes[text] < WINDOW
        rows[short] = np.where(np.arange(WINDOW) < sizes[text[short]][:, None], rows[short], -1)
        scores = np.empty((len(rows), len(KINDS)), np.float32)
        for part in (np.flatnonzero(~short), np.flatnonzero(short)):
            if len(part):
                scores[part] = window_scores(self.p, self.gates, rows[part])
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        out[text[first]] = np.maximum.reduceat(scores, first)
        return out


def score_content(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: key, the columns of `keep`, and a score from 0 to 1 for each kind.

    All overlapping windows of the whole text are scored; a document's score is its
    highest. Null, empty and wordless texts score 0. Null keys and repeated rows
    are kept as they are. Columns not named aren't read.
    """
    keep = keep or []
    require_columns(documents, [key, text, *keep], "score_content")
    rows = documents.select(F.struct(F.col(key).alias("k"), *[F.col(c).alias(f"c{n}") for n, c in enumerate(keep)]).alias("row"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer()
        for batch in batches:
            texts = batch["t"].to_pylist()
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars < CHARS_AT_ONCE):
                    chars += len(texts[b] or "")
                    b += 1
                got = scorer.score(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch["row"].slice(a, b - a), *[pa.array(got[:, n].astype(np.float64)) for n in range(len(KINDS))]], ["row", *KINDS])
                a = b

    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{k} double" for k in KINDS)
    out = rows.mapInArrow(run, schema)
    return out.select(F.col("row.k").alias(key), *[F.col(f"row.c{n}").alias(c) for n, c in enumerate(keep)], *KINDS)


def canonical_source(source: Column) -> Column:
    """A source's name in lower case with single underscores; "unknown" for null and blank."""
    s = F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_")
    return F.when(F.coalesce(s, F.lit("")) == "", "unknown").otherwise(s)


def found_kinds(scores: DataFrame, key: str = "doc_id", threshold: float = FOUND) -> DataFrame:
    """(key, kind, score): one row per document and kind whose score reaches the threshold."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("score")) for k in KINDS]))
    return scores.select(key, kinds.alias("x")).where(F.col("x.score") >= threshold).select(key, "x.kind", "x.score")


def rates(scores: DataFrame, source: str = "source", threshold: float = FOUND) -> DataFrame:
    """Per canonical source: documents, and for each kind their number and rate, and of any kind."""
    hit = {k: (F.col(k) >= threshold).cast("long") for k in KINDS}
    any_kind = F.greatest(*[F.col(k) for k in KINDS]) >= threshold
    out = scores.groupBy(canonical_source(F.col(source)).alias("source")).agg(
        F.count("*").alias("n_docs"), *[F.sum(h).alias(f"n_{k}") for k, h in hit.items()], F.sum(any_kind.cast("long")).alias("n_any")
    )
    return out.select("*", *[F.round(F.col(f"n_{k}") / F.col("n_docs"), 6).alias(f"rate_{k}") for k in (*KINDS, "any")])
