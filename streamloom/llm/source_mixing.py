"""Mixing sources to target weights, in tokens of a public tokenizer.

Two plans. `mixing_plan` comes as near to given target shares as the repetition caps
allow: sources that would go over their cap in proportion to the targets are held at
it, the others share the rest in proportion. `temperature_plan` needs no targets: it
exponentiates the sources' own token shares, p^a, and bisects the exponent to a given
entropy, or to the flattest mix in which no source is repeated more often than its cap.

A weight is realised by whole epochs and one part of an epoch. Every epoch is a
permutation of blocks of documents; the part takes blocks in that order up to its
budget of tokens and cuts only the last block, document by document, where it comes nearest. Blocks are
summed before anything is ordered, so no source is ever sorted as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamloom.llm.content_scores import canonical_source
from streamloom.operators.shared import require_columns, write_and_read

#: The public tokenizer's rank file, a path that every executor has; blocks a source is cut into; most sources a target table may have.
TOKENIZER, BLOCKS, MOST_SOURCES = "/opt/tokenizers/byte_bpe_50k.tiktoken", 512, 100_000
# -- fixed value: the public tokenizer's pattern that splits text before the merges --
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# ----------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import base64
    from pathlib import Path

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(Path(path).stem, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: DataFrame, text: str = "text", out: str = "n_tokens", tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """All columns of `texts` but the text, and the number of its tokens; 0 for null and empty texts."""
    keep = [c for c in texts.columns if c != text]
    rows = texts.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoder(tokenizer, pattern).encode_to_numpy
        for batch in batches:
            n = [len(count(t, disallowed_special=())) if t else 0 for t in batch["t"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(n, pa.int64())], ["row", "n"])

    counted = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n long")
    return counted.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("n").alias(out))


def _bisected(low: float, high: float, ok, steps: int = 60) -> float:
    """The largest value in [low, high] with ok(value), given ok(low) and that ok only ever turns false."""
    if ok(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if ok(mid) else (low, mid)
    return low


def tempered(shares: dict[str, float], a: float) -> dict[str, float]:
    """Weights in proportion to share^a; sources without a share get none."""
    top = max(shares.values(), default=0)
    w = {s: math.exp(a * math.log(p / top)) if p > 0 else 0.0 for s, p in shares.items()}
    total = sum(w.values())
    return {s: x / total if total else 0.0 for s, x in w.items()}


def entropy(weights: dict[str, float]) -> float:
    """In nats."""
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def temperature_plan(tokens: dict[str, int], caps: dict[str, int], total: int | None = None, nats: float | None = None) -> tuple[float, dict[str, float]]:
    """(exponent, tokens each source contributes): weights in proportion to share^a, a from 0 (all alike) to 1 (as they are).

    With `nats` the exponent at which the weights have that entropy, or the nearest the caps
    allow; without it the least exponent that repeats no source more often than its cap.
    At 1 every source is repeated total / all tokens times; where that is over a cap already the
    plan is smaller: at most `total` times the scale that fits. Sources without tokens or with a
    cap below 1 contribute none.
    """
    live = {s: n for s, n in tokens.items() if n > 0 and caps.get(s, 0) >= 1}
    if not live:
        return 1.0, {s: 0.0 for s in tokens}
    everything = sum(live.values())
    size = float(everything if total is None else total)
    size = min(size, min(caps[s] for s in live) * everything)
    shares = {s: n / everything for s, n in live.items()}
    fits = lambda a: all(w * size <= caps[s] * live[s] * (1 + 1e-12) for s, w in tempered(shares, a).items())
    flattest = 1 - _bisected(0.0, 1.0, lambda d: fits(1 - d))  # a source's repeats only grow as the exponent falls, or stay below 1
    a = flattest
    if nats is not None:
        a = max(flattest, _bisected(0.0, 1.0, lambda x: entropy(tempered(shares, x)) >= nats) if entropy(tempered(shares, 0.0)) >= nats else 0.0)
    return a, {s: 0.0 for s in tokens} | {s: w * size for s, w in tempered(shares, a).items()}


def mixing_plan(tokens: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, float]:
    """Tokens each source contributes; `targets` gives share and cap; `total` defaults to all tokens of sources with a target.

    No mix of that size is nearer to the targets: held sources stand at their caps and would get
    more in proportion, all others have one ratio of tokens to target. Sources without tokens, without
    target or with a cap below 1 contribute none. A size the caps can't fill is not reached.
    """
    live = {s for s, (t, cap) in targets.items() if t > 0 and cap >= 1 and tokens.get(s, 0) > 0}
    most = {s: float(targets[s][1]) * tokens[s] for s in live}
    left = float(total if total is not None else sum(tokens[s] for s in live))
    share = sum(targets[s][0] for s in live)
    out = {s: 0.0 for s in targets}
    # In order of the rate at which they reach their caps: as others are held, the rate of the rest only rises.
    for s in sorted(live, key=lambda s: (most[s] / targets[s][0], s)):
        out[s] = min(most[s], left * targets[s][0] / share)
        left -= out[s]
        share -= targets[s][0]
    return out


def mix_sources(
    documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    total: int | None = None, seed: int = 1, tokenizer: str = TOKENIZER, blocks: int = BLOCKS, pattern: str = PATTERN, temperature: bool = False, nats: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The mixed corpus and the report of its shares.

    temperature: weights are powers of the sources' own shares (temperature_plan, `nats` its entropy) instead
    of as near to target_share as the caps allow (mixing_plan); the targets then only tell which sources and caps there are.

    documents: (key, text, source); sources are compared in canonical spelling, null
    is "unknown". targets: (source, target_share, max_repeat), one row per source; a
    null share or cap counts as none; more than MOST_SOURCES rows are refused. Texts without tokens and sources without a
    target are left out. Repeated rows are documents of their own. Empty tables give
    an empty corpus. Other columns are not read.
    Corpus: key, source, n_tokens, epoch (from 0), block, place (order in the epoch's
    block). Report: a row per target with tokens there are, planned and mixed, the
    repeats and the actual share (null if nothing is mixed).
    """
    require_columns(documents, [key, text, source], "mix_sources, documents")
    require_columns(targets, ["source", "target_share", "max_repeat"], "mix_sources, targets")
    spark = documents.sparkSession
    wanted = targets.select(canonical_source(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeat", F.lit(0)).alias("cap"))
    wanted = wanted.groupBy("source").agg(F.max("share").alias("share"), F.max("cap").alias("cap"))
    rows = wanted.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"mix_sources: more than {MOST_SOURCES} target sources")
    by = {r.source: (float(r.share), int(r.cap)) for r in rows}

    docs = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), canonical_source(F.col(source)).alias("source"))
    docs = docs.join(F.broadcast(spark.createDataFrame([(s,) for s in by], "source string")), "source", "left_semi")  # at most MOST_SOURCES names
    counted = write_and_read(count_tokens(docs, "t", "n_tokens", tokenizer, pattern).where(F.col("n_tokens") > 0), "token-counts")
    there = {r.source: r.n for r in counted.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    plan = temperature_plan({s: there.get(s, 0) for s in by}, {s: cap for s, (_, cap) in by.items()}, total, nats)[1] if temperature else mixing_plan(there, by, total)

    epochs, part = {}, {}
    for s, budget in plan.items():
        n = there.get(s, 0)
        full = int(budget // n) if n else 0
        if n and budget - full * n > n - 0.5:  # a whole epoch but for rounding
            full += 1
        epochs[s], part[s] = full, int(round(max(0.0, budget - full * n))) if n else 0
    facts = spark.createDataFrame([(s, *by[s], int(there.get(s, 0)), float(plan[s]), epochs[s], part[s]) for s in sorted(by)], "source string, target_share double, max_repeat int, n_tokens_there long, planned double, epochs int, part long")
    facts_small = F.broadcast(facts.select("source", "epochs", "part"))  # at most MOST_SOURCES rows

    def placed(df: DataFrame, epoch) -> DataFrame:
        h = F.xxhash64("k", epoch, F.lit(seed))
        return df.withColumn("place", h).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), h), F.lit(blocks)).cast("int"))

    with_plan = counted.join(facts_small, "source")
    whole = with_plan.where(F.col("epochs") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
    whole = placed(whole, F.col("epoch"))
    last = placed(with_plan.where(F.col("part") > 0).withColumn("epoch", F.col("epochs")), F.col("epoch"))
    # The block of the last epoch in which the budget ends: one row a source, none where the epoch fits.
    sums = last.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"), F.first("part").alias("part"))
    before = F.sum("in_block").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(before, F.lit(0)))
    ends = sums.where((F.col("before") < F.col("part")) & (F.col("before") + F.col("in_block") > F.col("part"))).select("source", F.col("block").alias("end_block"), "before")
    last = last.join(F.broadcast(ends), "source", "left")  # at most MOST_SOURCES rows
    inside = last.where(F.col("end_block").isNull() | (F.col("block") < F.col("end_block")))
    running = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("place", "k", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = last.where(F.col("block") == F.col("end_block")).withColumn("upto", F.col("before") + running)
    # The document in which the budget ends is taken if that brings the sum nearer to it.
    cut = cut.where(F.col("upto") - F.col("part") < F.greatest(F.col("part") - F.col("upto") + F.col("n_tokens"), F.lit(1)))
    cols = ["k", "source", "n_tokens", "epoch", "block", "place"]
    corpus = whole.select(*cols).unionByName(inside.select(*cols)).unionByName(cut.select(*cols))

    mixed = corpus.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_docs"))
    report = facts.join(mixed, "source", "left")
    report = report.withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0))).withColumn("mixed_docs", F.coalesce("mixed_docs", F.lit(0)))
    all_mixed = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0)))  # a row per target source
    report = report.select(
        "source", "target_share", "max_repeat", "n_tokens_there", F.round("planned").cast("long").alias("planned_tokens"), "mixed_docs", "mixed_tokens",
        F.round(F.col("mixed_tokens") / F.when(F.col("n_tokens_there") > 0, F.col("n_tokens_there")), 6).alias("repeats"),
        F.round(F.col("mixed_tokens") / F.when(all_mixed > 0, all_mixed), 6).alias("actual_share"),
    )
    return corpus.withColumnRenamed("k", key), report
