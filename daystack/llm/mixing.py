"""Mixing sources to target weights: subset-sum budget fitting.

Each source's target comes from its weight, a share of all words and a cap on repeats.  Whole rounds
of a source come first; what is left of its target is met exactly, or as close below as any choice comes,
by choosing how many documents of each size get one round more: a bounded knapsack over the counts of
sizes, of which large budgets first take shares.  Seeded hashes say which documents of a size these are.

Edge cases: texts of any length are counted whole; a null text has size 0; a null source is a source of its own, after all others; a source
without words has target 0; documents of equal size are told apart by seed, then by doc_id, so reruns
agree; rows that share a doc_id are mixed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, look_up, rank_rows, texts, unused

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix's words as a share of all words, and the most that a source, and a document, may repeat.
SHARE, MOST = 1.5, 2
#: The knapsack first looks at this many sums; where none is the budget, at twice as many, until it would hold so many bits.
KNAPSACK, MOST_BITS = 1 << 17, 1 << 31
#: Numbers that the knapsack holds for a length, about: powers of two up to how many fit.
STEPS = 12


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words between ASCII white space, of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(t.encode().split()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], ["doc_id", "source", "size"])

    return texts(docs, F.col("source").cast("string").alias("source")).mapInArrow(run, "doc_id long, source string, size long")


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``by_source`` (no, source_size, ...) with each source's target; only sums reach the driver."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    out = by_source.withColumn("_weight", weight)
    cap = F.col("source_size") * F.lit(float(most))
    total = out.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while True:  # the level rises as sources reach their caps, at most once for each
        full = F.col("_weight") * F.lit(level) >= cap
        r = out.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"), F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("free"), F.count_if(full).alias("n")).first()
        if r["n"] == above or not r["free"]:
            break
        above, level = r["n"], (share * total - r["capped"]) / r["free"]
    return out.withColumn("target", F.least(F.col("_weight") * F.lit(level), cap)).drop("_weight")


def _knapsack(lengths: np.ndarray, most: np.ndarray, budget: int) -> tuple[np.ndarray, int]:
    """(how many of each length, what they sum to): the largest sum up to ``budget``, by a bit for each sum that can be had."""
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for k, (length, left) in enumerate(zip(lengths.tolist(), most.tolist(), strict=True)):
        left = min(left, budget // length)
        block = 1
        while left > 0 and not reach >> budget & 1:
            n = min(block, left)
            steps.append((k, n, reach))
            reach |= (reach << (n * length)) & mask
            left -= n
            block *= 2
    at = best = reach.bit_length() - 1
    take = np.zeros(len(lengths), np.int64)
    for k, n, before in reversed(steps):
        if not before >> at & 1:
            take[k] += n
            at -= n * int(lengths[k])
    return take, best


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = 0) -> np.ndarray:
    """How many of each length to take so that they sum to ``budget``, or to the most below it that can be had.

    Lengths are positive and distinct.  Large budgets are met in part by shares of all lengths, from
    which enough of each are held back for the knapsack on the rest; it looks at twice the sums until
    it ends on the budget or has held back all that can matter: of an integer solution nearest to the
    shares no more than thrice the largest length differ from them, in units of documents, since else
    some of what is added would weigh as much as some of what is taken away.  Only where that many sums
    of long documents of few lengths would not fit in memory (``MOST_BITS``), it ends with the best it saw.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    if not len(lengths):
        return counts.copy()
    unit = int(np.gcd.reduce(lengths))
    lengths, budget = lengths // unit, max(0, budget) // unit
    total = sum(int(a) * int(n) for a, n in zip(lengths, counts, strict=True))
    if budget >= total:
        return counts.copy()
    order = np.random.default_rng(seed).permutation(len(lengths))
    lengths, counts = lengths[order], counts[order]
    share = np.array([int(n) * budget // total for n in counts], np.int64)
    rest = budget - int((share * lengths).sum())
    for k, length in enumerate(lengths.tolist()):  # each share is short of less than one
        if rest >= length and share[k] < counts[k]:
            share[k] += 1
            rest -= length
    enough = 3 * int(lengths.max()) + 1
    most = MOST_BITS // (STEPS * len(lengths))
    window, best, found = max(1, min(budget, KNAPSACK)), -1, share
    while True:
        hold = np.minimum(np.minimum(window // (len(lengths) * lengths) + 1, enough), share)
        hold[1:][np.cumsum(hold * lengths)[1:] > 2 * window] = 0  # of many lengths, not all
        base = share - hold
        left = budget - int((base * lengths).sum())
        take, got = _knapsack(lengths, counts - base, left)
        if budget - left + got > best:
            best, found = budget - left + got, base + take
        if best == budget or 2 * window > most or (hold >= np.minimum(enough, share)).all():
            break
        window *= 2
    out = np.zeros_like(found)
    out[order] = found
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and copies (rounds of it in the mix)."""
    # a source's name with a mark before it, so that null has a place
    rows = cut(sizes(docs).select("doc_id", "size", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key")))
    by_source = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_source = rank_rows(by_source.withColumn("last", (F.col("key") == "n").cast("int")), [], ["last", "key"], "no").drop("last")
    by_source = cut(targets(by_source, weights, share, most))
    rows = cut(look_up(rows, by_source, "key", "docs", "inner").drop("docs"))
    histogram = rows.where("size > 0").groupBy("no", "size", "source_size", "target").agg(F.count("*").alias("docs"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        whole, goal = int(pdf["source_size"][0]), round(float(pdf["target"][0]))
        base = min(most, goal // whole)
        take = fit(pdf["size"].to_numpy(), pdf["docs"].to_numpy(), goal - base * whole, seed) if base < most else np.zeros(len(pdf), np.int64)
        return pd.DataFrame({"group": pdf["no"].astype(str) + "/" + pdf["size"].astype(str), "docs": pdf["docs"], "base": base, "take": take})

    chosen = cut(histogram.groupBy("no").applyInPandas(choose, "group string, docs long, base long, take long"))
    ranked = rank_rows(rows.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id")), ["no", "size"], ["_hash", "doc_id"])
    ranked = ranked.withColumn("group", F.concat_ws("/", "no", "size"))
    copies = F.coalesce(F.col("base") + (F.col("rank") < F.col("take")).cast("long"), F.lit(0))
    out = look_up(ranked, chosen, "group", "docs").withColumn("copies", copies)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: ``docs`` with all their columns, each as often as the mix takes it.

    A document without words, empty or null, is in no one's way and stays once.  Rows that share a doc_id
    get the rounds of one of them.  Columns may have any names.
    """
    doc, copies = unused(docs, "_doc"), unused(docs, "_copies")
    plan = mix(docs, **how).groupBy("doc_id").agg(F.max(F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))).alias(copies))
    plan = plan.where(F.col(copies) > 0).withColumnRenamed("doc_id", doc)
    out = docs.join(plan, docs["doc_id"].eqNullSafe(plan[doc]))
    return out.select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(1), plan[copies].cast("int"))).alias(unused(docs, "_round"))).select(*docs.columns)
