"""Document quality: hierarchical empirical Bayes over sites, with a classifier's evidence for each document.

A document's evidence is the probability that a logistic regression on its text gives.  Sites are hosts
and paths on them; evidence sums by path and by host, in grouped aggregations that combine where rows are
read.  Paths' rates are taken to come from a beta distribution around their host's rate, and hosts' rates
from one around the global rate; how narrow these are is fitted to how much the rates differ (method of moments).
So a site with few documents is close to what is above it, and one with many speaks for itself.  A
document's posterior odds are its evidence times its site's odds over the global ones.

Edge cases: a null or empty text has its own evidence like any other; a null site is a site; repeated
rows count each time; without labels evidence is 0.5; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, look_up, remainder

#: Labelled rows that the classifier is fitted on, at most.
LABELLED = 20_000
#: How much of a site's log-odds moves a document's.
SITE_WEIGHT = 0.5
#: Evidence is kept this far from certainty, so that no document outvotes its site without end.
CLIP = 0.001

_word = re.compile(r"\S+")


def held_out():
    return F.coalesce(remainder(5) == 0, F.lit(False))


def features(text: str) -> list[float]:
    """Shares of characters, words and lines that tell prose from junk."""
    n = max(1, len(text))
    words = _word.findall(text)
    m = max(1, len(words))
    letters = sum(map(str.isalpha, text))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    ends = sum(w[-1] in ".,;:" for w in words)
    marks = sum(len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum() for w in words)
    return [
        np.log(n),
        letters / n,
        sum(map(str.isupper, text)) / max(1, letters),
        sum(map(str.isdigit, text)) / n,
        sum(not (c.isalnum() or c.isspace() or c in ".,;:'\"-()") for c in text) / n,
        letters / m / 10,
        len(counts) / m,
        max(counts.values(), default=0) / m,
        pairs / m,
        ends / m,
        marks / m,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(not w[0].isalnum() for w in words) / m,
    ]


@dataclass
class Evidence:
    """Logistic regression on standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def wide(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.concatenate([x, x * x, np.ones((len(x), 1))], axis=1)

    def of(self, rows: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(self.wide(rows) @ self.weights, -30, 30)))
        return np.clip(p, CLIP, 1 - CLIP)


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> Evidence:
    """By Newton's method, with a ridge."""
    size = rows.shape[1]
    model = Evidence(rows.mean(axis=0) if len(rows) else np.zeros(size), rows.std(axis=0) + 1e-6 if len(rows) else np.ones(size), np.zeros(2 * size + 1))
    if not len(rows):
        return model
    x = model.wide(rows)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (labels - p) / len(x) - ridge * model.weights)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-6:
            break
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Evidence:
    """The classifier, from at most ``most`` labelled rows that are not held out."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(~held_out())
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # small enough to send, so texts stay where they are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), b.column(1)], ["x", "quality"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id").select("text", "quality")
    got = rows.mapInArrow(run, "x array<double>, quality int").collect()
    size = len(features(""))
    return fit(np.array([r["x"] for r in got], float).reshape(-1, size), np.array([r["quality"] for r in got], float))


def evidence(docs: DataFrame, model: Evidence, host: str, path: str) -> DataFrame:
    """doc_id, host, path, held_out, evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.of(np.array([features(t) for t in b.column(0).to_pylist()], float).reshape(b.num_rows, -1)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p)], ["doc_id", "host", "path", "held_out", "evidence"])

    site = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))  # noqa: E731  null is a site of its own
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id", site(host).alias("host"), site(path).alias("path"), held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, host string, path string, held_out boolean, evidence double")


def concentration(groups: DataFrame, prior: str) -> float:
    """How many documents the level above is worth, by moments: groups (n, good) whose rates vary around ``prior``.

    The sum of squared deviations is what drawing n documents gives, plus what groups differ by.
    """
    rate = F.col("good") / F.col("n")
    spread = F.col(prior) * (1 - F.col(prior))
    r = groups.agg(F.sum(F.col("n") * (rate - F.col(prior)) ** 2).alias("seen"), F.sum(spread).alias("drawn"), F.sum(F.col("n") * spread).alias("scale"), F.count("*").alias("groups")).first()
    if not r["groups"] or not r["scale"]:
        return 1.0
    rho = (r["seen"] - r["drawn"]) / max(r["scale"] - r["drawn"], 1e-9)
    return float(1 / np.clip(rho, 1e-4, 0.5) - 1)


def site_posteriors(rows: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, n, host_rate, path_rate) shrunk towards what is above, and the global rate."""
    paths = cut(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    world = (total[1] + 1.0) / (total[0] + 2.0) if total[0] else 0.5
    hosts = hosts.withColumn("world", F.lit(world))
    k = concentration(hosts, "world")
    hosts = cut(hosts.select("host", ((F.col("good") + F.lit(k * world)) / (F.col("n") + F.lit(k))).alias("host_rate")))
    paths = cut(paths.join(hosts, "host"))
    k = concentration(paths, "host_rate")
    return paths.select("host", "path", "n", "host_rate", ((F.col("good") + F.lit(k) * F.col("host_rate")) / (F.col("n") + F.lit(k))).alias("path_rate")), world


def classify(docs: DataFrame, model: Evidence, host: str = "host", path: str = "path", site_weight: float = SITE_WEIGHT) -> DataFrame:
    """One row per document: doc_id, held_out, evidence, host_rate, path_rate, score, predicted."""
    rows = cut(evidence(docs, model, host, path))
    sites, world = site_posteriors(rows)
    sites = cut(sites.select(F.concat_ws("\u0001", "host", "path").alias("site"), "n", "host_rate", "path_rate"))
    rows = rows.select("doc_id", "held_out", "evidence", F.concat_ws("\u0001", "host", "path").alias("site"))
    out = look_up(rows, sites, "site", "n")
    odds = lambda p: F.log(p / (1 - p))
    moved = odds(F.col("evidence")) + F.lit(site_weight) * (odds(F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), F.col("path_rate")))) - odds(F.lit(world)))
    out = out.withColumn("score", 1 / (1 + F.exp(-moved)))
    return out.select("doc_id", "held_out", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
