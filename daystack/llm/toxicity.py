"""Toxicity by weak supervision.

Voters look for words of a lexicon and for patterns (word beginnings that, among labelled rows, are as
frequent in toxic texts alone); one fires where its words are at least a set share of a text's words.  A generative label model learns, from how the votes on all training rows
fall together, how often each voter fires on toxic and on other texts (by expectation maximisation,
two latent classes) and which voters depend on each other beyond that (by what is left of their
covariance within the classes); dependent voters share their weight.  Its posteriors are the labels that a linear
classifier on hashed words and word beginnings is trained on; scores are the classifier's.

Rows that are held out are never looked at in training.  Votes are counted over all other rows; patterns
and the classifier are fitted on bounded samples of them.

Edge cases: a null or empty text has no features and gets the classifier's score for none; texts of any
length are read whole; a row with a null doc_id is not held out, its votes count, and the classifier is
not fitted on it; repeated rows repeat, and equal texts have equal scores; a doc_id with several labels is
toxic if any says so; without toxic labels the lexicon alone votes; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, remainder, texts

#: Insults by kind, one voter each.
LEXICON = {
    "person": ("idiot", "moron", "imbecile", "loser", "clown", "fool", "dumbass", "jerk"),
    "worth": ("pathetic", "worthless", "useless", "disgusting", "vile", "repulsive"),
    "mind": ("stupid", "dumb", "braindead", "retarded", "clueless"),
    "refuse": ("scum", "trash", "garbage", "filth", "vermin", "parasite"),
    "threat": ("kill", "murder", "hate", "rape", "lynch"),
}
#: Letters of word beginnings; the share of a text's words from which a voter fires.
STEMS, LEAST = (3, 4, 5, 6, 7), 0.006
#: Most patterns, most labelled rows they are found in, and rows whose features the classifier is trained on.
PATTERNS, LABELLED, SAMPLE = 40, 20_000, 8_000
#: How many rows a labelled one counts for in the label model, and its most rounds.
KNOWN, ROUNDS = 5.0, 40
#: Parts that vote patterns are dealt to; a round is one job with so many tasks.
PARTS = 32
#: Lengths of word beginnings that are features; a feature is 1 from this share of a text's words on.
FEATURE_STEMS, FULL = (3, 5, 7), 0.015
#: Hashed features, passes and rate of the classifier.
BUCKETS, PASSES, RATE, DECAY = 1 << 17, 10, 0.5, 1e-6

_letters = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter[str]:
    return Counter(_letters.findall(text.lower()))


def stems_of(words: Counter[str], lengths: tuple[int, ...]) -> Counter[str]:
    """Beginnings of words that go on after them, with how many words have them."""
    out: Counter[str] = Counter()
    for w, n in words.items():
        for k in lengths:
            if len(w) <= k:
                break
            out[w[:k]] += n
    return out


def held_out():
    return F.coalesce(remainder(5) == 0, F.lit(False))


# ---------------------------------------------------------------- voters


@dataclass
class Voters:
    """``stems`` vote one by one, after the lexicon's kinds."""

    stems: list[str]

    def __post_init__(self) -> None:
        self.by_word = {w: k for k, words in enumerate(LEXICON.values()) for w in words}
        self.by_stem = {s: len(LEXICON) + k for k, s in enumerate(self.stems)}
        self.lengths = tuple(sorted({len(s) for s in self.stems}))

    @property
    def number(self) -> int:
        return len(LEXICON) + len(self.stems)

    @property
    def size(self) -> int:
        """Bytes that hold a text's votes."""
        return self.number // 8 + 1

    def table(self, votes: list[bytes]) -> np.ndarray:
        """(row, voter) of 0 and 1."""
        bits = np.frombuffer(b"".join(votes), np.uint8).reshape(len(votes), self.size)
        return np.unpackbits(bits, axis=1, bitorder="little")[:, : self.number].astype(float)

    def votes(self, words: Counter[str]) -> int:
        """A bit for each voter that fires."""
        seen = [0] * self.number
        for w in words.keys() & self.by_word.keys():
            seen[self.by_word[w]] += words[w]
        for w, n in words.items() if self.stems else ():
            for k in self.lengths:
                if len(w) <= k:
                    break
                if (v := self.by_stem.get(w[:k])) is not None:
                    seen[v] += n
        least = max(1, LEAST * words.total())
        return sum(1 << k for k, n in enumerate(seen) if n >= least)


def stem_counts(labelled: DataFrame) -> DataFrame:
    """stem, toxic, clean: in how many rows (text, toxic) of either kind each beginning is frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                least = max(1, LEAST * words.total())
                seen[toxic].update(s for s, n in stems_of(words, STEMS).items() if n >= least)
            stems = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([seen[1][s] for s in stems], pa.int64()), pa.array([seen[0][s] for s in stems], pa.int64())], ["stem", "toxic", "clean"])

    found = labelled.select("text", "toxic").mapInArrow(run, "stem string, toxic long, clean long")
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def find_stems(counts: DataFrame, n: tuple[int, int], most: int = PATTERNS) -> list[str]:
    """Beginnings that are frequent in toxic rows too often for chance, and in others hardly ever; ``n``: clean and toxic rows.

    Only those that pass come to the driver, the best of them first, and a bounded number.
    """
    if not n[1]:
        return []
    chance = float(np.log10(sum(n) / n[1]))
    least = 2 + float(np.log10(1 + counts.where("toxic > 0").count()))
    passed = counts.where((F.col("clean") <= 0.1 * F.col("toxic")) & ((F.col("toxic") - 5 * F.col("clean")) * chance >= least))
    best = passed.orderBy(F.desc("toxic"), F.desc(F.length("stem")), "stem").limit(100 * most).collect()
    lexicon = {w for words in LEXICON.values() for w in words}
    out: list[str] = []
    for s in (r["stem"] for r in best):
        if len(out) < most and not any(w.startswith(s) for w in lexicon) and not any(s.startswith(x) or x.startswith(s) for x in out):
            out.append(s)
    return out


# ---------------------------------------------------------------- the label model


@dataclass
class LabelModel:
    prior: float
    fires: np.ndarray  # (class, voter): how often each fires
    share: np.ndarray  # what each voter's evidence counts, given those that depend on it
    none: np.ndarray  # (class): how often no voter fires

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """votes: (row, voter) of 0 and 1.  A voter that doesn't fire abstains; only silence of all is evidence."""
        p, none = np.clip(self.fires, 1e-6, 1 - 1e-6), np.clip(self.none, 1e-6, 1 - 1e-6)
        odds = np.where(votes.any(axis=1), (votes * np.log(p[1] / p[0])) @ self.share, np.log(none[1] / none[0]))
        return np.log(self.prior / (1 - self.prior)) + odds


@dataclass
class Moments:
    """Sums over rows, by class: rows, votes, votes that meet, and rows without any; all that a round of estimation needs."""

    rows: np.ndarray  # (class)
    votes: np.ndarray  # (class, voter)
    meet: np.ndarray  # (class, voter, voter)
    silent: np.ndarray  # (class)

    @classmethod
    def none(cls, voters: int) -> Moments:
        return cls(np.zeros(2), np.zeros((2, voters)), np.zeros((2, voters, voters)), np.zeros(2))

    @classmethod
    def of(cls, votes: np.ndarray, by: np.ndarray) -> Moments:
        """votes: (pattern, voter); by: (class, pattern), how many rows of each class have it."""
        return cls(by.sum(axis=1), by @ votes, np.stack([(votes * c[:, None]).T @ votes for c in by]), by @ ~votes.any(axis=1))

    def __add__(self, o: Moments) -> Moments:
        return Moments(self.rows + o.rows, self.votes + o.votes, self.meet + o.meet, self.silent + o.silent)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.rows, self.votes.ravel(), self.meet.ravel(), self.silent])

    @classmethod
    def from_flat(cls, x: np.ndarray, voters: int) -> Moments:
        rows, votes, meet, silent = np.split(x, np.cumsum([2, 2 * voters, 2 * voters * voters]))
        return cls(rows, votes.reshape(2, voters), meet.reshape(2, voters, voters), silent)


def expected(votes: np.ndarray, weight: np.ndarray, model: LabelModel | None) -> Moments:
    """The moments that ``model`` expects of patterns with so many rows; without one, a row with a vote is likely toxic."""
    toxic = np.where(votes.any(axis=1), 0.95, 0.02) if model is None else 1 / (1 + np.exp(-np.clip(model.log_odds(votes), -50, 50)))
    return Moments.of(votes, np.stack([weight * (1 - toxic), weight * toxic]))


def fit_labels(expect: Callable[[LabelModel | None], Moments], voters: int, prior: float, known: Moments | None = None, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation; ``expect`` gives the moments of all rows under a model.

    Rows whose class is ``known`` keep it and count ``KNOWN`` times: voters for different languages never
    fire together, so it takes these to tell that they vote for the same.  From the middle on, each
    round estimates anew which voters are correlated within the classes: those whose covariance there is more
    than noise share their weight, in proportion to how strong their correlation is.
    """
    known = known or Moments.none(voters)
    model, before = None, None
    for k in range(rounds):
        by = expect(model)
        size = by.rows + KNOWN * known.rows
        # a voter that never fires has still been asked; half a row stands for what was not seen
        fires = (by.votes + KNOWN * known.votes + np.array([[0.01], [0.5]])) / (size[:, None] + 1)
        none = (by.silent + KNOWN * known.silent + [0.5, 0.1]) / (size + 1)
        share = _shares(by, fires) if k >= rounds // 2 else np.ones(voters)
        model = LabelModel(float(np.clip((size[1] + prior) / (size.sum() + 1), 1e-4, 0.5)), fires, share, none)
        now = np.concatenate([fires.ravel(), share, none, [model.prior]])
        if k > rounds // 2 and np.abs(now - before).max() < 1e-6:
            break
        before = now
    return model


def _shares(by: Moments, fires: np.ndarray) -> np.ndarray:
    """1 over 1 plus the squared correlations that are left within the classes and above noise."""
    cross = by.votes[:, :, None] * fires[:, None, :]
    cov = (by.meet - cross - cross.transpose(0, 2, 1) + by.rows[:, None, None] * fires[:, :, None] * fires[:, None, :]).sum(axis=0)
    var = np.diag(cov)
    corr = cov / np.sqrt(np.maximum(np.outer(var, var), 1e-12))
    np.fill_diagonal(corr, 0)
    corr[np.abs(corr) < 3 / np.sqrt(max(1.0, by.rows.sum()))] = 0
    return 1 / (1 + (np.maximum(corr, 0) ** 2).sum(axis=1))


# ---------------------------------------------------------------- the classifier


_features: dict[str, tuple[int, ...]] = {}


def features(words: Counter[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and beginnings, and their values."""
    if len(_features) > 200_000:
        _features.clear()
    total: Counter[int] = Counter()
    for w, n in words.items():
        if (f := _features.get(w)) is None:
            f = _features[w] = tuple(zlib.crc32(x.encode()) % BUCKETS for x in (w, *["^" + w[:k] for k in FEATURE_STEMS if len(w) > k]))
        for x in f:
            total[x] += n
    full = max(1.0, FULL * words.total())
    keys = np.fromiter(total.keys(), np.int64, len(total))
    return keys, np.minimum(1.0, np.fromiter(total.values(), float, len(total)) / full)


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def score(self, words: Counter[str]) -> float:
        f, x = features(words)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[f] @ x, -50, 50))))


def fit_linear(feats: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Linear:
    """Logistic regression on soft labels; both classes weigh the same, so rare toxic rows count."""
    weigh = y / max(y.sum(), 1e-9) + (1 - y) / max((1 - y).sum(), 1e-9)
    weigh *= len(y) / max(weigh.sum(), 1e-9)
    w, b, seen, rng = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-2), np.random.default_rng(seed)
    seen_b = 1e-2
    for _ in range(PASSES):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 32):
            part = order[at : at + 32]
            own = np.repeat(np.arange(len(part)), [len(feats[k]) for k in part])
            f = np.concatenate([feats[k] for k in part]) if len(own) else np.zeros(0, np.int64)
            x = np.concatenate([values[k] for k in part]) if len(own) else np.zeros(0)
            margin = b + np.bincount(own, w[f] * x, len(part))
            error = weigh[part] * (y[part] - 1 / (1 + np.exp(-np.clip(margin, -50, 50)))) / len(part)
            unique, where = np.unique(f, return_inverse=True)
            g = np.bincount(where, error[own] * x, len(unique)) - DECAY * w[unique]
            seen[unique] += g * g
            w[unique] += RATE * g / np.sqrt(seen[unique])
            seen_b += error.sum() ** 2
            b += RATE * error.sum() / np.sqrt(seen_b)
    return Linear(w.astype(np.float32), float(b))


# ---------------------------------------------------------------- the operator


def vote_counts(rows: DataFrame, voters: Voters) -> DataFrame:
    """votes, class, rows: the distinct vote patterns of a table of (text, class), counted where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = Counter((voters.votes(words_of(t)), c) for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([v.to_bytes(voters.size, "little") for v, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int32()), pa.array(list(found.values()), pa.int64())], ["votes", "class", "n"])

    return rows.mapInArrow(run, "votes binary, class int, n long").groupBy("votes", "class").agg(F.sum("n").alias("n"))


def summed(counts: DataFrame, voters: Voters, weigh: Callable[[np.ndarray, np.ndarray, np.ndarray], Moments]) -> Moments:
    """``weigh(votes, class, rows)`` summed over a table of patterns where it lies; the driver gets one row of moments a task.

    ``counts`` should lie in a bounded number of parts, as a task reads its part batch by batch and each sends voters squared numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments.none(voters.number)
        for b in batches:
            total += weigh(voters.table(b.column(0).to_pylist()), b.column(1).to_numpy(), b.column(2).to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.flat().tobytes()], pa.binary())], ["m"])

    total = Moments.none(voters.number)
    for r in counts.mapInArrow(run, "m binary").collect():  # one job, and PARTS rows
        total += Moments.from_flat(np.frombuffer(bytes(r["m"])), voters.number)
    return total


def sampled(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """About ``most`` rows, by a hash of the id; rows without one would all be in or all be out, and are out."""
    rows = rows.where("doc_id is not null")
    share = min(1.0, most / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < share * 1_000_000)


def training_rows(rows: DataFrame, voters: Voters) -> DataFrame:
    """doc_id, features, values (in 255ths) and votes of the rows' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                votes = voters.votes(words)
                f, x = features(words)
                out.append((doc_id, f.astype("<i4").tobytes(), np.rint(255 * x).astype(np.uint8).tobytes(), votes.to_bytes(voters.size, "little")))
            if out:
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "f", "x", "votes"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, f binary, x binary, votes binary")


@dataclass
class Trained:
    voters: Voters
    labels: LabelModel
    linear: Linear


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED, sample: int = SAMPLE) -> Trained:
    """The three models, from the rows of ``docs`` that are not held out.

    Votes are counted over all of them, stems over the labelled ones (at most ``labelled_rows``, by a hash
    of the id); the classifier is fitted on the features of a sample and of about as many labelled toxic
    rows at most.
    """
    rows = texts(docs).where(~held_out())
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    # at most ``labelled_rows`` numbers: small enough to send, and texts stay where they are
    known = known.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(labelled_rows)
    labelled = rows.join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")
    n = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n = (n.get(0, 0), n.get(1, 0))
    voters = Voters(find_stems(cut(stem_counts(labelled)), n))
    prior = float(np.clip(n[1] / max(1, sum(n)), 0.001, 0.5)) if n[1] else 0.05
    # each pattern's rows are in one task, in a fixed order; there they stay
    counts = cut(vote_counts(rows.select("text", F.lit(0).alias("class")), voters).repartition(PARTS, "votes").sortWithinPartitions("votes"))
    known = summed(vote_counts(labelled.select("text", "toxic"), voters).repartition(PARTS, "votes").sortWithinPartitions("votes", "class"), voters, lambda v, c, n: Moments.of(v, np.stack([n * (c == 0), n * (c == 1)])))
    model = fit_labels(lambda m: summed(counts, voters, lambda v, _, n: expected(v, n, m)), voters.number, prior, known)
    picked = sampled(rows, sample, 2).select("doc_id", "text").unionByName(sampled(labelled.where("toxic = 1"), sample, 3).select("doc_id", "text"))
    got = sorted((r["doc_id"] or 0, bytes(r["f"]), bytes(r["x"]), bytes(r["votes"])) for r in training_rows(picked, voters).toLocalIterator())
    if not got:
        return Trained(voters, model, Linear(np.zeros(BUCKETS, np.float32), -5.0))
    odds = model.log_odds(voters.table([v for *_, v in got]))
    feats, values = [np.frombuffer(f, "<i4") for _, f, _, _ in got], [np.frombuffer(x, np.uint8) / np.float32(255) for _, _, x, _ in got]
    return Trained(voters, model, fit_linear(feats, values, 1 / (1 + np.exp(-np.clip(odds, -50, 50)))))


def score(docs: DataFrame, model: Trained) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array([model.linear.score(w) for w in map(words_of, b.column(1).to_pylist())], float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return texts(docs).withColumn("held_out", held_out()).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
