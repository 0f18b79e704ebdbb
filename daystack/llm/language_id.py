"""Language identification of code-switched text with a linear-chain conditional random field.

A text's words (runs of letters, in lower case, of which long ones are cut every ``LETTERS``) are a chain.  Word features are its letter n-grams
with the word's borders (so that affixes are among them), three-letter affixes, and the word itself as
a lexicon entry, all hashed; transitions between languages are learned with them.  Forward-backward
gives each word's posterior, and a text's language is the one with the largest share of them.

Training uses a bounded sample of labelled rows, whole texts: about ``per_language`` of each language
there is, all of those that have fewer, until they come to ``LETTERS_PER_LANGUAGE``.  Some training chains are joined from parts of texts in
several languages, for the transitions.

Edge cases: a text that is null, empty or without letters (digits, superscripts and fractions are none)
is ``und`` with score 0; texts of any length are read whole; ties go to the
language that sorts first; repeated rows repeat; without any labelled row all texts are ``und``; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystack.llm.common import remainder

UNKNOWN = "und"
#: Rows for training: about so many of each language.
PER_LANGUAGE = 300
#: Characters for training of each language: the text that exceeds them is its last.
LETTERS_PER_LANGUAGE = 1_500_000
#: Hashed features; letters of a word: longer runs, as of scripts without spaces, are several words.
BUCKETS, LETTERS = 1 << 15, 24
#: Words that a task remembers, and words that forward-backward takes at once, with up to MANY languages; fewer with more.
REMEMBERED, AT_ONCE, MANY = 300_000, 200_000, 64
#: Training: chains' length, chains a step, passes, rate, and decay.
CHAIN, STEP, PASSES, RATE, DECAY = 48, 48, 2, 0.3, 1e-6

_letters = re.compile(rf"[^\W\d_]{{1,{LETTERS}}}")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    words = _letters.findall(text)
    if text.isascii() or all(map(str.isalpha, words)):
        return words
    # numerals that are neither letters nor decimal digits
    return _letters.findall("".join(c if c.isalpha() else " " for c in text))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all words in a row, word numbers): n-grams of 2 and 3 letters, affixes of 3, the word."""
    marked = [f"^{w}$" for w in words]
    c = np.array(marked, f"U{LETTERS + 2}").reshape(-1, 1).view(np.uint32).reshape(len(words), LETTERS + 2).astype(np.uint64)
    n = (c > 0).sum(axis=1)
    odd = np.uint64(0x9E3779B97F4A7C15)
    rows = np.arange(len(words))
    feats, owners = [], []

    def add(keys: np.ndarray, owner: np.ndarray, kind: int) -> None:
        keys = (keys + np.uint64(kind)) * odd
        feats.append(((keys ^ (keys >> np.uint64(29))) * odd >> np.uint64(40)) % np.uint64(BUCKETS))
        owners.append(owner)

    two = c[:, :-1] * np.uint64(1 << 21) + c[:, 1:]
    three = two[:, :-1] * np.uint64(1 << 21) + c[:, 2:]
    for grams, width in ((two, 2), (three, 3)):
        at = np.arange(grams.shape[1])[None, :] <= (n - width)[:, None]
        add(grams[at], np.broadcast_to(rows[:, None], grams.shape)[at], width)
    long = n >= 5
    first = three[long, 0] * odd + c[long, 3]
    add(first, rows[long], 4)
    last = three[rows[long], n[long] - 4] * odd + c[rows[long], n[long] - 1]
    add(last, rows[long], 5)
    whole = np.zeros(len(words), np.uint64)
    for k in range(LETTERS + 2):
        whole = whole * odd + c[:, k]
    add(whole, rows, 6)
    return np.concatenate(feats).astype(np.int64), np.concatenate(owners)


def posteriors(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains, longest first.

    scores: exp of word scores (chain, time, language); moves: exp of transitions.  Returns posteriors
    (zero where a chain has ended) and forward vectors, each scaled to sum to one.
    """
    chains, times, _ = scores.shape
    active = np.searchsorted(-lengths, -np.arange(1, times + 1), "right")
    forward = np.zeros_like(scores)
    scale = np.ones((chains, times, 1), scores.dtype)
    a = scores[:, 0]
    for t in range(times):
        m = active[t]
        a = scores[:m, t] if t == 0 else (a[:m] @ moves) * scores[:m, t]
        s = a.sum(axis=1, keepdims=True)
        a = a / s
        forward[:m, t], scale[:m, t] = a, s
    out = np.zeros_like(scores)
    back = np.ones((chains, scores.shape[2]), scores.dtype)
    for t in range(times - 1, -1, -1):
        m = active[t]
        if t + 1 < times and (k := active[t + 1]):
            back[:k] = (scores[:k, t + 1] * back[:k] / scale[:k, t + 1]) @ moves.T
        p = forward[:m, t] * back[:m]
        out[:m, t] = p / p.sum(axis=1, keepdims=True)
    return out, forward


@dataclass
class Model:
    """Weights of the field; call it with texts."""

    languages: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def scores(self, words: list[str]) -> np.ndarray:
        """exp of each word's scores, the largest of them 1."""
        feats, owners = word_features(words)
        raw = np.stack([np.bincount(owners, self.weights[feats, k], len(words)) for k in range(len(self.languages))], axis=1)
        return np.exp(raw - raw.max(axis=1, keepdims=True)) + 1e-12

    def shares(self, texts: list[str | None], labels: bool = False) -> list:
        """For each text (None without words) its languages' shares, and how sure its words are on average; or, with ``labels``, its words' languages."""
        languages = max(MANY, len(self.languages))
        if not hasattr(self, "_known") or len(self._known) > REMEMBERED * MANY // languages:
            self._known: dict[str, int] = {}
            self._new: list[str] = []
            self._table = np.zeros((0, len(self.languages)))
        chains: list[np.ndarray | None] = []
        for text in texts:
            words = words_of(text)
            chains.append(self._numbers(words) if words else None)
        self._look_up_new()
        out: list = [None] * len(texts)
        order = sorted((k for k, c in enumerate(chains) if c is not None), key=lambda k: -len(chains[k]))
        at = 0
        while at < len(order):
            longest = len(chains[order[at]])
            part = order[at : at + max(1, min(256, AT_ONCE * MANY // languages // longest))]
            at += len(part)
            lengths = np.array([len(chains[k]) for k in part])
            ids = np.zeros((len(part), longest), np.int64)
            for row, k in enumerate(part):
                ids[row, : lengths[row]] = chains[k]
            post, _ = posteriors(self._table[ids], np.exp(self.moves), lengths)
            for row, k in enumerate(part):
                own = post[row, : lengths[row]]
                out[k] = own.argmax(axis=1) if labels else (own.mean(axis=0), own.max(axis=1).mean())
        return out

    # words get numbers as they come; scores of new ones are computed together
    def _numbers(self, words: list[str]) -> np.ndarray:
        known, new = self._known, self._new
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = len(known)
                    new.append(w)
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _look_up_new(self) -> None:
        parts = [self._table] + [self.scores(self._new[k : k + 20_000]) for k in range(0, len(self._new), 20_000)]
        self._table = np.concatenate(parts)
        self._new.clear()

    def __getstate__(self):
        return {"languages": self.languages, "weights": self.weights, "moves": self.moves}


def fit(rows: list[tuple[str, str]], seed: int = 0) -> Model:
    """The field that maximises the likelihood of (text, language) rows' chains, by adaptive gradient steps."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([])
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    chains: list[tuple[np.ndarray, np.ndarray]] = []
    segments: list[tuple[np.ndarray, np.ndarray]] = []
    for text, lang in rows:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int64)
        y = np.full(len(ids), languages.index(lang))
        for at in range(0, len(ids), CHAIN):
            chains.append((ids[at : at + CHAIN], y[at : at + CHAIN]))
            if rng.random() < 0.25:
                segments += [(ids[k : k + 12], y[k : k + 12]) for k in range(at, min(at + CHAIN, len(ids)), 12)]
    rng.shuffle(segments)
    chains += [tuple(map(np.concatenate, zip(*segments[k : k + 4], strict=True))) for k in range(0, len(segments), 4)]
    if not chains:
        return Model([])
    words, size = list(vocabulary), len(languages)
    parts, counts = [], []
    for at in range(0, len(words), 20_000):
        f, owner = word_features(words[at : at + 20_000])
        parts.append(f[np.argsort(owner, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owner, minlength=len(words[at : at + 20_000])))
    feats, start = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    weights, moves = np.zeros((BUCKETS, size)), np.zeros((size, size))
    seen_w, seen_m = np.full((BUCKETS, size), 1e-4), np.full((size, size), 1e-4)
    for _ in range(PASSES):
        rng.shuffle(chains)
        for at in range(0, len(chains), STEP):
            part = sorted(chains[at : at + STEP], key=lambda c: -len(c[0]))
            lengths = np.array([len(c[0]) for c in part])
            present = np.arange(lengths[0])[None, :] < lengths[:, None]
            ids, y = np.zeros(present.shape, np.int64), np.zeros(present.shape, np.int64)
            ids[present], y[present] = (np.concatenate(c) for c in zip(*part, strict=True))
            unique, where = np.unique(ids[present], return_inverse=True)
            n = start[unique + 1] - start[unique]
            own = np.repeat(np.arange(len(unique)), n)
            f = feats[np.repeat(start[unique] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            raw = np.stack([np.bincount(own, weights[f, k], len(unique)) for k in range(size)], axis=1)
            e = np.zeros((*present.shape, size))
            e[present] = np.exp(raw - raw.max(axis=1, keepdims=True))[where] + 1e-12
            jump = np.exp(moves)
            post, forward = posteriors(e, jump, lengths)
            error = -post[present]
            error[np.arange(len(error)), y[present]] += 1
            by_word = np.stack([np.bincount(where, error[:, k], len(unique)) for k in range(size)], axis=1)
            grad = np.stack([np.bincount(f, by_word[own, k], BUCKETS) for k in range(size)], axis=1) / len(error)
            pairs = present[:, 1:]
            # expected moves: forward x move x (posterior / what leads there)
            ahead = np.einsum("ctk,kj->ctj", forward[:, :-1], jump)
            ratio = np.where(pairs[..., None], post[:, 1:] / np.maximum(ahead, 1e-300), 0)
            expected = np.einsum("ctk,ctj->kj", forward[:, :-1], ratio) * jump
            real = np.zeros((size, size))
            np.add.at(real, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
            move = (real - expected) / max(1, pairs.sum())
            for w, g, seen in ((weights, grad - DECAY * weights, seen_w), (moves, move - DECAY * moves, seen_m)):
                seen += g * g
                w += RATE * g / np.sqrt(seen)
    return Model(languages, weights.astype(np.float32), moves)


# ---------------------------------------------------------------- operators


def train(docs: DataFrame, where=None, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` rows of each language, picked by a hash of their id, of rows ``where``."""
    rows = docs.where("lang is not null and text is not null")
    rows = rows.where(where) if where is not None else rows
    counts = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("_n"))
    picked = rows.select("doc_id", "text", "lang").join(F.broadcast(counts), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    ahead = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text").rowsBetween(Window.unboundedPreceding, -1))
    picked = picked.withColumn("_ahead", F.coalesce(ahead, F.lit(0))).where(F.col("_ahead") < LETTERS_PER_LANGUAGE)
    sample = [(r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["lang"]) for r in picked.select("doc_id", "text", "lang").toLocalIterator()]
    return fit([(text, lang) for *_, text, lang in sorted(sample)])


def judged(model: Model, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Language, its share of the words, and how sure these are on average."""
    if not model.languages:
        return [(UNKNOWN, 0.0, 0.0)] * len(texts)
    return [(UNKNOWN, 0.0, 0.0) if s is None else (model.languages[int(s[0].argmax())], min(1.0, float(s[0].max())), float(s[1])) for s in model.shares(texts)]


def predictions(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    return [x[:2] for x in judged(model, texts)]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the language's share of the words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = predictions(model, b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([p[0] for p in found], pa.string()), pa.array([p[1] for p in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def word_languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per stretch of words in one language: doc_id, first word's number, words, lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, labels in zip(b.column(0).to_pylist(), model.shares(b.column(1).to_pylist(), labels=True), strict=True):
                if labels is not None:
                    cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
                    rows += [(doc_id, lo, hi - lo, model.languages[int(labels[lo])]) for lo, hi in zip(cuts, cuts[1:], strict=False)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "word", "words", "lang"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, word long, words long, lang string")


def held_out():
    return remainder(4) == 2


def with_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with all their columns, without those that have no letters, or whose words are not known well.

    The mean of words' largest posteriors is at least ``least``: a text in several languages stays where
    each word's is clear.  Null and empty texts go; repeated rows stay or go together.
    """
    model = train(docs, ~held_out())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = judged(model, b.column(at).to_pylist())
            yield b.filter(pa.array([p[0] != UNKNOWN and p[2] >= least for p in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
