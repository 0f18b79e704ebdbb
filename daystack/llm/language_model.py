"""Scoring texts with a log-bilinear neural language model, beside an add-one unigram model.

The model predicts a word's class from the classes of the two words before it, and then the word from
its class and the class before it.  The most frequent words are classes of their own; others share a
class by how they end, and in it each word of the vocabulary is an outcome of its own.  Both steps are
log-bilinear, trained by noise-contrastive estimation in numpy, and normalised by batched matrix
products over all outcomes.  A class's last outcome stands for all words outside the vocabulary; these
share it by their counts, with one part for all words never seen.

Training is on counts over all training texts: of triples of classes, and of pairs of a class and a
word.  The vocabulary is every word that occurs ``LEAST`` times, up to ``VOCABULARY``, so it grows with the corpus up to
there; which words these are, and so every score, does not depend on how rows are dealt to tasks.

Counts of single words have no such bound.  Those of the ``COUNTED`` most frequent words are in every task;
all others stay distributed.  A task holds texts up to ``HELD`` such words, and each different one travels
once for all these texts, packed by ranges of hashes, to where all counts of a range meet; what goes back is
its count.  Texts wait in the shared folder for these counts, so no text is sent or named once for each range,
and what travels does not depend on how many ranges there are.  Ranges are as many as their bytes ask for.
Words are told apart by 56 bits of a hash and the range.

Edge cases: a null or empty text is the end token alone; texts of any length are scored whole; rows that
repeat are scored alike, and counted each; ties in frequency go to the word that sorts
first; a null doc_id is in no held-out part, so its text trains; without training texts every word is
unknown; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from daystack.llm.common import cut, rank_rows, remainder, texts

#: Classes, of which so many are frequent words; the next is the end token, the others go by endings.
CLASSES, FREQUENT = 128, 80
END = FREQUENT
#: Words with outcomes of their own: so many at most, and how often one occurs in training at least.
VOCABULARY, LEAST = 16_384, 32
#: Words of which every task has the counts, at most.
COUNTED = 262_144
#: Words of which a task holds counts before it sends them on, and as how many of them a text counts besides its own.
HELD, TEXT = 1_000_000, 10
#: Bytes of packed words in a range, about, and of one word.
RANGE_BYTES, WORD_BYTES = 16 << 20, 11
#: The model of classes: numbers a class, triples a step, steps, noise words a step, rate.
WIDTH, STEP, STEPS, NOISE, RATE = 32, 4096, 1500, 64, 0.08
#: The model of words: noise words for each word, rounds over all counts, rate, decay.
WORD_NOISE, ROUNDS, WORD_RATE, DECAY = 8, 200, 0.3, 1e-7
#: Slices in which counts are summed, at least.
SLICES = 16


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def ending_class(word: bytes) -> int:
    return END + 1 + xxh3_64_intdigest(word[-2:]) % (CLASSES - END - 1)


class Vocabulary:
    """Numbers of words: frequent ones from 0, then classes, then the other words, then ``more``, words outside the vocabulary; ``words`` are sorted by frequency."""

    def __init__(self, words: list[bytes], more: list[bytes] = ()) -> None:
        self.frequent, self.others, self.more = words[:FREQUENT], words[FREQUENT:], list(more)
        own = len(self.others)
        #: Of each number its class, and its place among the outcomes within classes; the last place is certain.
        self.classes = np.array([*range(CLASSES), *map(ending_class, self.others), *map(ending_class, self.more)], np.int64)
        rest = np.concatenate([np.full(END + 1, own + CLASSES), own + np.arange(END + 1, CLASSES)])
        self.places = np.concatenate([rest, np.arange(own), own + self.classes[CLASSES + own :]])
        #: Classes of the outcomes within classes: words, then one for the rest of each class.
        self.outcomes = np.concatenate([self.classes[CLASSES : CLASSES + own], np.arange(CLASSES)])

    def numbers(self) -> Numbers:
        return Numbers(self)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """``values`` of the words (frequent, others, more) by number; 0 for classes."""
        out = np.zeros(len(self.classes))
        out[: len(self.frequent)] = values[: len(self.frequent)]
        out[CLASSES:] = values[len(self.frequent) :]
        return out


class Numbers(dict):
    """Word (bytes) -> number, in one task; endings are remembered, words without a number are not."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__({w: k for k, w in enumerate(vocabulary.frequent)})
        self.update({w: CLASSES + k for k, w in enumerate([*vocabulary.others, *vocabulary.more])})
        self.endings: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        end = word[-2:]
        if (c := self.endings.get(end)) is None:
            c = self.endings[end] = ending_class(word)
        return c

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


# ---------------------------------------------------------------- counting


def word_counts(rows: DataFrame) -> DataFrame:
    """word, n: how often each word occurs in ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()

        for b in batches:
            for t in b.column(1).to_pylist():
                found.update(words_of(t))
            if len(found) > HELD // 4:
                yield from out()
        yield from out()

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def commonest(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The ``most`` most frequent words, and how often they occur; of equally frequent ones those that sort first.

    The driver gets how many words have each count, and then these words alone, not the first of every task.
    """
    levels = counts.groupBy("n").count().toArrow()
    n, words = (levels.column(c).to_numpy() for c in ("n", "count"))
    order = np.argsort(-n)
    n, upto = n[order], np.cumsum(words[order])
    whole = int(np.searchsorted(upto, most, "right"))  # so many levels fit as they are
    left = most - (int(upto[whole - 1]) if whole else 0)
    parts = [counts.where(F.col("n") >= int(n[whole - 1]))] if whole else []
    if left and whole < len(n):
        parts.append(rank_rows(counts.where(F.col("n") == int(n[whole])), [], ["word"]).where(F.col("rank") < left).select("word", "n"))
    top = []
    for t in parts:
        got = t.toArrow()
        top += zip(got.column("word").to_pylist(), got.column("n").to_pylist(), strict=True)
    top.sort(key=lambda x: (-x[1], x[0]))
    return [w for w, _ in top], np.array([k for _, k in top], np.int64)


def vocabulary_size(n: np.ndarray, most: int = VOCABULARY, least: int = LEAST) -> int:
    """How many of words that occur ``n`` times, the most frequent first, have outcomes of their own."""
    return min(most, max(min(len(n), FREQUENT), int((n >= least).sum())))


def vocabulary_of(counts: DataFrame, most: int = VOCABULARY, least: int = LEAST) -> Vocabulary:
    """The most frequent words, and of those not so frequent the ones that occur ``least`` times."""
    words, n = commonest(counts, most)
    return Vocabulary(words[: vocabulary_size(n, most, least)])


def outside(counts: DataFrame, vocabulary: Vocabulary, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Of each class how often words outside the vocabulary occur and how many there are; the same of all words.

    ``n``: how often the vocabulary's words occur.
    """
    seen, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.groupBy(F.substring("word", -2, 2).alias("ending")).agg(F.sum("n").alias("n"), F.count("n").alias("words")).collect():
        c = ending_class(bytes(r["ending"]))
        seen[c] += r["n"]
        distinct[c] += r["words"]
    total = int(seen.sum()), int(distinct.sum())
    own = np.array([ending_class(w) for w in (*vocabulary.frequent, *vocabulary.others)], np.int64)
    np.subtract.at(seen, own, n[: len(own)])
    np.subtract.at(distinct, own, 1)
    return seen, distinct, *total


def class_counts(rows: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Counts over ``rows``: of (class before last, last class, class), and of (last class, outcome within its class).

    Texts begin as after two ends.
    """
    triples, places = CLASSES**3, len(vocabulary.outcomes) + 1
    size = triples + CLASSES * places
    slices = max(SLICES, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a task for each, however many tasks count
    width = -(-size // slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, total = vocabulary.numbers(), np.zeros(size, np.int64)
        for b in batches:
            for t in b.column(1).to_pylist():
                s = np.concatenate([[END, END], numbers.of(words_of(t)), [END]])
                c = vocabulary.classes[s]
                np.add.at(total, (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], 1)
                np.add.at(total, triples + c[1:-1] * places + vocabulary.places[s[2:]], 1)
        at = np.flatnonzero(total)
        bounds = np.searchsorted(at, np.arange(slices + 1) * width)
        for k in range(slices):
            part = at[bounds[k] : bounds[k + 1]]
            if len(part):
                blob = (part - k * width).astype("<u4").tobytes() + total[part].astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob], pa.binary())], ["slice", "blob"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for blob in table.column("blob").to_pylist():
            n = len(blob) // 12
            total[np.frombuffer(blob, "<u4", n)] += np.frombuffer(blob, "<i8", n, 4 * n)
        at = np.flatnonzero(total)
        blob = at.astype("<u4").tobytes() + total[at].astype("<i8").tobytes()
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary())})

    out = np.zeros(size, np.int64)
    for r in rows.mapInArrow(run, "slice int, blob binary").groupBy("slice").applyInArrow(add, "slice int, blob binary").toLocalIterator():
        n = len(r["blob"]) // 12
        out[r["slice"] * width + np.frombuffer(r["blob"], "<u4", n)] = np.frombuffer(r["blob"], "<i8", n, 4 * n)
    return out[:triples].reshape(CLASSES, CLASSES, CLASSES), out[triples:].reshape(CLASSES, places)[:, :-1]


#: What is known of a text where it is read: sums over the words that have numbers, and its other words.
TEXTS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("part", pa.float64()), ("logs", pa.float64()), ("known", pa.int64()), ("at", pa.list_(pa.uint32())), ("n", pa.list_(pa.uint32()))])
#: Range of the message that holds a batch's texts.
OWN = -1


def packed(held: list[tuple], ranges: int) -> Iterator[tuple[int, bytes]]:
    """Messages (range, bytes) of a batch of texts: the texts, and for each range their different words with training counts.

    ``held``: the columns of ``TEXTS``, with hashes of words in place of ``at``, which says where a word is
    among the batch's, these being sorted by range.
    """
    *plain, hashes, counts = zip(*held, strict=True)
    each = np.array([len(h) for h in hashes], np.int64)
    hashes, counts = np.concatenate(hashes), np.concatenate(counts)
    train = np.repeat(~np.array(plain[1], bool), each)
    distinct, at = np.unique(hashes, return_inverse=True)
    seen = np.bincount(at, counts * train, len(distinct)).astype("<u4")
    part = (distinct % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    offsets = pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.uint32))) for x in (place[at], counts)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, TEXTS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([*(pa.array(x, f.type) for x, f in zip(plain, TEXTS, strict=False)), *lists], schema=TEXTS))
    yield OWN, sink.getvalue().to_pybytes()
    high = distinct[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 1:]
    seen, bounds = seen[order], np.searchsorted(part[order], np.arange(ranges + 1))
    for r in range(ranges):
        lo, hi = bounds[r], bounds[r + 1]
        if lo < hi:
            yield r, np.uint32(hi - lo).tobytes() + high[lo:hi].tobytes() + zlib.compress(seen[lo:hi].tobytes(), 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and training counts of a message to a range."""
    m = int(np.frombuffer(blob, "<u4", 1)[0])
    wide = np.zeros((m, 8), np.uint8)
    wide[:, 1:] = np.frombuffer(blob, np.uint8, 7 * m, 4).reshape(-1, 7)
    return wide.view("<u8").ravel(), np.frombuffer(zlib.decompress(blob[4 + 7 * m :]), "<u4")


def meet(table: pa.Table) -> pa.Table:
    """Messages to one range -> answers: how often each of a message's words occurs in training."""
    parts = [unpacked(x) for x in table.column("blob").to_pylist()]
    bounds = np.cumsum([0, *(len(h) for h, _ in parts)])
    _, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    total = np.bincount(at, np.concatenate([c for _, c in parts]))[at].astype("<u4")
    answers = [total[lo:hi].tobytes() for lo, hi in zip(bounds, bounds[1:], strict=False)]
    return pa.table([table.column("g"), table.column("r"), pa.array(answers, pa.binary())], ["g", "r", "blob"])


def complete(table: pa.Table) -> pa.Table:
    """A batch's texts and the answers to it -> its texts, with sums over all their words.  Sums go by hash, so they come out alike in any batch."""
    (_, own), *answers = sorted(zip(table.column("r").to_pylist(), table.column("blob").to_pylist(), strict=True))
    out = pa.ipc.open_stream(own).read_all().combine_chunks()
    total = np.frombuffer(b"".join(x for _, x in answers), "<u4")
    at, n = (out.column(c).combine_chunks() for c in ("at", "n"))
    owner = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
    c, n = total[at.flatten().to_numpy()], n.flatten().to_numpy()
    rest, known = np.bincount(owner, n * np.log10(c + 1.0), len(at)), np.bincount(owner, n * (c > 0), len(at)).astype(np.int64)
    sums = [out.column("part").to_numpy() + rest, out.column("logs").to_numpy() + rest, out.column("known").to_numpy() + known]
    return pa.table([*out.columns[:3], *map(pa.array, sums)], TEXTS.names[:6])


# ---------------------------------------------------------------- the neural model


@dataclass
class LogBilinear:
    """Predicted vector = sum over the two classes before of (their vector x the position's weights)."""

    vectors: np.ndarray  # of classes as context
    places: np.ndarray  # two positions' matrices
    targets: np.ndarray  # of classes as what follows
    bias: np.ndarray

    def predicted(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.vectors[before] @ self.places[0] + self.vectors[last] @ self.places[1]

    def log_probabilities(self) -> np.ndarray:
        """Natural, normalised, for all pairs of classes at once: (pair, class)."""
        pairs = np.arange(CLASSES**2)
        out = self.predicted(pairs // CLASSES, pairs % CLASSES) @ self.targets.T + self.bias
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))


def train(triples: np.ndarray, seed: int = 0, steps: int = STEPS) -> LogBilinear:
    """Noise-contrastive estimation; noise is the classes' own frequency, shared by a step's triples."""
    rng = np.random.default_rng(seed)
    unigram = triples.sum(axis=(0, 1)) + 1.0
    noise = unigram / unigram.sum()
    log_noise = np.log(noise) + np.log(NOISE)
    model = LogBilinear(rng.normal(0, 0.1, (CLASSES, WIDTH)), np.stack([np.eye(WIDTH)] * 2) * 0.5, rng.normal(0, 0.1, (CLASSES, WIDTH)), np.log(noise))
    flat = triples.ravel()
    at = np.flatnonzero(flat)
    if not len(at):
        return model
    ahead = np.cumsum(flat[at], dtype=np.float64)
    squares = [np.full_like(p, 1e-3) for p in (model.vectors, model.places, model.targets, model.bias)]
    for step in range(steps):
        drawn = at[np.searchsorted(ahead, rng.random(STEP) * ahead[-1], "right").clip(max=len(at) - 1)]
        before, last, word = drawn // CLASSES**2, drawn // CLASSES % CLASSES, drawn % CLASSES
        wrong = rng.choice(CLASSES, NOISE, p=noise)
        q = model.predicted(before, last)
        true = (q * model.targets[word]).sum(axis=1) + model.bias[word] - log_noise[word]
        false = q @ model.targets[wrong].T + model.bias[wrong] - log_noise[wrong]
        e_true = 1 / (1 + np.exp(true))  # 1 - sigmoid
        e_false = -1 / (1 + np.exp(-false))
        g_targets, g_bias = np.zeros_like(model.targets), np.zeros(CLASSES)
        np.add.at(g_targets, word, e_true[:, None] * q)
        np.add.at(g_targets, wrong, e_false.T @ q)
        np.add.at(g_bias, word, e_true)
        np.add.at(g_bias, wrong, e_false.sum(axis=0))
        g_q = e_true[:, None] * model.targets[word] + e_false @ model.targets[wrong]
        g_vectors = np.zeros_like(model.vectors)
        np.add.at(g_vectors, before, g_q @ model.places[0].T)
        np.add.at(g_vectors, last, g_q @ model.places[1].T)
        g_places = np.stack([model.vectors[before].T @ g_q, model.vectors[last].T @ g_q])
        rate = RATE * (1 - step / steps) + 1e-3
        for p, g, s in zip((model.vectors, model.places, model.targets, model.bias), (g_vectors, g_places, g_targets, g_bias), squares, strict=True):
            g /= STEP
            s += g * g
            p += rate * g / np.sqrt(s)
    return model


def train_words(pairs: np.ndarray, outcomes: np.ndarray, seed: int = 0, rounds: int = ROUNDS) -> np.ndarray:
    """Natural, normalised log-probabilities (last class, outcome) of each outcome within its class.

    ``pairs``: counts of (last class, outcome); ``outcomes``: their classes.  Noise is the outcomes' own
    frequency within their class.  As counts say all that there is to say about the texts, each round
    takes the estimation's expectation over all words and all noise, by products of matrices.
    """
    rng = np.random.default_rng(seed)
    counts = pairs.astype(np.float64)
    unigram = counts.sum(axis=0) + 0.5
    within = unigram / np.bincount(outcomes, unigram, CLASSES)[outcomes]
    to_class = np.zeros((len(outcomes), CLASSES))
    to_class[np.arange(len(outcomes)), outcomes] = 1
    noise = WORD_NOISE * (counts @ to_class)[:, outcomes] * within
    vectors, targets, bias = rng.normal(0, 0.1, (CLASSES, WIDTH)), rng.normal(0, 0.1, (len(outcomes), WIDTH)), np.log(within)
    log_noise = np.log(WORD_NOISE * within)
    scale = 1 / max(1.0, counts.sum())
    squares = [np.full_like(p, 1e-12) for p in (vectors, targets, bias)]
    for k in range(rounds):
        odds = vectors @ targets.T + bias - log_noise
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        g = (counts * (1 - p) - noise * p) * scale
        rate = WORD_RATE * (1 - k / rounds) + 1e-3
        for x, d, s in zip((vectors, targets, bias), (g @ targets, g.T @ vectors, g.sum(axis=0)), squares, strict=True):
            d -= DECAY * x
            s += d * d
            x += rate * d / np.sqrt(s)
    out = vectors @ targets.T + bias
    top = np.full((CLASSES, CLASSES), -np.inf)
    np.maximum.at(top.T, outcomes, out.T)
    out -= top[:, outcomes]
    return out - np.log(np.exp(out) @ to_class)[:, outcomes]


# ---------------------------------------------------------------- the operator


def score(docs: DataFrame, most: int = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    held = F.coalesce(remainder(7) == 2, F.lit(False))
    rows = texts(docs).withColumn("held_out", held)
    learned = rows.where("not held_out").drop("held_out")
    counts = cut(word_counts(learned))
    words, n = commonest(counts, max(most, COUNTED))
    size = vocabulary_size(n, most)
    vocabulary, counted = Vocabulary(words[:size]), Vocabulary(words[:size], words[size:])
    seen, distinct, n_words, v_words = outside(counts, vocabulary, n)
    triples, pairs = class_counts(learned, vocabulary)
    model = train(triples)
    of_class = (model.log_probabilities() / np.log(10)).astype(np.float32).ravel()
    of_word = (train_words(pairs, vocabulary.outcomes) / np.log(10)).astype(np.float32)
    of_word = np.concatenate([of_word, np.zeros((CLASSES, 1), np.float32)], axis=1)  # classes of one outcome
    ends = int(triples[:, :, END].sum())
    n_train, v_train = n_words + ends, v_words + (ends > 0)
    # a word outside the vocabulary has of its class's last outcome what its count is of all
    shared = np.log10(seen + distinct + 1.0)
    shared[: END + 1] = 0
    logs, known = counted.spread(np.log10(n + 1.0)), counted.spread(np.ones(len(n))).astype(np.int64)
    more = len(counted.classes) - len(counted.more)
    share = np.concatenate([-shared, np.zeros(more - CLASSES), logs[more:] - shared[counted.classes[more:]]])
    fixed = spark.sparkContext.broadcast((counted.numbers(), counted.classes, counted.places, of_class, of_word.ravel(), logs, known, share))
    places = of_word.shape[1]
    # words that travel are at most as many as occur, about
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(n_words - int(n.sum())) * WORD_BYTES // RANGE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, classes, place, of_class, of_word, logs, known, share = fixed.value
        held: list[tuple] = []
        g, n = TaskContext.get().partitionId() << 32, 0

        def out() -> Iterator[pa.RecordBatch]:
            for r, blob in packed(held, ranges) if held else ():
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([r], pa.int32()), pa.array([blob], pa.binary())], ["g", "r", "blob"])
            held.clear()

        for b in batches:
            for doc_id, text, held_out in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                words = words_of(text)
                s = np.concatenate([[END, END], numbers.of(words), [END]])
                c, of = classes[s], s[2:-1]
                part = of_class[(c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]].sum(dtype=np.float64)
                part += of_word[c[1:-1] * places + place[s[2:]]].sum(dtype=np.float64) + share[of].sum()
                rare = np.flatnonzero((of > END) & (of < CLASSES)).tolist()
                h, times = np.unique(np.fromiter((xxh3_64_intdigest(words[k]) for k in rare), np.uint64, len(rare)), return_counts=True)
                held.append((doc_id, held_out, len(of) + 1, float(part), float(logs[of].sum()), int(known[of].sum()), h, times))
                n += len(h) + TEXT
                if n > HELD:
                    yield from out()
                    g, n = g + 1, 0
        yield from out()

    # kept, so that texts and the answers to them are of the same batches
    sent = cut(rows.mapInArrow(run, "g long, r int, blob binary"))
    answers = sent.where(F.col("r") != OWN).repartitionById(ranges, F.col("r")).groupBy("r").applyInArrow(meet, "g long, r int, blob binary")
    out = answers.union(sent.where(F.col("r") == OWN)).groupBy("g")
    out = out.applyInArrow(complete, "doc_id long, held_out boolean, n_tokens long, part double, logs double, known long")
    base = F.col("logs") + F.lit(float(np.log10(ends + 1.0))) - F.col("n_tokens") * F.lit(float(np.log10(n_train + v_train + 1.0)))
    known = F.col("known") + F.lit(int(ends > 0))
    return out.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), F.col("part").alias("score"))
