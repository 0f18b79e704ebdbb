"""Packing tokenised documents into as few sequences as possible: bin completion by branch and bound.

What decides a packing is how many pieces there are of each length, at most ``capacity`` numbers, so
the search runs on these and its answer is a list of patterns (which lengths share a sequence, how
often).  Pieces are then ranked within their length, wherever they are, and take the patterns' places
in order; no text moves, and no length is too frequent.

Bounds of the search are the parameters below: nodes for each number of sequences that is tried, and
steps for listing a node's fillings.  Within them it is exact; beyond, the best packing so far stands.

Edge cases: a null or empty text is the end token alone; a text of any length is encoded whole, then cut;
documents with equal ids or equal texts are packed one by one, and which of equal pieces comes first is
settled by doc_id (null first), piece and ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daystack.llm.common import cut, rank_rows, texts

CAPACITY = 4096
END_ID = 1
#: Words of which a task remembers the ids.
REMEMBERED = 400_000
#: Branches at each depth of a node's first fillings; deeper levels take the largest that fits.
BRANCHES = (4, 3, 2)
#: Nodes that the search may visit for each number of sequences that it tries: for each length there is, and besides.
NODES_PER_LENGTH, NODES = 4, 2000
#: Steps that listing all of a node's fillings may take, once its first ones have failed, and how many count as a node.
LISTED, LISTED_PER_NODE = 5_000, 20

Pattern = tuple[int, ...]


# ---------------------------------------------------------------- tokenising


def byte_marks() -> dict[int, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


BYTE_MARKS = byte_marks()


class WordIds(dict):
    """Bytes of a word -> its ids as little-endian 32-bit numbers, encoded when first asked for.

    The vocabulary drops white space and never joins words, so a text's ids are its words' ids.
    Likewise a run of punctuation after a letter or digit is a word of its own; what a letter is, is
    asked once it is composed and in lower case, as some letters then end with a mark.
    """

    MARKS = b"!$%&*#.,;:?"

    def __init__(self, tokenizer) -> None:
        super().__init__({b"": b""})
        self.tokenizer = tokenizer

    def encode(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha() and max(text) <= "\xff":
            # letters of one byte each in Latin-1 are composed as they are: only the merges are left to do
            marked = text.lower().encode().decode("latin-1").translate(BYTE_MARKS)
            return array("I", [t.id for t in self.tokenizer.model.tokenize(marked)]).tobytes()
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(self.MARKS)
        if core and core != word and normalize("NFC", core.decode()[-1]).lower()[-1].isalnum():
            ids = self[core] + self[word[len(core) :]]
        else:
            ids = self.encode(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
                self[b""] = b""
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        raw = text.encode()
        if b"<|" not in raw:  # the names of special tokens are told apart by case
            raw = raw.lower()
        raw = raw.replace(b"\n", b" ").replace(b"\t", b" ")
        return b"".join(map(self.__getitem__, raw.split(b" ")))


_loaded: dict[str, object] = {}


def word_ids(path: str) -> WordIds:
    """A fresh memory of words on the worker's one copy of the tokenizer: it goes with the task that fills it."""
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return WordIds(_loaded[path])


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The documents' ids, cut every ``capacity``; each text is encoded whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path)
        end = np.asarray([END_ID], "<u4").tobytes()
        for b in batches:
            out: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = ids_of.text(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(run, PIECES)


# ---------------------------------------------------------------- searching


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Fewest sequences that any packing needs: the total, or what pieces over half a sequence force."""
    lengths = sorted(counts)
    n = np.array([counts[x] for x in lengths], np.int64)
    size = np.array(lengths, np.int64)
    best = -(-int((n * size).sum()) // capacity)
    for least in {0, *[x for x in lengths if 2 * x <= capacity]}:
        large = size > capacity - least
        middle = ~large & (2 * size > capacity)
        small = ~large & ~middle & (size >= least)
        room = int((n[middle] * (capacity - size[middle])).sum())
        spare = int((n[small] * size[small]).sum()) - room
        best = max(best, int(n[large].sum() + n[middle].sum()) + max(0, -(-spare // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best-fit decreasing, on lengths instead of single pieces."""
    rooms: dict[int, Counter[Pattern]] = {}
    order: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if room not in rooms:
            rooms[room] = Counter()
            order.insert(bisect_right(order, room), room)
        rooms[room][pattern] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_right(order, length - 1)
            if at == len(order):
                room, pattern, n = capacity, (), -(-left // (capacity // length))
            else:
                room = order[at]
                pattern, n = rooms[room].popitem()
                if not rooms[room]:
                    del rooms[room], order[at]
            each = min(room // length, left)
            full = min(n, left // each)
            put(room - each * length, pattern + (length,) * each, full)
            left -= full * each
            if full < n:
                if left and left < each:
                    put(room - left * length, pattern + (length,) * left, 1)
                    left, full = 0, full + 1
                if n - full and pattern:
                    put(room, pattern, n - full)
    return sum(rooms.values(), Counter())


def repeats(most: int) -> Iterator[int]:
    """All numbers from ``most`` to 1: those near it and its halves first."""
    first = [most, most - 1]
    while first[-1] > 1:
        first.append(first[-1] // 2)
    first = [n for n in dict.fromkeys(first) if n > 0]
    yield from first
    yield from (n for n in range(most, 0, -1) if n not in first)


class Completion:
    """Depth-first bin completion: each node fills up the sequence that holds the largest piece left."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.counts[length] = n
        self.total = int((self.counts * np.arange(capacity + 1)).sum())

    def fillings(self, largest: int) -> list[tuple[int, Pattern]]:
        """(waste, pattern) with the least waste first; no other filling here is at least as good for the rest."""
        have = self.counts.copy()
        have[largest] -= 1
        lengths = np.flatnonzero(have).tolist()
        room = self.capacity - largest
        found: dict[Pattern, int] = {}

        def fill(left: int, most: int, taken: Pattern, depth: int) -> None:
            at = bisect_right(lengths, min(left, most)) - 1
            width = BRANCHES[depth] if depth < len(BRANCHES) else 1
            tried = 0
            while at >= 0 and tried < width:
                length = lengths[at]
                if have[length] > 0:
                    tried += 1
                    if depth < len(BRANCHES):
                        have[length] -= 1
                        fill(left - length, length, (*taken, length), depth + 1)
                        have[length] += 1
                    else:  # no branches: as many of these as fit
                        n = int(min(have[length], left // length))
                        have[length] -= n
                        fill(left - n * length, length - 1, taken + (length,) * n, depth + 1)
                        have[length] += n
                at -= 1
            if not tried:
                found[taken] = left

        fill(room, room, (), 0)
        ok = have > 0  # two pieces that fill the room exactly
        pair = np.flatnonzero(ok[: room + 1] & ok[: room + 1][::-1])
        for a in pair[pair * 2 >= room][:2].tolist():
            if a != room - a or have[a] > 1:
                found[(a, room - a)] = 0

        best = sorted(((w, (largest, *f)) for f, w in found.items()), key=lambda x: (x[0], [-y for y in x[1]]))
        kept = [x for x in best if x[0] == 0 or not self._dominated(have, lengths, x[1][1:], x[0])]
        return kept or best[:1]

    def _dominated(self, have: np.ndarray, lengths: list[int], filling: Pattern, waste: int) -> bool:
        """Some piece left over could stand in for one or two pieces here, within the waste."""
        used = Counter(filling)
        parts = {(x,): x for x in used} | {(a, b): a + b for k, a in enumerate(filling) for b in filling[k + 1 :]}
        for part, size in parts.items():
            low = size + (len(part) == 1)
            at = bisect_right(lengths, size + waste) - 1
            if at >= 0 and lengths[at] >= low and have[lengths[at]] > used[lengths[at]]:
                return True
        return False

    def all_fillings(self, largest: int, most_waste: int) -> tuple[list[tuple[int, Pattern]], int]:
        """All undominated (waste, pattern) with at most so much waste, the least first, and the steps that it took.

        Fillings that take other pieces though one more would fit are dominated.  Where listing takes
        ``LISTED`` steps it ends with what it has.
        """
        have = self.counts.copy()
        have[largest] -= 1
        lengths = np.flatnonzero(have).tolist()
        room = self.capacity - largest
        left = {x: int(have[x]) for x in lengths}
        below = [0]
        for x in lengths:
            below.append(below[-1] + x * left[x])
        found: list[tuple[int, Pattern]] = []
        steps = 0

        def fill(space: int, k: int, taken: Pattern) -> None:
            """``k``: lengths[:k] may still be taken."""
            nonlocal steps
            steps += 1
            if steps > LISTED or space - below[k] > most_waste:
                return
            while k and lengths[k - 1] > space:
                k -= 1
            if not k:
                if space <= most_waste and not any(x <= space and left[x] for x in lengths):
                    found.append((space, (largest, *taken)))
                return
            x = lengths[k - 1]
            most = min(left[x], space // x)
            for n in range(most, -1, -1):
                left[x] -= n
                fill(space - n * x, k - 1, taken + (x,) * n)
                left[x] += n

        fill(room, len(lengths), ())
        found.sort(key=lambda f: (f[0], [-y for y in f[1]]))
        return [f for f in found if f[0] == 0 or not self._dominated(have, lengths, f[1][1:], f[0])], steps

    def search(self, sequences: int, nodes: int, fewer: bool = False) -> Counter[Pattern] | None:
        """A packing into ``sequences``, if one turns up within ``nodes``.

        A filling is used as often as it can be; with ``fewer`` also less often, and then no more of it
        goes to pieces of this length.  A node first tries a few fillings, and all others once these fail.
        """
        spare = sequences * self.capacity - self.total
        if spare < 0:
            return None
        # fillings, next, pattern, times, waste, repeats left, largest, patterns that are settled, whether all are listed
        path: list[list] = []
        wasted, largest = 0, self.capacity
        while True:
            while largest and not self.counts[largest]:
                largest -= 1
            if not largest:
                return self._collect(path)
            if nodes <= 0:
                self._undo(path)
                return None
            nodes -= 1
            fillings, settled = self.fillings(largest), frozenset()
            if fewer and path and path[-1][6] == largest:
                settled = path[-1][7] | {path[-1][2]}
                fillings = [x for x in fillings if x[1] not in settled]
            path.append([fillings, 0, (), 0, 0, iter(()), largest, settled, False])
            while True:  # take the next filling, here or further up
                frame = path[-1]
                pattern = frame[2]
                for length, k in Counter(pattern).items():
                    self.counts[length] += k * frame[3]
                wasted -= frame[4]
                frame[2:5] = [(), 0, 0]
                times = next(frame[5], 0)
                while not times:
                    if frame[1] == len(frame[0]):
                        if frame[8] or nodes <= 0:
                            break
                        more, steps = self.all_fillings(frame[6], spare - wasted)
                        tried, frame[8] = {x[1] for x in frame[0]} | frame[7], True
                        frame[0], frame[1] = [x for x in more if x[1] not in tried], 0
                        nodes -= steps // LISTED_PER_NODE
                        continue
                    waste, pattern = frame[0][frame[1]]
                    frame[1] += 1
                    most = min(int(self.counts[length]) // k for length, k in Counter(pattern).items())
                    if waste:
                        most = min(most, (spare - wasted) // waste)
                    if most > 0:
                        frame[5] = repeats(most) if fewer else iter((most,))
                        times = next(frame[5])
                    elif waste > spare - wasted:  # and so are all that follow
                        frame[1] = len(frame[0])
                if times:
                    for length, k in Counter(pattern).items():
                        self.counts[length] -= k * times
                    waste = times * (self.capacity - sum(pattern))
                    frame[2:5] = [pattern, times, waste]
                    wasted += waste
                    break
                path.pop()
                if not path:
                    return None
                nodes -= 1
            largest = self.capacity

    def _collect(self, path: list[list]) -> Counter[Pattern]:
        out: Counter[Pattern] = Counter()
        for _, _, pattern, n, *_ in path:
            out[pattern] += n
        return out

    def _undo(self, path: list[list]) -> None:
        for _, _, pattern, n, *_ in path:
            for length, k in Counter(pattern).items():
                self.counts[length] += k * n


def fill_sequences(counts: dict[int, int], capacity: int = CAPACITY, nodes_per_length: int = NODES_PER_LENGTH) -> Counter[Pattern]:
    """Patterns (lengths that share a sequence) and how often; best-fit unless the search finds fewer."""
    counts = {int(x): int(n) for x, n in counts.items() if n}
    if not counts:
        return Counter()
    incumbent = best_fit(counts, capacity)
    least, most = lower_bound(counts, capacity), sum(incumbent.values())
    nodes = nodes_per_length * len(counts) + NODES
    # a search that fails may have run out of nodes, so that small gaps are tried one by one
    sequences = least
    while least < most:
        found = None
        for fewer in (False, True):
            if found := Completion(counts, capacity).search(sequences, nodes, fewer):
                break
        if found:
            incumbent, most = found, sum(found.values())
        else:
            least = sequences + 1
        sequences = least if most - least <= 4 else (least + most) // 2
    return incumbent


def places(patterns: Counter[Pattern]) -> tuple[np.ndarray, ...]:
    """Runs of places, by (length, rank): key, first sequence, places of this length in one, offset of the first."""
    runs: list[tuple[int, int, int, int, int]] = []
    rank: Counter[int] = Counter()
    first = 0
    for pattern, n in sorted(patterns.items(), reverse=True):
        offset = 0
        for length, k in sorted(Counter(pattern).items(), reverse=True):
            runs.append(((length << 44) + rank[length], first, k, offset, length))
            rank[length] += k * n
            offset += k * length
        first += n
    runs.sort()
    return tuple(np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 5


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cuts = cut(pieces(docs, tokenizer_path, capacity))
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    # a run for each length of each pattern: some thousands, and fewer than there are sequences
    runs = docs.sparkSession.sparkContext.broadcast(places(fill_sequences(counts, capacity)))
    ranked = rank_rows(cuts, ["length"], ["doc_id", "piece", "ids_crc32"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, each, offsets, lengths = runs.value
        for b in batches:
            if not b.num_rows:
                continue
            key = (b.column("length").to_numpy() << 44) + b.column("rank").to_numpy()
            run = np.searchsorted(keys, key, "right") - 1
            nth = key - keys[run]
            where = (pa.array(firsts[run] + nth // each[run]), pa.array(offsets[run] + nth % each[run] * lengths[run]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *where], [*b.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
