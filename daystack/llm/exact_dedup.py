"""Exact deduplication by grace hashing.

Texts are first combined where they are read (one row per distinct text and memory-full), so a text
with any number of copies costs each later task at most a few rows.  These rows are dealt by digest.
Each task then runs the grace hash join's build: rows go into an open-addressing table that compares
complete contents; when the table would outgrow its memory, everything is dealt by the digest's next
bits into spill files, and each of these is treated alike.

Edge cases: a text of any length is compared whole, and held whole; a null text is an empty one; a null doc_id is below all others; all empty texts are copies of each other; rows that share
both doc_id and text are one document, so all of them are kept or dropped together; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import sys
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, look_up, texts, unused

#: Bytes of texts and their entries that a task holds before it hands on what it has combined, or deals a bucket anew.
MEMORY = 48 << 20
#: Bytes that an entry takes besides its text.
ENTRY = 230
#: A bucket is dealt to so many spill files, by so many bits of the digest.
FAN_BITS = 4


def larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


Row = tuple[bytes, bytes, int, int]


class ContentTable:
    """Open addressing with linear probing over complete contents; a slot holds an entry's number + 1."""

    def __init__(self) -> None:
        self.slots = np.zeros(256, np.int64)
        self.hashes: list[int] = []
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.best: list[int] = []
        self.sizes: list[int] = []
        self.bytes = 0

    def _place(self, slots: np.ndarray, number: int) -> None:
        mask = len(slots) - 1
        at = self.hashes[number] & mask
        while slots[at]:
            at = (at + 1) & mask
        slots[at] = number + 1

    def add(self, digest: bytes, content: bytes, doc_id: int, size: int) -> None:
        key = int.from_bytes(digest[-7:], "little")
        mask = len(self.slots) - 1
        at = key & mask
        while entry := int(self.slots[at]):
            if self.hashes[entry - 1] == key and self.contents[entry - 1] == content:
                self.best[entry - 1] = larger(self.best[entry - 1], doc_id)
                self.sizes[entry - 1] += size
                return
            at = (at + 1) & mask
        self.hashes.append(key)
        self.digests.append(digest)
        self.contents.append(content)
        self.best.append(doc_id)
        self.sizes.append(size)
        self.bytes += len(content) + ENTRY
        self.slots[at] = len(self.hashes)
        if 2 * len(self.hashes) > len(self.slots):
            slots = np.zeros(2 * len(self.slots), np.int64)
            for number in range(len(self.hashes)):
                self._place(slots, number)
            self.slots = slots

    def rows(self) -> Iterator[Row]:
        return zip(self.digests, self.contents, self.best, self.sizes, strict=True)


def grace(rows: Iterator[Row], memory: int, bits_used: int = 0) -> Iterator[ContentTable]:
    """Tables that together hold ``rows`` (digest, content, doc_id, size), no content in two of them.

    Once all bits of the digest are used, rows left together have equal digests; the table takes them
    whatever their size.  Spill files have no name on disk: they vanish with the task.
    """
    table = ContentTable()
    for digest, content, doc_id, size in rows:
        table.add(digest, content, doc_id, size)
        if table.bytes > memory and bits_used + FAN_BITS <= 8 * len(digest):
            break
    else:
        yield table
        return

    files = [tempfile.TemporaryFile() for _ in range(1 << FAN_BITS)]

    def spill(digest: bytes, content: bytes, doc_id: int, size: int) -> None:
        bits = int.from_bytes(digest, "big") >> (8 * len(digest) - bits_used - FAN_BITS)
        pickle.dump((digest, content, doc_id, size), files[bits & ((1 << FAN_BITS) - 1)], pickle.HIGHEST_PROTOCOL)

    for row in table.rows():
        spill(*row)
    del table
    for row in rows:
        spill(*row)

    def read(file) -> Iterator[Row]:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return

    for file in files:
        with file:
            yield from grace(read(file), memory, bits_used + FAN_BITS)


def _combine(memory: int, digest: Callable[[bytes], bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        used = 0

        def out() -> Iterator[pa.RecordBatch]:
            names, step = list(held), 1000
            for at in range(0, len(names), step):
                part = names[at : at + step]
                yield pa.RecordBatch.from_pydict(
                    {"digest": pa.array([digest(t.encode()) for t in part], pa.binary()), "text": pa.array(part, pa.string()), "doc_id": pa.array([held[t][0] for t in part], pa.int64()), "size": pa.array([held[t][1] for t in part], pa.int64())}
                )
            held.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (have := held.get(text)) is None:
                    held[text] = [doc_id, 1]
                    used += sys.getsizeof(text) + ENTRY
                else:
                    have[0] = larger(have[0], doc_id)
                    have[1] += 1
                if used > memory:
                    yield from out()
                    used = 0
        yield from out()

    return run


def _bucket(memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Row]:
            for b in batches:
                for d, t, i, n in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                    yield d, t.encode(), i, n

        for table in grace(rows(), memory):
            by: dict[bytes, list] = {}
            for d, content, best, size in table.rows():
                by.setdefault(d, []).append((content, best, size))
            out = [(d, best, size, content.decode() if len(same) > 1 else None) for d, same in by.items() for content, best, size in same]
            for at in range(0, len(out), 10_000):
                part = list(zip(*out[at : at + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.binary()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64()), pa.array(part[3], pa.string())], ["digest", "keep_id", "group_size", "content"])

    return run


def content_classes(docs: DataFrame, memory: int = MEMORY, digest: Callable[[bytes], bytes] = sha256) -> DataFrame:
    """One row per distinct text: its digest, keep_id, group_size, and the text itself if another text has its digest."""
    combined = texts(docs).mapInArrow(_combine(memory, digest), "digest binary, text string, doc_id long, size long")
    return combined.repartition("digest").mapInArrow(_bucket(memory), "digest binary, keep_id long, group_size long, content string")


def exact_dedup(docs: DataFrame, memory: int = MEMORY, digest: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` (bytes to bytes) only deals and addresses; texts are equal when their contents are.
    """
    classes = cut(content_classes(docs, memory, digest or sha256))
    shared = classes.where(F.col("content").isNotNull())
    base = texts(docs).withColumn("text_sha256", F.sha2("text", 256))
    if digest is None:
        keyed = base.withColumn("digest", F.unhex("text_sha256"))
    else:
        own = F.udf(lambda t: digest(t.encode()), "binary")
        keyed = base.withColumn("digest", own("text"))
    single = classes.where(F.col("content").isNull()).withColumn("digest", F.hex("digest")).drop("content")
    narrow = keyed.select("doc_id", "text_sha256", F.hex("digest").alias("digest"))
    out = look_up(narrow, single, "digest", "group_size", "inner").drop("digest")
    if not shared.isEmpty():  # different texts with one digest: compare contents
        exact = keyed.join(shared.drop("digest"), F.col("text") == F.col("content"))
        out = out.unionByName(exact.select("doc_id", "text_sha256", "keep_id", "group_size"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns, whatever their names, one document of each group of equal texts.

    Rows that share the doc_id of one that stays, stay with it; null texts and empty ones are a group.
    """
    key = unused(docs, "_kept_id")
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept[key]), "left_semi")
