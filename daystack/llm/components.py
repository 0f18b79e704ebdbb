"""Connected components: links are contracted where they are, then by alternating large and small stars.

Contraction replaces a task's links by stars around their smallest ids, so what is left is at most one
link for each id a task has seen.  Once that is few enough for one task it is contracted there, and
that is all; as long as it isn't, each round is two joins on narrow rows and one more contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.llm.common import cut, release

#: Links that are contracted at once: a task holds so many, and no more.
AT_ONCE = 1_000_000
#: Links that a task of a round takes.
ROWS = 100_000

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, roots): for each id in the links a - b the smallest id that it reaches."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while len(x):
        np.minimum.at(label, np.maximum(label[x], label[y]), np.minimum(label[x], label[y]))
        while (label[label] != label).any():
            label = label[label]
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    return ids, ids[label]


def contracted(links: DataFrame, at_once: int = AT_ONCE, whole: bool = False) -> DataFrame:
    """(a, b): stars that join what each task's ``links`` join; ``whole``: with a link of every centre to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                ids, roots = roots_of(*(np.concatenate(c) for c in zip(*held, strict=True)))
                some = slice(None) if whole else ids != roots
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(roots[some])], schema=LINKS)
            held.clear()

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n > at_once and not whole:
                yield from out()
                n = 0
        yield from out()

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): the smallest id that it reaches.

    A hub's links are spread by Spark's handling of skewed joins; minima are taken where rows are read.
    Links to oneself are no links; no links give no rows.
    """
    most = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = cut(contracted(links.where("a <> b"), at_once))
    before = None
    while (n := edges.count()) > at_once:
        tasks = min(most, n // ROWS + 1)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(tasks).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(least, F.col("a") == F.col("u"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = cut(contracted(small.coalesce(tasks), at_once).distinct())
        release(edges.sparkSession)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:  # stars alone are left
            stars = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
            return stars.unionByName(stars.select(F.col("root").alias("id"), "root").distinct())
        before = now
    return contracted(edges.coalesce(1), at_once, whole=True).select(F.col("a").alias("id"), F.col("b").alias("root"))
