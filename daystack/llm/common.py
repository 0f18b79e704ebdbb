"""What the operators of this package share: durable cuts, held-out rows, ranks, skew-proof lookups."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.session import share


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return share(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder, or ``spark.checkpoint.dir``.

    Where both are unset, local sessions get a temporary folder; a cluster has no folder that all
    machines see, so there it is an error.
    """
    context = spark.sparkContext
    if folder := context.getCheckpointDir():
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="daystack-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that lost executors don't bring it back."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished rounds now; it finds out when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the text with null as empty, and ``more`` columns; nothing else gets in the way of names."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that ``docs`` has no column of."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(modulus: int, of: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(of).cast("string").cast("binary")) % modulus


ENDS = pa.schema([("part", pa.int32()), ("first", pa.list_(pa.int64())), ("n_first", pa.int64()), ("last", pa.list_(pa.int64())), ("n_last", pa.int64())])


def rank_rows(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` and each row's place (long, from 0) in its group, by ``order``.

    ``group`` are integer columns without nulls; none: all rows are one group.  Rows are dealt by ranges of (group, order), so a
    group of any size spreads over many tasks; from each task the driver gets the counts of its first
    and last group only.  ``order`` should tell rows apart: those that it doesn't share a range.
    """
    if not group:
        return rank_rows(df.withColumn("_all", F.lit(0)), ["_all"], order, name).drop("_all")
    kept = cut(df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order))

    def keys_of(b: pa.RecordBatch) -> np.ndarray:
        return np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in group], axis=1)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n_first = n_last = 0
        for b in batches:
            keys = keys_of(b)
            if not len(keys):
                continue
            moved = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            cuts = [0, *moved.tolist(), len(keys)]
            for lo, hi in {(cuts[0], cuts[1]): 0, (cuts[-2], cuts[-1]): 0}:
                key = keys[lo].tolist()
                if first is None:
                    first, last = key, key
                    n_first = n_last = hi - lo
                elif key == last:
                    n_last += hi - lo
                    if key == first:
                        n_first = n_last
                else:
                    last, n_last = key, hi - lo
        if first is not None:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "n_first": n_first, "last": last, "n_last": n_last}], ENDS)

    found = kept.select(*group).mapInArrow(ends, "part int, first array<long>, n_first long, last array<long>, n_last long").collect()
    before: dict[int, int] = {}
    open_key, open_n = None, 0
    for r in sorted(found, key=lambda r: r["part"]):
        before[r["part"]] = open_n if r["first"] == open_key else 0
        open_n = r["n_last"] + (before[r["part"]] if r["first"] == r["last"] else 0)
        open_key = r["last"]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen = None, before.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            keys = keys_of(b)
            if not len(keys):
                continue
            at = np.arange(len(keys))
            start = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
            rank = at - np.maximum.accumulate(np.where(start, at, 0))
            if key is None or keys[0].tolist() == key:
                rank += np.where(np.cumsum(start) == 1, seen, 0)
            key, seen = keys[-1].tolist(), int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank.astype(np.int64))], [*b.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(ranked, f"{schema}, `{name}` long")


#: A lookup table's hot rows are those that stand for at least this share of all rows, so there are at most 1000.
HOT_SHARE = 1e-3


def look_up(rows: DataFrame, table: DataFrame, key: str, size: str, how: str = "left") -> DataFrame:
    """Join ``rows`` with ``table`` (one row a key, string or binary) where ``size`` says how many rows each key stands for.

    Keys with a thousandth of all rows or more are at most a thousand: these go by broadcast, so that
    a key of any weight costs no more in one task than in another; all others go by shuffle.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    least = max(2, int(total * HOT_SHARE))
    columns = [c for c in table.columns if c != key]
    hot = table.where(F.col(size) >= least)
    cold = table.where(F.col(size) < least)
    boxed = lambda t, name: t.select(F.col(key).alias(f"{name}_key"), F.struct(*columns).alias(name))
    out = rows.join(F.broadcast(boxed(hot, "_hot")), F.col(key) == F.col("_hot_key"), "left")
    # a row already answered gets a key of its own, which no table row has; the same one if a lost task is run again
    own = F.concat(F.lit("\u0000"), F.xxhash64(*rows.columns).cast("string"))
    out = out.withColumn("_cold_on", F.when(F.col("_hot_key").isNull(), F.col(key).cast("string")).otherwise(own))
    out = out.join(boxed(cold.withColumn(key, F.col(key).cast("string")), "_cold"), F.col("_cold_on") == F.col("_cold_key"), "left")
    if how == "inner":
        out = out.where(F.col("_hot_key").isNotNull() | F.col("_cold_key").isNotNull())
    picked = [F.when(F.col("_hot_key").isNotNull(), F.col("_hot")[c]).otherwise(F.col("_cold")[c]).alias(c) for c in columns]
    return out.select(*rows.columns, *picked)
