"""Cutting an ordered stream of requests into batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystack.operators.durable import durable


def greedy_cuts(tokens: np.ndarray, budget: int, filled: int) -> tuple[np.ndarray, int]:
    """Which rows open a batch, and how full the last one is, when the first row meets one filled to ``filled``.

    ``filled`` is -1 where no batch is open: at the start, and after a row that is over the budget by
    itself and so is a batch of its own.
    """
    opens = np.zeros(len(tokens), bool)
    for k, n in enumerate(tokens.tolist()):
        if n > budget:
            opens[k], filled = True, -1
        elif filled < 0 or filled + n > budget:
            opens[k], filled = True, n
        else:
            filled += n
    return opens, filled


def stretch_map(tokens: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a stretch of rows does to a batch filled to ``f`` >= 0: (above, opened, filled), ascending in ``above``.

    The first entry with above > budget - f says how many batches the stretch opens, and how full it
    leaves the last one; without such an entry it opens none.  What was open only decides which row
    opens the first batch; these rows are followed together from batch to batch, and merge where they
    meet.  Rows that come to the same are one entry, so there are at most as many as a batch has rows.
    """
    n = len(tokens)
    sums = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
    after = np.maximum(np.searchsorted(sums, sums[:-1] + budget, "right") - 1, np.arange(n) + 1)
    heads = np.arange(int(np.searchsorted(sums[:-1], budget, "right")))
    at, last, opened = heads.copy(), np.full(len(heads), -1), np.zeros(len(heads), np.int64)
    going = at < n
    while going.any():
        some, where = np.unique(at[going], return_inverse=True)
        last[going], opened[going] = at[going], opened[going] + 1
        at[going] = after[some][where]
        going = at < n
    filled = np.where(tokens[last] > budget, -1, sums[-1] - sums[last]) if n else last
    final = np.concatenate([(opened[1:] != opened[:-1]) | (filled[1:] != filled[:-1]), [True]]) if len(heads) else np.zeros(0, bool)
    return sums[1:][heads][final], opened[final], filled[final]


def token_batches(rows: DataFrame, budget: int, seq: str = "seq", tokens: str = "tokens", parts: int | None = None) -> DataFrame:
    """``rows`` with batch_id (from 1): in order, each batch as long as it stays within the budget.

    The rule is sequential, but a stretch of rows depends on those before it only by how full the open
    batch is.  Rows are dealt by ranges of ``seq``; one pass says of every stretch what it does to any
    open batch, the driver goes through these maps in order, and a second pass numbers the batches.
    """
    narrow = rows.select(*rows.columns)
    dealt = narrow.repartitionByRange(parts, seq) if parts else narrow.repartitionByRange(seq)
    kept = durable(dealt.sortWithinPartitions(seq))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = np.concatenate([np.zeros(0, np.int64), *[b.column(0).to_numpy() for b in batches]])
        if len(t):
            opens, filled = greedy_cuts(t, budget, -1)  # nothing is open
            row = [TaskContext.get().partitionId(), int(t.sum()), int(opens.sum()), filled, *[x.astype("<i8").tobytes() for x in stretch_map(t, budget)]]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["part", "total", "opened", "filled", "above", "opened_by", "filled_by"])

    found = kept.select(F.col(tokens).cast("bigint").alias("t")).mapInArrow(look, "part long, total long, opened long, filled long, above binary, opened_by binary, filled_by binary")
    before: dict[int, tuple[int, int]] = {}  # stretch -> (filled, batches) before it
    filled = -1
    count = 0
    for r in sorted(found.collect(), key=lambda r: r["part"]):
        before[r["part"]] = (filled, count)
        if filled < 0:
            count, filled = count + r["opened"], r["filled"]
            continue
        above, opened, left = (np.frombuffer(r[c], "<i8") for c in ("above", "opened_by", "filled_by"))
        at = int(np.searchsorted(above, budget - filled, "right"))
        count, filled = (count + int(opened[at]), int(left[at])) if at < len(above) else (count, filled + r["total"])
    at = kept.columns.index(tokens)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, last = before.get(TaskContext.get().partitionId(), (-1, 0))
        for b in batches:
            opens, filled = greedy_cuts(b.column(at).cast(pa.int64()).to_numpy(), budget, filled)
            ids = last + np.cumsum(opens)
            last = int(ids[-1]) if len(ids) else last
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.int64())], [*b.schema.names, "batch_id"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(assign, f"{schema}, batch_id long")


def batch_totals(batches: DataFrame, tokens: str = "tokens") -> DataFrame:
    return batches.groupBy("batch_id").agg(F.count("*").alias("articles"), F.sum(tokens).alias("tokens"))


def fixed_chunks(rows: DataFrame, size: int, seq: str = "seq") -> DataFrame:
    """``rows`` with chunk (from 0): ``size`` rows each, in order.

    ``seq`` is dealt by ranges of its value; a running total of the ranges' counts gives each its first
    place, so no window spans the table.
    """
    ranged = durable(rows.repartitionByRange(seq).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").count()
    firsts = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(seq)) - 1 + F.col("_first")
    return ranged.join(firsts, "_part").withColumn("chunk", F.floor(place / size)).drop("_part", "_first")


#: Fixed value: where a service takes chat requests.
URL = "/v1/chat/completions"


def requests_jsonl(items: DataFrame, kind: str, prompt: str, model: str = "rules", temperature: float = 0.01, max_tokens: int = 2, stop: str | None = None) -> DataFrame:
    """A request line for each item (article_id and a prompt column), as JSON text."""
    from daystack.functions.text import custom_id

    message = F.array(F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content")))
    fields = [F.lit(model).alias("model"), message.alias("messages"), F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens")]
    if stop is not None:
        fields.append(F.array(F.lit(stop)).alias("stop"))
    line = F.struct(custom_id(F.col("article_id"), kind).alias("custom_id"), F.lit("POST").alias("method"), F.lit(URL).alias("url"), F.struct(*fields).alias("body"))
    return items.select("article_id", F.to_json(line).alias("line"))
