"""The best record of each day, and an audit of what it displaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystack.functions.payload import count_of, day_of, metrics_of, outcome, parse
from daystack.functions.text import iso_date
from daystack.operators.durable import durable

#: Why a row gave way.
REPLACED = "replaced by higher pilgrim_count"
LOWER = "lower pilgrim_count, existing kept"


def validated(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """``rows`` (year, month, ...) with day, pilgrim_count, other_metrics, outcome and date (null unless valid).

    A payload is parsed once, however many of these columns a query uses: the optimizer doesn't copy
    what an explosion makes.
    """
    v = F.col("_v")
    out = rows.select("*", F.explode(F.array(parse(F.col(payload)))).alias("_v"))
    out = out.withColumn("day", day_of(v)).withColumn("pilgrim_count", count_of(v)).withColumn("other_metrics", metrics_of(v))
    out = out.withColumn("outcome", outcome(F.col("day"), F.col("pilgrim_count")))
    date = F.when(F.col("outcome") == "extracted_success", iso_date(F.col("year"), F.col("month"), F.col("day")))
    return out.withColumn("date", date).drop("_v")


def daily_best(valid: DataFrame, count: str = "pilgrim_count", seq: str = "seq") -> DataFrame:
    """Per date the row with the highest count; of equal ones the first in ``seq``."""
    rest = [c for c in valid.columns if c != "date"]
    best = valid.groupBy("date").agg(F.max_by(F.struct(*rest), F.struct(F.col(count), -F.col(seq))).alias("_b"))
    return best.select("date", *[F.col("_b")[c].alias(c) for c in rest])


def displaced(valid: DataFrame, count: str = "pilgrim_count", seq: str = "seq") -> DataFrame:
    """Rows that are not their date's best: the reason, and the seq at which they gave way.

    A row leads if no earlier one of its date has a count as high.  The last leader is kept; others
    give way when the next leader comes, and rows that never lead at once.

    Rows are dealt by ranges of ``seq``, and windows span a date's rows of one range: what the ranges
    before it came to, and the first leader of those after it, are joined from a row for each date and range.
    """
    kept = durable(valid.repartitionByRange(seq).withColumn("_range", F.spark_partition_id()))
    each = Window.partitionBy("date").orderBy("_range")
    tops = kept.groupBy("date", "_range").agg(F.max(count).alias("_top"))
    tops = tops.select("date", "_range", F.max("_top").over(each.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    by = Window.partitionBy("date", "_range").orderBy(seq)
    rows = kept.join(tops, ["date", "_range"])
    earlier = F.greatest(F.max(count).over(by.rowsBetween(Window.unboundedPreceding, -1)), "_before")
    rows = durable(rows.withColumn("_leads", earlier.isNull() | (F.col(count) > earlier)).drop("_before"))
    firsts = rows.groupBy("date", "_range").agg(F.min(F.when(F.col("_leads"), F.col(seq))).alias("_first"))
    firsts = firsts.select("date", "_range", F.min("_first").over(each.rowsBetween(1, Window.unboundedFollowing)).alias("_later"))
    own = F.min(F.when(F.col("_leads"), F.col(seq))).over(by.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.join(firsts, ["date", "_range"]).withColumn("_next", F.coalesce(own, "_later"))
    rows = rows.where(~F.col("_leads") | F.col("_next").isNotNull())
    rows = rows.withColumn("reason", F.when(F.col("_leads"), REPLACED).otherwise(LOWER))
    rows = rows.withColumn("displaced_at", F.when(F.col("_leads"), F.col("_next")).otherwise(F.col(seq)))
    return rows.select(*valid.columns, "reason", "displaced_at")


def displaced_lists(rows: DataFrame, columns: list[str], seq: str = "seq") -> DataFrame:
    """Per date its displaced rows in the order in which they gave way; an earlier leader before what replaced it."""
    item = F.struct("displaced_at", F.col(seq).alias("_seq"), F.struct(*columns, "reason").alias("row"))
    return rows.groupBy("date").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["row"]).alias("displaced"))


def displaced_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("displaced"), F.count_distinct("date").alias("dates"))
