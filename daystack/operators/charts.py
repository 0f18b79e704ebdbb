"""The daily series by month and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_periods(series: DataFrame) -> DataFrame:
    """``series`` (date) with year and year_month."""
    return series.withColumn("year", F.year("date")).withColumn("year_month", F.date_format("date", "yyyy-MM"))


def month_view(series: DataFrame, month: str | None = None) -> DataFrame:
    """Days with a count, of one month or all, each with its month's highest count and whether it has that."""
    rows = with_periods(series).where(F.col("pilgrim_count").isNotNull())
    rows = rows if month is None else rows.where(F.col("year_month") == month)
    top = F.max("pilgrim_count").over(Window.partitionBy("year_month"))
    return rows.withColumn("month_max", top).withColumn("is_max", F.col("pilgrim_count") == F.col("month_max"))


def month_maxima(series: DataFrame) -> DataFrame:
    return with_periods(series).groupBy("year_month").agg(F.max("pilgrim_count").alias("month_max"))


def year_months(series: DataFrame) -> DataFrame:
    """Each year and its months in order."""
    return with_periods(series).groupBy("year").agg(F.array_sort(F.collect_set("year_month")).alias("months")).orderBy("year")


def year_spine(series: DataFrame) -> DataFrame:
    """All twelve months of each year, with the month's highest count or null, and whether it is the year's."""
    found = month_maxima(series)
    spine = with_periods(series).select("year").distinct().withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    spine = spine.withColumn("year_month", F.format_string("%04d-%02d", "year", "month"))
    rows = spine.join(found, "year_month", "left")
    top = F.max("month_max").over(Window.partitionBy("year"))
    return rows.withColumn("is_max", F.coalesce(F.col("month_max") == top, F.lit(False)))


def default_selection(series: DataFrame) -> DataFrame:
    """First year and its first month for the month view, last year for the year view."""
    rows = with_periods(series)
    return rows.agg(F.min("year").alias("month_tab_year"), F.min("year_month").alias("month_tab_month"), F.max("year").alias("year_tab_year"))
