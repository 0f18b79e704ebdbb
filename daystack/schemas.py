"""Schemas of files and messages."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE_COLUMNS = ("year", "month", "page", "article_id", "title", "link", "content")
ARTICLE_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS])

#: A loaded article: where it came from, and in which order.
ARTICLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("article_id", "title", "link", "content", "year", "month")]
    + [T.StructField("retry", T.BooleanType()), T.StructField("source_rank", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("row_seq", T.LongType())]
)

RESULT_LINE = "custom_id string, error string, response struct<body: struct<choices: array<struct<message: struct<content: string>>>>>"
SERIES_JSON = "map<string, struct<article_id: string, title: string, post: string, data: struct<pilgrim_count: string, other_metrics: string>>>"
LEDGER_ENTRY = "array<struct<kind: string, batch_id: string, article_ids: array<string>, estimated_tokens: bigint>>"
#: The keys of a saved state.
STATE_KEYS = ("darshan_rows", "failed_records", "metrics", "pending_batches", "date_duplicates")
BATCH_STATUS = "batch_id string, status string, created_at bigint, total_requests bigint, processed bigint, failed bigint, submitted_at bigint, completed_at bigint, output_file_id string, error_file_id string"
