"""Schemas of the engine's tables, and their DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = (
    "item_id string, source string, list_name string, title string, text string, url string, created_time timestamp, last_edited_time timestamp, "
    "tags array<string>, user_rating double, take_aways string, ordinal bigint"
)
CHUNK = (
    "chunk_id string, chunk_text string, chunk_index int, article_id string, source string, source_url string, created_time string, "
    "metadata struct<title:string,chunk_length:int,total_chunks:int>"
)
STATE = "ns string, k1 string, k2 string, id string, value string, expires_at timestamp"

#: Managed tables: (columns, unique key, allowed values).
TABLES: dict[str, tuple[str, list[str], dict[str, tuple[str, ...]]]] = {
    "patch": ("order_id bigint, name string", ["order_id"], {}),
    "index_pages": ("category string, name string, index_id string", ["category", "name"], {}),
    "content_items": ("id bigint, source string, source_url string, title string, content string, created_time timestamp, ingested_at timestamp", ["id"], {}),
    "embeddings": ("id bigint, content_id bigint, chunk_hash string, chunk_text string, embedding array<float>", ["chunk_hash"], {}),
    "content_scores": ("content_id bigint, score int, reasoning string, scored_at timestamp", ["content_id"], {}),
    "review_status": ("content_id bigint, status string, updated_at timestamp", ["content_id"], {"status": ("pending", "approved", "rejected")}),
    "approved_content": ("content_id bigint, category string, published_at timestamp", ["content_id"], {}),
    "failed_items": ("item_id string, stage string, reason string, attempts int, failed_at timestamp", ["item_id", "stage"], {}),
}


def create(spark: SparkSession, database: str | None = None) -> None:
    """Create the managed tables that do not exist yet."""
    for name, (columns, _, _) in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {f'{database}.' if database else ''}{name} ({columns}) USING parquet")


def violations(df: DataFrame, name: str) -> DataFrame:
    """Rows (rule, value, n) that break a table's unique key or its allowed values."""
    _, key, allowed = TABLES[name]
    out = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("unique").alias("rule"), F.concat_ws(",", *key).alias("value"), "n")
    for column, values in allowed.items():
        bad = df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
        out = out.unionByName(bad.select(F.lit(column).alias("rule"), F.col(column).alias("value"), "n"))
    return out


def index_map(index_pages: DataFrame) -> DataFrame:
    """Rows (category, names): each category's names with their index ids."""
    return index_pages.groupBy("category").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "index_id")))).alias("names"))
