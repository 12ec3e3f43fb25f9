"""Full-text token table and lookup."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: tokens are runs of letters and digits.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(df: DataFrame, row_id: str, columns: list[str] | None = None) -> DataFrame:
    """Distinct (token, row) pairs over all text columns.

    Tokens are made distinct inside the row, so no shuffle is needed and a
    common word moves no data.
    """
    columns = columns or [f.name for f in df.schema.fields
                          if isinstance(f.dataType, T.StringType) and f.name != row_id]
    words = F.split(F.lower(F.concat_ws(" ", *columns)), TOKEN_BREAK)
    distinct_words = F.filter(F.array_distinct(words), lambda w: w != "")
    return df.select(F.col(row_id), F.explode(distinct_words).alias("token")).select("token", row_id)


def write_token_table(df: DataFrame, row_id: str, path: str, partitions: int = 64,
                      columns: list[str] | None = None) -> str:
    """Token table in folders by token hash; a lookup reads only its token's folder.

    Adaptive execution rebalances the buckets, so the bucket of a very common
    word is split over several files.
    """
    bucketed = tokens(df, row_id, columns).withColumn("bucket", token_bucket(F.col("token"), partitions))
    (bucketed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))
    return path


def token_bucket(token, partitions: int):
    return F.pmod(F.crc32(token.cast("binary")), F.lit(partitions)).cast("int")


def search_tokens(token_table: DataFrame, row_id: str, query: str, partitions: int | None = None) -> DataFrame:
    """Row ids that contain every token of the query; the table has a row per id and token."""
    words = sorted({w for w in re.split(r"[\W_]+", query.lower()) if w})
    hits = token_table.where(F.col("token").isin(words))
    if partitions:
        wanted = [token_bucket(F.lit(w), partitions) for w in words]
        hits = hits.where(F.col("bucket").isin(wanted))
    return (hits.groupBy(row_id).agg(F.count("*").alias("_n"))
            .where(F.col("_n") == len(words)).select(row_id))
