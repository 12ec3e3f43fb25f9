"""Personal-data columns by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keyword and class, in the order they are tried. The first keyword
# contained in the column name decides, so "ip_address" is caught by "address".
PII_KEYWORDS = [
    ("email", "Email Address"),
    ("phone", "Phone Number"),
    ("date_of_birth", "Date of Birth"),
    ("address", "Physical Address"),
    ("postal_code", "Postal Code"),
    ("card_last_four", "Partial Card Number"),
    ("first_name", "Person Name"),
    ("last_name", "Person Name"),
    ("ssn", "Social Security Number"),
    ("ip_address", "IP Address"),
]


def _by_rule(name: Column, result) -> Column:
    chain = F
    for keyword, cls in PII_KEYWORDS:
        chain = chain.when(name.contains(keyword), result(keyword, cls))
    return chain


def classify_columns(columns: DataFrame, column: str = "column_name") -> DataFrame:
    """Keep the columns whose name hits a keyword; map-only, no join."""
    name = F.lower(F.col(column))
    return columns.withColumns({
        "pii_classification": _by_rule(name, lambda keyword, cls: F.lit(cls)),
        "confidence": _by_rule(name, lambda keyword, cls: F.when(name == keyword, "high").otherwise("medium")),
    }).where(F.col("pii_classification").isNotNull())


def pii_rollup(pii: DataFrame) -> DataFrame:
    """Columns and distinct bare table names per class."""
    return pii.groupBy("pii_classification").agg(
        F.count("*").alias("column_count"), F.count_distinct("table_name").alias("table_count"))


def flag_columns(columns: DataFrame, pii: DataFrame) -> DataFrame:
    """Membership of each column in the classified set."""
    key = ["dataset_id", "table_name", "column_name"]
    known = pii.select(*key).distinct().withColumn("_hit", F.lit(True))
    return columns.join(known, key, "left").withColumn("pii", F.coalesce("_hit", F.lit(False))).drop("_hit")


def flag_tables(tables: DataFrame, pii: DataFrame) -> DataFrame:
    """A table is flagged by any classified column or by its own label."""
    key = ["dataset_id", "table_name"]
    known = pii.select(*key).distinct().withColumn("_hit", F.lit(True))
    labelled = F.coalesce(F.col("labels")["pii"] == "true", F.lit(False))
    return tables.join(known, key, "left").withColumn(
        "pii", F.coalesce("_hit", F.lit(False)) | labelled).drop("_hit")
