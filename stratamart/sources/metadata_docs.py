"""Metadata documents: typed sections in and out.

A document is one nested JSON object per project and extraction. The scale axis
is many projects times many days of dumps, so a folder of documents is read as
one DataFrame and each section is exploded on its own: only the section's
columns are parsed out of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import METADATA_DOCUMENT, SECTION_SCHEMAS

CORRUPT = "_corrupt_document"


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``multi_line`` for pretty-printed dumps, one object per file; else one object per line.

    A document that cannot be read is kept as a row whose text is in ``CORRUPT``;
    ``broken_documents`` counts them.
    """
    schema = T.StructType([*METADATA_DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).json(path, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT)


def broken_documents(documents: DataFrame) -> DataFrame:
    """One row: documents read, those with a header, and those that could not be parsed."""
    return documents.agg(F.count("*").alias("documents"), F.count("extraction_metadata").alias("with_header"),
                         F.count(CORRUPT).alias("broken"))


def section(documents: DataFrame, name: str) -> DataFrame:
    """One row per record of a section, across all documents."""
    outer, _, inner = name.partition(".")
    source = F.col(outer)[inner] if inner else F.col(outer)
    return documents.select(F.explode(source).alias("r")).select("r.*")


def schema_fields(documents: DataFrame) -> DataFrame:
    """Top-level and one level of nested fields of every table, flattened."""
    top = section(documents, "tables").select(
        "dataset_id", "table_name", F.posexplode("schema_fields").alias("pos", "f"))
    nested = top.select("dataset_id", "table_name", "pos", "f", F.explode("f.fields").alias("n"))
    return top.select(
        "dataset_id", "table_name", (F.col("pos") + 1).cast("long").alias("ordinal_position"),
        F.col("f.name").alias("field_path"), F.col("f.field_type").alias("field_type"),
        F.col("f.mode").alias("mode"),
    ).unionByName(nested.select(
        "dataset_id", "table_name", (F.col("pos") + 1).cast("long").alias("ordinal_position"),
        F.concat_ws(".", "f.name", "n.name").alias("field_path"),
        F.col("n.field_type").alias("field_type"), F.col("n.mode").alias("mode")))


def write_sections(documents: DataFrame, root: str, names: list[str] | None = None) -> dict[str, str]:
    """One parquet table per section."""
    paths = {}
    for name in names or list(SECTION_SCHEMAS):
        paths[name] = f"{root}/{name}"
        section(documents, name).write.mode("overwrite").parquet(paths[name])
    return paths


def write_documents(documents: DataFrame, path: str) -> str:
    """Nested JSON, one document per line. Timestamps are already ISO text in the records."""
    documents.drop(CORRUPT).write.mode("overwrite").json(path)
    return path
