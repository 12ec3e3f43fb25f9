"""Options, labels, access records and coverage of metadata sections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.display import coverage_bucket
from .dedup import latest_per_key
from .predicates import contains_ignoring_case
from .skew import collect_members

TABLE_KEY = ["dataset_id", "table_name"]

# Sections of the coverage report, in display order.
COVERAGE_SECTIONS = [
    "datasets", "tables", "columns", "column_field_paths", "views", "table_options",
    "lineage.table_lineage", "lineage.column_lineage", "quality", "pii_classification",
    "access.dataset_permissions", "jobs", "routines", "routine_parameters", "scheduled_queries", "storage",
    "table_constraints", "key_column_usage", "row_level_security", "snapshots", "partitions",
    "streaming_buffers", "search_indexes", "vector_indexes", "materialized_views", "bi_engine",
]


def options_long(tables: DataFrame, options_column: str = "options") -> DataFrame:
    """A map of options per table as one row per option."""
    return tables.select(*TABLE_KEY, F.explode(options_column).alias("option_name", "option_value"))


def options_grouped(options: DataFrame, ordinal: str) -> DataFrame:
    """Options of each table in ordinal order, one row per option with its position."""
    keyed = options.withColumn("table", F.concat_ws(".", *TABLE_KEY))
    return collect_members(keyed, "table", ordinal, ["option_name", "option_value"])


def search_options(options: DataFrame, needle: str) -> DataFrame:
    """All options of the tables whose name, or the name of any of whose options, contains ``needle``.

    The matching tables are found first, one row each, so a table keeps every option
    however many it has.
    """
    found = options.where(contains_ignoring_case(F.col("option_name"), needle)
                          | contains_ignoring_case(F.concat_ws(".", *TABLE_KEY), needle)).select(*TABLE_KEY).distinct()
    return options.join(found, TABLE_KEY, "left_semi")


def current_options(log: DataFrame, applied_at: str, sequence: str) -> DataFrame:
    """Last writer wins per table and option; a later label set replaces the earlier one whole.

    Maps have no order, so map columns travel through the comparison as sorted
    entries and come out as maps again.
    """
    maps = {f.name: f.dataType for f in log.schema.fields if f.dataType.typeName() == "map"}
    flat = log.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps})
    latest = latest_per_key(flat, [*TABLE_KEY, "option_name"], applied_at, [sequence])
    return latest.withColumns({c: F.map_from_entries(c).cast(t) for c, t in maps.items()}).select(*log.columns)


def table_details(columns: DataFrame, paths: DataFrame, options: DataFrame, views: DataFrame) -> DataFrame:
    """Columns with their field-path record, option count and view definition.

    Every right side is unique per join key, so the row count of ``columns`` is kept.
    """
    option_counts = options.groupBy(*TABLE_KEY).agg(F.count("*").alias("option_count"))
    top = paths.where(F.col("field_path") == F.col("column_name")).groupBy(*TABLE_KEY, "column_name").agg(
        F.max("description").alias("description"))
    definitions = views.groupBy("dataset_id", F.col("view_name").alias("table_name")).agg(
        F.max("view_definition").alias("view_definition"))
    return (columns.join(top, [*TABLE_KEY, "column_name"], "left")
            .join(option_counts, TABLE_KEY, "left").join(definitions, TABLE_KEY, "left")
            .withColumn("option_count", F.coalesce("option_count", F.lit(0))))


def access_rows(datasets: DataFrame) -> DataFrame:
    """One row per dataset and access entry."""
    return datasets.select("dataset_id", F.explode("access_entries").alias("e")).select("dataset_id", "e.*")


def authorized_views(access: DataFrame) -> DataFrame:
    return access.where(F.col("entity_type") == "view").select(
        "dataset_id", F.col("entity_id").alias("authorized_view"))


def section_counts(documents: DataFrame) -> DataFrame:
    """Records per coverage section over a folder of documents; one pass over the text."""
    def cell(name: str):
        outer, _, inner = name.partition(".")
        return F.col(outer)[inner] if inner else F.col(outer)
    sums = documents.agg(*[F.coalesce(F.sum(F.greatest(F.size(cell(n)), F.lit(0))), F.lit(0)).alias(f"s{i}")
                           for i, n in enumerate(COVERAGE_SECTIONS)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("section"), F.col(f"s{i}").alias("records"))
        for i, n in enumerate(COVERAGE_SECTIONS)])))


def coverage_of(sections: dict[str, DataFrame]) -> DataFrame:
    """Record counts of section tables; sections without a table count zero."""
    any_df = next(iter(sections.values()))
    parts = []
    for i, n in enumerate(COVERAGE_SECTIONS):
        counted = sections[n].agg(F.count("*").alias("records")) if n in sections else (
            any_df.sparkSession.range(1).select(F.lit(0).cast("long").alias("records")))
        parts.append(counted.select(F.lit(i + 1).alias("ordinal"), F.lit(n).alias("section"), "records"))
    return reduce(DataFrame.unionByName, parts)


def coverage_report(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", coverage_bucket(F.col("records")))


def coverage_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("sections"), F.count_if(F.col("records") > 0).alias("populated"))
