"""Schemas of the raw layer and of the metadata records.

Raw business columns are text by design; the staging layer types them. The
metadata schemas are explicit so that an empty section keeps its columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(names: list[str], default: T.DataType = S, **typed: T.DataType) -> T.StructType:
    """The named fields, of the default type unless ``typed`` says otherwise."""
    return T.StructType([T.StructField(n, typed.get(n, default)) for n in names])


# Raw layer columns, in order.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct(
        ["customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "gender", "address_line1",
         "city", "state", "country", "postal_code", "created_at", "updated_at", "source_system", "_ingested_at"], _ingested_at=TS),
    "products": _struct(
        ["product_id", "product_name", "category", "subcategory", "brand", "unit_price", "cost_price",
         "weight_kg", "is_active", "created_at", "source_system", "_ingested_at"], _ingested_at=TS),
    "orders": _struct(
        ["order_id", "customer_id", "order_date", "order_status", "shipping_method", "shipping_address_city",
         "shipping_address_state", "shipping_address_country", "total_amount", "discount_amount", "tax_amount",
         "currency", "source_system", "_ingested_at"], _ingested_at=TS),
    "order_items": _struct(
        ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "subtotal", "_ingested_at"], _ingested_at=TS),
    "payments": _struct(
        ["payment_id", "order_id", "payment_method", "payment_status", "amount", "currency", "processed_at",
         "gateway_reference", "card_last_four", "source_system", "_ingested_at"], _ingested_at=TS),
    "shipping_events": _struct(
        ["event_id", "order_id", "carrier", "tracking_number", "event_type", "event_timestamp", "location",
         "source_system", "_ingested_at"], _ingested_at=TS),
}

TABLE_REF = _struct(["project_id", "dataset_id", "table_id"])
ACCESS_ENTRY = _struct(["role", "entity_type", "entity_id"])
LABELS = T.MapType(S, S)

SCHEMA_FIELD = T.StructType(
    _struct(["name", "field_type", "mode", "description"]).fields
    + [T.StructField("fields", T.ArrayType(_struct(["name", "field_type", "mode", "description"])))])

COLUMN_PROFILE = _struct(
    ["column_name", "data_type", "total_rows", "null_count", "null_pct", "distinct_count", "uniqueness_pct",
         "min", "max", "mean", "stddev", "min_length", "max_length", "avg_length", "error"],
    total_rows=L, null_count=L, null_pct=D, distinct_count=L, uniqueness_pct=D, mean=D, stddev=D,
    min_length=L, max_length=L, avg_length=D)

# Record layout of each section of a metadata document.
SECTION_SCHEMAS: dict[str, T.StructType] = {
    "datasets": _struct(
        ["project_id", "dataset_id", "description", "friendly_name", "location", "created", "modified",
         "default_table_expiration_ms", "default_partition_expiration_ms", "labels", "access_entries"],
        default_table_expiration_ms=L, default_partition_expiration_ms=L, labels=LABELS,
        access_entries=T.ArrayType(ACCESS_ENTRY)),
    "tables": _struct(
        ["project_id", "dataset_id", "table_name", "table_type", "description", "friendly_name", "created",
         "modified", "expires", "num_rows", "num_bytes", "size_mb", "labels", "partitioning",
         "clustering_fields", "streaming_buffer", "require_partition_filter", "schema_fields"],
        num_rows=L, num_bytes=L, size_mb=D, labels=LABELS,
        partitioning=_struct(["type", "field", "expiration_ms", "require_partition_filter", "range_start", "range_end",
         "range_interval"], expiration_ms=L, require_partition_filter=B,
                             range_start=L, range_end=L, range_interval=L),
        clustering_fields=T.ArrayType(S),
        streaming_buffer=_struct(["estimated_rows", "estimated_bytes", "oldest_entry_time"],
                                 estimated_rows=L, estimated_bytes=L),
        require_partition_filter=B, schema_fields=T.ArrayType(SCHEMA_FIELD)),
    "columns": _struct(
        ["project_id", "dataset_id", "table_name", "column_name", "ordinal_position", "is_nullable",
         "data_type", "is_partitioning_column", "clustering_ordinal_position", "is_hidden", "is_system_defined",
         "is_generated", "generation_expression", "column_default", "collation_name", "rounding_mode"],
        ordinal_position=L, clustering_ordinal_position=L),
    "column_field_paths": _struct(
        ["project_id", "dataset_id", "table_name", "column_name", "field_path", "data_type", "description",
         "collation_name"]),
    "views": _struct(["project_id", "dataset_id", "view_name", "view_definition", "check_option", "use_standard_sql"]),
    "routines": _struct(
        ["project_id", "dataset_id", "routine_name", "routine_type", "routine_body", "routine_definition",
         "return_type", "external_language", "is_deterministic", "security_type", "created", "last_modified"]),
    "routine_parameters": _struct(
        ["project_id", "dataset_id", "routine_name", "ordinal_position", "parameter_mode", "parameter_name",
         "data_type", "is_result"], ordinal_position=L),
    "scheduled_queries": _struct(
        ["name", "config_id", "destination_dataset", "schedule", "disabled", "state", "update_time",
         "next_run_time", "params", "schedule_options_disable_auto_scheduling"],
        disabled=B, params=LABELS, schedule_options_disable_auto_scheduling=B),
    "storage": _struct(
        ["project_id", "dataset_id", "table_name", "table_type", "creation_time", "total_rows",
         "total_partitions", "total_logical_bytes", "storage_last_modified_time", "deleted"],
        total_rows=L, total_partitions=L, total_logical_bytes=L, deleted=B),
    "table_constraints": _struct(
        ["project_id", "dataset_id", "table_name", "constraint_name", "constraint_type", "is_deferrable",
         "initially_deferred", "enforced"]),
    "key_column_usage": _struct(
        ["project_id", "dataset_id", "table_name", "constraint_name", "column_name", "ordinal_position",
         "position_in_unique_constraint"], ordinal_position=L, position_in_unique_constraint=L),
    "table_options": _struct(["project_id", "dataset_id", "table_name", "option_name", "option_type", "option_value"]),
    "row_level_security": _struct(
        ["project_id", "dataset_id", "table_name", "policy_name", "filter_predicate", "created",
         "last_modified"]),
    "snapshots": _struct(
        ["project_id", "dataset_id", "snapshot_table_name", "base_table_project", "base_table_dataset",
         "base_table_name", "snapshot_time"]),
    "partitions": _struct(
        ["project_id", "dataset_id", "table_name", "partition_id", "total_rows", "total_logical_bytes",
         "last_modified_time"], total_rows=L, total_logical_bytes=L),
    "streaming_buffers": _struct(
        ["project_id", "dataset_id", "table_name", "estimated_rows", "estimated_bytes", "oldest_entry_time"],
        estimated_rows=L, estimated_bytes=L),
    "quality": _struct(
        ["dataset_id", "table_name", "table_type", "row_count", "note", "columns"], row_count=L,
        columns=T.ArrayType(COLUMN_PROFILE)),
    "jobs": _struct(
        ["job_id", "user_email", "job_type", "state", "creation_time", "end_time", "bytes_processed",
         "bytes_billed", "cache_hit", "statement_type", "priority", "total_slot_ms", "error_result",
         "query_preview", "referenced_tables", "destination_table"],
        bytes_processed=L, bytes_billed=L, cache_hit=B, total_slot_ms=L,
        referenced_tables=T.ArrayType(TABLE_REF), destination_table=TABLE_REF),
    "pii_classification": _struct(
        ["dataset_id", "table_name", "column_name", "pii_classification", "confidence"]),
    "materialized_views": _struct(
        ["project_id", "dataset_id", "view_name", "last_refresh_time", "refresh_watermark"]),
}

LINEAGE = T.StructType([
    T.StructField("table_lineage", T.ArrayType(_struct(["upstream", "downstream", "transform"]))),
    T.StructField("column_lineage", T.ArrayType(_struct(["upstream_col", "downstream_col", "transform"]))),
])

ACCESS = T.StructType([
    T.StructField("dataset_permissions", T.ArrayType(T.StructType([
        T.StructField("dataset_id", S),
        T.StructField("access_entries", T.ArrayType(_struct(["role", "entity_type", "entity_id", "dataset_id"]))),
    ]))),
    T.StructField("authorized_views", T.ArrayType(_struct(["dataset_id", "authorized_view"]))),
])

EXTRACTION = T.StructType([
    T.StructField("project_id", S), T.StructField("extracted_at", S),
    T.StructField("datasets_scanned", T.ArrayType(S)), T.StructField("extractor_version", S)])

# Sections that only exist for the coverage report; their records are not modelled further.
OPAQUE_SECTIONS = ["search_indexes", "vector_indexes", "bi_engine"]

METADATA_DOCUMENT = T.StructType(
    [T.StructField("extraction_metadata", EXTRACTION)]
    + [T.StructField(n, T.ArrayType(s)) for n, s in SECTION_SCHEMAS.items()]
    + [T.StructField("lineage", LINEAGE), T.StructField("access", ACCESS)]
    + [T.StructField(n, T.ArrayType(LABELS)) for n in OPAQUE_SECTIONS])
