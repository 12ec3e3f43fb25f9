"""Table, column, field and partition inventories.

Row counts and sizes come from the files themselves: grouping by file needs no
data column, so parquet answers from footers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.display import layer_of, size_mb, table_kind
from ..sources.tables import file_facts
from ..sources.sinks import read_layout
from ..types import SECTION_SCHEMAS
from .skew import stored
from .specs import TableSpec


def _has_files(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path")
        return True
    except AnalysisException:
        return False


def files_of(df: DataFrame, *group: Column, also: tuple[Column, ...] = ()) -> DataFrame:
    """Rows per file (and group), with the file's size and time, and any further aggregates."""
    facts = file_facts(df) if _has_files(df) else [
        F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("long").alias("file_size"),
        F.lit(None).cast("timestamp").alias("file_modified")]
    return df.groupBy(*group, *facts).agg(F.count("*").alias("rows"), *also)


def stored_spec(spark: SparkSession, dataset: str, name: str, path: str) -> TableSpec:
    """A stored table with the layout its writer recorded; nothing is filled in by hand."""
    layout = read_layout(spark, path)
    return TableSpec(dataset, name, spark.read.parquet(path), partition_column=next(iter(layout["partition_columns"]), None),
                     cluster_columns=tuple(layout["sort_columns"]))


def table_inventory(specs: list[TableSpec]) -> DataFrame:
    """One row per table or view: rows, bytes, columns and layout."""
    def one(s: TableSpec) -> DataFrame:
        if s.is_view:
            counted = s.df.sparkSession.range(1).select(
                F.lit(0).cast("long").alias("num_rows"), F.lit(0).cast("long").alias("num_bytes"),
                F.lit(None).cast("timestamp").alias("modified"))
        else:
            counted = files_of(s.df).agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("num_rows"),
                F.coalesce(F.sum("file_size"), F.lit(0)).alias("num_bytes"),
                F.max("file_modified").alias("modified"))
        return counted.select(
            F.lit(s.dataset).alias("dataset_id"), F.lit(s.name).alias("table_name"),
            table_kind(F.lit(s.kind)).alias("table_type"), "num_rows", "num_bytes",
            size_mb(F.col("num_bytes")).alias("size_mb"), "modified",
            F.lit(len(s.df.columns)).cast("long").alias("column_count"),
            F.lit(s.partition_column).cast("string").alias("partition_column"),
            F.array(*[F.lit(c) for c in s.cluster_columns]).cast("array<string>").alias("clustering_fields"),
            F.lit(s.require_partition_filter).alias("require_partition_filter"),
            F.from_json(F.to_json(F.create_map(*[F.lit(x) for kv in s.labels.items() for x in kv])),
                        "map<string,string>").alias("labels") if s.labels else
            F.lit(None).cast("map<string,string>").alias("labels"),
            F.lit(s.description).cast("string").alias("description"),
            F.lit(s.friendly_name).cast("string").alias("friendly_name"))
    return reduce(DataFrame.unionByName, [one(s) for s in specs])


def overview(inventory: DataFrame, **section_counts: DataFrame) -> DataFrame:
    """Totals over the inventory, plus the size of any sibling section given by name.

    Every input becomes one row with its own columns; the rows are then merged into one.
    """
    parts = [inventory.agg(
        F.coalesce(F.sum("column_count"), F.lit(0)).alias("total_columns"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("num_bytes"), F.lit(0)).alias("total_bytes"),
        F.count_if(F.col("table_type") == "VIEW").alias("views"),
        F.count_if(F.col("table_type") != "VIEW").alias("tables"))]
    parts += [df.agg(F.count("*").alias(name)) for name, df in section_counts.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# Column metadata keys: Spark's own for defaults, ours for what a schema has no place for.
_DEFAULT, _GENERATED, _ROUNDING, _SYSTEM = "CURRENT_DEFAULT", "generation_expression", "rounding_mode", "system_defined"


def _collation(t: T.DataType) -> str | None:
    name = getattr(t, "collation", None) if isinstance(t, T.StringType) else None
    return None if name in (None, "UTF8_BINARY") else name


def column_inventory(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    """One row per column with all its surveyed attributes, from schemas alone.

    Defaults, generation expressions, rounding modes and system columns come from the field's
    metadata; names that start with an underscore are hidden, as they are to folder scans.
    """
    rows = []
    yes = lambda x: "YES" if x else "NO"
    for s in specs:
        for i, f in enumerate(s.df.schema.fields):
            clustered = s.cluster_columns.index(f.name) + 1 if f.name in s.cluster_columns else None
            m = f.metadata or {}
            rows.append((s.dataset, s.name, f.name, i + 1, yes(f.nullable), f.dataType.simpleString(), yes(f.name == s.partition_column),
                         clustered, yes(f.name.startswith("_")), yes(m.get(_SYSTEM)), "ALWAYS" if m.get(_GENERATED) else "NEVER",
                         m.get(_GENERATED), m.get(_DEFAULT), _collation(f.dataType), m.get(_ROUNDING)))
    schema = T.StructType([SECTION_SCHEMAS["columns"][n] for n in (
        "dataset_id", "table_name", "column_name", "ordinal_position", "is_nullable", "data_type", "is_partitioning_column",
        "clustering_ordinal_position", "is_hidden", "is_system_defined", "is_generated", "generation_expression", "column_default",
        "collation_name", "rounding_mode")])
    return spark.createDataFrame(rows, schema)


def schema_paths(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    """Every dotted path of a schema; array elements share their array's path."""
    out: list[tuple[str, T.DataType]] = []

    def walk(t: T.DataType, path: str) -> None:
        while isinstance(t, T.ArrayType):
            t = t.elementType
        if isinstance(t, T.StructType):
            for f in t.fields:
                p = f"{path}.{f.name}" if path else f.name
                out.append((p, f.dataType))
                walk(f.dataType, p)
    walk(schema, "")
    return out


def _present(schema: T.StructType, path: str) -> Column:
    """True when the path holds a value, or for arrays when any element does."""
    def reach(c: Column, t: T.DataType, parts: list[str]) -> Column:
        if isinstance(t, T.ArrayType) and parts:
            return F.exists(c, lambda e: F.coalesce(reach(e, t.elementType, parts), F.lit(False)))
        if not parts:
            return c.isNotNull()
        return reach(c.getField(parts[0]), t[parts[0]].dataType, parts[1:])
    first, *rest = path.split(".")
    return F.coalesce(reach(F.col(f"`{first}`"), schema[first].dataType, rest), F.lit(False))


def field_paths(spec: TableSpec) -> DataFrame:
    """One row per nested path with its type and how many rows have a value there; one scan."""
    paths = schema_paths(spec.df.schema)
    counted = spec.df.agg(F.count("*").alias("total"), *[
        F.count_if(_present(spec.df.schema, p)).alias(f"p{i}") for i, (p, _) in enumerate(paths)])
    return counted.select("total", F.inline(F.array(*[F.struct(
        F.lit(p.split(".")[0]).alias("column_name"), F.lit(p).alias("field_path"),
        F.lit(t.simpleString()).alias("data_type"), F.col(f"p{i}").alias("present_rows"))
        for i, (p, t) in enumerate(paths)]))).select(
        F.lit(spec.dataset).alias("dataset_id"), F.lit(spec.name).alias("table_name"), "column_name",
        "field_path", "data_type", F.col("total").alias("total_rows"), "present_rows")


def filled_rows(specs: list[TableSpec]) -> DataFrame:
    """One row per column of many tables with how many rows have a value there; one scan a table."""
    def one(s: TableSpec) -> DataFrame:
        columns = s.df.columns
        counted = s.df.agg(*[F.count(F.col(f"`{c}`")).alias(f"p{i}") for i, c in enumerate(columns)])
        return counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"p{i}").alias("present_rows"))
                                                 for i, c in enumerate(columns)]))).select(
            F.lit(s.dataset).alias("dataset_id"), F.lit(s.name).alias("table_name"), "column_name", "present_rows")
    return reduce(DataFrame.unionByName, [one(s) for s in specs])


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """Keys of a JSON text column: rows that have the key and rows where it is not null."""
    pairs = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("k", "v"))
    return pairs.groupBy(F.concat(F.lit(column + "."), F.col("k")).alias("field_path")).agg(
        F.count("*").alias("present_rows"), F.count("v").alias("non_null_rows"))


def json_tree(df: DataFrame, column: str) -> DataFrame:
    """Every path of a JSON text column, of any depth: rows (field_path, data_type, n_values, n_null).

    Values are parsed once into variants. Each round counts the values of a level by path and
    type and opens its objects (``.key``) and arrays (``[]``) for the next, so the depth comes from the
    data. A path that holds several types has a row for each; nulls are counted on all of them.
    Text that is no JSON is reported as one path of type ``invalid``.
    """
    text = F.col(f"`{column}`")
    first = df.where(text.isNotNull()).select(F.lit(column).alias("field_path"), F.try_parse_json(text).alias("v"))
    level, counts = first, []
    while True:
        kind = F.when(F.col("v").isNull(), "invalid").otherwise(F.regexp_extract(F.schema_of_variant("v"), "^[A-Za-z_]+", 0))
        seen = stored(level.groupBy("field_path", kind.alias("data_type")).agg(F.count("*").alias("n_values")), "json-paths")
        counts.append(seen)
        if seen.where(F.col("data_type").isin("OBJECT", "ARRAY")).isEmpty():
            break
        inner = level.where(F.schema_of_variant("v").startswith("OBJECT") | F.schema_of_variant("v").startswith("ARRAY"))
        opened = inner.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("pos", "key", "value"))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
        level = stored(opened.select(F.concat("field_path", step).alias("field_path"), F.col("value").alias("v")), "json-level")
    found = reduce(DataFrame.unionByName, counts)
    nulls = found.where("data_type = 'VOID'").select("field_path", F.col("n_values").alias("n_null"))
    typed = found.where("data_type <> 'VOID'").join(nulls, "field_path", "full")
    return typed.select("field_path", F.coalesce("data_type", F.lit("VOID")).alias("data_type"), F.coalesce("n_values", F.lit(0)).alias("n_values"),
                        F.coalesce("n_null", F.lit(0)).alias("n_null"))


# Fixed value: the partition of a table that has none.
UNPARTITIONED = "__UNPARTITIONED__"


def all_partition_stats(specs: list[TableSpec], partition_ids: dict[str, Column]) -> DataFrame:
    """``partition_stats`` of many tables as one plan; tables without a partition column are one partition."""
    return reduce(DataFrame.unionByName, [partition_stats(s.df, partition_ids.get(s.name, F.lit(UNPARTITIONED))).select(
        F.lit(s.dataset).alias("dataset_id"), F.lit(s.name).alias("table_name"), "*") for s in specs if not s.is_view])


def all_storage_stats(partitions: DataFrame) -> DataFrame:
    """The statistics of many tables' partitions rolled up to one row per table."""
    return partitions.groupBy("dataset_id", "table_name").agg(
        F.sum("total_rows").alias("total_rows"), F.count("*").alias("total_partitions"),
        F.sum("total_logical_bytes").alias("total_logical_bytes"), F.max("last_modified_time").alias("storage_last_modified_time"))


def partition_stats(df: DataFrame, partition_id: Column) -> DataFrame:
    """Rows, bytes and last change per partition.

    Bytes are whole files: exact when the table is stored in partition folders,
    where each file belongs to one partition.
    """
    return (files_of(df, partition_id.alias("partition_id"))
            .where(F.col("partition_id").isNotNull())
            .groupBy("partition_id").agg(
                F.sum("rows").alias("total_rows"), F.sum("file_size").alias("total_logical_bytes"),
                F.max("file_modified").alias("last_modified_time")))


def storage_stats(partitions: DataFrame) -> DataFrame:
    """Partition statistics rolled up to the table."""
    return partitions.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("total_partitions"),
        F.sum("total_logical_bytes").alias("total_logical_bytes"),
        F.max("last_modified_time").alias("storage_last_modified_time"))


def layer_nodes(inventory: DataFrame) -> DataFrame:
    return inventory.select(layer_of(F.col("dataset_id")).alias("layer"), "dataset_id", "table_name")
