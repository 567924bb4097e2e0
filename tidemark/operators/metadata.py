"""Metadata tables: their shapes, lookups, column specs and row replacement."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.sizes import BROADCAST_BYTES, broadcast_if_small
from tidemark.functions.types import spark_type, struct_of

_CHANGED = "created_by string, created_date timestamp_ntz, modified_by string, modified_date timestamp_ntz"

# The columns of the six metadata tables.
CONNECTION_INFO = struct_of(
    "connection_id bigint, connection_name string, connection_url string, user_name string, "
    f"password_encrypted string, security_token string, {_CHANGED}"
)
INGESTION_CONFIG = struct_of(
    "ingestion_config_id bigint, ingestion_type string, source_schema_table_name string, "
    "primary_key_column string, incremental_date_column string, load_type string, "
    "extra_parameters string, partitioned_by string, api_source_name string, source_system string, "
    "connection_name string, project_id string, database_schema string, table_name string, "
    "file_format string, header string, delimiter string, quote_characters string, "
    "escape_characters string, accepted_encoding string, is_parquet boolean, to_parquet boolean, "
    f"bucket string, bucket_destination string, archive_destination string, {_CHANGED}"
)
COLUMN_DETAILS = struct_of(
    "column_name string, datatype string, ordinal_position bigint, mapping_column string, "
    f"project_id string, database_schema string, table_name string, {_CHANGED}"
)
ACTION_HISTORY = struct_of(
    "action_id bigint, connection_name string, database_schema string, table_name string, "
    "executed_by string, execution_start_datetime timestamp_ntz, "
    "execution_end_datetime timestamp_ntz, execution_status bigint"
)
AUDIT_DETAILS = struct_of(
    "audit_id bigint, action_id bigint, connection_name string, database_schema string, "
    "table_name string, execution_start_datetime timestamp_ntz, "
    "execution_end_datetime timestamp_ntz, execution_duration bigint, record_cnt_before bigint, "
    "record_cnt_after bigint, delta double, delta_avg double, delta_variance double, "
    "delta_std_deviation double"
)
SPARK_CONFIG = struct_of(
    "spark_id bigint, application_name string, executor_instances string, executor_memory string, "
    "executor_cores string, driver_memory string, driver_cores string, "
    "auto_broadcast_join_threshold string, shuffle_partitions string, broadcast_timeout string, "
    f"connection_id bigint, connection_name string, bucket string, source_file string, {_CHANGED}"
)

# What a load needs to know, in the order the lookup returns it.
FROM_CONNECTION = ("connection_url", "user_name", "password_encrypted", "security_token")
FROM_CONFIG = (
    "ingestion_type", "source_schema_table_name", "primary_key_column", "incremental_date_column",
    "load_type", "extra_parameters", "project_id", "database_schema", "table_name", "file_format",
    "header", "delimiter", "quote_characters", "escape_characters", "accepted_encoding",
    "is_parquet", "to_parquet", "bucket", "bucket_destination", "archive_destination",
)

TABLE_KEY = ("project_id", "database_schema", "table_name")


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a table: read ``source``, cast to ``datatype``, call it ``target``."""

    source: str
    datatype: str
    target: str

    @property
    def type(self) -> T.DataType:
        return spark_type(self.datatype)


def connection_details(
    connections: DataFrame,
    configs: DataFrame,
    from_connection: Sequence[str] = FROM_CONNECTION,
    from_config: Sequence[str] = FROM_CONFIG,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Connections joined to the tables they feed, without repeats.

    Repeats are removed before the join (partial aggregation on both sides), so a
    connection with a third of all rows is already reduced when rows move.
    """
    left = connections.select("connection_name", *from_connection).distinct()
    right = configs.select("connection_name", *from_config).distinct()
    left, _ = broadcast_if_small(left, broadcast_bytes)
    # Both sides are distinct and all their columns stay, so the result is too.
    return right.join(left, "connection_name").select(
        "connection_name", *from_connection, *from_config
    )


def lookup(df: DataFrame, **equals: str) -> DataFrame:
    """Rows whose columns equal the given values; the predicates reach the scan."""
    for name, value in equals.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def lookup_ci(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column equals the value when case is ignored."""
    return df.filter(F.upper(column) == F.lit(value.upper()))


def runtime_profile(spark_config: DataFrame, application_name: str) -> DataFrame:
    """The stored session settings of an application (name matched without case)."""
    return lookup_ci(spark_config, "application_name", application_name).select(
        "application_name", "executor_instances", "executor_memory", "executor_cores",
        "driver_memory", "driver_cores", "auto_broadcast_join_threshold", "shuffle_partitions",
        "broadcast_timeout", "bucket", "source_file",
    )


def column_specs(details: DataFrame) -> DataFrame:
    """The four column lists of every table, in ordinal order.

    Any position is allowed, equal ones stand in the order of datatype and names. A
    column without a mapping appears in the source list only. A table's lists are one
    row, as long as its columns in the metadata.
    """
    columns = details.groupBy(*TABLE_KEY).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "ordinal_position",
                    "datatype",
                    F.lower("column_name").alias("source"),
                    F.lower("mapping_column").alias("target"),
                )
            )
        ).alias("c")
    )

    def listed(text: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform("c", text), ", ")  # a NULL text is left out

    return columns.select(
        *TABLE_KEY,
        listed(lambda e: F.concat(e["target"], F.lit(" "), e["datatype"])).alias("create_columns"),
        listed(
            lambda e: F.concat(
                F.lit("SAFE_CAST("), e["source"], F.lit(" AS "), e["datatype"], F.lit(") AS "), e["target"]
            )
        ).alias("cast_columns"),
        listed(lambda e: e["source"]).alias("source_columns"),
        listed(lambda e: e["target"]).alias("target_columns"),
    )


def compile_columns(details: DataFrame, **table: str) -> list[ColumnSpec]:
    """The specs of one table for execution: one metadata row per column comes to the driver."""
    rows = (
        lookup(details, **table)
        .select("column_name", "datatype", "ordinal_position", "mapping_column")
        .orderBy("ordinal_position")
        .collect()
    )
    if not rows:
        raise ValueError(f"no column metadata for {table}")
    specs = [
        ColumnSpec(r["column_name"].lower(), r["datatype"], r["mapping_column"].lower())
        for r in rows
        if r["mapping_column"] is not None
    ]
    return check_specs(specs)


def check_specs(specs: Sequence[ColumnSpec]) -> list[ColumnSpec]:
    """Reject two columns with one target name and unknown datatypes."""
    seen: set[str] = set()
    for spec in specs:
        if spec.target in seen:
            raise ValueError(f"two source columns map to {spec.target!r}")
        seen.add(spec.target)
        spark_type(spec.datatype)
    return list(specs)


def specs_of(spark: SparkSession, rows: Sequence[tuple], **table: str) -> DataFrame:
    """Column-details rows from ``(column, datatype, target)`` tuples, numbered in order."""
    fixed = (table.get("project_id"), table.get("database_schema"), table.get("table_name"))
    return spark.createDataFrame(
        [(c, d, i, m, *fixed, None, None, None, None) for i, (c, d, m) in enumerate(rows, 1)],
        COLUMN_DETAILS,
    )


def replace_by_key(
    old: DataFrame, new: DataFrame, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``old`` without the rows whose key occurs in ``new``, plus ``new``."""
    replaced, _ = broadcast_if_small(new.select(*keys).distinct(), broadcast_bytes)
    return old.join(replaced, list(keys), "left_anti").select(*old.columns).unionByName(new)
