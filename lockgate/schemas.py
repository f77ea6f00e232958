"""Schemas of every report. Nothing is inferred, so empty and all-NULL reports are valid."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(text: str) -> T.StructType:
    """'name type, name type' as a StructType; unlike fromDDL it needs no session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


INVENTORY = struct(
    """
    database_name string, database_location string, database_owner string, table_name string,
    object_type string, data_provider string, table_location string, table_owner string,
    serde_library string, input_format string, output_format string, table_properties string,
    partition_columns array<string>, num_columns bigint, estimated_rows bigint,
    estimated_bytes bigint, is_delta boolean, has_partitions boolean, error_message string
    """
)
COLUMNS = struct("table_name string, column_name string, ordinal int, data_type string")
SCHEMA_MAPPING = struct(
    "src_database string, tgt_catalog string, tgt_schema string, name_changed boolean, status string"
)
LOCATIONS = struct(
    "location_name string, storage_path string, credential string, status string"
)
MIGRATION_LOG = struct(
    """
    src_table string, tgt_table string, strategy string, status string, duration_sec double,
    rows_copied bigint, bytes_copied bigint, error_message string, migrated_at timestamp
    """
)
GRANTS = struct(
    """
    src_object_type string, src_database string, src_object string, principal string,
    privilege string, grant_option boolean
    """
)
FINDINGS = struct(
    "src_table string, scope string, item string, metric string, src_value string, tgt_value string, status string"
)
INTEGRITY = struct("table_name string, n_rows bigint, status string, error_message string")
ROLLBACK_LOG = struct(
    "action string, tgt_object string, src_object string, statement string, status string, planned_at timestamp"
)
PERMISSION_LOG = struct(
    """
    src_object string, tgt_object string, principal string, src_privilege string, tgt_privilege string,
    grant_sql string, status string, error_message string
    """
)
VIEW_LOG = struct("src_view string, tgt_view string, create_sql string, status string, error_message string")
GATE = struct("src_table string, check string, n_checks bigint, n_failed bigint, detail string, status string")
DRILLDOWN = struct("src_table string, key string, n_src bigint, n_tgt bigint, finding string")
