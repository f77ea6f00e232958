"""Values that results depend on."""

# Words that may not name a database, schema or table.
RESERVED_WORDS = [
    "catalog", "schema", "database", "table", "view", "column", "function",
    "volume", "storage", "credential", "location", "share", "recipient", "provider",
]

# Serdes and input formats the target cannot hold.
UNSUPPORTED_SERDES = [
    "org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe",
    "org.apache.hadoop.hive.ql.io.orc.OrcSerde",
    "org.apache.hadoop.hive.ql.io.RCFileSerDe",
]
UNSUPPORTED_INPUT_FORMATS = [
    "org.apache.hadoop.hive.ql.io.RCFileInputFormat",
    "org.apache.hadoop.mapred.SequenceFileInputFormat",
    "com.databricks.spark.avro",
]

# File formats that are rewritten into the managed format.
FORMATS_TO_CONVERT = ["parquet", "orc", "csv", "json", "avro", "text"]

# Source privilege -> target privilege.
PRIVILEGES = {
    "SELECT": "SELECT",
    "INSERT": "MODIFY",
    "UPDATE": "MODIFY",
    "DELETE": "MODIFY",
    "ALL PRIVILEGES": "ALL PRIVILEGES",
    "ALL": "ALL PRIVILEGES",
    "CREATE": "CREATE TABLE",
    "USAGE": "USE SCHEMA",
    "READ_METADATA": "BROWSE",
    "MODIFY": "MODIFY",
}

# Path prefixes that form one storage root, first match wins.
STORAGE_ROOTS = [
    r"^(abfss://[^@]+@[^/]+\.dfs\.core\.windows\.net/[^/]+)",
    r"^(wasbs?://[^@]+@[^/]+\.blob\.core\.windows\.net/[^/]+)",
    r"^(s3[an]?://[^/]+)",
    r"^(gs://[^/]+)",
    r"^(dbfs:/mnt/[^/]+)",
]

# Type names that mean the same type.
TYPE_ALIASES = {"int": "integer", "long": "bigint", "float": "real", "bool": "boolean"}

# Limits on names.
MAX_NAME = 255
MAX_LOCATION_NAME = 127

# Object types and the codes used in reports.
MANAGED, EXTERNAL, VIEW, ERROR = "MANAGED", "EXTERNAL", "VIEW", "ERROR"
DEEP_COPY, REGISTER_IN_PLACE, RECREATE_VIEW = "DEEP_COPY", "REGISTER_IN_PLACE", "RECREATE_VIEW"
CONVERT, REVIEW = "CONVERT", "REVIEW"
