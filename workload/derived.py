"""Metadata tables derived from the given ones, in SQL that both engines run.

One part is one catalogued object, one customer one view, one order one grant, so that the metadata
operators work on inputs that grow with the data.
"""

# Objects: names good and bad, all types and formats, locations in every kind of store.
OBJECTS = r"""
SELECT
  CASE WHEN p_size = 1 THEN 'catalog' WHEN p_size = 2 THEN 'Schema' WHEN p_size = 3 THEN '2024_vendas'
       WHEN p_size = 4 THEN 'minha-base' WHEN p_size < 20 THEN p_brand
       ELSE replace(lower(p_brand), '#', '_') END AS database_name,
  CASE WHEN p_size = 5 THEN 'TABLE' WHEN p_size = 6 THEN p_name WHEN p_size = 7 THEN ''
       WHEN p_size = 8 THEN repeat('a', 256) WHEN p_size = 9 THEN repeat('a', 255)
       WHEN p_size = 10 THEN CAST(NULL AS STRING)
       ELSE replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) END AS table_name,
  CASE WHEN p_size = 50 THEN 'ERROR' WHEN p_size % 5 < 2 THEN 'MANAGED' WHEN p_size % 5 < 4 THEN 'EXTERNAL'
       ELSE 'VIEW' END AS object_type,
  CASE p_type WHEN 'ECONOMY' THEN 'delta' WHEN 'SMALL' THEN 'DELTA' WHEN 'MEDIUM' THEN 'parquet'
       WHEN 'PROMO' THEN 'orc' WHEN 'STANDARD' THEN 'csv' ELSE 'hive' END AS data_provider,
  CASE p_partkey % 7
       WHEN 0 THEN 'abfss://data@acct' || CAST(p_size AS STRING) || '.dfs.core.windows.net/' || lower(p_type) || '/x/' || p_name
       WHEN 1 THEN 'wasbs://raw@acct' || CAST(p_size AS STRING) || '.blob.core.windows.net/in/' || p_name
       WHEN 2 THEN 's3a://bucket-' || CAST(p_size AS STRING) || '/a/b/' || p_name
       WHEN 3 THEN 'gs://bucket.' || CAST(p_size AS STRING) || '/a/' || p_name
       WHEN 4 THEN 'dbfs:/mnt/Lake' || CAST(p_size AS STRING) || '/t/' || p_name
       WHEN 5 THEN 'dbfs:/user/' || p_brand || '/t--' || CAST(p_size AS STRING)
       ELSE '' END AS table_location,
  CASE WHEN p_size % 4 = 0 THEN CAST(NULL AS STRING) WHEN p_size % 4 = 1 THEN ''
       ELSE 'owner_' || CAST(p_size AS STRING) END AS table_owner,
  CASE p_size % 6 WHEN 0 THEN 'org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe'
       WHEN 1 THEN 'org.apache.hadoop.hive.ql.io.orc.OrcSerde'
       WHEN 2 THEN 'org.example.DeltaSource' WHEN 3 THEN CAST(NULL AS STRING) ELSE '' END AS serde_library,
  CASE p_size % 9 WHEN 0 THEN 'org.apache.hadoop.mapred.SequenceFileInputFormat'
       WHEN 1 THEN 'com.databricks.spark.avro' ELSE 'org.apache.hadoop.mapred.TextInputFormat' END AS input_format,
  p_size % 2 = 0 AS has_partitions,
  p_partkey * 10 AS estimated_rows,
  p_partkey * 1000 AS estimated_bytes
FROM {part}
"""

# Views: quoted, bare, unmapped and three-part references; some without AS, some without text.
VIEW_HEAD = "'CREATE VIEW `' || d || '`.`' || v || '` as ' || chr(10) || '  '"
VIEW_PIECES = {
    "open": "'SELECT `t`.`id`, x.orders.total FROM '",
    "ref_1": "'`' || d || '`.`orders`'",
    "join_1": "' `t` JOIN '",
    "ref_2": "'`extra_' || c_mktsegment || '`.`refs`'",
    "join_2": "' r ON t.id = r.id JOIN '",
    "ref_3": "'Sales_' || CAST((c_nationkey + 1) % 25 AS STRING) || '.items'",
    "close": "' i ON i.id = t.id WHERE `a`.`b`.`c` = 1'",
}
VIEW_BODY = " || ".join(VIEW_PIECES.values())
VIEW_NAMES = """
SELECT 'Sales_' || CAST(c_nationkey AS STRING) AS d, 'vw_' || CAST(c_custkey AS STRING) AS v,
       c_nationkey, c_mktsegment, c_custkey
FROM {customer}
"""
VIEWS = f"""
SELECT d AS database_name, v AS table_name,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'nothing to see' WHEN 'FURNITURE' THEN CAST(NULL AS STRING)
            ELSE {VIEW_HEAD} || {VIEW_BODY} || ' ' END AS ddl
FROM ({VIEW_NAMES}) n
"""

# Grants: every privilege in both cases, an unknown one, objects of every type, unmapped databases.
GRANTS = """
SELECT t AS src_object_type, d AS src_database,
       CASE WHEN t = 'DATABASE' THEN d ELSE d || '.t_' || CAST(o_custkey AS STRING) END AS src_object,
       'user ' || CAST(o_custkey % 97 AS STRING) AS principal,
       CASE o_orderkey % 12 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'select' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'UPDATE'
            WHEN 4 THEN 'DELETE' WHEN 5 THEN 'ALL PRIVILEGES' WHEN 6 THEN 'ALL' WHEN 7 THEN 'CREATE'
            WHEN 8 THEN 'USAGE' WHEN 9 THEN 'READ_METADATA' WHEN 10 THEN 'MODIFY' ELSE 'Custom_Priv' END AS privilege,
       false AS grant_option
FROM (SELECT o_orderkey, o_custkey, 'Sales_' || CAST(o_custkey % 30 AS STRING) AS d,
             CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'FUNCTION' WHEN o_orderstatus = 'P' THEN 'DATABASE'
                  WHEN o_orderstatus = 'O' THEN 'VIEW' WHEN o_orderpriority = '5-LOW' THEN 'EXTERNAL'
                  ELSE 'MANAGED' END AS t
      FROM {orders}) o
"""

# Schema mapping of the databases above; the ones beyond the nations have no target.
SALES_MAPPING = """
SELECT 'Sales_' || CAST(n_nationkey AS STRING) AS src_database, 'prod' AS tgt_catalog,
       'sales_' || CAST(n_nationkey AS STRING) AS tgt_schema, true AS name_changed, 'CREATED' AS status
FROM {nation}
"""

# Grants found in the target: some lost, some never asked for, none on a few schemas.
ACTUAL_GRANTS = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'SCHEMA' ELSE 'TABLE' END AS object_type,
       CASE WHEN o_orderstatus = 'P' THEN 'prod.sales_' || CAST(o_custkey % 21 AS STRING)
            ELSE 'prod.sales_' || CAST(o_custkey % 30 AS STRING) || '.t_' || CAST(o_custkey AS STRING) END AS object_name,
       'user ' || CAST(o_custkey % 97 AS STRING) AS principal,
       CASE o_orderkey % 4 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'MODIFY' WHEN 2 THEN 'USE SCHEMA'
            ELSE 'CREATE TABLE' END AS privilege
FROM {orders}
"""

# Statistics texts: both numbers, bytes only, none.
STATS = """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey * 100 AS STRING) || ' bytes, ' || CAST(o_orderkey AS STRING) || ' rows'
            WHEN 'O' THEN CAST(o_custkey AS STRING) || ' bytes' ELSE '' END AS stats,
       o_orderpriority = '1-URGENT' AS failed
FROM {orders}
"""

# Column profiles, one table per order: target drifts by status and priority.
SRC_COLUMNS = """
SELECT 'o_' || CAST(o_orderkey AS STRING) AS table_name, column_name, ordinal, data_type FROM (
  SELECT o_orderkey, 'id' AS column_name, 0 AS ordinal, 'bigint' AS data_type FROM {orders}
  UNION ALL SELECT o_orderkey, 'amount', 1, 'decimal(18, 2)' FROM {orders}
  UNION ALL SELECT o_orderkey, 'day', 2, 'date' FROM {orders}
  UNION ALL SELECT o_orderkey, 'note', 3, 'string' FROM {orders}
) c
"""
TGT_COLUMNS = """
SELECT 'o_' || CAST(o_orderkey AS STRING) AS table_name, column_name, ordinal, data_type FROM (
  SELECT o_orderkey, 'id' AS column_name, CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS ordinal,
         'LONG' AS data_type FROM {orders} WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT o_orderkey, 'amount', CASE WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 1 END,
         CASE WHEN o_orderstatus = 'P' THEN 'string' ELSE 'DECIMAL(18,2)' END
         FROM {orders} WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'extra' ELSE 'note' END, 3, 'string'
         FROM {orders} WHERE o_orderpriority <> '1-URGENT'
  UNION ALL SELECT o_orderkey, 'day', 2, 'date' FROM {orders} WHERE o_orderpriority <> '1-URGENT'
) c
"""

# A migration log, one table per order.
LOG = """
SELECT 'db.t_' || CAST(o_orderkey AS STRING) AS src_table,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'DRY_RUN' ELSE 'ERROR' END AS status,
       CAST(o_custkey % 60 AS DOUBLE) AS duration_sec, o_custkey AS rows_copied
FROM {orders}
"""
