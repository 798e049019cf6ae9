"""Input tables of the queries as SQL, for the engine the results are checked against.

Each text may use the ones before it. ``queries.fixtures`` derives the same rows with Spark.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["fx_catalogs"] = """
SELECT lower(replace(r_name, ' ', '_')) AS catalog_name,
       concat('owner_', CAST(r_regionkey AS STRING)) AS catalog_owner,
       CASE r_regionkey WHEN 3 THEN 'FOREIGN' WHEN 4 THEN 'DELTA SHARING' ELSE 'REGULAR' END AS catalog_type,
       CASE WHEN r_regionkey % 2 = 0 THEN concat('it''s region ', CAST(r_regionkey AS STRING)) END AS comment,
       CAST('2000-01-01 00:00:00' AS TIMESTAMP) AS last_altered
FROM region
UNION ALL
SELECT 'system', 'admin', 'REGULAR', NULL, CAST('2000-01-01 00:00:00' AS TIMESTAMP)
"""

SQL["fx_schemata"] = """
SELECT lower(replace(r_name, ' ', '_')) AS catalog_name, lower(n_name) AS schema_name,
       concat('owner_', CAST(n_nationkey % 7 AS STRING)) AS schema_owner,
       CASE WHEN n_nationkey % 3 = 0 THEN concat('nation ', CAST(n_nationkey AS STRING)) END AS comment,
       CAST('2000-01-01 00:00:00' AS TIMESTAMP) AS last_altered
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT catalog_name, 'information_schema', 'admin', NULL, last_altered FROM fx_catalogs
"""

SQL["fx_tables"] = """
SELECT lower(replace(r_name, ' ', '_')) AS table_catalog, lower(n_name) AS table_schema,
       concat('t_', CAST(c_custkey AS STRING)) AS table_name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'VIEW' WHEN 'MACHINERY' THEN 'EXTERNAL'
                         WHEN 'FURNITURE' THEN 'FOREIGN' ELSE 'MANAGED' END AS table_type,
       CASE WHEN c_custkey % 13 <> 0 THEN concat('owner_', CAST(c_custkey % 7 AS STRING)) END AS table_owner,
       CASE WHEN c_custkey % 5 = 0 THEN concat('customer ', CAST(c_custkey AS STRING)) END AS comment,
       max(o_orderdate) AS last_altered, c_custkey AS table_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY r_name, n_name, c_custkey, c_mktsegment
"""

SQL["fx_mat_views"] = """
SELECT table_catalog, table_schema, table_name FROM fx_tables WHERE table_type = 'VIEW' AND table_id % 4 = 0
"""

SQL["fx_table_privileges"] = """
SELECT DISTINCT table_catalog, table_schema, table_name,
       concat('grp_', CAST(o_orderkey % 3 AS STRING)) AS grantee,
       upper(substr(o_orderpriority, 3)) AS privilege_type,
       CASE o_orderstatus WHEN 'P' THEN 'CATALOG' ELSE 'NONE' END AS inherited_from
FROM orders JOIN fx_tables ON o_custkey = table_id
"""

SQL["fx_table_tags"] = """
SELECT table_catalog AS catalog_name, table_schema AS schema_name, table_name,
       l_returnflag AS tag_name,
       CASE WHEN count(*) % 5 = 0 THEN NULL ELSE concat('v', CAST(count(*) AS STRING)) END AS tag_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN fx_tables ON o_custkey = table_id
GROUP BY table_catalog, table_schema, table_name, l_returnflag
"""

SQL["fx_columns"] = """
SELECT o_custkey AS table_id,
       concat('c_', CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 23 = 0 THEN concat(chr(39), 's') ELSE '' END) AS name,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS position,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'int' WHEN '2-HIGH' THEN 'string'
            WHEN '3-MEDIUM' THEN 'decimal(10,2)' WHEN '5-LOW' THEN 'array<string>' ELSE 'timestamp' END AS type_text,
       CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderkey % 2 AS INT) END AS partition_index,
       CASE WHEN o_orderkey % 7 = 0 THEN 'a + 1' END AS generation_expr,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(1 AS BIGINT) END AS identity_start,
       (o_orderkey % 10 = 0) AS explicit_insert,
       CASE WHEN o_orderkey % 3 = 0 THEN '0' END AS default_expr,
       (o_orderkey % 2 = 0) AS mask_uses_columns,
       CASE WHEN o_orderkey % 17 = 0 THEN 'c.s.mask_fn' END AS mask_function,
       (o_orderstatus <> 'O') AS nullable,
       CASE WHEN o_orderkey % 4 = 0 THEN concat('note', CASE WHEN o_orderkey % 8 = 0 THEN concat(' on LOCATION ', chr(39), 'x', chr(39), ' --') ELSE '' END) END AS comment
FROM orders
"""

SQL["fx_external_locations"] = """
SELECT concat('loc_', CAST(page_id AS STRING)) AS external_location_name,
       CASE WHEN page_id % 9 = 0 THEN concat('s3://bucket', CAST(page_id AS STRING), '/p')
            ELSE concat('abfss://c', CAST(page_id % 3 AS STRING), '@', regexp_extract(url, '://([^/]+)', 1), '/p/', CAST(page_id AS STRING)) END AS url,
       concat('cred_', CAST(page_id % 3 AS STRING)) AS storage_credential_name,
       (page_id % 4 = 0) AS read_only,
       CASE WHEN page_id % 2 = 0 THEN 'location' END AS comment,
       concat('owner_', CAST(page_id % 7 AS STRING)) AS external_location_owner
FROM pages
"""

SQL["fx_share_grants"] = """
SELECT DISTINCT p_brand AS share_name,
       CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE s_name END AS recipient_name,
       CASE WHEN l_linestatus = 'F' THEN 'SELECT' ELSE 'READ' END AS privilege_type
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""

SQL["fx_ip_ranges"] = """
SELECT s_name AS recipient_name,
       CASE WHEN s_suppkey % 5 <> 0 THEN concat('10.', CAST(s_nationkey AS STRING), '.', CAST(s_suppkey % 256 AS STRING), '.0/24') END AS allowed_ip_range
FROM supplier
UNION ALL
SELECT s_name, concat('192.168.', CAST(s_suppkey % 256 AS STRING), '.0/24') FROM supplier WHERE s_suppkey % 2 = 0
"""

SQL["fx_kinds"] = """
SELECT CASE p_size % 6 WHEN 0 THEN 'VOLUME' WHEN 1 THEN 'FUNCTION' WHEN 2 THEN 'CONNECTION'
            WHEN 3 THEN 'RECIPIENT' WHEN 4 THEN 'SHARE' ELSE 'DELTA SHARING SHARE OBJECT' END AS kind,
       concat('o_', CAST(p_partkey AS STRING)) AS name, p_brand AS share_name,
       CASE WHEN p_partkey % 2 = 0 THEN 'EXTERNAL' ELSE 'MANAGED' END AS type,
       CASE WHEN p_partkey % 2 = 0 THEN concat('abfss://c@h/v/', CAST(p_partkey AS STRING)) END AS storage_location,
       CASE WHEN p_partkey % 3 = 0 THEN p_name END AS comment,
       concat('{', chr(39), 'host', chr(39), ': ', chr(39), 'h', CAST(p_partkey AS STRING), chr(39),
  CASE p_partkey % 5
    WHEN 0 THEN concat(', ', chr(39), 'port', chr(39), ': ', chr(39), '1', chr(39), '}')
    WHEN 1 THEN concat(', ', chr(39), 'port', chr(39), ': 1, ', chr(39), 'ssl', chr(39), ': True, ', chr(39), 'user', chr(39), ': None,}')
    WHEN 2 THEN concat(', ', chr(34), 'note', chr(34), ': ', chr(39), 'it', chr(92), chr(39), 's, {x}', chr(39), '}')
    WHEN 3 THEN concat(', ', chr(39), 'list', chr(39), ': [1, {', chr(39), 'a', chr(39), ': (2,)}]}')
    ELSE concat(', ', chr(39), 'port', chr(39), ': }') END) AS options,
       CASE WHEN p_partkey % 4 = 0 THEN concat('id-', CAST(p_partkey AS STRING)) END AS sharing_id,
       CASE p_partkey % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'SCHEMA' ELSE 'MATERIALIZED VIEW' END AS shared_type,
       (p_partkey % 5 = 0) AS history
FROM part
"""

SQL["fx_connection_grants"] = """
SELECT name AS connection_name, concat('grp_', CAST(length(name) % 3 AS STRING)) AS grantee, pr AS privilege_type
FROM fx_kinds CROSS JOIN (VALUES ('USE CONNECTION'), ('CREATE FOREIGN CATALOG')) AS t(pr)
WHERE kind = 'CONNECTION' AND length(coalesce(comment, '')) = 0
"""

SQL["fx_description_rows"] = """
SELECT concat('c.s.f_', CAST(p_partkey AS STRING)) AS function_name, ord,
       CASE ord WHEN 0 THEN concat('Function: c.s.f_', CAST(p_partkey AS STRING))
            WHEN 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Type: TABLE' ELSE 'Type: SCALAR' END
            WHEN 2 THEN 'Input: a INT' WHEN 3 THEN '       b STRING'
            WHEN 4 THEN 'Returns: x INT' WHEN 5 THEN '         y STRING'
            WHEN 6 THEN 'Deterministic: true' WHEN 7 THEN 'Language: SQL'
            ELSE concat('Body: a + ', CAST(p_size AS STRING)) END AS function_desc
FROM part CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8)) AS o(ord)
"""

SQL["fx_models"] = """
SELECT concat('c.s.m_', CAST(l_partkey AS STRING)) AS full_name,
       CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate, l_tax, l_discount) AS STRING) AS version,
       concat('run_', CAST(l_orderkey AS STRING)) AS run_id,
       CASE WHEN l_orderkey % 2 = 0 THEN concat('about ', CAST(l_orderkey AS STRING)) END AS description,
       concat('s3://models/', CAST(l_orderkey AS STRING)) AS source,
       CASE l_orderkey % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' END AS current_stage,
       CASE l_orderkey % 5 WHEN 0 THEN 'champion' WHEN 1 THEN 'a,b' END AS alias_list,
       CASE WHEN l_orderkey % 7 = 0 THEN concat('t', CAST(l_orderkey % 10 AS STRING)) END AS tag
FROM lineitem
"""

SQL["fx_table_properties"] = """
SELECT table_id, k AS key, CASE k WHEN 'delta.liquid.clusteringColumns' THEN CASE WHEN table_id % 5 = 0 THEN '["a","b"]' END
       ELSE concat('v (', CAST(table_id % 4 AS STRING), ')') END AS value
FROM fx_tables CROSS JOIN (VALUES ('delta.appendOnly'), ('delta.lastUpdateVersion'), ('team'), ('delta.feature.liquid'),
  ('delta.liquid.clusteringColumns')) AS t(k)
WHERE table_id % 3 <> 0
"""

SQL["fx_table_constraints"] = """
SELECT table_id, concat('pk_', table_name) AS name, 'PRIMARY KEY' AS kind, 'a,b' AS child_columns, CAST(NULL AS STRING) AS parent_table, CAST(NULL AS STRING) AS parent_columns
FROM fx_tables WHERE table_id % 2 = 0
UNION ALL
SELECT table_id, concat('fk_', table_name), 'FOREIGN KEY', 'a', 'c.s.parent', 'id' FROM fx_tables WHERE table_id % 6 = 0
"""

SQL["fx_row_filters"] = """
SELECT table_id, 'c.s.filter_fn' AS name, CASE WHEN table_id % 14 = 0 THEN 'a,b' END AS input_columns FROM fx_tables WHERE table_id % 7 = 0
"""

SQL["fx_view_text"] = """
SELECT concat(table_catalog, '.', table_schema, '.', table_name) AS view_name,
       concat(CASE table_id % 4 WHEN 1 THEN concat('-- CREATE VIEW by hand', chr(10)) WHEN 2 THEN '/* made ' || chr(10) || 'here */ ' ELSE '' END,
              CASE table_id % 3 WHEN 0 THEN 'CREATE VIEW ' WHEN 1 THEN 'create or replace view ' ELSE 'CREATE VIEW IF NOT EXISTS ' END,
              CASE table_id % 2 WHEN 0 THEN concat(table_schema, '.', table_name)
              ELSE concat('`', table_schema, '`.`', table_name, '`') END,
              CASE table_id % 5 WHEN 0 THEN ' AS SELECT x FROM t WHERE f(x) > 1'
              WHEN 1 THEN chr(10) || 'AS SELECT 1 AS one' ELSE ' (a, b) AS SELECT (1) a, 2 b' END) AS create_text
FROM fx_tables WHERE table_type = 'VIEW'
"""

SQL["fx_catalog_options"] = """
SELECT catalog_name, CASE WHEN catalog_type = 'FOREIGN' THEN 'database = db1, user=u1' WHEN catalog_name = 'asia' THEN 'not an option list' END AS options FROM fx_catalogs
"""

SQL["fx_catalog_bindings"] = """
SELECT lower(replace(r_name, ' ', '_')) AS catalog_name, CAST(n_nationkey AS BIGINT) AS workspace_id
FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey % 2 = 0
"""

SQL["fx_inventory"] = """
SELECT catalog_name AS object_name, 'CATALOG' AS object_type, 'ms' AS object_parent_name, 'METASTORE' AS object_parent_type,
       catalog_name AS object_cross_relationship, CAST(-1000 - length(catalog_name) * 10 - ascii(catalog_name) % 10 AS BIGINT) AS object_uid,
       CASE catalog_type WHEN 'DELTA SHARING' THEN concat('CREATE CATALOG `', catalog_name, '` USING SHARE `p`.`s`') ELSE concat('CREATE CATALOG `', catalog_name, '`') END AS restore_ddl,
       CAST(NULL AS STRING) AS api_payload, last_altered AS created_tsp
FROM fx_catalogs WHERE catalog_name <> 'system'
UNION ALL
SELECT concat(lower(replace(r_name, ' ', '_')), '.', lower(n_name)), 'SCHEMA', lower(replace(r_name, ' ', '_')), 'CATALOG',
       lower(n_name), CAST(-100 - n_nationkey AS BIGINT), concat('CREATE SCHEMA `', lower(n_name), '`'), NULL, CAST('2000-01-01 00:00:00' AS TIMESTAMP)
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT concat(table_catalog, '.', table_schema, '.', table_name), CASE WHEN table_type = 'VIEW' THEN 'VIEW' ELSE 'TABLE' END,
       concat(table_catalog, '.', table_schema), 'SCHEMA', table_name, table_id,
       CASE WHEN table_id % 19 <> 0 THEN concat('CREATE TABLE `', table_name, '`', CASE WHEN table_type = 'EXTERNAL' THEN concat(' LOCATION ''abfss://c@h/', table_name, '''') ELSE '' END) END,
       NULL, last_altered
FROM fx_tables
UNION ALL
SELECT concat(table_catalog, '.', table_schema, '.', table_name), 'OWNER',
       concat(table_catalog, '.', table_schema, '.', table_name), CASE WHEN table_type = 'VIEW' THEN 'VIEW' ELSE 'TABLE' END,
       table_owner, 1000000 + table_id, 'ALTER TABLE `' || table_name || '` SET OWNER TO `' || table_owner || '`', NULL, last_altered
FROM fx_tables
UNION ALL
SELECT concat(table_catalog, '.', table_schema, '.', table_name), 'TAG',
       concat(table_catalog, '.', table_schema, '.', table_name), 'TABLE',
       'k', 2000000 + table_id, concat('ALTER TABLE `', table_name, '` SET TAGS (''k'' = ''v'')'), NULL, last_altered
FROM fx_tables WHERE table_id % 3 = 0
UNION ALL
SELECT concat(table_catalog, '.', table_schema, '.', table_name), 'PRIVILEGE',
       concat(table_catalog, '.', table_schema, '.', table_name), 'TABLE',
       'grp_0', 3000000 + table_id, concat('GRANT SELECT ON TABLE `', table_name, '` TO `grp_0`'), NULL, last_altered
FROM fx_tables WHERE table_id % 2 = 0
UNION ALL
SELECT DISTINCT p_brand, 'SHARE', 'ms', 'METASTORE', p_brand,
       CAST(-2000 - CAST(substr(p_brand, 7) AS BIGINT) AS BIGINT), concat('CREATE SHARE `', p_brand, '`'), CAST(NULL AS STRING), CAST('2000-01-01 00:00:00' AS TIMESTAMP)
FROM part
UNION ALL
SELECT DISTINCT p_brand, 'DELTA SHARING SHARE OBJECT', p_brand, 'SHARE', 'c.s.t',
       CAST(-3000 - CAST(substr(p_brand, 7) AS BIGINT) AS BIGINT), concat('ALTER SHARE `', p_brand, '` ADD TABLE c.s.t'), CAST(NULL AS STRING), CAST('2000-01-01 00:00:00' AS TIMESTAMP)
FROM part
UNION ALL
SELECT external_location_name, 'EXTERNAL LOCATION', storage_credential_name, 'STORAGE CREDENTIAL', external_location_name,
       CAST(-100000 - CAST(substr(external_location_name, 5) AS BIGINT) AS BIGINT), concat('CREATE EXTERNAL LOCATION `', external_location_name, '`'),
       CASE WHEN read_only THEN '{"read_only":true}' END, CAST('2000-01-01 00:00:00' AS TIMESTAMP)
FROM fx_external_locations
UNION ALL
SELECT DISTINCT storage_credential_name, 'STORAGE CREDENTIAL', 'ms', 'METASTORE', storage_credential_name,
       CAST(-500 - CAST(substr(storage_credential_name, 6) AS BIGINT) AS BIGINT), CAST(NULL AS STRING), '{"name":"x"}', CAST('2000-01-01 00:00:00' AS TIMESTAMP)
FROM fx_external_locations
"""

SQL["fx_history"] = """
SELECT CAST(y - 1995 AS INT) AS version, make_timestamp(y, 12, 31, 0, 0, 0.0) AS timestamp
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) AS years
"""

SQL["fx_snapshots"] = """
SELECT h.version, concat('Obj.', CAST(o_orderkey AS STRING)) AS object_name,
       CASE o_orderstatus WHEN 'F' THEN 'TABLE' WHEN 'O' THEN 'VIEW' ELSE 'VOLUME' END AS object_type,
       concat('s_', CAST(o_custkey % 25 AS STRING)) AS object_parent_name, 'SCHEMA' AS object_parent_type,
       concat('Obj.', CAST(o_orderkey AS STRING)) AS object_cross_relationship, o_orderkey AS object_uid,
       concat('ddl ', o_orderpriority, CASE WHEN o_orderkey % 10 = h.version THEN ' changed' ELSE '' END) AS restore_ddl,
       CAST(NULL AS STRING) AS api_payload, o_orderdate AS created_tsp
FROM orders JOIN fx_history h ON o_orderdate <= h.timestamp
WHERE o_orderkey % 11 <> h.version
"""

SQL["fx_checkpoint"] = """
SELECT CAST(event_id % 3 + 1 AS BIGINT) AS jobid, user_id AS rowid,
       CASE event_type WHEN 'error' THEN 'Failed' ELSE 'Succeeded' END AS status,
       CASE event_type WHEN 'error' THEN concat('failed, "', props, '"') END AS error_message,
       ts AS record_timestamp
FROM events
"""

SQL["fx_failures"] = """
SELECT object_uid, concat('Failed to create ', object_type, ': ', object_name) AS error_message
FROM fx_inventory WHERE object_uid % 10 = 7
"""

SQL["fx_jobs"] = """
SELECT event_id AS jobid, concat('job_', CAST(user_id AS STRING)) AS jobtype,
       CASE event_type WHEN 'error' THEN 'Failed' WHEN 'purchase' THEN 'Succeeded' WHEN 'click' THEN 'Completed' ELSE 'Running' END AS jobstatus,
       ts AS jobstart,
       CASE WHEN event_type IN ('error', 'purchase', 'click') THEN ts + INTERVAL 1 HOUR END AS jobend,
       CAST(event_id % 7 AS INT) AS backupversion
FROM events
"""

SQL["fx_job_types"] = """
SELECT DISTINCT concat('job_', CAST(user_id AS STRING)) AS jobtype FROM events
UNION ALL
SELECT concat('job_of_', lower(n_name)) FROM nation
"""

SQL["fx_audit"] = """
SELECT ts AS event_time,
       CASE event_type WHEN 'signup' THEN 'createCatalog' WHEN 'error' THEN 'deleteCatalog' WHEN 'view' THEN 'getCatalog'
            WHEN 'click' THEN 'updateCatalog' ELSE 'listCatalog' END AS action_name,
       CASE event_type WHEN 'signup' THEN concat('cat_', CAST(user_id AS STRING)) END AS param_name,
       CASE WHEN event_type <> 'signup' THEN concat('cat_', CAST(user_id AS STRING)) END AS param_name_arg
FROM events
"""

SQL["fx_visible_catalogs"] = """
SELECT DISTINCT concat('cat_', CAST(user_id AS STRING)) AS catalog_name FROM events WHERE user_id % 3 = 0
"""

SQL["fx_views"] = """
SELECT table_catalog, table_schema, table_name, (table_id % 4 = 0) AS is_materialized FROM fx_tables WHERE table_type = 'VIEW'
"""

SQL["fx_catalog_privileges"] = """
SELECT DISTINCT table_catalog AS catalog_name, grantee, privilege_type, inherited_from FROM fx_table_privileges
"""

SQL["fx_schema_privileges"] = """
SELECT DISTINCT table_catalog AS catalog_name, table_schema AS schema_name, grantee, privilege_type, inherited_from FROM fx_table_privileges
"""

SQL["fx_catalog_tags"] = """
SELECT DISTINCT catalog_name, tag_name, tag_value FROM fx_table_tags
"""

SQL["fx_schema_tags"] = """
SELECT DISTINCT catalog_name, schema_name, tag_name, tag_value FROM fx_table_tags
"""

SQL["fx_volumes"] = """
SELECT 'c' AS volume_catalog, lower(replace(share_name, '#', '_')) AS volume_schema, name AS volume_name, type AS volume_type,
       storage_location, comment, concat('owner_', CAST(length(name) AS STRING)) AS volume_owner
FROM fx_kinds WHERE kind = 'VOLUME'
"""

SQL["fx_volume_privileges"] = """
SELECT 'c' AS volume_catalog, lower(replace(share_name, '#', '_')) AS volume_schema, name AS volume_name,
       concat('grp_', CAST(length(name) % 3 AS STRING)) AS grantee, pr AS privilege_type,
       CASE WHEN history THEN 'SCHEMA' ELSE 'NONE' END AS inherited_from
FROM fx_kinds CROSS JOIN (VALUES ('WRITE VOLUME'), ('READ VOLUME')) AS t(pr) WHERE kind = 'VOLUME'
"""

SQL["fx_volume_tags"] = """
SELECT 'c' AS catalog_name, lower(replace(share_name, '#', '_')) AS schema_name, name AS volume_name,
       tag AS tag_name, CASE tag WHEN 'kind' THEN type ELSE comment END AS tag_value
FROM fx_kinds CROSS JOIN (VALUES ('note'), ('kind')) AS t(tag) WHERE kind = 'VOLUME'
"""

SQL["fx_routines"] = """
SELECT 'c' AS specific_catalog, 's' AS specific_schema, concat('f_', CAST(p_partkey AS STRING)) AS specific_name,
       concat('owner_', CAST(p_size AS STRING)) AS routine_owner
FROM part
"""

SQL["fx_routine_privileges"] = """
SELECT 'c' AS specific_catalog, CASE WHEN p_partkey % 10 = 0 THEN 'information_schema' ELSE 's' END AS specific_schema,
       concat('f_', CAST(p_partkey AS STRING)) AS specific_name, concat('grp_', CAST(p_size % 3 AS STRING)) AS grantee,
       'EXECUTE' AS privilege_type, CASE WHEN p_partkey % 4 = 0 THEN 'SCHEMA' ELSE 'NONE' END AS inherited_from
FROM part
"""

SQL["fx_location_privileges"] = """
SELECT external_location_name, concat('grp_', CAST(length(url) % 3 AS STRING)) AS grantee, pr AS privilege_type,
       CASE WHEN read_only AND pr = 'WRITE FILES' THEN 'METASTORE' ELSE 'NONE' END AS inherited_from
FROM fx_external_locations CROSS JOIN (VALUES ('WRITE FILES'), ('READ FILES')) AS t(pr)
"""

SQL["fx_recipients"] = """
SELECT s_name AS recipient_name, concat('owner_', CAST(s_nationkey AS STRING)) AS recipient_owner,
       CASE WHEN s_suppkey % 3 = 0 THEN concat('gid:', CAST(s_suppkey AS STRING)) END AS data_recipient_global_metastore_id,
       CASE WHEN s_suppkey % 4 = 0 THEN 'supplier''s own' END AS comment
FROM supplier
"""

SQL["fx_shares"] = """
SELECT p_brand AS share_name, concat('owner_', CAST(count(*) AS STRING)) AS share_owner,
       concat('parts: ', CAST(count(*) AS STRING)) AS comment
FROM part GROUP BY p_brand
"""

SQL["fx_share_contents"] = """
SELECT p_brand AS share_name, CASE p_partkey % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'SCHEMA' ELSE 'MATERIALIZED VIEW' END AS type,
       concat('c.s.o_', CAST(p_partkey AS STRING)) AS shared_object, concat('a_', CAST(p_partkey AS STRING)) AS name,
       CASE WHEN p_partkey % 3 = 0 THEN p_name END AS comment,
       CASE WHEN p_partkey % 8 = 0 THEN '(x = 1)' END AS partitions,
       CASE WHEN p_partkey % 5 = 0 THEN 'ENABLED' ELSE 'Disabled' END AS history_sharing
FROM part
"""

SQL["fx_connections"] = """
SELECT name AS connection_name, 'MYSQL' AS connection_type, options AS connection_options, comment,
       concat('owner_', CAST(length(name) AS STRING)) AS connection_owner
FROM fx_kinds WHERE kind = 'CONNECTION'
"""

SQL["fx_model_list"] = """
SELECT concat('c.s.m_', CAST(p_partkey AS STRING)) AS full_name, 'c' AS catalog_name, 's' AS schema_name,
       concat('m_', CAST(p_partkey AS STRING)) AS name, concat('owner_', CAST(p_size AS STRING)) AS owner
FROM part
"""

SQL["fx_model_grants"] = """
SELECT concat('c.s.m_', CAST(p_partkey AS STRING)) AS registered_model_name, concat('grp_', CAST(p_size % 3 AS STRING)) AS grantee, pr AS privilege_type
FROM part CROSS JOIN (VALUES ('MANAGE'), ('EXECUTE')) AS t(pr) WHERE p_partkey % 2 = 0
"""

SQL["fx_storage_credentials"] = """
SELECT storage_credential_name, concat('owner_', CAST(count(*) AS STRING)) AS storage_credential_owner,
       concat('{"name":"', storage_credential_name, '"}') AS payload
FROM fx_external_locations GROUP BY storage_credential_name
"""

SQL["fx_credential_privileges"] = """
SELECT storage_credential_name, external_location_owner AS grantee,
       CASE WHEN read_only THEN 'READ FILES' ELSE 'WRITE FILES' END AS privilege_type, 'NONE' AS inherited_from
FROM fx_external_locations GROUP BY storage_credential_name, external_location_owner, read_only
"""

SQL["fx_catalog_descriptions"] = """
SELECT c.catalog_name, info_name,
       CASE info_name WHEN 'Catalog Type' THEN catalog_type WHEN 'Comment' THEN comment WHEN 'Options' THEN options
            WHEN 'Connection Name' THEN CASE WHEN catalog_type = 'FOREIGN' THEN concat('conn_', c.catalog_name) END
            ELSE concat('abfss://Root@Host/', upper(c.catalog_name)) END AS info_value
FROM fx_catalogs c JOIN fx_catalog_options o ON c.catalog_name = o.catalog_name
CROSS JOIN (VALUES ('Catalog Type'), ('Comment'), ('Options'), ('Connection Name'), ('Storage Root')) AS t(info_name)
"""

SQL["fx_catalog_shares"] = """
SELECT catalog_name, 'prov' AS provider_name, concat('share_', catalog_name) AS share_name FROM fx_catalogs WHERE catalog_type = 'DELTA SHARING'
"""

# The earlier snapshot an incremental run builds on.
SQL["fx_past"] = """
SELECT * FROM fx_inventory WHERE created_tsp <= CAST('2000-06-30 00:00:00' AS TIMESTAMP)
"""
