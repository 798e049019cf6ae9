"""SQL texts the query results are checked against."""

from __future__ import annotations

import re

from queries.fixture_sql import SQL


def with_inputs(query: str, **steps: str) -> str:
    """Prefix a query with the input tables it needs, directly or through others."""
    needed: set[str] = set()
    waiting = [query, *steps.values()]
    while waiting:
        for name in re.findall(r"\bfx_\w+", waiting.pop()):
            if name in SQL and name not in needed:
                needed.add(name)
                waiting.append(SQL[name])
    texts = [(name, sql) for name, sql in SQL.items() if name in needed] + list(steps.items())
    # An input may use any other one, so they are put in an order in which that works.
    ordered: list[tuple[str, str]] = []
    while texts:
        for name, sql in texts:
            others = {other for other, _ in texts if other != name}
            if not others & set(re.findall(r"\b\w+", sql)):
                ordered.append((name, sql))
                break
        texts.remove(ordered[-1])
    common = ",\n".join(f"{name} AS (\n{sql.strip()}\n)" for name, sql in ordered)
    return f"WITH {common}\n{query.strip()}" if common else query


ORACLE: dict[str, str] = {}
RUN_AT = "TIMESTAMP '2024-01-01 00:00:00'"
NL, TAB = "chr(10)", "chr(9)"
NO_TEXT = "CAST(NULL AS VARCHAR)"


def quoted(name: str) -> str:
    return f"('`' || replace({name}, '.', '`.`') || '`')"


def literal(value: str) -> str:
    return f"('''' || replace({value}, '''', '''''') || '''')"


def clause(condition: str, text: str) -> str:
    return f"CASE WHEN {condition} THEN {NL} || {text} ELSE '' END"




def connection_ddl(name: str) -> str:
    """One statement for each of the five kinds of option text; null for the one that cannot be read."""
    n = f"CAST(substr({name}, 3) AS BIGINT) % 5"
    line = f" || ',' || {NL} || {TAB} || "
    more = (
        f"CASE {n} WHEN 0 THEN 'port ''1''' WHEN 1 THEN 'port ''1'''{line}'ssl ''True'''{line}'user ''None'''"
        " WHEN 2 THEN 'note ''it''''s, {x}''' WHEN 3 THEN 'list ''[1, {''''a'''': (2,)}]''' END"
    )
    return (
        f"'CREATE OR REPLACE CONNECTION `' || {name} || '`' || {NL} || 'TYPE MYSQL' || {NL} || 'OPTIONS (' || {NL}"
        f" || {TAB} || 'host ''h' || substr({name}, 3) || '''' {line} {more} || {NL} || ')' || {COMMENT}"
    )


COMMENT = clause("comment IS NOT NULL", f"'COMMENT ' || {literal('comment')}")

IDENTITY = (
    "object_name, object_type, object_parent_name, object_parent_type, "
    "object_cross_relationship, restore_ddl, api_payload"
)


def objects(
    source: str,
    name: str,
    object_type: str,
    parent: str,
    parent_type: str,
    owner: str,
    ddl: str = NO_TEXT,
    payload: str = NO_TEXT,
    relationship: str | None = None,
) -> str:
    return f"""SELECT {name} AS object_name, '{object_type}' AS object_type, {parent} AS object_parent_name,
       '{parent_type}' AS object_parent_type, {relationship or name} AS object_cross_relationship,
       {ddl} AS restore_ddl, {payload} AS api_payload, {owner} AS object_owner
FROM {source}"""


def own_and_owner(key: str, by_payload: bool = False) -> str:
    """Rows of the step own_<key> and the owner row of each."""
    statement = (
        NO_TEXT
        if by_payload
        else f"'ALTER ' || object_type || ' ' || {quoted('object_name')} || ' SET OWNER TO `' || object_owner || '`'"
    )
    payload = (
        "'{\"full_name\":\"' || object_name || '\",\"owner\":\"' || object_owner || '\"}'"
        if by_payload
        else NO_TEXT
    )
    return f"""SELECT {IDENTITY} FROM own_{key}
UNION ALL
SELECT object_name, 'OWNER', object_name, object_type, object_owner, {statement}, {payload} FROM own_{key}"""


def grants(
    source: str, name: str, parent_type: str, keyword: str | None = None,
    where: str = "inherited_from = 'NONE'", existing: str | None = None,
) -> str:
    exists = f"WHERE n IN ({existing})" if existing else ""
    return f"""SELECT n AS object_name, 'PRIVILEGE' AS object_type, n AS object_parent_name,
       '{parent_type}' AS object_parent_type, grantee AS object_cross_relationship,
       'GRANT ' || string_agg(privilege_type, ', ' ORDER BY privilege_type) || ' ON {keyword or parent_type} '
       || {quoted('n')} || ' TO `' || grantee || '`' AS restore_ddl, {NO_TEXT} AS api_payload
FROM (SELECT {name} AS n, grantee, privilege_type FROM {source} WHERE {where}) AS g
{exists} GROUP BY n, grantee"""


def tags(source: str, name: str, parent_type: str, where: str = "true", existing: str | None = None) -> str:
    exists = f"AND n IN ({existing})" if existing else ""
    return f"""SELECT n AS object_name, 'TAG' AS object_type, n AS object_parent_name,
       '{parent_type}' AS object_parent_type, string_agg(pair, ', ' ORDER BY pair) AS object_cross_relationship,
       'ALTER {parent_type} ' || {quoted('n')} || ' SET TAGS (' || string_agg(pair, ', ' ORDER BY pair) || ')' AS restore_ddl,
       {NO_TEXT} AS api_payload
FROM (SELECT DISTINCT {name} AS n, {literal('tag_name')} || ' = ' || {literal('tag_value')} AS pair
      FROM {source} WHERE {where}) AS p
WHERE pair IS NOT NULL {exists} GROUP BY n"""


TABLE_FULL = "table_catalog || '.' || table_schema || '.' || table_name"
TAG_FULL = "catalog_name || '.' || schema_name || '.' || table_name"
STORED = f"SELECT {TABLE_FULL} FROM fx_tables WHERE table_type IN ('EXTERNAL', 'MANAGED')"
PLAIN_VIEWS = f"SELECT {TABLE_FULL} FROM fx_views WHERE NOT is_materialized"
VOLUME_FULL = "volume_catalog || '.' || volume_schema || '.' || volume_name"
ROUTINE_FULL = "specific_catalog || '.' || specific_schema || '.' || specific_name"
RESERVED_SCHEMA = "table_schema <> 'information_schema'"

CREATE_TABLE = (
    f"CASE table_type WHEN 'EXTERNAL' THEN 'CREATE EXTERNAL TABLE ' ELSE 'CREATE TABLE ' END || {quoted(TABLE_FULL)}"
)



def share_object(share: str, kind: str, full: str, partition: str, alias: str, history: str) -> str:
    return (
        f"'ALTER SHARE `' || {share} || '`' || {NL} || 'ADD ' || {kind} || ' ' || {quoted(full)} || {COMMENT} || "
        + clause(f"{kind} = 'TABLE' AND {partition} IS NOT NULL", f"'PARTITION ' || {partition}")
        + " || "
        + clause(f"{kind} <> 'SCHEMA'", f"'AS ' || {alias}")
        + " || "
        + clause(f"{kind} = 'TABLE' AND {history}", "'WITH HISTORY'")
    )


FUNCTION_DDL = f"""'CREATE OR REPLACE FUNCTION `c`.`s`.`f_' || p_partkey || '`(a INT, b STRING)' || {NL}
       || CASE WHEN p_partkey % 2 = 0 THEN 'RETURNS TABLE (x INT, y STRING)' ELSE 'RETURNS x INT' END || {NL}
       || 'LANGUAGE sql' || {NL} || 'RETURN a + ' || p_size"""

_VERSION_JSON = """'{"name":"' || full_name || '"'
    || CASE WHEN alias_list IS NOT NULL THEN ',"aliases":["' || replace(alias_list, ',', '","') || '"]' ELSE '' END
    || CASE WHEN description IS NOT NULL THEN ',"description":"' || description || '"' ELSE '' END
    || CASE WHEN tag IS NOT NULL THEN ',"tags":{"k":"' || tag || '"}' ELSE '' END
    || CASE WHEN current_stage IS NOT NULL THEN ',"current_stage":"' || current_stage || '"' ELSE '' END
    || ',"source":"' || source || '","run_id":"' || run_id || '","version":"' || version || '"}'"""
MODEL_PAYLOADS = (
    f"(SELECT full_name AS n, string_agg({_VERSION_JSON}, ',' ORDER BY CAST(version AS BIGINT)) AS versions"
    " FROM fx_models GROUP BY full_name)"
)

# Object rows by declaration: the step own_<key>.
OWN: dict[str, str] = {
    "catalogs": objects(
        "fx_catalogs AS c", "c.catalog_name", "CATALOG", "'ms'", "METASTORE", "catalog_owner",
        ddl="CASE catalog_type WHEN 'FOREIGN' THEN 'CREATE FOREIGN CATALOG `' ELSE 'CREATE CATALOG `' END"
        " || c.catalog_name || '`' || "
        + clause("catalog_type = 'DELTA SHARING'", "'USING SHARE `prov`.`share_' || c.catalog_name || '`'")
        + " || " + clause("catalog_type = 'FOREIGN'", "'USING CONNECTION conn_' || c.catalog_name")
        + f" || {NL} || 'MANAGED LOCATION ''abfss://root@host/' || c.catalog_name || '''' || {COMMENT} || "
        + clause(
            "catalog_type = 'FOREIGN'",
            f"'OPTIONS (' || {NL} || {TAB} || 'database ''db1'',' || {NL} || {TAB} || 'user ''u1''' || {NL} || ')'",
        ),
        payload="(SELECT '{\"assign_workspaces\":[' || string_agg(CAST(workspace_id AS VARCHAR), ',' ORDER BY workspace_id)"
        " || ']}' FROM fx_catalog_bindings AS b WHERE b.catalog_name = c.catalog_name)",
    ) + " WHERE c.catalog_name NOT IN ('system', 'main', 'hive_metastore', 'spark_catalog', 'samples')",
    "schemas": objects(
        "fx_schemata", "catalog_name || '.' || schema_name", "SCHEMA", "catalog_name", "CATALOG",
        "schema_owner",
        ddl="'CREATE SCHEMA `' || catalog_name || '`.`' || schema_name || '`' || " + COMMENT + " || "
        + clause("length(schema_name) % 2 = 0", "'MANAGED LOCATION ''abfss://m@h/' || schema_name || ''''")
        + " || "
        + clause(
            "comment IS NOT NULL",
            f"'WITH DBPROPERTIES (' || {NL} || {TAB} || '''team'' = ''' || schema_name || '''' || {NL} || ')'",
        ),
    ) + " WHERE catalog_name NOT IN ('system', 'main', 'hive_metastore', 'spark_catalog', 'samples')"
        " AND schema_name NOT IN ('information_schema', 'default')",
    "tables": objects(
        "fx_tables", TABLE_FULL, "TABLE", "table_catalog || '.' || table_schema", "SCHEMA",
        "table_owner", ddl=f"{CREATE_TABLE} || {COMMENT}",
    ) + f" WHERE table_type IN ('EXTERNAL', 'MANAGED') AND {RESERVED_SCHEMA}",
    "views": objects(
        "fx_tables AS t", TABLE_FULL, "VIEW", "table_catalog || '.' || table_schema", "SCHEMA",
        "table_owner", ddl=f"'CREATE VIEW ' || {quoted(TABLE_FULL)} || CASE table_id % 5 WHEN 0 THEN ' AS SELECT x FROM t WHERE f(x) > 1' WHEN 1 THEN ' AS SELECT 1 AS one' ELSE ' (a, b) AS SELECT (1) a, 2 b' END",
    ) + " WHERE table_type = 'VIEW' AND last_altered > TIMESTAMP '1900-01-01 00:00:00' AND NOT EXISTS (SELECT 1 FROM fx_mat_views AS m WHERE m.table_catalog = t.table_catalog"
        " AND m.table_schema = t.table_schema AND m.table_name = t.table_name)",
    "volumes": objects(
        "fx_volumes", VOLUME_FULL, "VOLUME", "volume_catalog || '.' || volume_schema", "SCHEMA",
        "volume_owner",
        ddl=f"CASE volume_type WHEN 'EXTERNAL' THEN 'CREATE EXTERNAL VOLUME ' ELSE 'CREATE VOLUME ' END || {quoted(VOLUME_FULL)} || "
        + clause("volume_type = 'EXTERNAL'", f"'LOCATION ' || {literal('storage_location')}") + " || " + COMMENT,
    ),
    "functions": objects(
        "fx_routines JOIN part ON specific_name = 'f_' || p_partkey", ROUTINE_FULL, "FUNCTION",
        "specific_catalog || '.' || specific_schema", "SCHEMA", "routine_owner", ddl=FUNCTION_DDL,
    ),
    "external_locations": objects(
        "fx_external_locations", "external_location_name", "EXTERNAL LOCATION", "storage_credential_name",
        "STORAGE CREDENTIAL", "external_location_owner",
        ddl=f"'CREATE EXTERNAL LOCATION `' || external_location_name || '`' || {NL} || 'URL ''' || url || '''' || {NL}"
        f" || 'WITH (STORAGE CREDENTIAL `' || storage_credential_name || '`)' || {COMMENT}",
        payload="CASE WHEN read_only THEN '{\"read_only\":true}' END",
    ),
    "storage_credentials": objects(
        "fx_storage_credentials", "storage_credential_name", "STORAGE CREDENTIAL", "'ms'", "METASTORE",
        "storage_credential_owner", payload="payload",
    ),
    "recipients": objects(
        "fx_recipients AS r", "r.recipient_name", "RECIPIENT", "'ms'", "METASTORE", "recipient_owner",
        ddl="'CREATE RECIPIENT `' || r.recipient_name || '`' || "
        + clause(
            "data_recipient_global_metastore_id IS NOT NULL",
            "'USING ID ''' || data_recipient_global_metastore_id || ''''",
        ) + " || " + COMMENT,
        payload="(SELECT '{\"ip_access_list\":{\"allowed_ip_addresses\":[' || coalesce(string_agg('\"' || allowed_ip_range || '\"', ','"
        " ORDER BY allowed_ip_range), '') || ']}}' FROM fx_ip_ranges AS i WHERE i.recipient_name = r.recipient_name)",
    ),
    "shares": objects(
        "fx_shares", "share_name", "SHARE", "'ms'", "METASTORE", "share_owner",
        ddl=f"'CREATE SHARE `' || share_name || '`' || {COMMENT}",
    ),
    "share_objects": objects(
        "fx_share_contents", "share_name", "DELTA SHARING SHARE OBJECT", "share_name", "SHARE", NO_TEXT,
        ddl=share_object("share_name", "type", "shared_object", "partitions", "name", "history_sharing = 'ENABLED'"),
        relationship=quoted("shared_object"),
    ),
    "connections": objects(
        "fx_connections", "connection_name", "CONNECTION", "'ms'", "METASTORE", "connection_owner",
        ddl=connection_ddl("connection_name"),
    ),
    "registered_models": objects(
        f"fx_model_list LEFT JOIN {MODEL_PAYLOADS} AS v ON v.n = full_name", "full_name", "REGISTERED MODEL",
        "catalog_name || '.' || schema_name", "SCHEMA", "owner",
        payload="'{\"registered_model\":{\"catalog_name\":\"c\",\"schema_name\":\"s\",\"name\":\"' || name"
        " || '\"},\"versions\":[' || coalesce(versions, '') || ']}'",
    ),
}

# Complete rows by declaration.
ROWS: dict[str, str] = {key: own_and_owner(key) for key in OWN}
ROWS["registered_models"] = own_and_owner("registered_models", by_payload=True)
ROWS["share_objects"] = f"SELECT {IDENTITY} FROM own_share_objects"
ROWS |= {
    "catalog_privileges": grants("fx_catalog_privileges", "catalog_name", "CATALOG"),
    "schema_privileges": grants("fx_schema_privileges", "catalog_name || '.' || schema_name", "SCHEMA"),
    "table_privileges": grants("fx_table_privileges", TABLE_FULL, "TABLE", existing=STORED),
    "view_privileges": grants("fx_table_privileges", TABLE_FULL, "VIEW", existing=PLAIN_VIEWS),
    "volume_privileges": grants("fx_volume_privileges", VOLUME_FULL, "VOLUME"),
    "function_privileges": grants(
        "fx_routine_privileges", ROUTINE_FULL, "FUNCTION",
        where="inherited_from = 'NONE' AND specific_schema <> 'information_schema'",
    ),
    "external_location_privileges": grants("fx_location_privileges", "external_location_name", "EXTERNAL LOCATION"),
    "connection_privileges": grants(
        "fx_connection_grants", "connection_name", "CONNECTION", where="privilege_type IS NOT NULL",
        existing="SELECT connection_name FROM fx_connections",
    ),
    "model_privileges": grants(
        "fx_model_grants", "registered_model_name", "REGISTERED MODEL", "FUNCTION", where="true"
    ),
    "storage_credential_privileges": grants(
        "fx_credential_privileges", "storage_credential_name", "STORAGE CREDENTIAL"
    ),
    "share_recipient_privileges": f"""SELECT share_name AS object_name, 'PRIVILEGE' AS object_type, share_name AS object_parent_name,
       'SHARE' AS object_parent_type, {NO_TEXT} AS object_cross_relationship,
       'GRANT ' || string_agg(privilege_type, ', ' ORDER BY privilege_type) || ' ON SHARE `' || share_name || '` TO RECIPIENT `'
       || recipient_name || '`' AS restore_ddl, {NO_TEXT} AS api_payload
FROM fx_share_grants WHERE share_name <> '' AND recipient_name <> '' GROUP BY share_name, recipient_name""",
    "catalog_tags": tags("fx_catalog_tags", "catalog_name", "CATALOG"),
    "schema_tags": tags("fx_schema_tags", "catalog_name || '.' || schema_name", "SCHEMA"),
    "table_tags": tags("fx_table_tags", TAG_FULL, "TABLE", existing=STORED),
    "view_tags": tags("fx_table_tags", TAG_FULL, "VIEW", existing=PLAIN_VIEWS),
    "volume_tags": tags("fx_volume_tags", "catalog_name || '.' || schema_name || '.' || volume_name", "VOLUME"),
}


def entity_sql(key: str) -> str:
    steps = {f"own_{key}": OWN[key]} if key in OWN else {}
    return with_inputs(
        f"SELECT {IDENTITY}, {RUN_AT} AS created_tsp FROM rows_of_kind", **steps, rows_of_kind=ROWS[key]
    )


for _query, _key in {
    "inventory_catalogs": "catalogs",
    "inventory_schemas": "schemas",
    "inventory_tables": "tables",
    "inventory_views_no_mat": "views",
    "inventory_volumes": "volumes",
    "inventory_functions": "functions",
    "inventory_external_locations": "external_locations",
    "inventory_storage_credentials": "storage_credentials",
    "inventory_recipients": "recipients",
    "inventory_shares": "shares",
    "inventory_share_objects": "share_objects",
    "inventory_connections": "connections",
    "inventory_models": "registered_models",
    "catalog_grant_rollup": "catalog_privileges",
    "schema_grant_rollup": "schema_privileges",
    "grant_rollup": "table_privileges",
    "view_grant_rollup": "view_privileges",
    "volume_grant_rollup": "volume_privileges",
    "function_grant_rollup": "function_privileges",
    "location_grant_rollup": "external_location_privileges",
    "connection_grant_rollup": "connection_privileges",
    "model_grant_rollup": "model_privileges",
    "credential_grant_rollup": "storage_credential_privileges",
    "share_grant_rollup": "share_recipient_privileges",
    "catalog_tag_rollup": "catalog_tags",
    "schema_tag_rollup": "schema_tags",
    "tag_rollup": "table_tags",
    "view_tag_rollup": "view_tags",
    "volume_tag_rollup": "volume_tags",
}.items():
    ORACLE[_query] = entity_sql(_key)

ORACLE["owner_rows"] = with_inputs(
    f"SELECT {IDENTITY}, {RUN_AT} AS created_tsp FROM rows_of_kind WHERE object_type = 'OWNER'",
    own_tables=OWN["tables"], rows_of_kind=ROWS["tables"],
)

ORACLE["recipient_ip_payload"] = with_inputs(
    """SELECT recipient_name,
       '{"ip_access_list":{"allowed_ip_addresses":[' || coalesce(string_agg('"' || allowed_ip_range || '"', ','
       ORDER BY allowed_ip_range), '') || ']}}' AS api_payload
FROM fx_ip_ranges GROUP BY recipient_name"""
)

ORACLE["external_locations_by_host"] = with_inputs(
    """SELECT host, string_agg(external_location_name, ',' ORDER BY external_location_name) AS external_location_names
FROM (SELECT external_location_name, CASE WHEN url LIKE '%@%' THEN split_part(split_part(url, '@', 2), '/', 1)
             ELSE regexp_extract(url, '://([^/]+)', 1) END AS host FROM fx_external_locations) AS hosted
GROUP BY host"""
)

# --- table statements -----------------------------------------------------------------------

COLUMN_TEXT = """SELECT table_id, position, partition_index, '`' || name || '`' AS ticked_name,
       '`' || name || '` ' || type_text
       || CASE WHEN generation_expr IS NOT NULL THEN ' GENERATED ALWAYS AS (' || generation_expr || ')'
               WHEN identity_start IS NOT NULL THEN ' GENERATED ' || CASE WHEN explicit_insert THEN 'BY DEFAULT' ELSE 'ALWAYS' END || ' AS IDENTITY (START WITH ' || identity_start || ' INCREMENT BY 1)'
               WHEN default_expr IS NOT NULL THEN ' DEFAULT ' || default_expr
               WHEN mask_function IS NOT NULL THEN ' MASK ' || """ + quoted("mask_function") + """
                    || CASE WHEN mask_uses_columns THEN ' USING COLUMNS (`a`, `b`)' ELSE '' END
               WHEN NOT nullable THEN ' NOT NULL' ELSE '' END
       || CASE WHEN comment IS NOT NULL THEN ' COMMENT ''' || replace(comment, '''', '''''') || '''' ELSE '' END AS column_text
FROM fx_columns"""
COLUMN_LISTS = f"""SELECT table_id, string_agg(column_text, ',' || {NL} ORDER BY position) AS columns_ddl,
       string_agg(ticked_name, ', ' ORDER BY partition_index, position) FILTER (WHERE partition_index IS NOT NULL) AS partition_columns
FROM column_texts GROUP BY table_id"""
PROPERTY_LISTS = f"""SELECT table_id, string_agg({TAB} || '''' || key || ''' = ''' || value || '''', ',' || {NL} ORDER BY key) AS properties
FROM fx_table_properties WHERE key IN ('delta.appendOnly', 'team') GROUP BY table_id"""
CONSTRAINT_LISTS = f"""SELECT table_id, string_agg(CASE kind WHEN 'PRIMARY KEY' THEN 'CONSTRAINT ' || name || ' PRIMARY KEY (`a`, `b`)'
       ELSE 'CONSTRAINT ' || name || ' FOREIGN KEY (`a`) REFERENCES c.s.parent (`id`)' END, ',' || {NL} ORDER BY name) AS constraints
FROM fx_table_constraints GROUP BY table_id"""
FILTER_TEXTS = """SELECT table_id, 'ROW FILTER `c`.`s`.`filter_fn`' || CASE WHEN input_columns IS NOT NULL THEN ' ON (`a`, `b`)' ELSE '' END AS row_filter
FROM fx_row_filters"""
FULL_DDL = (
    f"{CREATE_TABLE} || "
    + clause(
        "columns_ddl IS NOT NULL",
        f"'(' || columns_ddl || CASE WHEN constraints IS NOT NULL THEN ',' || {NL} || constraints ELSE '' END || ')'",
    )
    + " || " + clause("t.table_id % 2 = 0", "'USING DELTA'")
    + " || " + clause(
        "table_type = 'EXTERNAL'",
        "'LOCATION ''s3://b/it''''s (' || table_name || ')''' || CASE WHEN t.table_id % 4 = 0 THEN ' WITH (CREDENTIAL cred_1)' ELSE '' END",
    )
    + " || " + clause("partition_columns IS NOT NULL AND clustered IS NULL", "'PARTITIONED BY (' || partition_columns || ')'")
    + " || " + clause("partition_columns IS NULL AND clustered IS NOT NULL", "'CLUSTER BY (`a`, `b`)'")
    + f" || {COMMENT} || "
    + clause("properties IS NOT NULL", f"'TBLPROPERTIES (' || {NL} || properties || {NL} || ')'")
    + " || " + clause("row_filter IS NOT NULL", "'WITH ' || row_filter")
)
FULL_TABLES = objects(
    "fx_tables AS t LEFT JOIN column_lists AS cl ON cl.table_id = t.table_id"
    " LEFT JOIN property_lists AS pl ON pl.table_id = t.table_id"
    " LEFT JOIN constraint_lists AS kl ON kl.table_id = t.table_id"
    " LEFT JOIN filter_texts AS ft ON ft.table_id = t.table_id"
    " LEFT JOIN (SELECT table_id, value AS clustered FROM fx_table_properties WHERE key = 'delta.liquid.clusteringColumns'"
    " AND value IS NOT NULL) AS lq ON lq.table_id = t.table_id",
    TABLE_FULL, "TABLE", "table_catalog || '.' || table_schema", "SCHEMA", "table_owner", ddl=FULL_DDL,
) + f" WHERE table_type IN ('EXTERNAL', 'MANAGED') AND {RESERVED_SCHEMA}"
TABLE_STEPS = {
    "column_texts": COLUMN_TEXT,
    "column_lists": COLUMN_LISTS,
    "property_lists": PROPERTY_LISTS,
    "constraint_lists": CONSTRAINT_LISTS,
    "filter_texts": FILTER_TEXTS,
}

ORACLE["columns_ddl"] = with_inputs(
    "SELECT table_id, columns_ddl, partition_columns FROM column_lists",
    column_texts=COLUMN_TEXT, column_lists=COLUMN_LISTS,
)
ORACLE["table_ddl_full"] = with_inputs(
    "SELECT object_name, restore_ddl FROM own_tables", **TABLE_STEPS, own_tables=FULL_TABLES
)
FALLBACK = f"""CASE WHEN object_type = 'TABLE' AND restore_ddl IS NOT NULL THEN 'CREATE TABLE ' || {quoted('object_name')} || {NL} || 'USING DELTA'
            || CASE WHEN regexp_matches(restore_ddl, '\\nLOCATION ''') THEN {NL} || 'LOCATION '
               || regexp_extract(restore_ddl, '\\nLOCATION (''(?:[^'']|'''')*'')', 1) ELSE '' END END AS fallback_ddl,
       CASE WHEN object_type = 'TABLE' AND regexp_matches(restore_ddl, '\\nTBLPROPERTIES \\(')
            THEN 'ALTER TABLE ' || {quoted('object_name')} || ' SET TBLPROPERTIES ('
                 || regexp_extract(restore_ddl, '\\nTBLPROPERTIES \\((.*?\\n)\\)', 1, 's') || ')' END AS fallback_props_ddl"""
ORACLE["fallback_ddl"] = with_inputs(
    f"SELECT object_name, {FALLBACK} FROM own_tables", **TABLE_STEPS, own_tables=FULL_TABLES
)

KIND_DDL = (
    "CASE kind WHEN 'VOLUME' THEN CASE type WHEN 'EXTERNAL' THEN 'CREATE EXTERNAL VOLUME `c`.`s`.`' ELSE 'CREATE VOLUME `c`.`s`.`' END || name || '`' || "
    + clause("type = 'EXTERNAL'", "'LOCATION ''' || storage_location || ''''") + f" || {COMMENT}"
    f" WHEN 'FUNCTION' THEN 'CREATE OR REPLACE FUNCTION `c`.`s`.`' || name || '`(a INT, b INT)' || {NL} || 'RETURNS INT' || {NL}"
    f" || 'LANGUAGE python' || {COMMENT} || {NL} || 'AS $$ ' || name || ' $$'"
    f" WHEN 'CONNECTION' THEN {connection_ddl('name')}"
    " WHEN 'RECIPIENT' THEN 'CREATE RECIPIENT `' || name || '`' || "
    + clause("sharing_id IS NOT NULL", "'USING ID ''' || sharing_id || ''''") + f" || {COMMENT}"
    f" WHEN 'SHARE' THEN 'CREATE SHARE `' || name || '`' || {COMMENT} ELSE "
    + share_object("share_name", "shared_type", "'c.s.' || name", "'(x = 1)'", "name", "history") + " END"
)
ORACLE["render_other_kinds"] = with_inputs(
    f"""SELECT kind, name, {KIND_DDL} AS restore_ddl,
       CASE kind WHEN 'DELTA SHARING SHARE OBJECT' THEN '`c`.`s`.`' || name || '`' ELSE '' END AS shared_name
FROM fx_kinds"""
)

ORACLE["parse_sections"] = with_inputs(
    """SELECT function_name, ord,
       CASE ord WHEN 0 THEN 'function' WHEN 1 THEN 'type' WHEN 2 THEN 'input' WHEN 3 THEN 'input' WHEN 4 THEN 'returns'
                WHEN 5 THEN 'returns' WHEN 6 THEN 'deterministic' WHEN 7 THEN 'language' ELSE 'body' END AS section,
       CAST(CASE ord WHEN 3 THEN 2 WHEN 5 THEN 4 ELSE ord END AS INTEGER) AS start,
       trim(CASE WHEN ord IN (3, 5) THEN function_desc ELSE substr(function_desc, strpos(function_desc, ':') + 1) END) AS text
FROM fx_description_rows"""
)
ORACLE["function_statements"] = with_inputs(
    f"SELECT 'c.s.f_' || p_partkey AS function_name, {FUNCTION_DDL} AS restore_ddl FROM part"
)
ORACLE["model_versions_plan"] = with_inputs(
    """SELECT full_name AS object_name, CAST(version AS BIGINT) AS version_number, source, run_id, description, alias_list AS aliases,
       tag AS tags, current_stage
FROM fx_models WHERE full_name IN (SELECT full_name FROM fx_model_list)"""
)

# --- backup -------------------------------------------------------------------------------------

ORACLE["uid_uniqueness"] = with_inputs(
    f"""SELECT count(*) AS objects, (SELECT count(*) FROM (SELECT DISTINCT {IDENTITY} FROM fx_inventory) AS d) AS ids,
       CAST(0 AS BIGINT) AS without_id FROM fx_inventory"""
)

_BACKUP_STEPS = {f"own_{key}": sql for key, sql in OWN.items() if key != "tables"}
ORACLE["full_backup"] = with_inputs(
    f"""SELECT {IDENTITY}, {RUN_AT} AS created_tsp FROM all_rows
WHERE restore_ddl IS NOT NULL OR api_payload IS NOT NULL""",
    **TABLE_STEPS, **_BACKUP_STEPS, own_tables=FULL_TABLES,
    all_rows="\nUNION ALL\n".join(f"SELECT {IDENTITY} FROM ({sql}) AS rows_{key}" for key, sql in ROWS.items()),
)

INVENTORY = (
    "object_name, object_type, object_parent_name, object_parent_type, object_cross_relationship, "
    "object_uid, restore_ddl, api_payload, created_tsp"
)
RESTORABLE = "(restore_ddl IS NOT NULL OR api_payload IS NOT NULL)"
_ALL_ROWS = "\nUNION ALL\n".join(
    f"SELECT {IDENTITY} FROM ({sql}) AS rows_{key}" for key, sql in ROWS.items()
)
ORACLE["backup_ids"] = with_inputs(
    f"""SELECT count(*) AS objects, (SELECT count(*) FROM (SELECT DISTINCT * FROM kept) AS d) AS contents,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM kept) AS d) AS ids, CAST(0 AS BIGINT) AS without_id FROM kept""",
    **TABLE_STEPS, **_BACKUP_STEPS, own_tables=FULL_TABLES, all_rows=_ALL_ROWS,
    kept="SELECT * FROM all_rows WHERE restore_ddl IS NOT NULL OR api_payload IS NOT NULL",
)

ORACLE["snapshot_write_read"] = with_inputs(f"SELECT {INVENTORY} FROM fx_past WHERE {RESTORABLE}")

WATERMARK = (
    "(SELECT coalesce(max(created_tsp), TIMESTAMP '1900-01-01 00:00:00') FROM fx_past WHERE object_type = 'TABLE')"
)
ORACLE["incremental_watermark"] = with_inputs(f"SELECT {WATERMARK} AS watermark")
CURRENT = f"""SELECT {TABLE_FULL} AS object_name, last_altered FROM fx_tables WHERE table_type IN ('EXTERNAL', 'MANAGED')"""
REFRESH = f"""SELECT object_name FROM current_tables WHERE last_altered > {WATERMARK}
UNION
(SELECT object_name FROM current_tables EXCEPT SELECT object_name FROM fx_past WHERE object_type = 'TABLE' AND restore_ddl IS NOT NULL)"""
ORACLE["self_heal_set"] = with_inputs(
    "SELECT object_name FROM to_refresh", current_tables=CURRENT, to_refresh=REFRESH
)
ORACLE["incremental_merge"] = with_inputs(
    f"""SELECT {IDENTITY}, {RUN_AT} AS created_tsp FROM rows_of_kind
WHERE object_name IN (SELECT object_name FROM to_refresh) AND {RESTORABLE}
UNION ALL
SELECT {IDENTITY}, created_tsp FROM fx_past
WHERE (object_type = 'TABLE' OR (object_type = 'OWNER' AND object_parent_type = 'TABLE')) AND {RESTORABLE}
  AND object_name IN (SELECT object_name FROM current_tables WHERE last_altered <= {WATERMARK} OR last_altered IS NULL)
  AND object_name NOT IN (SELECT object_name FROM to_refresh)""",
    current_tables=CURRENT, to_refresh=REFRESH, own_tables=OWN["tables"], rows_of_kind=ROWS["tables"],
)

# --- snapshots ------------------------------------------------------------------------------------

SNAPSHOT = f"version, {INVENTORY}"
ORACLE["snapshot_as_of_version"] = with_inputs(f"SELECT {SNAPSHOT} FROM fx_snapshots WHERE version = 3")
ORACLE["snapshot_as_of_timestamp"] = with_inputs(
    f"""SELECT {SNAPSHOT} FROM fx_snapshots WHERE version = (
    SELECT version FROM (SELECT version, timestamp, lag(timestamp) OVER (ORDER BY version DESC) AS next_timestamp FROM fx_history) AS h
    WHERE timestamp <= TIMESTAMP '2000-06-01 00:00:00' AND (next_timestamp > TIMESTAMP '2000-06-01 00:00:00' OR next_timestamp IS NULL))"""
)
ORACLE["snapshot_latest"] = with_inputs(
    f"SELECT {SNAPSHOT} FROM fx_snapshots WHERE version = (SELECT max(version) FROM fx_history)"
)
ORACLE["version_intervals"] = with_inputs(
    "SELECT version, timestamp, lag(timestamp) OVER (ORDER BY version DESC) AS next_timestamp FROM fx_history"
)
ORACLE["snapshot_history"] = with_inputs("SELECT version, timestamp FROM fx_history ORDER BY version DESC")
ORACLE["snapshot_history_latest"] = with_inputs(
    "SELECT version, timestamp FROM fx_history ORDER BY version DESC LIMIT 1"
)
ORACLE["expired_versions"] = with_inputs(
    """SELECT version, timestamp FROM (SELECT version, timestamp, lead(timestamp) OVER (ORDER BY version) AS next_timestamp FROM fx_history) AS h
WHERE next_timestamp < TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 500 DAY"""
)
NAMED = INVENTORY.replace("object_name,", "lower(object_name) AS object_name,", 1)
ORACLE["object_history"] = with_inputs(
    f"""SELECT s.version, h.timestamp, {NAMED} FROM fx_snapshots AS s JOIN fx_history AS h ON s.version = h.version
WHERE lower(object_name) = 'obj.14' AND object_type = 'VIEW'
  AND h.timestamp >= (SELECT max(timestamp) FROM fx_history) - INTERVAL 1500 DAY"""
)
ORACLE["object_latest"] = with_inputs(
    f"""SELECT s.version, h.timestamp, {NAMED} FROM fx_snapshots AS s JOIN fx_history AS h ON s.version = h.version
WHERE lower(object_name) = 'obj.17' AND object_type = 'VOLUME'
  AND s.version = (SELECT max(version) FROM fx_snapshots WHERE lower(object_name) = 'obj.17' AND object_type = 'VOLUME')"""
)
DIFF = INVENTORY.replace(", created_tsp", "")
ORACLE["snapshot_diff"] = with_inputs(
    f"""SELECT 'Post' AS backup_source, * FROM (SELECT {DIFF} FROM fx_snapshots WHERE version = 4 EXCEPT SELECT {DIFF} FROM fx_snapshots WHERE version = 3) AS a
UNION ALL
SELECT 'Pre' AS backup_source, * FROM (SELECT {DIFF} FROM fx_snapshots WHERE version = 3 EXCEPT SELECT {DIFF} FROM fx_snapshots WHERE version = 4) AS b"""
)

ORACLE["snapshot_diff_stored"] = ORACLE["snapshot_diff"]
ORACLE["object_search_stored"] = with_inputs(
    f"""SELECT CAST(version - 3 AS INTEGER) AS version,
       CASE version WHEN 3 THEN TIMESTAMP '2000-07-01 00:00:00' ELSE {RUN_AT} END AS timestamp, {NAMED}
FROM fx_snapshots WHERE lower(object_name) = 'obj.17' AND object_type = 'VOLUME'
  AND version = (SELECT max(version) FROM fx_snapshots WHERE version IN (3, 4) AND lower(object_name) = 'obj.17' AND object_type = 'VOLUME')"""
)
ORACLE["versions_at_times"] = with_inputs(
    """SELECT o_orderkey, o_orderdate, version FROM orders ASOF LEFT JOIN fx_history ON o_orderdate >= timestamp"""
)

# --- selection and restore ----------------------------------------------------------------------------

ONE_SCHEMA = (
    "(object_type = 'SCHEMA' AND object_parent_type = 'CATALOG' AND object_parent_name = 'asia' AND object_name = 'asia.nation_2')"
)
IN_SCHEMA = "object_parent_type = 'SCHEMA' AND object_parent_name = 'asia.nation_2'"


def whole_catalog(name: str) -> str:
    return (
        f"(object_type = 'SCHEMA' AND object_parent_type = 'CATALOG' AND object_parent_name = '{name}') OR (object_parent_type = 'SCHEMA' AND "
        f"object_parent_name IN (SELECT object_name FROM fx_inventory WHERE object_type = 'SCHEMA' AND object_parent_name = '{name}'))"
    )


def catalog_rows(*names: str) -> str:
    listed = ", ".join(f"'{name}'" for name in names)
    return f"(object_type = 'CATALOG' AND object_name IN ({listed}))"


MIXED = (
    "(object_type = 'SHARE' AND object_name IN ('Brand#11', 'Brand#23')) OR object_type IN ('EXTERNAL LOCATION', 'RECIPIENT') OR "
    f"{catalog_rows('europe', 'asia')} OR {whole_catalog('europe')} OR {ONE_SCHEMA} OR ({IN_SCHEMA} AND object_type = 'TABLE')"
)
CONDITIONS = {
    "select_all": "true",
    "select_credential_star": "object_type IN ('STORAGE CREDENTIAL', 'EXTERNAL LOCATION')",
    "select_credential_list": "(object_type = 'STORAGE CREDENTIAL' AND object_name = 'cred_1')"
    " OR (object_type = 'EXTERNAL LOCATION' AND object_parent_name = 'cred_1')",
    "select_catalog_star": "object_type IN ('CATALOG', 'SCHEMA') OR object_parent_type = 'SCHEMA'",
    "select_one_catalog": f"{catalog_rows('asia')} OR {whole_catalog('asia')}",
    "select_schema_star": f"{catalog_rows('asia')} OR {whole_catalog('asia')}",
    "select_one_schema": f"{catalog_rows('asia')} OR {ONE_SCHEMA} OR ({IN_SCHEMA})",
    "select_kind_star": f"{catalog_rows('asia')} OR {ONE_SCHEMA} OR ({IN_SCHEMA} AND object_type = 'VIEW')",
    "select_kind_list": f"{catalog_rows('asia')} OR {ONE_SCHEMA} OR ({IN_SCHEMA} AND object_type = 'TABLE'"
    " AND object_name IN ('asia.nation_2.t_0', 'asia.nation_2.t_32'))",
    "select_mixed": MIXED,
}
for _query, _condition in CONDITIONS.items():
    ORACLE[_query] = with_inputs(f"SELECT {INVENTORY} FROM fx_inventory WHERE {_condition}")

ORACLE["select_large_spec"] = with_inputs(
    f"""SELECT {INVENTORY} FROM fx_inventory
WHERE (object_type = 'CATALOG' AND object_name IN (SELECT table_catalog FROM named))
   OR (object_type = 'SCHEMA' AND object_parent_type = 'CATALOG' AND (object_name, object_parent_name) IN (SELECT schema_name, table_catalog FROM named))
   OR (object_parent_type = 'SCHEMA' AND (object_type, object_name, object_parent_name) IN (SELECT kind, table_name, schema_name FROM named))""",
    named="""SELECT table_catalog, table_catalog || '.' || table_schema AS schema_name, table_catalog || '.' || table_schema || '.' || table_name AS table_name,
       CASE WHEN table_type = 'VIEW' THEN 'VIEW' ELSE 'TABLE' END AS kind FROM fx_tables WHERE table_owner IS NOT NULL""",
)

CORE = (
    "('STORAGE CREDENTIAL', 'EXTERNAL LOCATION', 'CONNECTION', 'SHARE', 'RECIPIENT', 'CATALOG', 'SCHEMA', 'TABLE', 'VIEW', "
    "'FUNCTION', 'VOLUME', 'REGISTERED MODEL')"
)
HANGING = "('OWNER', 'TAG', 'PRIVILEGE', 'DELTA SHARING SHARE OBJECT')"
CHOSEN = f"SELECT {INVENTORY} FROM fx_inventory WHERE {MIXED}"
WITH_DEPENDENTS = f"""SELECT {INVENTORY} FROM chosen
UNION
SELECT {INVENTORY} FROM fx_inventory WHERE object_type IN {HANGING}
  AND object_name IN (SELECT object_name FROM chosen WHERE object_type IN {CORE})"""
BY_KIND = f"""SELECT {INVENTORY} FROM chosen
UNION
SELECT {INVENTORY} FROM fx_inventory WHERE object_type IN {HANGING}
  AND (object_name, object_parent_type) IN (SELECT object_name, object_type FROM chosen WHERE object_type IN {CORE})"""
WORK = f"""SELECT {INVENTORY} FROM with_hanging
WHERE object_uid NOT IN (SELECT rowid FROM fx_checkpoint WHERE jobid = 2 AND status = 'Succeeded')"""
WORK_STEPS = {"chosen": CHOSEN, "with_hanging": WITH_DEPENDENTS, "work": WORK}

ORACLE["attach_dependents"] = with_inputs(
    f"SELECT {INVENTORY} FROM with_hanging", chosen=CHOSEN, with_hanging=WITH_DEPENDENTS
)
ORACLE["attach_dependents_by_kind"] = with_inputs(
    f"SELECT {INVENTORY} FROM with_hanging", chosen=CHOSEN, with_hanging=BY_KIND
)
ORACLE["remaining_work"] = with_inputs(f"SELECT {INVENTORY} FROM work", **WORK_STEPS)

_ORDER = [
    "STORAGE CREDENTIAL", "EXTERNAL LOCATION", "CONNECTION", "CATALOG", "SCHEMA", "TABLE", "VIEW", "VOLUME", "FUNCTION",
    "REGISTERED MODEL", "SHARE", "RECIPIENT", "DELTA SHARING SHARE OBJECT", "TAG", "PRIVILEGE", "OWNER",
]
PHASE = "CAST(CASE object_type " + " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(_ORDER, 1)) + " ELSE 0 END AS INTEGER)"
STAGE = (
    "CASE WHEN object_type = 'TABLE' OR (object_type = 'OWNER' AND object_parent_type = 'TABLE') THEN 'table' "
    "WHEN object_type IN ('VIEW', 'FUNCTION', 'DELTA SHARING SHARE OBJECT', 'TAG', 'PRIVILEGE', 'OWNER') THEN 'post' ELSE 'pre' END"
)
PLAN_PARENT = (
    f"CASE WHEN {STAGE} = 'table' THEN regexp_extract(object_parent_name, '([^.]+\\.[^.]+)', 1) ELSE object_parent_name END"
)
PLAN = f"""SELECT {PHASE} AS phase, {STAGE} AS stage, object_uid, object_type, object_name, object_parent_type,
       {PLAN_PARENT} AS object_parent_name, restore_ddl AS statement, api_payload,
       CASE WHEN object_type = 'TABLE' AND restore_ddl IS NOT NULL THEN 'CREATE TABLE ' || {quoted('object_name')} || {NL} || 'USING DELTA'
            || CASE WHEN restore_ddl LIKE '%LOCATION %' THEN {NL} || 'LOCATION ''' || regexp_extract(restore_ddl, 'LOCATION ''([^'']+)''', 1) || ''''
               ELSE '' END END AS fallback_ddl,
       {NO_TEXT} AS fallback_props_ddl
FROM work"""
ORACLE["restore_plan"] = with_inputs(f"{PLAN} ORDER BY phase, object_name", **WORK_STEPS)
ORACLE["backup_restore_roundtrip"] = with_inputs(
    f"""SELECT {PHASE} AS phase, {STAGE} AS stage, object_type, object_name, object_parent_type,
       {PLAN_PARENT} AS object_parent_name, restore_ddl AS statement, api_payload, {FALLBACK}
FROM all_rows WHERE (restore_ddl IS NOT NULL OR api_payload IS NOT NULL) AND object_name LIKE '%7'""",
    **TABLE_STEPS, **_BACKUP_STEPS, own_tables=FULL_TABLES, all_rows=_ALL_ROWS,
)
ORACLE["executor_statements"] = with_inputs(
    """SELECT object_type, object_name, step,
       CASE step WHEN 'grant' THEN 'GRANT ALL PRIVILEGES ON ' || object_type || ' `' || object_name || '` TO `restorer`'
                 ELSE 'REVOKE ALL PRIVILEGES ON ' || object_type || ' `' || object_name || '` FROM `restorer`' END AS statement
FROM fx_inventory CROSS JOIN (VALUES ('grant'), ('revoke')) AS s(step)
WHERE object_type IN ('STORAGE CREDENTIAL', 'EXTERNAL LOCATION', 'CATALOG')
UNION ALL
SELECT object_type, object_name, 'own', 'ALTER SHARE `' || object_name || '` SET OWNER TO `restorer`' FROM work WHERE object_type = 'SHARE'""",
    **WORK_STEPS,
)
GROUPS = """SELECT object_parent_name, object_count,
       CAST(row_number() OVER (ORDER BY object_count DESC, object_parent_name) % 8 AS INTEGER) AS group_id
FROM (SELECT object_parent_name, count(*) AS object_count FROM work WHERE object_type = 'TABLE' GROUP BY object_parent_name) AS counted"""
ORACLE["schema_groups"] = with_inputs(
    "SELECT object_parent_name, object_count, group_id FROM schema_shards", **WORK_STEPS, schema_shards=GROUPS
)
ORACLE["group_slice"] = with_inputs(
    """SELECT p.*, g.group_id FROM planned AS p JOIN schema_shards AS g USING (object_parent_name)
WHERE stage = 'table' AND group_id = 3""",
    **WORK_STEPS, schema_shards=GROUPS, planned=PLAN,
)
ORACLE["restore_plan_sharded"] = with_inputs(
    """SELECT p.*, CASE WHEN stage = 'table' THEN g.group_id END AS group_id
FROM planned AS p LEFT JOIN schema_shards AS g USING (object_parent_name)""",
    **WORK_STEPS, schema_shards=GROUPS, planned=PLAN,
)
ORACLE["route_by_count"] = with_inputs(
    """SELECT count(*) AS restore_object_count, CASE WHEN count(*) > 5000 THEN 'sharded' ELSE 'single' END AS route
FROM fx_inventory WHERE object_type = 'TABLE'"""
)

# --- outcomes, jobs, reports -------------------------------------------------------------------------------

OUTCOMES = f"""SELECT object_uid, {NO_TEXT} AS error_message, 'Succeeded' AS status FROM fx_inventory
WHERE object_uid NOT IN (SELECT object_uid FROM fx_failures)
UNION ALL
SELECT object_uid, error_message, 'Failed' FROM fx_failures"""
ORACLE["record_outcomes"] = with_inputs("SELECT object_uid, error_message, status FROM made", made=OUTCOMES)
ORACLE["record_outcomes_fallback"] = with_inputs(
    """SELECT object_uid, error_message, status, (status = 'Succeeded' AND object_uid IN
    (SELECT object_uid FROM fx_inventory WHERE restore_ddl LIKE '%LOCATION ''%')) AS used_fallback FROM made""",
    made=OUTCOMES,
)
ORACLE["checkpoint_append"] = with_inputs(
    """SELECT CAST(1 AS BIGINT) AS jobid, object_uid AS rowid, status, error_message, TIMESTAMP '2024-01-01 00:00:00' AS record_timestamp FROM made
UNION ALL
SELECT CAST(2 AS BIGINT), object_uid, status, error_message, TIMESTAMP '2024-01-02 00:00:00' FROM made WHERE status = 'Failed'""",
    made=OUTCOMES,
)
ORACLE["job_max_id"] = with_inputs(
    """SELECT coalesce(max(jobid), 0) AS max_jobid, arg_max(jobstatus, jobid) AS jobstatus FROM fx_jobs WHERE jobtype = 'job_7'"""
)
LAST = "SELECT jobtype, max(jobid) AS last_jobid, arg_max(jobstatus, jobid) AS last_status FROM fx_jobs GROUP BY jobtype"
ORACLE["job_last_per_type"] = with_inputs("SELECT jobtype, last_jobid, last_status FROM last_jobs", last_jobs=LAST)
_DUE = (
    "jobtype = 'job_7' AND jobid = (SELECT max(jobid) FROM fx_jobs WHERE jobtype = 'job_7') AND jobstatus IN ('Running', 'Failed')"
)
ORACLE["job_update_status"] = with_inputs(
    f"""SELECT jobid, jobtype, CASE WHEN {_DUE} THEN 'Completed' ELSE jobstatus END AS jobstatus, jobstart,
       CASE WHEN {_DUE} THEN {RUN_AT} ELSE jobend END AS jobend, backupversion FROM fx_jobs"""
)
_NEW = f"""SELECT coalesce(last_jobid, 0) + 1 AS jobid, t.jobtype, 'Running' AS jobstatus, {RUN_AT} AS jobstart, CAST(NULL AS TIMESTAMP) AS jobend,
       CAST(6 AS INTEGER) AS backupversion FROM fx_job_types AS t LEFT JOIN last_jobs AS l ON l.jobtype = t.jobtype"""
ORACLE["job_next_run_fresh"] = with_inputs(
    f"""SELECT jobid, j.jobtype, CASE WHEN jobid = last_jobid AND jobstatus IN ('Running', 'Failed') THEN 'Completed' ELSE jobstatus END AS jobstatus,
       jobstart, CASE WHEN jobid = last_jobid AND jobstatus IN ('Running', 'Failed') THEN {RUN_AT} ELSE jobend END AS jobend, backupversion
FROM fx_jobs AS j JOIN last_jobs AS l ON l.jobtype = j.jobtype
UNION ALL
{_NEW}""",
    last_jobs=LAST,
)
ORACLE["job_next_run_restart"] = with_inputs(
    f"""SELECT jobid, j.jobtype, CASE WHEN jobid = last_jobid AND last_status NOT IN ('Succeeded', 'Completed') THEN 'Running' ELSE jobstatus END AS jobstatus,
       jobstart, jobend, backupversion FROM fx_jobs AS j JOIN last_jobs AS l ON l.jobtype = j.jobtype
UNION ALL
{_NEW} WHERE last_status IS NULL OR last_status IN ('Succeeded', 'Completed')""",
    last_jobs=LAST,
)
LATEST = """SELECT jobid, rowid, status, error_message, record_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY rowid ORDER BY record_timestamp DESC, status) AS place FROM fx_checkpoint WHERE jobid = 2) AS ranked
WHERE place = 1"""
ORACLE["latest_status"] = with_inputs(
    "SELECT jobid, rowid, status, error_message, record_timestamp FROM newest", newest=LATEST
)
DETAIL = """SELECT jobid, rowid, status, error_message, object_name, object_type, object_parent_name, object_parent_type, record_timestamp,
       restore_ddl, api_payload, created_tsp
FROM fx_checkpoint LEFT JOIN fx_inventory ON rowid = object_uid WHERE jobid = 2"""
ORACLE["report_detail"] = with_inputs(DETAIL)
ORACLE["report_failures_csv"] = with_inputs(f"{DETAIL} AND status = 'Failed'")
ORACLE["report_status_summary"] = with_inputs(
    """SELECT jobid, status, count(status) AS total_count, max(record_timestamp) AS record_timestamp FROM newest GROUP BY jobid, status""",
    newest=LATEST,
)
ORACLE["report_status_summary_sql"] = ORACLE["report_status_summary"]
_REPORT = [
    "STORAGE CREDENTIAL", "EXTERNAL LOCATION", "CONNECTION", "SHARE", "RECIPIENT", "CATALOG", "SCHEMA", "TABLE", "VIEW", "FUNCTION",
    "REGISTERED MODEL",
]
REPORT_RANK = (
    "CAST(CASE " + " ".join(f"WHEN object_type = '{n}' OR object_parent_type = '{n}' THEN {i}" for i, n in enumerate(_REPORT, 1))
    + " ELSE 12 END AS INTEGER)"
)
ORACLE["report_by_type"] = with_inputs(
    f"""SELECT jobid, object_type, object_parent_type, status, count(*) AS total_count, max(record_timestamp) AS record_timestamp,
       {REPORT_RANK} AS report_rank
FROM newest LEFT JOIN fx_inventory ON rowid = object_uid GROUP BY jobid, object_type, object_parent_type, status""",
    newest=LATEST,
)
ORACLE["report_counts_csv"] = with_inputs(
    "SELECT object_type, count(*) AS count FROM work GROUP BY object_type", **WORK_STEPS
)

# --- checks and audit -----------------------------------------------------------------------------------------

UNRESTORABLE = f"""SELECT regexp_extract(object_name, '^([^.]+)\\.', 1) AS catalog, {INVENTORY} FROM fx_inventory
WHERE NOT {RESTORABLE} AND regexp_extract(object_name, '^([^.]+)\\.', 1) NOT IN
      (SELECT object_name FROM fx_inventory WHERE object_type = 'CATALOG' AND restore_ddl LIKE '%USING SHARE%')"""
ORACLE["post_check_unrestorable"] = with_inputs(UNRESTORABLE)
ORACLE["post_check_is_clean"] = with_inputs(
    "SELECT count(*) = 0 AS is_empty FROM unrestorable", unrestorable=UNRESTORABLE
)
ORACLE["count_by_type"] = with_inputs(
    "SELECT object_type, count(*) AS count FROM fx_inventory GROUP BY object_type ORDER BY object_type"
)
EVENTS = """SELECT coalesce(param_name, param_name_arg) AS catalog_name, action_name, event_time FROM fx_audit"""
NEWEST_EVENT = """SELECT catalog_name, action_name, event_time FROM (
    SELECT *, row_number() OVER (PARTITION BY catalog_name ORDER BY event_time DESC, action_name) AS place FROM named_events) AS ranked
WHERE place = 1"""
ORACLE["audit_latest_state_more"] = with_inputs(
    "SELECT catalog_name, action_name, event_time FROM newest_events",
    named_events="""SELECT CASE action_name WHEN 'updateCatalog' THEN 'moved_' || param_name_arg ELSE coalesce(param_name, param_name_arg) END AS catalog_name,
       CASE action_name WHEN 'updateCatalog' THEN 'moveCatalog' ELSE action_name END AS action_name, event_time FROM fx_audit""",
    newest_events=NEWEST_EVENT,
)
UNBOUND = """SELECT catalog_name FROM newest_events WHERE action_name <> 'deleteCatalog'
  AND catalog_name NOT IN ('system', 'default', 'hive_metastore', 'spark_catalog')
EXCEPT SELECT catalog_name FROM fx_visible_catalogs"""
ORACLE["audit_latest_state"] = with_inputs(
    "SELECT catalog_name, action_name, event_time FROM newest_events", named_events=EVENTS, newest_events=NEWEST_EVENT
)
ORACLE["audit_unbound"] = with_inputs(UNBOUND, named_events=EVENTS, newest_events=NEWEST_EVENT)
ORACLE["audit_look_back"] = with_inputs(
    "SELECT coalesce(max(created_tsp) - INTERVAL 2 HOUR, TIMESTAMP '1900-01-01 00:00:00') AS since FROM fx_past"
)
ORACLE["audit_unbound_recent"] = with_inputs(
    UNBOUND, newest_events=NEWEST_EVENT,
    named_events=f"{EVENTS} WHERE event_time > (SELECT max(event_time) - INTERVAL 2 HOUR FROM fx_audit)",
)
