"""Input tables of the queries, derived from the given tables with Spark.

The rows equal those of ``queries.fixture_sql``; the plans are made for size: dimension-like
expansions are generators instead of joins, aggregation comes before joins, and one pass
over a table yields all the rows made from it.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators.ordering import position_in_group
from catkeep.session import scratch_path, shuffles_freed

CREATED = "TIMESTAMP_NTZ '2000-01-01 00:00:00'"
PAST_UNTIL = "TIMESTAMP_NTZ '2000-06-30 00:00:00'"

TABLE_TYPE = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'VIEW' WHEN 'MACHINERY' THEN 'EXTERNAL' "
    "WHEN 'FURNITURE' THEN 'FOREIGN' ELSE 'MANAGED' END"
)
#: Options that take every way through the reader: plain, other values, escapes, nested, broken.
CONNECTION_OPTIONS = """concat('{', chr(39), 'host', chr(39), ': ', chr(39), 'h', p_partkey, chr(39),
  CASE p_partkey % 5
    WHEN 0 THEN concat(', ', chr(39), 'port', chr(39), ': ', chr(39), '1', chr(39), '}')
    WHEN 1 THEN concat(', ', chr(39), 'port', chr(39), ': 1, ', chr(39), 'ssl', chr(39), ': True, ', chr(39), 'user', chr(39), ': None,}')
    WHEN 2 THEN concat(', ', chr(34), 'note', chr(34), ': ', chr(39), 'it', chr(92), chr(39), 's, {x}', chr(39), '}')
    WHEN 3 THEN concat(', ', chr(39), 'list', chr(39), ': [1, {', chr(39), 'a', chr(39), ': (2,)}]}')
    ELSE concat(', ', chr(39), 'port', chr(39), ': }') END)"""
CATALOG_NAME = "lower(replace(r_name, ' ', '_'))"


def inventory_columns(*values: str) -> list[str]:
    pairs = zip(model.INVENTORY_COLUMNS, values, strict=True)
    return [f"{value} AS {name}" for name, value in pairs]


def inventory_struct(*values: str) -> str:
    pairs = zip(model.INVENTORY_COLUMNS, values, strict=True)
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in pairs) + ")"


def failures_of(inventory: DataFrame) -> DataFrame:
    return inventory.filter("object_uid % 10 = 7").selectExpr(
        "object_uid",
        "concat('Failed to create ', object_type, ': ', object_name) AS error_message",
    )


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def stored(self, name: str) -> DataFrame:
        """An input written to the shared folder and read back.

        An inventory is a stored table wherever it is restored or reported from. Queries that
        read it several times read it as that, instead of deriving it each time.
        """
        if name not in self._stored:
            path = scratch_path(self.spark, name)
            with shuffles_freed(self.spark):
                getattr(self, name).write.parquet(path)
            self._stored[name] = self.spark.read.parquet(path)
        return self._stored[name]

    def keep(self, *names: str) -> Fixtures:
        """Store inputs, so that everything derived from them reads the stored rows."""
        for name in names:
            self.__dict__[name] = self.stored(name)
        return self

    # --- catalogs, schemas, tables -------------------------------------------------

    @cached_property
    def fx_catalogs(self) -> DataFrame:
        from_regions = self.table("region").selectExpr(
            f"{CATALOG_NAME} AS catalog_name",
            "concat('owner_', r_regionkey) AS catalog_owner",
            "CASE r_regionkey WHEN 3 THEN 'FOREIGN' WHEN 4 THEN 'DELTA SHARING' ELSE 'REGULAR' END"
            " AS catalog_type",
            "CASE WHEN r_regionkey % 2 = 0 THEN concat('it\\'s region ', r_regionkey) END AS comment",
            f"{CREATED} AS last_altered",
        )
        reserved = self.spark.range(1).selectExpr(
            "'system' AS catalog_name",
            "'admin' AS catalog_owner",
            "'REGULAR' AS catalog_type",
            "CAST(NULL AS STRING) AS comment",
            f"{CREATED} AS last_altered",
        )
        return from_regions.unionByName(reserved)

    @cached_property
    def nations(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def fx_schemata(self) -> DataFrame:
        from_nations = self.nations.selectExpr(
            f"{CATALOG_NAME} AS catalog_name",
            "lower(n_name) AS schema_name",
            "concat('owner_', n_nationkey % 7) AS schema_owner",
            "CASE WHEN n_nationkey % 3 = 0 THEN concat('nation ', n_nationkey) END AS comment",
            f"{CREATED} AS last_altered",
        )
        reserved = self.fx_catalogs.selectExpr(
            "catalog_name",
            "'information_schema' AS schema_name",
            "'admin' AS schema_owner",
            "CAST(NULL AS STRING) AS comment",
            "last_altered",
        )
        return from_nations.unionByName(reserved)

    @cached_property
    def table_names(self) -> DataFrame:
        """fx_tables without the column that needs the orders."""
        placed = self.table("customer").join(
            self.nations, F.col("c_nationkey") == F.col("n_nationkey")
        )
        return placed.selectExpr(
            f"{CATALOG_NAME} AS table_catalog",
            "lower(n_name) AS table_schema",
            "concat('t_', c_custkey) AS table_name",
            f"{TABLE_TYPE} AS table_type",
            "CASE WHEN c_custkey % 13 <> 0 THEN concat('owner_', c_custkey % 7) END AS table_owner",
            "CASE WHEN c_custkey % 5 = 0 THEN concat('customer ', c_custkey) END AS comment",
            "c_custkey AS table_id",
        )

    @cached_property
    def fx_tables(self) -> DataFrame:
        altered = (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("table_id"))
            .agg(F.max("o_orderdate").alias("last_altered"))
        )
        return self.table_names.join(altered, "table_id", "left")

    @cached_property
    def fx_mat_views(self) -> DataFrame:
        return self.fx_views.filter("is_materialized").drop("is_materialized")

    @cached_property
    def fx_views(self) -> DataFrame:
        return self.table_names.filter("table_type = 'VIEW'").selectExpr(
            "table_catalog", "table_schema", "table_name", "table_id % 4 = 0 AS is_materialized"
        )

    @cached_property
    def fx_view_text(self) -> DataFrame:
        return self.table_names.filter("table_type = 'VIEW'").selectExpr(
            "concat(table_catalog, '.', table_schema, '.', table_name) AS view_name",
            "concat(CASE table_id % 4 WHEN 1 THEN '-- CREATE VIEW by hand\\n' WHEN 2 THEN '/* made \\nhere */ ' "
            "ELSE '' END, CASE table_id % 3 WHEN 0 THEN 'CREATE VIEW ' WHEN 1 THEN "
            "'create or replace view ' ELSE 'CREATE VIEW IF NOT EXISTS ' END, "
            "CASE table_id % 2 WHEN 0 THEN concat(table_schema, '.', table_name) "
            "ELSE concat('`', table_schema, '`.`', table_name, '`') END, "
            "CASE table_id % 5 WHEN 0 THEN ' AS SELECT x FROM t WHERE f(x) > 1' "
            "WHEN 1 THEN '\\nAS SELECT 1 AS one' ELSE ' (a, b) AS SELECT (1) a, 2 b' END) AS create_text",
        )

    # --- grants and tags -------------------------------------------------------------

    @cached_property
    def table_grants(self) -> DataFrame:
        """Distinct grants by table id, before they meet the names."""
        return (
            self.table("orders")
            .selectExpr(
                "o_custkey AS table_id",
                "concat('grp_', o_orderkey % 3) AS grantee",
                "upper(substr(o_orderpriority, 3)) AS privilege_type",
                "CASE o_orderstatus WHEN 'P' THEN 'CATALOG' ELSE 'NONE' END AS inherited_from",
            )
            .distinct()
        )

    @cached_property
    def fx_table_privileges(self) -> DataFrame:
        return self.table_grants.join(self.table_names, "table_id").select(
            "table_catalog", "table_schema", "table_name", "grantee", "privilege_type",
            "inherited_from",
        )

    @cached_property
    def fx_catalog_privileges(self) -> DataFrame:
        return self.fx_table_privileges.selectExpr(
            "table_catalog AS catalog_name", "grantee", "privilege_type", "inherited_from"
        ).distinct()

    @cached_property
    def fx_schema_privileges(self) -> DataFrame:
        return self.fx_table_privileges.selectExpr(
            "table_catalog AS catalog_name", "table_schema AS schema_name", "grantee",
            "privilege_type", "inherited_from",
        ).distinct()

    @cached_property
    def fx_table_tags(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_returnflag")
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("table_id"))
        counted = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("table_id", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        return counted.join(self.table_names, "table_id").selectExpr(
            "table_catalog AS catalog_name",
            "table_schema AS schema_name",
            "table_name",
            "l_returnflag AS tag_name",
            "CASE WHEN n % 5 <> 0 THEN concat('v', n) END AS tag_value",
        )

    @cached_property
    def fx_catalog_tags(self) -> DataFrame:
        return self.fx_table_tags.select("catalog_name", "tag_name", "tag_value").distinct()

    @cached_property
    def fx_schema_tags(self) -> DataFrame:
        return self.fx_table_tags.select(
            "catalog_name", "schema_name", "tag_name", "tag_value"
        ).distinct()

    # --- table details -----------------------------------------------------------------

    @cached_property
    def fx_columns(self) -> DataFrame:
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"
        )
        placed = position_in_group(orders, ["o_custkey"], "o_orderkey")
        return placed.selectExpr(
            "o_custkey AS table_id",
            "concat('c_', o_orderkey, CASE WHEN o_orderkey % 23 = 0 THEN concat(chr(39), 's') ELSE '' END) AS name",
            "CAST(position - 1 AS INT) AS position",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'int' WHEN '2-HIGH' THEN 'string' "
            "WHEN '3-MEDIUM' THEN 'decimal(10,2)' WHEN '5-LOW' THEN 'array<string>' "
            "ELSE 'timestamp' END AS type_text",
            "CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderkey % 2 AS INT) END AS partition_index",
            "CASE WHEN o_orderkey % 7 = 0 THEN 'a + 1' END AS generation_expr",
            "CASE WHEN o_orderkey % 5 = 0 THEN 1L END AS identity_start",
            "o_orderkey % 10 = 0 AS explicit_insert",
            "CASE WHEN o_orderkey % 3 = 0 THEN '0' END AS default_expr",
            "o_orderkey % 2 = 0 AS mask_uses_columns",
            "CASE WHEN o_orderkey % 17 = 0 THEN 'c.s.mask_fn' END AS mask_function",
            "o_orderstatus <> 'O' AS nullable",
            "CASE WHEN o_orderkey % 4 = 0 THEN concat('note', CASE WHEN o_orderkey % 8 = 0 THEN "
            "concat(' on LOCATION ', chr(39), 'x', chr(39), ' --') ELSE '' END) END AS comment",
        )

    @cached_property
    def fx_table_properties(self) -> DataFrame:
        return self.table_names.filter("table_id % 3 <> 0").selectExpr(
            "table_id",
            "explode(array('delta.appendOnly', 'delta.lastUpdateVersion', 'team', "
            "'delta.feature.liquid', 'delta.liquid.clusteringColumns')) AS key",
            "concat('v (', table_id % 4, ')') AS value",
        ).selectExpr(
            "table_id", "key",
            "CASE key WHEN 'delta.liquid.clusteringColumns' THEN IF(table_id % 5 = 0, '[\"a\",\"b\"]', NULL) "
            "ELSE value END AS value",
        )

    @cached_property
    def fx_table_constraints(self) -> DataFrame:
        return self.table_names.filter("table_id % 2 = 0").selectExpr(
            "table_id",
            "inline(filter(array("
            "named_struct('name', concat('pk_', table_name), 'kind', 'PRIMARY KEY', "
            "'child_columns', 'a,b', 'parent_table', CAST(NULL AS STRING), "
            "'parent_columns', CAST(NULL AS STRING)), "
            "IF(table_id % 6 = 0, named_struct('name', concat('fk_', table_name), 'kind', "
            "'FOREIGN KEY', 'child_columns', 'a', 'parent_table', 'c.s.parent', "
            "'parent_columns', 'id'), NULL)), x -> x IS NOT NULL))",
        )

    @cached_property
    def fx_row_filters(self) -> DataFrame:
        return self.table_names.filter("table_id % 7 = 0").selectExpr(
            "table_id",
            "'c.s.filter_fn' AS name",
            "CASE WHEN table_id % 14 = 0 THEN 'a,b' END AS input_columns",
        )

    # --- locations, shares, recipients, connections, functions, models --------------------

    @cached_property
    def fx_external_locations(self) -> DataFrame:
        return self.table("pages").selectExpr(
            "concat('loc_', page_id) AS external_location_name",
            "CASE WHEN page_id % 9 = 0 THEN concat('s3://bucket', page_id, '/p') ELSE "
            "concat('abfss://c', page_id % 3, '@', regexp_extract(url, '://([^/]+)', 1), '/p/', "
            "page_id) END AS url",
            "concat('cred_', page_id % 3) AS storage_credential_name",
            "page_id % 4 = 0 AS read_only",
            "CASE WHEN page_id % 2 = 0 THEN 'location' END AS comment",
            "concat('owner_', page_id % 7) AS external_location_owner",
        )

    @cached_property
    def fx_location_privileges(self) -> DataFrame:
        return (
            self.fx_external_locations.withColumn(
                "pr", F.explode(F.array(F.lit("WRITE FILES"), F.lit("READ FILES")))
            )
            .selectExpr(
                "external_location_name",
                "concat('grp_', length(url) % 3) AS grantee",
                "pr AS privilege_type",
                "CASE WHEN read_only AND pr = 'WRITE FILES' THEN 'METASTORE' ELSE 'NONE' END"
                " AS inherited_from",
            )
        )

    @cached_property
    def fx_storage_credentials(self) -> DataFrame:
        return (
            self.fx_external_locations.groupBy("storage_credential_name")
            .agg(F.count(F.lit(1)).alias("n"))
            .selectExpr(
                "storage_credential_name",
                "concat('owner_', n) AS storage_credential_owner",
                "concat('{\"name\":\"', storage_credential_name, '\"}') AS payload",
            )
        )

    @cached_property
    def fx_credential_privileges(self) -> DataFrame:
        return self.fx_external_locations.selectExpr(
            "storage_credential_name",
            "external_location_owner AS grantee",
            "CASE WHEN read_only THEN 'READ FILES' ELSE 'WRITE FILES' END AS privilege_type",
            "'NONE' AS inherited_from",
        ).distinct()

    @cached_property
    def fx_share_grants(self) -> DataFrame:
        lines = self.table("lineitem").select("l_partkey", "l_suppkey", "l_linestatus")
        parts = self.table("part").select("p_partkey", F.col("p_brand").alias("share_name"))
        suppliers = self.table("supplier").select("s_suppkey", "s_name")
        by_brand = (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select("share_name", "l_suppkey", "l_linestatus")
            .distinct()
        )
        return (
            by_brand.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .selectExpr(
                "share_name",
                "CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE s_name END AS recipient_name",
                "CASE WHEN l_linestatus = 'F' THEN 'SELECT' ELSE 'READ' END AS privilege_type",
            )
            .distinct()
        )

    @cached_property
    def fx_ip_ranges(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_name AS recipient_name",
            "inline(filter(array("
            "named_struct('allowed_ip_range', CASE WHEN s_suppkey % 5 <> 0 THEN concat('10.', s_nationkey, '.', "
            "s_suppkey % 256, '.0/24') END), "
            "IF(s_suppkey % 2 = 0, named_struct('allowed_ip_range', concat('192.168.', "
            "s_suppkey % 256, '.0/24')), NULL)), x -> x IS NOT NULL))",
        )

    @cached_property
    def fx_recipients(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_name AS recipient_name",
            "concat('owner_', s_nationkey) AS recipient_owner",
            "CASE WHEN s_suppkey % 3 = 0 THEN concat('gid:', s_suppkey) END"
            " AS data_recipient_global_metastore_id",
            "CASE WHEN s_suppkey % 4 = 0 THEN 'supplier\\'s own' END AS comment",
        )

    @cached_property
    def fx_shares(self) -> DataFrame:
        return (
            self.table("part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
            .selectExpr(
                "p_brand AS share_name",
                "concat('owner_', n) AS share_owner",
                "concat('parts: ', n) AS comment",
            )
        )

    @cached_property
    def fx_share_contents(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_brand AS share_name",
            "CASE p_partkey % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'SCHEMA' "
            "ELSE 'MATERIALIZED VIEW' END AS type",
            "concat('c.s.o_', p_partkey) AS shared_object",
            "concat('a_', p_partkey) AS name",
            "CASE WHEN p_partkey % 3 = 0 THEN p_name END AS comment",
            "CASE WHEN p_partkey % 8 = 0 THEN '(x = 1)' END AS partitions",
            "CASE WHEN p_partkey % 5 = 0 THEN 'ENABLED' ELSE 'Disabled' END AS history_sharing",
        )

    @cached_property
    def fx_kinds(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CASE p_size % 6 WHEN 0 THEN 'VOLUME' WHEN 1 THEN 'FUNCTION' WHEN 2 THEN 'CONNECTION' "
            "WHEN 3 THEN 'RECIPIENT' WHEN 4 THEN 'SHARE' ELSE 'DELTA SHARING SHARE OBJECT' END"
            " AS kind",
            "concat('o_', p_partkey) AS name",
            "p_brand AS share_name",
            "CASE WHEN p_partkey % 2 = 0 THEN 'EXTERNAL' ELSE 'MANAGED' END AS type",
            "CASE WHEN p_partkey % 2 = 0 THEN concat('abfss://c@h/v/', p_partkey) END"
            " AS storage_location",
            "CASE WHEN p_partkey % 3 = 0 THEN p_name END AS comment",
            f"{CONNECTION_OPTIONS} AS options",
            "CASE WHEN p_partkey % 4 = 0 THEN concat('id-', p_partkey) END AS sharing_id",
            "CASE p_partkey % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'SCHEMA' "
            "ELSE 'MATERIALIZED VIEW' END AS shared_type",
            "p_partkey % 5 = 0 AS history",
        )

    def kinds(self, kind: str) -> DataFrame:
        return self.fx_kinds.filter(F.col("kind") == kind)

    @cached_property
    def fx_connections(self) -> DataFrame:
        return self.kinds(model.CONNECTION).selectExpr(
            "name AS connection_name",
            "'MYSQL' AS connection_type",
            "options AS connection_options",
            "comment",
            "concat('owner_', length(name)) AS connection_owner",
        )

    @cached_property
    def fx_connection_grants(self) -> DataFrame:
        return (
            self.kinds(model.CONNECTION)
            .filter("length(coalesce(comment, '')) = 0")
            .selectExpr(
                "name AS connection_name",
                "concat('grp_', length(name) % 3) AS grantee",
                "explode(array('USE CONNECTION', 'CREATE FOREIGN CATALOG')) AS privilege_type",
            )
        )

    @cached_property
    def fx_volumes(self) -> DataFrame:
        return self.kinds(model.VOLUME).selectExpr(
            "'c' AS volume_catalog",
            "lower(replace(share_name, '#', '_')) AS volume_schema",
            "name AS volume_name",
            "type AS volume_type",
            "storage_location",
            "comment",
            "concat('owner_', length(name)) AS volume_owner",
        )

    @cached_property
    def fx_volume_privileges(self) -> DataFrame:
        return self.kinds(model.VOLUME).selectExpr(
            "'c' AS volume_catalog",
            "lower(replace(share_name, '#', '_')) AS volume_schema",
            "name AS volume_name",
            "concat('grp_', length(name) % 3) AS grantee",
            "explode(array('WRITE VOLUME', 'READ VOLUME')) AS privilege_type",
            "CASE WHEN history THEN 'SCHEMA' ELSE 'NONE' END AS inherited_from",
        )

    @cached_property
    def fx_volume_tags(self) -> DataFrame:
        return self.kinds(model.VOLUME).selectExpr(
            "'c' AS catalog_name",
            "lower(replace(share_name, '#', '_')) AS schema_name",
            "name AS volume_name",
            "inline(array(named_struct('tag_name', 'note', 'tag_value', comment), "
            "named_struct('tag_name', 'kind', 'tag_value', type)))",
        )

    @cached_property
    def fx_routines(self) -> DataFrame:
        return self.table("part").selectExpr(
            "'c' AS specific_catalog",
            "'s' AS specific_schema",
            "concat('f_', p_partkey) AS specific_name",
            "concat('owner_', p_size) AS routine_owner",
        )

    @cached_property
    def fx_routine_privileges(self) -> DataFrame:
        return self.table("part").selectExpr(
            "'c' AS specific_catalog",
            "CASE WHEN p_partkey % 10 = 0 THEN 'information_schema' ELSE 's' END AS specific_schema",
            "concat('f_', p_partkey) AS specific_name",
            "concat('grp_', p_size % 3) AS grantee",
            "'EXECUTE' AS privilege_type",
            "CASE WHEN p_partkey % 4 = 0 THEN 'SCHEMA' ELSE 'NONE' END AS inherited_from",
        )

    @cached_property
    def fx_description_rows(self) -> DataFrame:
        return (
            self.table("part")
            .withColumn("ord", F.explode(F.sequence(F.lit(0), F.lit(8))))
            .selectExpr(
                "concat('c.s.f_', p_partkey) AS function_name",
                "ord",
                "CASE ord WHEN 0 THEN concat('Function: c.s.f_', p_partkey) "
                "WHEN 1 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Type: TABLE' ELSE 'Type: SCALAR' END "
                "WHEN 2 THEN 'Input: a INT' WHEN 3 THEN '       b STRING' "
                "WHEN 4 THEN 'Returns: x INT' WHEN 5 THEN '         y STRING' "
                "WHEN 6 THEN 'Deterministic: true' WHEN 7 THEN 'Language: SQL' "
                "ELSE concat('Body: a + ', p_size) END AS function_desc",
            )
        )

    @cached_property
    def fx_models(self) -> DataFrame:
        # Lines of one order and part differ in nothing that is taken, so their order among each other is not either.
        lines = self.table("lineitem").select("l_partkey", "l_orderkey")
        return position_in_group(lines, ["l_partkey"], "l_orderkey").selectExpr(
            "concat('c.s.m_', l_partkey) AS full_name",
            "CAST(position AS STRING) AS version",
            "concat('run_', l_orderkey) AS run_id",
            "CASE WHEN l_orderkey % 2 = 0 THEN concat('about ', l_orderkey) END AS description",
            "concat('s3://models/', l_orderkey) AS source",
            "CASE l_orderkey % 3 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' END AS current_stage",
            "CASE l_orderkey % 5 WHEN 0 THEN 'champion' WHEN 1 THEN 'a,b' END AS alias_list",
            "CASE WHEN l_orderkey % 7 = 0 THEN concat('t', l_orderkey % 10) END AS tag",
        )

    @cached_property
    def fx_model_list(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('c.s.m_', p_partkey) AS full_name",
            "'c' AS catalog_name",
            "'s' AS schema_name",
            "concat('m_', p_partkey) AS name",
            "concat('owner_', p_size) AS owner",
        )

    @cached_property
    def fx_model_grants(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 2 = 0").selectExpr(
            "concat('c.s.m_', p_partkey) AS registered_model_name",
            "concat('grp_', p_size % 3) AS grantee",
            "explode(array('MANAGE', 'EXECUTE')) AS privilege_type",
        )

    # --- catalog payloads ------------------------------------------------------------------

    @cached_property
    def fx_catalog_options(self) -> DataFrame:
        return self.fx_catalogs.selectExpr(
            "catalog_name",
            "CASE WHEN catalog_type = 'FOREIGN' THEN 'database = db1, user=u1' "
            "WHEN catalog_name = 'asia' THEN 'not an option list' END AS options",
        )

    @cached_property
    def fx_catalog_bindings(self) -> DataFrame:
        return self.nations.filter("r_regionkey % 2 = 0").selectExpr(
            f"{CATALOG_NAME} AS catalog_name", "CAST(n_nationkey AS BIGINT) AS workspace_id"
        )

    @cached_property
    def fx_catalog_descriptions(self) -> DataFrame:
        described = self.fx_catalogs.join(self.fx_catalog_options, "catalog_name")
        return described.selectExpr(
            "catalog_name",
            "inline(array(named_struct('info_name', 'Catalog Type', 'info_value', catalog_type), "
            "named_struct('info_name', 'Comment', 'info_value', comment), "
            "named_struct('info_name', 'Options', 'info_value', options), "
            "named_struct('info_name', 'Connection Name', 'info_value', "
            "CASE WHEN catalog_type = 'FOREIGN' THEN concat('conn_', catalog_name) END), "
            "named_struct('info_name', 'Storage Root', 'info_value', "
            "concat('abfss://Root@Host/', upper(catalog_name)))))",
        )

    @cached_property
    def fx_catalog_shares(self) -> DataFrame:
        return self.fx_catalogs.filter("catalog_type = 'DELTA SHARING'").selectExpr(
            "catalog_name", "'prov' AS provider_name", "concat('share_', catalog_name) AS share_name"
        )

    # --- inventory, snapshots, logs ------------------------------------------------------------

    @cached_property
    def fx_inventory(self) -> DataFrame:
        full = "concat(table_catalog, '.', table_schema, '.', table_name)"
        kind = "IF(table_type = 'VIEW', 'VIEW', 'TABLE')"
        nothing = "CAST(NULL AS STRING)"
        object_row = inventory_struct(
            full, kind, "concat(table_catalog, '.', table_schema)", "'SCHEMA'", "table_name",
            "table_id",
            "CASE WHEN table_id % 19 <> 0 THEN concat('CREATE TABLE `', table_name, '`', "
            "CASE WHEN table_type = 'EXTERNAL' THEN "
            "concat(' LOCATION \\'abfss://c@h/', table_name, '\\'') ELSE '' END) END",
            nothing, "last_altered",
        )
        owner_row = inventory_struct(
            full, "'OWNER'", full, kind, "table_owner", "1000000 + table_id",
            "concat('ALTER TABLE `', table_name, '` SET OWNER TO `', table_owner, '`')",
            nothing, "last_altered",
        )
        tag_row = inventory_struct(
            full, "'TAG'", full, "'TABLE'", "'k'", "2000000 + table_id",
            "concat('ALTER TABLE `', table_name, '` SET TAGS (\\'k\\' = \\'v\\')')",
            nothing, "last_altered",
        )
        grant_row = inventory_struct(
            full, "'PRIVILEGE'", full, "'TABLE'", "'grp_0'", "3000000 + table_id",
            "concat('GRANT SELECT ON TABLE `', table_name, '` TO `grp_0`')",
            nothing, "last_altered",
        )
        tables = self.fx_tables.selectExpr(
            f"inline(filter(array({object_row}, {owner_row}, "
            f"IF(table_id % 3 = 0, {tag_row}, NULL), IF(table_id % 2 = 0, {grant_row}, NULL)), "
            "x -> x IS NOT NULL))"
        )
        catalogs = self.fx_catalogs.filter("catalog_name <> 'system'").selectExpr(
            *inventory_columns(
                "catalog_name", "'CATALOG'", "'ms'", "'METASTORE'", "catalog_name",
                "CAST(-1000 - length(catalog_name) * 10 - ascii(catalog_name) % 10 AS BIGINT)",
                "concat('CREATE CATALOG `', catalog_name, '`', CASE catalog_type "
                "WHEN 'DELTA SHARING' THEN ' USING SHARE `p`.`s`' ELSE '' END)",
                nothing, "last_altered",
            )
        )
        schemas = self.nations.selectExpr(
            *inventory_columns(
                f"concat({CATALOG_NAME}, '.', lower(n_name))", "'SCHEMA'", CATALOG_NAME,
                "'CATALOG'", "lower(n_name)", "CAST(-100 - n_nationkey AS BIGINT)",
                "concat('CREATE SCHEMA `', lower(n_name), '`')", nothing, CREATED,
            )
        )
        brand_number = "CAST(substr(p_brand, 7) AS BIGINT)"
        share_row = inventory_struct(
            "p_brand", "'SHARE'", "'ms'", "'METASTORE'", "p_brand", f"-2000 - {brand_number}",
            "concat('CREATE SHARE `', p_brand, '`')", nothing, CREATED,
        )
        content_row = inventory_struct(
            "p_brand", "'DELTA SHARING SHARE OBJECT'", "p_brand", "'SHARE'", "'c.s.t'",
            f"-3000 - {brand_number}", "concat('ALTER SHARE `', p_brand, '` ADD TABLE c.s.t')",
            nothing, CREATED,
        )
        shares = (
            self.table("part")
            .select("p_brand")
            .distinct()
            .selectExpr(f"inline(array({share_row}, {content_row}))")
        )
        location_row = inventory_columns(
            "external_location_name", "'EXTERNAL LOCATION'", "storage_credential_name",
            "'STORAGE CREDENTIAL'", "external_location_name",
            "-100000 - CAST(substr(external_location_name, 5) AS BIGINT)",
            "concat('CREATE EXTERNAL LOCATION `', external_location_name, '`')",
            "CASE WHEN read_only THEN '{\"read_only\":true}' END", CREATED,
        )
        credential_row = inventory_columns(
            "storage_credential_name", "'STORAGE CREDENTIAL'", "'ms'", "'METASTORE'",
            "storage_credential_name", "-500 - CAST(substr(storage_credential_name, 6) AS BIGINT)",
            nothing, "'{\"name\":\"x\"}'", CREATED,
        )
        locations = self.fx_external_locations.selectExpr(*location_row)
        credentials = (
            self.fx_external_locations.select("storage_credential_name")
            .distinct()
            .selectExpr(*credential_row)
        )
        return reduce(
            DataFrame.unionByName, [catalogs, schemas, tables, shares, locations, credentials]
        )

    @cached_property
    def fx_past(self) -> DataFrame:
        return self.fx_inventory.filter(f"created_tsp <= {PAST_UNTIL}")

    @cached_property
    def fx_history(self) -> DataFrame:
        years = self.table("orders").select(F.year("o_orderdate").alias("y")).distinct()
        return years.selectExpr(
            "y - 1995 AS version", "make_timestamp_ntz(y, 12, 31, 0, 0, 0.0) AS timestamp"
        )

    @cached_property
    def fx_snapshots(self) -> DataFrame:
        """Every order in each version from the first one committed after it.

        Versions are the years that have orders, so the versions an order is in are generated
        from its date and then matched to the committed ones by number. Those are a few numbers and are
        sent to the rows: dealt out by version, all rows of one version would be one task's.
        """
        first = (
            "year(o_orderdate) - 1995 + "
            "IF(o_orderdate > make_timestamp_ntz(year(o_orderdate), 12, 31, 0, 0, 0.0), 1, 0)"
        )
        newest = self.fx_history.agg(F.max("version"))
        in_versions = self.table("orders").withColumns(
            {"_first": F.expr(first), "_newest": newest.scalar()}
        )
        spread = in_versions.filter("_first <= _newest").withColumn(
            "version", F.explode(F.sequence("_first", "_newest"))
        )
        return (
            spread.join(F.broadcast(self.fx_history.select("version")), "version", "left_semi")
            .filter("o_orderkey % 11 <> version")
            .selectExpr(
                "version",
                "concat('Obj.', o_orderkey) AS object_name",
                "CASE o_orderstatus WHEN 'F' THEN 'TABLE' WHEN 'O' THEN 'VIEW' ELSE 'VOLUME' END"
                " AS object_type",
                "concat('s_', o_custkey % 25) AS object_parent_name",
                "'SCHEMA' AS object_parent_type",
                "concat('Obj.', o_orderkey) AS object_cross_relationship",
                "o_orderkey AS object_uid",
                "concat('ddl ', o_orderpriority, CASE WHEN o_orderkey % 10 = version "
                "THEN ' changed' ELSE '' END) AS restore_ddl",
                "CAST(NULL AS STRING) AS api_payload",
                "o_orderdate AS created_tsp",
            )
        )

    @cached_property
    def fx_checkpoint(self) -> DataFrame:
        return self.table("events").selectExpr(
            "CAST(event_id % 3 + 1 AS BIGINT) AS jobid",
            "user_id AS rowid",
            "CASE event_type WHEN 'error' THEN 'Failed' ELSE 'Succeeded' END AS status",
            "CASE event_type WHEN 'error' THEN concat('failed, \"', props, '\"') END"
            " AS error_message",
            "ts AS record_timestamp",
        )

    @cached_property
    def fx_failures(self) -> DataFrame:
        return failures_of(self.fx_inventory)

    @cached_property
    def fx_jobs(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS jobid",
            "concat('job_', user_id) AS jobtype",
            "CASE event_type WHEN 'error' THEN 'Failed' WHEN 'purchase' THEN 'Succeeded' "
            "WHEN 'click' THEN 'Completed' ELSE 'Running' END AS jobstatus",
            "ts AS jobstart",
            "CASE WHEN event_type IN ('error', 'purchase', 'click') THEN ts + INTERVAL '1' HOUR END"
            " AS jobend",
            "CAST(event_id % 7 AS INT) AS backupversion",
        )

    @cached_property
    def fx_job_types(self) -> DataFrame:
        seen = self.table("events").selectExpr("concat('job_', user_id) AS jobtype").distinct()
        return seen.unionByName(
            self.table("nation").selectExpr("concat('job_of_', lower(n_name)) AS jobtype")
        )

    @cached_property
    def fx_audit(self) -> DataFrame:
        return self.table("events").selectExpr(
            "ts AS event_time",
            "CASE event_type WHEN 'signup' THEN 'createCatalog' WHEN 'error' THEN 'deleteCatalog' "
            "WHEN 'view' THEN 'getCatalog' WHEN 'click' THEN 'updateCatalog' ELSE 'listCatalog' END"
            " AS action_name",
            "CASE event_type WHEN 'signup' THEN concat('cat_', user_id) END AS param_name",
            "CASE WHEN event_type <> 'signup' THEN concat('cat_', user_id) END AS param_name_arg",
        )

    @cached_property
    def fx_visible_catalogs(self) -> DataFrame:
        return (
            self.table("events")
            .filter("user_id % 3 = 0")
            .selectExpr("concat('cat_', user_id) AS catalog_name")
            .distinct()
        )
