"""What is backed up: one declaration per kind of catalog object.

A declaration names its source table, the rows it keeps and how its inventory columns are
made. ``catkeep.plans.backup`` turns all of them into inventory rows the same way. Sources
are a mapping of DataFrames by name; ``needs`` names the further sources a kind cannot do without.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep import model
from catkeep.functions import render, text
from catkeep.operators import rollup, sections

Sources = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Reserved:
    """Columns holding the namespace, and which reserved names are left out."""

    catalog: str
    schema: str | None = None
    table_like: bool = True

    def keep(self, left_out: Sequence[str] = ()) -> Column:
        """Rows outside the reserved names and the catalogs ``left_out``; null namespaces go as well."""
        catalogs = model.RESERVED_CATALOGS_TABLE_LIKE if self.table_like else model.RESERVED_CATALOGS
        schemas = model.RESERVED_SCHEMAS_TABLE_LIKE if self.table_like else model.RESERVED_SCHEMAS
        kept = ~F.col(self.catalog).isin([*catalogs, *left_out])
        if self.schema is not None:
            kept = kept & ~F.col(self.schema).isin(schemas)
        return kept


@dataclass(frozen=True)
class ObjectSpec:
    """Objects that stand on their own. ``parent`` None is the metastore.

    ``split`` names the sources, each with the column that holds the object, by which the objects can be
    made in parts, where a source has far more rows than there are objects.
    """

    key: str
    object_type: str
    source: str
    name: tuple[str, ...]
    owner: str | None
    parent: tuple[str, ...] | None
    parent_type: str
    statement: Callable[[], Column] = text.none
    payload: Callable[[], Column] = text.none
    relationship: Callable[[], Column] = lambda: F.col("object_name")
    reserved: Reserved | None = None
    kinds: tuple[str, list[str]] | None = None
    shape: Callable[[DataFrame, Sources], DataFrame] = lambda df, _sources: df
    owner_rows: str | None = "statement"
    needs: tuple[str, ...] = ()
    split: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class GrantSpec:
    """Direct grants, rolled up per grantee.

    ``existing`` lists the objects whose grants are kept as (object_name, object_parent_type);
    where it is given the kind comes from there, so one pass serves several kinds.
    """

    key: str
    source: str
    name: tuple[str, ...]
    parent_type: str | None
    keyword: str | None = None
    reserved: Reserved | None = None
    inherited: bool = True
    existing: Callable[[Sources], DataFrame] | None = None
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class TagSpec:
    """Tags of objects; ``existing`` as for grants."""

    key: str
    source: str
    name: tuple[str, ...]
    parent_type: str | None
    reserved: Reserved | None = None
    existing: Callable[[Sources], DataFrame] | None = None
    needs: tuple[str, ...] = ()


TABLE_NAME = ("table_catalog", "table_schema", "table_name")


def _named(df: DataFrame, kind: str) -> DataFrame:
    return df.select(
        text.qualified(*TABLE_NAME).alias("object_name"), F.lit(kind).alias("object_parent_type")
    )


def tables_and_views(sources: Sources) -> DataFrame:
    """Stored tables and views that are not materialised, with their kind."""
    stored = sources["tables"].filter(F.col("table_type").isin(model.STORED_TABLE_KINDS))
    plain = sources["views"].filter(~F.col("is_materialized"))
    return _named(stored, model.TABLE).unionByName(_named(plain, model.VIEW))


def listed_connections(sources: Sources) -> DataFrame:
    return sources["connections"].select(
        F.col("connection_name").alias("object_name"),
        F.lit(model.CONNECTION).alias("object_parent_type"),
    )


# --- fixed values: columns of a shown-grants listing and what they are called here ---
SHOWN_GRANT_COLUMNS = {"Principal": "grantee", "ActionType": "privilege_type"}


def shown_grants(listing: DataFrame, object_type: str, name: str) -> DataFrame:
    """(name, grantee, privilege_type) from the rows of grant listings on one kind of object."""
    renamed = {"ObjectKey": name, **SHOWN_GRANT_COLUMNS}
    kept = listing.filter(F.col("ObjectType") == object_type)
    return kept.withColumnsRenamed(renamed).select(*renamed.values())


def _ensure(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns a source does not have as nulls."""
    missing = {name: text.none(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing)


def _optional(
    df: DataFrame, sources: Sources, name: str, key: str, columns: dict[str, str]
) -> DataFrame:
    """Take columns from a payload table by ``key`` where that table is given."""
    if name in sources:
        return df.drop(*columns).join(sources[name].select(key, *columns), key, "left")
    return _ensure(df, columns)


def _shape_catalogs(df: DataFrame, sources: Sources) -> DataFrame:
    fields = ["catalog_type", "comment", "options", "storage_root", "connection_name"]
    described = rollup.description_columns(sources["catalog_descriptions"], "catalog_name", fields)
    df = df.select("catalog_name", "catalog_owner", "object_name").join(described, "catalog_name", "left")
    df = _optional(
        df, sources, "catalog_shares", "catalog_name",
        {"provider_name": "string", "share_name": "string"},
    )
    if "catalog_bindings" in sources:
        return df.join(rollup.bindings(sources["catalog_bindings"]), "catalog_name", "left")
    return df.withColumn("api_payload", text.none())


def _catalog_statement() -> Column:
    return render.catalog(
        F.col("catalog_name"), F.col("catalog_type"), F.col("comment"),
        text.parsed_options(F.col("options")), F.col("options"), F.col("storage_root"),
        F.col("connection_name"), F.col("provider_name"), F.col("share_name"),
    )


def _shape_schemas(df: DataFrame, sources: Sources) -> DataFrame:
    details = {"comment": "string", "storage_root": "string", "properties": "map<string,string>"}
    return _optional(df, sources, "schema_details", "object_name", details)


def _schema_statement() -> Column:
    return render.schema(
        F.col("object_name"), F.col("comment"), F.col("storage_root"),
        text.keyed(F.col("properties")),
    )


TABLE_DETAILS = {
    "columns_ddl": "string",
    "partition_columns": "string",
    "cluster_columns": "array<string>",
    "properties": "map<string,string>",
    "constraints": (
        "array<struct<name:string,kind:string,child_columns:array<string>,"
        "parent_table:string,parent_columns:array<string>>>"
    ),
    "row_filter": "struct<name:string,input_columns:array<string>>",
}


TABLE_STORAGE = {
    "data_source_format": "string",
    "storage_location": "string",
    "storage_credential_name": "string",
}


def _shape_tables(df: DataFrame, sources: Sources) -> DataFrame:
    df = _ensure(df, TABLE_STORAGE)
    return _optional(df, sources, "table_details", "object_name", TABLE_DETAILS)


def _table_statement() -> Column:
    columns = F.when(
        text.given(F.col("columns_ddl")),
        F.concat_ws(",\n", "columns_ddl", render.constraints(F.col("constraints"))),
    )
    return render.table(
        F.col("object_name"), F.col("table_type"), columns, F.col("data_source_format"),
        F.col("storage_location"), F.col("storage_credential_name"), F.col("partition_columns"),
        render.cluster_columns(F.col("cluster_columns")), F.col("comment"),
        text.keyed(render.restorable_properties(F.col("properties"))),
        render.row_filter(F.col("row_filter.name"), F.col("row_filter.input_columns")),
    )


def _shape_views(df: DataFrame, sources: Sources) -> DataFrame:
    materialised = sources["views"].filter("is_materialized").select(*TABLE_NAME)
    plain = df.join(materialised, list(TABLE_NAME), "left_anti")
    return _optional(plain, sources, "view_texts", "object_name", {"create_text": "string"})


def _shape_functions(df: DataFrame, sources: Sources) -> DataFrame:
    statements = sections.function_statements(sources["function_descriptions"])
    # One text per function, made of lines whose size is not foreseen: merged, never broadcast.
    named = statements.withColumnRenamed("function_name", "object_name").hint("merge")
    return df.join(named, "object_name", "left")


def _shape_recipients(df: DataFrame, sources: Sources) -> DataFrame:
    payloads = rollup.address_payloads(sources["recipient_allowed_ip_ranges"])
    return df.join(payloads, "recipient_name", "left")


def _recipient_statement() -> Column:
    return render.recipient(
        F.col("recipient_name"), F.col("data_recipient_global_metastore_id"), F.col("comment")
    )


def _shape_share_objects(df: DataFrame, sources: Sources) -> DataFrame:
    content = sources["share_contents"].select(
        "share_name", "type", "shared_object", "name", "partitions", "history_sharing",
        F.col("comment").alias("_comment"),
    )
    return df.join(content, "share_name")


def _share_object_statement() -> Column:
    return render.share_object(
        F.col("share_name"), F.col("type"), F.col("shared_object"), F.col("_comment"),
        F.col("partitions"), F.col("name"), F.lower("history_sharing") != "disabled",
    )


MODEL_FIELDS = ["catalog_name", "schema_name", "name", "comment", "storage_location"]
MODEL_VERSION_FIELDS = [
    "name", "aliases", "description", "tags", "current_stage", "source", "run_id", "version",
]


def _shape_models(df: DataFrame, sources: Sources) -> DataFrame:
    df = _ensure(df, dict.fromkeys(MODEL_FIELDS, "string"))
    versions = sources["model_versions"].withColumn("name", F.col("full_name"))
    present = [name for name in MODEL_VERSION_FIELDS if name in versions.columns]
    return df.join(rollup.model_payloads(versions, present), "full_name", "left")


def _model_payload() -> Column:
    """The model's own fields and its version list as one JSON object."""
    own = F.to_json(F.struct(*MODEL_FIELDS))
    versions = F.coalesce("versions_json", F.lit("[]"))
    return F.concat(
        F.lit('{"registered_model":'), own, F.lit(',"versions":'), versions, F.lit("}")
    )


OBJECTS = [
    ObjectSpec(
        "catalogs", model.CATALOG, "catalogs", ("catalog_name",), "catalog_owner",
        None, model.METASTORE,
        statement=_catalog_statement, payload=lambda: F.col("api_payload"),
        reserved=Reserved("catalog_name", table_like=False), shape=_shape_catalogs, needs=("catalog_descriptions",),
    ),
    ObjectSpec(
        "schemas", model.SCHEMA, "schemata", ("catalog_name", "schema_name"), "schema_owner",
        ("catalog_name",), model.CATALOG,
        statement=_schema_statement,
        reserved=Reserved("catalog_name", "schema_name", table_like=False), shape=_shape_schemas,
    ),
    ObjectSpec(
        "tables", model.TABLE, "tables", TABLE_NAME, "table_owner",
        TABLE_NAME[:2], model.SCHEMA,
        statement=_table_statement, reserved=Reserved("table_catalog", "table_schema"),
        kinds=("table_type", model.STORED_TABLE_KINDS), shape=_shape_tables,
    ),
    ObjectSpec(
        "views", model.VIEW, "tables", TABLE_NAME, "table_owner",
        TABLE_NAME[:2], model.SCHEMA,
        statement=lambda: text.view_statement(F.col("create_text"), F.col("object_name")),
        reserved=Reserved("table_catalog", "table_schema"),
        kinds=("table_type", [model.VIEW_KIND]), shape=_shape_views, needs=("views",),
    ),
    ObjectSpec(
        "volumes", model.VOLUME, "volumes", ("volume_catalog", "volume_schema", "volume_name"),
        "volume_owner", ("volume_catalog", "volume_schema"), model.SCHEMA,
        statement=lambda: render.volume(
            F.col("object_name"), F.col("volume_type"), F.col("storage_location"), F.col("comment")
        ),
        kinds=("volume_type", model.STORED_TABLE_KINDS),
    ),
    ObjectSpec(
        "functions", model.FUNCTION, "routines",
        ("specific_catalog", "specific_schema", "specific_name"), "routine_owner",
        ("specific_catalog", "specific_schema"), model.SCHEMA,
        statement=lambda: F.col("restore_ddl"),
        reserved=Reserved("specific_catalog", "specific_schema"), shape=_shape_functions,
        needs=("function_descriptions",),
    ),
    ObjectSpec(
        "external_locations", model.EXTERNAL_LOCATION, "external_locations",
        ("external_location_name",), "external_location_owner",
        ("storage_credential_name",), model.STORAGE_CREDENTIAL,
        statement=lambda: render.external_location(
            F.col("external_location_name"), F.col("url"), F.col("storage_credential_name"),
            F.col("comment"),
        ),
        payload=lambda: text.read_only_payload(F.col("read_only")),
    ),
    ObjectSpec(
        "recipients", model.RECIPIENT, "recipients", ("recipient_name",), "recipient_owner",
        None, model.METASTORE,
        statement=_recipient_statement, payload=lambda: F.col("api_payload"),
        shape=_shape_recipients, needs=("recipient_allowed_ip_ranges",),
    ),
    ObjectSpec(
        "shares", model.SHARE, "shares", ("share_name",), "share_owner", None, model.METASTORE,
        statement=lambda: render.share(F.col("share_name"), F.col("comment")),
    ),
    ObjectSpec(
        "share_objects", model.SHARE_OBJECT, "shares", ("share_name",), None,
        ("share_name",), model.SHARE,
        statement=_share_object_statement,
        relationship=lambda: F.when(F.col("restore_ddl").isNotNull(), text.quoted(F.col("shared_object"))),
        shape=_shape_share_objects, owner_rows=None, needs=("share_contents",),
    ),
    ObjectSpec(
        "connections", model.CONNECTION, "connections", ("connection_name",), "connection_owner",
        None, model.METASTORE,
        statement=lambda: render.connection(
            F.col("connection_name"), F.col("connection_type"),
            text.literal_options(F.col("connection_options")), F.col("comment"), F.col("connection_options"),
        ),
    ),
    ObjectSpec(
        "registered_models", model.REGISTERED_MODEL, "models", ("full_name",), "owner",
        ("catalog_name", "schema_name"), model.SCHEMA,
        payload=_model_payload, shape=_shape_models, owner_rows="payload",
        needs=("model_versions",), split=(("models", "full_name"), ("model_versions", "full_name")),
    ),
    ObjectSpec(
        "storage_credentials", model.STORAGE_CREDENTIAL, "storage_credentials",
        ("storage_credential_name",), "storage_credential_owner", None, model.METASTORE,
        payload=lambda: F.col("payload"),
    ),
]

GRANTS = [
    GrantSpec("catalog_privileges", "catalog_privileges", ("catalog_name",), model.CATALOG),
    GrantSpec(
        "schema_privileges", "schema_privileges", ("catalog_name", "schema_name"), model.SCHEMA
    ),
    GrantSpec(
        "table_view_privileges", "table_privileges", TABLE_NAME, None,
        reserved=Reserved("table_catalog", "table_schema"), existing=tables_and_views,
        needs=("tables", "views"),
    ),
    GrantSpec(
        "volume_privileges", "volume_privileges",
        ("volume_catalog", "volume_schema", "volume_name"), model.VOLUME,
    ),
    GrantSpec(
        "function_privileges", "routine_privileges",
        ("specific_catalog", "specific_schema", "specific_name"), model.FUNCTION,
        reserved=Reserved("specific_catalog", "specific_schema"),
    ),
    GrantSpec(
        "external_location_privileges", "external_location_privileges",
        ("external_location_name",), model.EXTERNAL_LOCATION,
    ),
    GrantSpec(
        "connection_privileges", "connection_grants", ("connection_name",), None,
        inherited=False, existing=listed_connections, needs=("connections",),
    ),
    GrantSpec(
        "model_privileges", "model_grants", ("registered_model_name",), model.REGISTERED_MODEL,
        keyword=model.FUNCTION, inherited=False,
    ),
    GrantSpec(
        "storage_credential_privileges", "storage_credential_privileges",
        ("storage_credential_name",), model.STORAGE_CREDENTIAL,
    ),
]

TAGS = [
    TagSpec("catalog_tags", "catalog_tags", ("catalog_name",), model.CATALOG),
    TagSpec("schema_tags", "schema_tags", ("catalog_name", "schema_name"), model.SCHEMA),
    TagSpec(
        "table_view_tags", "table_tags", ("catalog_name", "schema_name", "table_name"), None,
        reserved=Reserved("catalog_name", "schema_name"), existing=tables_and_views,
        needs=("tables", "views"),
    ),
    TagSpec(
        "volume_tags", "volume_tags", ("catalog_name", "schema_name", "volume_name"), model.VOLUME,
        reserved=Reserved("catalog_name", "schema_name"),
    ),
]

BY_KEY = {spec.key: spec for spec in [*OBJECTS, *GRANTS, *TAGS]}
