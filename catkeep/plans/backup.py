"""Backup: source tables to inventory rows, in full or building on the last snapshot."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep import model
from catkeep.functions import render, text
from catkeep.operators import rollup
from catkeep.operators.checks import restorable
from catkeep.session import shared_folder
from catkeep.sources.entities import (
    BY_KEY,
    GRANTS,
    OBJECTS,
    TAGS,
    GrantSpec,
    ObjectSpec,
    Sources,
    TagSpec,
)

SHARE_GRANTS = "share_recipient_privileges"
#: Parts in which a declaration that is split is made, when its rows are kept.
PIECES = 4

#: Stores inventory rows and returns them read back; ``SnapshotStore.stage`` is one.
Keep = Callable[[DataFrame], DataFrame]


def changed_since(df: DataFrame, watermark: Column) -> DataFrame:
    """Rows altered after the watermark; sources without the column are read whole."""
    if "last_altered" not in df.columns:
        return df
    return df.filter(F.col("last_altered").cast("timestamp_ntz") > watermark)


def epoch() -> Column:
    return F.lit(model.EPOCH).cast("timestamp_ntz")


def watermark(inventory: DataFrame, object_type: str = model.TABLE) -> DataFrame:
    """One row: the newest run time of a type's rows, or the earliest time without any."""
    return inventory.filter(F.col("object_type") == object_type).agg(
        F.coalesce(F.max(F.col("created_tsp").cast("timestamp_ntz")), epoch()).alias("watermark")
    )


def kept_rows(
    spec: ObjectSpec | GrantSpec | TagSpec, sources: Sources, left_out: Sequence[str] = ()
) -> DataFrame:
    """Source rows of a declaration that pass its filters, with ``object_name``."""
    df = sources[spec.source]
    if spec.reserved is not None:
        df = df.filter(spec.reserved.keep(left_out))
    if isinstance(spec, ObjectSpec) and spec.kinds is not None:
        column, values = spec.kinds
        df = df.filter(F.col(column).isin(values))
    if isinstance(spec, GrantSpec) and spec.inherited:
        df = df.filter(F.col("inherited_from") == "NONE")
    return df.withColumn("object_name", text.qualified(*spec.name))


def object_rows(spec: ObjectSpec, kept: DataFrame, sources: Sources, metastore: str) -> DataFrame:
    """Inventory columns of objects, with their owner still alongside."""
    shaped = spec.shape(kept, sources)
    parent = F.lit(metastore) if spec.parent is None else text.qualified(*spec.parent)
    return shaped.withColumn("restore_ddl", spec.statement().cast("string")).select(
        "object_name",
        (F.col(spec.owner) if spec.owner else text.none()).alias("object_owner"),
        F.lit(spec.object_type).alias("object_type"),
        parent.alias("object_parent_name"),
        F.lit(spec.parent_type).alias("object_parent_type"),
        "restore_ddl",
        spec.payload().cast("string").alias("api_payload"),
        spec.relationship().alias("object_cross_relationship"),
    )


def with_owner_rows(df: DataFrame, owner_rows: str | None) -> DataFrame:
    """Each object row and, beside it, the row that gives it its owner; one pass over ``df``."""
    own = F.struct(*model.IDENTITY_COLUMNS)
    if owner_rows is None:
        return df.select(*model.IDENTITY_COLUMNS)
    name, owner = F.col("object_name"), F.col("object_owner")
    as_payload = owner_rows == "payload"
    statement = text.none() if as_payload else render.set_owner(F.col("object_type"), name, owner)
    payload = render.owner_payload(name, owner) if as_payload else text.none()
    ownership = F.struct(
        name.alias("object_name"),
        F.lit(model.OWNER).alias("object_type"),
        name.alias("object_parent_name"),
        F.col("object_type").alias("object_parent_type"),
        owner.alias("object_cross_relationship"),
        statement.alias("restore_ddl"),
        payload.alias("api_payload"),
    )
    return df.select(F.inline(F.array(own, ownership)))


def of_existing(rolled: DataFrame, spec: GrantSpec | TagSpec, sources: Sources) -> DataFrame:
    """Keep roll-ups of existing objects and add their kind.

    This comes after the roll-up: the join sees one row per object and grantee, and an object
    with very many of them is split by the skew join because nothing groups by it afterwards.
    """
    if spec.existing is not None:
        return rolled.join(spec.existing(sources).distinct(), "object_name")
    return rolled.withColumn("object_parent_type", F.lit(spec.parent_type))


def grant_rows(spec: GrantSpec, sources: Sources, left_out: Sequence[str] = ()) -> DataFrame:
    rolled = of_existing(rollup.grants_per_grantee(kept_rows(spec, sources, left_out)), spec, sources)
    keyword = F.lit(spec.keyword) if spec.keyword else F.col("object_parent_type")
    return rolled.select(
        "object_name",
        F.lit(model.PRIVILEGE).alias("object_type"),
        F.col("object_name").alias("object_parent_name"),
        "object_parent_type",
        F.col("grantee").alias("object_cross_relationship"),
        render.grant(
            F.col("privileges"), keyword, F.col("object_name"), F.col("grantee")
        ).alias("restore_ddl"),
        text.none().alias("api_payload"),
    )


def share_grant_rows(sources: Sources) -> DataFrame:
    return rollup.share_grant_statements(sources[SHARE_GRANTS]).select(
        F.col("share_name").alias("object_name"),
        F.lit(model.PRIVILEGE).alias("object_type"),
        F.col("share_name").alias("object_parent_name"),
        F.lit(model.SHARE).alias("object_parent_type"),
        text.none().alias("object_cross_relationship"),
        "restore_ddl",
        text.none().alias("api_payload"),
    )


def tag_rows(spec: TagSpec, sources: Sources, left_out: Sequence[str] = ()) -> DataFrame:
    rolled = of_existing(rollup.tags_per_object(kept_rows(spec, sources, left_out)), spec, sources)
    return rolled.select(
        "object_name",
        F.lit(model.TAG).alias("object_type"),
        F.col("object_name").alias("object_parent_name"),
        "object_parent_type",
        F.col("tags").alias("object_cross_relationship"),
        render.set_tags(F.col("object_parent_type"), F.col("object_name"), F.col("tags")).alias(
            "restore_ddl"
        ),
        text.none().alias("api_payload"),
    )


def identified(df: DataFrame, run_at: Column) -> DataFrame:
    """Add the surrogate id and the run time.

    The hash skips nulls, so a null is replaced by a character no name holds: otherwise
    (a, null) and (null, a) would get the same id.
    """
    parts = [F.coalesce(name, F.lit("\u0000")) for name in model.IDENTITY_COLUMNS]
    return df.select(
        *model.IDENTITY_COLUMNS, F.xxhash64(*parts).alias("object_uid"), run_at.alias("created_tsp")
    ).select(*model.INVENTORY_COLUMNS)


def entity_rows(
    key: str, sources: Sources, metastore: str, left_out: Sequence[str] = ()
) -> DataFrame:
    """All rows of one declaration, before ids."""
    if key == SHARE_GRANTS:
        return share_grant_rows(sources)
    spec = BY_KEY[key]
    if isinstance(spec, GrantSpec):
        return grant_rows(spec, sources, left_out)
    if isinstance(spec, TagSpec):
        return tag_rows(spec, sources, left_out)
    kept = kept_rows(spec, sources, left_out)
    if key != "tables":
        # A table without a time of change is one that was never backed up, so it is due.
        kept = changed_since(kept, epoch())
    return with_owner_rows(object_rows(spec, kept, sources, metastore), spec.owner_rows)


def entity(
    key: str, sources: Sources, run_at: Column, metastore: str, left_out: Sequence[str] = ()
) -> DataFrame:
    return identified(entity_rows(key, sources, metastore, left_out), run_at)


def available(sources: Sources) -> list[str]:
    """Keys of the declarations all of whose sources are supplied."""
    keys = [
        spec.key
        for spec in [*OBJECTS, *GRANTS, *TAGS]
        if all(name in sources for name in (spec.source, *spec.needs))
    ]
    return keys + ([SHARE_GRANTS] if SHARE_GRANTS in sources else [])


def pieces(key: str, sources: Sources) -> Iterator[Sources]:
    """The sources of a declaration, or one after the other those of parts of its objects."""
    split = getattr(BY_KEY.get(key), "split", ())
    for piece in range(PIECES if split else 1):
        yield ChainMap(
            {n: sources[n].filter(F.pmod(F.xxhash64(column), F.lit(PIECES)) == piece) for n, column in split}, sources
        )


def declared_rows(
    keys: Sequence[str], sources: Sources, run_at: Column, metastore: str, left_out: Sequence[str], keep: Keep | None
) -> DataFrame | None:
    """Restorable rows of several declarations; with ``keep`` stored one declaration after the other."""
    if not keys:
        return None
    if keep is None:
        parts = [entity_rows(key, sources, metastore, left_out) for key in keys]
        return identified(reduce(DataFrame.unionByName, parts), run_at).filter(restorable())
    kept = [
        keep(entity(key, some, run_at, metastore, left_out).filter(restorable()))
        for key in keys
        for some in pieces(key, sources)
    ]
    return reduce(DataFrame.unionByName, kept)


def full_backup(
    sources: Sources, run_at: Column, metastore: str, left_out: Sequence[str] = (), keep: Keep | None = None
) -> DataFrame:
    """Every supplied source as one inventory; rows that cannot be re-created are left out.

    ``left_out`` names further catalogs that are not backed up, such as the platform's own. With ``keep``
    each declaration is run and stored by itself, so that the shuffle files of all are never there at once.
    """
    return declared_rows(available(sources), sources, run_at, metastore, left_out, keep)


def classified_tables(sources: Sources, past: DataFrame, left_out: Sequence[str] = ()) -> DataFrame:
    """Current tables with ``refresh``: altered since the last run, or never backed up whole.

    A table without a time of change is refreshed only in the second case.
    """
    spec = BY_KEY["tables"]
    backed_up = (
        past.filter((F.col("object_type") == model.TABLE) & F.col("restore_ddl").isNotNull())
        .select("object_name", F.lit(True).alias("_backed_up"))
        .distinct()
    )
    altered = F.col("last_altered").cast("timestamp_ntz")
    since = watermark(past).scalar()
    return (
        kept_rows(spec, sources, left_out)
        .join(backed_up, "object_name", "left")
        .withColumn(
            "refresh",
            F.coalesce(altered > since, F.lit(False)) | F.col("_backed_up").isNull(),
        )
        .drop("_backed_up")
    )


def tables_to_refresh(sources: Sources, past: DataFrame) -> DataFrame:
    return classified_tables(sources, past).filter("refresh").select("object_name")


def carried_forward(past: DataFrame, classified: DataFrame) -> DataFrame:
    """Past table and table-owner rows of tables that still exist unchanged."""
    of_tables = (F.col("object_type") == model.TABLE) | (
        (F.col("object_type") == model.OWNER) & (F.col("object_parent_type") == model.TABLE)
    )
    unchanged = classified.filter("NOT refresh").select("object_name")
    return (
        past.filter(of_tables & restorable())
        .join(unchanged, "object_name", "left_semi")
        .select(*model.INVENTORY_COLUMNS)
    )


def refreshed_tables(
    classified: DataFrame, sources: Sources, run_at: Column, metastore: str
) -> DataFrame:
    spec = BY_KEY["tables"]
    due = classified.filter("refresh").drop("refresh")
    rows = object_rows(spec, due, sources, metastore)
    return identified(with_owner_rows(rows, spec.owner_rows), run_at)


def incremental_tables(
    sources: Sources, past: DataFrame, run_at: Column, metastore: str, left_out: Sequence[str] = ()
) -> DataFrame:
    """Table rows of the next snapshot: refreshed ones and those carried over.

    Tables are classified once; the list is checkpointed because both halves read it.
    """
    shared_folder(past.sparkSession)
    classified = classified_tables(sources, past, left_out).checkpoint()
    fresh = refreshed_tables(classified, sources, run_at, metastore)
    return fresh.unionByName(carried_forward(past, classified))


def incremental_backup(
    sources: Sources,
    past: DataFrame,
    run_at: Column,
    metastore: str,
    left_out: Sequence[str] = (),
    keep: Keep | None = None,
) -> DataFrame:
    """Like ``full_backup``, but tables are only rendered again when they have to be."""
    others = [key for key in available(sources) if key != "tables"]
    rows = declared_rows(others, sources, run_at, metastore, left_out, keep)
    tables = incremental_tables(sources, past, run_at, metastore, left_out).filter(restorable())
    tables = tables if keep is None else keep(tables)
    return tables if rows is None else rows.unionByName(tables)
