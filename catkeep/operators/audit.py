"""Catalogs seen in the audit log that are not bound here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators.ordering import newest_per_key


def look_back_start(inventory: DataFrame) -> DataFrame:
    """One row: two hours before the newest backup row, or the earliest time without any."""
    return inventory.agg(
        F.coalesce(
            F.max(F.col("created_tsp").cast("timestamp_ntz")) - F.expr("INTERVAL '2' HOUR"),
            F.lit(model.EPOCH).cast("timestamp_ntz"),
        ).alias("since")
    )


def catalog_of_event() -> Column:
    """Catalog an event is about; which parameter names it depends on the action."""
    parameters = F.col("request_params")
    return (
        F.when(F.col("action_name") == model.CREATE_CATALOG_ACTION, parameters["name"])
        .when(F.col("action_name").isin(model.CATALOG_ACTIONS_BY_NAME_ARG), parameters["name_arg"])
        .otherwise(parameters["catalog_name"])
    )


def latest_catalog_events(
    audit: DataFrame,
    since: DataFrame | None = None,
    metastore: str | None = None,
    more_actions: Sequence[str] = (),
) -> DataFrame:
    """Newest catalog event per catalog; equal times are settled by action.

    ``more_actions`` are further actions on catalogs, which carry the name as ``catalog_name``.
    """
    actions = [model.CREATE_CATALOG_ACTION, *model.CATALOG_ACTIONS_BY_NAME_ARG, *more_actions]
    events = audit.filter(F.col("action_name").isin(actions))
    if since is not None:
        events = events.filter(F.col("event_time") > since.scalar())
    if metastore is not None:
        events = events.filter(F.col("request_params.metastore_id") == metastore)
    named = events.select(catalog_of_event().alias("catalog_name"), "action_name", "event_time")
    return newest_per_key(named, "catalog_name", [F.desc("event_time"), F.asc("action_name")])


def live_catalogs(latest: DataFrame, left_out: Sequence[str] = ()) -> DataFrame:
    """Catalogs whose newest event is no deletion, without reserved names and those ``left_out``."""
    name = F.col("catalog_name")
    return latest.filter(
        (F.col("action_name") != model.DELETE_CATALOG_ACTION)
        & ~name.isin([*model.RESERVED_CATALOGS_AUDIT, *left_out])
    )


def unbound_catalogs(
    audit: DataFrame,
    visible: DataFrame,
    since: DataFrame | None = None,
    metastore: str | None = None,
    left_out: Sequence[str] = (),
) -> DataFrame:
    seen = live_catalogs(latest_catalog_events(audit, since, metastore), left_out)
    return seen.select("catalog_name").subtract(visible.select("catalog_name"))
