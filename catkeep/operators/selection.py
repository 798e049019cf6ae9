"""Objects chosen by a nested restore specification, and what hangs off them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators.outcomes import id_filter

# --- fixed values: keys a specification may use ---------------------------------------
METASTORE_KINDS = ["storage credential", "share", "recipient", "connection", "external location"]
SCHEMA_CHILD_KINDS = ["table", "view", "volume", "function", "registered model"]


#: What a rule may compare, in the order of a mask's bits.
RULE_COLUMNS = ["object_type", "object_name", "object_parent_type", "object_parent_name"]
#: Values up to which a specification is a filter that reaches the scan; beyond, its rules are a table.
FILTER_VALUES = 200
#: Bits of the filter over the ids a job has left: 4 MB; it keeps out most of what is done up to some ten million ids.
LEFT_BITS = 1 << 25


@dataclass(frozen=True)
class Rule:
    """Rows to select; None stands for any value."""

    object_type: str | None = None
    names: tuple[str, ...] | None = None
    parent_type: str | None = None
    parent: str | None = None
    parents: tuple[str, ...] | None = None

    def condition(self) -> Column:
        tests = [F.lit(True)]
        if self.object_type is not None:
            tests.append(F.col("object_type") == self.object_type)
        if self.names is not None:
            tests.append(F.col("object_name").isin(list(self.names)))
        if self.parent_type is not None:
            tests.append(F.col("object_parent_type") == self.parent_type)
        if self.parent is not None:
            tests.append(F.col("object_parent_name") == self.parent)
        if self.parents is not None:
            tests.append(F.col("object_parent_name").isin(list(self.parents)))
        return reduce(Column.__and__, tests)

    def rows(self) -> list[tuple]:
        """The rule as rows of RULE_COLUMNS; None stands for any value."""
        parents = self.parents if self.parents is not None else (self.parent,)
        names = self.names if self.names is not None else (None,)
        return [(self.object_type, name, self.parent_type, parent) for name, parent in product(names, parents)]


@dataclass
class Selection:
    """Rules, plus the catalogs all of whose schemas' children are selected."""

    rules: list[Rule] = field(default_factory=list)
    whole_catalogs: list[str] = field(default_factory=list)

    def condition(self) -> Column:
        """Plain comparisons, which the scan can use; null where a name or parent is null."""
        return reduce(Column.__or__, [rule.condition() for rule in self.rules], F.lit(False))

    def rows(self) -> list[tuple]:
        return list(dict.fromkeys(row for rule in self.rules for row in rule.rows()))


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


def _names(value, place: str) -> tuple[str, ...] | None:
    """None for "*", alone or in a list."""
    if value == "*":
        return None
    _require(isinstance(value, list), f"{place} must be a list or '*'")
    _require(all(isinstance(item, str) for item in value), f"{place} must hold strings")
    return None if "*" in value else tuple(value)


def read_spec(spec: dict) -> Selection:
    """Check a specification and turn it into rules."""
    _require("metastore" in spec, "key 'metastore' is missing")
    metastore = spec["metastore"]
    chosen = Selection()
    if metastore == "*":
        chosen.rules.append(Rule())
        return chosen
    _require(isinstance(metastore, dict), "'metastore' must be a dictionary or '*'")
    for kind, value in metastore.items():
        if kind == "catalog":
            _read_catalogs(value, chosen)
            continue
        _require(kind in METASTORE_KINDS, f"unknown kind '{kind}'")
        names = _names(value, f"'{kind}'")
        chosen.rules.append(Rule(kind.upper(), names))
        if kind == "storage credential":
            chosen.rules.append(Rule(model.EXTERNAL_LOCATION, parents=names))
    return chosen


def _read_catalogs(catalogs, chosen: Selection) -> None:
    if catalogs == "*":
        chosen.rules += [
            Rule(model.CATALOG),
            Rule(model.SCHEMA),
            Rule(parent_type=model.SCHEMA),
        ]
        return
    _require(isinstance(catalogs, dict), "'catalog' must be a dictionary or '*'")
    chosen.rules.append(Rule(model.CATALOG, tuple(catalogs)))
    for catalog, children in catalogs.items():
        if children == "*":
            children = {"schema": "*"}
        _require(isinstance(children, dict), f"catalog '{catalog}' must be a dictionary or '*'")
        _require(set(children) <= {"schema"}, f"catalog '{catalog}' may only hold 'schema'")
        schemas = children.get("schema", {})
        if schemas == "*":
            chosen.rules.append(
                Rule(model.SCHEMA, parent_type=model.CATALOG, parent=catalog)
            )
            chosen.whole_catalogs.append(catalog)
            continue
        _require(isinstance(schemas, dict), f"schemas of '{catalog}' must be a dictionary or '*'")
        for schema, kinds in schemas.items():
            chosen.rules.append(
                Rule(model.SCHEMA, (schema,), parent_type=model.CATALOG, parent=catalog)
            )
            _read_children(schema, kinds, chosen)


def _read_children(schema: str, kinds, chosen: Selection) -> None:
    if kinds == "*":
        chosen.rules.append(Rule(parent_type=model.SCHEMA, parent=schema))
        return
    _require(isinstance(kinds, dict), f"schema '{schema}' must be a dictionary or '*'")
    for kind, value in kinds.items():
        _require(kind in SCHEMA_CHILD_KINDS, f"unknown kind '{kind}' in schema '{schema}'")
        names = _names(value, f"'{kind}' of schema '{schema}'")
        chosen.rules.append(
            Rule(kind.upper(), names, parent_type=model.SCHEMA, parent=schema)
        )


def mask_of(row: tuple) -> int:
    """Which columns a rule compares, as bits."""
    return sum(1 << i for i, value in enumerate(row) if value is not None)


def rule_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rules as a local table; columns travel in one piece, so its plan is one node at any number."""
    columns = zip(*rows, strict=True) if rows else ((),) * len(RULE_COLUMNS)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(RULE_COLUMNS, columns, strict=True)}))


def _masks_in(rules: DataFrame) -> list[int]:
    """The masks that occur, 16 at most."""
    bits = sum(F.when(F.col(n).isNotNull(), 1 << i).otherwise(0) for i, n in enumerate(RULE_COLUMNS))
    return sorted(row[0] for row in rules.select(bits.alias("mask")).distinct().collect())


def marked_by_rules(inventory: DataFrame, rules: DataFrame, masks: list[int] | None = None) -> DataFrame:
    """Inventory rows with ``_chosen``: whether any rule fits.

    Rules that compare the same columns are one hash join on those columns, so there are as many joins
    as there are masks (seven from a specification), whatever the number of rules. A rule
    without any value selects all rows. Adaptive execution broadcasts rules where they are few and splits
    hot names where they are not.
    """
    masks = _masks_in(rules) if masks is None else masks
    columns, marks, marked = inventory.columns, [], inventory
    for mask in masks:
        keys = [n for i, n in enumerate(RULE_COLUMNS) if mask >> i & 1]
        if not keys:
            marks.append(F.lit(True))
            continue
        fits = reduce(
            Column.__and__,
            [F.col(n).isNotNull() if n in keys else F.col(n).isNull() for n in RULE_COLUMNS],
        )
        listed = rules.filter(fits).select(*keys).distinct().withColumn(f"_mark_{mask}", F.lit(True))
        marked = marked.join(listed, keys, "left")
        marks.append(F.coalesce(F.col(f"_mark_{mask}"), F.lit(False)))
    return marked.select(*columns, reduce(Column.__or__, marks, F.lit(False)).alias("_chosen"))


def select_by_rules(inventory: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows that any row of ``rules`` (RULE_COLUMNS, null for any value) selects."""
    return marked_by_rules(inventory, rules).filter("_chosen").drop("_chosen")


def _scan_condition(rows: list[tuple]) -> Column:
    """Kinds of objects and parents that rules compare: few values, which the scan can use."""
    kinds = sorted({(row[0], row[2]) for row in rows}, key=str)
    tests = []
    for object_type, parent_type in kinds:
        test = F.lit(True)
        if object_type is not None:
            test &= F.col("object_type") == object_type
        if parent_type is not None:
            test &= F.col("object_parent_type") == parent_type
        tests.append(test)
    return reduce(Column.__or__, tests, F.lit(False))


def _below_catalogs(inventory: DataFrame, catalogs: list[str]) -> DataFrame:
    """Schemas of the catalogs, as names of parents."""
    schemas = inventory.filter(F.col("object_type") == model.SCHEMA)
    if len(catalogs) > FILTER_VALUES:
        named = rule_table(inventory.sparkSession, [(None, None, None, c) for c in dict.fromkeys(catalogs)])
        schemas = schemas.join(named.select("object_parent_name"), "object_parent_name", "left_semi")
    else:
        schemas = schemas.filter(F.col("object_parent_name").isin(catalogs))
    return schemas.select(F.col("object_name").alias("object_parent_name"), F.lit(True).alias("_below")).distinct()


def _flagged(inventory: DataFrame, spec: dict, extra: Column) -> DataFrame:
    """Rows that the specification selects or that satisfy ``extra``, with ``_chosen``.

    A short specification is a filter on the scan. A long one is a table of rules that is joined,
    and only the kinds it names are left to the scan. Children of whole catalogs are found through
    the schemas of those catalogs, one row per schema. One schema may hold most rows.
    """
    chosen = read_spec(spec)
    no = F.lit(False)
    rows = chosen.rows()
    in_schema = F.col("object_parent_type") == model.SCHEMA
    below_any = in_schema if chosen.whole_catalogs else no
    if len(rows) > FILTER_VALUES:
        rules = rule_table(inventory.sparkSession, rows)
        candidates = inventory.filter(_scan_condition(rows) | below_any | extra)
        flagged = marked_by_rules(candidates, rules, sorted(set(map(mask_of, rows))))
    else:
        by_rule = chosen.condition()
        candidates = inventory.filter(by_rule | below_any | extra)
        flagged = candidates.withColumn("_chosen", F.coalesce(by_rule, no))
    if chosen.whole_catalogs:
        below = F.coalesce(F.col("_below") & in_schema, no)
        flagged = flagged.join(
            _below_catalogs(inventory, chosen.whole_catalogs), "object_parent_name", "left"
        ).withColumn("_chosen", F.col("_chosen") | below)
    elif len(rows) <= FILTER_VALUES:
        return flagged
    return flagged.filter(F.col("_chosen") | extra).select(*inventory.columns, "_chosen")


def select_by_spec(inventory: DataFrame, spec: dict) -> DataFrame:
    """Inventory rows a specification names, each as often as the inventory holds it."""
    return _flagged(inventory, spec, F.lit(False)).drop("_chosen")


def with_dependents(
    inventory: DataFrame, spec: dict, match_parent_type: bool = False
) -> DataFrame:
    """Selected rows and the owner, tag, grant and share-content rows of the core objects.

    Dependents are matched by name, or by name and kind with ``match_parent_type``. The chosen
    objects are read once as narrow names; a second read is marked by them. Adaptive execution
    broadcasts the names where they turn out small and splits hot ones where they do not.
    """
    hanging = F.col("object_type").isin(model.DEPENDENT_TYPES)
    flagged = _flagged(inventory, spec, hanging)
    core = flagged.filter(F.col("_chosen") & F.col("object_type").isin(model.CORE_TYPES))
    keys = ["object_name"]
    owners = core.select("object_name")
    if match_parent_type:
        keys.append("object_parent_type")
        owners = core.select("object_name", F.col("object_type").alias("object_parent_type"))
    marked = owners.distinct().withColumn("_owned", F.lit(True))
    owned = F.coalesce(F.col("_owned"), F.lit(False)) & hanging
    return (
        flagged.join(marked, keys, "left")
        .filter(F.col("_chosen") | owned)
        .select(*inventory.columns)
    )


def remaining_work(
    selected: DataFrame, checkpoints: DataFrame, job_id: int, mostly_done: bool = False
) -> DataFrame:
    """Selected rows without a success in this job's log, each object once.

    Repeats are found by id, or by content for rows without one. Neither is the object's name,
    so an object with very many rows is spread.

    ``mostly_done`` is for a job that is run again when little of it is left. The ids that are left are found
    first, from the ids alone, and a filter over them keeps most of the other rows, with their statements, out of
    the shuffle; what it lets through goes by the log as ever. The selection is read twice for that.
    """
    done = (
        checkpoints.filter((F.col("jobid") == job_id) & (F.col("status") == model.SUCCEEDED))
        .select(F.col("rowid").alias("object_uid"))
        .distinct()
    )
    if mostly_done:
        # A row without an id is in no log.
        ids = selected.select("object_uid").filter("object_uid IS NOT NULL")
        left = id_filter(ids.join(done, "object_uid", "left_anti"), "object_uid", LEFT_BITS)
        selected = selected.filter(F.col("object_uid").isNull() | left)
    content = F.xxhash64(*[F.coalesce(name, F.lit("\u0000")) for name in model.IDENTITY_COLUMNS])
    # The key is never null, so rows without an id do not meet in one task; the flag keeps a content
    # hash from being taken for an id.
    keyed = selected.withColumns(
        {"_no_id": F.col("object_uid").isNull(), "_key": F.coalesce("object_uid", content)}
    )
    done = done.select(F.lit(False).alias("_no_id"), F.col("object_uid").alias("_key"))
    return (
        keyed.join(done, ["_key", "_no_id"], "left_anti")
        .dropDuplicates(["_key", "_no_id"])
        .select(selected.columns)
    )
