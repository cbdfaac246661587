"""Records that links are made from, classes of linked references, and the policies that a linked tree has to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import last_wins
from .validate import together

COMPOSITE, ATOMIC = "linked_shared_definition", "linked_shared_atomic_definition"


def records(definitions: DataFrame | None, popups: DataFrame | None, only: str | None = None) -> DataFrame:
    """SRC-14, and SRC-13 with only="definition": definitions, then popups, with the columns source (0, 1) and those of both; what one lacks is null.

    only keeps the rows of one popup_type, a null type being none. None stands for a file that isn't there."""
    given = [df.withColumn("source", F.lit(k)) for k, df in enumerate((definitions, popups)) if df is not None]
    if not given:
        raise ValueError("neither definitions nor popups")
    both = given[0] if len(given) == 1 else given[0].unionByName(given[1], allowMissingColumns=True)
    return both if only is None else both.where(F.col("popup_type") == only)


def linked_classes(refs: DataFrame, composites: DataFrame, atoms: DataFrame) -> DataFrame:
    """CLS-2: refs (definition_link_status, linked_definition_condition_key, root_composite_id, root_atomic_id, and others) that are linked,
    with category, message, action and root.

    A ref without a root (null or empty) takes that of its condition key in composites or atoms (key, root, position), where
    the last position of a key counts; a null or empty key has none. Refs of other statuses aren't linked."""
    roots = last_wins(composites.withColumn("kind", F.lit(COMPOSITE)).unionByName(atoms.withColumn("kind", F.lit(ATOMIC))).select("kind", "key", "position", "root"), ["kind", "key"], "position")
    roots = roots.where("key <> ''").select(F.col("kind").alias("_kind"), F.col("key").alias("_key"), F.col("root").alias("_root"))
    status, key = F.col("definition_link_status"), F.col("linked_definition_condition_key")
    own = F.nullif(F.when(status == COMPOSITE, F.col("root_composite_id")).otherwise(F.col("root_atomic_id")), F.lit(""))
    rows = refs.where(status.isin(COMPOSITE, ATOMIC)).withColumn("_own", own)
    # refs that have their root, or no key, need no look-up and stay out of its keys
    rows = rows.withColumn("_of", F.when(F.col("_own").isNull() & (key != ""), key))
    rows = rows.join(roots, (status == F.col("_kind")) & (F.col("_of") == F.col("_key")), "left")
    root = F.coalesce("_own", F.nullif(F.col("_root"), F.lit("")))
    kind = F.when(status == COMPOSITE, "composite").otherwise("atomic")
    message = F.when(root.isNull(), F.concat(status, F.lit(" status but no root_"), kind, F.lit("_id"))).otherwise(F.concat(F.lit("Linked to shared "), kind, F.lit(" definition.")))
    return rows.select(*refs.columns, status.alias("category"), message.alias("message"), F.lit("none_already_linked").alias("action"), root.alias("root"))


def _violation(check: str, entity, message: str):
    return [F.lit(check).alias("check_id"), entity.cast("string").alias("entity_id"), F.lit(message).alias("message")]


def allowed_statuses(nodes: DataFrame, policies: DataFrame) -> DataFrame:
    """VAL-24: nodes (code, logic_node_id, condition_key, linked_domain_node_id, definition_link_status) whose status their code's policy doesn't allow.

    A policy has code (null: of all codes without one of their own), prefix (nodes of domains whose ids start so are held to it)
    and allowed, a list; several rows of a code allow what one of them allows. Nodes with a blank condition key are no leaves; a null status is ''."""
    each = policies.groupBy("code", "prefix").agg(F.array_distinct(F.flatten(F.collect_list("allowed"))).alias("allowed"))  # a row for each code and prefix
    leaves = nodes.where(F.trim("condition_key") != "").select("code", "logic_node_id", F.coalesce("linked_domain_node_id", F.lit("")).alias("_domain"), F.coalesce("definition_link_status", F.lit("")).alias("_status"))
    named = each.where("code IS NOT NULL").withColumnRenamed("code", "_code")
    held = leaves.join(named, F.col("code") == F.col("_code"), "left")
    rest = each.where("code IS NULL").agg(F.collect_list(F.struct("prefix", "allowed")).alias("rest"))  # one row: the prefixes of the general policy
    own = F.when(F.col("_code").isNotNull(), F.array(F.struct("prefix", "allowed")))
    held = held.withColumn("_rules", F.coalesce(own, rest.scalar()))
    bad = F.exists("_rules", lambda r: F.col("_domain").startswith(r["prefix"]) & ~F.array_contains(r["allowed"], F.col("_status")))
    return held.where(bad).select("code", *_violation("allowed status", F.col("logic_node_id"), "status not allowed")).distinct()


def required_links(nodes: DataFrame, expected: DataFrame, domain: DataFrame) -> DataFrame:
    """VAL-25: what expected (code, condition_key, status, root, node_type) asks of nodes and doesn't find.

    A node of the code has the key; one has the status too; the first of those, by position, has the root, and its domain node
    is one of the code's domain nodes (code, node_id, node_type) of the node_type. nodes has position and root besides the columns of VAL-24.
    Without a node of the status the root is missing too, and no place is looked up. A null root or node_type asks for nothing."""
    asked = expected.select("code", "condition_key", "status", F.col("root").alias("_root"), F.col("node_type").alias("_type")).distinct()
    keys = ["code", "condition_key"]
    first = F.min(F.when(F.col("definition_link_status") == F.col("status"), F.struct("position", "linked_domain_node_id", "root"))).alias("first")
    found = nodes.select(*keys, "position", "definition_link_status", "linked_domain_node_id", "root").join(asked.select(*keys, "status").distinct(), keys).groupBy(*keys, "status").agg(F.lit(True).alias("there"), first)
    rows = asked.join(found, [*keys, "status"], "left")
    paths = domain.select(F.col("code").alias("_c"), F.col("node_id").alias("_n"), F.col("node_type").alias("_t")).distinct()
    places = rows.where("first IS NOT NULL AND _type IS NOT NULL")
    astray = places.join(paths, (F.col("code") == F.col("_c")) & (F.col("first.linked_domain_node_id") == F.col("_n")) & (F.col("_type") == F.col("_t")), "left_anti")
    trees = domain.select(F.col("code").alias("_c")).distinct()
    entity = F.col("condition_key")
    return together(
        rows.where("there IS NULL").select("code", *_violation("required link", entity, "no node")),
        rows.where("first IS NULL").select("code", *_violation("required link", entity, "not linked")),
        rows.where("_root IS NOT NULL AND NOT (first.root <=> _root)").select("code", *_violation("required link", entity, "other root")),
        astray.join(trees, F.col("code") == F.col("_c"), "left_semi").select("code", *_violation("required link", entity, "not on a path")),
        places.join(trees, F.col("code") == F.col("_c"), "left_anti").select("code", *_violation("required link", entity, "no domain tree")),
    )
