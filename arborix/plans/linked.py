"""Queries over record unions, linked references and their policies, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import linked
from ..sources.io import table
from .catalog import query

_NODES = """SELECT 'C' || (o_custkey % 20) AS code, o_orderkey AS position, 'n' || o_orderkey AS logic_node_id, CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE 'k' || (o_custkey % 2) END AS condition_key,
  CASE WHEN o_orderkey % 3 = 0 THEN 'dis.' ELSE 'adm.' END || o_custkey AS linked_domain_node_id, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'linked_shared_definition' WHEN o_orderstatus = 'O' THEN 'linked_shared_atomic_definition' ELSE 'unlinked' END AS definition_link_status,
  'root.' || (o_custkey % 3) AS root FROM orders"""


def _sql(spark, sf_dir, text: str, *names: str):
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(f"linked_{n}")
        text = text.replace(f"FROM {n}", f"FROM linked_{n}")
    return spark.sql(text)


@query(
    f"""WITH nodes AS ({_NODES}), held AS (SELECT *, coalesce(definition_link_status, '') AS s FROM nodes WHERE trim(condition_key) <> ''),
    bad AS (SELECT code, logic_node_id FROM held WHERE code IN (SELECT 'C' || n_nationkey FROM nation WHERE n_nationkey < 8) AND starts_with(linked_domain_node_id, 'adm.') AND s NOT IN ('linked_shared_definition', CASE WHEN substr(code, 2)::INT % 2 = 0 THEN 'linked_shared_atomic_definition' ELSE 'linked_shared_definition' END)
      UNION ALL SELECT code, logic_node_id FROM held WHERE code NOT IN (SELECT 'C' || n_nationkey FROM nation WHERE n_nationkey < 8) AND s = '')
    SELECT code, 'allowed status' AS check_id, logic_node_id AS entity_id, 'status not allowed' AS message FROM bad"""
)
def linked_allowed_statuses(spark, sf_dir):
    """VAL-24: all orders as leaves, held to the policies of some nations' codes and to the general one."""
    own = "SELECT 'C' || n_nationkey AS code, 'adm.' AS prefix, CASE WHEN n_nationkey % 2 = 0 THEN array('linked_shared_definition', 'linked_shared_atomic_definition') ELSE array('linked_shared_definition') END AS allowed FROM nation WHERE n_nationkey < 8"
    policies = _sql(spark, sf_dir, own, "nation").unionByName(spark.sql("SELECT CAST(NULL AS string) AS code, x AS prefix, array('linked_shared_definition', 'linked_shared_atomic_definition', 'unlinked') AS allowed FROM (SELECT explode(array('adm.', 'dis.')) AS x)"))
    return linked.allowed_statuses(_sql(spark, sf_dir, _NODES, "orders"), policies)


_EXPECTED = "SELECT 'C' || n_nationkey AS code, 'k' || (n_nationkey % 3) AS condition_key, CASE WHEN n_nationkey % 4 < 2 THEN 'linked_shared_definition' ELSE 'linked_shared_atomic_definition' END AS status, 'root.' || n_regionkey AS root, 'admission_path' AS node_type FROM nation"
_DOMAIN = "SELECT 'C' || (c_custkey % 20) AS code, CASE WHEN c_custkey % 5 = 0 THEN 'dis.' ELSE 'adm.' END || c_custkey AS node_id, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'admission_path' ELSE 'group' END AS node_type FROM customer WHERE c_custkey % 20 <> 6"


@query(
    f"""WITH nodes AS ({_NODES}), expected AS ({_EXPECTED}), dom AS ({_DOMAIN}),
    j AS (SELECT e.code, e.condition_key, e.root AS want, (SELECT count(*) FROM nodes n WHERE n.code = e.code AND n.condition_key = e.condition_key) AS n, f.position, f.root, f.linked_domain_node_id AS d FROM expected e LEFT JOIN (SELECT code, condition_key, definition_link_status, position, root, linked_domain_node_id FROM nodes QUALIFY row_number() OVER (PARTITION BY code, condition_key, definition_link_status ORDER BY position, linked_domain_node_id, root) = 1) f ON f.code = e.code AND f.condition_key = e.condition_key AND f.definition_link_status = e.status),
    v AS (SELECT code, condition_key, 'no node' AS message FROM j WHERE n = 0 UNION ALL SELECT code, condition_key, 'not linked' FROM j WHERE position IS NULL UNION ALL SELECT code, condition_key, 'other root' FROM j WHERE root IS DISTINCT FROM want
      UNION ALL SELECT code, condition_key, CASE WHEN EXISTS (SELECT 1 FROM dom WHERE dom.code = j.code) THEN 'not on a path' ELSE 'no domain tree' END FROM j WHERE position IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dom WHERE dom.code = j.code AND dom.node_id = j.d AND dom.node_type = 'admission_path'))
    SELECT code, 'required link' AS check_id, condition_key AS entity_id, message FROM v"""
)
def linked_required(spark, sf_dir):
    """VAL-25: what the nations ask of all orders as nodes, with all customers as domain nodes."""
    return linked.required_links(_sql(spark, sf_dir, _NODES, "orders"), _sql(spark, sf_dir, _EXPECTED, "nation"), _sql(spark, sf_dir, _DOMAIN, "customer"))


_REFS = "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'linked_shared_definition' WHEN 'N' THEN 'linked_shared_atomic_definition' ELSE 'unlinked' END AS definition_link_status, CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'p' || l_partkey END AS linked_definition_condition_key, CASE WHEN l_suppkey % 3 = 0 THEN 'own.' || l_suppkey WHEN l_suppkey % 3 = 1 THEN '' END AS root_composite_id, CASE WHEN l_suppkey % 5 = 0 THEN 'atom.' || l_suppkey END AS root_atomic_id FROM lineitem"
_ROOTS = "SELECT 'p' || (p_partkey - p_partkey % 2) AS key, CASE WHEN p_size % 6 = 0 THEN '' ELSE '{}' || p_partkey END AS root, p_partkey AS position FROM part"


@query(
    f"""WITH refs AS ({_REFS}), c AS (SELECT * FROM ({_ROOTS.format("c")}) QUALIFY row_number() OVER (PARTITION BY key ORDER BY position DESC) = 1), a AS (SELECT * FROM ({_ROOTS.format("a")}) QUALIFY row_number() OVER (PARTITION BY key ORDER BY position DESC) = 1),
    r AS (SELECT refs.*, definition_link_status = 'linked_shared_definition' AS comp, CASE WHEN definition_link_status = 'linked_shared_definition' THEN coalesce(nullif(root_composite_id, ''), nullif(c.root, '')) ELSE coalesce(nullif(root_atomic_id, ''), nullif(a.root, '')) END AS root
      FROM refs LEFT JOIN c ON c.key = linked_definition_condition_key LEFT JOIN a ON a.key = linked_definition_condition_key WHERE definition_link_status <> 'unlinked')
    SELECT definition_link_status AS category, root, CASE WHEN root IS NULL THEN definition_link_status || ' status but no root_' || CASE WHEN comp THEN 'composite' ELSE 'atomic' END || '_id' ELSE 'Linked to shared ' || CASE WHEN comp THEN 'composite' ELSE 'atomic' END || ' definition.' END AS message, 'none_already_linked' AS action, count(*) AS n FROM r GROUP BY ALL"""
)
def linked_reference_classes(spark, sf_dir):
    """CLS-2: all line items as references, their parts as shared definitions, counted by class and root."""
    found = linked.linked_classes(_sql(spark, sf_dir, _REFS, "lineitem"), *(_sql(spark, sf_dir, _ROOTS.format(k), "part") for k in "ca"))
    return found.groupBy("category", "root", "message", "action").agg(F.count("*").alias("n"))


@query(
    """SELECT 0 AS source, doc_id AS id, text AS body, NULL::VARCHAR AS url, lang AS popup_type, lang IS NOT DISTINCT FROM 'en' AS definition FROM documents
    UNION ALL SELECT 1, page_id, NULL, url, CASE page_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'x' END, page_id % 3 = 0 FROM pages"""
)
def linked_records(spark, sf_dir):
    """SRC-13, SRC-14: documents as definitions and pages as popups in one table, and whether a row is of the type asked for."""
    definitions = _sql(spark, sf_dir, "SELECT doc_id AS id, text AS body, lang AS popup_type FROM documents", "documents")
    popups = _sql(spark, sf_dir, "SELECT page_id AS id, url, CASE page_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'x' END AS popup_type FROM pages", "pages")
    every, only = linked.records(definitions, popups), linked.records(definitions, popups, only="en")
    rest = every.where("NOT (popup_type <=> 'en')").withColumn("definition", F.lit(False))
    return only.withColumn("definition", F.lit(True)).unionByName(rest).select("source", "id", "body", "url", "popup_type", "definition")
