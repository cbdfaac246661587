"""Queries over numbered trees, rendered graphs and bounded crawls, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..sources.io import table
from .catalog import query


def _sql(spark, sf_dir, name, *columns):
    return table(spark, sf_dir, name).selectExpr(*columns)


# ---- numbers of trees ------------------------------------------------------------------------------------------

_FOREST = """forest AS (SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent, 0::DOUBLE AS ord FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_acctbal FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_totalprice FROM orders)"""
_TOUR = f"""WITH RECURSIVE {_FOREST}, ranked AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY ord, id) AS k FROM forest),
walk AS (SELECT id, parent, id AS root, 0 AS depth, []::BIGINT[] AS place FROM ranked WHERE parent IS NULL
  UNION ALL SELECT r.id, r.parent, w.root, w.depth + 1, list_append(w.place, r.k) FROM ranked r JOIN walk w ON r.parent = w.id),
tour AS (SELECT id, parent, root, depth, row_number() OVER (PARTITION BY root ORDER BY place) - 1 AS pre, row_number() OVER (PARTITION BY root ORDER BY list_append(place, 9000000000000000)) - 1 AS post FROM walk)"""


def _forest(spark, sf_dir):
    """Regions, nations, customers and all orders."""
    rows = _sql(spark, sf_dir, "region", "'r' || r_regionkey AS id", "CAST(NULL AS string) AS parent", "0D AS ord")
    rows = rows.unionByName(_sql(spark, sf_dir, "nation", "'n' || n_nationkey AS id", "'r' || n_regionkey AS parent", "CAST(n_nationkey AS double) AS ord"))
    rows = rows.unionByName(_sql(spark, sf_dir, "customer", "'c' || c_custkey AS id", "'n' || c_nationkey AS parent", "c_acctbal AS ord"))
    return rows.unionByName(_sql(spark, sf_dir, "orders", "'o' || o_orderkey AS id", "'c' || o_custkey AS parent", "o_totalprice AS ord"))


@query(f"{_TOUR} SELECT id, root, depth, post - pre + depth + 1 AS size, pre, post FROM tour")
def tree_tour_numbers(spark, sf_dir):
    """S9: numbers on entering and on leaving, and sizes, of every node of region > nation > customer > order."""
    return graph.tour_numbers(_forest(spark, sf_dir)).select("id", "root", "depth", "size", "pre", "post")


@query(f"{_TOUR} SELECT t.id, CASE WHEN pre = 0 THEN 'logic.' || lower(r_name) ELSE 'd.' || lower(r_name) || '.' || pre END AS logic_id, post AS sort_order FROM tour t JOIN region ON t.root = 'r' || r_regionkey")
def tree_logic_ids(spark, sf_dir):
    """S9, TREE-5: ids by entering, the root's given and not counted; order by leaving."""
    roots = _sql(spark, sf_dir, "region", "'r' || r_regionkey AS root", "'logic.' || lower(r_name) AS root_id", "'d.' || lower(r_name) AS prefix")
    return graph.logic_ids(_forest(spark, sf_dir), roots).select("id", "logic_id", "sort_order")


_HEADS = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Admission is indicated for 1 OR more of these' WHEN '2' THEN 'ADMISSION IS INDICATED by the following' WHEN '3' THEN 'Admission is indicated' ELSE 'Order ' || o_orderdate END"
_ITEMS = "CASE l_returnflag WHEN 'R' THEN 'Extended Stay over ' || l_quantity WHEN 'A' THEN CASE l_linestatus WHEN 'F' THEN 'Goal length of stay' ELSE 'Item' END ELSE 'Item ' || l_partkey END"


@query(
    f"""WITH nodes AS (SELECT 'c' || o_custkey AS code, 'c' || o_custkey || CASE o_orderstatus WHEN 'P' THEN '.section.stay' ELSE '.section.admission' END AS section, 'o' || o_orderkey AS id, NULL::VARCHAR AS parent, o_orderkey % 5 AS ord, {_HEADS} AS text FROM orders
    UNION ALL SELECT 'c' || o_custkey, '', 'o' || l_orderkey || '.' || l_linenumber, 'o' || l_orderkey, l_linenumber, {_ITEMS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    heads AS (SELECT code, id, row_number() OVER (PARTITION BY code ORDER BY CASE WHEN regexp_matches(lower(text), 'admission is indicated') AND regexp_matches(lower(text), '1 or more|following') THEN 0 ELSE 1 END, ord, id) AS k FROM nodes WHERE parent IS NULL AND section = code || '.section.admission')
    SELECT code, path_id, row_number() OVER (PARTITION BY code ORDER BY ord, path_id) AS n FROM (SELECT n.code, n.id AS path_id, min(n.ord) AS ord FROM nodes n JOIN heads h ON n.parent = h.id AND h.k = 1 WHERE NOT regexp_matches(lower(n.text), 'extended stay|goal length of stay') GROUP BY ALL)"""
)
def tree_paths(spark, sf_dir):
    """TREE-9: the admission paths of every customer; orders are headers, their lines are items."""
    orders = table(spark, sf_dir, "orders")
    heads = orders.selectExpr("'c' || o_custkey AS code", "'c' || o_custkey || CASE o_orderstatus WHEN 'P' THEN '.section.stay' ELSE '.section.admission' END AS section", "'o' || o_orderkey AS id", "CAST(NULL AS string) AS parent", "o_orderkey % 5 AS ord", f"{_HEADS} AS text")
    items = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr("'c' || o_custkey AS code", "'' AS section", "'o' || l_orderkey || '.' || l_linenumber AS id", "'o' || l_orderkey AS parent", "CAST(l_linenumber AS bigint) AS ord", f"{_ITEMS} AS text")
    return graph.discover_paths(heads.unionByName(items))


# ---- occurrences -----------------------------------------------------------------------------------------------

_GRAPH = """nodes AS (SELECT 'domain' AS graph, 'n' || n_nationkey AS id, n_name AS label FROM nation UNION ALL SELECT 'domain', 's' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'domain', 'p' || p_partkey, p_name FROM part WHERE p_size <> 1 UNION ALL SELECT 'shared', 'd' || p_partkey, p_brand FROM part),
edges AS (SELECT 'domain' AS graph, 'n' || s_nationkey AS parent, 'domain' AS to_graph, 's' || s_suppkey AS child, s_suppkey AS pos FROM supplier
  UNION ALL SELECT 'domain', 's' || s_suppkey, 'domain', 'n' || s_nationkey, 0 FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT DISTINCT 'domain', 's' || l_suppkey, 'domain', 'p' || l_partkey, l_partkey FROM lineitem
  UNION ALL SELECT 'domain', 'p' || p_partkey, 'shared', 'd' || p_partkey, 0 FROM part
  UNION ALL SELECT 'shared', 'd' || p_partkey, 'shared', 'd' || CASE WHEN p_partkey >= 10 THEN p_partkey // 10 WHEN p_partkey % 2 = 1 THEN p_partkey * 10 ELSE 0 END, 1 FROM part)"""
_OCCURS = f"""WITH RECURSIVE {_GRAPH},
walk AS (SELECT 'n' || n_nationkey AS root, [n_nationkey]::BIGINT[] AS place, 0 AS depth, []::VARCHAR[] AS above, 'domain' AS graph, 'n' || n_nationkey AS id, false AS cycle, true AS there, n_name AS label FROM nation
  UNION ALL SELECT w.root, list_append(w.place, e.pos), w.depth + 1, CASE WHEN e.to_graph = w.graph THEN list_append(w.above, w.id) ELSE [] END, e.to_graph, e.child, e.to_graph = w.graph AND (list_contains(w.above, e.child) OR w.id = e.child), n.id IS NOT NULL, n.label
  FROM walk w JOIN edges e ON e.graph = w.graph AND e.parent = w.id LEFT JOIN nodes n ON n.graph = e.to_graph AND n.id = e.child WHERE NOT w.cycle AND w.there)"""


def _parts(spark, sf_dir):
    """Nations, their suppliers, all parts that they deliver, and what a part shares; with ways back and parts that are missing."""
    t = lambda name, *columns: _sql(spark, sf_dir, name, *columns)
    nodes = t("nation", "'domain' AS graph", "'n' || n_nationkey AS id", "n_name AS label")
    for more in (t("supplier", "'domain' AS graph", "'s' || s_suppkey AS id", "s_name AS label"), t("part", "'domain' AS graph", "'p' || p_partkey AS id", "p_name AS label", "p_size").where("p_size <> 1").drop("p_size"), t("part", "'shared' AS graph", "'d' || p_partkey AS id", "p_brand AS label")):
        nodes = nodes.unionByName(more)
    edge = lambda graph, parent, to, child, pos: [f"'{graph}' AS graph", f"{parent} AS parent", f"'{to}' AS to_graph", f"{child} AS child", f"CAST({pos} AS bigint) AS pos"]
    edges = t("supplier", *edge("domain", "'n' || s_nationkey", "domain", "'s' || s_suppkey", "s_suppkey"))
    back = table(spark, sf_dir, "supplier").where("s_acctbal < 0").selectExpr(*edge("domain", "'s' || s_suppkey", "domain", "'n' || s_nationkey", "0"))
    delivers = t("lineitem", *edge("domain", "'s' || l_suppkey", "domain", "'p' || l_partkey", "l_partkey")).distinct()
    shares = t("part", *edge("domain", "'p' || p_partkey", "shared", "'d' || p_partkey", "0"))
    ways = t("part", *edge("shared", "'d' || p_partkey", "shared", "'d' || CASE WHEN p_partkey >= 10 THEN p_partkey DIV 10 WHEN p_partkey % 2 = 1 THEN p_partkey * 10 ELSE 0 END", "1"))
    roots = t("nation", "'domain' AS graph", "'n' || n_nationkey AS id", "CAST(n_nationkey AS bigint) AS pos")
    return nodes, edges.unionByName(back).unionByName(delivers).unionByName(shares).unionByName(ways), roots


@query(f"{_OCCURS} SELECT root, place, depth, graph, id, CASE WHEN cycle THEN 'cycle' WHEN there THEN 'node' ELSE 'missing' END AS kind, CASE WHEN cycle AND graph = 'domain' THEN 'Cycle skipped: ' || id WHEN cycle THEN 'Shared cycle skipped: ' || id WHEN there THEN coalesce(label, '') WHEN graph = 'domain' THEN 'Missing logic node: ' || id ELSE 'Missing shared child: ' || id END AS line FROM walk")
def graph_occurrences(spark, sf_dir):
    """TREE-19, ORC-5: all occurrences under every nation, with markers."""
    return graph.occurrences(*_parts(spark, sf_dir))


@query(f"{_OCCURS} SELECT root, graph, CASE WHEN cycle THEN 'cycle' WHEN there THEN 'node' ELSE 'missing' END AS kind, max(depth) AS deepest, count(*) AS n FROM walk GROUP BY ALL")
def graph_occurrence_counts(spark, sf_dir):
    """TREE-19: how often what occurs under each nation."""
    return graph.occurrence_counts(*_parts(spark, sf_dir))


# ---- crawl -----------------------------------------------------------------------------------------------------

PAGES, LEAVES, ROUNDS = 400, 150, 16
_LINKS = """harvest AS (SELECT page_id, unnest(x) AS h, generate_subscripts(x, 1) AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS x FROM pages)),
links AS (SELECT 'page:' || page_id AS src, h AS dst, pos, regexp_matches(h, '^/[A-Z]') AS leaf FROM harvest UNION ALL SELECT DISTINCT h, 'page:' || page_id, page_id, false FROM harvest WHERE NOT regexp_matches(h, '^/[A-Z]'))"""


def _crawl_sql() -> str:
    """The rounds written out one after the other."""
    steps = ["v0 AS (SELECT 'page:' || min(page_id) AS url, 0 AS round, NULL::VARCHAR AS parent, 0::BIGINT AS n FROM pages)", "s0 AS (SELECT * FROM v0)"]
    for k in range(1, ROUNDS + 1):
        found = f"SELECT dst AS url, min((v.n, l.pos)) AS place, arg_min(src, (v.n, l.pos)) AS parent FROM links l JOIN v{k - 1} v ON l.src = v.url WHERE NOT leaf AND (SELECT count(*) FROM s{k - 1}) < {PAGES} AND dst NOT IN (SELECT url FROM s{k - 1}) GROUP BY dst"
        steps += [f"v{k} AS MATERIALIZED (SELECT url, {k} AS round, parent, row_number() OVER (ORDER BY place, url) - 1 + (SELECT count(*) FROM s{k - 1}) AS n FROM ({found}))", f"s{k} AS MATERIALIZED (FROM s{k - 1} UNION ALL FROM v{k})"]
    leaves = f"SELECT dst AS url, min((s.n, l.pos)) AS place, arg_min(src, (s.n, l.pos)) AS parent, arg_min(round, (s.n, l.pos)) AS round FROM links l JOIN s{ROUNDS} s ON l.src = s.url WHERE leaf AND s.n < {PAGES} GROUP BY dst"
    return f"WITH {_LINKS}, {', '.join(steps)} SELECT url, 'page' AS kind, round, parent, n, n < {PAGES} AS taken FROM s{ROUNDS} UNION ALL SELECT url, 'leaf', round + 1, parent, row_number() OVER (ORDER BY place, url) - 1, row_number() OVER (ORDER BY place, url) <= {LEAVES} FROM ({leaves})"


@query(_crawl_sql())
def crawl_links(spark, sf_dir):
    """SRC-8: a crawl with budgets over all links of all pages: from the first page to what it links to, and from a link's target to the pages that name it."""
    harvest = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "h"))
    page, leaf = F.concat(F.lit("page:"), F.col("page_id").cast("string")), F.col("h").rlike("^/[A-Z]")
    links = harvest.select(page.alias("src"), F.col("h").alias("dst"), (F.col("pos") + 1).cast("long").alias("pos"), leaf.alias("leaf"))
    back = harvest.where(~leaf).select(F.col("h").alias("src"), page.alias("dst"), F.col("page_id").cast("long").alias("pos"), F.lit(False).alias("leaf")).distinct()
    starts = table(spark, sf_dir, "pages").agg(F.min("page_id").alias("m")).select(F.concat(F.lit("page:"), F.col("m").cast("string")).alias("url"), F.lit(0).alias("pos"))
    return graph.crawl(links.unionByName(back), starts, PAGES, LEAVES)
