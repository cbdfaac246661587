"""Queries of the guideline functions, the tree builder, definition bundles and audits over the driver tables, with their DuckDB forms.

Inputs are made by the same SQL expressions on both sides; what is shown is the operator over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import guideline as g
from ..operators import build, evaluate
from ..operators.evaluate import Atom, Composite, Node, Rules
from ..sources.io import table
from .catalog import _FACTS, _NAME, _WS, SQL, _wide, eval_case_check, eval_trace, query


def _inputs(spark, sf_dir, name, *columns):
    return table(spark, sf_dir, name).selectExpr(*columns)


def _from(name, *columns):
    return f"(SELECT {', '.join(columns)} FROM {name})"


# ---- functions -------------------------------------------------------------------------------------------------

_T1 = ("p_partkey", "CASE p_size % 5 WHEN 0 THEN 'Note: ' || p_name WHEN 1 THEN p_name || ' may include more' WHEN 2 THEN p_name || ' includes: all' WHEN 3 THEN 'Includes ' || p_name || ':' ELSE p_name END AS x", "p_partkey % 3 AS depth", "p_partkey % 2 = 0 AS has")


@query(f"SELECT p_partkey, CASE WHEN lower(x) LIKE 'note:%' THEN 'note' WHEN contains(lower(x), 'may include') THEN 'option' WHEN (contains(lower(x), 'includes') AND x LIKE '%:') OR contains(lower(x), 'includes:') THEN 'checklist_item' WHEN depth = 1 AND has THEN 'criterion_root' ELSE 'criterion_item' END AS kind FROM {_from('part', *_T1)}")
def node_type_parts(spark, sf_dir):
    """FN-5."""
    return _inputs(spark, sf_dir, "part", *_T1).select("p_partkey", g.node_type(F.col("x"), F.col("depth"), F.col("has")).alias("kind"))


_T2 = ("p_partkey", "CASE p_size % 8 WHEN 0 THEN 'admission' WHEN 1 THEN 'alternatives' WHEN 2 THEN 'discharge_planning' WHEN 3 THEN 'evidence_x' WHEN 4 THEN 'related_cms' WHEN 5 THEN 'care_planning' WHEN 6 THEN 'extended_stay' ELSE 'own' END AS k", "CASE p_partkey % 5 WHEN 0 THEN 'References' WHEN 1 THEN 'Alternatives to Admission 2' WHEN 2 THEN 'Codes' WHEN 3 THEN 'Evidence Summary' ELSE p_name END AS t", f"CASE WHEN p_partkey % 11 = 0 THEN '{g.ADMISSION_ROLE}' END AS r")


@query(
    f"""SELECT p_partkey, CASE WHEN k = 'admission' OR r IS NOT NULL THEN 'admission' WHEN k = 'alternatives' OR contains(t, 'Alternatives to Admission') THEN 'alternatives' WHEN k = 'extended_stay' THEN k
  WHEN k LIKE 'discharge%' THEN 'discharge' WHEN t = 'References' THEN 'references' WHEN t = 'Codes' THEN 'codes' WHEN k LIKE 'evidence%' OR k = 'related_cms' OR t = 'Evidence Summary' THEN 'evidence_summary' ELSE k END AS domain,
  k LIKE 'evidence%' OR k = 'related_cms' AS prose, k = 'discharge' OR k LIKE 'discharge.%' AS in_scope FROM {_from('part', *_T2)}"""
)
def section_domains(spark, sf_dir):
    """PARSE-7, PARSE-17, FN-44."""
    k = F.col("k")
    return _inputs(spark, sf_dir, "part", *_T2).select("p_partkey", g.section_domain(k, F.col("t"), F.col("r")).alias("domain"), g.is_prose(k).alias("prose"), g.in_scope(k, "discharge").alias("in_scope"))


_T3 = ("p_partkey", "p_name || ' [A] (2 of ' || p_size || '): more ( x), as indicated by' AS x", "CASE WHEN p_size % 2 = 0 THEN 'Definition - ' || p_name ELSE p_name END AS t", "replace(p_name, ' ', '_') || CASE p_size % 3 WHEN 0 THEN '_condition_present' WHEN 1 THEN '_required' ELSE '' END AS k")


@query(
    rf"""SELECT p_partkey, trim(split_part(x, ', as indicated', 1)) AS title, trim(split_part(split_part(trim(x), ':', 1), '( ', 1)) AS headline, lower(trim(regexp_replace(regexp_replace(regexp_replace(x, '\[\s*[A-Za-z]\s*\]', '', 'g'), '\(\s*\d', ' (', 'g'), '\s+', ' ', 'g'))) AS audited,
  lower(CASE WHEN t LIKE 'Definition -%' THEN trim(substr(t, 13)) ELSE t END) AS core, trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) AS plain, list_sort(list_distinct(list_filter(string_split(regexp_replace(k, '(_condition_present|_required)$', ''), '_'), lambda w: length(w) >= 4))) AS tokens FROM {_from('part', *_T3)}"""
)
def headline_forms(spark, sf_dir):
    """FN-14, FN-28, FN-29, FN-30, FN-42, FN-43."""
    x = F.col("x")
    return _inputs(spark, sf_dir, "part", *_T3).select("p_partkey", g.path_title(F.lit(""), x).alias("title"), g.match_headline(x).alias("headline"), g.audit_headline(x).alias("audited"), g.core_title(F.col("t")).alias("core"), g.plain(x).alias("plain"), g.meaning_tokens(F.col("k")).alias("tokens"))


_PAD = "'M' || CASE WHEN length({0}::VARCHAR) < 3 THEN lpad({0}::VARCHAR, 3, '0') ELSE {0}::VARCHAR END"
_T4 = ("p_partkey", "p_size", "'m' || p_size || ', M-' || p_partkey % 1000 || ' ,, x' AS x")


@query(f"SELECT p_partkey, list_sort(list_distinct(list_filter([{_PAD.format('p_size')}, CASE WHEN p_partkey % 1000 > 0 THEN {_PAD.format('(p_partkey % 1000)')} END], lambda c: c IS NOT NULL))) AS codes, 3 AS parts FROM part")
def code_lists(spark, sf_dir):
    """PARSE-28, FN-46, LIM-1's list of codes."""
    return _inputs(spark, sf_dir, "part", *_T4).select("p_partkey", g.only_codes(F.col("x")).alias("codes"), F.size(g.code_list(F.col("x"))).alias("parts"))


_T5 = ("page_id", "url", "html", "CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN '/login/x' WHEN 2 THEN ' #top' WHEN 3 THEN '' WHEN 4 THEN 'Abstract.htm' ELSE '/ok' END AS href")
_H = lambda x: f"lower(trim(regexp_replace({x}, '{_WS}', ' ', 'g')))"


@query(
    f"""SELECT page_id, CASE WHEN href LIKE 'http%' THEN 'blocked absolute http(s) href' WHEN href = '/login/x' THEN 'blocked href contains ''/login''' WHEN href = ' #top' THEN 'blocked href contains ''#top''' WHEN href = 'Abstract.htm' THEN 'blocked href contains ''abstract.htm''' END AS reason,
  sha1({_H('url')} || '|' || {_H('substr(href, 1, 400)')} || '||' || {_H('substr(html, 1, 800)')}) AS fingerprint FROM {_from('pages', *_T5)}"""
)
def trigger_links(spark, sf_dir):
    """FN-49, ID-3."""
    return _inputs(spark, sf_dir, "pages", *_T5).select("page_id", g.blocked(F.col("href")).alias("reason"), g.fingerprint(F.col("url"), F.col("href"), F.lit(None).cast("string"), F.col("html")).alias("fingerprint"))


_T6 = ("p_partkey", "p_type", "p_name", "'M-' || p_size || CASE WHEN p_partkey % 5 = 0 THEN '-RRG' ELSE '' END || ' | ' || CASE p_partkey % 3 WHEN 0 THEN 'ISC' ELSE 'GRG' END || ' | ' || CASE p_partkey % 2 WHEN 0 THEN 'ORG' ELSE 'OTH' END || ' || ' || p_name || ' | end' AS x", "p_size")
_SCORE = "CASE WHEN p_size <> 15 THEN -99999 WHEN p_partkey % 5 = 0 THEN -100000 ELSE CASE WHEN p_partkey % 3 = 0 THEN 400 ELSE 0 END + CASE WHEN p_partkey % 2 = 0 THEN 650 ELSE 0 END + CASE WHEN contains(lower(x), 'red') THEN 220 ELSE 0 END END"


@query(f"SELECT p_partkey, trim(split_part(x, ' | ', 1)) AS code, CASE p_partkey % 3 WHEN 0 THEN 'ISC' ELSE 'GRG' END AS product, p_name || ' | end' AS title, ({_SCORE})::INT AS score FROM {_from('part', *_T6)}")
def search_rows(spark, sf_dir):
    """PARSE-34, RANK-4."""
    own = g.pipe_fields(F.col("x"))
    return _inputs(spark, sf_dir, "part", *_T6).select("p_partkey", own["code"].alias("code"), own["product"].alias("product"), own["title"].alias("title"), g.row_score(F.col("x"), "15", False, "red").alias("score"))


@query(f"SELECT p_type, p_partkey, score FROM (SELECT p_type, p_partkey, ({_SCORE})::INT AS score FROM {_from('part', *_T6)}) WHERE score > -50000 QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY score DESC, p_partkey) = 1")
def search_best(spark, sf_dir):
    """RANK-5: best row of each group, the first on a tie; rejected rows never win."""
    rows = _inputs(spark, sf_dir, "part", *_T6).select("p_type", "p_partkey", g.row_score(F.col("x"), "15", False, "red").alias("score")).where("score > -50000")
    return rows.groupBy("p_type").agg(F.max(F.struct("score", -F.col("p_partkey"))).alias("b"), F.max_by("p_partkey", F.struct("score", -F.col("p_partkey"))).alias("p_partkey")).select("p_type", "p_partkey", "b.score")


_T7 = ("c_custkey", "c_mktsegment", "CASE c_nationkey % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'needs_review' ELSE 'pass' END AS s", "c_custkey % 2 = 0 AS lenient", "'M0' || c_nationkey AS code", "c_nationkey", "CASE WHEN c_acctbal > 0 THEN 200 ELSE 20 END AS t")


@query("SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 OR (c_nationkey % 3 = 1 AND c_custkey % 2 = 1) THEN 1 ELSE 0 END AS exit_code, [c_mktsegment, 'M0' || c_nationkey, 'M-' || c_nationkey] AS markers, c_acctbal > 0 OR c_nationkey >= 20 AS grew, list_distinct_order AS ids FROM (SELECT *, CASE WHEN c_nationkey = 1 THEN ['a', '1'] ELSE ['a', '1', c_nationkey::VARCHAR] END AS list_distinct_order FROM customer)")
def capture_helpers(spark, sf_dir):
    """FN-50, FN-56, FN-57, JOIN-19."""
    c = _inputs(spark, sf_dir, "customer", *_T7)
    ids = g.merged_ids(F.array(F.lit(" a"), F.lit(""), F.lit("1")), F.array(F.col("c_nationkey").cast("string"), F.lit("a"), F.lit(None).cast("string")))
    return c.select("c_custkey", g.exit_code(F.col("s"), F.col("lenient")).alias("exit_code"), g.login_markers(F.col("code"), F.col("c_mktsegment")).alias("markers"), g.grew(F.lit(0), F.lit(0), F.col("t"), F.col("c_nationkey"), 100, 20).alias("grew"), ids.alias("ids"))


_T8 = ("p_partkey", "p_size", "'x var collapseExpandMap = {A:[\"c' || p_partkey || '\",\"e1\"], B2:[''x'', ], A:[\"z\",\"y' || p_size || '\"]}; y' AS x", "p_name || chr(10) || ' first ' || chr(10) || 'Close' || chr(10) || chr(10) || p_type AS body")


@query("SELECT p_partkey, 'z' AS expanded, 'y' || p_size AS collapsed, 2 AS n_groups, 'first' || chr(10) || p_type AS body FROM part")
def collapse_maps(spark, sf_dir):
    """PARSE-18, PARSE-20, PARSE-30."""
    rows = _inputs(spark, sf_dir, "part", *_T8).withColumn("m", g.collapse_map(F.col("x")))
    pair = g.collapse_pair(F.col("m"), F.lit("A"))
    return rows.select("p_partkey", pair["expanded"].alias("expanded"), pair["collapsed"].alias("collapsed"), F.size("m").alias("n_groups"), g.popup_body(F.col("body")).alias("body"))


_T9 = ("p_partkey", "p_size", "'x M-' || p_size || CASE p_partkey % 2 WHEN 0 THEN ' ORG ' ELSE repeat(' y', 20) END || ' M' || (p_size + 3) || CASE p_partkey % 3 WHEN 0 THEN ' org' ELSE ' discharge' END AS x")


@query(f"SELECT p_partkey, p_partkey % 2 = 0 OR p_partkey % 3 = 0 AS is_guideline, CASE WHEN p_partkey % 2 = 0 THEN {_PAD.format('p_size')} WHEN p_partkey % 3 = 0 THEN {_PAD.format('(p_size + 3)')} ELSE {_PAD.format('p_size')} END AS code, p_partkey % 3 <> 0 AS critical, p_partkey % 3 <> 0 AS probe FROM part")
def page_probes(spark, sf_dir):
    """FN-17, FN-20, FN-27, FN-35."""
    x, none = F.col("x"), F.lit("")
    return _inputs(spark, sf_dir, "part", *_T9).select("p_partkey", g.is_guideline(x, none, none).alias("is_guideline"), g.primary_code(x).alias("code"), g.has_terms(x, ["admission", "discharge"]).alias("critical"), g.probe_flags(x, ["admission", "discharge"])["discharge"].alias("probe"))


_T10 = ("p_partkey", "CASE WHEN p_size % 2 = 0 THEN p_type END AS m", "CASE WHEN p_size % 4 < 2 THEN '>' ELSE 'IS_TRUE' END AS op", "CASE WHEN p_partkey % 3 > 0 THEN p_size::{} END AS v", "CASE WHEN p_size % 3 = 0 THEN 'mm' ELSE '' END AS u", "CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'pediatric_x' ELSE 'k' || p_size END AS k", "p_name AS x", "p_size")
_T10S, _T10D = [tuple(c.format(t) for c in _T10) for t in ("STRING", "VARCHAR")]


@query(
    f"""SELECT p_partkey, CASE WHEN m IS NOT NULL AND v IS NOT NULL THEN m || ' ' || op || ' ' || v || CASE WHEN u <> '' THEN ' ' || u ELSE '' END WHEN k <> '' THEN k ELSE x END AS atom, '[atomic / ' || op || CASE WHEN k <> '' THEN ' / ' || k ELSE '' END || '] ' || x AS label,
  CASE WHEN p_size % 5 = 0 THEN 'true' ELSE v END AS traced, coalesce(v = '7', false) AS seven, op = '>' AND v IS NOT NULL AS minimal, k = 'pediatric_x' AS pediatric FROM {_from('part', *_T10D)}"""
)
def rule_labels(spark, sf_dir):
    """FN-12, FN-13, FN-52, FN-55, CLS-3, CLS-4."""
    c = F.col
    rows = _inputs(spark, sf_dir, "part", *_T10S)
    return rows.select("p_partkey", g.atom_label(c("m"), c("op"), c("v"), c("u"), c("k"), c("x"), F.lit("id")).alias("atom"), g.node_label(F.lit("atomic"), c("op"), c("k"), c("x")).alias("label"), g.trace_value(F.when(c("p_size") % 5 == 0, True), c("v")).alias("traced"), g.equal_number(c("v"), F.lit(7.0)).alias("seven"), g.is_numeric_minimal(F.lit("atomic"), c("op"), c("v").cast("double")).alias("minimal"), g.is_pediatric(c("k"), c("x")).alias("pediatric"))


# ---- trees -----------------------------------------------------------------------------------------------------

_TOP = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Examples include these: (1) [A]' WHEN 'AUTOMOBILE' THEN 'The OPTIONS include one' WHEN 'FURNITURE' THEN 'As indicated by this' WHEN 'MACHINERY' THEN '1 or more of the following' ELSE 'Customer' END"
_HEAD = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '1 or more of the following' WHEN '2' THEN 'All of the following' WHEN '3' THEN 'Examples include these' WHEN '4' THEN 'May include these' ELSE 'Order' END"
_LEAF = "'item ' || l_partkey % 50 || CASE WHEN l_returnflag = 'R' THEN ' returned' ELSE '' END"


def _source(spark, sf_dir):
    """Customers, their orders and the orders' lines as a source tree of three levels."""
    tops = _inputs(spark, sf_dir, "customer", "'c' || c_custkey AS id", "cast(NULL AS string) AS parent", f"{_TOP} AS text", "cast(0 AS bigint) AS ord")
    heads = _inputs(spark, sf_dir, "orders", "'o' || o_orderkey AS id", "'c' || o_custkey AS parent", f"{_HEAD} AS text", "cast(o_orderkey AS bigint) AS ord")
    lines = _inputs(spark, sf_dir, "lineitem", "'o' || l_orderkey || '.' || l_linenumber AS id", "'o' || l_orderkey AS parent", f"{_LEAF} AS text", "cast(l_linenumber AS bigint) AS ord")
    return tops.unionByName(heads).unionByName(lines.groupBy("id", "parent", "ord").agg(F.min("text").alias("text")))  # line numbers repeat


_SOURCE = f"source AS (SELECT 'c' || c_custkey AS id, NULL::VARCHAR AS parent, {_TOP} AS text, 0::BIGINT AS ord FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, {_HEAD}, o_orderkey FROM orders UNION ALL SELECT 'o' || l_orderkey || '.' || l_linenumber, 'o' || l_orderkey, min({_LEAF}), l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber)"
_OP = "CASE substr(s.text, 1, 3) WHEN '1 o' THEN 'OR' WHEN 'All' THEN 'AND' WHEN 'Exa' THEN 'EXAMPLE_SET' WHEN 'May' THEN 'OPTIONS' WHEN 'The' THEN 'OPTIONS' WHEN 'As ' THEN 'criteria_intro' ELSE 'CHECKLIST' END"
_LOGIC = f"""{_SOURCE}, kinds AS (SELECT s.*, s.id IN (SELECT parent FROM source WHERE parent IS NOT NULL) AS inner_node, {_OP} AS hinted FROM source s),
logic AS (SELECT s.id, s.parent, coalesce(g.id, p.id, s.id) AS root, CASE WHEN p.id IS NULL THEN 0 WHEN g.id IS NULL THEN 1 ELSE 2 END AS depth, CASE WHEN s.inner_node THEN 'composite' ELSE 'atomic' END AS kind, CASE WHEN s.inner_node THEN s.hinted ELSE 'IS_TRUE' END AS operator,
  CASE WHEN NOT s.inner_node THEN 'leaf_o1_' || sha256(s.id)[1:16] END AS key, CASE WHEN s.inner_node THEN s.hinted = 'EXAMPLE_SET' ELSE coalesce(p.hinted = 'EXAMPLE_SET', false) OR coalesce(g.hinted = 'EXAMPLE_SET', false) END AS example_only, s.text, coalesce(p.ord, 0) AS ord1, s.ord
  FROM kinds s LEFT JOIN kinds p ON s.parent = p.id LEFT JOIN kinds g ON p.parent = g.id)"""


@query(f"WITH {_LOGIC} SELECT id, parent, root, depth, kind, operator, key, example_only, NOT example_only AS strict FROM logic")
def tree_logic_nodes(spark, sf_dir):
    """TREE-3 to TREE-6, TREE-10, TREE-22."""
    return build.logic_nodes(_source(spark, sf_dir), "O-1").drop("text", "place")


@query(f"WITH {_SOURCE} SELECT 'sr.' || sha256(lower(text))[1:14] AS ref_id, arg_min(id, (ord, id)) AS first_id, count(*) AS uses FROM source GROUP BY lower(text)")
def tree_ref_registry(spark, sf_dir):
    """TREE-2, JOIN-23."""
    return build.ref_registry(_source(spark, sf_dir)).select("ref_id", "first_id", "uses")


@query(f"WITH {_LOGIC} SELECT l.id, coalesce(l.key, replace(l.id, '.', '_') || '_composite') AS condition_key, CASE WHEN l.kind = 'composite' THEN 'composite' WHEN substr(l.root, length(l.root)) NOT IN ('1', '3', '5') THEN 'atomic_fact' WHEN p.operator = 'OPTIONS' THEN 'option' ELSE 'checklist_item' END AS role, p.operator AS parent_operator FROM logic l LEFT JOIN logic p ON l.parent = p.id")
def tree_dictionary(spark, sf_dir):
    """TREE-12: trees of some customers are discharge trees."""
    nodes = build.logic_nodes(_source(spark, sf_dir), "O-1").withColumn("domain", F.when(F.substring("root", -1, 1).isin("1", "3", "5"), "M1.discharge_planning").otherwise("M1.admission"))
    return build.dictionary(nodes)


@query(f"WITH {_LOGIC} SELECT 'synthetic text' AS check_id, id FROM logic WHERE text = 'item 7' UNION ALL SELECT 'strict example', id FROM logic WHERE operator = 'EXAMPLE_SET'")
def tree_hygiene(spark, sf_dir):
    """TREE-13: example sets count as strict here, as their flag is taken out."""
    nodes = build.logic_nodes(_source(spark, sf_dir), "O-1").withColumn("strict", F.col("operator") == "EXAMPLE_SET")
    return build.hygiene(nodes.withColumn("example_only", F.col("operator") == "EXAMPLE_SET"), ["item 7"])


@query(f"WITH {_LOGIC} SELECT root, string_agg(repeat('  ', depth) || CASE kind WHEN 'atomic' THEN '[atomic] ' ELSE '[' || operator || '] ' END || CASE WHEN text LIKE 'Exa%(1)%' THEN 'Examples include these: )' ELSE text END, chr(10) ORDER BY CASE depth WHEN 0 THEN 0 WHEN 1 THEN ord ELSE ord1 END, depth, ord) AS text FROM logic GROUP BY root")
def tree_indented(spark, sf_dir):
    """TREE-14 to TREE-16."""
    nodes = build.logic_nodes(_source(spark, sf_dir), "O-1")
    return build.indented(nodes.withColumn("line", build.tree_line(F.col("kind"), F.col("operator"), F.lit(None).cast("string"), F.col("text"))))


@query(f"WITH {_LOGIC} SELECT 'unknown reference' AS check_id, id FROM logic WHERE text LIKE '%returned' UNION ALL SELECT 'unknown parent', id FROM logic WHERE operator <> 'OPTIONS' AND parent IN (SELECT id FROM logic WHERE operator = 'OPTIONS')")
def validate_logic_nodes(spark, sf_dir):
    """VAL-9: with references of returned items and the option groups taken out."""
    nodes = build.logic_nodes(_source(spark, sf_dir), "O-1").withColumn("ref_id", F.sha1("text"))
    refs = nodes.where("NOT text LIKE '%returned'").select("ref_id").distinct()
    options = F.col("operator") != "OPTIONS"
    return build.logic_checks(nodes.where(options), refs)


@query("SELECT c_custkey AS id, 'op' AS field FROM customer WHERE c_nationkey % 4 = 1 AND c_acctbal > 0 UNION ALL SELECT c_custkey, 'id' FROM customer WHERE c_nationkey % 4 = 2")
def validate_sentinels(spark, sf_dir):
    """VAL-19: expected atoms that are missing or differ."""
    c = table(spark, sf_dir, "customer")
    expected = c.selectExpr("c_custkey AS id", "c_mktsegment AS key", "'>' AS op")
    atoms = c.where("c_nationkey % 4 <> 2").selectExpr("c_custkey AS id", "c_mktsegment AS key", "CASE WHEN c_nationkey % 4 = 1 AND c_acctbal > 0 THEN '<' ELSE '>' END AS op")
    return build.sentinels(atoms, expected, ["key", "op"])


@query("SELECT o_orderkey AS id FROM orders WHERE NOT ((o_orderstatus = 'F' AND o_orderkey % 3 <> 0) OR (o_orderstatus = 'O' AND o_orderkey % 5 <> 0))")
def validate_condition_roots(spark, sf_dir):
    """VAL-20."""
    rows = _inputs(spark, sf_dir, "orders", "o_orderkey AS id", "CASE o_orderstatus WHEN 'F' THEN 'composite' WHEN 'O' THEN 'atomic' END AS type", "CASE WHEN o_orderstatus = 'F' THEN 'c' ELSE '' END AS root_composite", "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'a' WHEN o_orderstatus = 'O' AND o_orderkey % 5 <> 0 THEN 'a' END AS root_atomic")
    return build.root_consistency(rows)


# ---- definitions -----------------------------------------------------------------------------------------------


def stratified(key: str, fact: str, op: str, limits: list[tuple[str, float, bool]]) -> tuple[list, list]:
    """DEFN-1, DEFN-2, DEFN-6, DEFN-12: any of several limits of one number; those of a stratum (True) need a review."""
    atoms = [Atom(f"a.{key}.{name}", fact, "atomic_numeric", op, limit, review="needs_review" if review else "ok") for name, limit, review in limits]
    return atoms, [Composite(f"c.{key}", "OR", tuple(a.id for a in atoms), key=key)]


def flags(key: str, facts: list[str], op: str = "OR") -> tuple[list, list]:
    """DEFN-4, DEFN-11, DEFN-13: any, or all, of several facts."""
    atoms = [Atom(f"a.{key}.{f}", f) for f in facts]
    return atoms, [Composite(f"c.{key}", op, tuple(a.id for a in atoms), key=key)]


def paired_drops(key: str, drops: list[tuple[str, str, str, float]]) -> tuple[list, list]:
    """DEFN-3: any of several falls from one fact to another, as (name, from, to, least fall)."""
    atoms = [Atom(f"a.{key}.{name}", before, "atomic_numeric", ">=", fall, minus=after) for name, before, after, fall in drops]
    return atoms, [Composite(f"c.{key}", "OR", tuple(a.id for a in atoms), key=key)]


def placeholder(key: str) -> tuple[list, list]:
    """DEFN-9, DEFN-14: a definition that nobody has checked yet: one atom, in review."""
    return [Atom(f"a.{key}", key, review="needs_review")], [Composite(f"c.{key}", "OR", (f"a.{key}",), key=key)]


def definitions(*bundles: tuple[list, list], over: list[Composite]) -> Rules:
    """DEFN-5, DEFN-7, DEFN-8, DEFN-10, DEFN-17: bundles, conditions over their roots, and a path for each condition."""
    atoms, composites = [a for b in bundles for a in b[0]], [*(c for b in bundles for c in b[1]), *over]
    keys = [c.key for c in composites]
    return Rules(atoms=atoms, composites=composites, nodes=[Node(f"n.{k}", key=k) for k in keys], paths=[(k, f"n.{k}") for k in keys], links={c.key: c.id for c in composites})


DEFINITIONS = definitions(
    stratified("rich", "acctbal", ">", [("any", 8000.0, False), ("building", 5000.0, True)]), stratified("poor", "acctbal", "<", [("any", 0.0, False)]),
    stratified("large", "max_order_price", ">=", [("any", 200000.0, False)]), flags("known", ["has_orders", "segment_building"], "AND"), placeholder("odd"),
    over=[Composite("c.unstable", "AND", ("c.poor", "c.large"), key="unstable"), Composite("c.notable", "OR", ("c.unstable", "c.rich", "c.known"), key="notable")],
)


def _definition_sql() -> str:
    t = "CASE WHEN coalesce({}, false) THEN 2 ELSE 0 END"
    made = f"SELECT case_id, greatest({t.format('bal > 8000')}, 1) AS rich, {t.format('bal < 0')} AS poor, {t.format('mx >= 200000')} AS large, {t.format('n IS NOT NULL AND seg')} AS known, 1 AS odd FROM facts"
    more = "SELECT *, least(poor, large) AS unstable FROM made"
    last = "SELECT *, greatest(unstable, rich, known) AS notable FROM more"
    keys = ["rich", "poor", "large", "known", "odd", "unstable", "notable"]
    facts = _FACTS.split(",\natoms AS")[0]
    return f"WITH {facts}, made AS ({made}), more AS ({more}), done AS ({last}) " + " UNION ALL ".join(f"SELECT case_id, '{k}' AS path_id, {_NAME.format(k)} AS verdict FROM done" for k in keys)


@query(_definition_sql())
def definition_bundles(spark, sf_dir):
    """DEFN-1 to DEFN-14, DEFN-17: numbers with strata, flags, placeholders and conditions over conditions, from rules tables."""
    return evaluate.path_verdicts(DEFINITIONS, evaluate.compiled(DEFINITIONS, _wide(spark, sf_dir))).select("case_id", "path_id", "verdict")


DROPS = definitions(
    paired_drops("fall", [("price", "first_price", "last_price", 50000.0), ("debt", "last_price", "acctbal", 250000.0)]), paired_drops("rise", [("price", "last_price", "first_price", 100000.0)]), flags("known", ["has_orders"]),
    over=[Composite("c.swing", "OR", ("c.fall", "c.rise"), key="swing"), Composite("c.sure", "AND", ("c.swing", "c.known", "c.nowhere"), key="sure")],
)
_DROPS_SQL = """WITH priced AS (SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS p, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS q, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT c_custkey AS case_id, greatest(CASE WHEN coalesce(p - q >= 50000, false) THEN 2 ELSE 0 END, CASE WHEN coalesce(q - c_acctbal >= 250000, false) THEN 2 ELSE 0 END) AS fall, CASE WHEN coalesce(q - p >= 100000, false) THEN 2 ELSE 0 END AS rise, CASE WHEN n > 0 THEN 2 ELSE 0 END AS known FROM customer LEFT JOIN priced ON c_custkey = o_custkey),
u AS (SELECT *, greatest(fall, rise) AS swing FROM t), v AS (SELECT *, least(swing, known, 1) AS sure FROM u)
"""


def _priced(spark, sf_dir):
    """First and last price, balance and flag of every customer."""
    at = F.struct("o_orderdate", "o_orderkey")
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_totalprice", at).alias("n_first_price"), F.max_by("o_totalprice", at).alias("n_last_price"))
    both = table(spark, sf_dir, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return both.select(F.col("c_custkey").alias("case_id"), "n_first_price", "n_last_price", F.col("c_acctbal").alias("n_acctbal"), F.when(F.col("o_custkey").isNotNull(), True).alias("b_has_orders"))


@query(_DROPS_SQL + " UNION ALL ".join(f"SELECT case_id, '{k}' AS path_id, {_NAME.format(k)} AS verdict FROM v" for k in ("fall", "rise", "known", "swing", "sure")))
def definition_paired_drops(spark, sf_dir):
    """DEFN-3: falls and rises between two facts of every customer, and conditions over them, by the compiled evaluator."""
    return evaluate.path_verdicts(DROPS, evaluate.compiled(DROPS, _priced(spark, sf_dir))).select("case_id", "path_id", "verdict")


@query(_DROPS_SQL + " UNION ALL ".join(f"SELECT case_id, 'n.{k}' AS id, {k}::INT AS trit FROM v" for k in ("fall", "rise", "known", "swing", "sure")))
def definition_paired_drops_long(spark, sf_dir):
    """DEFN-3, EVAL-3 to EVAL-9: the same over long facts by the relational evaluator."""
    wide = _priced(spark, sf_dir)
    number = lambda k: wide.where(F.col(f"n_{k}").isNotNull()).select("case_id", F.lit(k).alias("condition_key"), F.lit("num").alias("fact_kind"), F.lit(None).cast("boolean").alias("b"), F.col(f"n_{k}").alias("n"))
    facts = number("first_price").unionByName(number("last_price")).unionByName(number("acctbal"))
    facts = facts.unionByName(wide.where("b_has_orders").select("case_id", F.lit("has_orders").alias("condition_key"), F.lit("bool").alias("fact_kind"), F.lit(True).alias("b"), F.lit(None).cast("double").alias("n")))
    done = evaluate.relational(DROPS, facts, wide.select("case_id"))
    return done.where(F.col("id").startswith("n.")).select("case_id", "id", "trit")


@query("SELECT conv_id, bool_or(role = 'user' AND contains(lower(text), 'the')) AS first_gate, bool_or(contains(lower(text), 'the')) AND bool_or(contains(lower(text), 'and')) AS both_gates FROM conversations GROUP BY 1")
def definition_triggers(spark, sf_dir):
    """DEFN-15, DEFN-16: which texts ask for a definition; the parts of a text are tested one by one, so no text is put together."""
    low = F.lower("text")
    gate = lambda c: F.coalesce(F.bool_or(c), F.lit(None))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(gate((F.col("role") == "user") & low.contains("the")).alias("first_gate"), (gate(low.contains("the")) & gate(low.contains("and"))).alias("both_gates"))


# ---- audits ----------------------------------------------------------------------------------------------------


@query("SELECT coalesce(bool_or(l_quantity > 49), false) AS has_large, coalesce(bool_or(l_discount > 2), false) AS has_odd, coalesce(bool_or(l_returnflag = 'R' AND l_linestatus = 'F'), false) AS has_returned FROM lineitem")
def audit_definition_flags(spark, sf_dir):
    """AGG-6."""
    c = F.col
    return build.definition_flags(table(spark, sf_dir, "lineitem"), {"has_large": c("l_quantity") > 49, "has_odd": c("l_discount") > 2, "has_returned": (c("l_returnflag") == "R") & (c("l_linestatus") == "F")})


_LINK = "(SELECT d.doc_id, d.lang, d.source, d.n_chars > 1000 AS leaf, d.lang IS NOT NULL AS named, l.doc_id IS NOT NULL AS linked FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"


def _linked(spark, sf_dir):
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k")).distinct()
    d = table(spark, sf_dir, "documents")
    return d.join(known, d["doc_id"] == known["k"], "left").select("doc_id", "lang", "source", (F.col("n_chars") > 1000).alias("leaf"), F.col("lang").isNotNull().alias("named"), F.col("k").isNotNull().alias("linked"))


_LEAVES = "SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 'leaf_m1_' || d.doc_id WHEN d.doc_id % 3 = 1 THEN 'named_' || d.doc_id END AS key, coalesce(substr(lower(text), 1, 40), '') AS head, toxic, CASE WHEN quality = 1 THEN 'linked_shared_definition' WHEN quality = 0 THEN 'linked_shared_atomic_definition' ELSE 'unlinked' END AS status FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id"


@query(
    f"""WITH rows AS ({_LEAVES}), titles AS (SELECT DISTINCT head FROM rows WHERE toxic = 1 AND head <> ''), hashed AS (SELECT * FROM rows WHERE starts_with(key, 'leaf_m1_'))
    SELECT *, missing = 0 AND NOT says_the AND NOT says_none AS ready FROM (SELECT (SELECT count(*) FROM rows) AS leaves, (SELECT count(*) FROM hashed) AS hashed, (SELECT count(*) FROM rows WHERE starts_with(key, 'named_')) AS named, (SELECT count(*) FROM rows WHERE status = 'linked_shared_definition') AS linked,
    (SELECT count(*) FROM rows WHERE status = 'linked_shared_atomic_definition') AS linked_atomic, (SELECT count(*) FROM rows WHERE status = 'unlinked') AS unlinked, (SELECT count(*) FROM hashed WHERE head IN (FROM titles)) AS missing, (SELECT coalesce(bool_or(contains(head, 'the ')), false) FROM hashed) AS says_the, (SELECT coalesce(bool_or(contains(head, '%%%%')), false) FROM hashed) AS says_none)"""
)
def audit_linkage_summary(spark, sf_dir):
    """AGG-9, AGG-10, AGG-13: documents as leaves; the headlines of toxic ones are the definitions' titles."""
    per = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").join(per, "doc_id", "left").selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN 'leaf_m1_' || doc_id WHEN doc_id % 3 = 1 THEN 'named_' || doc_id END AS key", "coalesce(substr(lower(text), 1, 40), '') AS head", "toxic", "CASE WHEN quality = 1 THEN 'linked_shared_definition' WHEN quality = 0 THEN 'linked_shared_atomic_definition' ELSE 'unlinked' END AS status")
    return build.linkage_summary(rows, rows.where("toxic = 1"), "M1", {"says_the": "the ", "says_none": "%%%%"})


@query(f"SELECT source, count(*) AS n, count(*) FILTER (leaf) AS leaves, count(*) FILTER (leaf AND NOT linked) AS unlinked_leaves, greatest(0, count(*) - count(*) FILTER (linked)) AS \"left\" FROM {_LINK} GROUP BY 1")
def audit_dashboard(spark, sf_dir):
    """AGG-7, AGG-8, AGG-12."""
    return build.dashboard(_linked(spark, sf_dir), "source", {"leaves": F.col("leaf"), "unlinked_leaves": F.col("leaf") & ~F.col("linked")}, F.col("linked"))


@query(f"SELECT doc_id, CASE WHEN lang IS NULL THEN 'no name' WHEN source = 'src0' THEN 'known source' ELSE 'no definition' END AS diagnosis, coalesce(p.quality, -1)::INT AS prior FROM {_LINK} u LEFT JOIN (SELECT doc_id AS k, max(quality) AS quality FROM labels GROUP BY 1) p ON p.k = u.doc_id - 1 WHERE leaf AND NOT linked")
def audit_unlinked(spark, sf_dir):
    """AGG-5, JOIN-18, JOIN-21: unlinked leaves with a diagnosis and what an earlier audit said."""
    prior = table(spark, sf_dir, "labels").groupBy((F.col("doc_id") + 1).alias("doc_id")).agg(F.max("quality").alias("quality"))
    rows = _linked(spark, sf_dir).where("leaf AND NOT linked").join(prior, "doc_id", "left")
    diagnosis = F.when(F.col("lang").isNull(), "no name").when(F.col("source") == "src0", "known source").otherwise("no definition")
    return rows.select("doc_id", diagnosis.alias("diagnosis"), F.coalesce("quality", F.lit(-1)).cast("int").alias("prior"))


@query("SELECT user_id, reached::INT AS reached, CASE reached WHEN 0 THEN 'capture' WHEN 1 THEN 'parse' WHEN 2 THEN 'link' END AS halted, CASE reached WHEN 0 THEN ['failed: capture'] WHEN 1 THEN ['failed: parse'] WHEN 2 THEN ['failed: link'] ELSE [] END AS errors, reached = 3 AS ready FROM (SELECT user_id, CASE WHEN x >= 4 THEN 0 WHEN p = 0 THEN 1 WHEN m < 30 THEN 2 ELSE 3 END AS reached FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS x, count(*) FILTER (event_type = 'purchase') AS p, max(value) AS m FROM events GROUP BY 1))")
def stage_status(spark, sf_dir):
    """ORC-1, ORC-2, ORC-12, VAL-33."""
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("x"), F.count_if(F.col("event_type") == "purchase").alias("p"), F.max("value").alias("m"))
    return build.stage_rows(e, [("capture", F.col("x") < 4), ("parse", F.col("p") > 0), ("link", F.col("m") >= 30)], "user_id")


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 99 END, CASE WHEN o_orderkey % 4 = 0 THEN 9999 ELSE o_orderkey % 7 END, o_orderkey)::INT AS n FROM orders")
def path_order(spark, sf_dir):
    """SORT-2, SORT-3, RANK-9: a number for each path of a group."""
    rows = _inputs(spark, sf_dir, "orders", "o_custkey AS group", "o_orderstatus AS domain", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 7 END AS sort_order", "o_orderkey AS id")
    return build.path_order(rows, ["O", "F"]).select(F.col("group").alias("o_custkey"), F.col("id").alias("o_orderkey"), "n")


@query(f"SELECT c.case_id, c.passed, t.shown FROM ({SQL['eval_case_check']}) c JOIN (SELECT case_id, string_agg(id || ' ' || result, '; ' ORDER BY ord) AS shown FROM ({SQL['eval_trace']}) WHERE ord < 12 GROUP BY 1) t USING (case_id)")
def eval_case_report(spark, sf_dir):
    """EVAL-13: each case's verdict and the first twelve rows of its trace."""
    return build.case_report(eval_case_check(spark, sf_dir), eval_trace(spark, sf_dir))
