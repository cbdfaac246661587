"""Queries over parts of pages and matched texts, with their DuckDB forms. Markup that the pages lack is made from their own links and paragraphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import matching
from ..operators import passes, triggers
from ..sources.io import table
from .catalog import query

_A = '<a href="/([^"]*)">([^<]*)</a>'


def _with_triggers(spark, sf_dir):
    """All pages, their links by first letter: definitions, citations, footnotes, contexts; others stay links.

    Their texts show the links' markup as it is written, so references in it are no references here."""
    html = F.replace("html", F.lit("&"), F.lit("&amp;"))
    for letters, to in (
        ("[a-d]", r"""<a href="/$1" onclick="popup_definition('$1', 'About $1')">$2</a>"""),
        ("[e-h]", r"""<a href="#" class="x  y" onclick="return popup_citation(1, 'it\\'s $1, (so)', go(2, 3), )">$2</a>"""),
        ("[i-o]", r"""<span onclick="popup_footnote(&quot;$1&quot;)">$2<b>!</b></span>"""),
        ("[p-s]", r"""<td onclick="popup_the_context ($1); popup_x_context('$1')">$2</td>"""),
    ):
        html = F.regexp_replace(html, f'<a href="/({letters}[^"]*)">([^<]*)</a>', to)
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


_TRIGGERS = f"""links AS (SELECT page_id, regexp_extract(a, '{_A}', 1) AS h, trim(regexp_extract(a, '{_A}', 2)) AS t, i FROM (SELECT page_id, unnest(x) AS a, generate_subscripts(x, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '{_A}') AS x FROM pages))),
made AS (SELECT page_id, i, h, lower(t) AS t, CASE WHEN regexp_matches(h, '^[a-d]') THEN 1 WHEN regexp_matches(h, '^[e-h]') THEN 2 WHEN regexp_matches(h, '^[i-o]') THEN 3 WHEN regexp_matches(h, '^[p-s]') THEN 4 END AS k FROM links),
first AS (SELECT * FROM made WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY page_id, k, t, h ORDER BY i) = 1)"""


@query(
    f"""WITH {_TRIGGERS} SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS nth, ['a', 'a', 'span', 'td'][k] AS tag, CASE k WHEN 3 THEN t || ' !' ELSE t END AS text, CASE k WHEN 1 THEN '/' || h WHEN 2 THEN '#' ELSE '' END AS href,
    ['definition', 'citation', 'footnote', 'context'][k] AS popup_type, ['popup_definition', 'popup_citation', 'popup_footnote', 'popup_x_context'][k] AS handler, CASE k WHEN 1 THEN [h, 'About ' || h] WHEN 2 THEN ['1', 'it''s ' || h || ', (so)', 'go(2, 3)'] ELSE [h] END AS args FROM first"""
)
def popup_triggers(spark, sf_dir):
    """PARSE-29, PARSE-32, PARSE-33: triggers of all pages with their calls' types and arguments."""
    rows = triggers.page_parts(_with_triggers(spark, sf_dir)).where("part = 'trigger'")
    return rows.select("page_id", "nth", F.col("name").alias("tag"), "text", "href", "popup_type", "handler", "args")


def _with_lists(spark, sf_dir):
    """All pages, their first paragraphs' texts as references and footnotes under their headings."""
    texts = F.regexp_extract_all("html", F.lit("<p>([^<&]{3,})</p>"), F.lit(1))
    n = lambda i: i.cast("string")
    refs = F.transform(texts, lambda t, i: F.concat(F.lit("<li><b>"), t, F.lit('</b><a title="See Abstract">x</a> doi: 10.1/'), n(i), F.lit(". <a>view ABSTRACT of it</a>"), F.when(i % 2 == 0, F.concat(F.lit("[ Context Link A, ,"), n(i), F.lit(" ]"))).otherwise(""), F.lit("</li>")))
    notes = F.transform(texts, lambda t, i: F.concat(F.lit('<p class="MsoFootnoteText">[ N'), n(F.floor(i / 2)), F.lit(" ] "), t, F.lit(" ("), n(i), F.lit(")(7)</p><p>between</p>")))
    html = F.concat(F.lit("<body><h2>  References </h2>text<ol>"), F.array_join(refs, "\n"), F.lit("</ol><ol><li>other</li></ol><h2>Footnotes</h2>"), F.array_join(notes, " "), F.lit("<h2>End</h2>"))
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


@query(
    """WITH texts AS (SELECT page_id, trim(regexp_replace(unnest(x), '\\s+', ' ', 'g')) AS t, generate_subscripts(x, 1) - 1 AS i FROM (SELECT page_id, regexp_extract_all(html, '<p>([^<&]{3,})</p>', 1) AS x FROM pages))
    SELECT page_id, 'reference' AS part, (i + 1)::VARCHAR AS name, t || ' doi: 10.1/' || i || '.' || CASE WHEN i % 2 = 0 THEN ' [ Context Link A, ,' || i || ' ]' ELSE '' END AS text, '10.1/' || i AS doi, CASE WHEN i % 2 = 0 THEN ['A', i::VARCHAR] ELSE [] END AS list FROM texts
    UNION ALL SELECT page_id, 'footnote', 'N' || (i // 2), t || ' (' || i || ')(7)', NULL, list_concat(list_filter(regexp_extract_all(t, '\\((\\d+)\\)', 1), lambda x: true), [i::VARCHAR, '7']) FROM texts WHERE i % 2 = 0"""
)
def reference_lists(spark, sf_dir):
    """PARSE-26, PARSE-27: references with DOIs and context links, footnotes with the references they name."""
    rows = triggers.page_parts(_with_lists(spark, sf_dir)).where("part IN ('reference', 'footnote')")
    return rows.select("page_id", "part", "name", "text", F.col("href").alias("doi"), "list")


@query(
    """SELECT page_id, pos, nullif(last_value(nullif(own, '') IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), '') AS expands
    FROM (SELECT page_id, generate_subscripts(x, 1) - 1 AS pos, regexp_extract(unnest(x), '^([ACEIT][a-z]*)', 1) AS own FROM (SELECT page_id, string_split(html, '<p>') AS x FROM pages))"""
)
def expand_group_lookup(spark, sf_dir):
    """PARSE-19: the group before each paragraph of all pages, where some paragraphs' first words open one."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.split("html", "<p>")).alias("pos", "markup"))
    rows = rows.withColumn("markup", F.regexp_replace("markup", "^([ACEIT][a-z]*)", "<a onclick=\"ExpandAll('$1')\">all</a>"))
    return triggers.expand_groups(rows, ["page_id"], "pos", "markup", "expands").select("page_id", "pos", "expands")


_LETTERS = ("E", "I", "A")


@query(
    """WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')) AS x FROM documents),
    a AS (SELECT *, coalesce(list_position(list_transform(x, lambda y: starts_with(y, 'E')), true), 0) AS i FROM l),
    b AS (SELECT *, CASE WHEN i > 0 THEN i + coalesce(nullif(list_position(list_transform(x[i + 1:], lambda y: starts_with(y, 'I')), true), 0), -i) ELSE 0 END AS j FROM a),
    c AS (SELECT *, CASE WHEN j > 0 THEN j + coalesce(nullif(list_position(list_transform(x[j + 1:], lambda y: starts_with(y, 'A')), true), 0), -j) ELSE 0 END AS k FROM b)
    SELECT doc_id, list_transform(list_filter([i, j, k], lambda p: p > 0), lambda p: x[p]) AS taken, CASE WHEN i = 0 THEN 'E' WHEN j = 0 THEN 'I' WHEN k = 0 THEN 'A' END AS missing FROM c"""
)
def lines_in_order(spark, sf_dir):
    """FN-32: of every document the lines that start with three letters one after the other, and the first letter without one."""
    found = matching.lines_in_order(F.col("text"), F.array(*map(F.lit, _LETTERS)))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("f")).select("doc_id", "f.taken", "f.missing")


_NEAR = "doc_id, 'M' || lpad((doc_id % 150)::VARCHAR, 3, '0') AS code, translate(coalesce(text, ''), 'gG0123456789', 'kK') AS t"


@query(
    f"""SELECT doc_id, near, CASE WHEN hit THEN 'M token ' || digits END AS token FROM (SELECT doc_id, substr(code, 2) AS digits,
      strpos(substr(body, greatest(1, s - 48), s + 24 - greatest(1, s - 48)), 'ORG') > 0 OR strpos(substr(body, greatest(1, s + 2 - 40), s + 5 + 20 - greatest(1, s + 2 - 40)), 'ORG') > 0 OR strpos(substr(body, greatest(1, s - 40), s + 5 + 20 - greatest(1, s - 40)), 'ORG') > 0 AS near, true AS hit
      FROM (SELECT *, length(head) + 1 AS s, head || 'M-' || substr(code, 2) || ' ' || tail AS body FROM (SELECT doc_id, code, CASE WHEN doc_id % 2 = 0 THEN 'ORG ' || upper(substr(t, 1, (doc_id % 61)::INT)) || ' ' ELSE upper(substr(t, 1, 90)) || ' ' END AS head,
        CASE WHEN doc_id % 2 = 0 THEN upper(t) ELSE upper(substr(t, 91, (doc_id % 31)::INT)) || 'ORG' END AS tail FROM (SELECT {_NEAR} FROM documents))))"""
)
def codes_near_words(spark, sf_dir):
    """FN-21, FN-26: whether a word stands near each document's own code, with 0 to 60 characters of its text between, and whether the code is there at all."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id", "'M' || lpad(CAST(doc_id % 150 AS string), 3, '0') AS code", "translate(coalesce(text, ''), 'gG0123456789', 'kK') AS t")
    body = "CASE WHEN doc_id % 2 = 0 THEN 'ORG ' || substr(t, 1, CAST(doc_id % 61 AS int)) || ' M-' || substr(code, 2) || ' ' || t ELSE substr(t, 1, 90) || ' M-' || substr(code, 2) || ' ' || substr(t, 91, CAST(doc_id % 31 AS int)) || 'ORG' END AS body"
    rows = rows.selectExpr("doc_id", "code", body)
    token = F.get(F.filter(matching.code_markers(F.col("body"), F.col("code")), lambda x: x.startswith("M token")), F.lit(0))
    return rows.select("doc_id", matching.word_near_code(F.col("body"), F.col("code")).alias("near"), token.alias("token"))


@query("SELECT doc_id, CASE kind WHEN 'definition' THEN coalesce(d, h, l[1], 'Definition') WHEN 'citation' THEN coalesce(c, l[1], 'Citation') ELSE coalesce(l[1], 'Other Popup') END[1:400] AS title FROM (SELECT *, list_filter(l[1:12], lambda x: regexp_matches(x, '(?i)^definition\\b'))[1] AS d, list_filter(l[1:12], lambda x: length(x) >= 12 AND contains(x, ':') AND length(x) <= 200)[1] AS h, list_filter(l[1:8], lambda x: regexp_matches(x, '[0-9A-Za-z]'))[1] AS c FROM (SELECT doc_id, ['definition', 'citation', 'other_popup'][doc_id % 3 + 1] AS kind, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents WHERE text <> ''))")
def popup_titles(spark, sf_dir):
    """PARSE-31: titles of all documents taken as popups of three types."""
    kind = F.get(F.array(F.lit("definition"), F.lit("citation"), F.lit("other_popup")), (F.col("doc_id") % 3).cast("int"))
    return table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", triggers.popup_title(F.col("text"), kind).alias("title"))


_CLICKED = "[[], ['click'], ['timeout'], ['timeout', 'error', 'click'], ['error'], ['click', 'timeout'], ['click', 'click'], ['left'], ['click', 'cleared']]"
_KIND = "CASE WHEN l_partkey % 16 < 14 THEN l_partkey % 16 % 7 ELSE l_partkey % 16 - 7 END"


@query(
    f"""WITH RECURSIVE made AS (SELECT l_orderkey AS key, l_linenumber AS pass, l_shipdate AS ts, l_quantity::BIGINT % 2 AS t, (l_discount = 0)::BIGINT AS invoked, l_suppkey AS remaining, {_KIND} AS kind FROM lineitem WHERE l_linenumber <= 6),
    one AS (SELECT * FROM made QUALIFY row_number() OVER (PARTITION BY key, pass ORDER BY ts, t, invoked, remaining, {_CLICKED}[kind + 1]) = 1),
    p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pass) AS k FROM one),
    walk AS (SELECT DISTINCT key, 0::BIGINT AS k, 0 AS pass, 0::BIGINT AS streak, 0::BIGINT AS clicks, 0::BIGINT AS same, -1::BIGINT AS t, 0::BIGINT AS remaining, NULL::VARCHAR AS outcome FROM p
      UNION ALL SELECT key, k, pass, streak, clicks + n + invoked, same, t, remaining, CASE WHEN kind = 7 THEN 'aborted_unexpected_navigation' WHEN streak >= 2 THEN 'aborted_consecutive_timeouts' WHEN kind = 8 THEN 'ok'
          WHEN same >= 2 THEN 'stopped_stable_body' WHEN pass >= 6 THEN 'stopped_max_passes' WHEN n = 0 AND invoked = 0 AND t < 1 THEN 'stopped_no_progress' END
        FROM (SELECT key, k, pass, clicks, invoked, kind, t, remaining, same, streak, CASE WHEN kind IN (1, 5, 7) OR (kind = 3 AND streak < 2) THEN 1 WHEN kind IN (6, 8) THEN 2 ELSE 0 END AS n
          FROM (SELECT p.key, p.k, p.pass, w.clicks, p.invoked, p.kind, p.t, p.remaining, CASE WHEN p.t = w.t THEN w.same + 1 ELSE 0 END AS same,
              CASE WHEN p.kind IN (1, 6, 7, 8) THEN 0 WHEN p.kind = 5 THEN 1 WHEN p.kind = 2 THEN c + 1 WHEN p.kind = 3 THEN CASE WHEN c + 1 >= 2 THEN c + 1 ELSE 0 END ELSE c END AS streak
            FROM (SELECT w.*, CASE WHEN p.invoked > 0 THEN 0 ELSE w.streak END AS c FROM walk w JOIN p ON p.key = w.key AND p.k = w.k + 1 WHERE w.outcome IS NULL) w JOIN p ON p.key = w.key AND p.k = w.k + 1)))
    SELECT key, pass AS passes, clicks, coalesce(outcome, 'unfinished') AS outcome, t AS text, 0::BIGINT AS html, remaining FROM walk WHERE k > 0 QUALIFY row_number() OVER (PARTITION BY key ORDER BY k DESC) = 1"""
)
def pass_outcomes(spark, sf_dir):
    """ITER-1: every order's lines as passes, whose parts decide what the clicks did, and where and why they come to rest."""
    kinds = F.array(*[F.array(*map(F.lit, x)).cast("array<string>") for x in ([], ["click"], ["timeout"], ["timeout", "error", "click"], ["error"], ["click", "timeout"], ["click", "click"], ["left"], ["click", "cleared"])])
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("pass"), F.col("l_shipdate").alias("ts"), F.lit(0).alias("text_before"), F.lit(0).alias("html_before"), (F.col("l_quantity").cast("long") % 2).alias("text_after"), F.lit(0).alias("html_after"),
        (F.col("l_discount") == 0).cast("long").alias("invoked"), F.col("l_suppkey").alias("remaining"), F.get(kinds, F.expr(_KIND).cast("int")).alias("events"),
    )
    return passes.outcomes(rows, passes.Limits(passes=6))
