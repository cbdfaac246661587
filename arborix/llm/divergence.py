"""Source divergence audit: how far each source of a language lies from its other sources and from the language.

Terms are counted where texts are read and added up over the cluster. The sources of a language are dealt to seats, the seats'
counts to blocks of terms; a cell (language, block, seat) holds its sources' sparse counts as one compressed row. Cells stay in
the buckets of a saved table. In each round of a round-robin tournament half of the seats send their cells to the seats they
meet, so every two seats meet once, and each meeting evaluates both directions. In the round at home the sources of one seat
meet each other, and the language's own counts visit every seat: heaps of each cell keep its best terms. What blocks found is
added up in the end.

All arithmetic is in whole numbers: with N occurrences of the V kept terms, a term that a group has c times has the share
p = 1 + floor(scale * (c + 1) / (N + V)), and f(p, q) = floor((p - q)^2 / q).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, portions, trim

SCALE = 1_000_000_000
#: Letters a-z, A-Z (lowered) and all bytes beyond ASCII make terms; the rest parts them.
_FOLD = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_LONG = 1 << 24


def _terms(raw: bytes):
    """The terms of a text in lists, a few million bytes at a time."""
    if len(raw) <= _LONG:
        yield raw.translate(_FOLD).split()
        return
    at = 0
    while at < len(raw):  # cut where a term ends
        end = at + _LONG
        if end < len(raw) and (m := re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]").search(raw, end)):
            end = m.start()
        elif end < len(raw):
            end = len(raw)
        yield raw[at:end].translate(_FOLD).split()
        at = end


def counted(most: int = 400_000):
    """Arrow function: (lang, source, term, occurrences, documents) of what a task reads, handed on whenever `most` terms are held."""

    def table(held):
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for a in range(0, len(terms), 50_000):
                own = terms[a : a + 50_000]
                columns = [pa.array([lang] * len(own), pa.string()), pa.array([source] * len(own), pa.string()), pa.array(own, pa.binary()).cast(pa.string()), pa.array([n[t] for t in own], pa.int64()), pa.array([docs[t] for t in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def work(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in portions(batches):
            names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for name, text in zip(names, batch.column("text"), strict=True):
                n, docs = held.setdefault(name, (Counter(), Counter()))
                own: set[bytes] = set()
                for terms in _terms(text.as_py()):
                    n.update(terms)
                    own.update(terms)
                docs.update(own)
            if sum(len(n) for n, _ in held.values()) > most:
                yield from table(held)
                held.clear()
        yield from table(held)
        held.clear()
        trim()

    return work


def shares(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(scale * (count + 1) / total), in three steps of a thousand so that nothing exceeds 64 bits."""
    rest = count.astype(np.int64) + 1
    out = rest // total
    rest -= out * total
    for _ in range(3):
        rest *= 1000
        step = rest // total
        rest -= step * total
        out = out * 1000 + step
    return out + 1


def gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def packed(numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray, totals: dict[int, int]) -> bytes:
    """The counts of a cell's sources: their numbers, totals (N + V) and places, then each source's ids as steps, and its counts."""
    order = np.lexsort((ids, numbers))
    numbers, ids, counts = numbers[order], ids[order], counts[order]
    names = np.array(sorted(totals), np.int64)
    edges = np.searchsorted(numbers, np.append(names, np.iinfo(np.int64).max))
    steps = np.diff(ids, prepend=0)
    inner = edges[:-1][edges[:-1] < len(ids)]
    steps[inner] = ids[inner]  # each source starts anew
    head = np.concatenate(([len(names), len(ids)], names, [totals[k] for k in names.tolist()], edges)).astype("<i8")
    return zlib.compress(head.tobytes() + steps.astype("<u4").tobytes() + counts.astype("<i8").tobytes(), 1)


def unpacked(cell: bytes):
    """(number, total, ids, counts) of each source of a cell."""
    raw = zlib.decompress(cell)
    k, n = np.frombuffer(raw, "<i8", 2).tolist()
    names, totals, edges = np.split(np.frombuffer(raw, "<i8", 3 * k + 1, 16), [k, 2 * k])
    at = 16 + 8 * (3 * k + 1)
    steps, counts = np.frombuffer(raw, "<u4", n, at).astype(np.int64), np.frombuffer(raw, "<i8", n, at + 4 * n)
    return [(int(name), int(total), np.cumsum(steps[a:b]), counts[a:b]) for name, total, a, b in zip(names, totals, edges[:-1], edges[1:], strict=True)]


def meet(residents, guests, width: int, both: bool):
    """(resident, guest, value, back) for each two sources of two cells, of one cell if not both: sums over the block's terms that either has,
    of what a term adds beyond f of two zero counts."""
    share, seen = np.zeros(width, np.int64), np.zeros(width, bool)
    known = [(name, total, ids, shares(counts, total), int(shares(np.zeros(1, np.int64), total)[0])) for name, total, ids, counts in guests]
    for name, total, ids, counts in residents:
        p, base = shares(counts, total), int(shares(np.zeros(1, np.int64), total)[0])
        share[:] = base
        share[ids] = p
        for other, _, far, q, far_base in known:
            if not both and other <= name:
                continue
            here = share[far]
            seen[far] = True
            alone = p[~seen[ids]]
            seen[far] = False
            n, zero, far_zero = len(far) + len(alone), np.int64(base), np.int64(far_base)
            there = int(gain(here, q).sum()) + int(gain(alone, far_zero).sum()) - n * int(gain(zero, far_zero))
            back = int(gain(q, here).sum()) + int(gain(far_zero, alone).sum()) - n * int(gain(far_zero, zero))
            yield name, other, there, back


def best(residents, language, top: int):
    """(source, id, value) of the `top` terms of each resident that it uses more than the language does, by value, then by id."""
    (_, total, ids, counts), = language
    q_of = shares(counts, total)
    for name, own, mine, held in residents:
        p, q = shares(held, own), q_of[np.searchsorted(ids, mine)]
        above = np.flatnonzero(p > q)
        value = gain(p[above], q[above])
        order = np.lexsort((mine[above], -value))[:top]
        for k in order.tolist():
            yield name, int(mine[above[k]]), int(value[k])


_FOUND = "lang string, block int, source int, other int, id int, value long"


def _meeting(top: int, at_home: bool):
    """Arrow function over rows (lang, block, width, cell, guest): a row for each direction of each two sources, at home also each source's best terms."""

    def work(batches):
        for batch in batches:
            for lang, block, width, cell, guest in zip(*(batch.column(c) for c in ("lang", "block", "width", "cell", "guest")), strict=True):
                own, other = unpacked(cell.as_py()), unpacked(guest.as_py())
                found = [(a, b, None, x) for a, b, v, w in meet(own, own if at_home else other, width.as_py(), not at_home) for a, b, x in ((a, b, v), (b, a, w))]
                if at_home:
                    found += [(a, None, k, v) for a, k, v in best(own, other, top)]
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    source, peer, ids, value = zip(*part, strict=True)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * n, pa.string()), pa.array([block.as_py()] * n, pa.int32()), pa.array(source, pa.int32()), pa.array(peer, pa.int32()), pa.array(ids, pa.int32()), pa.array(value, pa.int64())], ["lang", "block", "source", "other", "id", "value"])
        trim()

    return work


def _seated(key, table):
    """One cell from rows (number, total, id, n); rows without an id only name a source of the seat."""
    lang, block, seat = (k.as_py() for k in key)
    number, total = table.column("number").to_numpy(), table.column("total").to_numpy()
    there = table.column("id").is_valid().to_numpy(zero_copy_only=False)
    ids, n = (table.column(c).fill_null(0).to_numpy()[there] for c in ("id", "n"))
    cell = packed(number[there], ids.astype(np.int64), n.astype(np.int64), dict(zip(number.tolist(), total.tolist(), strict=True)))
    return pa.table([pa.array([lang], pa.string()), pa.array([block], pa.int32()), pa.array([seat], pa.int32()), pa.array([int(table.column("width")[0].as_py())], pa.int32()), pa.array([cell], pa.binary())], ["lang", "block", "seat", "width", "cell"])


def rounds(seats: int) -> list[list[tuple[int, int]]]:
    """The circle method: seat 0 stays, the others move on by one each round; every two seats meet once. Hosts take turns."""
    ring = list(range(seats + seats % 2))
    out = []
    for k in range(len(ring) - 1):
        pairs = [(ring[i], ring[-1 - i]) for i in range(len(ring) // 2)]
        out.append([p if k % 2 else p[::-1] for p in pairs if max(p) < seats])
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, seats: int = 6, cell_rows: int = 25_000) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (text, lang, source).

    Part `pair` has a row for each other source of the language, part `term` the `top` terms that the source uses more than its
    language. Null text, lang and source count as empty ones; texts without terms, repeated rows and very long texts are
    counted like others; a language without kept terms has pairs of value 0; ties go by the item's bytes; an empty table gives
    no row; further columns are ignored.

    A block has about `seats` x `cell_rows` rows (source, term) of a language, so a cell is bounded whatever a source holds."""
    scratch = Scratch(docs.sparkSession, "divergence")
    text, named = F.coalesce("text", F.lit("")).cast("binary").alias("text"), [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    rows = docs.select(text, *named)
    partial = rows.mapInArrow(counted(), _COUNTS)
    by_term = Window.partitionBy("lang", "term")
    counts = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = scratch.save(counts.withColumn("all_docs", F.sum("docs").over(by_term)).withColumn("all_n", F.sum("n").over(by_term)).where(F.col("all_docs") >= least_docs).withColumn("first", F.row_number().over(by_term.orderBy("source")) == 1).drop("docs", "all_docs"))

    of_lang = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_n"), F.count("*").alias("lang_rows"))
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = rows.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = scratch.save(
        groups.select("lang", "source", (F.row_number().over(in_lang) - 1).alias("number"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "v", "lang_n", "lang_rows")))
        .withColumn("total", F.col("n") + F.col("v"))
        .withColumn("blocks", F.ceil(F.col("lang_rows") / (seats * cell_rows)).cast("int"))
    )

    # Ids of terms in their block, in the terms' order; the language's own counts are a source of seat -1.
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    totals = groups.select("lang", "source", "number", "total", "blocks")
    in_block = Window.partitionBy("lang", "block")
    numbered = kept.join(totals, ["lang", "source"]).select("lang", block, "term", "number", "total", "n", "first", "all_n")
    numbered = numbered.withColumn("id", F.dense_rank().over(in_block.orderBy("term")) - 1).withColumn("width", F.max("id").over(in_block) + 1)
    numbered = scratch.save(numbered)
    seat = F.pmod("number", F.lit(seats)).alias("seat")
    langs = groups.where("number = 0").select("lang", (F.col("lang_n") + F.col("v")).alias("total"), "blocks")
    rows_of = [F.col("id"), F.col("n"), F.col("width")]
    own = numbered.select("lang", "block", seat, "number", "total", *rows_of)
    whole = numbered.where("first").join(langs.drop("blocks").withColumnRenamed("total", "lang_total"), "lang").select("lang", "block", F.lit(-1).alias("seat"), F.lit(-1).alias("number"), F.col("lang_total").alias("total"), "id", F.col("all_n").alias("n"), "width")
    widths = numbered.groupBy("lang", "block").agg(F.max("width").alias("width"))
    names = groups.select("lang", "number", "total").join(widths, "lang").select("lang", "block", seat, "number", "total", F.lit(None).cast("int").alias("id"), F.lit(0).cast("long").alias("n"), "width")
    cells = own.unionByName(whole).unionByName(names).groupBy("lang", "block", "seat").applyInArrow(_seated, "lang string, block int, seat int, width int, cell binary")
    place = lambda s: F.xxhash64("lang", "block", s)
    cells = scratch.save_by(cells.withColumn("place", place("seat")), "place")

    found = []
    home, visitor = cells.where("seat >= 0"), cells.where("seat < 0").select("lang", "block", F.col("cell").alias("guest"))
    at_home = home.join(visitor, ["lang", "block"])
    found.append(scratch.save(at_home.select("lang", "block", "width", "cell", "guest").mapInArrow(_meeting(top, True), _FOUND)))
    for pairs in rounds(seats):
        to = F.create_map(*(F.lit(x) for host, guest in pairs for x in (guest, host)))
        visitors = cells.where(F.col("seat").isin([g for _, g in pairs])).select("lang", "block", to[F.col("seat")].alias("seat"), F.col("cell").alias("guest"))
        visitors = visitors.withColumn("place", place("seat"))
        met = home.join(visitors, ["place", "lang", "block", "seat"]).select("lang", "block", "width", "cell", "guest")
        found.append(scratch.save(met.mapInArrow(_meeting(top, False), _FOUND)))

    values = found[0]
    for x in found[1:]:
        values = values.unionByName(x)
    beyond = values.where("other IS NOT NULL").groupBy("lang", F.col("source").alias("number"), F.col("other").alias("peer")).agg(F.sum("value").alias("beyond"))
    zero = lambda total: F.lit(1).cast("long") + F.expr(f"CASE WHEN {total} > 0 THEN {SCALE} DIV {total} ELSE 0 END")
    one = groups.select("lang", "source", "number", "v", zero("total").alias("p"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("peer"), zero("total").alias("q"))
    pairs = one.join(two, "lang").where("number != peer").join(beyond, ["lang", "number", "peer"], "left")
    value = F.col("v") * F.expr("((p - q) * (p - q)) DIV q") + F.coalesce("beyond", F.lit(0).cast("long"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    pairs = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))

    terms = numbered.where("first").select("lang", "block", "id", F.col("term").alias("item"))
    tops = found[0].where("id IS NOT NULL").select("lang", "block", F.col("source").alias("number"), "id", "value")
    tops = tops.join(terms, ["lang", "block", "id"]).join(groups.select("lang", "number", "source"), ["lang", "number"])
    tops = ranked(tops.select("lang", "source", F.lit("term").alias("part"), "item", "value")).where(F.col("rank") <= top)
    return pairs.unionByName(tops)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT lang, source, coalesce(v.v, 0) AS v, coalesce(sum(c.n), 0) + coalesce(v.v, 0) AS total FROM g LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source, v.v),
full_table AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // total AS p
    FROM groups JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
whole AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
whole_total AS (SELECT lang, sum(n) + count(*) AS total FROM whole GROUP BY lang),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // total AS q FROM whole JOIN whole_total USING (lang)),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN full_table x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN full_table y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM full_table JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
    FROM (FROM pair UNION ALL FROM term))
WHERE part = 'pair' OR rank <= 200
"""
