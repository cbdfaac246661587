"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

A mask keeps some places of a window of words and ignores the rest, so a substituted word at an
ignored place doesn't hide the window. The masked windows of benchmark items and documents are
hashed and joined; every hit fixes a diagonal (document place minus item place), and along it the
words of the item and of the document are compared one by one. A document is contaminated by an
item if on one diagonal there is a run in which `need` words agree and at least half of the words from
the first to the last of those; need is half of the item's words, at least 8 (all words of a shorter item)
and at most 13. A word that agrees by chance far from a passage is left out of its run. Items too short for a
mask have one seed of all their words; one of fewer than LEAST words is no passage, and only a document
that holds nothing else is contaminated by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places kept of a window; all masks span SPAN words.
MASKS = ((0, 1, 3, 5, 6), (0, 2, 3, 4, 6))
SPAN = 7
LEAST = 4
#: Most bytes of seeds, or of items, that are broadcast; more are joined by shuffles of places and hits, not of texts' windows.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _seeds(rows: DataFrame, keep: list[str], place: str, short: list[int], whole: bool) -> DataFrame:
    """keep, the place and a hash for each window and mask of the column words, and for windows of the short lengths.

    whole: short windows only where they are all words."""
    least = min([SPAN, *short])
    rows = rows.select(*keep, F.explode(F.when(F.size("words") >= least, F.sequence(F.lit(0), F.size("words") - least))).alias(place))
    at = lambda i: F.get("words", F.col(place) + i)
    hashes = [F.xxhash64(F.lit(k), *[at(i) for i in mask]) for k, mask in enumerate(MASKS)]
    if short:
        hashes = [F.when(F.col(place) + SPAN <= F.size("words"), h) for h in hashes]
    for n in short:
        fits = F.size("words") == n if whole or n < LEAST else F.col(place) + n <= F.size("words")
        hashes.append(F.when(fits, F.xxhash64(F.lit(100 + n), *[at(i) for i in range(n)])))
    out = rows.select(*keep, place, F.explode(F.array(*hashes)).alias("seed"))
    return out.where(F.col("seed").isNotNull()) if short else out


def _longest_run(same: Column) -> Column:
    """(n, a): of the runs of agreeing words in which at least half of the words agree that of most words, the first on a tie.

    With h(i) = 2 i - same[i] the words a to b are such a run if h(b) - h(a) + 1 >= 0. The least h up to a place and the greatest
    from a place on are monotone, so two places that only move forward meet the longest run, in steps that grow with the words."""
    h = F.transform(same, lambda x, i: 2 * i - x)
    empty = F.array().cast("array<int>")
    kept = lambda pick: lambda out, x: F.concat(out, F.array(pick(x, F.coalesce(F.get(out, F.size(out) - 1), x))))
    low = F.aggregate(h, empty, kept(F.least))
    high = F.reverse(F.aggregate(F.reverse(h), empty, kept(F.greatest)))
    whole = lambda x: F.lit(x).cast("int")

    def step(s, _):
        i, j = s["i"], s["j"]
        holds = F.get(s["high"], j) >= F.get(s["low"], i) - 1
        longer = holds & (j + 1 - i > s["n"])
        moved = F.struct((i + F.when(holds, 0).otherwise(1)).alias("i"), (j + F.when(holds, 1).otherwise(0)).alias("j"), F.when(longer, j + 1 - i).otherwise(s["n"]).alias("n"), F.when(longer, i).otherwise(s["a"]).alias("a"), s["low"].alias("low"), s["high"].alias("high"))
        return F.when(j < F.size(s["high"]), moved).otherwise(s)

    start = F.struct(whole(0).alias("i"), whole(0).alias("j"), whole(0).alias("n"), whole(0).alias("a"), low.alias("low"), high.alias("high"))
    return F.aggregate(F.sequence(F.lit(1), 2 * F.size(same)), start, step, lambda s: F.struct(s["n"].alias("n"), s["a"].alias("a")))


def find(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_match, n_span, n_item, first_word) for each contaminated document and item, the best diagonal.

    Null and empty texts and items without words never match; ties go to the smallest first_word; repeated rows
    count once, rows that share a doc_id give its best passage; further columns are ignored."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).dropDuplicates(["item_id", "words"])
    n = F.size("words")
    held = items.agg(F.sum(F.greatest(n - SPAN + 1, F.lit(1)).cast("long") * 48 * len(MASKS)), F.sum(F.octet_length(F.array_join("words", " ")).cast("long") + 16 * n), F.array_sort(F.collect_set(F.when(n < SPAN, n)))).first()  # at most SPAN - 1 lengths
    small, short = max(held[0] or 0, held[1] or 0) <= broadcast_bytes, held[2]
    hint = F.broadcast if small else (lambda x: x)
    seeds = _seeds(items, ["item_id", "words"], "item_at", short, True).select("seed", "item_id", "item_at", n.alias("n_item")).distinct()
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    diagonal = F.col("doc_at") - F.col("item_at")
    start = F.greatest(F.col("diagonal"), F.lit(0))
    part = F.slice("words", start + 1, F.col("diagonal") + F.col("n_item") - start).alias("part")
    hit = ["doc_id", "item_id", "diagonal"]
    if small:
        windows = _seeds(rows, ["doc_id", "words"], "doc_at", short, False)
        hits = windows.join(hint(seeds), "seed").select("doc_id", "item_id", diagonal.alias("diagonal"), "n_item", "words").select(*hit, part)
    else:  # the places alone are shuffled, and texts join their hits again
        windows = _seeds(rows, ["doc_id", "words"], "doc_at", short, False).select("doc_id", "doc_at", "seed")
        found = windows.join(seeds, "seed").select("doc_id", "item_id", diagonal.alias("diagonal"), "n_item").distinct().withColumnRenamed("doc_id", "of")
        hits = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of"))).select(*hit, part)
    both = hits.distinct().join(hint(items), "item_id")
    shift = F.greatest(-F.col("diagonal"), F.lit(0))
    # the parts start at the same place of both; item words before it hang over the document's start
    same = F.filter(F.sequence(F.lit(0), F.least(F.size("part"), F.size("words") - shift) - 1), lambda i: F.get("part", i) == F.get("words", i + shift))
    need = F.least(F.col("n_item"), F.lit(13), F.greatest(F.lit(8), F.ceil(F.col("n_item") / 2)))
    both = both.select(*hit, F.size("words").alias("n_item"), same.alias("same")).where(F.size("same") >= need)
    at = F.col("same")
    run = both.select("doc_id", "item_id", "diagonal", "n_item", "same", _longest_run(at).alias("run"))
    first, end = at[F.col("run.a")], at[F.col("run.a") + F.col("run.n") - 1]
    good = run.where(F.col("run.n") >= need).select(
        "doc_id", "item_id", "n_item", F.col("run.n").cast("int").alias("n_match"), (end - first + 1).cast("int").alias("n_span"),
        (F.greatest(F.col("diagonal"), F.lit(0)) + first).cast("int").alias("first_word"),
    )
    best = F.max_by(F.struct("n_match", "n_span", "n_item", "first_word"), F.struct("n_match", -F.col("first_word"), "n_span")).alias("best")
    return good.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


_ITEM_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_KEY = lambda mask, k, at: f"'{k}'" + "".join(f" || ' ' || words[{at} + {i + 1}]" for i in mask)
#: DuckDB's form of find().
_SHORT = " UNION ALL ".join(f"SELECT doc_id, place, 's{n} ' || array_to_string(words[place + 1:place + {n}], ' ') AS seed FROM (SELECT doc_id, words, unnest(range(len(words) - {n - 1})) AS place FROM docs WHERE len(words) {'=' if n < LEAST else '>='} {n})" for n in range(1, SPAN))
SQL = f"""
WITH items AS (SELECT DISTINCT item_id, words FROM (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
docs AS (SELECT DISTINCT doc_id, words FROM (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents) WHERE len(words) > 0),
item_at AS (SELECT item_id, words, unnest(range(len(words) - {SPAN - 1})) AS place FROM items WHERE len(words) >= {SPAN}),
doc_at AS (SELECT doc_id, words, unnest(range(len(words) - {SPAN - 1})) AS place FROM docs WHERE len(words) >= {SPAN}),
item_seeds AS ({" UNION ALL ".join(f"SELECT DISTINCT item_id, place, {_KEY(m, k, 'place')} AS seed FROM item_at" for k, m in enumerate(MASKS))}
  UNION ALL SELECT item_id, 0, 's' || len(words) || ' ' || array_to_string(words, ' ') FROM items WHERE len(words) < {SPAN}),
doc_seeds AS ({" UNION ALL ".join(f"SELECT doc_id, place, {_KEY(m, k, 'place')} AS seed FROM doc_at" for k, m in enumerate(MASKS))} UNION ALL {_SHORT}),
hits AS (SELECT DISTINCT d.doc_id, i.item_id, d.place - i.place AS diagonal FROM doc_seeds d JOIN item_seeds i USING (seed)),
pairs AS (SELECT h.doc_id, h.item_id, diagonal, len(i.words) AS n_item,
  list_filter(range(len(i.words)), lambda k: k + diagonal >= 0 AND k + diagonal < len(d.words) AND i.words[k + 1] = d.words[k + diagonal + 1]) AS same
  FROM hits h JOIN items i USING (item_id) JOIN docs d USING (doc_id)),
good AS (SELECT *, least(n_item, 13, greatest(8, ceil(n_item / 2.0))) AS need FROM pairs),
starts AS (SELECT *, unnest(range(1, len(same) + 1)) AS a FROM good WHERE len(same) >= need),
ends AS (SELECT *, unnest(range(a, len(same) + 1)) AS b FROM starts),
runs AS (SELECT doc_id, item_id, n_item::INT AS n_item, diagonal, a, (b - a + 1)::INT AS n_match, (same[b] - same[a] + 1)::INT AS n_span, (diagonal + same[a])::INT AS first_word
  FROM ends WHERE b - a + 1 >= need AND (b - a + 1) * 2 >= same[b] - same[a] + 1),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY n_match DESC, a) = 1)
SELECT doc_id, item_id, n_match, n_span, n_item, first_word FROM best
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_match DESC, first_word, n_span DESC) = 1
"""
