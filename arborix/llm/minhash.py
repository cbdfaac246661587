"""MinHash near-dedup with ProbMinHash signatures.

A document's shingles (five words) weigh 1 + ln(times). Every shingle is a Poisson process of
that rate: its arrivals fall on registers at random, a register keeps its first arrival, and a
shingle stops once its time is beyond the document's slowest register. Equal registers then have
the probability Jaccard of two documents. Bands of registers give candidates, and a candidate is
a link if the exact Jaccard of its shingle sets is at least the threshold.

Exact copies (same words) form a class first, and one representative of each goes on. In a bucket,
members are held against pivots rather than each other: first against the member that shares
most buckets with others, then, while a bucket holds several components, against the best
members of the other components. A small bucket compares all members of different components.
What large buckets leave is settled exactly: over all members of large buckets that still hold
several components, an exact prefix filter finds the pairs of different components that can link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, n_parts, portions, slices, texts_of, word_hashes
from .components import components

WORDS = 5
_PLACE = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x9FB21C651E98DF25], np.uint64)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times), sorted, of distinct shingles; a text of one to four words is one shingle, one without words none."""
    words, first = word_hashes(texts)
    count = np.diff(first)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            runs += words[k : k + len(runs)] * _PLACE[k]
        runs = mix(runs)
        text = np.repeat(np.arange(len(texts)), np.maximum(0, count - WORDS + 1))
        offset = np.arange(len(text)) - np.repeat(np.cumsum(np.maximum(0, count - WORDS + 1)) - np.maximum(0, count - WORDS + 1), np.maximum(0, count - WORDS + 1))
        own = runs[np.repeat(first[:-1], np.maximum(0, count - WORDS + 1)) + offset] if len(text) else np.empty(0, np.uint64)
        short = np.flatnonzero((count > 0) & (count < WORDS))
        if len(short):
            rest = np.array([mix(np.array([np.sum(words[first[t] : first[t + 1]] * _PLACE[: count[t]], dtype=np.uint64) + np.uint64(count[t])]))[0] for t in short], np.uint64)
            text, own = np.concatenate((text, short)), np.concatenate((own, rest))
    order = np.lexsort((own, text))
    text, own = text[order], own[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (own[1:] != own[:-1])))) if len(text) else np.empty(0, np.int64)
    return text[new], own[new], np.diff(np.concatenate((new, [len(text)])))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash: per text the element that first arrived at each register."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    slowest = np.full(n, np.inf)
    active, time, step = np.arange(len(text)), np.zeros(len(text)), 0
    with np.errstate(over="ignore"):
        while len(active):
            h = mix(element[active] + np.uint64(0xD1B54A32D192ED03 * (2 * step + 1) & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[active]
            slot = text[active] * registers + (mix(h ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(registers)).astype(np.int64)
            live = time < slowest[text[active]]
            active, time, slot = active[live], time[live], slot[live]
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            winner[slot[won]] = element[active[won]]
            slowest = first.reshape(n, registers).max(axis=1)
            stay = time < slowest[text[active]]
            active, time, step = active[stay], time[stay], step + 1
    return winner.reshape(n, registers)


def _sign(bands: int, rows: int):
    names = ["doc_id", "k1", "k2", "n_shingles", "bands", "set"]

    def work(batches):
        for whole in portions(batches):
            for a, b in slices(whole, np.array([len(t) for t in texts_of(whole)]), 500_000):
                batch = whole.slice(a, b - a)
                texts, n = texts_of(batch), batch.num_rows
                text, element, times = shingles(texts)
                sig = signatures(text, element, 1 + np.log(times), n, bands * rows)
                words, first = word_hashes(texts)
                with np.errstate(over="ignore"):
                    place = (np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
                    keys = []
                    for seed in (0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9):
                        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words + place * np.uint64(seed)), dtype=np.uint64)))
                        keys.append(mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
                    band = np.zeros((n, bands), np.uint64)
                    for r in range(rows):
                        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, r * bands : (r + 1) * bands] + np.arange(bands, dtype=np.uint64))
                count = np.bincount(text, minlength=n)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(band.view(np.int64).ravel()))
                ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(ends), pa.array(element.astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys[0]), pa.array(keys[1]), pa.array(count), lists, own], names)

    return work


def _verify(scratch: Scratch, sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Those of pairs (a, b) whose shingle sets, among sets (id, set), have a Jaccard of the threshold or more."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    some = scratch.save(sets.join(ids, "id", "left_semi"))
    a, b = some.select(F.col("id").alias("a"), F.col("set").alias("x")), some.select(F.col("id").alias("b"), F.col("set").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("t"))
    # i / (t - i) >= threshold, free of rounding for thresholds of up to six places
    out = scratch.save(both.where(F.col("i").cast("long") * (1_000_000 + round(threshold * 1_000_000)) >= F.col("t").cast("long") * round(threshold * 1_000_000)).select("a", "b"))
    scratch.drop(some)
    return out


def _mixed(scratch: Scratch, live: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their component."""
    marked = live.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    return scratch.save(marked.join(mixed, "key", "left_semi"))


def _exact(scratch: Scratch, sets: DataFrame, marked: DataFrame, threshold: float, salts: int = 8, many: int = 256) -> DataFrame:
    """(rep, pivot) of all members of different components whose Jaccard can be the threshold: a prefix filter.

    A set's shingles are put in order, the rarest among these members first. Two sets that reach the threshold share
    one of the first n - ceil(threshold n) + 1 shingles of the larger and of the first
    n - ceil(2 threshold n / (1 + threshold)) + 1 of the smaller, and at the first that they share, what is left of
    both sets is still enough. A shingle of one member alone only counts as a place. Shingles that many members
    have in their prefix are dealt over salts."""
    t = round(threshold * 1_000_000)
    some = scratch.save(sets.join(marked.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"))
    grams = some.select("id", F.array_distinct("set").alias("set")).select("id", F.size("set").cast("long").alias("n"), F.explode("set").alias("e"))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n))
    dealt = F.pmod(F.xxhash64("id"), F.lit(salts))
    common = grams.groupBy("e").agg(F.count("*").alias("df")).where("df > 1").withColumn("salt", spread(F.lit(salts - 1).cast("long")))
    lists = grams.withColumn("salt", dealt).join(common, ["e", "salt"]).groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("own"))
    alone = F.col("n") - F.size("own")
    long, short = F.col("n") - F.expr(f"(n * {t} + 999999) div 1000000") + 1, F.col("n") - F.expr(f"(2 * n * {t} + {t + 999_999}) div {1_000_000 + t}") + 1
    prefix = lists.select("id", "n", alone.alias("alone"), short.alias("short"), F.posexplode(F.slice("own", F.lit(1), F.greatest(F.lit(0), long - alone).cast("int"))).alias("k", "own"))
    of = marked.select(F.col("rep").alias("id"), "component").distinct()
    posts = scratch.save(prefix.select("id", "n", (F.col("alone") + F.col("k")).alias("place"), "short", F.col("own.e").alias("e")).join(of, "id"))
    scratch.drop(some)
    sizes = posts.groupBy("e").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("e", "m")
    held = scratch.save(posts.join(sizes, "e"))
    large = F.col("m") > many
    x = held.where("place < short").withColumn("salt", F.when(large, dealt).otherwise(0)).alias("x")
    y = held.withColumn("salt", spread(F.when(large, F.lit(salts - 1)).otherwise(0).cast("long"))).alias("y")
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))  # this shingle counts too
    enough = left * (1_000_000 + t) >= (F.col("x.n") + F.col("y.n")) * t
    allowed = (F.col("x.e") == F.col("y.e")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.n") <= F.col("y.n")) & (F.col("x.n") * 1_000_000 >= F.col("y.n") * t) & enough
    return x.join(y, allowed).select(F.col("x.id").alias("rep"), F.col("y.id").alias("pivot"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 32, rows: int = 4, small: int = 48, rounds: int = 4) -> DataFrame:
    """(doc_id, class_id, component_id, kept) for each doc_id of docs (doc_id, text).

    class_id is the smallest doc_id with the same words, component_id the smallest that links reach;
    kept marks one document per component. Links between classes of one component aren't listed or counted.
    Texts without words (null and empty too) link with nothing and are kept. Rows that repeat a doc_id
    count as one document, rows without a doc_id as well; a caller that has such rows gives them keys of their own, as
    the pipeline does. An empty table gives no row; further columns are ignored."""
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select("doc_id", "text")
    # shingle sets are made once, and lie in buckets of doc_id, so that no later step shuffles all of them
    signed = scratch.save_by(docs.mapInArrow(_sign(bands, rows), "doc_id long, k1 long, k2 long, n_shingles long, bands array<long>, set array<int>").repartition(n_parts(docs.sparkSession), "doc_id"), "doc_id")
    sets = signed.select(F.col("doc_id").alias("id"), "set").dropDuplicates(["id"])
    classes = signed.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    held = signed.where("n_shingles > 0").drop("set").join(classes, ["k1", "k2"])
    member = scratch.save(held.groupBy("doc_id").agg(F.min("rep").alias("class_id")).unionByName(signed.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id")).distinct()))
    spots = held.where("doc_id = rep").select("rep", "n_shingles", F.explode("bands").alias("key")).distinct()
    sizes = spots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    live = scratch.save(spots.join(sizes, "key"))
    degree = live.groupBy("rep").agg(F.sum("n").alias("degree"))
    live = scratch.save(live.join(degree, "rep"))

    best = F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("pivot")
    ordered = lambda p: p.where("rep != pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    tested = scratch.save(ordered(live.join(live.groupBy("key").agg(best), "key")))
    links = _verify(scratch, sets, tested, threshold)
    found = scratch.save(components(scratch, links))
    for _ in range(rounds - 1):
        marked = _mixed(scratch, live, found)
        pivots = marked.groupBy("key", "component", "n").agg(best, F.max("degree").alias("d"))
        # of each component of a bucket its best member; in a large bucket the two best components' only
        place = F.struct("d", "pivot", "component")
        wide = pivots.where(F.col("n") > small)
        top = wide.groupBy("key").agg(F.max(place).alias("t"))
        second = wide.join(top, "key").where("component != t.component").groupBy("key").agg(F.max(place).alias("t"))
        large = top.unionByName(second).select("key", "t.pivot", F.col("t.component").alias("other"))
        some = marked.where(F.col("n") > small).join(large, "key").where("component != other")
        few = marked.where(F.col("n") <= small)
        every = few.join(few.select("key", F.col("rep").alias("pivot"), F.col("component").alias("other")), "key").where("component < other")
        pairs = scratch.save(ordered(some.select("rep", "pivot").unionByName(every.select("rep", "pivot"))).join(tested, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            break
        more = _verify(scratch, sets, pairs, threshold)
        tested = tested.unionByName(pairs)
        if more.isEmpty():
            break
        links = links.unionByName(more)
        found = scratch.save(components(scratch, links))
    pairs = scratch.save(ordered(_exact(scratch, sets, _mixed(scratch, live.where(F.col("n") > small), found), threshold)).join(tested, ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        more = _verify(scratch, sets, pairs, threshold)
        if not more.isEmpty():
            links = links.unionByName(more)
            found = scratch.save(components(scratch, links))
    out = member.join(found.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
    component = F.coalesce("component", "class_id")
    out = scratch.save(out.select("doc_id", "class_id", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")))
    scratch.keep(out)
    return out


def recall(bands: int, rows: int, similarity: float) -> float:
    """Chance that two documents of that probability Jaccard share a band."""
    return 1 - math.pow(1 - similarity**rows, bands)
