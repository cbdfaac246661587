"""Embedding near-dedup with a robust-pruned flat graph.

Vectors of one label are dealt to overlapping cluster shards. In each shard a flat graph is built: a
greedy search from the medoid gathers candidates for a vector, and robust pruning keeps a
neighbour only if no kept neighbour is much nearer to it. The shards' adjacency lists are united.
Then every vector is searched for in its shards over the united lists: a greedy search from the medoid
finds its surroundings, and the search range expands from every vector within the threshold to
its neighbours until none is new. What is found is verified in double precision. Each shard's recall is
audited on every fifth vector; a shard that misses links, as dense groups do in pruned graphs, is compared exactly.

Centers stand at least twice the threshold's angle apart, so a dense group of near copies has one
center, however many of its vectors were sampled, and all its members are dealt to it. A shard that
grows large that way has no graph: all its pairs are compared exactly, block by block, and come out
as counts and components, since a dense group has too many links to list.

The first level's centers are few, as they are broadcast. A shard that is crowded for want of centers is dealt
anew to centers of its own, level by level; only one that is dense in itself stays large.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components

DEGREE, BEAM, ALPHA = 24, 40, 1.2


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries in step: (ids, similarities), best first, -1 where there is none."""
    n, q = len(x), len(queries)
    beam = min(beam, n)
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf)
    done = np.ones((q, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    seen = np.zeros((q, n), bool)
    seen[:, start] = True
    rows = np.arange(q)
    while len(rows):
        open_sims = np.where(done[rows], -np.inf, sims[rows])
        pick = open_sims.argmax(axis=1)
        going = open_sims[np.arange(len(rows)), pick] > -np.inf
        rows, pick = rows[going], pick[going]
        if not len(rows):
            break
        done[rows, pick] = True
        near = graph[ids[rows, pick]]
        fresh = (near >= 0) & ~seen[rows[:, None], near]
        flat_row, flat_col = np.nonzero(fresh)
        seen[rows[flat_row], near[flat_row, flat_col]] = True
        new = np.full(near.shape, -np.inf)
        new[flat_row, flat_col] = (queries[rows[flat_row]] * x[near[flat_row, flat_col]]).sum(axis=1)
        all_sims = np.concatenate((sims[rows], new), axis=1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        line = np.arange(len(rows))[:, None]
        ids[rows] = np.concatenate((ids[rows], np.where(fresh, near, -1)), axis=1)[line, top]
        done[rows] = np.concatenate((done[rows], ~fresh), axis=1)[line, top]
        sims[rows] = all_sims[line, top]
    return ids, sims


def prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning of all points in step: the neighbours kept, -1 where there is none."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    own = x[np.maximum(candidates, 0)]
    far = np.where(valid, 1 - (own * x[points][:, None]).sum(axis=2), np.inf)
    out = np.full((len(points), degree), -1, np.int64)
    line = np.arange(len(points))
    for k in range(degree):
        best = far.argmin(axis=1)
        live = far[line, best] < np.inf
        if not live.any():
            break
        out[live, k] = candidates[line, best][live]
        between = 1 - (own * own[line, best][:, None]).sum(axis=2)
        gone = (alpha * between <= far) | (candidates == candidates[line, best][:, None])
        far[gone & live[:, None]] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, step: int = 128, seed: int = 5) -> tuple[np.ndarray, int]:
    """(graph, medoid) of unit vectors: two passes of search, prune and back links over all vectors in random order."""
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    random = np.random.default_rng(seed)
    graph = random.integers(0, n, (n, min(degree, max(1, n - 1))))
    graph = np.concatenate((graph, np.full((n, degree - graph.shape[1]), -1, np.int64)), axis=1)
    for _ in range(2):
        order = random.permutation(n)
        for a in range(0, n, step):
            points = order[a : a + step]
            found, _ = search(x, graph, medoid, x[points])
            graph[points] = prune(x, points, np.concatenate((found, graph[points]), axis=1))
            source, target = np.repeat(points, degree), graph[points].ravel()
            source, target = source[target >= 0], target[target >= 0]
            ranked = np.argsort(target, kind="stable")
            source, target = source[ranked], target[ranked]
            kinds, first, count = np.unique(target, return_index=True, return_counts=True)
            back = np.full((len(kinds), int(count.max(initial=1))), -1, np.int64)
            back[np.repeat(np.arange(len(kinds)), count), np.arange(len(target)) - np.repeat(first, count)] = source
            for b in range(0, len(kinds), step):
                graph[kinds[b : b + step]] = prune(x, kinds[b : b + step], np.concatenate((graph[kinds[b : b + step]], back[b : b + step]), axis=1))
    return graph, medoid


def within(x: np.ndarray, graph: np.ndarray, medoid: int, threshold: float, step: int = 256) -> np.ndarray:
    """Pairs (a < b) of similarity of the threshold or more: greedy search, then range expansion."""
    pairs = []
    for a in range(0, len(x), step):
        queries = np.arange(a, min(a + step, len(x)))
        found, sims = search(x, graph, medoid, x[queries])
        hit = np.zeros((len(queries), len(x)), bool)
        row, col = np.nonzero(sims >= threshold)
        hit[row, found[row, col]] = True
        hit[np.arange(len(queries)), queries] = True
        tried = np.zeros_like(hit)
        while True:
            row, at = np.nonzero(hit & ~tried)
            if not len(row):
                break
            tried[row, at] = True
            near = graph[at]
            row, near = np.repeat(row, near.shape[1]), near.ravel()
            keep = near >= 0
            row, near = row[keep], near[keep]
            new = np.unique(row * len(x) + near)
            row, near = new // len(x), new % len(x)
            keep = ~hit[row, near]
            row, near = row[keep], near[keep]
            good = (x[queries[row]] * x[near]).sum(axis=1) >= threshold
            hit[row[good], near[good]] = True
        row, at = np.nonzero(hit)
        pairs.append(np.stack((np.minimum(queries[row], at), np.maximum(queries[row], at)), axis=1)[queries[row] != at])
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)


def audited(x: np.ndarray, pairs: np.ndarray, threshold: float, every: int = 5, least: float = 0.99, step: int = 256) -> np.ndarray:
    """The pairs, where of every fifth vector's links at least 99 % are among them; else all pairs of x, compared exactly."""
    there = sum(int((x[i : i + every * step : every] @ x.T >= threshold).sum()) for i in range(0, len(x), every * step)) - len(range(0, len(x), every))
    if int((pairs % every == 0).sum()) >= least * there:
        return pairs
    out = []
    for a in range(0, len(x), step):
        row, at = np.nonzero(x[a : a + step] @ x[a:].T >= threshold)
        out.append(np.stack((row, at), axis=1)[at > row] + a)
    return np.concatenate(out)


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _unit(np.asarray(values.flatten(), np.float64).reshape(len(values), -1))


def _build(table: pa.Table) -> pa.Table:
    ids = np.asarray(table.column("id"))
    graph, _ = build(_matrix(table.column("v")))
    lists = [ids[g[g >= 0]].tolist() for g in graph]
    return pa.table([pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], names=["id", "near"])


def spread_places(x: np.ndarray, most_cosine: float) -> list[int]:
    """Places of those of unit vectors x that are no nearer than most_cosine to one kept before them."""
    held, places = np.empty_like(x), []
    for i, v in enumerate(x):
        if not places or (held[: len(places)] @ v).max() < most_cosine:
            held[len(places)] = v
            places.append(i)
    return places


def spread(x: np.ndarray, most_cosine: float) -> np.ndarray:
    return x[spread_places(x, most_cosine)]


def _lists(column, pad: int) -> np.ndarray:
    """Lists of numbers as rows, filled with pad."""
    rows = column.to_pylist()
    out = np.full((len(rows), max(1, max((len(r or ()) for r in rows), default=1))), pad, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r or ())] = r or ()
    return out


def _roots(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the connected component of each row and column, -1 where nothing is hit."""
    of_row, of_column, live = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1), hit.any(axis=1)
    for k in np.flatnonzero(live):
        if of_row[k] >= 0:
            continue
        rows = np.array([k])
        while len(rows):
            of_row[rows] = k
            columns = np.flatnonzero(hit[rows].any(axis=0) & (of_column < 0))
            of_column[columns] = k
            rows = np.flatnonzero(hit[:, columns].any(axis=1) & (of_row < 0))
    return of_row, of_column


def _blocks(threshold: float):
    """Of two blocks of a large shard the vectors with links: links' weight and the smallest id of the component in these blocks."""

    def work(table: pa.Table) -> pa.Table:
        ids, x, n = np.asarray(table.column("id")), _matrix(table.column("v")), np.asarray(table.column("n"))
        block, lo, hi = np.asarray(table.column("block")), table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        shard = table.column("shard")[0].as_py()
        before = _lists(table.column("large"), -1)
        before[before >= shard] = -1  # large shards that settle a pair before this one does
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        hit = np.zeros((len(a), len(b)), bool)
        for i in range(0, len(a), 512):
            own = a[i : i + 512]
            good = x[own] @ x[b].T >= threshold
            for k in range(before.shape[1]):
                for m in range(before.shape[1]):
                    good &= (before[own, k][:, None] != before[b, m][None]) | (before[own, k][:, None] < 0)
            hit[i : i + 512] = good
        if lo == hi:
            np.fill_diagonal(hit, False)
        weight = np.concatenate((hit @ n[b], n[a] @ hit if lo != hi else np.zeros(0, np.int64)))
        who = np.concatenate((ids[a], ids[b] if lo != hi else np.zeros(0, np.int64)))
        of_row, of_column = _roots(hit | np.eye(len(a), dtype=bool) if lo == hi else hit)
        group = np.concatenate((of_row, of_column if lo != hi else np.zeros(0, np.int64)))
        live = weight > 0
        weight, who, group = weight[live], who[live], group[live]
        kinds, at = np.unique(group, return_inverse=True)
        least = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(least, at, who)
        return pa.table([pa.array(who, pa.int64()), pa.array(weight, pa.int64()), pa.array(least[at], pa.int64())], names=["id", "others", "root"])

    return work


def _search(threshold: float):
    def work(table: pa.Table) -> pa.Table:
        ids, x = np.asarray(table.column("id")), _matrix(table.column("v"))
        order = np.argsort(ids)
        lists = [np.asarray(v, np.int64) for v in table.column("near").to_pylist()]
        size = np.array([len(v) for v in lists])
        flat = np.concatenate(lists) if len(lists) else np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)
        here = ids[order][at] == flat  # neighbours that stand in this shard
        graph = np.full((len(ids), max(1, int(size.max(initial=1)))), -1, np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        graph[row[here], (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size))[here]] = order[at[here]]
        medoid = int((x @ x.mean(axis=0)).argmax())
        pairs = audited(x, within(x, graph, medoid, threshold), threshold)
        large = _lists(table.column("large"), -1)
        x, y = large[pairs[:, 0]][:, :, None], large[pairs[:, 1]][:, None]
        pairs = pairs[~((x == y) & (x >= 0)).any(axis=(1, 2))]  # else settled, and counted, in a large shard
        a, b = ids[pairs[:, 0]], ids[pairs[:, 1]]
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return work


def valid(rows: DataFrame) -> DataFrame:
    """Rows whose vector can link: label and vector not null, all components finite, not all zero."""
    return rows.where(_can_link())


def _can_link():
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _nearest(vectors, centers: np.ndarray, overlap: int, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centers of each vector, best first, and their cosines."""
    sims, tops = [], []
    for i in range(0, len(vectors), step):
        s = vectors[i : i + step] @ centers.T
        top = np.argsort(-s, axis=1, kind="stable")[:, :overlap]
        tops.append(top)
        sims.append(np.take_along_axis(s, top, axis=1))
    return np.concatenate(tops), np.concatenate(sims)


def _fine(overlap: int):
    def work(table: pa.Table, centers: pa.Table) -> pa.Table:
        if not len(table) or not len(centers):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["id", "center", "sim"])
        of = np.asarray(centers.column("center"))
        top, sims = _nearest(_matrix(table.column("v")), _matrix(centers.column("v")), overlap)
        return pa.table([pa.array(np.repeat(np.asarray(table.column("id")), top.shape[1])), pa.array(of[top.ravel()]), pa.array(sims.ravel())], names=["id", "center", "sim"])

    return work


def _spread(most_cosine: float):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x = _matrix(table.column("v"))
        kept = spread_places(x, most_cosine)
        return table.take(pa.array(kept)).select(["label", "d", "shard", "id", "v"]).rename_columns(["label", "d", "shard", "center", "v"])

    return work


def refine(scratch: Scratch, classes: DataFrame, dealt: DataFrame, threshold: float, shard: int, overlap: int, most_centers: int, levels: int, part: int = 16_384) -> DataFrame:
    """dealt (id, label, v, d, shard, sim, home), with crowded shards dealt anew to centers of their own.

    A crowded shard's centers are spread over a sample, in proportion to its size, of the vectors at home there, so that no
    vector is a center of two shards; its vectors meet them in parts of about so many rows. Of the centers of all its
    shards a vector goes to the nearest. A shard without two centers is dense and stays as it is; so does what is
    crowded after the last level. Nothing of this passes through the driver."""
    key = ["label", "d", "shard"]
    kind = dealt.schema["v"].dataType.simpleString()
    for _ in range(levels):
        crowded = scratch.save(dealt.groupBy(*key).agg(F.count("*").alias("m"), F.count_if("home").alias("own")).where(F.col("m") > 4 * shard))
        if crowded.isEmpty():
            break
        wanted = F.least(F.lit(most_centers), F.col("m") / shard + 16) / F.greatest("own", F.lit(1))
        taken = dealt.where("home").join(crowded, key).where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < F.ceil(wanted * 1_000_000)).select(*key, "id", "v")
        centers = scratch.save(taken.groupBy(*key).applyInArrow(_spread(2 * threshold**2 - 1), f"label long, d int, shard long, center long, v {kind}"))
        several = centers.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1")
        split = scratch.save(crowded.join(several, key).select(*key, F.ceil(F.col("m") / part).alias("parts")))
        if split.isEmpty():
            break
        left = dealt.join(split, key).withColumn("part", F.pmod(F.xxhash64("id"), "parts")).select(*key, "part", "id", "v")
        right = centers.join(split, key).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(*key, "part", "center", "v")
        met = left.groupBy(*key, "part").cogroup(right.groupBy(*key, "part")).applyInArrow(_fine(overlap), "id long, center long, sim double")
        # a center's number among the shards: no less than 0 and far from the first level's
        fine = met.select("id", F.shiftrightunsigned(F.xxhash64("center", F.lit(11)), 1).alias("shard"), "sim")
        spots = fine.unionByName(dealt.join(split, key, "left_anti").select("id", "shard", "sim"))
        best = F.slice(F.sort_array(F.collect_set(F.struct("sim", "shard")), asc=False), 1, overlap)  # of overlap * overlap at most
        chosen = spots.groupBy("id").agg(best.alias("best")).select("id", F.posexplode("best").alias("k", "s"))
        placed = chosen.select("id", F.col("s.shard").alias("shard"), F.col("s.sim").alias("sim"), (F.col("k") == 0).alias("home"))
        again = placed.join(classes.select("id", "label", "v"), "id").select("id", "label", "v", F.size("v").alias("d"), "shard", "sim", "home")
        dealt = scratch.save(again)
    return dealt


def links(scratch: Scratch, classes: DataFrame, threshold: float, shard: int, overlap: int, most_centers: int, block: int = 4096, levels: int = 3) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of classes (label, v, id, n) found with a cosine of the threshold or more, and the links of
    large shards' pairs, not among those, as (id, others, root): members n linked to id, and an id that links reach."""
    spark = classes.sparkSession
    kind = classes.schema["v"].dataType.simpleString()
    counts = {(r["label"], r["d"]): r["n"] for r in classes.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}  # a row for each label
    total = sum(counts.values())
    share = min(1.0, (total / shard + 4 * len(counts)) / max(1, total), most_centers / max(1, total))
    taken = classes.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("label", "v").limit(4 * most_centers).collect()
    centers: dict[tuple, list] = {}
    for r in taken:
        centers.setdefault((r["label"], len(r["v"])), []).append(r["v"])
    held = spark.sparkContext.broadcast({k: spread(_unit(np.array(v, float)), 2 * threshold**2 - 1) for k, v in centers.items()})  # at most 4 * most_centers vectors

    def deal(batches):
        for batch in batches:
            label, vectors = batch.column("label").to_pylist(), batch.column("v").to_pylist()
            groups: dict[tuple, list[int]] = {}
            for i, (name, v) in enumerate(zip(label, vectors, strict=True)):
                groups.setdefault((name, len(v)), []).append(i)
            row, to, near, home = [], [], [], []
            for key, own in groups.items():
                c = held.value.get(key)
                if c is None:
                    row += own
                    to += [0] * len(own)
                    near += [0.0] * len(own)
                    home += [True] * len(own)
                    continue
                top, sims = _nearest(_unit(np.array([vectors[i] for i in own], float)), c, overlap)
                row += np.repeat(own, top.shape[1]).tolist()
                to += top.ravel().tolist()
                near += sims.ravel().tolist()
                home += ([True] + [False] * (top.shape[1] - 1)) * len(own)
            take = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([take.column("id"), take.column("label"), take.column("v"), pa.array([len(vectors[i]) for i in row], pa.int32()), pa.array(to, pa.int64()), pa.array(near, pa.float64()), pa.array(home, pa.bool_())], ["id", "label", "v", "d", "shard", "sim", "home"])

    dealt = scratch.save(classes.select("id", "label", "v").mapInArrow(deal, f"id long, label long, v {kind}, d int, shard long, sim double, home boolean"))
    dealt = refine(scratch, classes, dealt, threshold, shard, overlap, most_centers, levels).drop("sim", "home")
    key = ["label", "d", "shard"]
    crowded = scratch.save(dealt.groupBy(*key).agg(F.count("*").alias("m")).where(F.col("m") > 4 * shard).select(*key, F.ceil(F.col("m") / block).alias("blocks")))
    some = dealt.join(crowded, key)
    large = scratch.save(some.groupBy("id").agg(F.collect_set("shard").alias("large")))  # at most overlap each
    own = some.join(large, "id").join(classes.select("id", "n"), "id").select("id", *key, "v", "n", "large", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    counted = scratch.save(own.drop("other", "blocks").groupBy(*key, "lo", "hi").applyInArrow(_blocks(threshold), "id long, others long, root long"))
    usual = dealt.join(crowded, key, "left_anti")
    lists = usual.groupBy(*key).applyInArrow(_build, "id long, near array<long>")
    united = lists.select("id", F.explode("near").alias("x")).groupBy("id").agg(F.collect_set("x").alias("near"))  # at most overlap * DEGREE each
    full = usual.join(united, "id", "left").join(large, "id", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    return scratch.save(full.groupBy(*key).applyInArrow(_search(threshold), "a long, b long").distinct()), counted


def near_duplicates(rows: DataFrame, threshold: float = 0.93, shard: int = 700, overlap: int = 4, most_centers: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of rows (vec_id, embedding, label).

    Every row is a vector of its own, also where vec_ids repeat or are null: rows have keys of their own. component_id is
    the smallest vec_id of a component's rows, null where none of them has one; kept is whether it is the row's own, nulls
    being equal. Equal vectors of a label are one class while searching. Null labels and vectors that are null, empty,
    zero or hold null or non-finite components link with nothing. Vectors of other numbers than floats are read in
    double precision, as all cosines are. An empty table gives no row; further columns are ignored."""
    scratch = Scratch(rows.sparkSession, "vectors")
    element = rows.schema["embedding"].dataType.elementType.simpleString()
    vector = F.col("embedding") if element == "float" else F.col("embedding").cast("array<double>")
    rows = scratch.save(rows.select("vec_id", F.col("label").cast("long").alias("label"), vector.alias("embedding")).withColumn("row", F.monotonically_increasing_id()))
    good = valid(rows)
    classes = scratch.save(good.groupBy("label", F.col("embedding").alias("v")).agg(F.min("row").alias("id"), F.count("*").alias("n"), F.min("vec_id").alias("name")))
    found, counted = links(scratch, classes, threshold, shard, overlap, most_centers)
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.select(F.col("id").alias("b"), "n"), "b").select(F.col("a").alias("id"), F.col("n").alias("others"))
    others = others.unionByName(counted.select("id", "others")).groupBy("id").agg(F.sum("others").alias("others"))
    groups = components(scratch, found.unionByName(counted.select(F.col("root").alias("a"), F.col("id").alias("b"))))
    named = classes.select("label", "v", "id", "n", "name").join(others, "id", "left").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = scratch.save(named.select("label", "v", "name", "component", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    least = named.groupBy("component").agg(F.min("name").alias("component_id"))
    of_class = named.join(least, "component").select(F.col("label").alias("_label"), "v", "n_links", "component_id")
    linked = good.join(of_class, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("v"))).select("vec_id", "n_links", "component_id")
    alone = rows.where(~_can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = scratch.save(linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
    scratch.keep(out)
    return out


def audit(rows: DataFrame, result_links: DataFrame, threshold: float = 0.93, every: int = 50) -> tuple[int, int]:
    """(links found, links there are) of the vectors whose vec_id is divisible by `every`, by brute force against all rows in blocks."""
    good = valid(rows).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    queries = good.where(F.pmod("vec_id", F.lit(every)) == 0).collect()
    held = rows.sparkSession.sparkContext.broadcast([(r["vec_id"], r["label"], r["v"]) for r in queries])

    def work(batches):
        ids, label = np.array([q[0] for q in held.value]), np.array([q[1] for q in held.value])
        x = _unit(np.array([q[2] for q in held.value], float).reshape(len(ids), -1))
        for batch in batches:
            own = np.asarray(batch.column("vec_id"))
            sims = x @ _matrix(batch.column("v")).T
            good = (sims >= threshold) & (label[:, None] == np.asarray(batch.column("label"))[None]) & (ids[:, None] != own[None])
            q = np.nonzero(good)[0]
            yield pa.RecordBatch.from_arrays([pa.array(ids[q])], ["q"])

    truth = good.mapInArrow(work, "q long").count() if queries else 0
    found = result_links.where(F.pmod("vec_id", F.lit(every)) == 0).agg(F.sum("n_links")).first()[0] or 0
    return int(found), int(truth)
